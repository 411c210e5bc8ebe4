from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import credentials, hashing, mixing, pseudonyms, sentences
from sparkmart.llm.common import text_buffer
from tests.llm.fixtures import docs, edge_rows, prose, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def test_words_match_the_pattern(monkeypatch):
    texts = [t for _, t, *_ in edge_rows()]
    for piece in (1 << 20, 7):
        monkeypatch.setattr(hashing, "PIECE", piece)
        buf, offs = text_buffer(pa.array(texts if piece > 7 else texts[:10]))
        w = hashing.words(buf, offs)
        got = defaultdict(list)
        for s, e, r in zip(w.start, w.end, w.row, strict=True):
            got[int(r)].append(buf[s:e].tobytes().decode())
        for i, t in enumerate(texts[:len(offs) - 1]):
            assert got[i] == WORD.findall(t or "")
        seen = {}
        for h, s, e in zip(w.hash.tolist(), w.start, w.end, strict=True):
            assert seen.setdefault(h, lower(buf[s:e].tobytes().decode())) == lower(buf[s:e].tobytes().decode())
        assert len(set(seen.values())) == len(seen)


def test_shingles():
    buf, offs = text_buffer(pa.array(["a b c d e f", None, "a b", "", "A b C d e"]))
    w = hashing.words(buf, offs)
    h, at = hashing.shingles(w)
    assert w.row[at].tolist() == [0, 0, 2, 4] and h[0] == h[3] and len(set(h.tolist())) == 3


def brute_sentences(rows):
    """Spans by plain loops: which sentences of each row go."""
    cut = []
    for i, t in rows:
        found = [(m.start(), m.end(), m[0]) for m in WORD.finditer(t or "")]
        groups = []
        for k, (s, e, word) in enumerate(found):
            if k == 0 or found[k - 1][2][-1] in ".!?" or "\n" in t[found[k - 1][1]:s]:
                groups.append([])
            groups[-1].append(lower(word))
        cut.append((i, groups))
    first, spans = {}, []
    for r, (i, groups) in sorted(enumerate(cut), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0])):
        for p in range(len(groups)):
            for n in range(2, len(groups) - p + 1):
                if sum(map(len, groups[p:p + n])) >= 20:
                    key = tuple(w for g in groups[p:p + n] for w in g)
                    if first.setdefault(key, (r, p)) != (r, p):
                        spans.append((r, p, n))
                    break
    gone = defaultdict(set)
    for r, p, n in spans:
        gone[r] |= set(range(p, p + n))
    return [(i, len(g), len(gone[r])) for r, (i, g) in enumerate(cut)]


def test_sentence_spans(spark, tmp_path):
    rows = edge_rows()
    many = [(100 + k, prose(k, 30) + "\n" + prose(7, 60) + "\n" + prose(k + 50, 30), "en", "a") for k in range(9)]
    df = stored(spark, docs(spark, rows + many).coalesce(1), tmp_path)
    out = sentences.dedup_sentences(df).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r.doc_id, r.n_sentences, r.n_removed) for r in out), key=key) == sorted(
        brute_sentences([(i, t) for i, t, *_ in rows + many]), key=key)
    words = lambda text: len(WORD.findall(text or ""))
    left = sorted(words(r.text) + r.n_words_removed for r in out)
    assert left == sorted(words(t) for _, t, *_ in rows + many)
    by = {r.doc_id: r for r in out}
    assert by[1].text is None and by[3].text == rows[2][1]
    assert sum(len(WORD.findall(by[100 + k].text)) > 100 for k in range(9)) == 1
    assert sentences.dedup_sentences(docs(spark, [])).count() == 0


def test_passages_without_stops_go(spark, tmp_path):
    def plain(seed, n):
        return " ".join(x.strip(".!\n") for x in prose(seed, n).split(" "))

    shared = plain(41, 60)
    rows = [(k, plain(50 + k, 12) + " " + shared + " " + plain(70 + k, 12), "en", "a") for k in range(12)]
    rows += [(20 + k, plain(90, 55), "en", "a") for k in range(3)]
    wide = "".join(f"{chr(0x4E00 + 37 * k)}{chr(0x5000 + 91 * k)}漢字漢字。" for k in range(30))
    rows += [(30, "甲乙。" + wide, "zh", "a"), (31, "丙丁。" + wide + "戊己。", "zh", "a"), (32, wide[:5], "zh", "a")]
    rows += [(40, "ha " * 100, "en", "a")]
    df = stored(spark, docs(spark, rows), tmp_path)
    by = {r.doc_id: r for r in sentences.dedup_sentences(df).collect()}
    assert by[0].text == rows[0][1] and by[20].text == rows[12][1] and by[30].text == rows[15][1]
    for k in range(1, 12):
        left = by[k].text.split()
        assert left[:12] == plain(50 + k, 12).split() and left[-12:] == plain(70 + k, 12).split()
        assert len(left) <= 24 + 40
    assert by[21].text == by[22].text and len(by[21].text.split()) <= 35
    assert by[31].text == "丙丁。戊己。" and by[31].n_sentences == 32 and by[32].text == wide[:5]
    assert len(by[40].text.split()) == 20


def brute_base(text):
    kinds = ("assign", "access", "hex")
    out = [("assign", m.start(), m.end()) for m in re.finditer(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text, re.ASCII) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], kinds.index(x[0])))


SECRETS = [
    (50, "é token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" x", "en", "a"),
    (51, "token: token:abcdefghij PASSWD=short1 secret=longenough AKIA1234 AKIAABCDEFGHIJKL12", "en", "a"),
    (52, "toKen=abcdefghi ſecret=abcdefghi", "en", "a"),
    (53, "Zq8Rk2mX9vLw4TtY7bNc1PfH and nothing else", "en", "a"),
    (54, "AKIAABCDEFGHIJKL12 then Zq8Rk2mX9vLw4TtY7bNc1PfH at https://db.example.com/x", "en", "a"),
    (55, "AKIAABCDEFGHIJKL12 " + "lorem " * 100 + " Zq8Rk2mX9vLw4TtY7bNc1PfH", "en", "a"),
    (56, "0123456789abcdef0123456789abcdef" * 3 + " 🙂 apikey='ab.cd-ef_gh'", "en", "a"),
    (57, "host 10.0.0.1 only", "en", "a"), (58, "10.0.0.1 password: correcthorse", "en", "a"),
]


def test_secrets(spark):
    rows = edge_rows() + SECRETS
    out = credentials.scan_secrets(docs(spark, rows)).collect()
    want = []
    for i, t, *_ in rows:
        base = brute_base(t or "")
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        want.append((i, *[sum(k == x for k, *_ in base) for x in ("assign", "access", "hex")],
                     hashlib.sha256(text.encode()).hexdigest()))
    key = lambda x: (x[0] is not None, *x)
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out]
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
    kinds = {r.doc_id: [x.split(":")[0] for x in r.spans.split(",") if x] for r in out}
    assert kinds[53] == [] and kinds[57] == [] and kinds[55] == ["access"]
    assert kinds[54] == ["access", "weak_secret", "endpoint"] and kinds[58] == ["endpoint", "assign"]
    assert credentials.scan_secrets(docs(spark, [])).count() == 0


def test_redact(spark):
    rows = edge_rows() + SECRETS
    df = docs(spark, rows)
    out = credentials.redact(df)
    assert out.columns == df.columns and out.count() == len(rows)
    by = {r.doc_id: r.text for r in out.collect()}
    assert by[50] == "é [assign]\" x" and by[58] == "[endpoint] [assign]" and by[7] == edge_rows()[6][1]
    assert by[1] is None and by[53] == SECRETS[3][1]


def test_links_equal_plain_loops(spark):
    """Weak parts beside complementary ones, by comparing all parts of a row; then redaction."""
    import random

    r, scope = random.Random(4), 20
    parts = []
    for rid in range(40):
        for _ in range(r.randint(0, 12)):
            start = r.randint(0, 400)
            parts.append((rid, r.choice(credentials.KINDS), start, start + r.randint(1, 60)))
    want = set()
    for rid, kind, start, end in parts:
        if kind in credentials.KINDS[3:]:
            secret = credentials.ROLE[kind] == "secret"
            if any(o[0] == rid and (credentials.ROLE[o[1]] == "secret") != secret
                   and o[2] <= end + scope and o[3] >= start - scope for o in parts):
                want.add((rid, kind, start, end))
    frame = spark.createDataFrame(parts, "rid bigint, kind string, start bigint, end bigint")
    got = [tuple(x) for x in credentials.link_parts(frame, scope).collect()]
    assert set(got) == want and len(got) == len(want) and 20 < len(want) < len(set(parts))


def test_redaction_equals_plain_loops(spark):
    rows = [x for x in edge_rows() + SECRETS if x[0] is not None]
    df = docs(spark, rows)
    told = {(x.doc_id, x.spans) for x in credentials.scan_secrets(df).collect()}
    by = {}
    for i, spans in told:
        by.setdefault(i, []).append(spans)
    want = []
    for i, t, *_ in rows:
        out, at = "", 0
        cut = [x.split(":") for x in by[i][0].split(",") if x]
        for kind, s, e in sorted(cut, key=lambda x: (int(x[1]), -int(x[2]), x[0])):
            s, e = int(s), int(e)
            if e > at:
                out += "" if s < at else t[at:s] + f"[{kind}]"
                at = e
        want.append((i, None if t is None else out + t[at:]))
    assert sorted(map(str, ((x.doc_id, x.text) for x in credentials.redact(df).collect()))) == sorted(map(str, want))


def test_mix_targets(spark):
    rows = [(i + 1000, "w " * (i % 7 + 1), "en", s) for i, s in enumerate("aaaabbbbbbbbbbbbbbbccccccccccccccccccc" * 9)]
    out = mixing.mix_sources(docs(spark, rows + edge_rows())).collect()
    assert len(out) == len(rows) + len(edge_rows())
    texts = {i: len(WORD.findall(t or "")) for i, t, *_ in rows + edge_rows()}
    taken, target, size = defaultdict(int), {}, {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and r.size == texts[r.doc_id]
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    total = sum(size.values())
    assert sum(target.values()) == pytest.approx(total)
    for s in target:
        assert target[s] <= 3 * size[s] and abs(taken[s] - target[s]) <= max(8, 0.02 * target[s])
    again = mixing.mix_sources(docs(spark, rows + edge_rows()).repartition(5)).collect()
    pick = lambda rows: sorted(str((r.doc_id, r.size, r.source, r.taken)) for r in rows)
    assert pick(out) == pick(again)
    assert mixing.mix_sources(docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix_sources(docs(spark, edge_rows()[:3])).collect()] == [0, 0, 0]


def test_mix_small_source(spark):
    sizes = {f"s{k:02}": 200 for k in range(19)} | {"zz": 5}
    rows = [(100 * k + i, "w " * (1 if s == "zz" else 400), "en", s)
            for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    out = mixing.mix_sources(docs(spark, rows)).collect()
    assert len(out) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in out)
    taken = sum(r.taken for r in out if r.source == "zz")
    target = next(r.target for r in out if r.source == "zz")
    assert 0 < target and abs(taken - target) <= 3  # blocks of one word
    for s in sizes:
        target = next(r.target for r in out if r.source == s)
        assert abs(sum(r.taken for r in out if r.source == s) - target) < max(1, 0.02 * target)


def luhn(d):
    x = [int(c) for c in d][::-1]
    return sum(x[::2]) % 10 == -sum((2 * c if c < 5 else 2 * c - 9) for c in x[1::2]) % 10


PRIVATE = [
    (60, "Card 4111 1111 1111 1111, again 4111111111111111; bad 4111111111111112.", "en", "a"),
    (61, "Born 1970-02-28, not 1970-02-30; call +1 (499) 555-6503 or (212) 555-0199.", "en", "a"),
    (62, "ip 152.143.123.131 not 300.1.1.1; mail that.92@mail2.example.com ssn 123-45-6789 666-45-6789", "en", "a"),
    (63, "same: +1 (499) 555-6503 and 152.143.123.131 and 4111111111111111 at the end 1970-02-28", "en", "a"),
]


def test_pseudonyms(spark):
    rows = edge_rows() + PRIVATE
    df = docs(spark, rows)
    out = pseudonyms.pseudonymise(df, "sparkmart")
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) and set(df.columns) < set(out.columns)
    for i, t, *_ in edge_rows():
        if i is not None:
            assert by[i].text == t and by[i].n_card == 0
    a = re.fullmatch(r"Card (\d{4} \d{4} \d{4} \d{4}), again (\d{16}); bad 4111111111111112\.", by[60].text)
    assert a and a[1].replace(" ", "") == a[2] != "4111111111111111" and luhn(a[2]) and by[60].n_card == 2
    b = re.fullmatch(r"Born (\d{4}-\d\d-\d\d), not 1970-02-30; call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\(\d{3}\) \d{3}-\d{4})\.",
                     by[61].text)
    assert b and np.datetime64(b[1]) and (by[61].n_date, by[61].n_phone) == (1, 2)
    c = re.fullmatch(r"ip ([\d.]+) not 300\.1\.1\.1; mail p[0-9a-f]{16}@example\.com ssn (\d{3}-\d\d-\d{4}) 666-45-6789",
                     by[62].text)
    assert c and all(int(x) < 256 for x in c[1].split(".")) and (by[62].n_ip, by[62].n_email, by[62].n_ssn) == (1, 1, 1)
    assert by[63].text == f"same: {b[2]} and {c[1]} and {a[2]} at the end {b[1]}"


def test_pseudonyms_are_permutations(spark):
    from datetime import date, timedelta

    days = [str(date(1800, 1, 1) + timedelta(days=i)) for i in range(0, 146097, 7)]
    texts = [(i, " ".join(days[i::20]), "en", "a") for i in range(20)]
    out = " ".join(r.text for r in pseudonyms.pseudonymise(docs(spark, texts), "sparkmart").collect()).split()
    assert len(out) == len(days) == len(set(out)) and all("1800-01-01" <= x <= "2199-12-31" for x in out)
    other = pseudonyms.pseudonymise(docs(spark, texts), key="other").first().text
    assert other != pseudonyms.pseudonymise(docs(spark, texts), "sparkmart").first().text


def feistel(a, b, sizes, tag, key):
    """Ten rounds by plain arithmetic: even ones move ``a`` by a hash of ``b``, odd ones the other way."""
    for r in range(10):
        x, size = (b, sizes[0]) if r % 2 == 0 else (a, sizes[1])
        f = int(hashlib.sha256("|".join([key, *tag, str(r), str(x)]).encode()).hexdigest()[:15], 16) % size
        a, b = ((a + f) % sizes[0], b) if r % 2 == 0 else (a, (b + f) % sizes[1])
    return a, b


def digits_moved(d, tag, key):
    u = len(d) // 2
    v = len(d) - u
    a, b = feistel(int(d[:u]), int(d[u:]), (10 ** u, 10 ** v), (tag, str(len(d))), key)
    return f"{a:0{u}}{b:0{v}}"


def other_value(kind, m, key):
    """The pseudonym of a valid value by plain Python; None if it isn't valid."""
    from datetime import date, timedelta

    d = re.sub("[^0-9]", "", m)
    into = lambda new: re.sub("[0-9]", lambda _, it=iter(new): next(it), m)
    if kind == "email":
        return "p" + hashlib.sha256(f"{key}|email|{lower(m)}".encode()).hexdigest()[:16] + "@example.com"
    if kind == "date":
        try:
            n = (date.fromisoformat(m) - date(1800, 1, 1)).days
        except ValueError:
            return None
        a, b = feistel(n // 5411, n % 5411, (27, 5411), ("date",), key)
        return str(date(1800, 1, 1) + timedelta(days=a * 5411 + b)) if 0 <= n < 146097 else None
    if kind == "ssn":
        area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        place = (area - 1 - (area > 666)) * 99 + group - 1
        a, b = feistel(place, serial - 1, (898 * 99, 9999), ("ssn",), key)
        area = a // 99 + 1
        return f"{area + (area >= 666):03}-{a % 99 + 1:02}-{b + 1:04}"
    if kind == "ip":
        o = [int(x) for x in m.split(".")]
        if max(o) > 255:
            return None
        a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536), ("ip",), key)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "phone":
        return into(d[:-10] + digits_moved(d[-10:], "phone", key)) if 7 <= len(d) <= 15 else None
    if not (13 <= len(d) <= 19 and luhn(d)):
        return None
    body = digits_moved(d[:-1], "card", key)
    return into(next(body + c for c in "0123456789" if luhn(body + c)))


def test_pseudonyms_equal_plain_python(spark):
    import random

    r = random.Random(3)
    digit = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card(n):
        body = digit(n - 1)
        return next(body + c for c in "0123456789" if luhn(body + c))

    made = [lambda: f"u{digit(2)}.x@mail{digit(1)}.example.co{r.choice(['m', 'm.', 'm..x', 'm-', '1'])}",
            lambda: f"{r.randint(1700, 2300)}-{r.randint(0, 13):02}-{r.randint(0, 32):02}",
            lambda: f"{digit(3)}-{digit(2)}-{digit(4)}", lambda: ".".join(str(r.randint(0, 280)) for _ in range(4)),
            lambda: f"+{digit(2)} ({digit(3)}) {digit(3)}-{digit(4)}", lambda: f"({digit(3)}) {digit(3)}-{digit(4)}",
            lambda: card(r.randint(13, 19)), lambda: " ".join([(c := card(16))[:4], c[4:8], c[8:12], c[12:]]),
            lambda: digit(16), lambda: "plain words"]
    texts = [" ; ".join(r.choice(made)() for _ in range(12)) for _ in range(300)]
    want = []
    for text in texts:
        count = dict.fromkeys(pseudonyms.KINDS, 0)

        def swap(m, count=count):
            kind = next(k for k, p in pseudonyms.PATTERNS if re.fullmatch(p, m[0]))
            new = other_value(kind, m[0], "k3y")
            count[kind] += new is not None
            return m[0] if new is None else new
        want.append((re.sub(pseudonyms.ANY, swap, text), *count.values()))
    assert all(sum(w[1 + k] for w in want) > 20 for k in range(6))
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = {x.doc_id: (x.text, *(x[f"n_{k}"] for k in pseudonyms.KINDS))
           for x in pseudonyms.pseudonymise(docs(spark, rows), "k3y").collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_pseudonyms_of_megabyte_texts_are_linear(spark):
    import time

    n = 1 << 20
    texts = ["a@" + "b." * (n // 2) + " 1", "x" * n + " 1", "1" * n, "1 " * (n // 2), "a@b." * (n // 4) + " 1",
             "+1-" * (n // 3), "1.1." * (n // 4), "a@" + "b" * n, "a@b" * (n // 3) + " 4111111111111111"]
    for text in texts:
        start = time.time()
        row = pseudonyms.pseudonymise(docs(spark, [(1, text, "en", "a")]), "k3y").first()
        assert time.time() - start < 10, text[:9]
        assert row.text == text or row.n_card == row.n_phone + 1


def test_mix_equals_its_sql(spark, tmp_path):
    """Twenty sources, two of them tiny, a third of the ids NULL, repeated rows."""
    import duckdb

    rows = []
    for k in range(20):
        n, words = (3, 1) if k in (4, 17) else (60, 40)
        rows += [(None if i % 3 == 0 else 1000 * k + i, "w " * (words + i % 5), "en", f"s{k:02}") for i in range(n)]
    rows += [(7, "w " * 40, "en", None)] * 50 + [(None, "", "en", "s01"), (8, None, "en", "s02")]
    df = stored(spark, docs(spark, rows), tmp_path)
    out = mixing.mix_sources(df)
    got = sorted(map(str, out.select("doc_id", "size", "source_size", "target", "taken").collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/docs.parquet/*.parquet'")
    sql = con.execute(f"select doc_id, size, source_size, target, taken from ({mixing.mixing_sql()})").fetchall()
    schema = "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"
    assert got == sorted(map(str, spark.createDataFrame([(a, b, int(c), d, e) for a, b, c, d, e in sql], schema).collect()))
    taken, target = defaultdict(int), {}
    for r in out.collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= max(3, 0.02 * t) for s, t in target.items())


def test_mix_running_sums_in_small_blocks(spark, monkeypatch):
    rows = [(k, "w " * (k % 9 + 1), "en", f"s{k % 300:03}") for k in range(3000)]
    pick = lambda: sorted((r.source, r.source_size, round(r.target, 6)) for r in mixing.mix_sources(docs(spark, rows)).collect())
    whole = pick()
    monkeypatch.setattr(mixing, "SOURCES", 7)
    assert pick() == whole
