from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from sparkmart.llm import jaccard, suffixes, tiling, vectors
from tests.llm.fixtures import docs, edge_rows, prose, stored
from tests.llm.test_text_operators import WORD, lower


def brute_suffixes(rows):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    for i, b in data:
        for p in range(len(b) - 49):
            s = b[p:p + 50]
            if s not in first or order(i) < order(first[s]):
                first[s] = i
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 49):
            if order(first[b[p:p + 50]]) < order(i):
                gone[p:p + 50] = True
        gone = gone[:-1]
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def near_rows(n=40):
    r = random.Random(3)
    rows = []
    for k in range(n):
        base = prose(k % 6, 60).split(" ")
        for _ in range(r.randint(0, 4)):
            base[r.randrange(len(base))] = r.choice(["neu", "alt", "base", prose(99, 1)])
        cut = r.randint(0, 5)
        rows.append((1000 - 7 * k, " ".join(base[cut:]) + r.choice(["", " é", " " + prose(200 + k, 25)]), "en", "a"))
    return rows


@pytest.mark.parametrize(("chunk", "hot"), [(1 << 20, 64), (1500, 64), (1500, 2), (400, 1)])
def test_suffixes(spark, chunk, hot):
    rows = [(i, (t or "")[:3000] if t is not None else None, a, b) for i, t, a, b in edge_rows()] + near_rows()
    got = [tuple(r) for r in suffixes.dedup_suffixes(docs(spark, rows), chunk, hot).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_suffixes([(i, t) for i, t, *_ in rows])))
    assert suffixes.dedup_suffixes(docs(spark, [])).count() == 0


@pytest.mark.parametrize(("chunk", "hot"), [(1 << 20, 64), (1500, 1)])
def test_suffixes_tell_letter_case(spark, chunk, hot):
    r, rows = random.Random(8), []
    for k in range(40):
        text = list(prose(k % 4, 50))
        for _ in range(k // 4 % 4):
            i = r.randrange(len(text))
            text[i] = text[i].swapcase()
        rows.append((k, "".join(text), "en", "a"))
    got = [tuple(r) for r in suffixes.dedup_suffixes(docs(spark, rows), chunk, hot).collect()]
    assert sorted(got) == sorted(brute_suffixes([(i, t) for i, t, *_ in rows]))


def test_a_line_of_a_third_of_all_documents(spark):
    """Every third of 600 short documents has one line; its windows are split by content."""
    line = "This line is the same in very many of the documents, all of its hundred bytes and a few more."
    rows = [(k, prose(300 + k, 12) + ("\n" + line + "\n" if k % 3 == 0 else " ") + prose(900 + k, 12), "en", "a")
            for k in range(600)]
    rows += [(700, prose(7, 900), "en", "a"), (701, "x" + prose(7, 900), "en", "a")]
    got = [tuple(r) for r in suffixes.dedup_suffixes(docs(spark, rows), 2000, 4).collect()]
    assert sorted(got) == sorted(brute_suffixes([(i, t) for i, t, *_ in rows]))


def test_deep_shallow_order():
    r = np.random.default_rng(1)
    for n in (1, 2, 500):
        x = r.integers(97, 99, (n, 50)).astype(np.uint8)
        x[n // 3:2 * n // 3, :40] = 97
        x[n // 2:, :] = x[:n - n // 2, :]
        order, lcp = suffixes.deep_shallow_order(x)
        rows = [x[i].tobytes() for i in order]
        assert rows == sorted(rows)
        for k in range(1, n):
            same = next((j for j in range(50) if rows[k][j] != rows[k - 1][j]), 50)
            assert same == lcp[k]


def brute_jaccard(rows):
    sets = []
    for _, t in rows:
        w = [lower(x) for x in WORD.findall(t or "")]
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None) if sets[k] else (i, 0, i))
    return out


@pytest.mark.parametrize("picks", [6, 1])
def test_jaccard(spark, monkeypatch, tmp_path, picks):
    monkeypatch.setattr(jaccard, "PICKS", picks)
    rows = edge_rows() + near_rows(80)
    df = stored(spark, docs(spark, rows), tmp_path)
    got = [tuple(r) for r in jaccard.jaccard_join(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_jaccard([(i, t) for i, t, *_ in rows])))


def test_jaccard_empty_and_groups(spark, tmp_path):
    assert jaccard.jaccard_join(docs(spark, [])).count() == 0
    rows = near_rows(20)
    df = stored(spark, docs(spark, rows), tmp_path)
    kept = jaccard.one_per_component(df)
    want = {c for i, _, c in brute_jaccard([(i, t) for i, t, *_ in rows])}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == df.columns


def brute_one_per_component(rows):
    """Indexes of the rows that may stay, a list of equally good ones per component."""
    sets = []
    for r in rows:
        w = [lower(x) for x in WORD.findall(r[1] or "")]
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    out = []
    for g in sorted(set(group)):
        own = [k for k in range(len(rows)) if group[k] == g]
        best = min((rows[k][0] is None, rows[k][0] or 0) for k in own)
        out.append([k for k in own if (rows[k][0] is None, rows[k][0] or 0) == best])
    return out


def same_rows(got, rows):
    """Is ``got`` one row of each component of ``rows``, and nothing else?"""
    left = list(got)
    for own in brute_one_per_component(rows):
        found = next((rows[k] for k in own if rows[k] in left), None)
        if found is None:
            return False
        left.remove(found)
    return not left


def repeated_id_rows():
    near = prose(31, 60)
    return [
        (3, near, "en", "a"), (5, prose(32, 60), "en", "a"), (5, near + " more", "en", "b"),
        (None, near + " end", "en", "a"), (None, prose(33, 40), "en", "a"), (None, prose(34, 40), "de", "b"),
        (None, "", "en", "a"), (None, None, "en", "a"), (6, "", "en", "a"), (6, " ", "en", "a"),
        (None, prose(35, 40), "en", "a"), (None, prose(35, 40) + " x", "en", "a"),
        (8, prose(36, 40), "en", "a"), (8, prose(36, 40).upper(), "en", "b"),
    ]


def test_one_per_component_by_row(spark, tmp_path):
    rows = repeated_id_rows()
    df = stored(spark, docs(spark, rows), tmp_path)
    out = jaccard.one_per_component(df)
    assert out.columns == df.columns
    got = sorted(map(str, out.collect()))
    assert same_rows([tuple(r)[:4] for r in out.collect()], rows)
    assert got == sorted(map(str, jaccard.one_per_component(df).collect()))


def brute_tiles(d, w, seed=5):
    """Greedy string tiling by plain comparison."""
    seed = min(seed, len(w))
    free_d, free_w, out = [True] * len(d), [True] * len(w), []
    while True:
        best = (seed - 1, 0, 0)
        for p in range(len(d)):
            for q in range(len(w)):
                n = 0
                while (p + n < len(d) and q + n < len(w) and free_d[p + n] and free_w[q + n] and d[p + n] == w[q + n]):
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < seed or not n:
            return out
        out.append((p, q, n))
        free_d[p:p + n] = free_w[q:q + n] = [False] * n


def test_tiles():
    r = random.Random(5)
    for _ in range(60):
        d = np.array([r.randint(0, 4) for _ in range(r.randint(0, 60))], np.uint64)
        w = np.array([r.randint(0, 4) for _ in range(r.randint(0, 30))], np.uint64)
        assert tiling.tiles(d, w) == brute_tiles(d.tolist(), w.tolist())


@pytest.mark.parametrize("small", [8 << 20, -1])
def test_contamination(spark, tmp_path, small):
    items = [(1, prose(301, 40)), (2, prose(302, 40)), (3, None), (4, ""), (5, "one two three"), (6, prose(301, 40))]
    bench = spark.createDataFrame(items, "item_id int, text string")
    w = items[1][1].split()
    rows = edge_rows() + [
        (70, prose(9, 50) + " " + items[0][1].upper() + " " + prose(10, 50), "en", "a"),
        (71, " ".join(w[20:] + ["gap"] + w[:20]), "en", "a"), (72, " ".join(w[:15]), "en", "a"),
        (73, " ".join(x for k in range(0, 40, 4) for x in [*w[k:k + 4], "and"]), "en", "a")]
    df = stored(spark, docs(spark, rows), tmp_path)
    got = {(r.doc_id, r.item_id): (r.n_tiles, r.matched_words) for r in
           tiling.contaminated_pairs(df, bench, small_bytes=small).collect()}
    assert got == {(70, 1): (1, 40), (70, 6): (1, 40), (71, 2): (2, 40), (5, 5): (1, 3)}
    clean = tiling.decontaminate(df, bench)
    assert clean.columns == df.columns and clean.count() == len(rows) - 3
    assert tiling.contaminated_pairs(docs(spark, []), bench).count() == 0
    assert tiling.contaminated_pairs(df, bench.limit(0)).count() == 0


@pytest.mark.parametrize("small", [8 << 20, -1])
def test_contamination_equals_plain_tiling(spark, tmp_path, small):
    """Every document against every item; one phrase is in most documents and items."""
    r, phrase = random.Random(11), prose(400, 7).split()
    items = [(k, prose(500 + k, r.choice([3, 6, 12, 30])).split() + (phrase if k % 2 else [])) for k in range(12)]
    rows = []
    for k in range(60):
        words = phrase + prose(700 + k, 15).split()
        for _ in range(r.randint(0, 3)):
            w = r.choice(items)[1]
            a = r.randrange(len(w))
            words += w[a:] + ["gap"] * r.randint(0, 1) + w[:a]
        rows.append((None if k % 9 == 8 else k // 2, " ".join(words), "en", "a"))
    rows += [(90, None, None, None), (91, "", "en", "a")]
    want = []
    for i, t, *_ in rows:
        doc = [lower(x) for x in WORD.findall(t or "")]
        for j, w in items:
            item = [lower(x) for x in w]
            found = brute_tiles(doc, item)
            matched = sum(n for *_, n in found)
            if 2 * matched >= len(item):
                want.append((i, j, len(found), matched, len(item)))
    assert len(want) > 40
    bench = spark.createDataFrame([(j, " ".join(w), 1) for j, w in items], "item_id int, text string, _rid int")
    df = stored(spark, docs(spark, rows), tmp_path)
    got = [(x.doc_id, x.item_id, x.n_tiles, x.matched_words, x.item_words)
           for x in tiling.contaminated_pairs(df, bench, small_bytes=small).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_vectors(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((30, 16))
    rows = [(i, (base[i % 30] + r.standard_normal(16) * r.choice([0, 0.03, 0.12])).tolist(), i % 3) for i in range(300)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] + [1.0] * 15, 1),
             (304, rows[0][1], None), (305, rows[0][1][:8], 0), (306, [], 0), (307, rows[0][1], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    for tile in (2048, 8):
        out = vectors.near_vectors(df, tile=tile).collect()
        ok = [k for k, (i, e, lab) in enumerate(rows) if lab is not None and e and None not in e
              and np.isfinite(e).all() and any(e)]
        links = {k: set() for k in range(len(rows))}
        for a in ok:
            for b in ok:
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if a != b and rows[a][2] == rows[b][2] and len(x) == len(y):
                    if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                        links[a].add(b)
        want = []
        for k, (i, _, _) in enumerate(rows):
            seen, todo = {k}, [k]
            while todo:
                for b in links[todo.pop()] - seen:
                    seen.add(b)
                    todo.append(b)
            ids = [rows[b][0] for b in seen if rows[b][0] is not None]
            want.append((i, len(links[k]), min(ids, default=None), i is not None and i == min(ids)))
        assert sorted(map(str, (tuple(x) for x in out))) == sorted(map(str, want))
    assert vectors.near_vectors(df.limit(0)).count() == 0
