"""Cross-tokenizer alignment against plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import alignment
from sparkmart.llm.alignment import FOLDER, align_documents, alignments, pieces

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [None, "", " ", "  two  blanks ", "one", "The cat sat on the mat, didn't it?\n\n\tYes.", "a▁b", "<s> </s> <unk> <0x41>",
         "<|endoftext|> is text", "é ü ñ 漢字 🙂​ x", "\x00\x01", "x" * 500, "The cat sat on the mat.",
         "The cat sat on the mat.", "1234567 89", "漢" * 400, "ﬁ ² Ⅷ"]


def ends(ids, value):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(value[i])))
        at = out[-1][1]
    return out


def expected(rows):
    enc = alignment.Encoders(FOLDER)
    links, base, total = [], [], Counter()
    for _, text in rows:
        a = enc.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = enc.b.encode(text) if text else []
        want = (" " + text).encode() if text else b""
        if any(b"".join(v[i] for i in ids) != want for v, ids in ((enc.a_bytes, a), (enc.b_bytes, b))):
            a, b = [], []
        ea, eb = ends(a, enc.a_bytes), ends(b, enc.b_bytes)
        mine, low = [], 0
        for i, (s, e) in zip(a, ea):
            while low < len(eb) and eb[low][1] <= s:
                low += 1
            j = low
            while j < len(eb) and eb[j][0] < e:
                mine.append((i, b[j]))
                j += 1
        groups, ia, ib = [], 0, 0
        for cut in sorted({e for _, e in ea} & {e for _, e in eb}):
            ja = next(k for k in range(ia, len(a)) if ea[k][1] == cut) + 1
            jb = next(k for k in range(ib, len(b)) if eb[k][1] == cut) + 1
            groups.append(",".join(map(str, a[ia:ja])) + "|" + ",".join(map(str, b[ib:jb])))
            ia, ib = ja, jb
        links.append(mine)
        total.update(mine)
        base.append((len(a), len(b), len(groups), len(mine),
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    return Counter((key, *x[:4], sum(total[p] == most[p[1]] for p in mine), sum(total[p] for p in mine), x[4])
                   for (key, _), mine, x in zip(rows, links, base))


def found(frame):
    return Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in frame.collect())


@pytest.mark.parametrize("sizes", [{}, {"slice_chars": 40, "block_chars": 100}])
def test_alignment_equals_plain_loops(spark, sizes):
    rows = [(None if i % 6 == 5 else i // 2, t) for i, t in enumerate(TEXTS + TEXTS[5:8])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("_id", "_text", "block", "keys", "row", "a.b"):
        frame = frame.withColumn(name, F.lit("z"))
    assert found(align_documents(frame, **sizes)) == expected(rows)


def test_whole_table_and_long_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    assert found(align_documents(table, block_chars=50_000)) == expected(rows)
    rows = [(1, " ".join(t for _, t in rows if t) + " " + "z" * 100_000)]
    assert len(rows[0][1]) > alignment.SLICE / 4
    assert found(align_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), slice_chars=10_000)) == expected(rows)


def test_empty_table(spark):
    assert not found(align_documents(spark.createDataFrame([], "doc_id bigint, text string")))


def test_pieces_are_encoded_like_the_whole():
    enc = alignment.Encoders(FOLDER)
    text = "It's 3 o'clock, né?  Two  blanks\n\nand a b c. " * 30
    parts = pieces(text, 50)
    assert "".join(parts) == " " + text and len(parts) > 10
    a, b, right = enc.encode(parts)
    whole_a, whole_b, _ = enc.encode([" " + text])
    assert all(right) and sum(a, []) == whole_a[0] and sum(b, []) == whole_b[0]
    assert pieces("漢" * 100, 10) == [" " + "漢" * 100]


def test_groups_of_a_text(spark):
    frame = spark.createDataFrame([(1, "Unbelievable é 漢"), (2, None), (3, "")], "doc_id bigint, text string").withColumn("a.b", F.lit(1))
    out = {r["doc_id"]: r["alignment"] for r in alignments(frame).collect()}
    assert out[2] == out[3] == []
    text, enc, at = " Unbelievable é 漢".encode(), alignment.Encoders(FOLDER), 0
    for g in out[1]:
        assert g["start"] == at
        at = g["end"]
        for ids, value in ((g["a_ids"], enc.a_bytes), (g["b_ids"], enc.b_bytes)):
            assert b"".join(value[i] for i in ids) == text[g["start"]:at]
    assert at == len(text)


def test_merging_by_rank_gives_the_ids_of_the_file(spark):
    """Every token alone, texts of the tables, and random strings of usual characters."""
    enc = alignment.Encoders(FOLDER)
    assert enc.a_fast is not None
    r = random.Random(4)
    usual = [c for c in map(chr, [*range(9, 0x530), *range(0x3041, 0x30FB), *range(0x4E00, 0x4F00), *range(0xAC00, 0xAD00)])
             if not alignment.UNUSUAL.search(c)]
    few = list("aeinorst'  \n\n.,1dlmvs")
    texts = ["".join(r.choices(r.choice([usual, few]), k=r.randint(1, 60))) for _ in range(20_000)]
    texts += [t.decode() for t in enc.a_bytes if t.isascii() and not alignment.UNUSUAL.search(t.decode())]
    texts += [t for (t,) in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if t]
    assert not any(alignment.UNUSUAL.search(t) for t in texts[:20_000])
    slow = [e.ids for e in enc.a.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode_a(texts) == slow
