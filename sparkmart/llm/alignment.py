"""Cross-tokenizer alignment by interval coalescing (operator 12).

Every text is encoded by a byte-level BPE (A) and a sentence-piece BPE (B).  Tokens are intervals of
bytes.  All A and B tokens are sorted by start, the running maximum of their ends is taken, and a
group ends where a start reaches that maximum; within groups, overlapping pairs are expanded.

Corpus-wide counts of id pairs come from one dictionary per block of documents: a block sends each
of its distinct pairs once, however many links hold it, and gets the pair's count back.  So no
pair is hot, and nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tiktoken import Encoding

from sparkmart.llm.common import staged

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters encoded at once, and encoded characters behind a dictionary of pairs.
SLICE, BLOCK = 1 << 19, 1 << 23
#: Pairs of a dictionary in one row.
DICT_ROW = 1 << 16
#: A pair is ``a << 15 | b``.
B_BITS = 15
#: Where both encoders start a token: a blank between a letter or digit and a letter.
CUT = re.compile(r"(?<=[^\W_]) (?=[^\W\d_])")


#: How the first vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters about whose class (letter, number, blank) versions of Unicode might differ.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\u00a1-\u024f\u0391-\u03a1\u03a3-\u03c9\u0400-\u0481\u048a-\u052f"
                     r"\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")


def byte_values() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Both encoders with the bytes and the printed form of each of their ids."""

    def __init__(self, folder: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/{A_FILE}")
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
        value = byte_values()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = (bytes(value[c] for c in token) if all(c in value for c in token)
                               else token.encode())
        self.a_fast = self._by_ranks(json.loads(Path(folder, A_FILE).read_text()))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        if len(self.b_bytes) > 1 << B_BITS:
            raise ValueError(f"the second vocabulary has more than {1 << B_BITS} ids")
        self.a_len, self.b_len = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))
        both = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        #: Text of id i before a comma, a bar, a semicolon and at the end, at 4 * i + 0 ... 3.
        self.printed = [s + mark for s in both for mark in (",", "|", ";", "")]

    def _by_ranks(self, declared: dict) -> Encoding | None:
        """The first encoder over its own vocabulary, merging by rank, which is three times as fast.

        Ids must rise as the merges do.  Both then merge alike: tokens only grow, so the steps within
        what becomes one token are those of that token alone, whose last step is its merge.
        """
        vocab, merges = declared["model"]["vocab"], declared["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        made = [vocab["".join(pair)] for pair in pairs]
        special = {t["id"] for t in declared["added_tokens"]}
        plain = set(vocab.values()) - special
        if made != sorted(made) or len(made) + 256 != len(plain):
            return None
        ranks = {self.a_bytes[i]: i for i in plain}
        return Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of the first vocabulary; texts with unusual characters take its own splitter."""
        odd = [self.a_fast is None or UNUSUAL.search(t) is not None for t in texts]
        slow = iter(self.a.encode_batch_fast([t for t, o in zip(texts, odd) if o], add_special_tokens=False))
        return [next(slow).ids if o else self.a_fast.encode_ordinary(t) for t, o in zip(texts, odd)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of texts that start with the blank, and whether both give the text's bytes again."""
        a = self.encode_a(texts)
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        right = []
        for t, x, y in zip(texts, a, b):
            want = t.encode()
            right.append(b"".join(map(self.a_bytes.__getitem__, x)) == want
                         and b"".join(map(self.b_bytes.__getitem__, y)) == want)
        return a, b, right


_encoders: dict[str, Encoders] = {}


def encoders(folder: str) -> Encoders:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if folder not in _encoders:
        _encoders[folder] = Encoders(folder)
    return _encoders[folder]


def pieces(text: str, most: int = SLICE) -> list[str]:
    """``text`` with the blank before it, cut where both encoders start a token anyway.

    A text without such a place, like one of ideographs only, stays whole.
    """
    text, out, at = " " + text, [], 0
    while len(text) - at > most:
        cut = CUT.search(text, at + most)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def coalesce(start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of intervals by (group, kind, start), and the group of each, in that order.

    Sorted by start, an interval opens a group when it starts at or after all ends before it.
    """
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = start[order][1:] >= reach[:-1]
    group = np.cumsum(fresh) - 1
    within = np.lexsort((kind[order], group))
    return order[within], group[within]


def overlaps(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all overlapping pairs; both sides tile the same bytes in order."""
    lo = np.searchsorted(end_b, start_a, "right")
    n = np.searchsorted(start_b, end_a, "left") - lo
    i = np.repeat(np.arange(len(start_a)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


class Aligned:
    """Alignment of consecutive pieces of text: ids, groups and links, by piece."""

    def __init__(self, enc: Encoders, a: list[list[int]], b: list[list[int]]):
        self.n_a, self.n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b))
        self.a, self.b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
                          for ids, n in ((a, self.n_a), (b, self.n_b)))
        ends = [np.cumsum(size[ids]) for size, ids in ((enc.a_len, self.a), (enc.b_len, self.b))]
        self.end_a, self.end_b = ends
        self.start_a, self.start_b = (np.r_[0, e[:-1]] if len(e) else e for e in ends)
        kind = np.repeat(np.array([0, 1], np.int8), (len(self.a), len(self.b)))
        self.order, self.group = coalesce(np.r_[self.start_a, self.start_b], np.r_[self.end_a, self.end_b], kind)
        self.kind = kind[self.order]
        self.id = np.r_[self.a, self.b][self.order]
        self.cuts = np.r_[0, np.cumsum(self.n_a + self.n_b)]
        i, j = overlaps(self.start_a, self.end_a, self.start_b, self.end_b)
        self.pair = self.a[i] << B_BITS | self.b[j]
        self.piece = np.repeat(np.arange(len(a)), self.n_a)[i]
        first = np.ones(len(self.group), bool)
        first[1:] = self.group[1:] != self.group[:-1]
        self.n_groups = np.bincount(np.repeat(np.arange(len(a)), np.diff(self.cuts))[first], minlength=len(a))

    def printed(self, enc: Encoders) -> list[str]:
        """Each piece's groups as ``a1,a2|b1;a3|b2``."""
        mark = np.zeros(len(self.id), np.int64)
        if len(self.id):
            mark[:-1][self.kind[1:] != self.kind[:-1]] = 1
            mark[:-1][self.group[1:] != self.group[:-1]] = 2
            mark[self.cuts[1:][np.diff(self.cuts) > 0] - 1] = 3
        words = list(map(enc.printed.__getitem__, (self.id * 4 + mark).tolist()))
        return ["".join(words[s:e]) for s, e in zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist())]


def _counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys`` in order with the sums of ``n``."""
    found, where, count = np.unique(keys, return_inverse=True, return_counts=True)
    return (found, count) if n is None else (found, np.bincount(where, n, len(found)).astype(np.int64))


class _Document:
    """Running results of a document whose pieces come one by one."""

    def __init__(self):
        self.right, self.counts, self.digest = True, np.zeros(4, np.int64), hashlib.sha256()
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, right: bool, counts: np.ndarray, printed: str, pairs: np.ndarray) -> None:
        self.right = self.right and right
        if self.right:
            self.digest.update((";" if self.counts[0] else "").encode() + printed.encode())
            self.counts += counts
            self.pairs.append(_counted(pairs))

    def result(self) -> tuple:
        if not self.right or not self.counts[0]:
            return (0, 0, 0, 0), "", np.empty(0, np.int64), np.empty(0, np.int64)
        keys, n = (np.concatenate(x) for x in zip(*self.pairs))
        return (*self.counts.tolist(),), self.digest.hexdigest(), *(
            _counted(keys, n) if len(self.pairs) > 1 else (keys, n))


def _slices(texts: Iterator[tuple[object, str | None]], most: int) -> Iterator[list[tuple[object, str, bool]]]:
    """Runs of (id, piece, last piece of the document) of about ``most`` characters."""
    run, size = [], 0
    for key, text in texts:
        parts = pieces(text, most) if text else [""]
        for k, part in enumerate(parts):
            run.append((key, part, k == len(parts) - 1))
            size += len(part)
            if size >= most:
                yield run
                run, size = [], 0
    if run:
        yield run


OUT = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("row", T.BooleanType()), T.StructField("_id", T.LongType()),
    *(T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")),
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("keys", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.IntegerType())),
])
ARROW = pa.schema([
    ("block", pa.int64()), ("row", pa.bool_()), ("_id", pa.int64()),
    *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
    ("keys", pa.list_(pa.int32())), ("n", pa.list_(pa.int32())),
])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(x) for x in arrays])].astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(offsets, flat.astype(np.int32))


def _batch(block: int, rows: list[tuple], is_row: bool) -> pa.RecordBatch:
    """Rows (id, counts, digest, keys, n); the keys of a document's pairs are stored as differences."""
    ids, counts, digests, keys, n = zip(*rows)
    columns = [pa.array([block] * len(rows), pa.int64()), pa.array([is_row] * len(rows)), pa.array(ids, pa.int64()),
               *(pa.array(c, pa.int64()) for c in zip(*counts)), pa.array(digests, pa.string()),
               _lists([np.diff(k, prepend=0) for k in keys] if is_row else list(keys)), _lists(list(n))]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW)


def _scan(folder: str, most: int, per_block: int):
    """Task: encode and align texts (id, text); returns documents, then each block's dictionary."""
    def dictionary(block: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, n = _counted(*(np.concatenate(x) for x in zip(*pairs)))
        for i in range(0, len(keys), DICT_ROW):
            yield _batch(block, [(None, (None,) * 4, None, keys[i:i + DICT_ROW], n[i:i + DICT_ROW])], False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoders(folder)
        block, size, pairs, doc = TaskContext.get().partitionId() << 32, 0, [], _Document()
        texts = ((k.as_py(), t.as_py()) for batch in batches for k, t in zip(batch.column(0), batch.column(1)))
        for run_ in _slices(texts, most):
            a, b, right = enc.encode([p for _, p, _ in run_])
            got = Aligned(enc, [x if ok else [] for x, ok in zip(a, right)], [x if ok else [] for x, ok in zip(b, right)])
            printed, links = got.printed(enc), np.searchsorted(got.piece, np.arange(len(run_) + 1))
            counts = np.stack([got.n_a, got.n_b, got.n_groups, np.diff(links)], 1)
            done = []
            for k, (key, _, last) in enumerate(run_):
                doc.add(right[k], counts[k], printed[k], got.pair[links[k]:links[k + 1]])
                if last:
                    done.append((key, *doc.result()))
                    doc = _Document()
            if done:
                yield _batch(block, done, True)
                pairs.append(_counted(*(np.concatenate(x) for x in zip(*((d[3], d[4]) for d in done)))))
            size += sum(len(p) for _, p, _ in run_)
            if size >= per_block and done and run_[-1][2]:
                yield from dictionary(block, pairs)
                block, size, pairs = block + 1, 0, []
        if pairs:
            yield from dictionary(block, pairs)
    return run


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows of a block, its dictionary first; adds up counts and best links by document."""
    block, parts, keys, count, best = None, [], None, None, None
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
            at, is_row = row[0].as_py(), row[1].as_py()
            if at != block:
                block, parts, keys = at, [], None
            if not is_row:
                parts.append([np.asarray(row[i].values) for i in (9, 10, 11)])
                continue
            if keys is None:
                keys, count, best = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 3
                order = np.argsort(keys)
                keys, count, best = keys[order], count[order], best[order]
            pair, n = np.cumsum(np.asarray(row[8].values)), np.asarray(row[7].values).astype(np.int64)
            where = np.searchsorted(keys, pair)
            out.append((*(row[i].as_py() for i in range(2, 7)), row[12].as_py(),
                        int((n * best[where]).sum()), int((n * count[where]).sum())))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), SCORED.types)], schema=SCORED)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
SCORED = pa.schema([("_id", pa.int64()), *((n, pa.int64()) for n in COUNTS), ("groups_sha256", pa.string()),
                    ("n_best", pa.int64()), ("count_sum", pa.int64())])


def pair_counts(scanned: DataFrame) -> DataFrame:
    """(key, count, best): links of each id pair in the corpus, and whether its B id has none higher."""
    pairs = scanned.filter("not row").select(F.explode(F.arrays_zip("keys", "n")).alias("p"))
    count = pairs.groupBy(F.col("p.keys").alias("key")).agg(F.sum(F.col("p.n").cast("bigint")).alias("count"))
    count = count.withColumn("b", F.col("key").bitwiseAND((1 << B_BITS) - 1))
    most = count.groupBy("b").agg(F.max("count").alias("most"))
    return count.join(most, "b").select("key", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = FOLDER,
                    slice_chars: int = SLICE, block_chars: int = BLOCK) -> DataFrame:
    """One row per document: sizes of its alignment, scores of its links, digest of its groups.

    Columns ``doc_id``, n_a, n_b, n_groups, n_links, n_best, count_sum (bigint) and groups_sha256;
    other columns of ``docs``, whatever their names, are not read.  ``doc_id`` must be a bigint; it may
    be NULL or repeat, and each row counts.  NULL and empty texts, and texts that an encoder doesn't
    give back byte for byte, have no tokens: zeros and ''.  Long texts are encoded in pieces cut where
    both encoders start a token; one without any such place is encoded whole.  Links that tie for a
    B id's highest count are all best.  An empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("_id"), F.col(f"`{text}`").alias("_text"))
    scanned = staged(rows.mapInArrow(_scan(folder, slice_chars, block_chars), OUT))
    counts = pair_counts(scanned)
    asked = scanned.filter("not row").select("block", F.explode("keys").alias("key"))
    told = (asked.join(counts, "key").groupBy("block", (F.col("key") % 64).alias("_part"))
            .agg(F.collect_list(F.struct("key", "count", "best")).alias("p"))
            .select("block", F.lit(False).alias("row"), *(F.col(f"p.{c}").alias(f"d_{c}") for c in ("key", "count", "best"))))
    kept = scanned.filter("row").select("block", "row", "_id", *COUNTS, F.col("n").alias("m"), "keys", "groups_sha256")
    scored = kept.unionByName(told, allowMissingColumns=True).select(
        "block", "row", "_id", *COUNTS, "m", "keys", "d_key", "d_count", "d_best", "groups_sha256")
    scored = scored.repartition(F.col("block")).sortWithinPartitions("block", "row")
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "groups_sha256" else T.LongType())
                           for f in SCORED])
    out = scored.mapInArrow(_score, schema)
    return out.select(F.col("_id").alias(doc_id), *COUNTS, "n_best", "count_sum", "groups_sha256")


def alignments(docs: DataFrame, text: str = "text", folder: str = FOLDER) -> DataFrame:
    """``docs`` with column ``alignment``: its groups as array of (a_ids, b_ids, start, end) in bytes.

    The offsets are those of the text with a blank before it.  Texts without tokens get an empty
    array.  A column called ``alignment`` is replaced; all others stay.
    """
    kind = "array<struct<a_ids:array<int>,b_ids:array<int>,start:bigint,`end`:bigint>>"

    @F.pandas_udf(kind)
    def groups(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoders(folder)
        for column in texts:
            yield pd.Series([_groups(enc, t) for t in column])

    return docs.withColumn("alignment", groups(F.col(f"`{text}`")))


def _groups(enc: Encoders, text: str | None) -> list[dict]:
    if not text:
        return []
    a, b, right = enc.encode(pieces(text))
    if not all(right):
        return []
    got = Aligned(enc, [[i for x in a for i in x]], [[i for x in b for i in x]])
    starts = np.r_[got.start_a, got.start_b][got.order]
    ends = np.r_[got.end_a, got.end_b][got.order]
    first = np.flatnonzero(np.r_[True, got.group[1:] != got.group[:-1]])
    out = []
    for s, e in zip(first, np.r_[first[1:], len(got.group)]):
        is_b = got.kind[s:e] == 1
        ids = got.id[s:e]
        out.append({"a_ids": ids[~is_b].tolist(), "b_ids": ids[is_b].tolist(),
                    "start": int(starts[s:e].min()), "end": int(ends[s:e].max())})
    return out
