"""Benchmark decontamination by greedy string tiling (operator 9).

Documents and benchmark items that share a five-word seed are joined.  In each such pair the
longest common word runs are marked again and again, without overlap on either side, until none
of five words is left (greedy string tiling with running Karp-Rabin hashes).  The share of the
item's words that are marked says how much of it the document holds, in whatever order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import free_name, in_small_batches, quoted, row_slices, staged, text_buffer
from sparkmart.llm.hashing import range_hash, words

SEED, COVERAGE = 5, 0.5
#: A benchmark of at most this many items and bytes is sent to all tasks; a larger one is joined.
SMALL_ITEMS, SMALL_BYTES = 20_000, 8 << 20
RESULT = "n_tiles int, matched_words bigint, item_words bigint, coverage double"


def _runs(h: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of all runs of ``size`` words without a marked word."""
    if len(h) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    used = np.r_[0, np.cumsum(~free)]
    at = np.flatnonzero(used[size:] == used[:-size])
    return range_hash(h, at, at + size), at


def tiles(doc: np.ndarray, item: np.ndarray, seed: int = SEED) -> list[tuple[int, int, int]]:
    """(start in doc, start in item, length) of greedy tiles of at least ``seed`` words.

    Longest matches first; of equally long ones the first in the document, then in the item.  An
    item with fewer words is one seed.  Both are arrays of word hashes.
    """
    seed = min(seed, len(item))
    if not seed:
        return []
    free_d, free_i, out = np.ones(len(doc), bool), np.ones(len(item), bool), []

    def matches(size: int):
        hi, at_i = _runs(item, free_i, size)
        hd, at_d = _runs(doc, free_d, size)
        keep = np.isin(hd, hi)
        return hi, at_i, hd[keep], at_d[keep]

    top = seed
    while len(matches(top)[2]):  # the longest match: double, then halve the gap
        top *= 2
    low, high = (top // 2, top) if top > seed else (0, 0)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if len(matches(mid)[2]) else (low, mid)
    size = low
    while size >= seed:
        hi, at_i, hd, at_d = matches(size)
        where: dict[int, list[int]] = {}
        for h, p in zip(hi.tolist(), at_i.tolist(), strict=True):
            where.setdefault(h, []).append(p)
        for h, p in zip(hd.tolist(), at_d.tolist(), strict=True):
            if not free_d[p:p + size].all():
                continue
            for q in where[h]:
                if free_i[q:q + size].all():
                    free_d[p:p + size] = free_i[q:q + size] = False
                    out.append((p, q, size))
                    break
        size -= 1
        while size >= seed and not len(matches(size)[2]):
            size -= 1
    return out


def _compare(doc: np.ndarray, item: np.ndarray, seeds: np.ndarray, seed: int):
    """Tiles of the part of ``doc`` that its seeds (first words in ``doc``) can reach."""
    near = np.zeros(len(doc) + 1, np.int64)
    np.add.at(near, seeds, 1)
    np.add.at(near, np.minimum(seeds + min(seed, len(item)), len(doc)), -1)
    inside = np.cumsum(near[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    parts = []
    for k, (a, b) in enumerate(zip(edge[::2], edge[1::2], strict=True)):
        parts += [doc[a:b], np.array([k + 1], np.uint64)]  # no match runs over a gap
    found = tiles(np.concatenate(parts), item, seed)
    matched = sum(n for *_, n in found)
    return len(found), matched, len(item), matched / len(item)


def _seeds(h: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    size = min(seed, len(h))
    return _runs(h, np.ones(len(h), bool), size) if size else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _word_hashes(texts) -> list[np.ndarray]:
    buf, offs = text_buffer(pa.array(texts, pa.string()))
    w = words(buf, offs)
    return [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]


def _tile_against(items: list[np.ndarray], ids: pa.Array, seed: int, coverage: float):
    """Matches of all documents with a benchmark that every task holds."""
    own = [_seeds(h, seed)[0] for h in items]
    size = np.array([min(seed, len(h)) for h in items])
    tables = {}
    for n in sorted(set(size.tolist()) - {0}):
        h = np.concatenate([own[i] for i in np.flatnonzero(size == n)])
        of = np.concatenate([np.full(len(own[i]), i) for i in np.flatnonzero(size == n)])
        order = np.argsort(h, kind="stable")
        tables[n] = (h[order], of[order])

    def hits(w, n: int):
        """(word, item) of every run of n words that is a seed of an item."""
        known, of = tables[n]
        left = np.repeat(w.first[1:], np.diff(w.first)) - np.arange(len(w.hash))
        at = np.flatnonzero(left >= n)
        h = range_hash(w.hash, at, at + n)
        lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
        k = np.flatnonzero(hi > lo)
        many = hi[k] - lo[k]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at[k], many), of[np.repeat(lo[k], many) + step]

    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column("text"))
            rows, found, results = [], [], []
            for lo, hi in row_slices(offs, 2 << 20):
                w = words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                pairs = [hits(w, n) for n in tables]
                if not pairs:
                    continue
                at, item = (np.concatenate(x) for x in zip(*pairs, strict=True))
                row = w.row[at]
                order = np.lexsort((at, item, row))
                at, item, row = at[order], item[order], row[order]
                cut = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]), True])
                for a, b in zip(cut[:-1], cut[1:], strict=True) if len(at) else ():
                    r, i = int(row[a]), int(item[a])
                    first, last = w.first[r], w.first[r + 1]
                    result = _compare(w.hash[first:last], items[i], at[a:b] - first, seed)
                    if result[3] >= coverage:
                        rows.append(lo + r)
                        found.append(i)
                        results.append(result)
            yield _matches(batch, rows, ids.take(pa.array(found, pa.int64())), results)
    return run


def _matches(batch, rows, item_ids, results):
    take = pa.array(rows, pa.int64())
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(take), batch.column("_rid").take(take), item_ids,
         *[pa.array([r[k] for r in results], kind) for k, kind in enumerate(kinds)]],
        names=["doc_id", "_rid", "item_id", "n_tiles", "matched_words", "item_words", "coverage"])


def _item_seeds(seed: int):
    """(h, _item, copies, words): the distinct seeds of each item and how often it has them."""
    def run(batches):
        for batch in batches:
            out = []
            for key, h in zip(batch.column("_item").to_pylist(), _word_hashes(batch.column("text").to_pylist())):
                found, copies = np.unique(_seeds(h, seed)[0], return_counts=True)
                out += [(x, key, n, len(h)) for x, n in zip(found.view(np.int64).tolist(), copies.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=["h", "_item", "copies", "words"])
    return run


def _doc_seeds(sizes: list[int]):
    """(h, _rid): the distinct runs of each row, of the lengths that items' seeds have."""
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column("text"))
            rid = batch.column("_rid").to_numpy()
            for lo, hi in row_slices(offs, 2 << 20):
                w = words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                left = np.repeat(w.first[1:], np.diff(w.first)) - np.arange(len(w.hash))
                for n in sizes:
                    at = np.flatnonzero(left >= n)
                    pair = np.stack([w.row[at].astype(np.uint64), range_hash(w.hash, at, at + n)], 1)
                    order = np.lexsort((pair[:, 1], pair[:, 0]))
                    pair = pair[order]
                    pair = pair[np.r_[True, (pair[1:] != pair[:-1]).any(1)]] if len(pair) else pair
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(pair[:, 1]).view(np.int64)),
                         pa.array(rid[lo + pair[:, 0].astype(np.int64)])], names=["h", "_rid"])
    return run


def _tile_lists(seed: int, coverage: float):
    """Matches of each document with the items in its list."""
    def run(batches):
        for batch in batches:
            rows, results, ids = [], [], []
            docs = _word_hashes(batch.column("text").to_pylist())
            for k, (doc, listed) in enumerate(zip(docs, batch.column("items").to_pylist(), strict=True)):
                for one, item in zip(listed, _word_hashes([x["text"] for x in listed]), strict=True):
                    h, at = _runs(doc, np.ones(len(doc), bool), max(1, min(seed, len(item))))
                    at = at[np.isin(h, _seeds(item, seed)[0])]
                    result = _compare(doc, item, at, seed) if len(at) else (0, 0, len(item), 0.0)
                    if result[3] >= coverage and result[1]:
                        rows.append(k)
                        ids.append(one["item_id"])
                        results.append(result)
            kind = batch.schema.field("items").type.value_type.field("item_id").type
            yield _matches(batch, rows, pa.array(ids, kind), results)
    return run


def candidate_pairs(rows: DataFrame, items: DataFrame, seed: int, coverage: float) -> DataFrame:
    """(_rid, _item) of documents and items that may share enough words, by a join of their seeds.

    A document that holds ``coverage`` of an item's W words in tiles of ``seed`` words or more has at
    least ``coverage * W / seed`` of its places where a seed begins.  So an item need not be joined on as
    many of its places less one, and those with the most frequent seeds are left out: no pair is
    lost, and a phrase that very many documents share joins only the items that consist of it.
    """
    of_items = staged(items.select("_item", "text").mapInArrow(_item_seeds(seed), "h bigint, _item bigint, copies bigint, words bigint"))
    sizes = [r[0] for r in of_items.select(F.least("words", F.lit(seed))).distinct().collect()]  # at most ``seed``
    known = of_items.select("h").distinct()
    found = staged(rows.mapInArrow(_doc_seeds(sizes), "h bigint, _rid bigint").join(known, "h", "left_semi"))
    frequent = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    spare = F.greatest(F.ceil(F.col("words") * coverage / seed) - 1, F.lit(0))
    order = Window.partitionBy("_item").orderBy(F.desc("n"), "h").rowsBetween(Window.unboundedPreceding, 0)
    kept = (of_items.join(frequent, "h").withColumn("places", F.sum("copies").over(order))
            .filter(F.col("places") > spare).select("h", "_item"))
    return found.join(kept, "h").select("_rid", "_item").distinct()


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, seed: int = SEED,
                       coverage: float = COVERAGE, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """doc_id, _rid, item_id, n_tiles, matched_words, item_words, coverage of pairs at or above
    ``coverage``; ``_rid`` tells rows with equal doc_id apart.

    Words compare with ASCII letters in lower case.  NULL and empty texts and items match nothing;
    repeated rows and items are compared each for itself; other columns are ignored.  The
    benchmark's size is measured: up to 20,000 items and ``small_bytes`` it goes to every task
    and documents aren't shuffled; beyond that seeds are joined, see ``candidate_pairs``, and each
    document's text then meets the list of its items once.
    """
    doc_type, item_type = (df.schema[c].dataType.simpleString()
                           for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    out = f"doc_id {doc_type}, _rid bigint, item_id {item_type}, {RESULT}"
    rows = in_small_batches(docs.select("doc_id", "text")).withColumn(
        "_rid", F.monotonically_increasing_id())
    items = benchmark.select("item_id", "text").filter("text is not null")
    n, size = items.limit(SMALL_ITEMS + 1).agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    if n <= SMALL_ITEMS and (size or 0) <= small_bytes:
        held = items.toArrow()
        ids = held.column("item_id").combine_chunks()
        hashes = _word_hashes(held.column("text").to_pylist())
        return rows.mapInArrow(_tile_against(hashes, ids, seed, coverage), out)
    items = staged(items.withColumn("_item", F.monotonically_increasing_id()))
    pairs = candidate_pairs(rows, items, seed, coverage)
    lists = pairs.join(items, "_item").groupBy("_rid").agg(F.collect_list(F.struct("item_id", "text")).alias("items"))
    return rows.join(lists, "_rid").select("doc_id", "_rid", "text", "items").mapInArrow(_tile_lists(seed, coverage), out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, seed: int = SEED,
                  coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that hold at least ``coverage`` of an item; all columns kept.

    ``docs`` must be a table that reads the same twice, rows included.  Columns may have any names;
    ``doc_id`` may be NULL or repeat, as rows are told apart by their number.
    """
    rid = free_name("_rid", docs)
    bad = contaminated_pairs(docs, benchmark, seed, coverage).select(F.col("_rid").alias(rid)).distinct()
    rows = docs.withColumn(rid, F.monotonically_increasing_id())
    return rows.join(bad, rid, "left_anti").select(*quoted(docs.columns))
