"""Embedding near-dedup by collision-counting projections (operator 1).

Vectors of unit length are projected on many directions, and cells of several projections select
what is compared at all:

1. A table's cells are the signs of some projections, that is, the two half-lines each projection's
   values are sorted into.  Vectors that share a cell of any table are counted: of all projections
   of all tables, on how many they lie on the same side.  Pairs that agree on as many as pairs at
   the threshold do are candidates.  Cells and count are calibrated for a recall of ``1 - MISS``.
2. Candidates' connected components are formed, so a vector is sent on once, whatever it met.
3. Within a component and label all pairs are counted by query-centred windows: two vectors collide
   in a projection when one lies in the window around the other's value.  The squared projected
   differences of a pair add up to its squared distance, so a pair within the threshold can miss at
   most ``distance**2 / window**2`` of the windows: no pair is lost here.  The rest is verified.

Cells and components with many vectors are cut into tiles of bounded size, and each pair of tiles
is a task's work.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.common import staged
from sparkmart.llm.components import components

THRESHOLD, TILE = 0.98, 2048
#: Of the squared distance, the share a window may cover in one projection: at most a quarter of
#: the projections can then be missed.
MISSES = 0.25
#: Pairs at the threshold that no table's cell brings together, by calculation, and vectors of a
#: label that one cell should hold.
MISS, PER_CELL = 1e-6, 512


def rotation(n: int, seed: int = 11) -> np.ndarray:
    """``n`` orthonormal directions, the same for all tasks."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def tables(most: int, threshold: float) -> tuple[int, int, int]:
    """(signs of a table's cells, tables, signs two vectors may differ in) for ``most`` vectors a label.

    Two vectors at the angle of the threshold lie on the same side of a projection with probability
    ``1 - angle / pi``.  The signs a pair differs in are let go eight deviations beyond their mean.
    """
    differ = math.acos(min(1.0, threshold)) / math.pi + 1e-9
    signs = max(9, math.ceil(math.log2(max(1, most / PER_CELL))))
    met = (1 - differ) ** signs
    n = math.ceil(math.log(MISS) / math.log(1 - met)) if met < 1 else 1
    size = signs * n
    return signs, n, math.ceil(size * differ + 8 * math.sqrt(size * differ * (1 - differ)))


def _signs(signs: int, n: int):
    """Task: (rep, label, keys of its cells, all signs) of each vector."""
    size = signs * n
    weight = 1 << np.arange(signs)

    def run(batches):
        for pdf in batches:
            bits = np.zeros((len(pdf), size), bool)
            lengths = pdf["embedding"].map(len).to_numpy()
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x = np.array(pdf["embedding"].iloc[at].tolist(), dtype=float)
                x /= np.abs(x).max(1)[:, None]
                turns = np.concatenate([rotation(int(d), 11 + k) for k in range(-(-size // int(d)))], axis=1)
                bits[at] = x @ turns[:, :size] > 0
            packed = np.packbits(np.pad(bits, ((0, 0), (0, -size % 64))), axis=1)
            yield pd.DataFrame({
                "rep": pdf["rep"], "label": pdf["label"],
                "keys": (bits.reshape(len(pdf), n, signs) @ weight).astype(np.int32).tolist(),
                "signs": [row.tobytes() for row in packed]})
    return run


def in_jobs(rows: DataFrame, cell: str, tile: int, by: str) -> DataFrame:
    """``rows`` with ``job`` and ``side``: a job is a cell, or a pair of tiles of one that has many rows.

    Tiles are dealt out by the column ``by``.  Side 2 is a tile with itself, 0 and 1 are the two tiles of
    a pair.  Only rows of cells with more than ``tile`` rows are repeated, once per tile.
    """
    large = rows.groupBy(cell).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > tile).select(
        F.col(cell).alias("_cell"), F.ceil(F.col("_n") / tile).cast("int").alias("_tiles"))
    cut = rows.join(large, F.col(cell).eqNullSafe(F.col("_cell")), "left")
    own = F.pmod(F.xxhash64(by), F.col("_tiles")).cast("int")
    cut = cut.withColumn("_own", own).withColumn("_other", F.explode(
        F.when(F.col("_tiles").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("_tiles") - 1))))
    side = F.when(F.col("_own").isNull() | (F.col("_own") == F.col("_other")), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    return cut.withColumns({"job": F.xxhash64(cell, F.least("_own", "_other"), F.greatest("_own", "_other")), "side": side}).drop(
        "_cell", "_tiles", "_own", "_other")


def linked(signs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (i, j) of a forest over the rows of words that differ in at most ``most`` bits."""
    n = len(signs)
    if n <= 64:
        apart = np.bitwise_count(signs[:, None] ^ signs[None]).sum(2, dtype=np.int32)
        i, j = np.nonzero(np.triu(apart <= most, 1))
        if len(i) < n:
            return i, j
    left, out = np.arange(n), []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            v = todo.pop()
            near = np.bitwise_count(signs[left] ^ signs[v]).sum(1, dtype=np.int32) <= most
            hit, left = left[near], left[~near]
            out.append(np.stack([np.full(len(hit), v), hit]))
            todo.extend(hit.tolist())
    return tuple(np.concatenate(out, axis=1)) if out else (np.empty(0, int),) * 2


def _meet(most: int):
    """Task: rows (job, rep, signs) sorted by job; returns a forest (a, b) of each job's candidates."""
    def edges(job, rep, signs):
        cut = np.flatnonzero(np.r_[True, job[1:] != job[:-1], True])
        found = []
        for k in np.flatnonzero(np.diff(cut) > 1):
            own = slice(cut[k], cut[k + 1])
            i, j = linked(signs[own], most)
            if len(i):
                found.append(np.stack([rep[own][i], rep[own][j]]))
        a, b = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            job, rep = (batch.column(k).to_numpy() for k in (0, 1))
            signs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(len(job), -1)
            held.append((job, rep, signs))
            if job[0] == job[-1]:
                continue  # one job so far
            job, rep, signs = (np.concatenate(x) for x in zip(*held))
            last = int(np.searchsorted(job, job[-1]))  # the last job may go on
            yield edges(job[:last], rep[:last], signs[:last])
            held = [(job[last:], rep[last:], signs[last:])]
        if held:
            yield edges(*(np.concatenate(x) for x in zip(*held)))
    return run


def _candidates(p: np.ndarray, q: np.ndarray, window: float, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of p, row of q) that collide in at least ``need`` projections.

    The values of each projection are sorted once; every query's window is then a stretch of
    them, and adds one to the counts of its query's row.  Queries go in blocks, so the counts
    take a few MB.
    """
    dims = p.shape[1]
    order = np.argsort(q, axis=0)
    line = np.take_along_axis(q, order, 0)
    rank = np.argsort(order, axis=0).astype(np.int32)
    found = []
    for a in range(0, len(p), 256):
        part = p[a:a + 256]
        count = np.zeros((len(part), len(q)), np.int16)
        for k in range(dims):
            lo = np.searchsorted(line[:, k], part[:, k] - window, "left")
            hi = np.searchsorted(line[:, k], part[:, k] + window, "right")
            r = rank[:, k]
            count += (r >= lo[:, None]) & (r < hi[:, None])
            if k >= dims - need and k % 8 == 7:  # rows that can't reach the count any more
                alive = count >= need - (dims - 1 - k)
                if not alive.any():
                    break
        i, j = np.nonzero(count >= need)
        found.append(np.stack([i + a, j]))
    return tuple(np.concatenate(found, axis=1)) if found else (np.empty(0, int),) * 2


def _link_tiles(threshold: float):
    distance = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9) + 1e-9

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        same = bool((pdf["side"] == 2).any())  # a tile with itself
        left, right = (pdf, pdf) if same else (pdf[pdf["side"] == 0], pdf[pdf["side"] == 1])
        rows = []
        if len(left) and len(right):
            x, y = (np.array(s["embedding"].tolist(), dtype=float) for s in (left, right))
            dims = x.shape[1]
            nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            turn = rotation(dims)
            misses = max(1, int(MISSES * dims))
            window = distance / np.sqrt(misses)
            i, j = _candidates((x / nx[:, None]) @ turn, (y / ny[:, None]) @ turn, window * (1 + 1e-9), dims - misses)
            if same:
                i, j = i[i < j], j[i < j]
            for a in range(0, len(i), 65536):
                u, v = i[a:a + 65536], j[a:a + 65536]
                ok = np.einsum("ij,ij->i", x[u], y[v]) / (nx[u] * ny[v]) >= threshold
                rows.append(np.stack([left["rep"].to_numpy()[u[ok]], right["rep"].to_numpy()[v[ok]],
                                      left["copies"].to_numpy()[u[ok]], right["copies"].to_numpy()[v[ok]]], axis=1))
        pairs = np.concatenate(rows) if rows else np.empty((0, 4), np.int64)
        # per vector the number of links, and per tile pair a forest instead of all its links
        ids = np.r_[pairs[:, 0], pairs[:, 1]]
        counts = pd.DataFrame({"rep": ids, "n": np.r_[pairs[:, 3], pairs[:, 2]]}).groupby("rep")["n"].sum()
        a, b = _forest(pairs[:, 0], pairs[:, 1])
        return pd.concat([
            pd.DataFrame({"a": counts.index.to_numpy(np.int64), "b": np.nan, "n": counts.to_numpy()}),
            pd.DataFrame({"a": a, "b": b, "n": 0})]).astype({"a": "int64", "b": "Int64", "n": "int64"})
    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    out = ([], [])
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            out[0].append(x)
            out[1].append(y)
    return out


def candidates(classes: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(rep, root): vectors of ``classes`` (rep, label, embedding) that candidates connect.

    ``label`` tells embeddings of other labels and lengths apart.  Each vector goes to one cell per
    table, as a few dozen bytes; a cell's answer is a forest, so many alike vectors bring no pairs.
    """
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs, n, differ = tables(most, threshold)
    placed = classes.select("rep", "label", "embedding").mapInPandas(
        _signs(signs, n), "rep bigint, label string, keys array<int>, signs binary")
    cells = staged(placed.select("rep", "label", "signs", F.posexplode("keys").alias("t", "key")).select(
        "rep", "signs", F.xxhash64("label", "t", "key").alias("cell")))
    jobs = in_jobs(cells, "cell", tile, "rep").select("job", "rep", "signs")
    found = jobs.repartition(F.col("job")).sortWithinPartitions("job").mapInArrow(
        _meet(differ), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    return components(found).withColumnRenamed("node", "rep")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Needs vec_id, embedding and label.  Rows link when their labels are equal and not NULL, their
    embeddings have the same length, and the cosine in double precision is ``threshold`` or more.
    Embeddings that are NULL, empty, zero or hold a NULL or non-finite component link with nothing.
    Equal embeddings of a label are compared once and counted as often as they occur; rows with
    equal vec_id count each for itself.  A NULL vec_id is never the smallest of its component.
    The work grows with the vectors times the tables they are in, and with the pairs within the
    components of candidates, which ``n_links`` is about.
    """
    good = ("label is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and "
            "not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)")
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    rows = rows.withColumn("ok", F.expr(f"coalesce({good}, false)")).withColumn(
        "key", F.expr("if(ok, sha2(concat_ws(',', cast(label as string), array_join(transform(embedding, "
                      "x -> hex(cast(if(x = 0, 0D, x) as string))), ' ')), 256), null)"))
    # one row for equal vectors of a label; the label takes the length in
    label = F.concat_ws(":", F.size(F.first("embedding")).cast("string"), F.first("label").cast("string"))
    classes = staged(
        rows.filter("ok").groupBy("key").agg(
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
            F.first("embedding").alias("embedding"), label.alias("label"))
        .withColumn("rep", F.monotonically_increasing_id()))
    near = candidates(classes, threshold, tile).withColumnRenamed("root", "candidate")
    together = classes.select("rep", "copies", "label", "embedding").join(near, "rep") \
        .withColumn("cell", F.xxhash64("candidate", "label")).drop("candidate")
    found = staged(
        in_jobs(staged(together), "cell", tile, "rep").select("job", "label", "side", "rep", "copies", "embedding")
        .groupBy("job", "label").applyInPandas(_link_tiles(threshold), "a bigint, b bigint, n bigint"))
    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "rep")
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    known = (
        classes.select("key", "rep", "least", "copies").join(links, "rep", "left")
        .join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep")))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select(
        "key", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id", "key").join(known, "key", "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def near_vectors_sql(vectors: str = "embeddings") -> str:
    """The same in DuckDB's SQL, by comparing all vectors of a label."""
    return rf"""
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from {vectors}),
good as (
  select vec_id, label, e from v where label is not null and len(e) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from good a join good b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) as (
  select vec_id, vec_id from v union
  select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from links group by a)
select l.a as vec_id, cast(coalesce(c.n, 0) as bigint) as n_links, l.component_id, l.a = l.component_id as kept
from least l left join counts c on c.a = l.a"""
