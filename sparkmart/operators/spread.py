"""Equi-joins that stay balanced when few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 4_000_000
CELL = "_cell"
#: Keys a sketch tracks, and hot keys at most.
TRACKED, MOST_HOT = 1 << 18, 100_000
#: Groups of keys that rows are counted by, at most so many short rows of a task, and crowded ones a filter lists.
GROUPS, LISTED = 1 << 16, 1000


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hot_keys(df: DataFrame, keys: list[str], rows_per_slice: int, name: str) -> DataFrame:
    """Hashes ``_h`` of keys with more than ``rows_per_slice`` rows, and in ``name`` their slices.

    Rows are first counted by ``GROUPS`` groups of hashes, an aggregate that combines in generated code before
    its small shuffle.  A hot key makes its group as large, so where no group is, there is none.  Only the rows
    of crowded groups go into a sketch of frequent items: every task tracks at most ``TRACKED`` keys, and the
    sketches are merged, so nothing is shuffled by key.  Up to so many distinct keys the counts are exact;
    beyond, they are off by at most 3.5 / ``TRACKED`` of all rows, so up to 3 * 10**11 rows no key of
    four million is missed (one that is missed stays whole, for the runtime's own skew handling).  At
    most ``MOST_HOT`` short rows: that bound is what makes it safe to collect and broadcast them.
    Another key with the same hash is dealt out as well, which changes no result.
    """
    hashed = df.select(_key_hash(keys).alias("_h"))
    group = F.pmod("_h", F.lit(GROUPS))
    counted = hashed.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    crowded = [r[0] for r in counted.filter(F.col("_n") > rows_per_slice).select("_group").collect()]
    if not crowded:
        return df.sparkSession.range(1).filter(F.lit(False)).select(
            F.col("id").alias("_h"), F.col("id").cast("int").alias(name))
    if len(crowded) <= LISTED:  # beyond, most rows would be in the list
        hashed = hashed.filter(group.isin(crowded))
    top = hashed.agg(F.expr(f"approx_top_k(_h, {MOST_HOT}, {TRACKED})").alias("top"))
    return (top.select(F.inline("top")).filter(F.col("count") > rows_per_slice)
            .select(F.col("item").alias("_h"), F.ceil(F.col("count") / rows_per_slice).cast("int").alias(name)))


def _with_slices(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_slices`` and ``_parts`` of the row's key, 1 and 1 unless it is hot."""
    return df.join(F.broadcast(hot), _key_hash(keys) == F.col("_h"), "left").selectExpr(
        *[f"`{c}`" for c in df.columns],
        "coalesce(_slices, 1) as _slices", "coalesce(_parts, 1) as _parts")


def _deal(share: str, by: list[str] | None) -> Column:
    """Deal rows out over ``share`` groups, by the columns ``by`` or else by their position."""
    what = F.xxhash64(*[F.col(f"`{c}`") for c in by]) if by else F.xxhash64(F.monotonically_increasing_id())
    return F.when(F.col(share) == 1, 0).otherwise(F.pmod(what, F.col(share)).cast("int"))


def _plain_join(big: DataFrame, lookups: list[DataFrame], keys: list[str], how: str, many: DataFrame | None,
                null_safe: bool, keep_cell: bool) -> DataFrame:
    """No key is hot: equi-joins on the keys, all with the same partitioning of ``big``."""
    equal, out = "<=>" if null_safe else "=", big
    match = F.expr(" and ".join(f"`{k}` {equal} `_key_{k}`" for k in keys))
    for lookup in [*lookups, *([] if many is None else [many])]:
        renamed = lookup.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        out = out.join(renamed, match, how).drop(*[f"_key_{k}" for k in keys])
    return out.withColumn(CELL, F.lit(0)) if keep_cell else out


def spread_join(big: DataFrame, lookups: list[DataFrame], keys: list[str], how: str = "left",
                many: DataFrame | None = None, null_safe: bool = False,
                rows_per_slice: int = ROWS_PER_SLICE, count_from: DataFrame | None = None,
                count_many_from: DataFrame | None = None, deal_by: list[str] | None = None,
                keep_cell: bool = False, at_most: int | None = None,
                many_at_most: int | None = None) -> DataFrame:
    """Join ``big`` with each lookup on ``keys`` (``how`` is ``left`` or ``inner``).

    ``lookups`` have one row per key; ``many`` is one more lookup that may have any number.
    The rows of a key that is hot in ``big`` are dealt out over slices, those of a key that is
    hot in ``many`` over parts, and slices x parts make the key's cells.  Each row goes to the
    cells of its slice or part, lookup rows to all cells of their key; other keys have one cell.
    Every matching pair meets in exactly one cell, so the result is that of the plain joins, and
    ``big`` is shuffled once, on (keys, cell), for all of them.

    The keys are counted before, by one job for each side that may be hot.  ``count_from`` and
    ``count_many_from`` may name cheaper frames to count keys in that have all rows of ``big`` or
    ``many``, or more.  ``at_most`` and ``many_at_most`` tell how many rows a side can have, if known: a
    side of no more than ``rows_per_slice`` has no hot key and isn't counted.  Where no key is hot,
    these are plain joins.

    A row must go to the same slice when its task is run again.  ``deal_by`` names columns of
    ``big`` that tell its rows apart.  Without it rows are dealt by position, copies too, which
    only holds for a scan and what is computed row by row from it: after a shuffle the order may
    change.  Rows of ``many`` are dealt by all their columns.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a spread join is left or inner, not {how}")
    if not null_safe:  # a NULL key matches nothing
        lookups = [lookup.dropna(subset=keys) for lookup in lookups]
        many = many if many is None else many.dropna(subset=keys)
    def hot_in(df: DataFrame, rows: int | None) -> list[tuple[int, int]]:
        if rows is not None and rows <= rows_per_slice:
            return []
        return hot_keys(df.select(*keys), keys, rows_per_slice, "n").collect()

    found: dict[int, list[int]] = {}
    for h, n in hot_in(big if count_from is None else count_from, at_most):
        found[h] = [n, 1]
    if many is not None:
        listed = many if count_many_from is None else count_many_from
        if not null_safe:
            listed = listed.dropna(subset=keys)
        for h, n in hot_in(listed, many_at_most):
            found.setdefault(h, [1, 1])[1] = n
    if not found:
        return _plain_join(big, lookups, keys, how, many, null_safe, keep_cell)
    hot = big.sparkSession.createDataFrame([(h, *n) for h, n in found.items()], "_h bigint, _slices int, _parts int")

    out = _with_slices(big, keys, hot).withColumn("_slice", _deal("_slices", deal_by))
    if many is None:
        out = out.withColumn(CELL, F.col("_slice"))
    else:
        cells = "sequence(_slice * _parts, (_slice + 1) * _parts - 1)"
        out = out.withColumn(CELL, F.expr(f"explode({cells})"))
    out = out.drop("_slice", "_slices")

    equal = "<=>" if null_safe else "="
    match = F.expr(" and ".join([*[f"`{k}` {equal} `_key_{k}`" for k in keys], f"{CELL} = _at"]))

    def join(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
        return left.join(right, match, how).drop("_at", *[f"_key_{k}" for k in keys])

    for lookup in lookups:
        at = F.expr("explode(sequence(0, _slices * _parts - 1))")
        out = join(out, _with_slices(lookup, keys, hot).withColumn("_at", at)
                   .drop("_slices", "_parts"))
    if many is not None:
        at = F.expr("explode(sequence(_part, (_slices - 1) * _parts + _part, _parts))")
        dealt = _with_slices(many, keys, hot).withColumn("_part", _deal("_parts", many.columns))
        out = join(out, dealt.withColumns({"_at": at, "_hit": F.lit(True)})
                   .drop("_part", "_slices", "_parts"))
        # a key with parts does have matches, so a cell of it without one adds no row
        out = out.filter("_hit or _parts = 1").drop("_hit")
    out = out.drop("_parts")
    return out if keep_cell else out.drop(CELL)
