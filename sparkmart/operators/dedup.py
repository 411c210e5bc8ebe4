"""One row per key, and rows that an earlier load has already brought."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 100_000


def latest_by_key(df: DataFrame, keys: list[str], newest: str, tie: list[str],
                  count_as: str | None = None) -> DataFrame:
    """The newest row of each key by the timestamp ``newest``, then the smallest ``tie``.

    ``count_as`` names a column for the number of rows the key had.

    Rows without a timestamp are the oldest.  A minimum of structs does it, which Spark combines
    on the map side; a window would bring all rows of a key to one task.  The remaining columns
    break full ties, so the answer never depends on row order; they must be orderable.
    """
    names = df.columns
    age = -F.unix_micros(F.col(newest).cast("timestamp"))
    oldest = F.lit(2 ** 63 - 1)
    rest = [c for c in names if c not in keys and c not in tie]
    best = F.min(F.struct(F.coalesce(age, oldest).alias("_age"), *tie, *rest))
    picked = df.groupBy(*keys).agg(best.alias("_best"), F.count(F.lit(1)).alias("_n"))
    return picked.select(*[
        F.col(c) if c in keys else F.col(f"_best.`{c}`").alias(c) for c in names
    ], *([F.col("_n").alias(count_as)] if count_as else []))


def drop_loaded(new: DataFrame, loaded: DataFrame, business: list[str],
                probe: str, meet_by: list[str] | None = None) -> DataFrame:
    """``new`` minus ``loaded`` as multisets over the ``business`` columns.

    A row that occurs five times in ``new`` and three times in ``loaded`` stays twice.  Other
    columns of the survivors take the largest value of their copies.  Both sides meet in one
    aggregate, where NULLs are equal and copies are combined before the shuffle; survivors are
    written out again in chunks that are spread over tasks, by the business column ``probe``.

    ``meet_by`` may name business columns that no very large part of the rows share; rows then meet by
    these, as they are, so that rows alike in them lie side by side and shuffle as fewer bytes.
    """
    extra = [c for c in new.columns if c not in business]
    kinds = {f.name: f.dataType for f in new.schema.fields}
    met = new.select(*business, *extra, F.lit(1).alias("_n")).union(loaded.select(
        *business, *[F.lit(None).cast(kinds[c]).alias(c) for c in extra], F.lit(-1).alias("_n")))
    if meet_by:
        met = met.repartition(*meet_by)
    left = met.groupBy(*business).agg(
        F.sum("_n").alias("_left"), *[F.max(c).alias(c) for c in extra]
    ).filter("_left > 0").select(*new.columns, "_left")
    chunks = (
        left.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_left - 1) div {CHUNK})")))
        .withColumn("_size", F.expr(f"least({CHUNK}L, _left - _chunk * {CHUNK})"))
        .repartition(probe, "_chunk")
    )
    copies = chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_size"))))
    return copies.select(*new.columns)
