"""Slowly changing dimensions: type 1 upsert, type 2 merge.

Validity is half-open, ``[start_date, end_date)``.  A closed version keeps its surrogate key and
is never touched again; a new version gets a new key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.keys import HEX_DIGITS, key_bucket, largest_key, number_new
from sparkmart.schemas import REJECT_REASON, SOURCE_SYSTEM

VERSION_COLUMNS = ["start_date", "end_date", "is_current"]


def current_rows(dim: DataFrame, drop: list[str] = ()) -> DataFrame:
    """Current versions only, without the columns in ``drop``."""
    return dim.filter("is_current").drop(*drop)


def with_source(df: DataFrame, source: str = SOURCE_SYSTEM) -> DataFrame:
    return df.withColumn("source_system", F.lit(source))


def with_scd_columns(df: DataFrame, run_date: str | date,
                     source: str = SOURCE_SYSTEM) -> DataFrame:
    """Validity and lineage columns of versions that open on ``run_date``."""
    return df.withColumns({
        "start_date": F.lit(str(run_date)).cast("date"),
        "end_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
        "source_system": F.lit(source),
    })


def changed(tracked: list[str], left: str, right: str) -> Column:
    """Does any tracked column differ?  A change to or from NULL is a change."""
    return F.expr(" or ".join(f"not ({left}.`{c}` <=> {right}.`{c}`)" for c in tracked))


def unchanged_keys(updates: DataFrame, current: DataFrame, key: str,
                   tracked: list[str]) -> DataFrame:
    """Incoming keys that open no new version over an existing one: new keys and same rows.

    An anti join against the changed keys; no list of keys leaves the cluster.
    """
    moved = (
        updates.alias("u").join(current.alias("c"), key)
        .filter(changed(tracked, "u", "c")).select(key)
    )
    return updates.select(key).join(moved, key, "left_anti")


def _row(side: str, names: list[str], overrides: dict[str, str]) -> str:
    """SQL text of a struct with the columns ``names`` of one side of the join."""
    values = (f"{overrides.get(n, f'{side}.`{n}`')} as `{n}`" for n in names)
    return f"struct({', '.join(values)})"


#: Bucket of a key in a table written in buckets, and its name while rows are merged.
BUCKET, DEALT = "bucket", "_dealt"


def bucket_of(key: str, n_buckets: int, digits: int = HEX_DIGITS) -> Column:
    return (key_bucket([key], digits) % n_buckets).cast("int")


def _side_by_side(target: DataFrame, updates: DataFrame, keys: list[str], digits: int,
                  n_buckets: int | None = None) -> DataFrame:
    """One row per key with the structs ``t`` and ``u`` of its target row and its update.

    Both sides are dealt out by the keys' bucket, in which keys are numbered as well, and met by
    an aggregate on the keys, where NULLs are equal.  So a merge shuffles each row once and runs its
    inputs once; a full outer join would leave the rows without a known partitioning.  With
    ``n_buckets`` the rows are dealt out by the table's buckets, one task for each, ready to be written so.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        key = key_bucket(keys, digits)
        return df.select(key.alias("_bucket"), (key % n_buckets if n_buckets else key).cast("int").alias(DEALT),
                         *[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys],
                         F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    both = side(target, "t").unionByName(side(updates, "u"), allowMissingColumns=True)
    return both.repartition(F.col(DEALT)).groupBy(DEALT, "_bucket", *[f"_key_{k}" for k in keys]).agg(
        F.first("t", ignorenulls=True).alias("t"), F.first("u", ignorenulls=True).alias("u"))


def scd2_delta(current: DataFrame, updates: DataFrame, key: str, tracked: list[str],
               run_date: str | date, sk: str, start: Column | int, digits: int = HEX_DIGITS,
               n_buckets: int | None = None) -> DataFrame:
    """Merge incoming rows with the current versions; both have one row per ``key``.

    Gives the new set of current versions plus the versions closed by this run.  Target row and
    update of a key meet in one aggregate, and each key becomes one or two output rows:

    * only incoming: opened on ``run_date``;
    * only current: stays as it is;
    * tracked columns equal: the other attributes are refreshed, key and start date stay;
    * tracked columns differ: the current version is closed, the incoming one opened.

    Without any current version this is the first load.  New versions are numbered where the keys
    met, see ``number_new``.

    If ``updates`` has a column ``reject_reason``, so has the result: an update with a reason changes
    nothing and comes out beside the current version as a row of neither kind, with ``is_current``,
    the key and the dates NULL.  With ``n_buckets`` the result has the column ``bucket`` and each bucket
    is in one task.
    """
    names = current.columns
    judged = REJECT_REASON in updates.columns
    out = [*names, REJECT_REASON] if judged else names
    met = _side_by_side(current, updates, [key], digits, n_buckets)

    day, no_reason = f"date'{run_date}'", {REJECT_REASON: "cast(null as string)"}
    still_open = {"end_date": "cast(null as date)", "is_current": "true"}
    opened = _row("u", out, {sk: "cast(null as bigint)", "start_date": day, **still_open})
    refreshed = _row("u", out, {sk: f"t.`{sk}`", "start_date": "t.start_date", **still_open})
    closed = _row("t", out, {"end_date": day, "is_current": "false", **no_reason})
    kept = _row("t", out, no_reason)
    rows = (
        F.when(F.col("u").isNull(), F.expr(f"array({kept})"))
        .when(F.col("t").isNull(), F.expr(f"array({opened})"))
        .when(changed(tracked, "u", "t"), F.expr(f"array({closed}, {opened})"))
        .otherwise(F.expr(f"array({refreshed})"))
    )
    if judged:
        nothing = {sk: "cast(null as bigint)", "start_date": "cast(null as date)",
                   "end_date": "cast(null as date)", "is_current": "cast(null as boolean)"}
        refused = _row("u", out, nothing)
        rows = F.when(F.col("u.reject_reason").isNotNull(), F.when(F.col("t").isNull(), F.expr(f"array({refused})"))
                      .otherwise(F.expr(f"array({kept}, {refused})"))).otherwise(rows)
    merged = met.select(DEALT, "_bucket", F.inline(rows))
    is_new = F.col(f"`{sk}`").isNull() & F.col("is_current").isNotNull()
    done = number_new(merged, sk, [key], start, is_new, [DEALT], digits)
    return done.withColumnRenamed(DEALT, BUCKET) if n_buckets else done.drop(DEALT)


def scd2_merge(target: DataFrame, updates: DataFrame, key: str, tracked: list[str],
               run_date: str | date, sk: str) -> DataFrame:
    """The whole dimension after the merge: untouched history and the result of the delta."""
    history = target.filter(~F.col("is_current"))
    current = target.filter("is_current")
    # closing a version opens one with a higher key, so the largest key is a current row's
    delta = scd2_delta(current, updates, key, tracked, run_date, sk, largest_key(current, sk))
    return history.unionByName(delta)


def scd1_upsert(target: DataFrame, updates: DataFrame, keys: list[str], sk: str,
                digits: int = HEX_DIGITS) -> DataFrame:
    """Overwrite matching rows, insert the others, keep rows without an update.

    Keys match null-safe.  A matched update overwrites every attribute, also with NULL.
    """
    names = target.columns
    attributes = [n for n in names if n != sk and n not in keys]
    has_update = F.col("u").isNotNull()
    merged = _side_by_side(target, updates, keys, digits).select(
        DEALT, "_bucket", F.col(f"t.`{sk}`").alias(sk),
        *[F.when(has_update, F.col(f"u.`{n}`")).otherwise(F.col(f"t.`{n}`")).alias(n)
          for n in keys + attributes])
    is_new = F.col(f"`{sk}`").isNull()
    return number_new(merged, sk, keys, largest_key(target, sk), is_new, [DEALT], digits).select(*names)
