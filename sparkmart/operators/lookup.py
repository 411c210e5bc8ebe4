"""Foreign-key lookups, the customer-account bridge and the junk dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.spread import spread_join

SMALL_ROWS, SMALL_BYTES = 200_000, 32 * 1024 * 1024


def lookup_view(dim: DataFrame, key_cols: list[str], sk: str,
                current_only: bool = True) -> DataFrame:
    """Surrogate and business key of a dimension, of its current rows if it has versions."""
    rows = dim.filter("is_current") if current_only else dim
    return rows.select(sk, *key_cols)


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Measure a frame before it is broadcast; never reads more than ``max_rows + 1`` rows."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8
                 for c in df.columns), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_fk(df: DataFrame, lookup: DataFrame, keys: list[str],
              small: bool | None = None, deal_by: list[str] | None = None) -> DataFrame:
    """Left join with a lookup on null-safe keys: a NULL key finds the NULL row.

    A lookup that is measured to be small is broadcast; any other is joined by ``spread_join``,
    which deals the rows of hot keys by the columns ``deal_by``.
    """
    if small is None:
        small = is_small(lookup)
    if not small:
        return spread_join(df, [lookup], keys, null_safe=True, deal_by=deal_by)
    renamed = lookup.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return df.join(F.broadcast(renamed), match, "left").drop(*[f"_key_{k}" for k in keys])


def account_bridge(customers: DataFrame) -> DataFrame:
    """Distinct (customer, account) pairs of the processed customers."""
    return customers.select(F.col("id").alias("customer_bk"), "account_id").distinct()


def junk_dimension(df: DataFrame, left: str, right: str) -> DataFrame:
    """The pairs of ``left`` and ``right`` that occur, each once; NULL is a value too.

    One scan and one aggregate with map-side combine.  The fact looks up pairs that occur, so
    pairs that don't are not made.
    """
    return df.select(left, right).distinct()
