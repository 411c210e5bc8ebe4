"""High-water marks and the filters that go with them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.schemas import FIRST_MARK


def high_water_mark(df: DataFrame, col: str, default: str = FIRST_MARK) -> DataFrame:
    """One row ``mark``: the largest value of ``col``, or the default for an empty table."""
    newest = F.coalesce(F.max(col), F.lit(default).cast("timestamp"))
    return df.agg(newest.alias("mark"))


def _literal(df: DataFrame, col: str, mark: datetime | str) -> Column:
    """The mark as a literal of the column's own kind of timestamp, with or without time zone, so that
    the column is compared as it is stored and the comparison reaches the parquet scan."""
    zoneless = df.select(col).schema[0].dataType.typeName() == "timestamp_ntz"
    return F.lit(mark).cast("timestamp_ntz" if zoneless else "timestamp")


def newer_than(df: DataFrame, col: str, mark: datetime | str) -> DataFrame:
    """Rows strictly newer than the mark."""
    return df.filter(F.col(col) > _literal(df, col, mark))


def since(mark: str, overlap: timedelta) -> str:
    """The time ``overlap`` before a mark."""
    return str(datetime.fromisoformat(mark) - overlap)


def newer_or_unseen(df: DataFrame, col: str, key: str, mark: str, overlap: timedelta,
                    seen: DataFrame) -> DataFrame:
    """Rows newer than the mark, and those of the ``overlap`` before it that came too late.

    ``seen`` has the (key, time) pairs loaded from that window, the mark's own time included; rows
    with one of them are left out.  Only the window is joined, and only the window's ``seen`` is needed.
    A row without a time is never newer.
    """
    late = df.filter((F.col(col) >= _literal(df, col, since(mark, overlap))) & (F.col(col) <= _literal(df, col, mark)))
    known = seen.select(F.col(seen.columns[0]).alias("_key"), F.col(seen.columns[1]).alias("_time")).distinct()
    late = late.join(known, F.col(key).eqNullSafe(F.col("_key")) & (F.col(col) == F.col("_time")), "left_anti")
    return newer_than(df, col, mark).unionByName(late)
