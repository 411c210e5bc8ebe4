"""Operators that turn one row into many."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def explode_array(df: DataFrame, array: str, item: str, keep_empty: bool = False) -> DataFrame:
    """One row per array member.  Rows without members vanish unless ``keep_empty``.

    A plain ``explode`` of a column makes Spark add a filter on the array's size, and pushes it
    below the projection that makes the array: with arrays out of ``from_json`` every document
    would be decoded twice.  An expression as input keeps that filter away.
    """
    if keep_empty:
        return df.withColumn(item, F.explode_outer(array))
    return df.withColumn(item, F.explode(F.coalesce(array, F.array())))


def explode_map(df: DataFrame, entries: str, key: str, value: str) -> DataFrame:
    """One row per map entry; rows without entries stay, with NULL key and value.

    Exploding outer keeps the entry-less rows directly, so no self-join is needed.
    """
    return df.select("*", F.explode_outer(entries).alias(key, value))


def date_series(spark: SparkSession, start: str | date, end: str | date,
                name: str = "date_full") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    days = F.sequence(first, last, F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))
