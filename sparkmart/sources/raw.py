"""Raw document collections: scan and envelope decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet",
             drop_deleted: bool = False) -> DataFrame:
    """All documents of a landed collection.

    Documents marked as deleted at the source stay in unless ``drop_deleted`` is set.
    """
    raw = spark.read.format(fmt).load(path)
    return without_deleted(raw) if drop_deleted else raw


def without_deleted(raw: DataFrame) -> DataFrame:
    """Documents that the source has not marked as deleted; an unset mark counts as live."""
    return raw.filter(~F.coalesce(F.col("_fivetran_deleted"), F.lit(False)))


CORRUPT = "_corrupt_record"


def parse_envelope(raw: DataFrame, schema: str, col: str = "data", text_as: str | None = None) -> DataFrame:
    """Replace the JSON string ``col`` by a struct of the declared schema.

    Missing, mistyped and malformed parts become NULL.  With ``text_as`` the string stays under that
    name, and the struct has one more field, ``_corrupt_record``: the string again if any part of it
    could not be read as declared, else NULL.  Either way a document is decoded once.
    """
    if text_as is None:
        return raw.withColumn(col, F.from_json(F.col(col), schema))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    decoded = F.from_json(F.col(col), f"{schema}, {CORRUPT} string", options)
    return raw.withColumns({text_as: F.col(col), col: decoded})


def refusal(missing: Column, what: str, col: str = "data") -> Column:
    """Why a decoded document gives no rows; NULL if it does.

    ``missing`` tells that the part the rows come from, called ``what``, isn't there: because the
    document is NULL or blank, because it can't be read, or because it has none.
    """
    return (F.when(F.col(col).isNull(), EMPTY)
            .when(missing & F.col(f"{col}.{CORRUPT}").isNotNull(), UNREADABLE)
            .when(missing, f"document has no {what}"))


EMPTY, UNREADABLE = "document is empty", "document is not readable"
