"""Surrogate keys: unique, larger than every earlier key, never reused.

Like identity columns of distributed tables the keys are not gap-free.  ``number_rows`` numbers
without gaps; that takes a global order and a second pass over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import staged

#: Rows that one bucket, which one task numbers, should not exceed.
ROWS_PER_BUCKET = 250_000
HEX_DIGITS = 3


def key_digits(rows: int) -> int:
    """Hex digits of the bucket number that keep buckets of ``rows`` keys small; 3 up to 10**9."""
    digits = HEX_DIGITS
    while rows > ROWS_PER_BUCKET * 16 ** digits:
        digits += 1
    return digits


def key_bucket(keys: list[str], digits: int = HEX_DIGITS) -> Column:
    """A number below ``16 ** digits`` that depends only on the key values."""
    text = F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys])
    return F.conv(F.left(F.md5(text), F.lit(digits)), 16, 10).cast("bigint")


def in_turn(start: Column, nth: Column, bucket: Column, digits: int = HEX_DIGITS) -> Column:
    """Key of the ``nth`` row of a bucket: the buckets take turns."""
    return start + (nth.cast("bigint") - 1) * 16 ** digits + bucket + 1


def assign_surrogate_keys(df: DataFrame, sk: str, order_by: list[str],
                          start: Column | int = 0, digits: int = HEX_DIGITS) -> DataFrame:
    """Number rows by their business key ``order_by``, above ``start``.

    Rows are numbered within hash buckets, and the buckets take turns: with 4,096 buckets the n-th
    row of bucket b gets ``start + (n - 1) * 4096 + b + 1``.  That needs one shuffle and no counts,
    and the same rows always get the same keys, so a repeated or partly recomputed run agrees
    with the first one.  Business keys are unique, so the buckets are even; rows that may be
    copies of each other take ``assign_row_keys``.  Beyond a thousand million rows give
    ``key_digits(rows)``.
    """
    base = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    w = Window.partitionBy("_bucket").orderBy(*[F.col(f"`{k}`") for k in order_by])
    return (
        df.drop(sk)
        .withColumn("_bucket", key_bucket(order_by, digits))
        .withColumn(sk, in_turn(base, F.row_number().over(w), F.col("_bucket"), digits))
        .drop("_bucket")
    )


def number_new(keyed: DataFrame, sk: str, order_by: list[str], start: Column | int,
               is_new: Column, within: list[str], digits: int = HEX_DIGITS) -> DataFrame:
    """Give the rows ``is_new`` of a frame with a ``_bucket`` column their keys, where they are.

    The keys are those of ``assign_surrogate_keys`` for these rows alone.  ``within`` are columns that
    the bucket decides; a frame dealt out by them already is not shuffled again.
    """
    base = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    w = Window.partitionBy("_bucket", "_new", *within).orderBy(*[F.col(f"`{k}`") for k in order_by])
    key = in_turn(base, F.row_number().over(w), F.col("_bucket"), digits)
    return (keyed.withColumn("_new", is_new)
            .withColumn(sk, F.when(F.col("_new"), key).otherwise(F.col(f"`{sk}`")))
            .drop("_new", "_bucket"))


def assign_row_keys(df: DataFrame, sk: str, start: int = 0) -> DataFrame:
    """Number rows where they are, without any shuffle, above ``start``.

    For large tables whose rows have no unique business key.  The keys depend on how the rows
    are spread, so this must be the last step before the frame is written.
    """
    return df.withColumn(sk, F.lit(start).cast("bigint") + 1 + F.monotonically_increasing_id())


def largest_key(df: DataFrame, sk: str) -> Column:
    """The largest key of a table, 0 when it is empty, as a scalar subquery column."""
    return F.coalesce(df.agg(F.max(sk)).scalar(), F.lit(0).cast("bigint"))


#: ``monotonically_increasing_id`` has the partition above these bits and the row in it below.
ROW_BITS = 33


def number_rows(df: DataFrame, name: str, order_by: list[Column | str], start: int = 0) -> DataFrame:
    """``df`` with gap-free numbers from ``start`` on, in the order of ``order_by``; staged.

    A distributed prefix sum: rows are dealt into ranges of the order and sorted there, the sorted
    ranges are written once, their sizes (one row per partition) are added up, and a row's number
    is its range's offset plus its place in the range.  So no task holds more than a range, however
    many rows there are.  Rows alike in all of ``order_by`` stay in one range: give columns that
    tell rows apart.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    placed = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(f"`{name}`"), ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shift = placed.groupBy(part.alias("_part")).count().select(
        "_part", (F.lit(start) + F.coalesce(F.sum("count").over(before), F.lit(0))
                  - F.shiftleft("_part", ROW_BITS)).alias("_shift"))
    return (placed.join(F.broadcast(shift), part == F.col("_part"))
            .withColumn(name, F.col(f"`{name}`") + F.col("_shift")).drop("_part", "_shift"))
