"""Boolean presence flags.  ``flags`` maps an output column to the value it stands for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def presence_flags(value: Column, flags: Mapping[str, str]) -> list[Column]:
    """Aggregates: does the group hold a row with this value?  Never NULL."""
    return [
        F.coalesce(F.bool_or(value == wanted), F.lit(False)).alias(name)
        for name, wanted in flags.items()
    ]


def array_flags(values: Column, flags: Mapping[str, str]) -> list[Column]:
    """Per row: does the array hold this value?  NULL arrays and NULL members count as no."""
    return [
        F.coalesce(F.array_contains(values, wanted), F.lit(False)).alias(name)
        for name, wanted in flags.items()
    ]


def array_presence_flags(values: Column, flags: Mapping[str, str]) -> list[Column]:
    """Aggregates: does any array of the group hold this value?

    Testing the arrays in place gives the answer of exploding them first, without the extra
    rows, and the boolean buffers keep the aggregation hash-based with a map-side combine.
    """
    return [
        F.coalesce(F.bool_or(F.array_contains(values, wanted)), F.lit(False)).alias(name)
        for name, wanted in flags.items()
    ]
