from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from sparkmart.functions.flags import array_flags, array_presence_flags, presence_flags
from sparkmart.functions.scalars import (
    composite_key,
    date_key,
    is_leapyear,
    is_weekday,
    iso_to_date,
    iso_to_epoch,
    to_bool,
)
from sparkmart.plans.calendar import build_dim_date

ISO = {
    "2015-03-01T00:00:00Z": (date(2015, 3, 1), 1425168000),
    "2015-03-01T23:59:59.250Z": (date(2015, 3, 1), 1425254399),
    "1965-05-05T00:00:00Z": (date(1965, 5, 5), -147052800),
    "1970-01-01T00:00:00Z": (date(1970, 1, 1), 0),
    "2015-02-30T00:00:00Z": (None, None),
    "2015-03-01T25:00:00Z": (None, None),
    "2015-03-01": (None, None),
    "2015": (None, None),
    "2015-03-01T00:00:00+02:00": (None, None),
    "junk": (None, None),
    "": (None, None),
    None: (None, None),
}


def test_iso_strings(spark):
    df = spark.createDataFrame([(t,) for t in ISO], "t string")
    got = df.select("t", iso_to_date(F.col("t")), iso_to_epoch(F.col("t"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == ISO


def test_iso_day_does_not_depend_on_the_time_zone(spark):
    df = spark.createDataFrame([("2015-03-01T23:30:00Z",)], "t string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        row = df.select(iso_to_date(F.col("t")), iso_to_epoch(F.col("t"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (date(2015, 3, 1), 1425252600)


def test_q2_composite_key(spark):
    rows = [(443178, 100), (443178, -100), (None, 5), (5, None), (2147483647, 99999999999)]
    df = spark.createDataFrame(rows, "a int, e bigint")
    got = [r[0] for r in df.select(composite_key(F.col("a"), F.col("e"))).collect()]
    assert got == [443178100, None, None, None, 214748364799999999999]


def test_q15_date_key_is_a_number(spark):
    df = spark.createDataFrame([(date(2024, 5, 3),), (date(1962, 1, 1),), (None,)], "d date")
    got = df.select(date_key(F.col("d")).alias("k"))
    assert [r[0] for r in got.collect()] == [20240503, 19620101, None]
    assert got.schema["k"].dataType.typeName() == "integer"


def test_safe_boolean(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,), ("maybe",)], "t string")
    assert [r[0] for r in df.select(to_bool(F.col("t"))).collect()] == [True, False, None, None]


def test_weekday_and_leap_year(spark):
    days = [date(2024, 5, d) for d in range(3, 7)] + [date(1900, 1, 1), date(2000, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [tuple(r) for r in df.select(is_weekday(F.col("d")), is_leapyear(F.col("d"))).collect()]
    assert got == [(1, 1), (0, 1), (0, 1), (1, 1), (1, 0), (0, 1)]


def test_calendar(spark):
    days = build_dim_date(spark).collect()
    assert len(days) == 25202 == len({d.date_id for d in days})
    for d in days:
        iso = d.date_full.isocalendar()
        assert (d.week, d.day_of_week) == (iso.week, iso.weekday - 1)
        assert d.day_name == d.date_full.strftime("%a")
        assert d.month_name == d.date_full.strftime("%B")
        assert d.is_leapyear == (1 if d.year % 4 == 0 else 0)


def test_q9_array_flags_are_never_null(spark):
    df = spark.createDataFrame(
        [(1, None), (2, [None, "B"]), (3, []), (4, ["A"])], "id int, a array<string>")
    got = df.select("id", *array_flags(F.col("a"), {"a_": "A", "b_": "B"})).collect()
    assert [tuple(r) for r in got] == [
        (1, False, False), (2, False, True), (3, False, False), (4, True, False)]


def test_group_flags(spark):
    df = spark.createDataFrame(
        [(1, "x", ["A"]), (1, None, None), (2, None, []), (2, "y", ["B", None])],
        "id int, t string, a array<string>")
    got = df.groupBy("id").agg(
        *presence_flags(F.col("t"), {"x_": "x", "y_": "y"}),
        *array_presence_flags(F.col("a"), {"a_": "A", "b_": "B"})).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (1, True, False, True, False), (2, False, True, False, True)]
