"""Spread joins give the rows of plain joins, whatever is hot."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.spread import CELL, hot_keys, spread_join

BIG = [(k, v) for k, n in [(1, 40), (2, 3), (3, 1), (None, 25), (4, 9)] for v in range(n)]
COPIES = [(1, 7)] * 30
LOOKUP = [(1, "a"), (2, "b"), (4, "d"), (None, "n"), (9, "z")]
MANY = [(1, f"m{i}") for i in range(3)] + [(2, f"w{i}") for i in range(50)] + \
       [(None, f"x{i}") for i in range(20)] + [(9, "q")]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plain(big, lookup, how, null_safe):
    out = Counter()
    for key, v in big:
        hits = [w for k, w in lookup if (k == key and (null_safe or key is not None))]
        if not hits and how == "left":
            hits = [None]
        for w in hits:
            out[(key, v, w)] += 1
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("limit", [2, 1000])
def test_one_row_per_key(spark, how, null_safe, limit):
    big = spark.createDataFrame(BIG + COPIES, "k int, v int")
    lookup = spark.createDataFrame(LOOKUP, "k int, w string")
    got = spread_join(big, [lookup], ["k"], how, null_safe=null_safe, rows_per_slice=limit)
    assert rows(got) == plain(BIG + COPIES, LOOKUP, how, null_safe)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("limit", [2, 1000])
def test_many_rows_per_key(spark, how, null_safe, limit):
    big = spark.createDataFrame(BIG + COPIES, "k int, v int")
    many = spark.createDataFrame(MANY, "k int, w string")
    got = spread_join(big, [], ["k"], how, many=many, null_safe=null_safe, rows_per_slice=limit)
    assert rows(got) == plain(BIG + COPIES, MANY, how, null_safe)


def test_several_lookups_at_once(spark):
    big = spark.createDataFrame(BIG, "k int, v int")
    one = spark.createDataFrame(LOOKUP, "k int, a string")
    many = spark.createDataFrame(MANY, "k int, b string")
    got = spread_join(big, [one], ["k"], many=many, rows_per_slice=5)
    expected = big.join(one, "k", "left").join(many, "k", "left")
    assert rows(got.select("k", "v", "a", "b")) == rows(expected.select("k", "v", "a", "b"))


def test_hot_keys_are_split_even_when_rows_are_copies(spark):
    big = spark.createDataFrame(COPIES * 20 + [(2, 1)], "k int, v int").repartition(3)
    lookup = spark.createDataFrame(LOOKUP, "k int, w string")
    got = spread_join(big, [lookup], ["k"], rows_per_slice=100, keep_cell=True)
    cells = {r[0]: r[1] for r in got.filter("k = 1").groupBy(CELL).count().collect()}
    assert len(cells) == 6 and max(cells.values()) < 200
    assert sum(cells.values()) == 600


def test_hot_key_count_is_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert hot_keys(df, ["k"], 9, "n").count() == 100
    assert hot_keys(df, ["k"], 10, "n").count() == 0


def test_other_joins_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        spread_join(df, [df], ["id"], how="full")


def test_rows_are_not_sketched_where_no_group_of_keys_is_crowded(spark):
    def plan(limit):
        return hot_keys(df, ["k"], limit, "n")._jdf.queryExecution().toString()
    df = spark.createDataFrame([(1,)] * 9 + [(None,)] * 5 + [(k,) for k in range(2, 50)], "k int")
    assert "approx_top_k" in plan(8)
    assert "approx_top_k" not in plan(9)
    assert [r.n for r in hot_keys(df, ["k"], 4, "n").orderBy("n").collect()] == [2, 3]
    assert hot_keys(df, ["k"], 9, "n").dtypes == hot_keys(df, ["k"], 8, "n").dtypes


def test_many_crowded_groups_are_all_sketched(spark, monkeypatch):
    monkeypatch.setattr("sparkmart.operators.spread.LISTED", 3)
    df = spark.range(200).selectExpr("id div 10 as k")
    assert hot_keys(df, ["k"], 9, "n").count() == 20
