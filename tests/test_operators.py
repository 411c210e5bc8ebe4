from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import dedup
from sparkmart.operators.dedup import drop_loaded, latest_by_key
from sparkmart.operators.generators import date_series, explode_array, explode_map
from sparkmart.operators.incremental import high_water_mark, newer_than
from sparkmart.operators.keys import assign_row_keys, assign_surrogate_keys, key_digits, largest_key, number_rows
from sparkmart.operators.lookup import account_bridge, is_small, junk_dimension, lookup_fk
from sparkmart.operators.quality import (
    check_length,
    check_not_null,
    check_one_current,
    check_unique,
)


def test_surrogate_keys_are_unique_repeatable_and_above_the_start(spark):
    df = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("bk"))
    first = {r.bk: r.sk for r in assign_surrogate_keys(df, "sk", ["bk"], 500).collect()}
    again = {r.bk: r.sk for r in
             assign_surrogate_keys(df.repartition(7), "sk", ["bk"], 500).collect()}
    assert first == again
    assert len(set(first.values())) == 20000
    assert min(first.values()) > 500 and max(first.values()) < 500 + 20000 * 4


def test_surrogate_keys_of_composite_keys_with_nulls(spark):
    rows = [("a", None), ("a", "b"), (None, "a"), (None, None), ("a|b", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert len({r.sk for r in assign_surrogate_keys(df, "sk", ["x", "y"]).collect()}) == 5


def test_row_keys(spark):
    df = spark.range(0, 1000, 1, 7)
    keys = [r.sk for r in assign_row_keys(df, "sk", 40).collect()]
    assert len(set(keys)) == 1000 and min(keys) == 41


def test_largest_key(spark):
    df = spark.createDataFrame([(3,), (9,), (None,)], "sk bigint")
    assert spark.range(1).select(largest_key(df, "sk")).first()[0] == 9
    assert spark.range(1).select(largest_key(df.filter("sk > 9"), "sk")).first()[0] == 0


def test_marks(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 2),), (None,)],
                               "t timestamp")
    assert high_water_mark(df, "t").first().mark == datetime(2024, 1, 2)
    assert high_water_mark(df.filter("false"), "t").first().mark == datetime(1900, 1, 1)
    assert newer_than(df, "t", "2024-01-01 00:00:00").count() == 1


def test_latest_by_key(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(1, "b", early, 1), (1, "c", late, 2), (1, "a", late, 3), (2, "z", None, 4),
            (2, "y", early, 5), (None, "n", None, 6)]
    df = spark.createDataFrame(rows, "k int, id string, t timestamp, v int")
    got = latest_by_key(df, ["k"], "t", ["id"])
    assert got.columns == df.columns
    assert {r.k: r.v for r in got.collect()} == {1: 3, 2: 5, None: 6}


@pytest.mark.parametrize("chunk", [1, 3, 100_000])
def test_q16_drop_loaded_is_a_multiset_difference(spark, monkeypatch, chunk):
    monkeypatch.setattr(dedup, "CHUNK", chunk)
    new = [(1, "a", 10)] * 7 + [(1, None, 11)] * 2 + [(2, "b", 12)] + [(3, "c", 13)]
    old = [(1, "a", 5)] * 3 + [(1, None, 5)] + [(3, "c", 5)] * 4 + [(9, "z", 5)]
    schema = "k int, s string, t int"
    got = drop_loaded(spark.createDataFrame(new, schema), spark.createDataFrame(old, schema),
                      ["k", "s"], "k")
    expected = Counter({(1, "a", 10): 4, (1, None, 11): 1, (2, "b", 12): 1})
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_generators(spark):
    df = spark.createDataFrame([(1, [5, None]), (2, []), (3, None)], "id int, a array<int>")
    assert sorted(str(r.x) for r in explode_array(df, "a", "x").collect()) == ["5", "None"]
    assert explode_array(df, "a", "x", keep_empty=True).count() == 4
    maps = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, {}), (3, None)],
                                 "id int, m map<string,int>")
    got = [(r.id, r.k, r.v) for r in explode_map(maps, "m", "k", "v").orderBy("id", "k").collect()]
    assert got == [(1, "a", 1), (1, "b", 2), (2, None, None), (3, None, None)]
    assert date_series(spark, "2024-02-28", "2024-03-01").count() == 3


def test_q26_junk_dimension_has_every_occurring_pair_once(spark):
    rows = [(f"t{i % 7}" if i % 7 else None, f"s{i % 90}" if i % 11 else None)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [tuple(r) for r in junk_dimension(df, "a", "b").collect()]
    assert len(got) == len(set(got)) and set(got) == set(rows)


@pytest.mark.parametrize("small", [True, False, None])
def test_q13_lookup_finds_null_keys(spark, small):
    df = spark.createDataFrame([("buy", None), ("buy", "x"), ("sell", "q")], "a string, b string")
    keys = spark.createDataFrame([("buy", None, 1), ("buy", "x", 2)], "a string, b string, pk int")
    got = lookup_fk(df, keys, ["a", "b"], small).collect()
    assert {(r.a, r.b): r.pk for r in got} == {("buy", None): 1, ("buy", "x"): 2, ("sell", "q"): None}


def test_broadcast_only_after_measuring(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 100).alias("s"))
    assert is_small(df, 100, 20_000)
    assert not is_small(df, 99, 20_000)
    assert not is_small(df, 100, 10_000)
    assert is_small(df.filter("false"))


def test_bridge(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "id string, account_id int")
    assert account_bridge(df).count() == 3


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, True), (None, 2, False), ("long", 3, True)],
                               "s string, n int, is_current boolean")

    def counts(found):
        return {r.rule: r.violations for r in found.collect()}

    assert counts(check_not_null(df, ["s", "n"])) == {"s is not null": 1, "n is not null": 0}
    assert counts(check_length(df, {"s": 3})) == {"s fits varchar(3)": 1}
    assert counts(check_unique(df, ["s"])) == {"s is unique": 1}
    assert counts(check_unique(df, ["s", "n"])) == {"s, n is unique": 0}
    assert counts(check_one_current(df, "s")) == {"s is unique": 1}
    assert counts(check_unique(df.filter("false"), ["s"])) == {"s is unique": 0}


def test_number_rows_is_gap_free_in_order(spark):
    rows = [(i * 7919 % 1000, i % 3) for i in range(1000)] + [(None, 9)]
    frame = spark.createDataFrame(rows, "k int, v int").repartition(5)
    out = [(r.n, r.k) for r in number_rows(frame, "n", [F.asc_nulls_first("k"), "v"], start=10).collect()]
    keys = [k for _, k in sorted(out)]
    assert [n for n, _ in sorted(out)] == list(range(10, 1011))
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert number_rows(spark.createDataFrame([], "k int"), "n", ["k"]).count() == 0


def test_buckets_of_new_keys_grow_with_the_table(spark):
    assert [key_digits(n) for n in (0, 10 ** 9, 10 ** 9 + 10 ** 8, 10 ** 11, 10 ** 13)] == [3, 3, 4, 5, 7]
    df = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("bk"))
    keys = [r.sk for r in assign_surrogate_keys(df, "sk", ["bk"], 7, digits=4).collect()]
    assert len(set(keys)) == 3000 and min(keys) > 7 and max(keys) <= 7 + 3 * 16 ** 4
