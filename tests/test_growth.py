"""Steps that decide how the loads grow: what is read, shuffled and computed once."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import envelopes as raw
from checks import queries
from sparkmart.operators.dedup import drop_loaded
from sparkmart.plans.processed import process_transactions

def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def landed(spark, folder, orders) -> str:
    day = datetime(1997, 1, 2)
    lines = [(1, 1, day), (1, 2, datetime(1997, 1, 5)), (2, 1, day), (None, 1, day), (9, 1, day)]
    spark.createDataFrame(
        [(k, n, 7, 5.0, 100.0, 0.1, "N", at) for k, n, at in lines],
        "l_orderkey int, l_linenumber int, l_partkey int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(7, "B", 9.5)], "p_partkey int, p_brand string, p_retailprice double") \
        .write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame(orders, "o_orderkey int, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_buckets_read_the_lines_once_and_keep_copies_of_orders(spark, tmp_path):
    first, later = datetime(1996, 12, 1), datetime(1996, 12, 9)
    sf = landed(spark, tmp_path, [(1, first), (1, first), (1, later), (2, None), (3, first), (None, first)])
    docs = raw.raw_transactions(spark, sf)
    leaves = docs._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert leaves.size() == 3  # lines, parts and orders
    got = docs.select("_id", F.get_json_object("data", "$.transaction_count").alias("n"), F.col("_fivetran_synced").alias("at"),
                      F.json_array_length(F.get_json_object("data", "$.transactions")).alias("listed")).collect()
    assert sorted(tuple(r) for r in got if r["_id"] == "T1-0") == [("T1-0", "2", first, 4), ("T1-0", "2", later, 2)]
    assert [tuple(r) for r in got if r["_id"] != "T1-0"] == [("T2-0", "1", None, 1)]


def test_two_runs_make_what_both_batches_share_once(spark, tmp_path, monkeypatch):
    """Who owns which accounts and which products an order has do not depend on the batch."""
    sf, day = str(tmp_path), datetime(1997, 1, 2)
    for name, schema, rows in [
            ("customer", "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
             [(0, "a", 1, 10.0, "BUILDING"), (1, "b", 2, 9000.0, "HOUSEHOLD"), (2, "c", 3, -5.0, "HOUSEHOLD"), (3, "d", 4, None, None)]),
            ("supplier", "s_suppkey bigint, s_name string, s_nationkey int", [(2, "s", 1)]),
            ("part", "p_partkey bigint, p_type string, p_brand string, p_retailprice double",
             [(7, "PROMO", "B", 9.5), (8, "SMALL", "B", 9.5), (None, "LARGE", "B", 9.5)]),
            ("orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
             " o_orderpriority string",
             [(1, 0, "O", 500.0, day, "1-URGENT"), (1, 0, "O", 500.0, day, "1-URGENT"), (2, 1, "F", 700.0, day, "5-LOW"),
              (3, 1, "P", None, day, "2-HIGH"), (4, None, "F", 1.0, None, "2-HIGH"), (5, 9, None, 1.0, day, None)]),
            ("lineitem", "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
             " l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
             [(k, p, 1, 1.0, 2.0, 0.1, "N", day) for k, p in [(1, 7), (1, 8), (1, 7), (2, 8), (3, None), (None, 7), (5, 6)]])]:
        spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{name}.parquet")
    made = {"accounts_of_owners": 0, "products_of_orders": 0}

    def counted(name, real):
        def call(*args):
            made[name] += 1
            return real(*args)
        return call

    for name in made:
        monkeypatch.setattr(raw, name, counted(name, getattr(raw, name)))
    loads = []
    monkeypatch.setattr(queries, "run_pipeline", lambda spark, store, found, run_ts: loads.append(found))
    queries._two_runs(spark, sf)
    assert made == {"accounts_of_owners": 1, "products_of_orders": 1} and len(loads) == 2
    for batch, found in enumerate(loads, 1):
        for name, make in [("customers", raw.raw_customers), ("accounts", raw.raw_accounts)]:
            assert sorted(map(texts, found[name].collect())) == sorted(map(texts, make(spark, sf, batch).collect()))


def texts(row) -> str:
    """A document as text, its accounts in order: a set has none."""
    data = json.loads(row["data"])
    if "accounts" in data:
        data["accounts"] = sorted(data["accounts"])
    return str((row["_id"], data, row["_fivetran_synced"], row["_fivetran_deleted"]))


@pytest.fixture()
def no_broadcast(spark):
    """Joins as large tables have them."""
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_products_of_an_order_are_aggregated_as_a_number(spark, tmp_path):
    lines = [(1, 1), (1, 2), (1, 1), (2, 3), (2, 4), (3, 1), (3, 9), (None, 1), (6, None)]
    spark.createDataFrame(lines, "l_orderkey int, l_partkey int").write.parquet(f"{tmp_path}/lineitem.parquet")
    kinds = [(1, "PROMO"), (2, "STANDARD"), (2, "SMALL"), (3, None), (4, "OTHER"), (None, "LARGE")]
    spark.createDataFrame(kinds, "p_partkey int, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k, "O", 250.0, "5-LOW") for k in (1, 2, 2, 3, 5, 6, None)],
                          "o_orderkey int, o_orderstatus string, o_totalprice double, o_orderpriority string") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    docs = raw.raw_accounts(spark, str(tmp_path))
    assert "collect_set" not in plan(docs)
    got = docs.select("_id", F.array_sort(F.from_json(F.get_json_object("data", "$.products"), "array<string>"))).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([
        ("A1", ["Derivatives", "InvestmentFund", "InvestmentStock"]), ("A2", []), ("A2", []), ("A3", ["Derivatives"]),
        ("A5", None), ("A6", None), (None, None)], key=str)


def test_large_joins_hash_the_smaller_side(spark, no_broadcast):
    many = spark.range(10_000).selectExpr("id % 50 as k", "id")
    few = spark.range(60).selectExpr("if(id = 3, null, id) as k", "id as name")
    joined = many.repartition(3).join(few.repartition(3), "k", "left")
    assert "ShuffledHashJoin" in executed(joined)
    assert joined.filter("name is null").count() == 200 and joined.count() == 10_000


def test_loaded_rows_meet_new_ones_without_a_join(spark):
    rows = [(1, None, "a"), (1, None, "b"), (1, None, "c"), (2, "x", "d"), (None, "y", "e"), (None, "y", "f")]
    new = spark.createDataFrame(rows, "id int, what string, run string")
    loaded = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (None, "y"), (5, "z")], "id int, what string")
    left = drop_loaded(new, loaded, ["id", "what"], "id")
    assert "Join" not in plan(left)
    assert sorted((tuple(r) for r in left.collect()), key=str) == [(1, None, "c"), (1, None, "c"), (None, "y", "f")]


def test_transaction_keys_are_made_once(spark):
    raw_docs = spark.createDataFrame([("T1", "{}", datetime(2024, 5, 1))], "_id string, data string, _fivetran_synced timestamp")
    assert plan(process_transactions(raw_docs)).count("decimal(38,0)") <= 1
