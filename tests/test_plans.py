"""Plans keep what large data needs: no cross joins, no single-task windows, no Python rows."""

from __future__ import annotations

import re
from datetime import date

import pytest

from sparkmart import schemas as S
from sparkmart.operators.dedup import latest_by_key
from sparkmart.operators.incremental import newer_than
from sparkmart.operators.lookup import account_bridge, junk_dimension, lookup_view
from sparkmart.plans import presentation as P
from sparkmart.plans.processed import (
    decode_transactions,
    process_accounts,
    process_customers,
)

DAY = date(2024, 5, 3)
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython",
             "MapInPandas", "FlatMapGroups", "PythonMapInArrow"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Empty tables on disk are enough to look at plans."""
    root = str(tmp_path_factory.mktemp("plans"))
    out = {}
    for name, schema in {
        "raw": S.ENVELOPE, "customer": S.PROCESSED_CUSTOMER, "account": S.PROCESSED_ACCOUNT,
        "transaction": S.PROCESSED_TRANSACTION, "dim_customer": S.DIM_CUSTOMER,
        "dim_account": S.DIM_ACCOUNT, "details": S.DIM_TRANSACTION_DETAILS,
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
        out[name] = spark.read.schema(schema).parquet(f"{root}/{name}")
    return out


@pytest.fixture(scope="module")
def plans(tables):
    t = tables
    fact = P.build_fact_transaction(
        t["transaction"], account_bridge(t["customer"]),
        lookup_view(t["dim_customer"], ["customer_bk"], "customer_sk"),
        lookup_view(t["dim_account"], ["account_id"], "account_sk"), t["details"], str(DAY))
    conf = t["raw"].sparkSession.conf  # empty tables would be broadcast
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact_plan = plan(fact)
    conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return {
        "customers": plan(process_customers(t["raw"])),
        "accounts": plan(process_accounts(t["raw"])),
        "transactions": plan(decode_transactions(t["raw"], "2024-05-01 00:00:00")),
        "dim_customer": plan(P.build_dim_customer(t["customer"], t["dim_customer"], DAY)),
        "dim_account": plan(P.build_dim_account(t["account"], t["dim_account"], DAY)),
        "details": plan(P.build_dim_transaction_details(t["transaction"], t["details"])),
        "fact": fact_plan,
    }


def test_no_cross_joins_and_no_python(plans):
    for name, text in plans.items():
        assert not [word for word in FORBIDDEN if word in text], name


def test_no_window_over_everything(plans):
    for name, text in plans.items():
        windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?),", text)
        assert all("_bucket" in first for first in windows), name


def test_single_partition_only_for_one_row_results(plans):
    for name, text in plans.items():
        for line, below in zip(text.splitlines(), text.splitlines()[1:]):
            if "Exchange SinglePartition" in line:
                assert "partial_max" in below, name


def test_decoding_needs_no_shuffle_and_happens_once(plans):
    for name in ("customers", "transactions"):
        assert "Exchange" not in plans[name]
        assert plans[name].count("from_json(") == 1, name


def test_marks_reach_the_scan(plans):
    scan = next(x for x in plans["transactions"].splitlines() if "FileScan" in x)
    assert "GreaterThan(_fivetran_synced,2024-05-01" in scan
    assert "ReadSchema: struct<data:string,_fivetran_synced:timestamp>" in scan


def test_marks_reach_the_scan_for_zoneless_timestamps(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([], "id int, at timestamp_ntz, rest string").write.parquet(path)
    text = plan(newer_than(spark.read.parquet(path), "at", "2024-05-01 00:00:00").select("id"))
    assert "GreaterThan(at,2024-05-01" in text and "cast(at" not in text
    assert "ReadSchema: struct<id:int,at:timestamp_ntz>" in text


def test_fact_reads_only_what_it_needs(plans):
    assert "struct<id:string,account_id:int>" in plans["fact"]
    assert "total_price" not in plans["fact"] and "bucket_start_date" not in plans["fact"]


def test_transactions_are_shuffled_once(plans):
    wide = [x for x in plans["fact"].splitlines() if "Exchange hashpartitioning(account_id" in x]
    lines = plans["fact"].splitlines()
    moved = [i for i, x in enumerate(lines) if x in wide and "unit_price" in lines[i + 1]]
    assert len(moved) == 1


def test_aggregates_combine_before_the_shuffle(plans, tables):
    assert re.search(r"HashAggregate\(keys=\[id#.*partial_max\(\(tier#", plans["dim_customer"])
    newest = plan(latest_by_key(tables["account"], ["account_id"], "ingest_date", ["id"]))
    assert "partial_min" in newest and "Window" not in newest
    pairs = plan(junk_dimension(tables["transaction"], "transaction_type", "symbol"))
    assert "Join" not in pairs and pairs.count("FileScan") == 1


def test_a_merge_runs_its_inputs_once_and_shuffles_each_once(plans):
    """Target and update meet in one aggregate; numbering the new keys needs no further shuffle."""
    for name in ("dim_account", "details"):
        assert "Join" not in plans[name], name
        assert len(re.findall(r"Exchange hashpartitioning\(_dealt", plans[name])) == 1, name
        assert "REPARTITION_BY_COL" in plans[name], name
    assert plans["dim_account"].count("FileScan") == 3 + 1  # account, current rows, history; largest key
