from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkmart.sources.store import TableStore, conform, run_id_of, with_defaults

A, B, C = "20240503T0", "20240510T0", "20240517T0"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def test_absent_tables_are_empty_and_typed(store):
    assert store.runs("t") == []
    df = store.snapshot("t", "a int, b string")
    assert df.count() == 0 and df.dtypes == [("a", "int"), ("b", "string")]
    assert store.appended("t", "a int").count() == store.versions("t", "a int").count() == 0
    with pytest.raises(ValueError):
        store.snapshot("t")


def test_snapshot_reads_the_newest_run_and_may_change_schema(spark, store):
    store.write_run(spark.range(3), "t", A)
    store.write_run(spark.range(2).select(F.col("id").cast("string").alias("name")), "t", B)
    assert store.snapshot("t").columns == ["name"]
    assert store.snapshot("t").count() == 2
    assert store.snapshot("t", before=B).columns == ["id"]


def test_q21_snapshot_keeps_a_declared_schema(spark, store):
    store.write_run(spark.range(2).withColumn("extra", F.lit(1)), "t", A, "note string, id int")
    got = store.snapshot("t")
    assert got.dtypes == [("note", "string"), ("id", "int")]
    assert store.snapshot("t", "id int, note string").dtypes[0] == ("id", "int")


def test_a_run_without_success_mark_does_not_count(spark, store, tmp_path):
    store.write_run(spark.range(3), "t", A)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(f"{store.root}/t/run={B}")
    assert store.runs("t") == [A]
    assert store.snapshot("t").count() == store.appended("t").count() == 3


def test_append_widens_by_name_and_repeats_replace(spark, store):
    store.write_run(spark.range(2), "t", A)
    wide = spark.range(5, 8).withColumn("x", F.lit("w"))
    store.write_run(wide, "t", B)
    store.write_run(wide, "t", B)
    got = store.appended("t")
    assert got.columns == ["id", "x"] and got.count() == 5
    assert got.filter("x is null").count() == 2
    assert store.appended("t", "id bigint", after=A).count() == 3
    assert store.appended("t", "id bigint", before=B).count() == 2


def test_versions_keep_history_of_all_runs(spark, store):
    schema = "id bigint, is_current boolean"

    def write(run, current, closed):
        rows = [(i, True) for i in current] + [(i, False) for i in closed]
        store.write_run(spark.createDataFrame(rows, schema), "t", run, schema, "is_current")

    write(A, [1, 2, 3], [])
    write(B, [2, 3, 4], [1])
    write(C, [3, 4], [2])
    got = store.versions("t", schema)
    assert got.dtypes == [("id", "bigint"), ("is_current", "boolean")]
    assert sorted(tuple(r) for r in got.collect()) == [(1, False), (2, False), (3, True), (4, True)]
    assert {r.id for r in store.current("t", schema).collect()} == {3, 4}
    assert {r.id for r in store.current("t", schema, before=C).collect()} == {2, 3, 4}


def test_ensure_builds_only_once(spark, store):
    store.ensure("t", A, lambda: spark.range(3))
    store.ensure("t", B, lambda: spark.range(9))
    assert store.snapshot("t").count() == 3 and store.runs("t") == [A]


def test_partitioned_writes_need_no_sort(spark, store):
    df = spark.range(10).withColumn("flag", F.col("id") > 4)
    store.write_run(df, "t", A, partition_by="flag")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "4"
    assert store.appended("t", "id bigint", part="flag=true").count() == 5


def test_conform_and_defaults(spark):
    df = spark.createDataFrame([(1, "2024-05-03", "x")], "a bigint, d string, junk string")
    got = conform(df, "d date, a int, `limit` int")
    assert got.dtypes == [("d", "date"), ("a", "int"), ("limit", "int")]
    stamped = with_defaults(df, {"a": F.lit(9), "t": F.lit("now")}).first()
    assert (stamped.a, stamped.t) == (1, "now")


def test_run_ids_sort_in_time_order():
    stamps = [datetime(2024, 5, 3), datetime(2024, 5, 3, 0, 0, 0, 1), datetime(2024, 12, 1)]
    ids = [run_id_of(s) for s in stamps]
    assert ids == sorted(ids) and len(set(ids)) == 3
