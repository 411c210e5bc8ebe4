"""Session settings that the jobs rely on."""

from __future__ import annotations

import time

from sparkmart.session import DROP_SHUFFLES, prepare, shuffles_dropped, staged


def test_methods_too_long_to_be_compiled_are_not_made(spark):
    """The JVM compiles no method above 8,000 bytes; Spark's own limit is eight times that."""
    assert int(prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_small_partitions_are_joined_into_tasks_that_stay_small(spark):
    assert prepare(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def shuffled_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_the_shuffles_of_a_staged_table_go_when_it_is_written(spark):
    before = shuffled_files(spark)
    frame = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    written = staged(frame)  # the frame is still there: nothing is left to be collected as garbage
    until = time.time() + 20
    while shuffled_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled_files(spark) - before
    assert sorted(written.collect()) == sorted(frame.collect())


def test_shuffles_stay_for_frames_outside_the_block(spark):
    known = spark.conf.get(DROP_SHUFFLES)
    with shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(DROP_SHUFFLES) == "true"
    assert spark.conf.get(DROP_SHUFFLES) == known == "false"
