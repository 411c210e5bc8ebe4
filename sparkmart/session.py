"""Session settings the operators rely on, and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Shuffled bytes of a partition that a join may hash; not below ``advisoryPartitionSizeInBytes``, or it has no effect.
HASHED_PARTITION = "64m"
#: Shuffled bytes that small partitions are joined up to: with more, the last few tasks of a step hold up the rest.
TASK_PARTITION = "16m"
#: Bytes of code that the JVM still compiles in one method; a longer one is interpreted, row by row.
COMPILED_METHOD = "8000"


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the jobs rely on.

    The session time zone is UTC, so that ISO strings with ``Z`` keep their calendar day.  Tables
    are partitioned by flags with two values; a task then keeps a file open for each of them,
    and need not sort its rows by the flag before it writes.

    A join of two shuffled sides hashes one whose partitions have all been measured to be at most
    ``HASHED_PARTITION``, instead of sorting both.

    Small shuffled partitions are joined up to ``TASK_PARTITION``, so that a step has several tasks for each core.
    Steps that Spark would fuse into a method of more than ``COMPILED_METHOD`` bytes stay apart, each of them compiled.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED_PARTITION)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_PARTITION)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor must be able to reach.

    Only a local session without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="sparkmart-")
    return f"{base.rstrip('/')}/sparkmart-{uuid.uuid4().hex}"


#: Setting by which the files of a statement's shuffles go when it ends, not when its plan is collected as garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Statements begun in this block remove their shuffled files when they end.

    Only for jobs that run their frames once: a frame collected again would have its shuffles made anew.
    """
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A shared folder for staged tables that nothing reads after the block; it is removed then."""
    folder = shared_folder(spark)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Use it where several jobs or branches read the same costly frame.  Unlike a cached frame
    the files outlive lost executors.  With ``folder`` the table is written below that one.
    """
    path = f"{folder}/{uuid.uuid4().hex}" if folder else shared_folder(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
