"""Helpers shared by the operators: inputs, staged tables, size-checked semi joins."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.lookup import is_small


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local session without it uses this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = os.path.join(tempfile.gettempdir(), "sparkmart-work")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Rows a task writes when a staged table's size is known beforehand.
ROWS_PER_TASK = 10_000


def staged(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the table, which outlives executors.

    ``at_most`` bounds the rows of narrow tables; they are then written by so many tasks that each
    gets ``ROWS_PER_TASK`` of them, not by one per shuffle partition.  The shuffle files behind the
    table are of no use any more, so Spark is told to delete them then.
    """
    if at_most is not None:
        df = df.coalesce(1 + at_most // ROWS_PER_TASK)
    spark, path = df.sparkSession, work_folder(df.sparkSession)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name`` with as many underscores before it as keep it apart from the frames' columns."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(names: list[str]) -> list[str]:
    """Column names as they are, dots and blanks included."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def undotted(df: DataFrame) -> DataFrame:
    """``df`` with stand-ins for column names that ``mapInArrow`` would take for paths."""
    odd = {c: f"_c{i}" for i, c in enumerate(df.columns) if "." in c or "`" in c}
    while any(name in df.columns for name in odd.values()):
        odd = {c: "_" + name for c, name in odd.items()}
    return df.toDF(*[odd.get(c, c) for c in df.columns]) if odd else df


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids``; the ids are broadcast once measured as small."""
    return df.join(F.broadcast(ids) if is_small(ids) else ids, key, "left_semi")


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df`` unchanged; texts go to Python in batches of at most 500 rows and about 4 MB."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, NULL as empty, without copying the text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return whole[offs[0]:offs[-1]], offs - offs[0]


def row_slices(offs: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``max_bytes`` of text, or of one longer row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def cut_slices(buf: np.ndarray, offs: np.ndarray, max_bytes: int, overlap: int) -> Iterator[
        tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, rows) of row ranges as ``row_slices`` makes them, but a longer row comes in
    pieces that share ``overlap`` bytes, so that each run of ``overlap + 1`` bytes is in one piece."""
    for lo, hi in row_slices(offs, max_bytes):
        size = int(offs[hi] - offs[lo])
        if hi > lo + 1 or size <= max_bytes:
            yield buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], np.arange(lo, hi)
            continue
        for a in range(0, size, max_bytes):
            if not a or size - a > overlap:
                part = buf[offs[lo] + a:min(offs[lo] + a + max_bytes + overlap, offs[hi])]
                yield part, np.array([0, len(part)]), np.array([lo])
