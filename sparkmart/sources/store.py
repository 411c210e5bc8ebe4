"""Parquet tables written run by run.

Every run of a table owns one folder ``<root>/<table>/run=<run id>``.  A run counts once its
``_SUCCESS`` file is there, so a half-written folder is never read, and writing the same run
again replaces just that folder.  Three ways to read follow from it:

* ``snapshot``: the newest run (full refresh),
* ``appended``: all runs together (incremental append),
* ``versions``: current rows of the newest run, closed rows of all runs (history is written
  once, when a version closes, and never rewritten).

Short lists the driver needs, such as manifests, are notes: JSON files beside the tables.

A table may keep rejected rows beside the accepted ones, in ``is_rejected=true``; ``snapshot`` reads
the accepted rows, ``rejected`` the others.  A table of versions may be bucketed by its key: a
manifest per run, in the table ``<table>_buckets``, says which run holds each bucket's current rows,
so a run writes the buckets that changed and refers to earlier runs for the rest.

Run ids must sort in time order as text; ``run_id_of`` makes such ids.
"""

from __future__ import annotations

import json
from datetime import datetime
from functools import cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


ROWS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 500_000, 16, 4096


class Bucket(NamedTuple):
    """Where the current rows of a bucket are, and what its last updates were."""

    bucket: int
    held_by: str
    n_buckets: int
    n_rows: int
    digest: str


def bucket_count(rows: int, before: dict[int, Bucket]) -> int:
    """Buckets for a table of about ``rows`` keys: those it has, unless they have grown too large."""
    wanted = LEAST_BUCKETS
    while wanted < MOST_BUCKETS and rows > wanted * ROWS_PER_BUCKET:
        wanted *= 2
    now = next(iter(before.values())).n_buckets if before else 0
    return now if wanted <= 4 * now else wanted


def bucket_digests(df: DataFrame, bucket: str) -> dict[int, tuple[int, str]]:
    """(rows, digest) of each bucket; the digest doesn't depend on the rows' order.

    One row per bucket comes to the driver, at most ``MOST_BUCKETS``.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c != bucket]
    h = F.xxhash64(*cols, *[c.isNull() for c in cols])  # a hash alone passes over NULLs
    rows = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"),
                                  F.bit_xor(h).alias("parity")).collect()
    return {r[0]: (r["n"], f"{r['n']}:{r['total']}:{r['parity']}") for r in rows}


def run_id_of(run_ts: datetime) -> str:
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


@cache
def declared(schema: str) -> StructType:
    return StructType.fromDDL(schema)


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], declared(schema))


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Project to the declared columns by name and cast to the declared types.

    Columns the frame lacks are NULL; columns the schema lacks are left out.
    """
    present = set(df.columns)
    return df.selectExpr(*[
        f"cast({f'`{f.name}`' if f.name in present else 'null'} as {f.dataType.simpleString()})"
        f" as `{f.name}`"
        for f in declared(schema).fields
    ])


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add the columns a writer has left out, with their default values."""
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- folders ---------------------------------------------------------------------------

    def _glob(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [str(status.getPath().toString()) for status in found or []]

    def runs(self, table: str, before: str | None = None) -> list[str]:
        """Complete runs, oldest first; with ``before`` only those of earlier run ids."""
        marks = self._glob(f"{self.root}/{table}/run=*/_SUCCESS")
        ids = sorted(mark.rsplit("/run=", 1)[1].removesuffix("/_SUCCESS") for mark in marks)
        return [run for run in ids if before is None or run < before]

    def _read(self, table: str, folders: list[str], schema: str | None) -> DataFrame:
        if not folders:
            if schema is None:
                raise ValueError(f"table {table} has no rows and no declared schema")
            return empty_table(self.spark, schema)
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        if schema is None:
            return reader.option("mergeSchema", "true").parquet(*folders).drop("run")
        names = [f"`{name}`" for name in declared(schema).names]
        return reader.schema(declared(schema)).parquet(*folders).select(*names)

    def _parts(self, table: str, runs: list[str], part: str | None) -> list[str]:
        if part is None:
            return [f"{self.root}/{table}/run={run}" for run in runs]
        wanted = set(runs)
        found = self._glob(f"{self.root}/{table}/run=*/{part}")
        return [f for f in found if f.rsplit("/run=", 1)[1].split("/")[0] in wanted]

    # -- sinks -----------------------------------------------------------------------------

    def write_run(self, df: DataFrame, table: str, run_id: str,
                  schema: str | None = None, partition_by: str | list[str] | None = None) -> None:
        """Write one run.  With ``schema`` the frame is conformed to it first; without, the
        frame's own schema counts (a snapshot then replaces the schema, an append widens it).
        """
        out = df if schema is None else conform(df, schema)
        writer = out.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
        writer.parquet(f"{self.root}/{table}/run={run_id}")

    def ensure(self, table: str, run_id: str, build) -> None:
        """Create-if-missing: write ``build()`` unless the table has a complete run."""
        if not self.runs(table):
            self.write_run(build(), table, run_id)

    # -- scans -----------------------------------------------------------------------------

    def snapshot(self, table: str, schema: str | None = None,
                 before: str | None = None) -> DataFrame:
        """Rows of the newest run, less the rejected ones."""
        newest = self.runs(table, before)[-1:]
        if newest and self._glob(f"{self.root}/{table}/run={newest[0]}/is_rejected=*"):
            return self._read(table, self._parts(table, newest, "is_rejected=false"), schema)
        return self._read(table, self._parts(table, newest, None), schema)

    def rejected(self, table: str, schema: str, run: str | None = None) -> DataFrame:
        """Rejected rows of one run, or of all runs."""
        return self._read(table, self._parts(table, [run] if run else self.runs(table), "is_rejected=true"), schema)

    def appended(self, table: str, schema: str | None = None, before: str | None = None,
                 after: str | None = None, part: str | None = None) -> DataFrame:
        """Rows of all runs; ``part`` (``name=value``) reads just that part of each run.

        With a declared schema no file footers are merged.  ``after`` leaves out whole run
        folders, before Spark lists their files.
        """
        runs = [r for r in self.runs(table, before) if after is None or r > after]
        return self._read(table, self._parts(table, runs, part), schema)

    def run_rows(self, table: str, run: str, schema: str, part: str | None = None) -> DataFrame:
        """Rows of one run."""
        return self._read(table, self._parts(table, [run], part), schema)

    def versions(self, table: str, schema: str, before: str | None = None) -> DataFrame:
        runs = self.runs(table, before)
        current = self._current_folders(table, runs[-1:])
        return self._read(table, current + self._parts(table, runs, "is_current=false"), schema)

    def current(self, table: str, schema: str, before: str | None = None,
                buckets: set[int] | None = None) -> DataFrame:
        """Current rows; of a bucketed table perhaps only those of some ``buckets``."""
        newest = self.runs(table, before)[-1:]
        return self._read(table, self._current_folders(table, newest, buckets), schema)

    # -- buckets ---------------------------------------------------------------------------

    def buckets(self, table: str, before: str | None = None) -> dict[int, Bucket]:
        """The manifest of the newest complete run; empty if there is none.

        At most ``MOST_BUCKETS`` short rows.
        """
        newest = self.runs(table, before)[-1:]
        rows = self.get_note(f"{table}_buckets", newest[0]) if newest else None
        return {r["bucket"]: Bucket(**r) for r in rows or []}

    def write_manifest(self, table: str, run_id: str, found: dict[int, Bucket]) -> None:
        """Say where the buckets' current rows are, before the run itself is written.

        A manifest counts only with its run, so one whose run broke off is never read.
        """
        self.put_note(f"{table}_buckets", run_id, [b._asdict() for b in found.values()])

    # -- notes: few short rows that the driver writes and reads itself, without a job -------

    def _note(self, name: str, run_id: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/run={run_id}/note.json")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put_note(self, name: str, run_id: str, rows: list[dict]) -> None:
        """Write ``rows`` as a file of JSON lines, whole or not at all."""
        path, fs = self._note(name, run_id)
        draft = path.suffix(".draft")
        out = fs.create(draft, True)
        out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows).encode()))
        out.close()
        fs.delete(path, False)
        fs.rename(draft, path)

    def get_note(self, name: str, run_id: str) -> list[dict] | None:
        path, fs = self._note(name, run_id)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return [json.loads(line) for line in text.splitlines()]

    def notes(self, name: str, schema: str, run: str | None = None) -> DataFrame:
        """The notes under ``name``, of one run or of all."""
        found = self._glob(f"{self.root}/{name}/run={run or '*'}/note.json")
        if not found:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(declared(schema)).json(found)

    def _current_folders(self, table: str, newest: list[str], buckets: set[int] | None = None) -> list[str]:
        found = self.buckets(table, before=None if not newest else newest[0] + "~")
        if not found:
            return self._parts(table, newest, "is_current=true")
        wanted = {(b.held_by, b.bucket) for b in found.values() if buckets is None or b.bucket in buckets}
        folders = []
        for run in sorted({run for run, _ in wanted}):
            for folder in self._glob(f"{self.root}/{table}/run={run}/is_current=true/bucket=*"):
                if (run, int(folder.rsplit("bucket=", 1)[1])) in wanted:
                    folders.append(folder)
        return folders
