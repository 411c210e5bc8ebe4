"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of ``links`` (a, b) is connected with.

    Alternates two star steps until nothing changes: every node's larger neighbours, then its
    smaller ones, are hung on the smallest node around it.  Each round is a few equi-joins and
    minima with map-side combine, both steps in one job, and is written to the shared folder.
    """
    edges = staged(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    digest = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        n = now[0]
        if now == digest:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        digest = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), 2 * n)
