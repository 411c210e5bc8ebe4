"""The corpus pipeline: stages over ``documents``, each written and read again as the next one's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import free_name, read, staged
from sparkmart.llm.credentials import redact
from sparkmart.llm.jaccard import one_per_component
from sparkmart.llm.mixing import mix_sources
from sparkmart.llm.quality import THRESHOLD, score_quality, train
from sparkmart.llm.tiling import decontaminate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of ``docs``."""
    model, score = train(docs, read(spark, sf_dir, "labels")), free_name("_score", docs)
    return score_quality(docs, model, score).filter(F.col(score) >= THRESHOLD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return one_per_component(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold half of a benchmark item or more."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by the kind; ``n_chars`` follows the text."""
    clean = redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(kind))
    return clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix_sources(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("secrets", secrets), ("mix", mix)]
#: The first stage's network and the tiling can't be written in SQL; the tests use plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs)
    return docs
