"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm.alignment import align_documents
from sparkmart.llm.chat import chat_sql, format_conversations
from sparkmart.llm.common import read
from sparkmart.llm.credentials import scan_secrets
from sparkmart.llm.jaccard import jaccard_join, jaccard_sql
from sparkmart.llm.language import identify
from sparkmart.llm.mixing import mix_sources, mixing_sql
from sparkmart.llm.pseudonyms import pseudonymise
from sparkmart.llm.quality import classify
from sparkmart.llm.repair import repair_report
from sparkmart.llm.sentences import dedup_sentences
from sparkmart.llm.suffixes import dedup_suffixes
from sparkmart.llm.tiling import contaminated_pairs
from sparkmart.llm.vectors import near_vectors, near_vectors_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_sentence_spans(spark, sf_dir):
    return dedup_sentences(read(spark, sf_dir, "documents"))


@query
def op3_linked_secrets(spark, sf_dir):
    return scan_secrets(read(spark, sf_dir, "documents"))


@query
def op4_mix_sources(spark, sf_dir):
    return mix_sources(read(spark, sf_dir, "documents")).drop("source")


ORACLE["op4_mix_sources"] = mixing_sql()


#: For the registered query alone: a key in the source protects nothing.
TEST_KEY = "sparkmart"


@query
def op5_feistel_pseudonyms(spark, sf_dir):
    return pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY)


@query
def op6_jaccard_join(spark, sf_dir):
    return jaccard_join(read(spark, sf_dir, "documents"))


ORACLE["op6_jaccard_join"] = jaccard_sql()


@query
def op9_string_tiling(spark, sf_dir):
    return contaminated_pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("_rid")


@query
def op10_attention_quality(spark, sf_dir):
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op8_language_bitmasks(spark, sf_dir):
    return identify(read(spark, sf_dir, "documents"))


@query
def op1_collision_counting(spark, sf_dir):
    return near_vectors(read(spark, sf_dir, "embeddings"))


ORACLE["op1_collision_counting"] = near_vectors_sql()


@query
def op7_deep_shallow_suffixes(spark, sf_dir):
    return dedup_suffixes(read(spark, sf_dir, "documents"))


@query
def op11_prefix_doubling_repair(spark, sf_dir):
    return repair_report(read(spark, sf_dir, "conversations"))


@query
def op12_interval_coalescing(spark, sf_dir):
    return align_documents(read(spark, sf_dir, "documents"))


@query
def op13_reply_trees(spark, sf_dir):
    return format_conversations(read(spark, sf_dir, "conversations"))


ORACLE["op13_reply_trees"] = chat_sql()
