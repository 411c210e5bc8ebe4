"""Functions that return their input's rows leave its other columns alone, whatever their names."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmart.llm.credentials import redact
from sparkmart.llm.jaccard import one_per_component
from sparkmart.llm.pseudonyms import pseudonymise
from sparkmart.llm.quality import score_quality, train
from sparkmart.llm.tiling import decontaminate
from tests.llm.fixtures import docs, edge_rows, prose, stored

ROWS = edge_rows() + [(70, "Card 4111111111111111 here", "en", "a"), (71, "token = abcdefghijkl", "en", "a"),
                      (72, "AKIAABCDEFGHIJKL12", None, None)]


def others(df):
    """Rows without their text, which the function may change."""
    names = [c for c in docs_columns(df) if c != "text"]
    return Counter(tuple(r[c] for c in names) for r in df.collect())


def docs_columns(df):
    return [c for c in df.columns if c in COLUMNS]


COLUMNS: list[str] = []


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    df = stored(spark, docs(spark, ROWS).withColumn("n_card", F.lit(3)), tmp_path_factory.mktemp("columns"))
    COLUMNS[:] = df.columns
    return df


def test_redact(table):
    out = redact(table)
    assert out.columns == table.columns and others(out) == others(table)


def test_pseudonymise(table):
    out = pseudonymise(table, "k3y")
    assert out.columns == [*table.columns, "n_email", "n_date", "n_ssn", "n_ip", "n_phone", "_n_card"]
    assert others(out) == others(table)
    assert {r["doc_id"]: r["_n_card"] for r in out.collect()}[70] == 1


def test_decontaminate(spark, table):
    items = spark.createDataFrame([(1, prose(1, 80), 5), (2, None, 6)], "item_id bigint, text string, _rid bigint")
    out = decontaminate(table, items)
    gone = others(table) - others(out)
    assert out.columns == table.columns and not others(out) - others(table)
    assert {key[0] for key in gone} == {7, 8, 9, 10}


def test_one_per_component(table):
    out = one_per_component(table)
    assert out.columns == table.columns and not others(out) - others(table)
    gone = others(table) - others(out)
    assert {8, 9, 12} <= {key[0] for key in gone} <= {None, 7, 8, 9, 10, 12, 16}


def test_score_quality(spark, table):
    labels = spark.createDataFrame([(i, i % 2, 1, 2) for i in range(90)], "doc_id bigint, quality int, y int, `a.b` int")
    model = train(table, labels)
    out = score_quality(table, model, "_p")
    assert out.columns == [*table.columns, "_p"] and others(out) == others(table)
    with pytest.raises(ValueError, match="_score"):
        score_quality(table, model)
