"""Edge rows that every operator must take: nulls, empty and long texts, ties, repeats, odd columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = (", rid bigint, h bigint, kind string, row int, _x string, component_id bigint, count bigint, "
         + ", ".join(f"`{n}` bigint" for n in ("_rid", "_score", "_order", "_hits", "_new", "_parts", "_spans", "_keep",
                                              "_hash", "_row", "_covers", "a.b", "src", "block", "y")))


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ter", "an", "su", "re", "to", "ni", "vel"]
    out = []
    for _ in range(n):
        out.append("".join(r.choice(syllables) for _ in range(r.randint(1, 4))))
        if r.random() < 0.1:
            out[-1] += r.choice([".", ".", "!", ".\n"])
    return " ".join(out)


def edge_rows() -> list[tuple]:
    shared = prose(1, 80)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, None),
        (4, "one", "en", "b"), (5, "One TWO three", "en", None), (6, "é ü ñ 漢字 🙂", "de", "é"),
        (7, shared, "en", "a"), (8, shared, "en", "a"), (9, shared.upper(), "en", "b"),
        (10, prose(2, 30) + " " + shared + " " + prose(3, 30), "fr", "c"),
        (11, prose(4, 20000), "fr", "a"), (12, prose(4, 20000) + " more", "fr", "a"),
        (None, prose(5, 50), None, "a"), (None, prose(5, 50), "en", "a"), (13, "x" * 200000, "en", "c"),
        (14, "a b c d e", "en", "a"), (15, "a b c d", "en", "a"), (16, "A  b\tC d E", "es", "a"),
    ]
    return rows + [rows[6], rows[9]]


def docs(spark: SparkSession, rows=None, extra: bool = True) -> DataFrame:
    rows = edge_rows() if rows is None else rows
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    if not extra:
        return spark.createDataFrame(full, SCHEMA)
    more = [(*r, 7, 8, "k", 9, "y", 10, 11, *(1000 * k + i for k in range(15))) for i, r in enumerate(full)]
    return spark.createDataFrame(more, SCHEMA + EXTRA)


def stored(spark: SparkSession, df: DataFrame, folder) -> DataFrame:
    path = str(folder / "docs.parquet")
    df.coalesce(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
