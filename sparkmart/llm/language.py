"""Language identification with language-bitmask n-gram filters (operator 8).

Byte n-grams of lower-case text are counted per language.  A bit-sliced Bloom filter keeps, for
each of its slots, one bit per language, so that two look-ups and an AND give all languages that
contain an n-gram.  A text's n-grams are looked up, each language's bits are counted, the counts
are corrected for the filter's false positives, and the language with the largest share wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import cut_slices, in_small_batches, text_buffer
from sparkmart.llm.hashing import mix

GRAM, SLICE = 4, 2 << 20
#: An n-gram belongs to a language that has it at least this often in its n-grams, which leaves
#: at most 20,000 per language, and at least this share as often as the language that has it most.
MIN_RATE, MIN_SHARE = 5e-5, 0.1
HELD_OUT = 2
#: Languages that are learned, those of most documents.
MOST_LANGUAGES = 256
SLOTS_PER_GRAM, LOOKUPS = 16, 2
U = np.uint64
_lower = np.arange(256, dtype=np.uint64)
_lower[65:91] += U(32)
_lower[[9, 10, 11, 12, 13]] = U(32)


def grams(buf: np.ndarray, offs: np.ndarray, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(code, row) of every byte n-gram without digits and signs that lies within a row."""
    n = len(buf) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    b = _lower[buf]
    plain = ((b >= 97) & (b <= 122)) | (b >= 128) | (b == 32)
    code = np.zeros(n, np.uint64)
    ok = np.ones(n, bool)
    for k in range(size):
        code = (code << U(8)) | b[k:k + n]
        ok &= plain[k:k + n]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    ok &= row[:n] == row[size - 1:]
    return code[ok], row[:n][ok]


def _count(size: int, slice_bytes: int):
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column("text"))
            lang = batch.column("lang").dictionary_encode()
            index = np.asarray(lang.indices.to_numpy(zero_copy_only=False), np.int64)
            for part, at, rows in cut_slices(buf, offs, slice_bytes, size - 1):
                code, row = grams(part, at, size)
                of = index[rows][row]
                for k in range(len(lang.dictionary)):
                    value, n = np.unique(code[of == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang.dictionary[k].as_py()] * len(value), pa.string()),
                         pa.array(value.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
    return run


def gram_rates(docs: DataFrame, size: int = GRAM, slice_bytes: int = SLICE) -> DataFrame:
    """(lang, gram, rate) of the n-grams that belong to a language, counted over all of ``docs``."""
    counts = (
        in_small_batches(docs.filter("lang is not null and text is not null").select("lang", "text"))
        .mapInArrow(_count(size, slice_bytes), "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total")).filter(
        F.col("rate") >= MIN_RATE)
    most = kept.groupBy("gram").agg(F.max("rate").alias("most"))
    return kept.join(most, "gram").filter(F.col("rate") >= MIN_SHARE * F.col("most")).select(
        "lang", "gram", "rate")


@dataclass
class LanguageFilter:
    """The bit-sliced filter: ``slots[s, w]`` has bit ``l % 64`` for language ``l``, ``w = l // 64``."""

    languages: list[str]
    slots: np.ndarray
    fill: np.ndarray
    size: int

    @classmethod
    def build(cls, languages: list[str], of: np.ndarray, codes: np.ndarray, size: int = GRAM):
        most = int(np.bincount(of, minlength=1).max(initial=1))
        n = 1 << max(6, int(most * SLOTS_PER_GRAM - 1).bit_length())
        slots = np.zeros((n, len(languages) // 64 + 1), np.uint64)
        for k in range(LOOKUPS):
            np.bitwise_or.at(slots, (cls._slot(codes, k, n), of // 64), U(1) << (of % 64).astype(np.uint64))
        fill = np.array([((slots[:, i // 64] >> U(i % 64)) & U(1)).mean() for i in range(len(languages))])
        return cls(languages, slots, fill, size)

    @staticmethod
    def _slot(codes: np.ndarray, k: int, n: int) -> np.ndarray:
        return (mix(codes + U(0x9E3779B97F4A7C15 * (k + 1) % 2 ** 64)) & U(n - 1)).astype(np.int64)

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """All languages of each n-gram, as words of 64 bits."""
        out = self.slots[self._slot(codes, 0, len(self.slots))]
        for k in range(1, LOOKUPS):
            out = out & self.slots[self._slot(codes, k, len(self.slots))]
        return out

    def hits(self, codes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row the number of n-grams, and per row and language of those the filter says it has."""
        masks = self.masks(codes)
        out = np.zeros((n, len(self.languages)))
        for i in range(len(self.languages)):
            hit = (masks[:, i // 64] >> U(i % 64)) & U(1)
            out[:, i] = np.bincount(row, hit.astype(float), n)
        return np.bincount(row, minlength=n), out

    def shares(self, total: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Per row and language the share of the row's n-grams, less what false positives would give."""
        wrong = self.fill ** LOOKUPS
        share = hits / np.maximum(total, 1)[:, None]
        return np.clip((share - wrong) / np.maximum(1 - wrong, 1e-9), 0, 1)


def learn(docs: DataFrame, size: int = GRAM, languages: int = MOST_LANGUAGES,
          slice_bytes: int = SLICE) -> LanguageFilter:
    """The filter of the languages in ``lang``: the ``languages`` of most documents, ties by name.

    At most 20,000 n-grams of each come to the driver, which bounds the filter, whatever ``lang``
    holds.  A NULL doc_id is no matter here; NULL texts and languages teach nothing.
    """
    common = docs.filter("lang is not null and text is not null").groupBy("lang").count() \
        .orderBy(F.desc("count"), "lang").limit(languages)
    names = sorted(r["lang"] for r in common.collect())
    rows = gram_rates(docs.filter(F.col("lang").isin(*names)), size, slice_bytes).select("lang", "gram").toArrow()
    place = {name: i for i, name in enumerate(names)}
    of = np.array([place[x] for x in rows["lang"].to_pylist()], np.int64)
    return LanguageFilter.build(names, of, rows["gram"].to_numpy().astype(np.int64).view(np.uint64), size)


def _predict(found: LanguageFilter, slice_bytes: int):
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column("text"))
            total, hits = np.zeros(batch.num_rows), np.zeros((batch.num_rows, len(found.languages)))
            for part, at, rows in cut_slices(buf, offs, slice_bytes, found.size - 1):
                n, hit = found.hits(*grams(part, at, found.size), len(rows))
                total[rows] += n
                hits[rows] += hit
            shares = found.shares(total, hits)
            names = [found.languages[i] for i in shares.argmax(1)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "letters")], pa.array(names, pa.string()), pa.array(shares.max(1))],
                names=["doc_id", "letters", "lang_pred", "score"])
    return run


def predict_language(docs: DataFrame, found: LanguageFilter, slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, lang_pred, score: one row per row of ``docs``, from whole texts alone.

    ``und`` with score 0 where the text is NULL or has no letter, or no language was learned.  The
    score is the corrected share of the text's n-grams that the language has; of equal shares, and
    for texts too short for an n-gram, the first language by name wins.  Ids may be NULL or repeat, long
    texts are read in pieces, other columns are ignored.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    rows = in_small_batches(docs.select("doc_id", "text")).withColumn(
        "letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if not found.languages:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    out = rows.mapInArrow(_predict(found, slice_bytes), f"doc_id {doc_type}, letters boolean, lang_pred string, score double")
    return out.select("doc_id", F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
                      F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows that are not held out."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == HELD_OUT, F.lit(False))
    found = learn(docs.filter(~held))
    return predict_language(docs, found).select("doc_id", held.alias("held_out"), "lang_pred", "score")
