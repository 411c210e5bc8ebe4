"""Substring dedup by sliding sentence spans (operator 2).

Every sentence starts a span: itself and the sentences after it, at least two and as many as it
takes to reach twenty words.  Spans are hashed and joined over all documents, and the sentences of
every span that is not its hash's first one are removed.

Sentences alone miss what has no full stops, so words are also cut at content-defined places: a
*unit* starts at every sentence and at every word that has, with the word after it, the smallest hash
of some window of eight words.  Spans of units start at rows and at the smallest hashes of windows of
sixteen.  In a passage of 51 equal words or more the first sixteen choose a start, and the span from
there ends eight words before the passage does or earlier, at the same place in all copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import in_small_batches, row_slices, text_buffer
from sparkmart.llm.hashing import Words, mix, range_hash, words
from sparkmart.llm.suffixes import _slide

MIN_SENTENCES, MIN_WORDS, ENDS, BEGINS = 2, 20, 8, 16
UNIT = np.uint64(0x94D049BB133111EB)
_close = np.zeros(256, bool)
_close[[ord(c) for c in ".!?"]] = True


def _stops(buf: np.ndarray) -> np.ndarray:
    """Is there a full-width stop just before each place?"""
    out = np.zeros(len(buf) + 1, bool)
    for stop in "。！？｡":
        a, b, c = stop.encode()
        out[3:] |= (buf[:-2] == a) & (buf[1:-1] == b) & (buf[2:] == c) if len(buf) > 2 else False
    return out


def cut_words(buf: np.ndarray, offs: np.ndarray) -> Words:
    """Words that also end after a full-width stop, as no blank follows there."""
    at = np.flatnonzero(_stops(buf))
    if not len(at):
        return words(buf, offs)
    w = words(buf, np.unique(np.r_[offs, at]))
    first = np.searchsorted(w.start, offs)
    return Words(w.start, w.end, w.hash, np.repeat(np.arange(len(offs) - 1), np.diff(first)), first)


def _weights(w: Words, buf: np.ndarray) -> np.ndarray:
    """Running number of words; two ideographs or kana count as one, as no blanks part them."""
    wide = np.r_[0, np.cumsum((buf >= 0xE3) & (buf <= 0xE9))]
    return np.r_[0, np.cumsum(np.maximum(1, (wide[w.end] - wide[w.start]) // 2))]


def _chosen(h: np.ndarray, row: np.ndarray, window: int) -> np.ndarray:
    """Is the hash the smallest of some window of so many words?"""
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(len(h), bool)
    least = _slide(h, window, np.minimum)
    least[row[:n] != row[window - 1:]] = 0  # windows over two rows choose nothing
    pad = np.zeros(window - 1, np.uint64)
    return _slide(np.concatenate([pad, least, pad]), window, np.maximum) == h


def unit_starts(w: Words, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the units, and whether a span starts there."""
    after = np.zeros(len(w.hash), np.uint64)
    after[:-1] = np.where(w.row[1:] == w.row[:-1], w.hash[1:], 0)
    h = mix(w.hash * UNIT + after) | np.uint64(1)
    begins = _chosen(h, w.row, BEGINS)
    units = np.union1d(starts, np.flatnonzero(_chosen(h, w.row, ENDS) | begins))
    begins[w.first[:-1][np.diff(w.first) > 0]] = True
    return units, begins[units]


def sentence_starts(w: Words, buf: np.ndarray) -> np.ndarray:
    """First word of each sentence: after a word that ends in . ! or ? or a full-width stop,
    after a line break, and at the start of a row."""
    if not len(w.start):
        return np.empty(0, np.int64)
    breaks = np.r_[0, np.cumsum(buf == 10)]
    new = np.ones(len(w.start), bool)
    new[1:] = (_close[buf[w.end[:-1] - 1]] | _stops(buf)[w.end[:-1]] | (breaks[w.start[1:]] > breaks[w.end[:-1]])
               | (w.row[1:] != w.row[:-1]))
    return np.flatnonzero(new)


def spans(w: Words, weight: np.ndarray, starts: np.ndarray, min_sentences: int, min_words: int,
          begins: np.ndarray | None = None):
    """(hash, row, first sentence within the row, number of sentences) of every span; ``starts``
    are those of sentences or of units, and ``begins`` tells which of them start a span."""
    if not len(starts):
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 4
    row = w.row[starts]
    ends = np.r_[starts[1:], len(w.start)]
    first = np.searchsorted(row, np.arange(len(w.first) - 1))
    index = np.arange(len(starts))
    last = np.maximum(index + min_sentences - 1, np.searchsorted(weight[ends], weight[starts] + min_words))
    limit = np.searchsorted(row, row, "right")  # one past the row's last sentence
    at = np.flatnonzero(last < limit if begins is None else (last < limit) & begins)
    return (range_hash(w.hash, starts[at], ends[last[at]]), row[at], index[at] - first[row[at]],
            last[at] - index[at] + 1, first)


def _first_in_row(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Is the span the first with its hash in its row?  Spans come in text order."""
    return _first_of(h, row) == np.arange(len(h))


def _first_of(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The first span with the same hash in the same row, for every span."""
    order = np.lexsort((np.arange(len(h)), h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    out = np.empty(len(h), np.int64)
    out[order] = order[new][np.cumsum(new) - 1] if len(h) else order
    return out


def _both(w: Words, buf: np.ndarray, min_sentences: int, min_words: int):
    """(starts, spans) of the sentences and of the units; hashes of the two kinds never meet."""
    weight, starts = _weights(w, buf), sentence_starts(w, buf)
    units, begins = unit_starts(w, starts)
    of_units = spans(w, weight, units, 2, min_words, begins)
    return (starts, spans(w, weight, starts, min_sentences, min_words)), (
        units, (mix(of_units[0] ^ UNIT), *of_units[1:]))


def _emit(min_sentences: int, min_words: int):
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column("text"))
            rid, doc = batch.column("_rid"), batch.column("doc_id")
            for lo, hi in row_slices(offs, 2 << 20):
                part = buf[offs[lo]:offs[hi]]
                w = cut_words(part, offs[lo:hi + 1] - offs[lo])
                for unit, (_, (h, row, pos, n, _)) in enumerate(_both(w, part, min_sentences, min_words)):
                    keep = _first_in_row(h, row)
                    take = pa.array(row[keep] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[keep].view(np.int64)), doc.take(take), rid.take(take),
                         pa.array(pos[keep].astype(np.int32)), pa.array(n[keep].astype(np.int32)),
                         pa.array(np.full(int(keep.sum()), bool(unit)))],
                        names=["h", "doc_id", "_rid", "pos", "n", "unit"])
    return run


def _dropped(kind, unit: bool, covers, lo: int, hi: int) -> np.ndarray:
    """Which sentences, or units, a later span covers; units never go for a copy they overlap."""
    starts, (h, row, pos, n, first) = kind
    edge = np.zeros(len(starts) + 1, np.int64)
    if not len(starts):
        return np.empty(0, bool)
    of = _first_of(h, row)
    again = pos >= pos[of] + n[of] if unit else of != np.arange(len(h))
    at = pos[again] + first[row[again]]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n[again], -1)
    for i in range(lo, hi):
        if covers[i].is_valid:
            for c in covers[i].values.to_pylist():
                if c["unit"] == unit:
                    at = c["pos"] + first[i - lo]
                    edge[at] += 1
                    edge[at + c["n"]] -= 1
    return np.cumsum(edge[:-1]) > 0


def _apply(min_sentences: int, min_words: int):
    def run(batches):
        for batch in batches:
            column = batch.column("text")
            buf, offs = text_buffer(column)
            covers = batch.column("_covers")
            total = np.zeros(batch.num_rows, np.int64)
            gone, words_gone = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            texts = []
            for lo, hi in row_slices(offs, 2 << 20):
                part = buf[offs[lo]:offs[hi]]
                begin = offs[lo:hi + 1] - offs[lo]
                w = cut_words(part, begin)
                of_sentences, of_units = _both(w, part, min_sentences, min_words)
                lost = _dropped(of_sentences, False, covers, lo, hi)
                drop = _dropped(of_units, True, covers, lo, hi)
                starts, units = of_sentences[0], of_units[0]
                owner = w.row[units]
                if len(starts):
                    drop |= lost[np.searchsorted(starts, units, "right") - 1]
                    total[lo:hi] = np.bincount(w.row[starts], minlength=hi - lo)
                    gone[lo:hi] = np.bincount(w.row[starts][lost], minlength=hi - lo)
                less = np.bincount(owner[drop], minlength=hi - lo)
                width = np.diff(np.r_[units, len(w.start)])
                words_gone[lo:hi] = np.bincount(owner[drop], width[drop], hi - lo)
                for i in range(lo, hi):
                    if not less[i - lo]:
                        texts.append(column[i].as_py())
                        continue
                    a, b = np.searchsorted(owner, [i - lo, i - lo + 1])
                    cut = np.r_[begin[i - lo], w.start[units[a + 1:b]], begin[i - lo + 1]]
                    texts.append(b"".join(
                        part[cut[k]:cut[k + 1]].tobytes() for k in range(b - a) if not drop[a + k]
                    ).decode())
            names = [c for c in batch.schema.names if c not in ("_covers", "text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(texts, pa.string()), pa.array(total),
                 pa.array(gone), pa.array(words_gone)],
                names=[*names, "text", "n_sentences", "n_removed", "n_words_removed"])
    return run


def dedup_sentences(docs: DataFrame, min_sentences: int = MIN_SENTENCES,
                    min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without repeated spans, n_sentences, n_removed, n_words_removed: one row per row
    of ``docs``.

    ``n_removed`` counts the sentences of repeated sentence spans; words that go with spans of
    units only leave the text as well, and ``n_words_removed`` counts all words that do.

    The first span of a hash is that of the smallest doc_id (NULL before all), then of the
    earlier row and place; all others are removed with their sentences, also within a document.
    Words are compared with ASCII letters in lower case and white space as one blank.  A NULL
    text stays NULL, a text without words is left alone; other columns are ignored.  ``docs``
    must be a table that reads the same twice, rows included.
    """
    rows = in_small_batches(docs.select("doc_id", "text")).withColumn("_rid", F.monotonically_increasing_id())
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_emit(min_sentences, min_words),
                            f"h bigint, doc_id {doc_type}, _rid bigint, pos int, n int, unit boolean")
    first = (
        found.groupBy("h").agg(F.min(F.struct("doc_id", "_rid")).alias("_first"),
                               F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1").select("h", F.col("_first._rid").alias("_keep"))
    )
    covers = (
        found.join(first, "h").filter("_rid <> _keep").groupBy("_rid")
        .agg(F.collect_list(F.struct("pos", "n", "unit")).alias("_covers"))
    )
    return rows.join(covers, "_rid", "left").drop("_rid").mapInArrow(
        _apply(min_sentences, min_words),
        f"doc_id {doc_type}, text string, n_sentences bigint, n_removed bigint, n_words_removed bigint")
