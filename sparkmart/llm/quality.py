"""Quality classifier: attention-based multiple-instance learning (operator 10).

A document is a bag of passages of fifty words.  Every passage is encoded, gated attention
weights are learned from the documents' labels alone, and the weighted sum of the encodings is
scored.  The model is fitted on a bounded sample of labelled documents; every passage of every
document is scored, in the tasks that read it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkmart.llm.common import free_name, in_small_batches, row_slices, text_buffer, undotted
from sparkmart.llm.hashing import mix, words

PASSAGE, SAMPLE, THRESHOLD = 50, 3000, 0.3
#: Passages of the sample, about 40 MB of features.
PASSAGES = 200_000
HIDDEN, GATE, EPOCHS, RATE = 24, 12, 150, 0.01


def _byte_classes() -> np.ndarray:
    """Each ASCII sign is a class of its own; letters, digits, blanks and UTF-8 parts share some."""
    c = np.zeros(256, np.int64)
    for b in range(256):
        ch = chr(b)
        c[b] = (1 if "a" <= ch <= "z" else 2 if "A" <= ch <= "Z" else 3 if "0" <= ch <= "9" else
                4 if b == 32 else 5 if b == 10 else 6 if b < 32 or b == 127 else
                7 if 128 <= b < 192 else 8 if 192 <= b < 224 else 9 if b >= 224 else 10)
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    c[signs] = 10 + np.arange(len(signs))
    return c


CLASS = _byte_classes()
N_CLASSES = int(CLASS.max()) + 1
N_FEATURES = N_CLASSES + 6


def encode(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, features) of every passage; rows without words have none."""
    w = words(buf, offs)
    if not len(w.start):
        return np.empty(0, np.int64), np.empty((0, N_FEATURES), np.float32)
    nth = np.arange(len(w.start)) - np.repeat(w.first[:-1], np.diff(w.first))
    lead = np.flatnonzero(nth % PASSAGE == 0)
    passage = np.cumsum(nth % PASSAGE == 0) - 1
    n = len(lead)
    last = np.r_[lead[1:], len(w.start)] - 1
    size = (last - lead + 1).astype(np.float32)
    width = w.end[last] - w.start[lead]
    inside = np.zeros(len(buf) + 1, np.int64)
    inside[w.start[lead]] = 1
    ends = np.zeros(len(buf) + 1, np.int64)
    np.add.at(ends, w.end[last], 1)
    of = np.cumsum(inside)[:-1]
    body = of - np.cumsum(ends)[:-1] > 0
    hist = np.bincount((of[body] - 1) * N_CLASSES + CLASS[buf[body]], minlength=n * N_CLASSES)
    out = np.empty((n, N_FEATURES), np.float32)
    out[:, :N_CLASSES] = np.sqrt(hist.reshape(n, N_CLASSES) / width[:, None])
    length = (w.end - w.start).astype(np.float32)
    edge = CLASS[buf[w.end - 1]]

    def share(x):
        return np.bincount(passage, x, n) / size

    distinct = np.unique((passage.astype(np.uint64) << np.uint64(36)) | (mix(w.hash) >> np.uint64(28)))
    unique = np.bincount((distinct >> np.uint64(36)).astype(np.int64), minlength=n) / size
    mean = share(length)
    out[:, N_CLASSES:] = np.stack([
        np.log1p(mean), np.log1p(np.sqrt(np.maximum(share(length ** 2) - mean ** 2, 0))),
        share(CLASS[buf[w.start]] == 2), share((edge > 9) | (edge == 3)), unique,
        np.log(size) / np.log(PASSAGE)], axis=1)
    return w.row[lead], out


@dataclass
class Model:
    """Weights of the network; ``prior`` scores texts without passages."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float

    def scores(self, rows: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.prior)
        if len(rows) and self.weights:
            start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            z = _forward(self.weights, (x - self.mean) / self.scale, start)["logit"]
            out[rows[start]] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _forward(p: dict, x: np.ndarray, start: np.ndarray) -> dict:
    """Bags are consecutive rows of ``x`` from each ``start``."""
    bag = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(x)]))
    h = np.tanh(x @ p["W"] + p["b"])
    a, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (a * g) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, start)[bag])
    att = e / np.add.reduceat(e, start)[bag]
    z = np.add.reduceat(att[:, None] * h, start, axis=0)
    return {"bag": bag, "h": h, "a": a, "g": g, "att": att, "z": z, "logit": z @ p["c"] + p["d"][0]}


def fit(rows: np.ndarray, x: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
    """Fit on passages ``x`` of documents ``rows`` (ascending) with labels ``y`` by document."""
    prior = float(y.mean()) if len(y) else 0.5
    if not len(rows) or prior in (0.0, 1.0):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, prior)
    mean, scale = x.mean(0), np.maximum(x.std(0), 0.02)
    x = ((x - mean) / scale).astype(np.float32)
    start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    y = y[rows[start]].astype(np.float32)
    r = np.random.default_rng(seed)
    p = {k: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) for k, s in {
        "W": (N_FEATURES, HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,)}.items()}
    p |= {"b": np.zeros(HIDDEN, np.float32), "d": np.zeros(1, np.float32)}
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        f = _forward(p, x, start)
        h, a, g, att, bag = f["h"], f["a"], f["g"], f["att"], f["bag"]
        ds = ((1 / (1 + np.exp(-f["logit"])) - y) / len(y)).astype(np.float32)
        dz = (ds[:, None] * p["c"])[bag]
        da = (h * dz).sum(1)
        de = att * (da - np.add.reduceat(att * da, start)[bag])
        dag = de[:, None] * p["w"]
        d_a, d_g = dag * g * (1 - a * a), dag * a * g * (1 - g)
        pre = (att[:, None] * dz + d_a @ p["V"].T + d_g @ p["U"].T) * (1 - h * h)
        grad = {"W": x.T @ pre, "b": pre.sum(0), "V": h.T @ d_a, "U": h.T @ d_g,
                "w": (a * g).T @ de, "c": f["z"].T @ ds, "d": ds.sum(keepdims=True)}
        for k in p:
            d = grad[k] + 1e-4 * p[k]
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.999 * v[k] + 0.001 * d * d
            p[k] = (p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                    ).astype(np.float32)
    return Model(mean.astype(np.float32), scale.astype(np.float32), p, prior)


def _encoded(batches):
    for batch in batches:
        buf, offs = text_buffer(batch.column("text"))
        blobs = [b""] * batch.num_rows
        for lo, hi in row_slices(offs, 2 << 20):
            row, x = encode(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
            cut = np.searchsorted(row, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                blobs[lo + i] = x[cut[i]:cut[i + 1]].tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("_order"), batch.column("y"), pa.array(blobs, pa.binary())],
            names=["_order", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, passages: int = PASSAGES) -> Model:
    """Fit on at most ``sample`` labelled documents, those with the smallest keyed hash of doc_id.

    ``labels`` has doc_id and quality (0 or 1); several labels of a document are averaged, NULL
    ones ignored.  Without any label, or with one class only, all texts score the labels' mean.
    Of these documents those are taken, whole and in the hash's order, that fit into ``passages``
    passages of 50 words together; a document too long for what is left is passed over.  That bounds
    what comes to the driver.  A NULL doc_id has no label.
    """
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).filter(~held)
        .groupBy("doc_id").agg(F.avg("quality").alias("y"))
        .withColumn("_order", order).orderBy("_order", "doc_id").limit(sample)
    )
    known = in_small_batches(docs.select("doc_id", "text")).join(F.broadcast(chosen), "doc_id")
    size = F.ceil(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) / PASSAGE) + 1
    sizes = known.groupBy("_order", "doc_id").agg(F.sum(size).alias("n")).collect()  # at most ``sample`` rows
    left, taken = passages, []
    for r in sorted(sizes):
        if r["n"] <= left:
            left -= r["n"]
            taken.append(r["doc_id"])
    rows = known.filter(F.col("doc_id").isin(*taken)).mapInArrow(_encoded, "_order bigint, y double, x binary").toArrow()
    got = sorted(zip(rows["_order"].to_pylist(), rows["x"].to_pylist(), rows["y"].to_pylist(), strict=True))
    parts = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for _, x, _ in got]
    x = np.concatenate(parts) if parts else np.empty((0, N_FEATURES), np.float32)
    return fit(np.repeat(np.arange(len(parts)), [len(q) for q in parts]), x, np.array([y for *_, y in got]))


def _scored(model: Model, name: str):
    def run(batches):
        for batch in batches:
            buf, offs = text_buffer(batch.column(batch.schema.names.index("text")))
            out = np.empty(batch.num_rows)
            for lo, hi in row_slices(offs, 2 << 20):
                row, x = encode(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                out[lo:hi] = model.scores(row, x, hi - lo)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)],
                                             names=[*batch.schema.names, name])
    return run


def score_quality(docs: DataFrame, model: Model, name: str = "_score") -> DataFrame:
    """``docs`` with the probability of label 1 as column ``name``; every row and column is kept.

    Only the text counts.  NULL texts and texts without words score the labels' mean.  ``name`` must
    not be a column already; ``common.free_name`` finds one that isn't.
    """
    if free_name(name, docs) != name:
        raise ValueError(f"there is a column {name} already")
    plain = undotted(docs)
    schema = StructType([*plain.schema.fields]).add(name, "double")
    return in_small_batches(plain).mapInArrow(_scored(model, name), schema).toDF(*docs.columns, name)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``, whole texts."""
    scored = score_quality(docs.select("doc_id", "text"), train(docs, labels))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"),
                         F.col("_score").alias("score"),
                         (F.col("_score") >= threshold).cast("int").alias("predicted"))
