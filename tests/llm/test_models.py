from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from sparkmart.llm import language, quality
from tests.llm.fixtures import docs, edge_rows, prose


def test_language_and_quality(spark):
    words = {"en": "the and with house water tree", "de": "der und mit haus wasser baum"}
    rows = [(1000 + k, " ".join((words[lang].split() * 9)[k % 5:]), lang, "a")
            for k in range(120) for lang in [("en", "de")[k % 2]]]
    df = docs(spark, rows + edge_rows())
    out = language.identify(df).collect()
    truth = {i: lang for i, _, lang, _ in rows}
    mine = [r for r in out if r.doc_id in truth]
    assert len(out) == len(rows) + len(edge_rows())
    assert all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in mine)
    assert {r.lang_pred for r in out if r.doc_id in (1, 2, 3)} == {"und"}
    assert language.identify(docs(spark, [])).count() == 0

    junk = [(i, t if k % 4 else t.upper().replace(" ", "!! ## "), lang, s)
            for k, (i, t, lang, s) in enumerate(rows)]
    labels = spark.createDataFrame([(i, int(k % 4 > 0)) for k, (i, *_) in enumerate(junk)],
                                   "doc_id bigint, quality int")
    df = docs(spark, junk + edge_rows())
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert all(got[i].predicted == int(k % 4 > 0) for k, (i, *_) in enumerate(junk))
    assert abs(got[2].score - got[1].score) < 1e-12 and all(0 <= r.score <= 1 for r in got.values())
    assert quality.classify(df, labels.limit(0)).count() == len(junk) + len(edge_rows())


def plain_grams(text, size=4):
    """Byte n-grams without digits and signs, A-Z in lower case, white space as a blank."""
    b = bytes(c + 32 if 65 <= c <= 90 else 32 if c in (9, 10, 11, 12, 13) else c for c in (text or "").encode())
    cut = [b[i:i + size] for i in range(len(b) - size + 1)]
    return [g for g in cut if all(97 <= c <= 122 or c >= 128 or c == 32 for c in g)]


def model_rows():
    r = random.Random(6)
    rows = [(k, prose(k, r.randint(1, 60)) + (" 12 éü" if k % 3 else ""), ["xx", "yy", "zz"][k % 3], "a") for k in range(60)]
    rows += [(k, prose(k % 2, 40).upper(), "xx", "a") for k in range(60, 70)]
    return [*rows, (None, prose(99, 500), "yy", "a"), (None, None, "yy", "a"), (71, "漢字 text", None, "a"), (72, "ab", "zz", "a")]


@pytest.mark.parametrize("slice_bytes", [2 << 20, 37])
def test_language_equals_plain_loops(spark, slice_bytes):
    rows = model_rows()
    df = docs(spark, rows)
    counts = {}
    for _, t, lang, _ in rows:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(t))
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    most = {}
    for c in rate.values():
        for g, x in c.items():
            most[g] = max(most.get(g, 0), x)
    want = {(lang, g) for lang, c in rate.items() for g, x in c.items()
            if x >= language.MIN_RATE and x >= language.MIN_SHARE * most[g]}
    got = language.gram_rates(df, slice_bytes=slice_bytes).collect()
    assert {(r.lang, r.gram.to_bytes(4, "big")) for r in got} == want
    found = language.learn(df, slice_bytes=slice_bytes)
    assert found.languages == ["xx", "yy", "zz"]
    # the corrected share is near the true one, and what the filter adds is taken off
    out = language.predict_language(df, found, slice_bytes=slice_bytes).collect()
    seen = {}
    for r in out:
        seen.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for i, t, _, _ in rows:
        if i is None or i == 71 or not plain_grams(t):
            continue
        grams = plain_grams(t)
        true = {lang: sum((lang, g) in want for g in grams) / len(grams) for lang in rate}
        (lang, score), = seen[i]
        assert score == pytest.approx(true[lang], abs=0.1) and true[lang] >= max(true.values()) - 0.1
        raw = {lang: 0 for lang in rate}
        for g in grams:
            mask = int(found.masks(np.array([int.from_bytes(g, "big")], np.uint64))[0, 0])
            for k, name in enumerate(found.languages):
                raw[name] += mask >> k & 1
        fixed = {name: min(1, max(0, (raw[name] / len(grams) - found.fill[k] ** 2) / (1 - found.fill[k] ** 2)))
                 for k, name in enumerate(found.languages)}
        assert score == pytest.approx(max(fixed.values()), abs=1e-12) and fixed[lang] == max(fixed.values())
    assert len(seen[None]) == 2 and ("und", 0.0) in seen[None]


def test_languages_are_bounded(spark):
    rows = [(k, prose(k, 30), f"l{k % 7}" if k > 9 else "l0", "a") for k in range(80)]
    found = language.learn(docs(spark, rows), languages=3)
    assert found.languages == ["l0", "l1", "l2"]


def test_quality_network_by_plain_loops():
    """One document's score, unit by unit."""
    r = np.random.default_rng(2)
    rows = np.repeat(np.arange(30), r.integers(1, 5, 30))
    x = r.standard_normal((len(rows), quality.N_FEATURES)).astype(np.float32)
    y = (np.arange(30) % 2).astype(float)
    x[:, 0] += 2 * y[rows]
    model = quality.fit(rows, x, y)
    got = model.scores(rows, x, 30)
    p = {k: w.astype(float).tolist() for k, w in model.weights.items()}
    for doc in (0, 7, 29):
        bag = ((x[rows == doc] - model.mean) / model.scale).astype(float).tolist()
        hidden, weight = [], []
        for v in bag:
            h = [math.tanh(sum(v[i] * p["W"][i][j] for i in range(len(v))) + p["b"][j]) for j in range(quality.HIDDEN)]
            e = sum(math.tanh(sum(h[i] * p["V"][i][k] for i in range(len(h)))) * p["w"][k]
                    / (1 + math.exp(-sum(h[i] * p["U"][i][k] for i in range(len(h))))) for k in range(quality.GATE))
            hidden.append(h)
            weight.append(math.exp(e))
        z = [sum(w * h[j] for w, h in zip(weight, hidden)) / sum(weight) for j in range(quality.HIDDEN)]
        logit = sum(a * b for a, b in zip(z, p["c"])) + p["d"][0]
        assert got[doc] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-4)
    assert ((got > 0.5) == (y > 0.5)).all()


def test_quality_sample_is_bounded_by_passages(spark):
    rows = [(k, prose(k, 20) if k % 2 else prose(k, 20).upper(), "en", "a") for k in range(1, 40)]
    rows += [(100, prose(5, 30_000), "en", "a"), (None, prose(6, 60), "en", "a"), (None, None, None, None)]
    df = docs(spark, rows)
    labels = spark.createDataFrame([(r[0], int(r[0] % 2)) for r in rows if r[0]] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    whole, small = quality.train(df, labels), quality.train(df, labels, passages=30)
    assert whole.weights and small.weights and quality.train(df, labels, passages=0).weights == {}
    for model in (whole, small):
        out = quality.score_quality(df, model, "_p").collect()
        assert len(out) == len(rows) and all(0 <= r["_p"] <= 1 for r in out)
