import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from murmur.llm import queries, toxicity
from murmur.llm.common import fold

SYLLABLES = ["th", "er", "in", "an", "re", "on", "at", "en", "nd", "ti", "es", "or"]
BAD = ["pathetic", "worthless", "disgusting", "idiot", "scumbag"]


def corpus(n, seed=0, share=0.2):
    """(doc_id, text, toxic): a few bad words in otherwise like texts; one text in ten is a copy."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(SYLLABLES, k=rng.randint(1, 5)))
    out = []
    for i in range(n):
        toxic = int(rng.random() < share)
        words = [word() for _ in range(rng.randint(20, 120))]
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randint(0, len(words)), rng.choice(BAD))
        out.append((i, " ".join(words), toxic) if i % 10 or not out else (i, *rng.choice(out)[1:]))
    return out


def tables(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows], "doc_id long, text string, toxic string, n int").repartition(3)
    return docs, spark.createDataFrame([(i, 1, c) for i, _, c in rows], "doc_id long, quality int, toxic int")


def plain_score(model, text):
    """The score with plain compression of one window after another."""
    dicts = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=toxicity._parameters()) for d in (model.toxic, model.ordinary)]
    e, found = 0.0, set(toxicity.windows(text))
    for w in found:
        a, b = (min(63, len(c.compress(toxicity._CARRIER + b" " + w + b" "))) for c in dicts)
        e += model.evidence[a * 64 + b]
    z = model.weights[0] + model.weights[1] * e + model.weights[2] * np.log1p(len(found))
    return 1 / (1 + np.exp(-z))


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(1500)
    docs, labels = tables(spark, rows)
    return rows, docs, toxicity.train(docs, labels, learn=fold(F.col("doc_id"), 3) != 1)


def test_windows():
    assert toxicity.windows("A b-C, d'é\x00_1") == [b"a", b"b", b"c", b"d", "é".encode(), b"1"]
    long = bytes(97 + i % 26 for i in range(1000))
    w = toxicity.windows("x " + long.decode() + " y")
    assert w[0] == b"x" and w[-1] == b"y" and max(map(len, w)) <= toxicity.WINDOW
    assert w[1] + b"".join(x[24:] for x in w[2:-1]) == long  # every byte is in a window
    assert toxicity.windows(None) == toxicity.windows(" .,\n") == []


def test_scores_against_plain_compression(fitted):
    rows, docs, model = fitted
    texts = {i: t for i, t, _ in rows}
    for r in toxicity.toxicity_scores(docs.where("doc_id < 60"), model).collect():
        assert r.score == pytest.approx(plain_score(model, texts[r.doc_id]), abs=1e-12)


def test_held_out_accuracy(fitted):
    rows, docs, model = fitted
    truth = {i: c for i, _, c in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect() if r.doc_id in truth}
    bad = [i for i in truth if truth[i]]
    assert sum(got[i] >= 0.7 for i in bad) >= 0.9 * len(bad)
    assert sum(got[i] >= 0.7 for i in truth if not truth[i]) <= 0.01 * len(truth)
    assert all(0 <= s <= 1 for s in got.values())


def test_model_uses_only_what_it_may_learn_from(spark, fitted):
    rows, _, model = fitted
    changed = [(i, t, c) if zlib.crc32(str(i).encode()) % 3 != 1 else (i, "quite other words", 1 - c) for i, t, c in rows]
    docs, labels = tables(spark, changed)
    other = toxicity.train(docs, labels, learn=fold(F.col("doc_id"), 3) != 1)
    assert other == model


def test_held_memory_changes_nothing(fitted):
    rows, _, model = fitted
    small, large = toxicity.Scorer(model, held=5), toxicity.Scorer(model)
    for i in range(0, 60, 7):
        texts = [t for _, t, _ in rows[i:i + 7]]
        assert small.evidence(texts) == large.evidence(texts)


def test_evidence_table():
    counts = Counter({(1, 10): 50, (0, 10): 5, (1, 20): 950, (0, 20): 9995, (1, 30): 1, (0, 30): 0})
    t = toxicity.evidence_table(counts, 0.7)
    assert t[10] == pytest.approx(np.log(0.05 / 0.0005), abs=0.4) and t[20] == 0 and t[30] < t[10]


def test_logistic_is_the_optimum():
    rng = np.random.default_rng(0)
    x = np.c_[np.ones(300), rng.normal(size=(300, 2))]
    y = (x @ [0.3, 1.0, -2.0] + rng.logistic(size=300) > 0).astype(float)
    weight = rng.uniform(0.5, 2, 300)
    w = toxicity.logistic(x, y, weight)
    p = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (weight * (y - p)) - np.array([0, 1, 1]) * w).max() < 1e-6


def test_odd_rows_little_to_learn_and_empty_tables(spark, make, odd, fitted):
    model = fitted[2]
    docs = make(odd)
    got = toxicity.toxicity_scores(docs, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in odd) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity_scores(docs.limit(0), model).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, none) == toxicity.Model()
    few = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (6, 1, None), (None, 1, 1), (10, 0, 1)], "doc_id long, quality int, toxic int")
    m = toxicity.train(docs, few)
    assert {r.score for r in toxicity.toxicity_scores(docs, m).collect()} == {m.base} == {2 / 3}


def test_query_on_the_small_table(spark):
    df = queries.QUERIES["op12_toxicity"](spark, "/root/testdata/sf0.01")
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in df.collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [i for i in truth if rows[i].held_out]
    assert sum(rows[i].predicted == truth[i] for i in held) >= 0.93 * len(held)
