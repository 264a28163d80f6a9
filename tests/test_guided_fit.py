from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.operators import cooccurrence as CO
from murmur.operators import evaluate as EV
from murmur.operators import guided as G


def toy(seed=0, n=90, k=3, v=24, dim=6):
    """Documents of a few topics, word vectors that know about them, and topic vectors off the mark."""
    rng = np.random.default_rng(seed)
    words = rng.normal(size=(v, dim))
    words /= np.sqrt((words ** 2).sum(1, keepdims=True))
    true = rng.normal(size=(k, dim)) * 3
    beta = G.softmax_rows(true @ words.T)
    theta = rng.dirichlet([0.3] * k, n)
    docs = [Counter(rng.choice(v, 40, p=theta[d] @ beta).tolist()) for d in range(n)]
    start = true / 3 + 0.3 * rng.normal(size=true.shape)
    return words, start, docs


def rows(spark, docs, partitions=3):
    return spark.createDataFrame([(i, sorted(c), [float(c[w]) for w in sorted(c)]) for i, c in enumerate(docs)], "doc_id long, at array<int>, n array<double>").repartition(partitions)


def plain_round(words, topics, docs):
    """Expectations by the formulas, document by document."""
    beta = G.softmax_rows(topics @ words.T)
    k = len(topics)
    got, count, loglik = np.zeros_like(topics), np.zeros(k), 0.0
    for c in docs:
        th = [1 / k] * k
        for _ in range(G.INNER):
            new = [G.SMOOTH + sum(n * th[t] * beta[t, w] / sum(th[s] * beta[s, w] for s in range(k)) for w, n in c.items()) for t in range(k)]
            th = [x / sum(new) for x in new]
        for w, n in c.items():
            p = sum(th[s] * beta[s, w] for s in range(k))
            loglik += n * np.log(p)
            for t in range(k):
                got[t] += n * th[t] * beta[t, w] / p * words[w]
                count[t] += n * th[t] * beta[t, w] / p
        loglik += G.SMOOTH * sum(np.log(th))
    return loglik, got, count


def test_expectations_against_formulas(spark):
    words, start, docs = toy(n=15)
    loglik, got, count = G.expectations(rows(spark, docs), words, start)
    want = plain_round(words, start, docs)
    assert loglik == pytest.approx(want[0], rel=1e-9)
    assert got == pytest.approx(want[1], rel=1e-8, abs=1e-9) and count == pytest.approx(want[2], rel=1e-8)


def test_move_finds_the_maximum():
    rng = np.random.default_rng(3)
    words, start = rng.normal(size=(15, 4)), rng.normal(size=4)
    n = rng.integers(0, 9, 15).astype(float)
    a = G.move(start.copy(), words, n @ words, n.sum(), start, 1.0, steps=40)
    slope = n @ words - n.sum() * (G.softmax_rows((words @ a)[None])[0] @ words) - (a - start)
    assert np.abs(slope).max() < 1e-3


def test_bound_rises_and_held_out_perplexity_falls(spark):
    words, start, docs = toy(n=140)
    terms = [f"w{i:02d}" for i in range(len(words))]
    model = G.fit_guided(rows(spark, docs[:100]), terms, words, start, rounds=8)
    assert len(model.bounds) >= 4 and all(b > a for a, b in zip(model.bounds, model.bounds[1:]))
    held = docs[100:]
    vbow = spark.createDataFrame([(i, terms[w], n) for i, c in enumerate(held) for w, n in c.items()], "doc_id long, term string, n long")
    ids = spark.range(len(held)).withColumnRenamed("id", "doc_id")

    def perplexity(m):
        return EV.perplexity_bow(vbow, G.thetas(rows(spark, held), ids, m), G.beta_table(spark, m)).first()[0]

    assert perplexity(model) < 0.97 * perplexity(G.GuidedModel(terms, words, start, []))


def test_documents_without_words_and_empty_table(spark):
    words, start, docs = toy(n=5)
    m = G.GuidedModel([str(i) for i in range(len(words))], words, start, [])
    out = {r.doc_id: r.theta for r in G.thetas(rows(spark, docs), spark.range(7).withColumnRenamed("id", "doc_id"), m).collect()}
    assert out[6] == {1: 1 / 3, 2: 1 / 3, 3: 1 / 3} and sum(out[0].values()) == pytest.approx(1)
    empty = G.fit_guided(rows(spark, docs).limit(0), m.terms, words, start, rounds=2)
    assert np.allclose(empty.topics, start)


# -- co-occurrence vectors
def plain_counts(docs, terms, window):
    c = Counter()
    at = {t: i for i, t in enumerate(terms)}
    for d in docs:
        for x in range(len(d)):
            for y in range(x + 1, min(len(d), x + window + 1)):
                if d[x] in at and d[y] in at:
                    c[tuple(sorted((at[d[x]], at[d[y]])))] += 1
    return c


def corpus(seed=0, n=60):
    rng = np.random.default_rng(seed)
    groups = [["sun", "sea", "sand", "wave"], ["vote", "law", "party", "seat"], ["goal", "team", "ball", "cup"]]
    return [[str(rng.choice(groups[i % 3])) if rng.random() < 0.8 else f"r{rng.integers(8)}" for _ in range(rng.integers(0, 30))] for i in range(n)]


def test_cooccurrences_and_ppmi(spark):
    docs = corpus()
    terms = sorted({t for d in docs for t in d} - {"r0"})
    df = spark.createDataFrame([(d,) for d in docs] + [(None,)], "tokens array<string>").repartition(3)
    got = {(r.i, r.j): r.n for r in CO.cooccurrences(df, terms, 3).collect()}
    assert got == plain_counts(docs, terms, 3)
    m = np.zeros((len(terms),) * 2)
    for (i, j), n in got.items():
        m[i, j] += n
        m[j, i] += n
    with np.errstate(divide="ignore"):
        want = np.maximum(0, np.log(m * m.sum() / np.outer(m.sum(1), m.sum(1))))
    for r in CO.ppmi(CO.cooccurrences(df, terms, 3)).collect():
        assert r.v == pytest.approx(want[r.i, r.j])
        want[r.i, r.j] = 0
    assert want.max() < 1e-12


def test_singular_values(spark):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    m = (q * (30 * 0.8 ** np.arange(40))) @ q.T
    df = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(40) for j in range(40)], "i int, j int, v double").repartition(3)
    s, u = CO.truncated_svd(df, 40, 8)
    want = np.linalg.svd(m)[1][:8]
    assert np.abs(s / want - 1).max() < 0.01
    assert np.abs(u.T @ u - np.eye(8)).max() < 1e-9


def test_vectors_carry_meaning(spark):
    docs = corpus(1, 150)
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(900, None), (901, ["unknown"])], "id long, tokens array<string>")
    terms = sorted({t for d in docs for t in d})
    m = CO.learn_vectors(df, "tokens", terms, dim=6, window=4)
    v = {t: x / max(np.sqrt(x @ x), 1e-12) for t, x in zip(m.terms, m.vectors)}
    assert min(v["sun"] @ v["sea"], v["vote"] @ v["law"], v["goal"] @ v["cup"]) > max(v["sun"] @ v["law"], v["vote"] @ v["cup"], v["goal"] @ v["sea"])
    out = {r.id: r.embedding for r in CO.embed_tokens(df, "tokens", m).collect()}
    assert len(out) == 152 and out[900] == out[901] == [0.0] * 6
    assert all(sum(x * x for x in e) == pytest.approx(1) for i, e in out.items() if i < 150 and docs[i])
