"""Findings of round 4: steps that were made whole or to scale, against plain versions."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.functions.text import LETTER_TOKEN
from murmur.operators import density, neighbours
from murmur.operators import topics as TP
from murmur.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def vectors(spark, x, partitions=3):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>").repartition(partitions)


def test_all_different_vectors_are_nodes(spark):
    """F8: no bound on the nodes changes a row; before, those beyond it joined the topic of their nearest one."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, s, (60, 3)) for c, s in (((0, 0, 0), 0.3), ((4, 0, 0), 0.5), ((0, 5, 0), 0.2))])
    key = lambda how: sorted(map(tuple, density.density_topics(vectors(spark, x), "id", "vec", min_size=8, **how).select("id", "topic_id", F.round("topic_prob", 9)).collect()))
    assert key({}) == key({"max_nodes": 50})


def test_many_topics_of_one_size():
    """F8: the driver passed over all nodes for each topic. 500 chains whose links grow, joined by long edges."""
    topics, each = 500, 30
    n = topics * each
    ids, a = np.arange(n) * 7, np.arange(n - 1)
    w = np.where((a + 1) % each != 0, 1.0 + (a % each) / 100, 50.0 + a / n)
    h = density.condense(ids, np.ones(n, np.int64), ids[a], ids[a + 1], w, 10)
    assert (h.topic == np.repeat(np.arange(topics), each)).all()  # numbered by their first node
    assert h.strength.min() > 0 and h.strength.max() == 1


def test_few_cells_are_visited_a_query(spark, monkeypatch):
    """a query was sent to each cell whose radius reaches it; planes and boxes leave out most of those, and lose no neighbour."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sent = []
    keep = neighbours.written
    monkeypatch.setattr(neighbours, "written", lambda df, name: (lambda t: (sent.append(t.count()) if name == "visits" else None, t)[1])(keep(df, name)))
    got = {r.id: [(f.d, f.id) for f in r.found] for r in neighbours.nearest(vectors(spark, x), vectors(spark, x), 6, 128, 64).collect()}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    near = np.argsort(d, axis=1, kind="stable")[:, :6]
    assert all([i for _, i in got[q]] == near[q].tolist() and np.allclose([v for v, _ in got[q]], d[q, near[q]], atol=1e-12) for q in range(len(x)))
    assert sum(sent) < 6 * len(x)  # 8.0 before, with as many cells


def test_cells_forests_hold_the_whole_forest(spark):
    """before the rounds, each cell's edges are thinned out to its own forest."""
    rng = np.random.default_rng(5)
    pairs = {tuple(sorted(p)) for p in rng.integers(0, 50, (400, 2)).tolist() if p[0] != p[1]}
    edges = [(a, b, float(rng.integers(1, 9)), int(a) // 10) for a, b in sorted(pairs)]
    df = spark.createDataFrame(edges, "a long, b long, w double, cell int").repartition(3)
    thin = density.local_forests(df)
    whole = lambda e: sorted(map(tuple, density.spanning_forest(e.select("a", "b", "w"), 0).collect()))
    assert thin.count() < df.count() and whole(thin) == whole(df)


@pytest.fixture(scope="module")
def fitted(spark):
    d = FX.table(spark, SF, "documents").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"))
    return d, TP.lda_fit(d.coalesce(1), "text", LETTER_TOKEN, settings=dict(max_iter=4))


def test_lda_takes_every_document_once_a_pass(spark, fitted):
    """a pass drew its documents with replacement, by partition, so the topics depended on how the rows lay."""
    d, (cv, model, _) = fitted
    other_cv, other, _ = TP.lda_fit(d.repartition(5), "text", LETTER_TOKEN, settings=dict(max_iter=4))
    assert cv.vocabulary == other_cv.vocabulary
    np.testing.assert_allclose(model.topicsMatrix().toArray(), other.topicsMatrix().toArray(), rtol=0.02, atol=0.02)
    # in the last pass the topics got every word of every document: all words are in the topics, by the rates
    words = sum(float(r.features.toArray().sum()) for r in model.vectors.collect())
    rates = [(10.0 + n) ** -0.7 for n in range(1, 5)]
    want = 10 * len(cv.vocabulary) * 0.1 * sum(r * np.prod([1 - q for q in rates[i + 1:]]) for i, r in enumerate(rates))
    want += words * sum(r * np.prod([1 - q for q in rates[i + 1:]]) for i, r in enumerate(rates))
    from pyspark.ml.clustering import LDA
    begun = LDA(k=10, maxIter=0, seed=42, optimizer="online").fit(model.vectors).topicsMatrix().toArray().sum() * np.prod([1 - q for q in rates])
    assert model.topicsMatrix().toArray().sum() == pytest.approx(want + begun, rel=1e-6)


def test_mixtures_by_blocks_are_those_of_spark(spark, fitted):
    """documents one by one before; null texts failed in the vectoriser."""
    from pyspark.ml.functions import vector_to_array
    _, (_, model, feats) = fitted
    got = {r.doc_id: r.m for r in model.mixtures(feats.drop("_tokens"), "m").collect()}
    want = {r.doc_id: r.m for r in model.transform(feats).select("doc_id", vector_to_array("topicDistribution").alias("m")).collect()}
    assert set(got) == set(want) and got[-1] == got[-2] == [0.0] * 10
    far = [max(abs(x - y) for x, y in zip(got[i], want[i])) for i in got]
    assert np.median(far) < 1e-3 and np.mean(np.array(far) < 0.02) > 0.95
    out = TP.lda_assign(feats.withColumn("time_label", F.lit("x")).withColumnRenamed("text", "comment_text"), model,
                        spark.createDataFrame([(t, f"w{t}") for t in range(1, 11)], "topic_id int, topic_keywords string"))
    assert {r.comment_id: r.topic_id for r in out.collect()} == {i: 1 + max(range(10), key=lambda t: (m[t], -t)) if any(m) else 1 for i, m in got.items()}


def test_perplexity_by_blocks_is_that_of_spark(spark, fitted):
    """documents one by one before."""
    from pyspark.ml.clustering import LocalLDAModel
    _, (_, model, feats) = fitted
    assert model.logPerplexity(model.vectors) == pytest.approx(LocalLDAModel.logPerplexity(model, feats), abs=1e-4)
    assert model.logPerplexity(model.vectors) == pytest.approx(model.logPerplexity(feats.select("features")), abs=1e-9)


def test_coherence_takes_the_fits_tokens(spark, monkeypatch):
    """the texts were searched for words again."""
    from murmur.plans import catalog, q_models as Q
    from murmur.operators import evaluate as EV
    from murmur.functions import text as T
    cv, model, feats = Q._lda(spark, SF)
    top = TP.lda_top_words(spark, cv, model, Q.LDA_TOP_WORDS)
    texts = feats.select(T.regex_tokens(F.col("comment_text"), LETTER_TOKEN).alias("tokens"))
    want = {r.topic_id: r.coherence for r in EV.coherence_of_documents(texts, top, Q.LDA_TOP_WORDS).collect()}
    monkeypatch.setattr(T, "regex_tokens", lambda *a: pytest.fail("searched again"))
    got = {r.topic_id: r.coherence for r in catalog.QUERIES["lda_evaluation"](spark, SF).collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_assigned_comments_stay_one_row_each(spark):
    """topics and vectors met in a join by comment id, which moved all texts and squared repeated ids."""
    from murmur import pipeline as PL
    rows = [(i, "a", f"w{i % 7} x{i % 5} word word{i % 3}") for i in range(40)] + [(3, "a", "w1 x1 again"), (None, "a", "w2 x2")]
    got = PL.assigned_topics(spark.createDataFrame(rows, "comment_id long, time_label string, comment_text string"), 16, 3, LETTER_TOKEN, True)
    assert got.columns == [*TP.TOPIC_ASSIGNMENT_COLUMNS, "embedding"]
    assert sorted((r.comment_id is None, r.comment_id, r.comment_text) for r in got.collect() if r.comment_id is not None) == \
        sorted((False, i, t) for i, _, t in rows if i is not None)
    assert got.count() == len(rows)
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x]
    assert joins and not any("[comment_id" in x for x in joins)  # only with a row a topic


def test_emotional_markers_are_searched_as_plain_strings(spark):
    """a regular expression went over every text."""
    from murmur.functions import text as T
    pad = "y" * 60
    texts = [pad, pad + "!!", pad + "!!!", pad + "??", pad + "a???b", "ㅋㅋ" + pad, "ㅋ" + pad, pad + "ㅎㅎ", pad + "ㅠㅠ", "", None, "!!!"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    likely = T.ai_likeness("t")
    assert "RLIKE" not in df.select(likely)._jdf.queryExecution().optimizedPlan().toString().upper()
    t = F.coalesce("t", F.lit(""))
    third = ((~t.rlike(T.EMOTION_PATTERN)) & (F.length(t) > 50)).cast("double")
    dots = F.regexp_count(t, F.lit("\\."))
    second = ((F.regexp_count(t, F.lit("[.!?]")) / (dots + 1)) > 0.8).cast("double")
    assert all(r.a == pytest.approx(r.b) for r in df.select(likely.alias("a"), ((second + third) / 3.0).alias("b")).collect())  # no text has two segments
