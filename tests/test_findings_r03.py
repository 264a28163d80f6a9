"""Findings of round 3: steps that were made to scale, against plain versions."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.functions.text import LETTER_TOKEN
from murmur.operators import evaluate as EV
from murmur.operators import topics as TP
from murmur.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_lda_passes_are_shared_by_all_cores(spark, monkeypatch):
    from pyspark.ml.clustering import LDA
    seen = []
    fit = LDA.fit
    monkeypatch.setattr(LDA, "fit", lambda self, df, *a: (seen.append([r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]), fit(self, df, *a))[1])
    d = FX.table(spark, SF, "documents").select("doc_id", "text").coalesce(1)
    _, _, feats = TP.lda_fit(d, "text", LETTER_TOKEN, settings=dict(max_iter=1))
    assert feats.count() == sum(seen[0]) == 200 and max(seen[0]) <= 200 // spark.sparkContext.defaultParallelism


def test_coherence_inside_the_row_is_that_of_the_tokens(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abcdefgh"), rng.integers(0, 40))) for _ in range(60)] + [""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    docs = docs.withColumn("tokens", F.regexp_extract_all("text", F.lit("([a-z])"), 1))
    top = spark.createDataFrame([(t, k, w) for t, ws in ((0, "abc"), (1, "cdf"), (-1, "ae")) for k, w in enumerate(ws, 1)], "topic_id int, rank int, term string")
    want = {r.topic_id: r.coherence for r in EV.coherence_cv(docs.select("doc_id", F.posexplode("tokens").alias("pos", "term")), top, 10, window=5).collect()}
    got = {r.topic_id: r.coherence for r in EV.coherence_of_documents(docs, top, 10, window=5).collect()}
    assert got == pytest.approx(want, abs=1e-12) and set(got) == {0, 1, -1}


def test_bots_are_joined_without_moving_the_texts(spark):
    from murmur.operators import bots
    kept, _ = bots.bot_filter(FX.comments(spark, SF))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_trie_counts_have_a_fixed_number_of_tasks(spark):
    from murmur.llm import phrases as P
    from murmur.llm.trie import Trie
    words = np.array([5, 7, 5, 7, 0, 9], np.uint64)
    texts = spark.createDataFrame([(bytearray(P.pack_words(words)),)] * 60, "words binary").repartition(60)
    t = Trie.build([np.array([5, 7], np.uint64)])
    counts = P.trie_counts(texts, [(0, *t.pack())])
    assert [tuple(r) for r in counts.collect()] == [(0, 0, 120)]
    assert f"Coalesce {2 * spark.sparkContext.defaultParallelism}" in counts._jdf.queryExecution().executedPlan().toString()


def test_sentiment_training_reads_the_texts_once(spark):
    from murmur.operators import sentiment as SE
    sc = spark.sparkContext
    seen = sc.accumulator(0)

    def row(i):
        seen.add(1)
        return f"{('bad', 'good')[i % 2]} word {i}", i % 2

    labelled = spark.createDataFrame(sc.parallelize(range(200), 4).map(row), "text string, label int")
    model, metrics = SE.train_sentiment(labelled)
    assert seen.value == 200
    m = metrics.first()
    assert m.accuracy == m.f1 == 1.0
    got = SE.score_sentiment(model, spark.createDataFrame([("good x",), ("bad y",)], "comment_text string")).collect()
    assert [r.sentiment_class for r in got] == ["positive", "negative"]


def test_labelled_texts_are_dealt_out(spark):
    assert FX.train_text(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_phrases_are_named_once_whatever_the_texts(spark):
    """The words of a phrase come from the counts: no task gives a row for each phrase of each row of texts, and nothing has the
    texts' phrases made distinct."""
    from collections import Counter
    from murmur.llm import phrases as P
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(1, 5, 25).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.uint64(0)) for _ in range(30)]
    df = spark.createDataFrame([(bytearray(P.pack_words(t)),) for t in texts], "words binary").repartition(10)
    c = Counter(tuple(t[i:i + m].view(np.int64).tolist()) for t in texts for m in (2, 3, 4) for i in range(25 - m + 1))
    read = spark.sparkContext.accumulator(0)
    schema, counting = df.schema, lambda rows: (read.add(1) or r for r in rows)
    safe = P.safe_phrases(spark.createDataFrame(df.rdd.mapPartitions(counting), schema), 4, 4, 22).collect()
    assert Counter(tuple(r.ids) for r in safe) == Counter({p: 1 for p, n in c.items() if n >= 4})
    assert read.value == 3 * len(texts)  # a pass a level and none for the words


def test_pairs_that_are_ordered_alike_keep_their_counts(spark):
    from murmur.llm import phrases as P
    t = np.array([1, 2, 0, 2, 1, 0, 3, 4, 0, 1, 2, 0], np.uint64)
    df = spark.createDataFrame([(bytearray(P.pack_words(t)),)], "words binary")
    assert {(r["head"], r["word"]): r["n"] for r in P.level(df, []).collect()} == {(1, 2): 2, (2, 1): 1, (3, 4): 1}
