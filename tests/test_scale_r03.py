"""Steps of the learned models that were made to scale, against plain versions."""
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.operators import guided as GU
from murmur.operators import topics as TP

TEXTS = ["Ab cd ab, ef", "cd cd x", None, "", "gh ef ab ab ab", "cd"]
WORD = r"([a-z]{2,})"


def corpus(spark, partitions=3):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(partitions)


def test_token_vocabulary_and_counts_are_those_of_the_bag(spark):
    docs = corpus(spark)
    toks = TP.tokenised(docs, "doc_id", "text", WORD, lower=True)
    bow = TP.doc_bow(docs, "doc_id", "text", WORD, lower=True)
    for how in (dict(min_df=2, max_df=1.0, max_features=10), dict(min_df=1, max_df=0.4, max_features=2), dict(min_df=0.3, max_df=3, max_features=None)):
        got = sorted(map(tuple, TP.token_vocabulary(toks, **how).select("term", "df", "tf").collect()))
        assert got == sorted(map(tuple, TP.vocabulary(bow, docs, **how).select("term", "df", "tf").collect()))
        terms = sorted(t for t, _, _ in got)
        assert sorted(map(tuple, TP.vocabulary_counts(toks, terms).collect())) == sorted(map(tuple, bow.where(F.col("term").isin(terms)).collect()))


def test_word_means_against_plain_means(spark):
    vec = {0: [1.0, 2.0], 1: [3.0, -1.0], 2: [5.0, 5.0], 4: [float("nan"), 4.0], 5: None}
    docs = spark.createDataFrame([(i, v) for i, v in vec.items()], "doc_id long, embedding array<double>").repartition(3)
    vbow = spark.createDataFrame([(i, t, n) for i, x in enumerate(TEXTS) for t, n in Counter((x or "").lower().replace(",", "").split()).items()],
                                 "doc_id long, term string, n long")
    terms = ["ab", "cd", "ef", "gh"]
    met = defaultdict(list)
    for i, x in enumerate(TEXTS):
        for t in set((x or "").lower().replace(",", "").split()) & set(terms):
            if vec.get(i):
                met[t].append(vec[i])
    got = {terms[r.at]: r.w for r in GU.word_means(GU.bags(vbow, terms), docs, len(terms)).collect()}
    assert set(got) == set(met)
    for t, v in met.items():
        assert got[t] == pytest.approx(np.mean(v, axis=0).tolist(), nan_ok=True)


def test_blocks_hold_each_document_once_within_their_size():
    rng = np.random.default_rng(2)
    docs = [(np.arange(k), rng.random(k) + 1) for k in rng.integers(0, 40, 200)]
    seen = {}
    for which, at, n in GU._blocks(docs, 64):
        assert at.size <= 64 or len(which) == 1
        seen |= {int(w): n[row][n[row] > 0] for row, w in enumerate(which)}
    assert sorted(seen) == list(range(200)) and all((seen[i] == docs[i][1]).all() for i in seen)


def test_topic_base_without_texts_reads_none_and_keeps_the_rows(spark):
    from murmur.sources import fixtures as FX
    sf = "/root/testdata/sf0.001"
    key = ["comment_id", "time_label", "channel", "topic_id", "embedding"]
    full, bare = FX.topic_base(spark, sf), FX.topic_base(spark, sf, texts=False)
    rows = sorted((tuple(r[c] for c in key[:4]), tuple(r.embedding), r.comment_text is None) for r in full.collect())
    assert rows and rows == sorted((tuple(r[c] for c in key[:4]), tuple(r.embedding), r.comment_text is None) for r in bare.collect())
    text = {r.doc_id: r.text for r in FX.table(spark, sf, "documents").collect()}
    assert all(r.comment_text == text[r.comment_id] for r in full.collect())
    assert {r.comment_text for r in bare.collect()} <= {"", None}
