"""Vectors, topics, sentiment and forecast operators on hand-made tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from murmur.functions import vectors as V
from murmur.operators import evaluate as EV
from murmur.operators import forecast as FC
from murmur.operators import sentiment as SE
from murmur.operators import topics as TP


def test_cosine_zero_vector_and_norm(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [2.0, 2.0])], "a array<double>, b array<double>")
    got = [(r.c, r.n) for r in df.select(V.cosine("a", "b").alias("c"), V.norm("b").alias("n")).collect()]
    assert got[0] == (0.0, 0.0)
    assert got[1][0] == pytest.approx(1.0) and got[1][1] == pytest.approx(math.sqrt(8))


def test_nearest_first_candidate_wins_ties(spark):
    cands = spark.createDataFrame([(0, "A", [1.0, 0.0]), (1, "B", [2.0, 0.0]), (2, "C", [0.0, 1.0])],
                                  "ord int, candidate string, embedding array<double>")
    arr = V.candidate_array(cands)
    df = spark.createDataFrame([([3.0, 0.0],), ([0.0, 5.0],), ([0.0, 0.0],)], "v array<double>")
    got = [r.n for r in df.select(V.nearest(F.col("v"), arr)["name"].alias("n")).collect()]
    assert got == ["A", "C", "A"]


def test_mean_vector_and_softmax(spark):
    df = spark.createDataFrame([("x", [1.0, 2.0]), ("x", [3.0, 4.0]), ("y", [5.0, 5.0]), ("y", None)],
                               "k string, v array<double>")
    got = {r.k: r.vector for r in V.mean_vector(df, ["k"], "v").collect()}
    assert got == {"x": [2.0, 3.0], "y": [5.0, 5.0]}
    s = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("h", 1000.0), ("h", 1001.0)], "g string, x double")
    out = V.softmax_over(s, ["g"], "x", "p").groupBy("g").agg(F.sum("p").alias("t")).collect()
    assert all(r.t == pytest.approx(1.0) for r in out)


def test_dominant_topic_uniform_for_empty_doc(spark):
    df = spark.createDataFrame([([0.1, 0.6, 0.6],), ([0.0, 0.0],)], "d array<double>")
    got = [(r.t.topic, r.t.prob) for r in df.select(TP.dominant_topic("d").alias("t")).collect()]
    assert got == [(2, 0.6), (1, 0.5)]


def test_top5_outlier_removed_after_cut(spark):
    rows = [("p", t) for t, n in [(-1, 9), (1, 8), (2, 7), (3, 6), (4, 5), (5, 4), (6, 3)] for _ in range(n)]
    df = spark.createDataFrame(rows, "time_label string, topic_id int")
    got = [r.topic_id for r in TP.topic_top5_by_period(df).orderBy("rank").collect()]
    assert got == [1, 2, 3, 4]


def test_class_tfidf_hand_computed(spark):
    cb = spark.createDataFrame([(0, "a", 3), (0, "b", 1), (1, "a", 1), (1, "c", 3)], "topic_id int, term string, n long")
    got = {(r.topic_id, r.term): r.weight for r in TP.class_tfidf(cb).collect()}
    A = 4  # mean words per class
    assert got[(0, "a")] == pytest.approx(0.75 * math.log(1 + A / 4))
    assert got[(1, "c")] == pytest.approx(0.75 * math.log(1 + A / 3))


def test_vocabulary_rules(spark):
    bow = spark.createDataFrame([(d, t, 1) for d, ts in enumerate(["a b", "a c", "a b", "a d"]) for t in ts.split()],
                                "doc_id int, term string, n int")
    docs = spark.range(4).withColumnRenamed("id", "doc_id")
    v = {r.term for r in TP.vocabulary(bow, docs, min_df=2, max_df=0.95, max_features=10).collect()}
    assert v == {"b"}   # a: df 4 > 0.95*4; c, d: df 1 < 2


def test_coherence_bounds(spark):
    toks = spark.createDataFrame([(d, i, w) for d, s in enumerate(["a b c a b", "a b x y", "c d c d"])
                                  for i, w in enumerate(s.split())], "doc_id int, pos int, term string")
    top = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 1, "c"), (1, 2, "d"), (1, 3, "x")],
                                "topic_id int, rank int, term string")
    got = {r.topic_id: r.coherence for r in EV.coherence_cv(toks, top, 10, window=3).collect()}
    assert set(got) == {0, 1} and all(-1.0 <= v <= 1.0 for v in got.values())


def test_sentiment_summary_half_even(spark):
    rows = [("0101", "c", "t", "positive")] + [("0101", "c", "t", "negative")] * 127
    df = spark.createDataFrame(rows, "time_label string, final_cluster string, comment_text string, sentiment_class string")
    r = SE.sentiment_summary(df, "m").first()
    assert r.positive == 0.007812 and r.total_comments == 128 and r.neutral == 0.0


def test_ranges_frame(spark):
    def days(spec):
        return [(r.ordinal, str(r.start), str(r.end)) for r in FC.ranges_frame(spark, spec).orderBy("ordinal").collect()]
    assert [x[1:] for x in days("")] == FC.DEFAULT_POLL_DATE_RANGES
    assert days(" 2025-01-01:2025-01-02 , ,2025-02-01 : 2025-02-03") == [(1, "2025-01-01", "2025-01-02"), (2, "2025-02-01", "2025-02-03")]
    for bad in ("2025-01-01", " , "):
        with pytest.raises(Exception, match="date range"):
            days(bad)


def test_poll_join_is_no_nested_loop(spark):
    j = FC.poll_range_join(spark.createDataFrame([(dt.datetime(2025, 1, 1),)], "date timestamp"), FC.ranges_frame(spark, "2025-01-01:2025-01-02"))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_target_without_weight_is_an_error(spark):
    polls = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1.0, 0.0)], "date timestamp, a double, weight double")
    with pytest.raises(Exception, match="no poll row"):
        FC.weighted_target(polls, FC.ranges_frame(spark, "2025-01-01:2025-01-02"), ["a"]).collect()


def test_weighted_target_rules(spark):
    polls = spark.createDataFrame([
        (dt.datetime(2025, 5, 19), 40.0, 10.0, 2.0),
        (dt.datetime(2025, 5, 21, 12, 0), 99.0, 99.0, 5.0),    # after midnight of the end day: out
        (dt.datetime(2025, 5, 20), 30.0, "x", 1.0),            # non-numeric -> dropped
        (dt.datetime(2025, 5, 25), 50.0, 50.0, 0.0),           # zero weight range
    ], "date timestamp, a double, b string, weight double")
    ranges = FC.ranges_frame(spark, "2025-05-19:2025-05-21,2025-05-19:2025-05-19,2025-05-24:2025-05-26,2025-06-01:2025-06-02")
    got = {r.time_label: (r.a, r.b) for r in FC.weighted_target(polls, ranges, ["a", "b"]).collect()}
    assert got == {1: (40.0, 10.0), 2: (40.0, 10.0)}       # overlap duplicates, ordinals kept


def test_entity_period_defaults_and_shares(spark):
    s = spark.createDataFrame([("p1", "t_A", 0.6, 0.2), ("p1", "u_A", 0.2, 0.2), ("p1", "t_B", 0.1, 0.3),
                               ("p2", "t_Z", 0.5, 0.5)],
                              "time_label string, final_cluster string, positive double, negative double")
    cv = spark.createDataFrame([("t_A", [1.0, 0.0]), ("u_A", [0.0, 1.0])], "final_cluster string, vector array<double>")
    ep = FC.entity_period(s, ["A", "B"], cv, dim=2)
    got = {(r.time_label, r.candidate): (round(r.avg_positive, 6), r.cluster_count, r.embedding) for r in ep.collect()}
    assert got[("p1", "A")] == (0.4, 2, [0.5, 0.5])
    assert got[("p1", "B")] == (0.1, 1, [0.0, 0.0])          # no vector -> zeros
    assert got[("p2", "A")] == (0.5, 0, [0.0, 0.0])          # default row
    rel = {(r.time_label, r.candidate): r.relative_sentiment for r in FC.relative_sentiment(ep, 2).collect()}
    assert rel[("p2", "A")] == 0.5                          # total 0 -> 1/n


def test_forecaster_unfitted_uniform(spark):
    train = spark.createDataFrame([(1, 1.0, 2.0, 10.0)], "time_label int, f1 double, f2 double, y double")
    m = FC.SequentialForecaster(["y", "z"], ["f1", "f2"], n_estimators=3).fit_period(train)
    m.fit_period(train)
    assert len(m.models["y"]) == 2 and "z" not in m.models
    assert m.predict(train, stages=0).first().pred_y == 0.5
    p = m.predict(train).first()
    assert p.pred_z == 0.5 and p.pred_y == pytest.approx(10.0, abs=1.0)


def test_training_error_falls_with_each_period(spark):
    rows = [(p, float(i), float(i * i % 7), 3.0 * i + 10 * p) for p in (1, 2, 3) for i in range(12)]
    train = spark.createDataFrame(rows, "time_label int, f1 double, f2 double, y double")
    m = FC.SequentialForecaster(["y"], ["f1", "f2"], n_estimators=4, learning_rate=0.5)
    for p in (1, 2, 3):
        m.fit_period(train.filter(F.col("time_label") == p))
    out = m.stage_errors(train, "time_label", [1, 2, 3], ["time_label"])
    got = out.groupBy("stage").agg(F.avg(F.abs(F.col("actual") - F.col("pred_before"))).alias("a"),
                                   F.avg(F.abs(F.col("actual") - F.col("pred_after"))).alias("b")).collect()
    assert len(got) == 3 and all(r.b < r.a for r in got)
