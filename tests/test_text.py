"""Hand-computed checks of the text expressions (T-1 .. T-8, T-13 .. T-15, IO-4, PF-6, PF-9)."""

import pytest
from pyspark.sql import functions as F

from murmur.functions import text as T


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_python_whitespace_split(spark):
    # NBSP, ideographic space, U+001C and tab all split like str.split()
    s = "a b　c\x1cd\te  f"
    assert one(spark, T.words(F.col("x")), s) == s.split()


def test_text_length_code_points_and_null(spark):
    assert one(spark, T.text_length(F.col("x")), "가나다😀") == 4
    assert one(spark, T.text_length(F.col("x")), None) == 0


def test_repetition_ratio(spark):
    assert one(spark, T.repetition_ratio(F.col("x")), "a a a b") == pytest.approx(0.5)
    assert one(spark, T.repetition_ratio(F.col("x")), "   ") == 0.0
    assert one(spark, T.repetition_ratio(F.col("x")), None) == 0.0


def test_ai_likeness_single_segment_variants(spark):
    t = "x" * 60  # one segment, no punctuation, long, no emotion
    # news: (a) false (NaN < 50), (b) 0/1 > .8 false, (c) true -> 1/3
    assert one(spark, T.ai_likeness(F.col("x"), None), t) == pytest.approx(1 / 3)
    # video: (a) true (0 < 50) -> 2/3
    assert one(spark, T.ai_likeness(F.col("x"), 0.0), t) == pytest.approx(2 / 3)


def test_ai_likeness_all_tests(spark):
    t = "Short one. Short two. Short six. " + "y" * 30 + "."
    # segments: lengths vary little? compute directly with python
    segs = [len(s) for s in t.split(".") if s]
    import numpy as np
    a = float(np.var(segs) < 50) if len(segs) > 1 else 0.0
    b = float(sum(t.count(c) for c in ".!?") / (t.count(".") + 1) > 0.8)
    c = float(len(t) > 50)
    assert one(spark, T.ai_likeness(F.col("x"), None), t) == pytest.approx((a + b + c) / 3)


def test_emotional_marker_blocks_test_c(spark):
    t = "ㅋㅋ " + "z" * 80
    assert one(spark, T.ai_likeness(F.col("x"), None), t) == 0.0


def test_hangul_tokens(spark):
    toks = one(spark, T.regex_tokens(F.col("x"), T.HANGUL_TOKEN), "가나다, 이재명은 abc가나 a가")
    assert toks == ["가나다", "이재명은"]


def test_keyword_count_non_overlapping_lowercase(spark):
    assert one(spark, T.keyword_count(F.col("x"), "aa"), "AAAa aa") == 3
    assert one(spark, T.keyword_count(F.col("x"), "the"), None) == 0


def test_keyword_classify_first_max_and_default(spark):
    axes = {"a": ["x"], "b": ["y"]}
    assert one(spark, T.keyword_classify(F.col("x"), axes, "none"), "x y") == "a"
    assert one(spark, T.keyword_classify(F.col("x"), axes, "none"), "y y x") == "b"
    assert one(spark, T.keyword_classify(F.col("x"), axes, "none"), "zzz") == "none"


@pytest.mark.parametrize("name,label", [
    ("data/comments_0204_0206.csv", "0204_0206"),
    ("x_20250519~20250521.csv", "0519_0521"),
    ("/tmp/nolabel.csv", "unknown"),
])
def test_time_label_from_path(spark, name, label):
    assert one(spark, T.time_label_from_path(F.col("x")), name) == label


def test_topic_label(spark):
    df = spark.createDataFrame([("  new  policy , b", 3), ("nan", 4), ("", 5), (None, 6), (" , x", 7)],
                               "k string, i int")
    got = [r[0] for r in df.select(T.topic_label(F.col("k"), F.col("i"))).collect()]
    assert got == ["new_policy", "topic_4", "topic_5", "topic_6", "topic_7"]


def test_candidate_of_cluster_list_order(spark):
    c = ["A", "AB"]
    df = spark.createDataFrame([("t_AB",), ("t_Z",), (None,)], "x string")
    got = [r[0] for r in df.select(T.candidate_of_cluster(F.col("x"), c)).collect()]
    assert got == ["A", "other", "unknown"]


def test_cluster_phrase(spark):
    assert one(spark, T.cluster_phrase(F.col("x")), "a_b") == "a 관련 b"
    assert one(spark, T.cluster_phrase(F.col("x")), None) == "알 수 없음"


def test_keyword_string_outlier(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e", "f"], 1), (["a"], -1)], "w array<string>, t int")
    got = [r[0] for r in df.select(T.keyword_string(F.col("w"), F.col("t"))).collect()]
    assert got == ["a, b, c, d, e", "outlier"]


def test_topic_probability(spark):
    df = spark.createDataFrame([(1, [0.1, 0.7, 0.2]), (-1, [0.1, 0.7, 0.2]), (9, [0.3, 0.2]), (0, [])],
                               "t int, d array<double>")
    got = [r[0] for r in df.select(T.topic_probability(F.col("t"), F.col("d"))).collect()]
    assert got == [0.7, 0.7, 0.3, 0.0]


@pytest.mark.parametrize("raw,mapped", [
    ("POSITIVE", "positive"), ("neg", "negative"), ("중립", "neutral"), ("hate", "negative"),
    ("LABEL_2", "negative"), ("LABEL_0", "neutral"), ("label_x", "neutral"), ("zzz", "neutral"), ("whatever", "negative"),
])
def test_sentiment_label_rules(spark, raw, mapped):
    # id2label: 0 -> neutral, 2 -> offensive (hate/offensive ranks before neutral in the id path)
    assert one(spark, T.sentiment_label(F.col("x"), {0: "None", 2: "offensive"}, 3), raw) == mapped


def test_sentiment_label_binary_fallback(spark):
    assert one(spark, T.sentiment_label(F.col("x"), {}, 2), "LABEL_1") == "positive"
    assert one(spark, T.sentiment_label(F.col("x"), {}, 2), "LABEL_0") == "negative"
    assert one(spark, T.sentiment_label(F.col("x"), {}, 3), "LABEL_1") == "neutral"


def test_doc_bow_counts_in_the_row(spark):
    from murmur.operators import topics as TP
    d = spark.createDataFrame([(1, "b a b c b"), (2, ""), (3, None), (4, "x")], "doc_id long, text string")
    got = TP.doc_bow(d, "doc_id", "text", r"([a-z])")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1), (1, "b", 3), (1, "c", 1), (4, "x", 1)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
