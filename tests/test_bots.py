"""Bot filter edge cases and the skew-safe gap computation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from murmur.operators import bots as B

SCHEMA = "comment_id long, comment_author_id long, comment_published string, comment_text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_null_author_kept_bad_ts_dropped(spark):
    rows = [(1, None, "2024-01-01 00:00:00", "x"),
            (2, 7, "not a time", "y"),
            (3, 7, "2024-01-01 00:00:10", "z")]
    kept, stats = B.bot_filter(frame(spark, rows), "news")
    ids = sorted(r.comment_id for r in kept.collect())
    assert ids == [1, 3]                          # bad timestamp gone, null author kept
    s = stats.collect()
    assert [r.comment_author_id for r in s] == [7]   # null author never enters stats
    assert s[0].comment_count == 1


def test_single_comment_author_low_var(spark):
    kept, stats = B.bot_filter(frame(spark, [(1, 5, "2024-01-01 00:00:00", "hello")]), "news")
    r = stats.first()
    assert r.length_var == 0.0 and r.low_len_var == 1 and r.time_var_sec == 0.0


def test_high_rep_alone_is_not_suspicious(spark):
    s = spark.createDataFrame([(1, 1, 0.0, 500.0, 0.9, 0.0)],
                              "comment_author_id long, comment_count long, time_var_sec double, length_var double,"
                              " avg_rep_ratio double, avg_ai_prob double")
    r = B.bot_flags(s, 2).first()
    assert r.high_rep == 1 and r.suspicious_score == pytest.approx(0.3) and r.cond_suspicious == 0


def _brute_gaps(pdf):
    pdf = pdf.sort_values(["comment_author_id", "ts", "comment_id"])
    pdf["g"] = pdf.groupby("comment_author_id")["ts"].diff().dt.total_seconds()
    out = {}
    for a, grp in pdf.groupby("comment_author_id"):
        g = grp["g"].dropna()
        out[a] = (len(grp), float(np.var(g)) if len(g) >= 2 else None)
    return out


def test_gaps_survive_slicing_of_a_hot_author(spark):
    rng = np.random.default_rng(0)
    n = 3000
    authors = np.where(rng.random(n) < 0.6, 1, rng.integers(2, 40, n))   # author 1 holds ~60% of rows
    base = dt.datetime(2024, 1, 1)
    secs = rng.integers(0, 86400 * 5, n)
    rows = [(i, int(a), (base + dt.timedelta(seconds=int(s), microseconds=int(i % 1000))).isoformat(" "), "t")
            for i, (a, s) in enumerate(zip(authors, secs))]
    df = B.parse_published(frame(spark, rows))
    stats = {r.comment_author_id: (r.comment_count, r.time_var_sec)
             for r in B.raw_author_stats(df, "news", slices=16).collect()}
    pdf = pd.DataFrame(rows, columns=["comment_id", "comment_author_id", "p", "t"])
    pdf["ts"] = pd.to_datetime(pdf["p"], format="ISO8601")
    brute = _brute_gaps(pdf)
    assert set(stats) == set(brute)
    for a, (cnt, var) in brute.items():
        assert stats[a][0] == cnt
        if var is None:
            assert stats[a][1] is None
        else:
            assert stats[a][1] == pytest.approx(var, rel=1e-9)
    # the hot author really was split over several slices
    rows_ = B.consecutive_gaps(df, B.AUTHOR, "ts", B.ID, 16)
    assert rows_.filter(F.col(B.AUTHOR) == 1).select("_slice").distinct().count() > 1


def test_row_gaps_match_per_row(spark):
    rows = [(i, 1 if i % 2 else 2, f"2024-01-01 00:0{i}:00", "t") for i in range(8)]
    df = B.parse_published(frame(spark, rows))
    got = {r.comment_id: r.gap_sec for r in B.row_gaps(df, slices=4).collect()}
    assert got[0] is None and got[1] is None
    assert all(got[i] == 120.0 for i in range(2, 8))


def test_video_bots_subset_of_news_bots(spark):
    from murmur.sources import fixtures as FX
    c = B.parse_published(FX.comments(spark, "/root/testdata/sf0.001"))
    news = {r[0] for r in B.author_stats(c, "news").filter("is_bot").select(B.AUTHOR).collect()}
    video = {r[0] for r in B.author_stats(c, "video").filter("is_bot").select(B.AUTHOR).collect()}
    assert video and video <= news


def test_every_flag_fires_on_overlay(spark):
    from murmur.sources import fixtures as FX
    c = B.parse_published(FX.comments(spark, "/root/testdata/sf0.001"))
    s = B.author_stats(c, "news")
    sums = s.agg(*[F.sum(x).alias(x) for x in ["cond_speed", "cond_ai", "high_rep", "low_len_var"]]).first()
    assert all(v > 0 for v in sums)
    assert s.filter("is_bot").count() > 0 and s.count() == 15 + 20      # all authors, and one derived for each tenth comment
