"""Registry of runnable queries: name -> fn(spark, sf_dir) -> DataFrame.

Each entry reads the testdata tables through ``murmur.sources.fixtures`` and
runs a library operator over the whole tables; outputs go through ``present``
so the SQL oracle can compare them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.operators import bots as B
from murmur.plans.present import present
from murmur.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: present(_fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


COMMENT_COLS = ["comment_id", "comment_author_id", "comment_published", "comment_text", "channel", "time_label"]


# ---------------------------------------------------------------------------
# 2.9 bot filter and its parts
# ---------------------------------------------------------------------------
def _stats(spark, sf_dir, variant="news"):
    parsed = B.parse_published(FX.comments(spark, sf_dir))
    return B.author_stats(parsed, variant)


@register("bot_news")
def q_bot_news(spark, sf_dir):
    """B-2: author stats and is_bot with the news threshold (>= 2 flags)."""
    return _stats(spark, sf_dir, "news")


@register("bot_video")
def q_bot_video(spark, sf_dir):
    """B-3: author stats and is_bot with the video threshold (>= 3 flags)."""
    return _stats(spark, sf_dir, "video")


@register("bot_flags")
def q_bot_flags(spark, sf_dir):
    """B-1: the five flags and the suspicious score."""
    return _stats(spark, sf_dir).select(B.AUTHOR, "cond_speed", "cond_ai", "suspicious_score",
                                        "cond_suspicious", "high_rep", "low_len_var")


@register("bot_filter")
def q_bot_filter(spark, sf_dir):
    """B-4: comments kept after removing bot authors (news rules)."""
    kept, _ = B.bot_filter(FX.comments(spark, sf_dir), "news")
    return kept


@register("drop_bot_authors")
def q_drop_bot_authors(spark, sf_dir):
    """J-3: anti-join of comments against video-rule bot authors."""
    kept, _ = B.bot_filter(FX.comments(spark, sf_dir), "video")
    return kept


@register("drop_helpers")
def q_drop_helpers(spark, sf_dir):
    """PF-4: the kept table carries only the input columns; summarised."""
    kept, _ = B.bot_filter(FX.comments(spark, sf_dir), "news")
    assert kept.columns == COMMENT_COLS, kept.columns
    return kept.agg(F.count("*").alias("kept_rows"), F.countDistinct(B.AUTHOR).alias("kept_authors"))


@register("author_stats")
def q_author_stats(spark, sf_dir):
    """A-1: count, gap variance (population), length variance (sample), mean repetition."""
    return _raw_stats(spark, sf_dir).select(B.AUTHOR, "comment_count", "time_var_sec", "length_var",
                                            "avg_rep_ratio")


def _raw_stats(spark, sf_dir, variant="news"):
    """Per-author statistics before null -> 0 (A-1, A-2)."""
    parsed = B.parse_published(FX.comments(spark, sf_dir))
    return B.raw_author_stats(parsed, variant)


@register("author_ai_mean")
def q_author_ai_mean(spark, sf_dir):
    """A-2: mean AI-likeness per author."""
    return _raw_stats(spark, sf_dir).select(B.AUTHOR, "avg_ai_prob")


@register("stats_x_ai")
def q_stats_x_ai(spark, sf_dir):
    """J-2: stats with the AI mean attached and every null statistic -> 0."""
    return _stats(spark, sf_dir).select(B.AUTHOR, "comment_count", "time_var_sec", "length_var",
                                        "avg_rep_ratio", "time_var_hr", "avg_ai_prob")


@register("unit_conv")
def q_unit_conv(spark, sf_dir):
    """T-23: time_var_hr = variance in s^2 / 3600 (unit kept as the reference has it)."""
    return _stats(spark, sf_dir).select(B.AUTHOR, "time_var_sec", "time_var_hr")


@register("author_gap")
def q_author_gap(spark, sf_dir):
    """W-1: seconds since the author's previous comment."""
    parsed = B.parse_published(FX.comments(spark, sf_dir)).select("comment_id", B.AUTHOR, "ts")
    return B.row_gaps(parsed).select("comment_id", B.AUTHOR, "gap_sec")


@register("text_length")
def q_text_length(spark, sf_dir):
    """T-1: length in code points."""
    c = FX.comments(spark, sf_dir)
    return c.select("comment_id", T.text_length("comment_text").alias("text_length"))


@register("repetition_ratio")
def q_repetition_ratio(spark, sf_dir):
    """T-2: word repetition ratio on Python-whitespace words."""
    c = FX.comments(spark, sf_dir)
    return c.select("comment_id", T.repetition_ratio("comment_text").alias("repetition_ratio"))


@register("ai_likeness")
def q_ai_likeness(spark, sf_dir):
    """T-3 / T-3b: AI-likeness with both single-segment conventions."""
    c = FX.comments(spark, sf_dir)
    return c.select("comment_id", T.ai_likeness("comment_text", None).alias("ai_news"),
                    T.ai_likeness("comment_text", 0.0).alias("ai_video"))


@register("drop_bad_ts")
def q_drop_bad_ts(spark, sf_dir):
    """PF-1: rows whose publication time does not parse are dropped."""
    return B.parse_published(FX.comments(spark, sf_dir)).select(*COMMENT_COLS)


@register("sort_comments")
def q_sort_comments(spark, sf_dir):
    """K-1: comments ordered by (author nulls last, ts, id) — a range-partitioned sort."""
    c = FX.comments(spark, sf_dir)
    return c.orderBy(F.asc_nulls_last(B.AUTHOR), "comment_published", "comment_id").select(*COMMENT_COLS)


# domain registries (import for their side effect of registering)
from murmur.plans import q_sources  # noqa: E402,F401
from murmur.plans import q_topics  # noqa: E402,F401
from murmur.plans import q_forecast  # noqa: E402,F401
from murmur.plans import q_models  # noqa: E402,F401
from murmur.plans import q_payloads  # noqa: E402,F401
from murmur.plans import q_learned  # noqa: E402,F401
