"""Bot-author filter (W-1, A-1, A-2, J-2, B-1 .. B-4, J-3, PF-1, PF-4, T-23).

Plan shape, designed so one prolific author (a third of all rows) never lands
in one task:

1. ``consecutive_gaps``: range-partition comments by (author, ts, id). The
   range partitioner splits a hot author over many slices; a window over
   (author, slice) computes the gap to the previous comment inside each slice,
   and a tiny (author, slice) edge table stitches the first gap of every slice
   to the last comment of the author's previous slice.
2. One ``groupBy(author)`` aggregate (partial aggregation map-side, so a hot
   author costs one row per map task) over the union of comment rows and
   slice-edge gaps gives every per-author statistic at once.
3. Flags are column arithmetic on the (small) stats table.
4. The kept comments are a ``left_anti`` join on author; AQE turns it into a
   broadcast when the measured bot table is small and splits a skewed comment
   partition otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.operators.neighbours import written
from murmur.session import ensure_checkpoint_dir, shuffle_partitions

AUTHOR = "comment_author_id"
PUBLISHED = "comment_published"
TEXT = "comment_text"
ID = "comment_id"

# Thresholds of the rule set.
MIN_COMMENTS_FOR_SPEED = 5
MAX_TIME_VAR_HR = 0.2
MIN_AI = 0.5
MIN_REP = 0.6
MAX_LEN_VAR = 200
LOW_VAR_WEIGHT = 0.2
HIGH_REP_WEIGHT = 0.3
MIN_SUSPICIOUS = 0.3
NEWS_MIN_FLAGS = 2
VIDEO_MIN_FLAGS = 3

STAT_COLUMNS = [
    AUTHOR, "comment_count", "time_var_sec", "length_var", "avg_rep_ratio", "time_var_hr",
    "avg_ai_prob", "cond_speed", "cond_ai", "suspicious_score", "cond_suspicious",
    "high_rep", "low_len_var", "is_bot",
]

VARIANTS = {
    # name: (single-segment variance for T-3 test (a), min flags for is_bot)
    "news": (None, NEWS_MIN_FLAGS),
    "video": (0.0, VIDEO_MIN_FLAGS),
}


def parse_published(df: DataFrame, col: str = PUBLISHED, out: str = "ts") -> DataFrame:
    """PF-1: parse the publication time per row (as ``timestamp_ntz`` wall
    clock); unparsable -> row dropped."""
    dtype = dict(df.dtypes)[col]
    if dtype.startswith("timestamp") or dtype == "date":
        ts = F.col(col).cast("timestamp_ntz")
    else:
        ts = F.coalesce(F.try_to_timestamp(F.col(col)),
                        F.try_to_timestamp(F.col(col), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))
                        ).cast("timestamp_ntz")
    return df.withColumn(out, ts).filter(F.col(out).isNotNull())


EPOCH = "1970-01-01 00:00:00"


def epoch_micros(ts: Column) -> Column:
    """Wall-clock microseconds since the epoch of a ``timestamp_ntz``: exact
    and independent of the session time zone (no DST jumps in gaps)."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def _slices(df: DataFrame, key: str, ts: str, order_id: str, slices: int | None) -> DataFrame:
    """Range-partition by (key, ts, id) and tag each row with its slice."""
    n = slices or shuffle_partitions(df.sparkSession)
    return (df.filter(F.col(key).isNotNull())
            .withColumn("_us", epoch_micros(F.col(ts)))
            .repartitionByRange(n, F.col(key), F.col("_us"), F.col(order_id))
            .withColumn("_slice", F.spark_partition_id()))


def consecutive_gaps(df: DataFrame, key: str, ts: str, order_id: str,
                     slices: int | None = None) -> DataFrame:
    """W-1 inside slices: ``df`` (non-null keys) plus ``_us`` (wall-clock
    microseconds), ``_slice`` and ``_gap_us``, the exact gap in microseconds to
    the previous row of the same key *in the same slice* (null on a slice's
    first row). The gaps across slice borders are recovered from per-slice
    (min, max) summaries by the callers, in the same lineage."""
    ranged = _slices(df, key, ts, order_id, slices)
    w = Window.partitionBy(key, "_slice").orderBy("_us", order_id)
    return ranged.withColumn("_gap_us", F.col("_us") - F.lag("_us").over(w))


def row_gaps(df: DataFrame, key: str = AUTHOR, ts: str = "ts", order_id: str = ID,
             slices: int | None = None, out: str = "gap_sec") -> DataFrame:
    """W-1 per row: every row of a non-null key with the seconds since the
    key's previous row (null on its first row).

    The sliced rows are checkpointed (reliable storage) before the slice-edge
    gaps are joined back, so both uses see one and the same slicing; the join
    touches one row per (key, slice).
    """
    rows = consecutive_gaps(df, key, ts, order_id, slices).checkpoint(eager=True)
    edges = (rows.groupBy(key, "_slice").agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
             .withColumn("_prev_hi", F.lag("_hi").over(Window.partitionBy(key).orderBy("_slice")))
             .filter(F.col("_prev_hi").isNotNull())
             .select(key, "_slice", (F.col("_lo") - F.col("_prev_hi")).alias("_edge_us")))
    inner = rows.filter(F.col("_gap_us").isNotNull())
    first = (rows.filter(F.col("_gap_us").isNull())
             .join(edges, [key, "_slice"], "left")
             .withColumn("_gap_us", F.col("_edge_us")).drop("_edge_us"))
    return (inner.unionByName(first).withColumn(out, F.col("_gap_us") / F.lit(1e6))
            .drop("_slice", "_us", "_gap_us"))


def author_stats(comments: DataFrame, variant: str = "news", slices: int | None = None) -> DataFrame:
    """A-1, A-2, J-2, T-23, B-1 .. B-3: one row per non-null author."""
    return bot_flags(raw_author_stats(comments, variant, slices), VARIANTS[variant][1])


DEC = "decimal(38,0)"


def _exact_var(n: Column, s1: Column, s2: Column, ddof: int, scale: float = 1.0) -> Column:
    """Variance from integer moments: with q = S1 div n and r = S1 - n q, the squares around q sum up to
    M = S2 - 2 q S1 + n q^2, exactly, and the variance is (M - r^2 / n) / (n - ddof). M is no larger than S2, so nothing overflows that
    S2 itself doesn't; a sum of squared gaps is at most the square of the time span. One formula at every size; order independent."""
    q = F.floor(s1 / n).cast(DEC)
    m = s2 - F.lit(2).cast(DEC) * q * s1 + n.cast(DEC) * q * q
    r = (s1 - n.cast(DEC) * q).cast("double")
    return (m.cast("double") - r * r / n.cast("double")) / (n - ddof).cast("double") / F.lit(scale)


def raw_author_stats(comments: DataFrame, variant: str = "news", slices: int | None = None) -> DataFrame:
    """A-1 + A-2 before null -> 0: comment_count (rows, null text included),
    time_var_sec (population variance of the gaps between consecutive
    comments, null below two gaps), length_var (sample variance), avg_rep_ratio,
    avg_ai_prob.

    A comment's numbers (length, repetition, AI-likeness) are taken before the first
    exchange, and its text goes no further. They are written to the checkpoint folder, as the range partitioner reads its input twice,
    to sample and to deal out. One lineage: the sliced, windowed rows are summarised per (author, slice), on
    the exchange that the window made, then per author; the
    gaps across slice borders come from the ordered per-slice (min, max) list,
    which has at most one entry per slice. Variances use exact integer moments
    (microsecond gaps, code-point lengths), so they do not depend on how rows
    were split or merged.
    """
    single_var = VARIANTS[variant][0]
    numbers = comments.select(AUTHOR, "ts", ID, T.text_length(TEXT).cast("long").alias("_ln"), T.repetition_ratio(TEXT).alias("_rp"),
                              T.ai_likeness(TEXT, single_var).alias("_al"))
    ensure_checkpoint_dir(comments.sparkSession)
    rows = consecutive_gaps(numbers.checkpoint(eager=True), AUTHOR, "ts", ID, slices)
    g, ln = F.col("_gap_us").cast(DEC), F.col("_ln").cast(DEC)
    per_slice = (rows.groupBy(AUTHOR, "_slice").agg(
        F.count("*").alias("_n"),
        F.count("_gap_us").alias("_gn"), F.sum(g).alias("_g1"), F.sum(g * g).alias("_g2"),
        F.min("_us").alias("_lo"), F.max("_us").alias("_hi"),
        F.sum(ln).alias("_l1"), F.sum(ln * ln).alias("_l2"),
        F.sum("_rp").alias("_rep"),
        F.sum("_al").alias("_ai")))
    a = per_slice.groupBy(AUTHOR).agg(
        F.sum("_n").alias("n"), F.sum("_gn").alias("gn"),
        F.coalesce(F.sum("_g1"), F.lit(0).cast(DEC)).alias("g1"),
        F.coalesce(F.sum("_g2"), F.lit(0).cast(DEC)).alias("g2"),
        F.sum("_l1").alias("l1"), F.sum("_l2").alias("l2"),
        F.sum("_rep").alias("rep"), F.sum("_ai").alias("ai"),
        F.array_sort(F.collect_list(F.struct("_slice", "_lo", "_hi"))).alias("parts"))
    # gaps across slice borders: lo of slice k minus hi of slice k-1
    border = F.transform(F.sequence(F.lit(2), F.greatest(F.size("parts"), F.lit(1))),
                         lambda k: (F.element_at("parts", k)["_lo"]
                                    - F.element_at("parts", k - 1)["_hi"]).cast(DEC))
    border = F.when(F.size("parts") > 1, border).otherwise(F.array().cast(f"array<{DEC}>"))
    zero = F.lit(0).cast(DEC)
    a = (a.withColumn("_b", border)
         .withColumn("gn", F.col("gn") + F.size("_b"))
         .withColumn("g1", F.col("g1") + F.aggregate("_b", zero, lambda acc, x: acc + x))
         .withColumn("g2", F.col("g2") + F.aggregate("_b", zero, lambda acc, x: acc + x * x)))
    n = F.col("n")
    return a.select(
        AUTHOR,
        n.cast("long").alias("comment_count"),
        F.when(F.col("gn") >= 2, _exact_var(F.col("gn"), F.col("g1"), F.col("g2"), 0, 1e12)).alias("time_var_sec"),
        F.when(n >= 2, _exact_var(n, F.col("l1"), F.col("l2"), 1)).alias("length_var"),
        (F.col("rep") / n).alias("avg_rep_ratio"),
        (F.col("ai") / n).alias("avg_ai_prob"))


def bot_flags(stats: DataFrame, min_flags: int = NEWS_MIN_FLAGS) -> DataFrame:
    """B-1 .. B-3 on a stats table (after null -> 0 on every statistic)."""
    s = (stats.withColumn("time_var_hr", F.col("time_var_sec") / 3600.0)
         .fillna(0, subset=["comment_count", "time_var_sec", "length_var", "avg_rep_ratio",
                            "time_var_hr", "avg_ai_prob"]))
    speed = ((F.col("comment_count") >= MIN_COMMENTS_FOR_SPEED)
             & (F.col("time_var_hr") < MAX_TIME_VAR_HR)).cast("int")
    ai = (F.col("avg_ai_prob") > MIN_AI).cast("int")
    rep = (F.col("avg_rep_ratio") > MIN_REP).cast("int")
    low = (F.col("length_var") < MAX_LEN_VAR).cast("int")
    score = low.cast("double") * LOW_VAR_WEIGHT + rep.cast("double") * HIGH_REP_WEIGHT
    s = (s.withColumn("cond_speed", speed)
         .withColumn("cond_ai", ai)
         .withColumn("suspicious_score", score)
         .withColumn("cond_suspicious", (F.col("suspicious_score") > MIN_SUSPICIOUS).cast("int"))
         .withColumn("high_rep", rep)
         .withColumn("low_len_var", low))
    total = (F.col("cond_speed") + F.col("cond_ai") + F.col("cond_suspicious")
             + F.col("high_rep") + F.col("low_len_var"))
    return s.withColumn("is_bot", total >= min_flags).select(*STAT_COLUMNS)


def drop_bot_authors(comments: DataFrame, stats: DataFrame) -> DataFrame:
    """J-3: anti-join on author. Null-author comments are kept (they never
    enter the stats and a null key never matches)."""
    bots = stats.filter("is_bot").select(AUTHOR)
    return comments.join(bots, on=AUTHOR, how="left_anti")


def bot_filter(comments: DataFrame, variant: str = "news",
               slices: int | None = None) -> tuple[DataFrame, DataFrame]:
    """B-4: (kept comments, author stats). Rows whose timestamp does not parse
    are dropped from both; helper columns never reach the output (PF-4). Comments are written once, as statistics and result both read them, and
    so are the statistics: the anti-join then knows how few bots there are and needn't move the texts by author."""
    cols = comments.columns
    parsed = written(parse_published(comments), "comments")
    stats = written(author_stats(parsed, variant, slices), "authors")
    kept = drop_bot_authors(parsed, stats).select(*cols)
    return kept, stats
