"""Collection bookkeeping as table operators (IO-14, W-4 .. W-7, PF-10).

The reference's crawlers made these decisions inside nested loops while
fetching. Here the fetched results are tables and each rule is a declarative
operator: generators for request grids, windows with a row limit for caps
(Spark inserts a partial per-group limit before the shuffle, so a hot group
never moves more than ``cap`` rows per map task), and a scan in slices for
the empty-page cutoff.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.session import ensure_checkpoint_dir, shuffle_partitions

# Search paging grid and stop rule.
PAGE_START = 1
PAGE_END = 2000          # exclusive
PAGE_STEP = 10
MAX_CONSECUTIVE_EMPTY = 5
MAX_ARTICLES_PER_KEYWORD = 6000
TOTAL_COMMENT_LIMIT = 300_000
POLITICS_CATEGORY = "25"


def crawl_manifest(days: DataFrame, keywords: Sequence[str], day_col: str = "day",
                   start: int = PAGE_START, end: int = PAGE_END, step: int = PAGE_STEP) -> DataFrame:
    """IO-14: the request grid day x keyword x page start (1, 11, ..., 1991).

    ``days`` is a table of days (e.g. ``explode(sequence(d0, d1))`` for an
    inclusive range); keywords and page starts are generated per row, so no
    join is involved.
    """
    last = start + ((end - 1 - start) // step) * step
    return (days.select(F.col(day_col).alias("day"))
            .withColumn("keyword", F.explode(F.array(*[F.lit(k) for k in keywords])))
            .withColumn("page_start", F.explode(F.sequence(F.lit(start), F.lit(last), F.lit(step)))))


def day_range(spark, start: str, end: str, inclusive: bool = True) -> DataFrame:
    """Days from ``start`` to ``end`` (inclusive, or end-exclusive for the
    video search grid)."""
    stop = F.to_date(F.lit(end)) if inclusive else F.date_sub(F.to_date(F.lit(end)), 1)
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), stop)).alias("day"))


SALT_BUCKETS = 64


def per_group_cap(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], cap: int,
                  distinct_on: str | None = None, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """W-4 / W-5: keep at most ``cap`` rows per group in ``order`` (exact).

    Two-phase top-N so a hot group is never sorted in one task: rows are
    salted into ``salt_buckets`` sub-groups and each sub-group keeps its own
    first ``cap`` rows (every row of the group's top ``cap`` survives this);
    the final rank then sees at most ``salt_buckets * cap`` rows per group.
    ``order`` must be a total order within a group.

    With ``distinct_on`` the value is first reduced to its first occurrence in
    the group (the visited-set rule), then capped.
    """
    ordcols = [F.col(o) if isinstance(o, str) else o for o in order]
    if distinct_on is not None:
        # first occurrence of each value: a partial-aggregated min, then a semi join
        key = order[0]
        first = df.groupBy(*group, distinct_on).agg(F.min(key).alias(key))
        df = df.join(first, [*group, distinct_on, key], "left_semi")
    if salt_buckets and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*ordcols), F.lit(salt_buckets))
        ws = Window.partitionBy(*group, salt).orderBy(*ordcols)
        df = df.withColumn("_salt_rank", F.row_number().over(ws)).filter(F.col("_salt_rank") <= cap) \
            .drop("_salt_rank")
    w = Window.partitionBy(*group).orderBy(*ordcols)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= cap).drop("_rank")


def per_keyword_cap(links: DataFrame, cap: int = MAX_ARTICLES_PER_KEYWORD) -> DataFrame:
    """W-4: at most ``cap`` distinct URLs per (day, keyword), in discovery
    order (``seq``); the counter restarts for every (day, keyword)."""
    return per_group_cap(links, ["day", "keyword"], ["seq"], cap, distinct_on="url")


def per_channel_cap(comments: DataFrame, n_channels: int, total_limit: int = TOTAL_COMMENT_LIMIT,
                    channel: str = "channel", order: str = "queue_pos") -> DataFrame:
    """W-5: at most ``total_limit // n_channels`` comments per channel in queue
    order. The global cap can never bind first (n * (T // n) <= T)."""
    return per_group_cap(comments, [channel], [order], total_limit // n_channels)


def channel_counts(comments: DataFrame, channels: DataFrame, channel: str = "channel") -> DataFrame:
    """A-10: comments per channel over the whole channel dimension, zeros
    included. Counts are aggregated first (partial aggregation, one row per
    channel), then the dimension is left-joined to them."""
    counts = comments.groupBy(channel).agg(F.count(F.lit(1)).alias("n_comments"))
    return (channels.select(channel).distinct().join(counts, channel, "left")
            .select(channel, F.coalesce(F.col("n_comments"), F.lit(0)).cast("bigint").alias("n_comments")))


def round_robin(comments: DataFrame, channel_order: Column, video: str = "video_id",
                channel: str = "channel", order: str = "queue_pos") -> DataFrame:
    """W-6: interleave channels one video per turn, in channel order.

    A video's turn is its dense rank inside its channel by first queue
    position; ranks are computed on the (small) per-video table and joined
    back, so no window runs over all comments of a channel.
    """
    videos = (comments.groupBy(channel, video).agg(F.min(order).alias("_first"))
              .withColumn("turn", F.dense_rank().over(Window.partitionBy(channel).orderBy("_first", video))))
    return (comments.join(videos.select(channel, video, "turn"), [channel, video])
            .withColumn("channel_ord", channel_order)
            .orderBy("turn", "channel_ord", order))


def empty_run_cutoff(pages: DataFrame, group: Sequence[str] = ("day", "keyword"), page: str = "page_start",
                     n_links: str = "n_links", max_empty: int = MAX_CONSECUTIVE_EMPTY) -> DataFrame:
    """W-7: pages of a (day, keyword) are read in order until ``max_empty``
    consecutive empty pages; returns the non-empty pages read before that.

    The pages are range-partitioned, so that a (day, keyword) with very many of them lies in many slices. Each slice counts its runs of
    empty pages and reports how it begins and ends; over the slices of a group, in order, the reports are combined (a slice that is empty
    throughout passes the run on), which gives every slice the run that it starts in. The first page at which a run reaches ``max_empty``
    is then a minimum over slices. No task holds more than a slice of a group.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    g = list(group)
    slices = max(1, shuffle_partitions(pages.sparkSession))
    empty = (F.coalesce(F.col(n_links), F.lit(0)) == 0).cast("int")
    rows = (pages.withColumn("_empty", empty).repartitionByRange(slices, *g, page)
            .withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True))
    inside = Window.partitionBy("_slice", *g).orderBy(page).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(inside)).withColumn("_full", F.sum(1 - F.col("_empty")).over(inside))
    rows = rows.withColumn("_run", F.col("_n") - F.coalesce(F.max(F.when(F.col("_empty") == 0, F.col("_n"))).over(inside), F.lit(0)))
    # one row a slice and group: its pages, whether all are empty, the run at its end
    ends = rows.groupBy("_slice", *g).agg(F.max("_n").alias("_all"), (F.max("_full") == 0).alias("_through"), F.max_by("_run", "_n").alias("_last"))
    order = Window.partitionBy(*g).orderBy("_slice")
    ends = ends.withColumn("_block", F.sum(F.when(F.col("_through"), 0).otherwise(1)).over(order))
    ends = ends.withColumn("_after", F.sum(F.when(F.col("_through"), F.col("_all")).otherwise(F.col("_last"))).over(Window.partitionBy(*g, "_block").orderBy("_slice")))
    ends = ends.withColumn("_before", F.coalesce(F.lag("_after").over(order), F.lit(0))).select("_slice", *g, "_before")
    rows = _same_slice(rows, ends, g)
    run = F.col("_run") + F.when(F.col("_full") == 0, F.col("_before")).otherwise(0)
    firsts = rows.groupBy("_slice", *g).agg(F.min(F.when((F.col("_empty") == 1) & (run >= max_empty), F.col(page))).alias("_first"))
    stops = firsts.withColumn("_stop", F.min("_first").over(Window.partitionBy(*g))).select("_slice", *g, "_stop")
    return (_same_slice(rows, stops, g)
            .filter((F.col("_empty") == 0) & (F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))))
            .drop("_empty", "_slice", "_n", "_full", "_run", "_before", "_stop"))


def _same_slice(rows: DataFrame, of_slices: DataFrame, group: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of their slice and group; null keys are a group."""
    keys = ["_slice", *group]
    other = of_slices.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[c for c in of_slices.columns if c not in keys])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & rows[k].eqNullSafe(other[f"_key{i}"])
    return rows.join(other, on).drop(*[f"_key{i}" for i in range(len(keys))])


def category_filter(videos: DataFrame, category: str = POLITICS_CATEGORY,
                    col: str = "video_category_id") -> DataFrame:
    """PF-10: keep videos of one category id."""
    return videos.filter(F.col(col) == category)
