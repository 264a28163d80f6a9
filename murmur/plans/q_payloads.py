"""Registered queries for JSON payload sources (IO-9, IO-10, J-11) and the link
set (S-2), with SQL oracles.

Testdata has no crawled payloads, so the payloads are *derived* from the
comments table by Spark (pages of at most 20 comments, HTML-escaped text, the
optional keys sometimes absent) and then parsed back by the source operators;
the oracle states what the parse must return.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.plans.catalog import register
from murmur.plans.oracle import ORACLE, TS_SQL, comments_cte
from murmur.sources import fixtures as FX
from murmur.sources import web as WB

PAGE_SIZE = 20
ISO = "yyyy-MM-dd'T'HH:mm:ss"
ISO_SQL = "%Y-%m-%dT%H:%M:%S"


def _escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _comments(spark, sf_dir):
    return FX.comments(spark, sf_dir, overlay=False).withColumn("page", F.floor(F.col("comment_id") / PAGE_SIZE))


def comment_pages(spark, sf_dir):
    """JSONP comment pages: one per (channel, page of <= 20 comment ids)."""
    c = _comments(spark, sf_dir)
    a = F.col("comment_author_id")
    item = F.struct(
        a.cast("string").alias("maskedUserId"),
        F.when(a % 3 != 0, F.date_format(F.timestamp_add("MINUTE", F.lit(1), "comment_published"), ISO))
        .alias("modTime"),
        F.date_format("comment_published", ISO).alias("createTime"),
        _escape(F.col("comment_text")).alias("contents"))
    pages = (c.groupBy("channel", "page")
             .agg(F.array_sort(F.collect_list(F.struct("comment_id", item.alias("item")))).alias("_l"),
                  F.count("*").alias("_n")))
    body = F.to_json(F.struct(F.struct(F.transform("_l", lambda x: x["item"]).alias("commentList"),
                                       F.col("_n").alias("totalCommentCount")).alias("result")))
    return pages.select(
        F.concat(F.lit("https://n.example/article/"), F.col("channel"), F.lit("/"), F.col("page").cast("string"))
        .alias("url"),
        F.concat(F.lit("jQuery1("), body, F.lit(");")).alias("payload"))


@register("payload_comments")
def q_payload_comments(spark, sf_dir):
    """IO-9: comments out of JSONP pages; modTime only when the key is present."""
    return WB.payload_comments(comment_pages(spark, sf_dir))


ORACLE["payload_comments"] = f"""WITH {comments_cte(False)}
SELECT 'https://n.example/article/' || channel || '/' || CAST(CAST(floor(comment_id / {PAGE_SIZE}) AS BIGINT) AS VARCHAR)
         AS url,
       CAST(comment_author_id AS VARCHAR) AS comment_author_id,
       CASE WHEN comment_author_id % 3 <> 0 THEN strftime(comment_published + INTERVAL 1 MINUTE, '{ISO_SQL}')
            ELSE strftime(comment_published, '{ISO_SQL}') END AS comment_published,
       comment_text
FROM comments"""


def thread_pages(spark, sf_dir):
    """Comment-thread JSON per (channel, page): author id and like count are
    sometimes absent."""
    c = _comments(spark, sf_dir)
    a = F.col("comment_author_id")
    snippet = F.struct(
        F.when(a % 5 != 0, F.struct(a.cast("string").alias("value"))).alias("authorChannelId"),
        F.col("comment_text").alias("textDisplay"),
        F.date_format("comment_published", ISO).alias("publishedAt"),
        F.when(a % 4 != 0, F.length("comment_text") % 7).alias("likeCount"))
    item = F.struct(F.struct(F.struct(snippet.alias("snippet")).alias("topLevelComment")).alias("snippet"))
    pages = c.groupBy("channel", "page").agg(
        F.array_sort(F.collect_list(F.struct("comment_id", item.alias("item")))).alias("_l"))
    return pages.select(F.col("channel").alias("video_id"),
                        F.to_json(F.struct(F.transform("_l", lambda x: x["item"]).alias("items"))).alias("body"))


def videos(spark, sf_dir):
    """Video attributes per channel, aggregated from the documents table."""
    d = FX.table(spark, sf_dir, "documents")
    return d.groupBy(F.col("source").alias("video_id")).agg(
        F.count("*").alias("video_comment_count"), F.sum("n_chars").alias("video_chars"))


_THREAD_SQL = f"""{comments_cte(False)},
flat AS (SELECT channel AS video_id,
                CASE WHEN comment_author_id % 5 <> 0 THEN CAST(comment_author_id AS VARCHAR) END AS comment_author_id,
                comment_text, strftime(comment_published, '{ISO_SQL}') AS comment_published,
                CAST(CASE WHEN comment_author_id % 4 <> 0 THEN length(comment_text) % 7 ELSE 0 END AS BIGINT)
                  AS comment_likes
         FROM comments)"""


@register("thread_comments")
def q_thread_comments(spark, sf_dir):
    """IO-10: comment-thread JSON flattened; likes default 0, author nullable."""
    return WB.thread_comments(thread_pages(spark, sf_dir))


ORACLE["thread_comments"] = f"WITH {_THREAD_SQL}\nSELECT * FROM flat"


@register("video_x_comment")
def q_video_x_comment(spark, sf_dir):
    """J-11: video attributes onto every comment (equi-join on video_id)."""
    return WB.thread_comments(thread_pages(spark, sf_dir), videos(spark, sf_dir))


ORACLE["video_x_comment"] = f"""WITH {_THREAD_SQL},
v AS (SELECT source AS video_id, count(*) AS video_comment_count, sum(n_chars) AS video_chars
      FROM documents GROUP BY source)
SELECT f.*, v.video_comment_count, v.video_chars FROM flat f LEFT JOIN v USING (video_id)"""


@register("distinct_links")
def q_distinct_links(spark, sf_dir):
    """S-2: the set of links over all pages (visited set)."""
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(r"(?i)<a\s[^>]*href\s*=\s*\"([^\"]*)\""), 1)
    return FX.pages(spark, sf_dir).select(F.explode(hrefs).alias("link")).distinct()


ORACLE["distinct_links"] = """
SELECT DISTINCT unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href\\s*=\\s*"([^"]*)"', 1)) AS link FROM pages"""

_ = TS_SQL
