"""Registered queries for sources, sinks and collection rules (2.1, W-4 .. W-8,
PF-10, PF-12, S-1) with their SQL oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.plans.catalog import register
from murmur.plans.oracle import ORACLE, TS_SQL, comments_cte, q
from murmur.session import ensure_checkpoint_dir
from murmur.sources import crawl as CR
from murmur.sources import files as FI
from murmur.sources import fixtures as FX
from murmur.sources import web as WB

WS = T.WS_RUN
def strip_sql(x: str) -> str:
    """Python ``str.strip()`` in SQL (same whitespace class as the Spark side)."""
    return f"regexp_replace({x}, " + q(f"^{WS}|{WS}$") + ", '', 'g')"


# ---------------------------------------------------------------------------
# IO-1 scan_comments: documents as comment files, one file per source
# ---------------------------------------------------------------------------
FILES = 4  # of a source


@register("scan_comments")
def q_scan_comments(spark, sf_dir):
    """IO-1: the documents as CSV files in the checkpoint folder, some for each source (a text's copies in one of them), read back; per file drop
    null, drop exact duplicates, strip, drop blank."""
    folder = f"{ensure_checkpoint_dir(spark)}/comments-{uuid.uuid4().hex}"
    d = FX.table(spark, sf_dir, "documents").select("source", F.col("text").alias("comment_text"), F.pmod(F.xxhash64("text"), F.lit(FILES)).alias("part"))
    FI.write_table(d.repartition("source", "part"), folder, "csv", partition_by=["source", "part"])
    read = FI.scan_comments(spark, [f"{folder}/*/*/*.csv"])
    return read.select(F.regexp_extract("file_path", "/source=([^/]*)/", 1).alias("file_path"), "text")


ORACLE["scan_comments"] = f"""
SELECT file_path, {strip_sql('text')} AS text
FROM (SELECT DISTINCT source AS file_path, text FROM documents WHERE text IS NOT NULL)
WHERE {strip_sql('text')} <> ''"""


# ---------------------------------------------------------------------------
# IO-4 time_label / PF-12 label_fallback on derived file paths
# ---------------------------------------------------------------------------
def _paths(spark, sf_dir):
    c = FX.comments(spark, sf_dir, overlay=False)
    d0 = F.date_format("comment_published", "yyyyMMdd")
    d1 = F.date_format(F.date_add(F.to_date("comment_published"), 2), "yyyyMMdd")
    md = F.date_format("comment_published", "MMdd")
    form = F.col("comment_id") % 3
    path = (F.when(form == 0, F.concat(F.lit("data/x_"), d0, F.lit("~"), d1, F.lit(".csv")))
            .when(form == 1, F.concat(F.lit("data/comments_"), md, F.lit("_"), md, F.lit(".csv")))
            .otherwise(F.concat(F.lit("data/"), F.col("channel"), F.lit(".csv"))))
    return c.withColumn("file_path", path)


_PATHS_SQL = f"""{comments_cte(False)},
paths AS (
  SELECT *, CASE comment_id % 3
      WHEN 0 THEN 'data/x_' || strftime(comment_published, '%Y%m%d') || '~'
                  || strftime(CAST(comment_published AS DATE) + INTERVAL 2 DAY, '%Y%m%d') || '.csv'
      WHEN 1 THEN 'data/comments_' || strftime(comment_published, '%m%d') || '_'
                  || strftime(comment_published, '%m%d') || '.csv'
      ELSE 'data/' || channel || '.csv' END AS file_path
  FROM comments)"""


def label_from_path_sql(p: str) -> str:
    name = f"regexp_extract({p}, '([^/\\\\]*)$', 1)"
    direct = f"regexp_extract({name}, '(\\d{{4}}_\\d{{4}})', 1)"
    a = f"regexp_extract({name}, '(\\d{{8}})~(\\d{{8}})', 1)"
    b = f"regexp_extract({name}, '(\\d{{8}})~(\\d{{8}})', 2)"
    return (f"CASE WHEN {direct} <> '' THEN {direct} WHEN {a} <> '' THEN substr({a}, 5, 4) || '_' || "
            f"substr({b}, 5, 4) ELSE 'unknown' END")


@register("time_label")
def q_time_label(spark, sf_dir):
    """IO-4: MMDD_MMDD label from a file name (three name forms)."""
    return _paths(spark, sf_dir).select("comment_id", "file_path",
                                        T.time_label_from_path(F.col("file_path")).alias("time_label"))


ORACLE["time_label"] = (f"WITH {_PATHS_SQL}\nSELECT comment_id, file_path, "
                        f"{label_from_path_sql('file_path')} AS time_label FROM paths")


@register("label_fallback")
def q_label_fallback(spark, sf_dir):
    """PF-12: own label unless null, else the label of the file path."""
    p = _paths(spark, sf_dir).withColumn(
        "time_label", F.when(F.col("comment_author_id") % 4 != 0, F.col("time_label")))
    return FI.label_fallback(p).select("comment_id", "time_label")


ORACLE["label_fallback"] = (f"WITH {_PATHS_SQL}\nSELECT comment_id, coalesce(CASE WHEN comment_author_id % 4 <> 0 "
                            f"THEN time_label END, {label_from_path_sql('file_path')}) AS time_label FROM paths")


# ---------------------------------------------------------------------------
# IO-11 .. IO-13 on raw pages
# ---------------------------------------------------------------------------
# Testdata pages carry the headline in <h1>; the fixture adds it as the last
# fallback after the reference selectors.
PAGE_TITLE_SELECTORS = WB.TITLE_SELECTORS + [("h1", None)]
PAGE_LINK_PREFIXES = ("/t",)
PAGE_ID_PATTERN = r"example\.[a-z]+/([^/]+)/([^/?#]+)"


@register("page_title")
def q_page_title(spark, sf_dir):
    """IO-11: title and date by ordered selector fallbacks, both required. Testdata pages have no date element; two in three get one
    appended, among elements whose class only looks like it."""
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    extra = (F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<span class="update">no</span><div class="x date"><div>2024-01-'), day,
                                                        F.lit("</div> 10:00</div>")))
             .when(F.col("page_id") % 3 == 1, F.concat(F.lit('<em class="date">2024-02-'), day, F.lit("</em>"))).otherwise(F.lit("")))
    pages = FX.pages(spark, sf_dir).withColumn("html", F.concat("html", extra))
    return WB.page_title(pages, PAGE_TITLE_SELECTORS).select("page_id", "title", "date")


def _elem_sql(tag: str, cls: str | None) -> str:
    if cls is None:
        attrs = r"(?:\s[^>]*)?"
    else:
        attrs = r"\s[^>]*class\s*=\s*[\"'][^\"']*(?:" + cls + r")[^\"']*[\"'][^>]*"
    close = r"[a-z0-9]+" if not tag.isalnum() else tag
    return r"(?is)<" + ("(?:" + tag + ")") + attrs + r">(.*?)</" + close + r"\s*>"


def _unescape_sql(x: str) -> str:
    # entities present in testdata pages (&amp; last so it is decoded once)
    for ent, ch in [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&middot;", "·"),
                    ("&copy;", "©"), ("&amp;", "&")]:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def _title_sql() -> str:
    parts = []
    for tag, cls in PAGE_TITLE_SELECTORS:
        pat = q(_elem_sql(tag, cls))
        inner = f"regexp_replace(regexp_extract(html, {pat}, 1), '<[^>]*>', '', 'g')"
        parts.append(f"CASE WHEN regexp_matches(html, {pat}) THEN {strip_sql(_unescape_sql(inner))} END")
    return "coalesce(" + ", ".join(parts) + ")"


ORACLE["page_title"] = (f"SELECT * FROM (SELECT page_id, {_title_sql()} AS title, '2024-0' || (page_id % 3 + 1) || '-' || "
                        "lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || CASE page_id % 3 WHEN 0 THEN ' 10:00' ELSE '' END AS date "
                        "FROM pages WHERE page_id % 3 < 2) WHERE title IS NOT NULL")


@register("page_links")
def q_page_links(spark, sf_dir):
    """IO-12: distinct links of a page with an allowed prefix."""
    return WB.page_links(FX.pages(spark, sf_dir), PAGE_LINK_PREFIXES)


ORACLE["page_links"] = """
SELECT DISTINCT page_id, link FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href\\s*=\\s*"([^"]*)"', 1)) AS link FROM pages)
WHERE starts_with(link, '/t')"""


@register("url_ids")
def q_url_ids(spark, sf_dir):
    """IO-13: two path ids of a page URL."""
    p = FX.pages(spark, sf_dir)
    oid, aid = WB.url_ids(F.col("url"), PAGE_ID_PATTERN)
    return p.select("page_id", oid.alias("oid"), aid.alias("aid"))


ORACLE["url_ids"] = f"""
SELECT page_id, nullif(regexp_extract(url, {q(PAGE_ID_PATTERN)}, 1), '') AS oid,
       nullif(regexp_extract(url, {q(PAGE_ID_PATTERN)}, 2), '') AS aid FROM pages"""


# ---------------------------------------------------------------------------
# IO-14 manifest, W-4 .. W-7 caps and cutoffs (events as the collection log)
# ---------------------------------------------------------------------------
@register("crawl_manifest")
def q_crawl_manifest(spark, sf_dir):
    """IO-14: day x keyword x page start over the days present in events."""
    days = FX.table(spark, sf_dir, "events").select(F.to_date(F.col("ts").cast("timestamp_ntz")).alias("day")).distinct()
    return CR.crawl_manifest(days, FX.candidate_names())


ORACLE["crawl_manifest"] = f"""
SELECT CAST(d.day AS VARCHAR) AS day, k.keyword, CAST(p.page_start AS BIGINT) AS page_start
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d,
     (SELECT unnest({FX.candidate_names()!r}) AS keyword) k,
     (SELECT range AS page_start FROM range({CR.PAGE_START}, {CR.PAGE_END}, {CR.PAGE_STEP})) p"""

W4_CAP = 20


def _links(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events")
    return ev.select(F.to_date(F.col("ts").cast("timestamp_ntz")).alias("day"), F.col("event_type").alias("keyword"),
                     F.col("props").alias("url"), F.col("event_id").alias("seq"))


@register("per_keyword_cap")
def q_per_keyword_cap(spark, sf_dir):
    """W-4: at most N distinct URLs per (day, keyword) in discovery order."""
    return CR.per_keyword_cap(_links(spark, sf_dir), W4_CAP)


ORACLE["per_keyword_cap"] = f"""
WITH links AS (SELECT CAST(ts AS DATE) AS day, event_type AS keyword, props AS url, event_id AS seq FROM events),
first AS (SELECT * FROM links QUALIFY row_number() OVER (PARTITION BY day, keyword, url ORDER BY seq) = 1)
SELECT CAST(day AS VARCHAR) AS day, keyword, url, seq FROM first
QUALIFY row_number() OVER (PARTITION BY day, keyword ORDER BY seq) <= {W4_CAP}"""

W5_TOTAL = 300


@register("per_channel_cap")
def q_per_channel_cap(spark, sf_dir):
    """W-5: at most total // n_channels comments per channel, queue order."""
    c = FX.comments(spark, sf_dir, overlay=False).withColumn("queue_pos", F.col("comment_id"))
    n_channels = c.select(F.countDistinct("channel")).first()[0]
    return CR.per_channel_cap(c, n_channels, W5_TOTAL).select("comment_id", "channel")


ORACLE["per_channel_cap"] = f"""
WITH {comments_cte(False)}
SELECT comment_id, channel FROM comments
QUALIFY row_number() OVER (PARTITION BY channel ORDER BY comment_id)
        <= {W5_TOTAL} // (SELECT count(DISTINCT channel) FROM comments)"""


@register("channel_counts")
def q_channel_counts(spark, sf_dir):
    """A-10: collected (capped) comments per channel; every channel of the
    channel dimension (all ``documents`` sources) appears, zeros included."""
    c = FX.comments(spark, sf_dir, overlay=False).withColumn("queue_pos", F.col("comment_id"))
    channels = FX.table(spark, sf_dir, "documents").select(F.col("source").alias("channel"))
    n_channels = channels.select(F.countDistinct("channel")).first()[0]
    return CR.channel_counts(CR.per_channel_cap(c, n_channels, W5_TOTAL), channels)


ORACLE["channel_counts"] = f"""
WITH {comments_cte(False)},
ch AS (SELECT DISTINCT source AS channel FROM documents),
capped AS (SELECT channel FROM comments
           QUALIFY row_number() OVER (PARTITION BY channel ORDER BY comment_id)
                   <= {W5_TOTAL} // (SELECT count(*) FROM ch)),
n AS (SELECT channel, count(*) AS n_comments FROM capped GROUP BY channel)
SELECT ch.channel, CAST(coalesce(n.n_comments, 0) AS BIGINT) AS n_comments
FROM ch LEFT JOIN n USING (channel)"""


@register("round_robin")
def q_round_robin(spark, sf_dir):
    """W-6: one video (here: one day of a channel) per channel per turn."""
    c = (FX.comments(spark, sf_dir, overlay=False)
         .withColumn("queue_pos", F.col("comment_id")).withColumn("video_id", F.col("time_label")))
    ch_ord = F.regexp_extract(F.col("channel"), r"(\d+)$", 1).cast("int")
    return CR.round_robin(c, ch_ord).select("comment_id", "channel", "turn", "channel_ord")


ORACLE["round_robin"] = f"""
WITH {comments_cte(False)},
v AS (SELECT channel, time_label, min(comment_id) AS first FROM comments GROUP BY ALL),
t AS (SELECT channel, time_label, dense_rank() OVER (PARTITION BY channel ORDER BY first, time_label) AS turn FROM v)
SELECT c.comment_id, c.channel, CAST(t.turn AS BIGINT) AS turn,
       CAST(regexp_extract(c.channel, '(\\d+)$', 1) AS BIGINT) AS channel_ord
FROM comments c JOIN t USING (channel, time_label)
ORDER BY turn, channel_ord, comment_id"""

SLOT_MINUTES = 10


def _pages_read(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")
    slot = F.floor((F.hour("ts") * 60 + F.minute("ts")) / SLOT_MINUTES)
    counts = (ev.select(F.to_date("ts").alias("day"), F.col("event_type").alias("keyword"),
                        (slot * CR.PAGE_STEP + 1).cast("int").alias("page_start"))
              .groupBy("day", "keyword", "page_start").agg(F.count("*").alias("n_links")))
    keys = ev.select(F.to_date("ts").alias("day"), F.col("event_type").alias("keyword")).distinct()
    n_slots = 24 * 60 // SLOT_MINUTES
    grid = keys.withColumn("page_start", F.explode(F.sequence(
        F.lit(1), F.lit(1 + (n_slots - 1) * CR.PAGE_STEP), F.lit(CR.PAGE_STEP))))
    return grid.join(counts, ["day", "keyword", "page_start"], "left").fillna(0, subset=["n_links"])


@register("empty_run_cutoff")
def q_empty_run_cutoff(spark, sf_dir):
    """W-7: pages read until five consecutive empty pages."""
    return CR.empty_run_cutoff(_pages_read(spark, sf_dir))


ORACLE["empty_run_cutoff"] = f"""
WITH ev AS (SELECT CAST(ts AS TIMESTAMP) AS ts, event_type FROM events),
counts AS (SELECT CAST(ts AS DATE) AS day, event_type AS keyword,
                  CAST(floor((hour(ts) * 60 + minute(ts)) / {SLOT_MINUTES}) * {CR.PAGE_STEP} + 1 AS INTEGER) AS page_start,
                  count(*) AS n_links FROM ev GROUP BY ALL),
keys AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS keyword FROM ev),
grid AS (SELECT k.day, k.keyword, CAST(r.range AS INTEGER) AS page_start
         FROM keys k, range(1, {1 + (24 * 60 // SLOT_MINUTES - 1) * CR.PAGE_STEP + 1}, {CR.PAGE_STEP}) r),
pg AS (SELECT g.*, coalesce(c.n_links, 0) AS n_links, CAST(coalesce(c.n_links, 0) = 0 AS INTEGER) AS e
       FROM grid g LEFT JOIN counts c USING (day, keyword, page_start)),
isl AS (SELECT *, sum(1 - e) OVER (PARTITION BY day, keyword ORDER BY page_start ROWS UNBOUNDED PRECEDING) AS island
        FROM pg),
run AS (SELECT *, sum(e) OVER (PARTITION BY day, keyword, island ORDER BY page_start ROWS UNBOUNDED PRECEDING) AS r
        FROM isl),
stop AS (SELECT *, min(CASE WHEN r >= {CR.MAX_CONSECUTIVE_EMPTY} THEN page_start END)
                     OVER (PARTITION BY day, keyword) AS stop_page FROM run)
SELECT CAST(day AS VARCHAR) AS day, keyword, CAST(page_start AS BIGINT) AS page_start, n_links FROM stop
WHERE e = 0 AND (stop_page IS NULL OR page_start < stop_page)"""


@register("category_filter")
def q_category_filter(spark, sf_dir):
    """PF-10: keep items of one category (events of one type)."""
    ev = FX.table(spark, sf_dir, "events").select("event_id", "user_id",
                                                  F.col("event_type").alias("video_category_id"))
    return CR.category_filter(ev, "purchase")


ORACLE["category_filter"] = ("SELECT event_id, user_id, event_type AS video_category_id FROM events "
                             "WHERE event_type = 'purchase'")


@register("stable_id")
def q_stable_id(spark, sf_dir):
    """W-8: consecutive ids in load order (source, doc_id) without a one-task window."""
    d = FX.table(spark, sf_dir, "documents").select("doc_id", "source", "text", "lang")
    return FI.stable_id(d, ["source", "doc_id"], "seq_id")


ORACLE["stable_id"] = ("SELECT doc_id, source, text, lang, CAST(row_number() OVER (ORDER BY source, doc_id) - 1 AS BIGINT) "
                       "AS seq_id FROM documents")


@register("union_frames")
def q_union_frames(spark, sf_dir):
    """IO-15: tables of different columns concatenated by name."""
    frames = [FX.table(spark, sf_dir, "documents").select("doc_id", "lang"),
              FX.table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url"),
              FX.table(spark, sf_dir, "labels").select("doc_id", "quality")]
    return FI.union_frames(spark, frames, "doc_id long, lang string, url string, quality int")


ORACLE["union_frames"] = ("SELECT doc_id, lang, NULL AS url, CAST(NULL AS BIGINT) AS quality FROM documents UNION ALL "
                          "SELECT page_id, NULL, url, NULL FROM pages UNION ALL SELECT doc_id, NULL, NULL, quality FROM labels")


@register("union_all")
def q_union_all(spark, sf_dir):
    """S-1: plain and overlaid comments stacked (duplicates kept)."""
    a = FX.comments(spark, sf_dir, overlay=False).select("comment_id", "comment_text", F.lit("plain").alias("tag"))
    b = FX.comments(spark, sf_dir, overlay=True).select("comment_id", "comment_text", F.lit("overlay").alias("tag"))
    return a.unionByName(b)


ORACLE["union_all"] = (f"WITH {comments_cte(False, 'plain')}, {comments_cte(True)}\n"
                       "SELECT comment_id, comment_text, 'plain' AS tag FROM plain UNION ALL "
                       "SELECT comment_id, comment_text, 'overlay' AS tag FROM comments")

_ = TS_SQL
