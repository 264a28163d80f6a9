"""Raw web payloads as tables (IO-9 .. IO-13).

The reference fetched pages and JSONP comment payloads over HTTP one at a
time; here the fetched bodies are rows of a table and the parsing is column
expressions, so parsing scales with the cluster. HTML entity decoding is the
one per-row Python helper (stdlib ``html.unescape`` in an Arrow-batched pandas
UDF); everything else is native.
"""

from __future__ import annotations

import html as _html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Tp

from murmur.functions.text import let, unicode_strip

# Selector fallbacks of the article page parser, in order.
# Each entry is (tag, attribute regex or None) and matches the first element
# with that tag whose class attribute matches.
TITLE_SELECTORS = [
    (r"[a-z0-9]+", r"media_end_head_headline"),
    ("h2", None),
    ("div", r"news_title"),
    ("div", r"end_tit"),
]
DATE_SELECTORS = [
    ("span", r"media_end_head_info_datestamp_time\s(?:[^\"']*\s)?_ARTICLE_DATE_TIME|_ARTICLE_DATE_TIME\s(?:[^\"']*\s)?media_end_head_info_datestamp_time"),
    ("em", r"date"),
    ("span", r"date"),
    ("div", r"date"),
]
# Link prefixes the article search accepts.
ARTICLE_LINK_PREFIXES = ("https://n.news.naver.com", "https://m.entertain.naver.com")
# ``…article/{oid}/{aid}?…``
ARTICLE_ID_PATTERN = r"article/([^/]+)/([^/?]+)"


@F.pandas_udf(Tp.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    """Full HTML entity decoding (stdlib), Arrow-batched."""
    return s.map(lambda x: _html.unescape(x) if isinstance(x, str) else x)


# The entities that nearly all pages use, decoded natively; ``&amp;`` comes last.
COMMON_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]
_OTHER_ENTITY = r"&(?!(?:lt|gt|quot|#39|apos|nbsp|amp);)#?[A-Za-z0-9]|&amp;#?[A-Za-z0-9]+;?"


def unescape_html(df: DataFrame, columns: list[str]) -> DataFrame:
    """Decode HTML entities in ``columns``. Rows whose texts hold only the common ones stay native; only the others go to Python, as
    a branch of their own (a condition around a Python function would not keep rows from it)."""
    odd = F.lit(False)
    for c in columns:
        odd = odd | F.coalesce(F.col(c).rlike(_OTHER_ENTITY), F.lit(False))
    plain, rest = df.where(~odd), df.where(odd)
    for c in columns:
        text = F.col(c)
        for name, char in COMMON_ENTITIES:
            text = F.replace(text, F.lit(name), F.lit(char))
        plain = plain.withColumn(c, text)
        rest = rest.withColumn(c, _unescape(F.col(c)))
    return plain.unionByName(rest)


def _open_tag(tag: str, cls: str | None) -> str:
    """A start tag; ``cls`` matches one whole token of its class attribute."""
    attrs = r"(?:\s[^>]*)?" if cls is None else r"\s(?:[^>]*\s)?class\s*=\s*[\"'](?:[^\"']*\s)?(?:" + cls + r")(?:\s[^\"']*)?[\"'][^>]*"
    return rf"<(?:{tag})" + attrs + ">"


def element_inner(html: Column, tag: str, cls: str | None = None) -> Column:
    """Text inside the first ``tag`` element (optionally with a class) with tags removed; null if there is no such element.

    The element ends at the end tag that closes it, also where elements of its name are nested: what follows the start tag is cut
    at start and end tags of that name, and kept up to the cut where the depth falls to none."""
    start = "(?is)" + _open_tag(tag, cls)
    head = F.regexp_extract(html, start, 0)
    rest = F.substr(html, F.regexp_instr(html, F.lit(start)) + F.length(head))
    name = F.lower(F.regexp_extract(head, r"<([A-Za-z0-9]+)", 1))
    edge = F.concat(F.lit(r"(?i)</?"), name, F.lit(r"(?:\s[^>]*)?>"))
    tags = F.regexp_extract_all(rest, edge, F.lit(0))
    parts = F.split(rest, edge, -1)
    begin = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

    def step(acc, p):
        open_ = acc["depth"] > 0
        depth = F.when(p["tag"].startswith("</"), acc["depth"] - 1).otherwise(acc["depth"] + 1)
        return F.struct(F.when(open_, depth).otherwise(0).alias("depth"),
                        F.when(open_, F.concat(acc["text"], p["text"])).otherwise(acc["text"]).alias("text"))

    pairs = F.zip_with(parts, tags, lambda x, y: F.struct(x.alias("text"), F.coalesce(y, F.lit("</>")).alias("tag")))
    inner = F.aggregate(F.filter(pairs, lambda p: p["text"].isNotNull()), begin, step, lambda acc: acc["text"])
    return F.when(head != "", F.regexp_replace(inner, r"<[^>]*>", ""))


#: Between two tokens of a class attribute, in patterns of classes.
CLASS_GAP = r"\s(?:[^\"']*\s)?"


def _literal(tag: str, cls: str | None) -> str | None:
    """A lower-cased text that every page with such an element holds; null where the patterns don't tell."""
    if cls is None:
        return f"<{tag.lower()}" if tag.isalnum() else None
    tokens = [a.replace(CLASS_GAP, " ").split(" ") for a in cls.split("|")]
    if not all(re.fullmatch(r"[\w-]+", t, re.ASCII) for a in tokens for t in a):
        return None
    shared = set.intersection(*map(set, tokens))
    return max(shared, key=lambda t: (len(t), t)).lower() if shared else None


def first_present(html: Column, selectors) -> Column:
    """Ordered fallback: the first selector that finds an element wins; its raw text. A page is searched by a selector's pattern only if it
    holds the name that the pattern asks for."""
    def search(lowered: Column) -> Column:
        found = []
        for t, c in selectors:
            name = _literal(t, c)
            inner = element_inner(html, t, c)
            found.append(inner if name is None else F.when(F.contains(lowered, F.lit(name)), inner))
        return F.coalesce(*found)

    return let(F.lower(html), search)


def page_title(pages: DataFrame, title_selectors=TITLE_SELECTORS, date_selectors=DATE_SELECTORS,
               keep_incomplete: bool = False) -> DataFrame:
    """IO-11: article title and date by ordered selector fallbacks; rows keep
    only when both are present (unless ``keep_incomplete``)."""
    h = F.col("html")
    out = pages.select("page_id", "url", first_present(h, title_selectors).alias("title"), first_present(h, date_selectors).alias("date"))
    if not keep_incomplete:
        out = out.filter(F.col("title").isNotNull() & F.col("date").isNotNull())
    out = unescape_html(out, ["title", "date"])
    return out.withColumns({c: unicode_strip(F.col(c)) for c in ("title", "date")})


def page_links(pages: DataFrame, prefixes=ARTICLE_LINK_PREFIXES) -> DataFrame:
    """IO-12: distinct ``href`` values of a page that start with an allowed prefix."""
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(r"(?i)<a\s[^>]*href\s*=\s*\"([^\"]*)\""), 1)
    keep = F.lit(False)
    for p in prefixes:
        keep = keep | F.col("link").startswith(p)
    return (pages.select("page_id", F.explode(hrefs).alias("link"))
            .filter(keep).dropDuplicates(["page_id", "link"]))


def url_ids(url: Column, pattern: str = ARTICLE_ID_PATTERN) -> tuple[Column, Column]:
    """IO-13: ``(oid, aid)`` from an article URL; null when it does not match."""
    oid = F.regexp_extract(url, pattern, 1)
    aid = F.regexp_extract(url, pattern, 2)
    return F.when(oid != "", oid), F.when(aid != "", aid)


# ---------------------------------------------------------------------------
# IO-9 / IO-10: JSON payloads
# ---------------------------------------------------------------------------
PAYLOAD_SCHEMA = "struct<result:struct<commentList:array<map<string,string>>>>"


def unwrap_jsonp(payload: Column) -> Column:
    """Text between the first ``(`` and the last ``)``."""
    start = F.instr(payload, "(") + 1
    end = F.length(payload) - F.instr(F.reverse(payload), ")") + 1
    return payload.substr(start, end - start)


def payload_comments(payloads: DataFrame, payload_col: str = "payload", url_col: str = "url") -> DataFrame:
    """IO-9: one row per comment of a JSONP comment page.

    The page is parsed once, each comment as a map: ``modTime`` is used when the key is present (even if its value is null),
    else ``createTime``; the text is HTML-unescaped.
    """
    parsed = F.from_json(unwrap_jsonp(F.col(payload_col)), PAYLOAD_SCHEMA)
    rows = payloads.select(F.col(url_col).alias("url"), F.explode(parsed["result"]["commentList"]).alias("c"))
    c = F.col("c")
    out = rows.select("url", F.try_element_at(c, F.lit("maskedUserId")).alias("comment_author_id"),
                      F.when(F.map_contains_key(c, "modTime"), F.try_element_at(c, F.lit("modTime")))
                      .otherwise(F.try_element_at(c, F.lit("createTime"))).alias("comment_published"),
                      F.coalesce(F.try_element_at(c, F.lit("contents")), F.lit("")).alias("comment_text"))
    return unescape_html(out, ["comment_text"])


THREAD_SCHEMA = Tp.StructType([
    Tp.StructField("items", Tp.ArrayType(Tp.StructType([
        Tp.StructField("snippet", Tp.StructType([
            Tp.StructField("topLevelComment", Tp.StructType([
                Tp.StructField("snippet", Tp.StructType([
                    Tp.StructField("authorChannelId", Tp.StructType([Tp.StructField("value", Tp.StringType())])),
                    Tp.StructField("textDisplay", Tp.StringType()),
                    Tp.StructField("textOriginal", Tp.StringType()),
                    Tp.StructField("publishedAt", Tp.StringType()),
                    Tp.StructField("likeCount", Tp.LongType()),
                ])),
            ])),
        ])),
    ]))),
])


def thread_comments(threads: DataFrame, videos: DataFrame | None = None) -> DataFrame:
    """IO-10 + J-11: flatten comment-thread JSON (``video_id``, ``body``) to one
    row per comment; video attributes are attached by an equi-join on
    ``video_id``; missing likes default to 0; the author id may be null."""
    p = F.from_json(F.col("body"), THREAD_SCHEMA)
    rows = threads.select("video_id", F.explode(p["items"]).alias("it"))
    s = F.col("it.snippet.topLevelComment.snippet")
    flat = rows.select(
        "video_id",
        s["authorChannelId"]["value"].alias("comment_author_id"),
        F.coalesce(s["textDisplay"], F.lit("")).alias("comment_text"),
        s["publishedAt"].alias("comment_published"),
        F.coalesce(s["likeCount"], F.lit(0)).cast("long").alias("comment_likes"),
    )
    if videos is None:
        return flat
    return flat.join(videos, "video_id", "left")
