"""Secrets in texts: base patterns, and weak candidates that are reported only where complementary parts co-occur.

Base spans: assignments of at least 8 characters, access identifiers of at least 16, hexadecimal runs of at least 32. Weak
candidates alone mean little: a run of 32 characters or more of mixed letters and digits with its base64 padding, alone or
behind "=" or ":" (key=value), the name of a user or client, an endpoint. They are parts of one credential if they stand within ``reach`` code points of each other (the scope) without
overlapping. A weak secret is reported if an identifier or an endpoint is in its scope, a weak identifier if a secret is (base or weak),
an endpoint if both an identifier and a secret are. Candidates that overlap a base span are not reported anew.

How: all spans are found in one pass over the texts, as native expressions. Parts of texts with weak candidates (one text of each kind) are then
joined as intervals: every part enters the cells of ``reach`` code points that it touches, a candidate looks into its own and
the cells next to them; a cell holds a bounded number of parts, as parts don't overlap others of their kind.

Defined results: a very long text is handled whole, like any other (in one row); null and empty texts have no spans; rows with null or repeated ids are rows of their own; an empty table
gives no rows. Columns other than id and text are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage
from murmur.llm.spans import apart, listing, matches, of_kind

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{32,}+={0,2}+(?![A-Za-z0-9+/=_-])"
WEAK_ID = r"""(?i)(?<![A-Za-z])(?:user|username|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,64}"""
ENDPOINT = (r"(?:https?|ftp|jdbc:[a-z]{1,20}|postgres|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+"
            r"|(?<![A-Za-z0-9.-])[a-z0-9-]{1,63}\.[a-z0-9-]{1,63}\.(?:com|net|org|io|internal|local)(?::[0-9]{1,5})?(?![A-Za-z0-9.-])")
KINDS = ("assign", "access", "hex", "pair_secret", "pair_id", "pair_endpoint")
REACH = 256


def found_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k1, k2, base, weak): spans of each row's text, by start and kind; k1 and k2 name the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    t = F.col("t")
    assign = of_kind(matches(t, ASSIGN, t.rlike(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]")), 0,
                     lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 8)
    access = of_kind(matches(t, ACCESS, t.contains("AKIA")), 1, lambda v: F.length(v) >= 16)
    hexes = of_kind(matches(t, HEX, t.rlike("[0-9a-f]{32}")), 2)
    # both letters and digits, and not of lower-case hexadecimal alone
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & v.rlike("[G-Zg-z+/]")
    secrets = of_kind(matches(t, WEAK_SECRET, t.rlike("[A-Za-z0-9+/]{32}")), 3, mixed)
    names = of_kind(matches(t, WEAK_ID, t.rlike(r"(?i)(?:user|login|client_?id|account)")), 4)
    ends = of_kind(matches(t, ENDPOINT, t.contains("://") | t.rlike(r"\.(?:com|net|org|io|internal|local)")), 5)
    rows = rows.select("doc_id", F.xxhash64("t").alias("k1"), F.xxhash64(F.lit(1), "t").alias("k2"),
                       F.array_sort(F.concat(assign, access, hexes)).alias("base"), F.array_sort(F.concat(secrets, names, ends)).alias("weak"))
    return rows.withColumn("weak", F.filter("weak", lambda x: apart(x, F.col("base"))))


def linked(parts: DataFrame, reach: int) -> DataFrame:
    """Of (k1, k2, s, k, e): the weak ones (kind 3 and up) whose complements are in their scope, as (k1, k2, s, k, e)."""
    cells = lambda low, high: F.explode(F.sequence(F.floor(low / reach).cast("int"), F.floor(high / reach).cast("int")))
    role = F.when(F.col("k").isin(0, 2, 3), 0).when(F.col("k").isin(1, 4), 1).otherwise(2)  # secret, identifier, endpoint
    near = parts.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("s").alias("s2"), F.col("e").alias("e2"), role.alias("role"),
                        cells(F.col("s"), F.col("e")).alias("cell2"))
    weak = parts.where("k >= 3").withColumn("cell", cells(F.col("s") - reach, F.col("e") + reach))
    met = weak.join(near, (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2")) & (F.col("cell") == F.col("cell2"))
                    & (F.col("s2") <= F.col("e") + reach) & (F.col("e2") >= F.col("s") - reach)
                    & ((F.col("e2") <= F.col("s")) | (F.col("s2") >= F.col("e"))))
    has = lambda r: F.max((F.col("role") == r).cast("int")).alias(f"has{r}")
    met = met.groupBy("k1", "k2", "s", "k", "e").agg(has(0), has(1), has(2))
    ok = (F.when(F.col("k") == 3, (F.col("has1") + F.col("has2")) > 0).when(F.col("k") == 4, F.col("has0") > 0)
          .otherwise((F.col("has0") + F.col("has1")) == 2))
    return met.where(ok).select("k1", "k2", "s", "k", "e")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (s, k, e) by start and kind, k an index into KINDS; ``spans`` holds the base ones too."""
    rows = cut_lineage(found_spans(docs, id_col, text_col))
    parts = rows.where(F.size("weak") > 0).dropDuplicates(["k1", "k2"]).select("k1", "k2", F.explode(F.concat("base", "weak")).alias("p"))
    more = (linked(parts.select("k1", "k2", "p.*"), reach).groupBy("k1", "k2")
            .agg(F.collect_list(F.struct("s", "k", "e")).alias("more")))
    more = cut_lineage(more)
    none = F.array().cast("array<struct<s: int, k: int, e: int>>")
    out = rows.join(more, ["k1", "k2"], "left")
    return out.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and the listings of the spans."""
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(listing(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"), listing(F.col("spans"), KINDS).alias("spans"))

