"""Text column expressions (T-1 .. T-8, T-13 .. T-15, IO-4, PF-6, PF-7, PF-9).

Everything here returns a ``Column`` built from native Spark SQL functions, so it
runs inside whole-stage codegen; no Python executes per row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Characters Python's ``str.split()`` / ``str.strip()`` treat as whitespace:
# TAB LF VT FF CR, the four information separators U+001C..U+001F, SPACE,
# NEL U+0085, NBSP U+00A0, U+1680, U+2000..U+200A, LINE SEP U+2028,
# PARAGRAPH SEP U+2029, U+202F, U+205F, IDEOGRAPHIC SPACE U+3000.
# Written in a syntax both Java regex and RE2 accept, so the SQL oracle uses
# the very same class.
WS_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\xA0\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
WS_RUN = WS_CLASS + "+"
# The same set split in two: rare Unicode spaces are first mapped to ' ' with a
# per-character ``translate`` (cheap), so the split regex is a small ASCII class.
UNICODE_SPACES = "\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
ASCII_WS_RUN = r"[\t\n\x0B\f\r\x1C-\x1F ]+"

# Emotional markers: laughing, smiling, crying jamo runs and tripled ! / ?.
EMOTIONS = ("ㅋㅋ", "ㅎㅎ", "ㅠㅠ", "!!!", "???")
EMOTION_PATTERN = "ㅋㅋ|ㅎㅎ|ㅠㅠ|!!!|\\?\\?\\?"

# Default token patterns: two or more Hangul syllables (reference), and a
# script-neutral letter/digit run used on the (European-language) testdata.
HANGUL_TOKEN = r"(?U)\b([가-힣]{2,})\b"
LETTER_TOKEN = r"([\p{L}\p{N}_]{2,})"

# Sentiment label keywords, in the order the rules test them.
POSITIVE_KEYS = ("positive", "pos", "긍정")
NEGATIVE_KEYS = ("negative", "neg", "부정")
NEUTRAL_KEYS = ("neutral", "none", "중립")
HOSTILE_KEYS = ("hate", "offensive")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# T-1 .. T-3: per-comment behavioural measures
# ---------------------------------------------------------------------------
def text_length(text) -> Column:
    """T-1: length in code points, null -> 0."""
    return F.length(F.coalesce(_c(text), F.lit("")))


def unicode_strip(text) -> Column:
    """Strip leading/trailing whitespace with Python's notion of whitespace."""
    return F.regexp_replace(_c(text), f"^{WS_RUN}|{WS_RUN}$", "")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body(value)``: the value is computed a
    single time per row even when ``body`` uses it several times (a one-element
    ``transform`` acts as a let-binding inside one expression)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text) -> Column:
    """Whitespace tokens exactly as Python's ``str.split()`` (no empties)."""
    t = F.translate(F.coalesce(_c(text), F.lit("")), UNICODE_SPACES, " " * len(UNICODE_SPACES))
    return F.filter(F.split(t, ASCII_WS_RUN), lambda w: w != F.lit(""))


def repetition_ratio(text) -> Column:
    """T-2: 1 - distinct words / words; 0 when there are no words."""
    return let(words(text), lambda w: F.when(
        F.size(w) > 0, F.lit(1.0) - F.size(F.array_distinct(w)) / F.size(w)).otherwise(F.lit(0.0)))


def _var_pop_of(arr: Column, total: Column) -> Column:
    """Population variance of a numeric array whose sum is known, two-pass
    (mean first, then squared deviations) like numpy's ``var``."""
    return let(total / F.size(arr), lambda mean: F.aggregate(
        arr, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / F.size(arr))


def ai_likeness(text, single_segment_var: float | None = None) -> Column:
    """T-3: mean of three 0/1 tests.

    (a) population variance of the lengths of non-empty ``.``-segments < 50;
        with at most one segment the variance is ``single_segment_var``
        (None -> test false, the news variant; 0.0 -> test true, video variant)
    (b) count of ``[.!?]`` / (count of ``.`` + 1) > 0.8
    (c) no emotional marker and length > 50

    The segment-length array is built once per row; its sum is the number of
    non-dot characters, so only the squared deviations need a pass.
    """
    t = F.coalesce(_c(text), F.lit(""))
    fallback = F.lit(None).cast("double") if single_segment_var is None else F.lit(float(single_segment_var))
    dots = F.regexp_count(t, F.lit("\\."))
    seg_len = F.transform(F.regexp_extract_all(t, F.lit("([^.]+)"), 1), lambda s: F.length(s).cast("double"))
    non_dot = (F.length(t) - dots).cast("double")
    var = let(seg_len, lambda L: F.when(F.size(L) > 1, _var_pop_of(L, non_dot)).otherwise(fallback))
    a = F.coalesce((var < 50).cast("double"), F.lit(0.0))
    punct = F.regexp_count(t, F.lit("[.!?]"))
    b = ((punct / (dots + 1)) > 0.8).cast("double")
    emotional = reduce(or_, [t.contains(x) for x in EMOTIONS])  # plain searches, as the markers are plain strings
    c = ((~emotional) & (F.length(t) > 50)).cast("double")
    return (a + b + c) / 3.0


# ---------------------------------------------------------------------------
# T-4 .. T-8: tokens and keyword scores
# ---------------------------------------------------------------------------
def regex_tokens(text, pattern: str = HANGUL_TOKEN) -> Column:
    """T-4: all matches of group 1 of ``pattern`` (order kept, case kept)."""
    return F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(pattern), 1)


def ws_tokens(text, min_len: int = 2) -> Column:
    """T-5: whitespace tokens of length >= min_len."""
    return F.filter(words(text), lambda w: F.length(w) >= min_len)


def keyword_count(text, keyword: str) -> Column:
    """T-6: non-overlapping occurrences of ``keyword`` in lower-cased text."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    k = keyword.lower()
    return ((F.length(t) - F.length(F.replace(t, F.lit(k), F.lit("")))) / F.lit(len(k))).cast("long")


def _borders(word: str) -> bool:
    """Can two occurrences of the word overlap?"""
    return any(word.startswith(word[-n:]) for n in range(1, len(word)))


def keyword_hits(text, keywords: Sequence[str]) -> Column:
    """T-6 for long lists: the sum of ``keyword_count`` over all ``keywords``, without a pass over the text for each.

    The text's characters are taken apart once. For each length that keywords have, the pieces of this length at all positions are looked up in the
    set of these keywords (a hash set; overlapping hits of different keywords all count). Keywords that can overlap
    themselves count without overlaps: their few hits are gone through in order. A keyword that is listed twice counts twice."""
    by: dict[tuple[int, int], list[str]] = {}
    for k, n in Counter(k.lower() for k in keywords if k).items():
        by.setdefault((len(k), n), []).append(k)

    def count(chars: Column) -> Column:
        total = F.lit(0).cast("long")
        for (size, times), words in sorted(by.items()):
            starts = F.when(F.size(chars) >= size, F.sequence(F.lit(1), F.size(chars) - (size - 1))).otherwise(F.array().cast("array<int>"))
            piece = lambda i, size=size: F.array_join(F.slice(chars, i, size), "")
            free, own = [w for w in words if not _borders(w)], [w for w in words if _borders(w)]
            if free:
                total = total + times * F.size(F.filter(starts, lambda i: piece(i).isin(free)))
            if own:
                hits = F.filter(F.transform(starts, lambda i: F.struct(i.alias("i"), piece(i).alias("w"))), lambda x: x["w"].isin(own))
                zero = F.struct(F.lit(1).alias("next"), F.lit(0).alias("n"))

                def apart(found: Column, word: Column, size=size, zero=zero) -> Column:
                    step = lambda acc, x: F.when((x["w"] == word) & (x["i"] >= acc["next"]), F.struct((x["i"] + size).alias("next"), (acc["n"] + 1).alias("n"))).otherwise(acc)
                    return F.aggregate(found, zero, step)["n"]

                total = total + times * let(hits, lambda h: F.aggregate(F.array_distinct(F.transform(h, lambda x: x["w"])), F.lit(0), lambda acc, w: acc + apart(h, w)))
        return total.cast("long")

    return let(F.split(F.lower(F.coalesce(_c(text), F.lit(""))), ""), lambda c: count(F.filter(c, lambda x: x != "")))


#: Keywords of all labels together from which on they are looked up in sets.
MANY_KEYWORDS = 64


def keyword_classify(text, axes: dict[str, Sequence[str]], default: str) -> Column:
    """T-8: score each label by the summed hits of its keywords and return the
    first label (declared order) with the maximum score; all-zero -> default."""
    labels = list(axes)
    if sum(map(len, axes.values())) > MANY_KEYWORDS:
        scores = [keyword_hits(text, axes[lbl]) for lbl in labels]
    else:
        scores = [sum((keyword_count(text, k) for k in axes[lbl]), F.lit(0)) for lbl in labels]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    expr = F.lit(default)
    for lbl, sc in reversed(list(zip(labels, scores))):
        expr = F.when((sc == best) & (best > 0), F.lit(lbl)).otherwise(expr)
    return expr


# ---------------------------------------------------------------------------
# Labels and names
# ---------------------------------------------------------------------------
def time_label_from_path(path) -> Column:
    """IO-4: ``MMDD_MMDD`` label from a file path.

    First ``\\d{4}_\\d{4}`` in the base name; else ``YYYYMMDD~YYYYMMDD`` with the
    years dropped; else ``unknown``.
    """
    name = F.regexp_extract(_c(path), r"([^/\\]*)$", 1)
    direct = F.regexp_extract(name, r"(\d{4}_\d{4})", 1)
    a = F.regexp_extract(name, r"(\d{8})~(\d{8})", 1)
    b = F.regexp_extract(name, r"(\d{8})~(\d{8})", 2)
    return (F.when(direct != "", direct)
            .when(a != "", F.concat(F.substring(a, 5, 4), F.lit("_"), F.substring(b, 5, 4)))
            .otherwise(F.lit("unknown")))


def topic_label(topic_keywords, topic_id) -> Column:
    """T-7: first comma part of the keyword string, trimmed, whitespace runs
    -> ``_``; blank / ``nan`` / null -> ``topic_{id}``."""
    kw = unicode_strip(F.coalesce(_c(topic_keywords).cast("string"), F.lit("")))
    first = unicode_strip(F.split_part(kw, F.lit(","), F.lit(1)))
    clean = F.regexp_replace(first, WS_RUN, "_")
    fallback = F.concat(F.lit("topic_"), _c(topic_id).cast("string"))
    return F.when((kw == "") | (F.lower(kw) == "nan") | (clean == ""), fallback).otherwise(clean)


def final_cluster(topic_label_col, candidate) -> Column:
    """PF-7: ``topic_label + "_" + candidate``."""
    return F.concat(_c(topic_label_col), F.lit("_"), _c(candidate))


def candidate_of_cluster(cluster, candidates: Sequence[str]) -> Column:
    """PF-6: first candidate (list order) contained in the cluster name;
    null -> ``unknown``; none -> ``other``."""
    expr = F.lit("other")
    for cand in reversed(list(candidates)):
        expr = F.when(_c(cluster).contains(cand), F.lit(cand)).otherwise(expr)
    return F.when(_c(cluster).isNull(), F.lit("unknown")).otherwise(expr)


def cluster_phrase(cluster) -> Column:
    """PF-9: cluster name as text: ``_`` -> `` 관련 ``; null -> ``알 수 없음``."""
    return F.coalesce(F.replace(_c(cluster), F.lit("_"), F.lit(" 관련 ")), F.lit("알 수 없음"))


def keyword_string(words_arr, topic_id=None, outlier_id: int = -1, k: int = 5) -> Column:
    """T-13: first ``k`` words joined by ``", "``; the outlier topic -> ``outlier``."""
    s = F.array_join(F.slice(_c(words_arr), 1, k), ", ")
    if topic_id is None:
        return s
    return F.when(_c(topic_id) == outlier_id, F.lit("outlier")).otherwise(s)


def topic_probability(topic_id, dist) -> Column:
    """T-14: the topic's own entry of the distribution, or its max when the
    topic is the outlier / out of range; absent or empty -> 0.0."""
    d = _c(dist)
    t = _c(topic_id)
    own = F.try_element_at(d, (t + 1).cast("int"))
    pick = F.when((t >= 0) & (t < F.size(d)), own).otherwise(F.array_max(d))
    return F.coalesce(F.when(F.size(d) > 0, pick), F.lit(0.0)).cast("double")


def _contains_any(s: Column, keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | s.contains(k)
    return out


def sentiment_label(label, id2label: dict[int, str] | None = None, num_labels: int = 2) -> Column:
    """T-15: map a classifier label to positive / negative / neutral.

    Direct substring rules first (positive, negative, neutral, then
    hate/offensive -> negative); then ``label_N`` through ``id2label`` (there
    hate/offensive rank before neutral); then, for binary models only,
    1 -> positive, other -> negative; otherwise neutral.
    """
    s = F.lower(unicode_strip(_c(label).cast("string")))
    idx = F.when(s.startswith("label_"),
                 unicode_strip(F.split_part(s, F.lit("_"), F.lit(2))).try_cast("int"))
    mapping = {int(k): str(v).lower() for k, v in (id2label or {}).items()}
    if mapping:
        m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        name = F.coalesce(F.element_at(m, idx.cast("int")), F.lit(""))
    else:
        name = F.lit("")
    via_idx = (F.when(_contains_any(name, POSITIVE_KEYS), "positive")
               .when(_contains_any(name, NEGATIVE_KEYS + HOSTILE_KEYS), "negative")
               .when(_contains_any(name, NEUTRAL_KEYS), "neutral"))
    if num_labels == 2:
        via_idx = via_idx.when(idx == 1, "positive").when(idx.isNotNull(), "negative")
    via_idx = via_idx.otherwise("neutral")
    return (F.when(_contains_any(s, POSITIVE_KEYS), "positive")
            .when(_contains_any(s, NEGATIVE_KEYS), "negative")
            .when(_contains_any(s, NEUTRAL_KEYS), "neutral")
            .when(_contains_any(s, HOSTILE_KEYS), "negative")
            .when(idx.isNotNull(), via_idx)
            .otherwise("neutral"))
