"""Quality rules with risk-controlled cutoffs.

Every rule is a whole number from 0 to 255 that grows with how odd a text is; it rejects a text at or
above a cutoff. Cutoffs are set for each stratum (language) and rule on the labelled documents,
which no rule was made from. A cutoff is certified if an exact binomial test shows, at level
``delta`` divided by the number of strata and rules (Bonferroni), that it rejects at most
``alpha`` / (number of rules) of the good documents of its stratum; so with confidence 1 - delta, all
rules together reject at most ``alpha`` of the good documents of every stratum. Inside a stratum and
rule, cutoffs are tested from the mildest on and testing stops at the first failure (fixed sequence,
which needs no further correction). Of the certified cutoffs the one with the most rejected bad documents
less ``cost`` times the rejected good ones is used (shares; ties: the mildest), none if that isn't above 0.
A stratum with too few labelled good documents certifies nothing and rejects nothing.

Defined results: a very long text is handled whole, like any other (a task holds one batch of texts); a null text has no words and fails the base; a null stratum is one of its own;
labels that are null are not used, several labels of an id count as one (the smallest); a document with a
null id is judged like any other; repeated rows are judged alike; empty tables give empty results."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import cut_lineage, free_name, kept_by_worker

SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "capitals", "shouts", "repeats", "dup_lines", "long_words", "short_words", "digits")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Strata beyond this are joined by a shuffle and not broadcast.
MAX_BROADCAST = 10_000
_SPACE = bytes([32, 9, 10, 11, 12, 13])


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    v = len(known)
    pair = ids[:-1] * v + ids[1:]
    if v > 2_000_000:  # v cubed has to fit into 63 bits
        pair = np.unique(pair, return_inverse=True)[1].reshape(-1)
    _, at, count = np.unique(pair[:-1] * v + ids[2:], return_inverse=True, return_counts=True)
    found = np.flatnonzero(count[at.reshape(-1)] > 1)
    hit = np.zeros(n, dtype=bool)
    for k in range(3):
        hit[found + k] = True
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The base counts, then the rules' values."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    b = np.frombuffer(raw, dtype=np.uint8)
    word_chars = len(text) - sum(raw.count(s) for s in _SPACE)
    n_symbols = sum(raw.count(ord(c)) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    rep = repeat_words(words)
    upper = int(np.count_nonzero((b >= 65) & (b <= 90)))
    lower = int(np.count_nonzero((b >= 97) & (b <= 122)))
    digits = int(np.count_nonzero((b >= 48) & (b <= 57)))
    share = lambda x, of: min(255, 100 * x // of) if of else 0
    mean = 10 * word_chars // n if n else 0
    return (n, word_chars, n_symbols, dup, rep, share(n_symbols, n), share(upper, upper + lower), share(raw.count(33), n),
            share(rep, n), share(dup, len(lines)), min(255, mean), max(0, 255 - mean) if n else 0, share(digits, word_chars))


_MEASURES = T.StructType([T.StructField(x, T.LongType()) for x in BASE] + [T.StructField(x, T.IntegerType()) for x in RULES])


def _measure_all(texts: pa.Array) -> pa.StructArray:
    kept_by_worker(("rules",), dict)  # what another operator remembered goes
    kind = [pa.field(x, pa.int64()) for x in BASE] + [pa.field(x, pa.int32()) for x in RULES]
    got = [measure(x.as_py()) for x in texts]
    cols = [pa.array(c, f.type) for c, f in zip(zip(*got), kind)] if got else [pa.array([], f.type) for f in kind]
    return pa.StructArray.from_arrays(cols, fields=kind)


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat > 50 * n_words)


def measured(docs: DataFrame, keep: list[str], text_col: str = "text") -> tuple[DataFrame, str]:
    """``keep`` columns of ``docs`` and one struct column (its name is returned) of the base counts and rule values."""
    name = free_name(docs.select(*keep), "m")
    docs = docs.select(*keep, F.col(text_col).cast("string").alias(free_name(docs, "text_")))
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField(name, _MEASURES)])
    names = docs.columns[:-1] + [name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _measure_all(b.column(b.num_columns - 1))], names)

    return docs.mapInArrow(run, schema), name


def measure_udf():
    """The measures of a text column as one struct column. Marked as not deterministic, so that the planner doesn't put a
    second call in the filter that reads them."""

    @F.arrow_udf(_MEASURES)
    def each(text: pa.Array) -> pa.Array:
        return _measure_all(text)

    return each.asNondeterministic()


def log_binomial_cdf(k: int, n: int, p: float) -> float:
    """Natural logarithm of P(X <= k) for X binomial (n, p), summed exactly, largest terms first."""
    if k >= n:
        return 0.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k, -1, -1)]
    top = max(logs)
    return min(0.0, top + math.log(math.fsum(math.exp(x - top) for x in logs)))


def certify(good: dict[int, int], bad: dict[int, int], limit: float, level: float, cost: float) -> int | None:
    """The cutoff for one stratum and rule from counts by value, None if there is none to use."""
    n, m = sum(good.values()), sum(bad.values())
    best, gain, k, caught = None, 0.0, 0, 0
    if not n or not m:
        return None
    for t in range(255, 0, -1):
        k, caught = k + good.get(t, 0), caught + bad.get(t, 0)
        # the CDF's terms need a walk only where k may pass at all
        if k > limit * n or log_binomial_cdf(k, n, limit) > math.log(level):
            break
        if (g := caught / m - cost * k / n) > gain + 1e-12:
            best, gain = t, g
    return best


def cutoffs(measures: DataFrame, m: str, labels: DataFrame, stratum: str, id_col: str = "doc_id", alpha: float = 0.05,
            delta: float = 0.05, cost: float = 10.0) -> DataFrame:
    """(stratum, cut struct of a cutoff or null for each rule), from histograms of the labelled documents: the
    rows that come together are at most 256 values by 2 labels for each stratum and rule."""
    truth = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.min("quality") > 0).alias("good")))
    rows = measures.select(F.col(id_col).cast("long").alias("_id"), F.col(stratum).cast("string").alias("stratum"), F.col(m).alias("m"))
    rows = rows.where(~base_failed(F.col("m.n_words"), F.col("m.n_repeat_words")))
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"m.{r}").alias("value")) for r in RULES])).alias("p")
    hist = cut_lineage(rows.join(truth, "_id").select("stratum", "good", pairs).groupBy("stratum", "p.rule", "p.value", "good").count())
    strata = hist.select("stratum").distinct().count()
    limit, level = alpha / len(RULES), delta / max(1, strata * len(RULES))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        by = [dict(zip(x["value"], x["count"])) for x in (pdf[pdf["good"]], pdf[~pdf["good"]])]
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "rule": [pdf["rule"].iloc[0]],
                             "cut": pd.array([certify(*by, limit, level, cost)], dtype="Int32")})

    chosen = hist.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cut int")
    table = chosen.groupBy("stratum").agg(F.struct(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(r) for r in RULES]).alias("cut"))
    return F.broadcast(cut_lineage(table)) if strata <= MAX_BROADCAST else table


def judged(measures: DataFrame, m: str, cuts: DataFrame, stratum: str) -> DataFrame:
    """``measures`` with _base_failed and _kept."""
    cuts = cuts.select(F.col("stratum").alias("_stratum"), F.col("cut").alias("_cut"))
    rows = measures.join(cuts, F.col(stratum).cast("string").eqNullSafe(F.col("_stratum")), "left")
    hit = F.lit(False)
    for r in RULES:
        hit = hit | F.coalesce(F.col(f"{m}.{r}") >= F.col(f"_cut.{r}"), F.lit(False))
    failed = base_failed(F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words"))
    return rows.withColumn("_base_failed", failed).withColumn("_kept", ~failed & ~hit).drop("_stratum", "_cut")


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang",
                     **risk) -> DataFrame:
    """Per document: id, base counts, base_failed, kept."""
    rows, m = measured(docs, [id_col, stratum], text_col)
    rows = cut_lineage(rows)
    out = judged(rows, m, cutoffs(rows, m, labels, stratum, id_col, **risk), stratum)
    return out.select(F.col(id_col).alias("doc_id"), *[F.col(f"{m}.{x}").alias(x) for x in BASE],
                      F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang",
              **risk) -> DataFrame:
    """The documents that the rules keep, with all their columns. Texts are measured a second time to judge them where
    they are, so that they are not shuffled to be joined to their verdicts; only the text goes to Python, the row waits in the JVM."""
    rows, m = measured(docs, [id_col, stratum], text_col)
    cuts = cutoffs(rows, m, labels, stratum, id_col, **risk)
    names, row, own, again = docs.columns, "_row", "_own_stratum", "_measures"
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias(row), F.col(f"`{stratum}`").cast("string").alias(own),
                         measure_udf()(F.col(f"`{text_col}`").cast("string")).alias(again))
    kept = judged(packed, again, cuts, own).where("_kept")
    return kept.select(*[F.col(row)[c].alias(c) for c in names])
