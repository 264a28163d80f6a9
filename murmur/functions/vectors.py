"""Dense-vector expressions and aggregates (T-16 .. T-19, A-11, J-6).

Vectors are ``array<double>`` columns; arithmetic is native higher-order
functions. Element-wise means are distributed aggregates (explode by position,
``avg`` per (key, position), re-assemble), so a group's vectors never meet in
one Python process.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.text import let

# A candidate table larger than this is not inlined into the plan.
MAX_INLINE_CANDIDATES = 4096


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    """T-17: L2 norm."""
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    """T-16: cosine similarity; 0 when either vector is all zeros."""
    den = norm(a) * norm(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)


def scale(a, k) -> Column:
    k = F.lit(k) if not isinstance(k, Column) else k
    return F.transform(_c(a), lambda x: x * k)


def blend(a, b, wa: float = 0.6, wb: float = 0.4) -> Column:
    """T-18: ``wa * a + wb * b``."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x * wa + y * wb)


def normalize(a) -> Column:
    """Row L2 normalisation; a zero vector stays zero."""
    return let(norm(a), lambda n: F.when(n == 0, _c(a)).otherwise(F.transform(_c(a), lambda x: x / n)))


def mean_vector(df: DataFrame, keys: Sequence[str], vec: str, out: str = "vector") -> DataFrame:
    """A-11: element-wise mean of ``vec`` per ``keys`` (null vectors skipped).

    A JVM vector aggregate (``Summarizer.mean``) with map-side partial
    aggregation: one dense buffer per key and task, no per-element rows.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    k = list(keys)
    return (df.filter(F.col(vec).isNotNull())
            .select(*k, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
            .groupBy(*k).agg(Summarizer.mean(F.col("_v")).alias("_m"))
            .select(*k, vector_to_array("_m").alias(out)))


def candidate_array(candidates: DataFrame, name: str = "candidate", vec: str = "embedding",
                    order: str = "ord", limit: int = MAX_INLINE_CANDIDATES) -> Column:
    """Inline a small, size-checked candidate table as a literal
    ``array<struct<ord, name, vec>>`` column (one copy per task, no join)."""
    rows = candidates.select(order, name, vec).orderBy(order).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"candidate table has more than {limit} rows; it is a dimension, not data")
    return F.array(*[F.struct(F.lit(int(r[0])).alias("ord"), F.lit(r[1]).alias("name"),
                               F.array(*[F.lit(float(x)) for x in r[2]]).alias("vec"),
                               F.lit(math.sqrt(sum(float(x) ** 2 for x in r[2]))).alias("norm")) for r in rows])


def nearest(vec, cands: Column) -> Column:
    """J-6: struct(name, score) of the most cosine-similar candidate; the
    first candidate (by ``ord``) wins ties. Each norm is taken once: the
    vector's per row, the candidates' when they are inlined."""
    init = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("double").alias("score"))

    def search(own):
        def step(acc, c):
            den = own * c["norm"]
            s = F.when(den == 0, F.lit(0.0)).otherwise(dot(vec, c["vec"]) / den)
            better = acc["score"].isNull() | (s > acc["score"])
            return F.when(better, F.struct(c["name"].alias("name"), s.alias("score"))).otherwise(acc)
        return F.aggregate(cands, init, step)

    return let(norm(vec), search)


def softmax_over(df: DataFrame, group: Sequence[str], score: str, out: str) -> DataFrame:
    """T-19: max-shifted softmax of ``score`` within each group."""
    from pyspark.sql import Window
    w = Window.partitionBy(*group)
    e = F.exp(F.col(score) - F.max(score).over(w))
    return df.withColumn("_e", e).withColumn(out, F.col("_e") / F.sum("_e").over(w)).drop("_e")
