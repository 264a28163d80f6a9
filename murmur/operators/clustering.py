"""(topic, candidate) clustering of comments (J-6, T-7, PF-7, A-9, PF-12).

Each comment vector is compared with the candidate vectors by cosine and
the best candidate is kept (first candidate wins ties). A candidate table of
checked size is inlined into the expression, so this is a row-level map over
the comments: no join, no shuffle. Larger ones are searched exactly in tiles,
which the triangle inequality mostly skips (``neighbours.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.functions import vectors as V
from murmur.operators.neighbours import nearest, written
from murmur.schemas import CLUSTER_OUTPUT_COLUMNS, TOPIC_ASSIGNMENT_COLUMNS, require_columns


def nearest_candidate(df: DataFrame, candidates: DataFrame, vec: str = "embedding",
                      out: str = "candidate", inline: int = V.MAX_INLINE_CANDIDATES) -> DataFrame:
    """J-6: the candidate with the highest cosine similarity to ``vec``, the first by ``ord`` among equals."""
    if candidates.limit(inline + 1).count() > inline:
        return nearest_of_many(df, candidates, vec, out)
    arr = V.candidate_array(candidates, limit=inline)
    best = V.nearest(F.col(vec).cast("array<double>"), arr)
    return df.withColumn(out, best["name"]).withColumn(f"{out}_score", best["score"])


def nearest_of_many(df: DataFrame, candidates: DataFrame, vec: str = "embedding", out: str = "candidate") -> DataFrame:
    """J-6 for candidate tables of any size. Vectors are scaled to length 1, where the nearest one has the highest cosine; equal
    vectors are searched once, and of equal candidates the first stands for all. A zero vector has cosine 0 with everything."""
    own = F.col(vec).cast("array<double>")
    cands = written(candidates.select(F.col("ord").cast("long").alias("ord"), F.col("candidate").alias("name"), F.col("embedding").cast("array<double>").alias("vec")), "candidates")
    length = V.norm("vec")
    points = written(cands.where(length > 0).select("ord", V.normalize("vec").alias("vec")).groupBy("vec").agg(F.min("ord").alias("id")), "points")
    zero = cands.where(length == 0).agg(F.min("ord")).first()[0]
    first = cands.agg(F.min("ord")).first()[0]
    asked = written(df.where(F.col(vec).isNotNull()).select(own.alias("raw")).distinct().select("raw", F.xxhash64("raw").alias("id"), V.normalize("raw").alias("vec")), "asked")
    found = nearest(asked.where(V.norm("raw") > 0).select("id", "vec"), points, 1)
    best = asked.join(found, "id", "left").select("raw", F.col("found")[0]["id"].alias("ord"))
    best = best.join(cands, "ord", "left").withColumn("score", F.when(F.col("ord").isNotNull(), V.cosine("raw", "vec")))
    # where zero vectors stand among the others
    of_zero = F.struct(F.lit(0.0).alias("score"), (-F.lit(zero)).cast("long").alias("o"))
    pick = F.struct("score", (-F.col("ord")).alias("o"))
    pick = F.when(F.col("ord").isNull(), F.struct(F.lit(0.0).alias("score"), (-F.lit(first)).cast("long").alias("o"))).otherwise(pick if zero is None else F.greatest(pick, of_zero))
    best = best.select("raw", pick.alias("p")).select("raw", (-F.col("p.o")).alias("ord"), "p.score").join(cands.select("ord", "name"), "ord")
    best = best.select(F.col("raw").alias("_raw"), F.col("name").alias("_name"), F.col("score").alias("_score"))
    got = df.withColumn("_own", own).join(best, F.col("_own") == F.col("_raw"), "left")
    return got.withColumn(out, F.col("_name")).withColumn(f"{out}_score", F.col("_score")).drop("_own", "_raw", "_name", "_score")


def cluster_topic_pairs(assign: DataFrame, candidates: DataFrame, vec: str = "embedding") -> DataFrame:
    """The clustering stage: contract check (IO-5), drop rows without text
    (PF-2), nearest candidate (J-6), topic label (T-7) and
    ``final_cluster = topic_label + "_" + candidate`` (PF-7)."""
    require_columns(assign, TOPIC_ASSIGNMENT_COLUMNS, "topic assignments")
    a = assign.filter(F.col("comment_text").isNotNull())
    a = nearest_candidate(a, candidates, vec)
    return (a.withColumn("topic_label", T.topic_label(F.col("topic_keywords"), F.col("topic_id")))
            .withColumn("final_cluster", T.final_cluster("topic_label", "candidate")))


def cluster_counts(clustered: DataFrame, n: int = 10) -> DataFrame:
    """A-9: the ``n`` most frequent clusters (top-k, ties by name)."""
    return (clustered.groupBy("final_cluster").agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), "final_cluster").limit(n))


def contract(clustered: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    from murmur.schemas import contract_projection
    return contract_projection(clustered, CLUSTER_OUTPUT_COLUMNS + list(extra))
