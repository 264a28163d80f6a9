"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage


def _star(pairs: DataFrame) -> DataFrame:
    """Each node u with the smallest of its neighbours and itself; joined back to its pairs (u, v).
    The minimum is aggregated before the shuffle and its side of the join has one row a node, so a
    node with very many neighbours can be split."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(low, "u")


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that ``edges`` names; component is its smallest reachable node.

    Each round writes its edges to the checkpoint folder. Rounds grow with the logarithm of the
    longest path. Null ends and loops are left out; an empty edge table gives no rows."""
    e = cut_lineage(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                    .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = _star(large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        e = cut_lineage(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
