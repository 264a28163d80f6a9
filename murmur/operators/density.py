"""M-5: topics as regions of high density. The number of topics and the outliers come from the data.

The k nearest neighbours of all vectors make a graph; an edge weighs what both its ends need to reach ``min_samples`` vectors
(themselves included), or their distance if that is more (mutual reachability). Its minimum spanning forest is found by Boruvka rounds of joins and
aggregates. Cut at falling distances, the forest falls apart; a part of at least ``min_size`` vectors is a cluster, a split counts where both sides are
that large, and of a cluster and those that it splits into, the ones that last longer (sum over vectors of 1 / distance, from the cluster's
birth until the vector leaves) are the topics.

Equal vectors are one node with a weight, so copies cost nothing. Graph and forest are tables of all nodes; none is left out, however many they are.
The forest's edges, fewer than nodes, come to the driver, where the hierarchy is read off in one pass over them, in arrays of some 200 bytes a node.

Defined results: null vectors are outliers; equal vectors share a topic; an empty table stays empty; topics are numbered by size, then by
smallest id."""

from __future__ import annotations

import math
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.operators.neighbours import nearest, written

OUTLIER = -1
#: Steps of the pass over the forest that are Python's numbers at once.
STEP = 100_000
#: Boruvka rounds end where so few edges are left between parts that they can be sorted at once.
TAIL = 100_000


def reach_graph(nodes: DataFrame, min_samples: int, k: int) -> DataFrame:
    """``nodes`` (id, vec, weight) -> (a, b, w) edges with a < b, and the cell of one end, near which the other one mostly lies."""
    weight = lambda i: F.aggregate(F.slice("found", 1, i + 1), F.lit(0).cast("long"), lambda acc, x: acc + x["weight"])
    reach = F.array_min(F.transform("found", lambda x, i: F.when(weight(i) >= min_samples, x["d"])))  # k + 1 neighbours a row
    found = written(nearest(nodes, nodes, k + 1).withColumn("core", reach), "knn")  # a node finds itself
    found = found.where("core is not null")  # one that reaches too few has no edge
    flat = found.select("id", "cell", "core", F.explode("found").alias("f")).where("f.id <> id")
    flat = flat.select("id", "cell", F.col("f.id").alias("other"), F.greatest("f.d", "core").alias("w"))
    core = found.select("id", "core")
    met = flat.join(core.select(F.col("id").alias("other"), F.col("core").alias("other_core")), "other")
    return met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), F.greatest("w", "other_core").alias("w"), "cell")


def local_forests(edges: DataFrame) -> DataFrame:
    """(a, b, w): of (a, b, w, cell), the minimum spanning forest of each cell's edges, ties by a, then b. What a part of the edges
    doesn't need, the whole doesn't either."""
    def forest(t: pa.Table) -> pa.Table:
        a, b, w = (t.column(c).to_numpy() for c in ("a", "b", "w"))
        names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        order = np.lexsort((b, a, w))
        top, keep = list(range(len(names))), []
        for e, x, y in zip(order.tolist(), place[:len(a)][order].tolist(), place[len(a):][order].tolist()):
            while top[x] != x:
                top[x] = x = top[top[x]]
            while top[y] != y:
                top[y] = y = top[top[y]]
            if x != y:
                top[x] = y
                keep.append(e)
        return t.select(["a", "b", "w"]).take(pa.array(keep, pa.int64()))

    return edges.groupBy("cell").applyInArrow(forest, "a long, b long, w double").distinct()


def _kruskal(edges: list[tuple]) -> list[tuple]:
    """The lightest spanning edges of (x, y, w, a, b), ties by a, then b."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y, w, a, b in sorted(edges, key=lambda e: e[2:]):
        x, y = find(x), find(y)
        if x != y:
            parent[x] = y
            out.append((a, b, w))
    return out


def spanning_forest(edges: DataFrame, tail: int = TAIL) -> DataFrame:
    """(a, b, w): the minimum spanning forest of (a, b, w), ties by a, then b.

    In each round every part takes its lightest edge out, and parts that an edge joins become one: the parts at least halve. Edges inside a
    part and all but the lightest between two parts are left out. What is left below ``tail`` edges is sorted at once."""
    spark = edges.sparkSession
    left = written(edges.select(F.col("a").alias("x"), F.col("b").alias("y"), "w", "a", "b"), "edges")
    chosen: list[DataFrame] = []
    key = F.struct("w", "a", "b", "x", "y")
    while left.count() > tail:
        out = left.select(F.col("x").alias("part"), key.alias("e")).unionByName(left.select(F.col("y").alias("part"), key.alias("e")))
        best = written(out.groupBy("part").agg(F.min("e").alias("e")), "lightest")
        chosen.append(best.select("e.a", "e.b", "e.w").distinct())
        to = written(best.select("part", F.when(F.col("e.x") == F.col("part"), F.col("e.y")).otherwise(F.col("e.x")).alias("to")), "parts")
        # two parts that took the same edge: the smaller one is the root
        back = to.select(F.col("part").alias("to"), F.col("to").alias("back"))
        to = written(to.join(back, "to", "left").select("part", F.when((F.col("back") == F.col("part")) & (F.col("part") < F.col("to")), F.col("part")).otherwise(F.col("to")).alias("to")), "parts")
        while True:  # halve the way to the root
            jump = written(to.join(to.select(F.col("part").alias("to"), F.col("to").alias("next")), "to")
                           .select("part", F.col("next").alias("to"), (F.col("to") != F.col("next")).alias("moved")), "parts")
            to = jump.select("part", "to")
            if jump.where("moved").isEmpty():
                break
        joined = left.join(to.select(F.col("part").alias("x"), F.col("to").alias("rx")), "x").join(to.select(F.col("part").alias("y"), F.col("to").alias("ry")), "y")
        joined = joined.where("rx <> ry").select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y"), F.struct("w", "a", "b").alias("e"))
        left = written(joined.groupBy("x", "y").agg(F.min("e").alias("e")).select("x", "y", "e.w", "e.a", "e.b"), "edges")
    rest = _kruskal([(r.x, r.y, r.w, r.a, r.b) for r in left.collect()])
    out = spark.createDataFrame(rest, "a long, b long, w double")
    for c in chosen:
        out = out.unionByName(c)
    return out


@dataclass
class Hierarchy:
    """Topics of nodes: ``topic`` and ``strength`` by node, and the distance up to which each topic reaches."""
    topic: np.ndarray
    strength: np.ndarray
    reach: dict[int, float]
    stability: dict[int, float]


def _filled(value: int, size: int) -> array:
    return array("q", [value]) * size


def condense(ids: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, min_size: int,
             first: np.ndarray | None = None) -> Hierarchy:
    """Read the clusters off a spanning forest: nodes ``ids`` (sorted) with weights, edges (a, b, w). Topics of one size are numbered
    by the smallest ``first`` (by default the ids) of their nodes."""
    first = ids if first is None else first
    n = len(ids)
    order = np.lexsort((b, a, w))
    a, b, w = np.searchsorted(ids, a[order]), np.searchsorted(ids, b[order]), w[order]
    # single linkage: a node from n on joins all parts that meet at one distance; its parts are a chain
    top, size = array("q", range(n)), array("q", weight.astype(np.int64).tobytes())
    head, last, after = array("q"), array("q"), _filled(-1, n)
    at = array("d")

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for s in range(0, len(w), STEP):
        for x, y, d in zip(a[s:s + STEP].tolist(), b[s:s + STEP].tolist(), w[s:s + STEP].tolist()):
            x, y = find(x), find(y)
            grows, joins = x >= n and at[x - n] == d, y >= n and at[y - n] == d
            if joins and not grows:
                x, y, grows, joins = y, x, True, False
            if grows:  # x takes y, or y's parts
                more, end = (head[y - n], last[y - n]) if joins else (y, y)
                after[last[x - n]] = more
                last[x - n] = end
                size[x] += size[y]
                top[y] = x
            else:
                top[x] = top[y] = len(top)
                top.append(len(top))
                size.append(size[x] + size[y])
                head.append(x)
                last.append(y)
                after[x] = y
                after.append(-1)
                at.append(d)
    del a, b, w, order

    def parts(x: int):
        x = head[x - n]
        while x >= 0:
            yield x
            x = after[x]

    roots = sorted({find(x) for x in range(n)})
    inverse = lambda d: 1 / d if d > 0 else math.inf
    # from the top down; each part at or below a cluster carries that cluster's number
    birth: list[float] = []
    up: list[int] = []
    leave, member = array("d", bytes(8 * n)), _filled(-1, n)
    stack = []
    for r in roots:
        if size[r] >= min_size:
            stack.append((r, len(birth)))
            birth.append(0.0)
            up.append(-1)
    splitting: list[tuple[int, float, int]] = []  # (cluster, 1 / distance, weight) of the clusters that it splits into

    def fall(x: int, c: int, lam: float) -> None:
        inner = [x]
        while inner:
            y = inner.pop()
            if y < n:
                member[y], leave[y] = c, lam
            else:
                inner.extend(parts(y))

    while stack:
        x, c = stack.pop()
        if x < n:  # a single node that is heavy enough: it never falls apart
            member[x], leave[x] = c, math.inf
            continue
        lam = inverse(at[x - n])
        splits = False
        for i, y in enumerate(z for z in parts(x) if size[z] >= min_size):
            if i == 1:
                splits = True
                break
        for y in parts(x):
            if size[y] < min_size:
                fall(y, c, lam)
            elif splits:
                splitting.append((c, lam, size[y]))
                stack.append((y, len(birth)))
                birth.append(lam)
                up.append(c)
            else:
                stack.append((y, c))
    single = len(roots) == 1
    del top, size, head, last, after, at, roots
    lam, own = np.frombuffer(leave, dtype=float) if n else np.zeros(0), np.frombuffer(member, dtype=np.int64) if n else np.zeros(0, np.int64)
    inside = own >= 0
    most = max([float(lam[inside & np.isfinite(lam)].max(initial=0.0)), *(x for _, x, _ in splitting if x < math.inf)])
    cap = 2 * most if most > 0 else 2.0  # equal vectors last as long as twice the longest of the others
    lam = np.minimum(lam, cap)
    begun = np.minimum(np.array(birth), cap)
    stability = np.bincount(own[inside], (lam[inside] - begun[own[inside]]) * weight[inside], len(birth))
    for c, x, much in splitting:
        stability[c] += (min(x, cap) - begun[c]) * much
    below: dict[int, list[int]] = {}
    for c, u in enumerate(up):
        below.setdefault(u, []).append(c)
    chosen, best = [False] * len(birth), stability.tolist()
    for c in reversed(range(len(birth))):
        kids = below.get(c, [])
        inner = sum(best[p] for p in kids)
        if up[c] == -1 and single and kids:  # everything is no topic, if it splits
            chosen[c], best[c] = False, inner
        elif kids and inner > stability[c]:
            best[c] = inner
        else:
            chosen[c] = True
    # the topmost chosen ones
    owner = [-1] * len(birth)
    for c in range(len(birth)):
        u = up[c]
        owner[c] = owner[u] if u >= 0 and owner[u] >= 0 else c if chosen[c] else -1
    own = np.array([*owner, -1], dtype=np.int64)[own]  # a node of no cluster has the last one, -1
    mine = np.flatnonzero(own >= 0)
    found, place = np.unique(own[mine], return_inverse=True)
    heavy, least, longest = np.zeros(len(found), np.int64), np.full(len(found), np.iinfo(np.int64).max), np.zeros(len(found))
    np.add.at(heavy, place, weight[mine])
    np.minimum.at(least, place, first[mine])
    np.maximum.at(longest, place, lam[mine])
    order = np.lexsort((least, -heavy))
    number = np.empty(len(found), np.int64)
    number[order] = np.arange(len(found))
    topic, strength = np.full(n, OUTLIER, np.int64), np.zeros(n)
    topic[mine], strength[mine] = number[place], lam[mine] / longest[place]
    return Hierarchy(topic, strength, {i: 1 / birth[c] if birth[c] > 0 else math.inf for i, c in enumerate(found[order].tolist())},
                     {i: float(stability[c]) for i, c in enumerate(found[order].tolist())})


def density_topics(docs: DataFrame, doc: str = "comment_id", vec: str = "embedding", min_size: int = 10, min_samples: int | None = None,
                   neighbours: int = 15, max_nodes: int | None = None, tail: int = TAIL) -> DataFrame:
    """``docs`` with topic_id (-1: outlier), topic_prob (how long the
    row stays in its topic, 0 to 1; 0 for outliers). All different vectors are nodes; ``max_nodes``, a bound on them in earlier
    versions, is taken and has no effect."""
    min_samples = min_samples or min_size
    if min_samples > min_size:
        raise ValueError("min_samples can't be above min_size")
    if neighbours + 1 < min_samples:
        raise ValueError("neighbours must reach min_samples")
    spark = docs.sparkSession
    own = F.transform(F.col(vec), lambda x: x.cast("double") + F.lit(0.0))  # no negative zeros
    taken = {c.lower() for c in docs.columns}
    n_, t_, s_ = (next(x for i in range(1, len(taken) + 2) if (x := "_" * i + name) not in taken) for name in ("node", "topic", "strength"))  # no column of ``docs``
    nodes = written(docs.where(F.col(vec).isNotNull()).groupBy(own.alias("_vec")).agg(F.min(F.col(doc).cast("long")).alias("first"), F.count("*").alias("weight"))
                    .select(F.xxhash64("_vec").alias("id"), F.col("_vec").alias("vec"), "weight", "first"), "nodes")
    forest = spanning_forest(local_forests(reach_graph(nodes, min_samples, neighbours)), tail).toArrow()  # fewer edges than nodes
    table = nodes.select("id", "weight", F.coalesce("first", F.lit(2**63 - 1)).alias("first")).toArrow().sort_by("id")
    h = condense(*(table[c].to_numpy() for c in ("id", "weight")), *(forest[c].to_numpy() for c in ("a", "b", "w")), min_size, table["first"].to_numpy())
    found = pa.table({"id": table["id"], "topic": pa.array(h.topic, pa.int64()), "strength": pa.array(h.strength, pa.float64())})
    named = written(spark.createDataFrame(found, "id long, topic long, strength double"), "topics").toDF(n_, t_, s_)
    out = docs.withColumn(n_, F.when(F.col(vec).isNotNull(), F.xxhash64(own))).join(named, n_, "left").drop(n_)
    topic = F.coalesce(t_, F.lit(OUTLIER)).cast("int")
    strength = F.coalesce(s_, F.lit(0.0))
    return out.withColumn("topic_id", topic).withColumn("topic_prob", strength).drop(t_, s_)
