import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from murmur.llm import simhash
from murmur.llm.components import connected_components


def plain_fingerprint(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids_fps, bits=2):
    nodes = sorted({f for _, f in ids_fps})
    root = {f: f for f in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    low = {}
    for i, f in ids_fps:
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return [(i, f, low.get(find(f))) for i, f in ids_fps]


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One two", "A b C", "A b c d " * 50, "ß Ä x y\x1cz q"])
def test_fingerprint_is_the_definition(text):
    assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def test_odd_rows_against_brute_force(make, odd):
    got = Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.simhash_groups(make(odd)).collect())
    assert got == Counter(plain_components([(i, plain_fingerprint(t)) for i, t in odd]))


@pytest.mark.parametrize("tile,parts", [(8, 1), (8, 3), (8192, 2), (64, 4)])
def test_links_of_planted_fingerprints(spark, tile, parts):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:60]:
        for _ in range(3):
            g = f
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                g ^= 1 << b
            fps.append(g)
    fps += [0, 1, 3, 7, 2**64 - 1, 2**63]
    fps = sorted(set(fps))
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, tile, parts)
    comp = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    want = {f: c for _, f, c in plain_components([(i, f) for i, f in enumerate(fps)])}
    groups = {}
    for i, (f, s) in enumerate(zip(fps, signed)):
        groups.setdefault(comp.get(s, s), []).append(i)
    mine = {i: min(g) for g in groups.values() for i in g}
    assert mine == {i: want[f] for i, f in enumerate(fps)}
    assert edges.count() < 4 * len(fps) * 3  # forests, not all pairs


def test_long_path_settles(spark):
    n = 300
    got = {r.node: r.component for r in connected_components(spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")), "a", "b").collect()}
    assert got == {i: 0 for i in range(n + 1)}
    assert connected_components(spark.createDataFrame([(None, 1), (2, 2)], "a long, b long"), "a", "b").count() == 0


def test_keep_one(make, odd):
    docs = make(odd)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    # 1 has fingerprint 0 with 2, 3 and the null text without id; 5 = 6; 8 = 9 in lower case; 7 comes twice
    assert Counter(i for i, _ in rows) == Counter([1, 4, 5, 7, 8, 10, None])
    assert [t for i, t in rows if i is None] == ["no id at all"]


def test_keep_one_tells_rows_of_one_id_apart(make):
    """An id that repeats with other texts: each group keeps one document, a copy goes whatever its id."""
    a, b, c = "the first text is about a lake", "quite other words stand here now", "nothing of this is found above it"
    rows = [(r.doc_id, r.text) for r in simhash.keep_one(make([(3, a), (5, a), (5, b), (7, c), (7, c), (None, b), (None, c + " x y z w")])).collect()]
    assert Counter(rows) == Counter([(3, a), (5, b), (7, c), (None, c + " x y z w")])


def test_empty_table(make):
    assert simhash.simhash_groups(make([]).limit(0)).collect() == []
    assert simhash.keep_one(make([]).limit(0)).collect() == []
