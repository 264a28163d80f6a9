import numpy as np
import pytest

from murmur.llm import itq


def brute(rows, threshold=0.9):
    vecs = {}
    for k, (i, v) in enumerate(rows):
        if v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, dtype=float)
            a = a / np.abs(a).max()
            vecs[k] = a / np.linalg.norm(a)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    deg = [0] * len(rows)
    ks = sorted(vecs)
    for x, a in enumerate(ks):
        for b in ks[x + 1:]:
            if vecs[a] @ vecs[b] >= threshold:
                deg[a] += 1
                deg[b] += 1
                root[find(b)] = find(a)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return deg, [low.get(find(k)) for k in range(len(rows))], {tuple(sorted((a, b))) for a in ks for b in ks if a < b and vecs[a] @ vecs[b] >= threshold}


def data(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, code string, size double").repartition(3)


def sample(seed=0, n=120):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        rows.append((i, rng.normal(size=16).astype(np.float32).tolist()))
    for i in range(n):  # near copies at 0.9 and above
        v = np.array(rows[i % 40][1]) + rng.normal(size=16) * 0.25
        rows.append((1000 + i, v.astype(np.float32).tolist()))
    rows += [(2000 + i, rows[3][1]) for i in range(25)]  # exact copies
    return rows


@pytest.mark.parametrize("tile", [8, 1024])
def test_recall_and_no_false_links(spark, tile):
    rows = sample()
    deg, _, _ = brute(rows)
    got = {r.vec_id: r for r in itq.vector_links(data(spark, rows), 0.9, tile=tile).collect()}
    mine = [got[i].n_links for i, _ in rows]
    assert all(a <= b for a, b in zip(mine, deg))
    assert sum(mine) >= 0.9 * sum(deg)
    for i, _ in rows:
        assert got[i].kept == (got[i].component_id == i) and got[i].component_id <= i


def test_odd_vectors(spark):
    base = [float(x) for x in range(1, 17)]
    rows = [(1, base), (2, [2 * x for x in base]), (3, None), (4, []), (5, [0.0] * 16), (6, [None] + base[1:]), (7, [float("nan")] + base[1:]),
            (8, [float("inf")] + base[1:]), (9, base[:4]), (None, base), (1, base), (10, [-x for x in base]), (11, [x * 1e-40 for x in base])]
    deg, comp, _ = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    got = sorted(((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id) for r in itq.vector_links(data(spark, rows)).collect()))
    want = sorted((i is None, i or 0, d, c) for (i, _), d, c in zip(rows, deg, comp))
    # float32 denormals round, but still link
    assert [x[:3] for x in got if x[1] != 11] == [x[:3] for x in want if x[1] != 11]
    assert [x[3] for x in got] == [x[3] for x in want]


def test_empty_and_single(spark):
    assert itq.vector_links(data(spark, sample(n=3)).limit(0)).collect() == []
    one = itq.vector_links(data(spark, [(5, [1.0] * 16)])).collect()
    assert [tuple(r) for r in one] == [(5, 0, 5, True)]


def test_codes_are_balanced():
    x = np.random.default_rng(1).normal(size=(2000, 32)) @ np.diag(np.linspace(3, 0.1, 32)) + 5
    mean, project = itq.learn_rotation(x, 32)
    bits = ((x - mean) @ project >= 0).mean(0)
    assert (abs(bits - 0.5) < 0.1).all() and np.allclose(project.T @ project, np.eye(32), atol=1e-8)
    code = itq.codes_of(x, mean, project)
    assert np.bitwise_count(code).max() <= 32


def with_common(rng, n, dim, common):
    """Unit vectors with a share ``common`` of their squared norm in one direction, and a partner of each at cosines from 0.9 to 0.93, in a random direction."""
    u = np.eye(dim)[0]
    x = rng.normal(size=(n, dim))
    x[:, 0] = 0
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    x = np.sqrt(common) * u + np.sqrt(1 - common) * x
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.sqrt((aside * aside).sum(1, keepdims=True))
    cos = rng.uniform(0.9, 0.93, (n, 1))
    return x, cos * x + np.sqrt(1 - cos * cos) * aside


@pytest.mark.parametrize("dim", [16, 32, 64, 128])
@pytest.mark.parametrize("common", [0.0, 0.5, 0.7, 0.8])
def test_candidate_rule_finds_pairs_near_the_threshold(dim, common):
    """The rule alone, on planted pairs only (no copies): at least 0.95 of them."""
    rng = np.random.default_rng(dim)
    x, y = with_common(rng, 1500, dim, common)
    fit = np.concatenate([x, y])[rng.permutation(3000)]
    mean, project = itq.learn_rotation(fit, min(64, dim))
    tables, far, exact = itq.choose_tables(fit, mean, project, 0.9)
    apart = itq.codes_of(x, mean, project) ^ itq.codes_of(y, mean, project)
    met = np.zeros(len(x), bool)
    for s, n in tables:
        met |= np.bitwise_count(apart >> np.uint64(s) & np.uint64((1 << n) - 1)) <= 2
    met &= np.bitwise_count(apart) <= far
    assert met.mean() >= 0.95
    assert sum(n for _, n in tables) == (0 if exact else project.shape[1])


@pytest.mark.parametrize("dim,common", [(16, 0.7), (64, 0.8)])
def test_links_with_a_common_direction(spark, dim, common):
    x, y = with_common(np.random.default_rng(1), 150, dim, common)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    rows += [(900 + i, np.random.default_rng(i).normal(size=7).tolist()) for i in range(3)] + [(950, rows[-1][1] + [0.0])]  # other lengths
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, code string, size double").repartition(3)
    got = {r.vec_id: r for r in itq.vector_links(df, 0.9).collect()}
    a = np.concatenate([x, y])
    linked = a @ a.T >= 0.9
    np.fill_diagonal(linked, False)
    want = linked.sum(1)
    mine = np.array([got[i].n_links for i in range(len(a))])
    assert (mine <= want).all() and mine.sum() >= 0.95 * want.sum() and want.sum() >= 300
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (900, 901, 902, 950))


@pytest.mark.parametrize("tile", [16, 4096])
def test_partners_against_all_pairs(spark, tile):
    rng = np.random.default_rng(4)
    tables, far = itq.cut_into(24, 8), 5
    code = np.unique(np.concatenate([rng.integers(0, 1 << 24, 150), rng.integers(0, 1 << 10, 150)])).astype(np.uint64)
    want, places = set(), set()
    for t, (s, n) in enumerate(tables):
        for x in code.tolist():
            own = x >> s & ((1 << n) - 1)
            places |= {(t, own, x)} | {(t, own ^ (1 << k), x) for k in range(n)}
    for t, b, x in places:
        others = np.array([y for y in code.tolist() if y != x and (t, b, y) in places and (x ^ y).bit_count() <= far], dtype=np.uint64)
        if len(others) and itq._first_shared(np.full(len(others), x, np.uint64), others, t, b, tables).any():
            want.add((t, b, x))
    df = spark.createDataFrame(sorted(places), "table int, bucket int, code long").repartition(3)
    assert want and {tuple(r) for r in itq.partners(df, tables, far, tile).collect()} == want
