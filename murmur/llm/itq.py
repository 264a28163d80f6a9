"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation for balanced binary codes is learned on at most ``max_fit`` vectors (default 20,000; those with the smallest id hashes):
the vectors are centred, turned to their principal axes and then alternately given their signs and the rotation that
fits these best. Every vector gets a code of one bit an axis (at most 64). Codes are cut into substrings of about equal
width, one hash table for each. Two vectors are candidates if in some table their substrings differ in at most two bits: each
enters, besides its own substring's bucket, those one bit away, so such two meet in a bucket. A pair is looked at in
one bucket only, the smallest that it shares. Candidates are compared by the cosine of their original vectors in double precision.

How far the codes of linked vectors lie apart depends on the data (a direction that all vectors share is lost in centring, and what is
left differs more). So pairs at exactly the threshold are made from the sample, their differences drawn from the sample's own and at
random, and the widest substrings (16 bits, else 12, 10 or 8) and the number of bits ``far`` are taken that find ``recall`` of the pairs (0.98) of
both sorts. Where none does, as with few dimensions, all tiles are compared, which is exact.

A first comparison, of codes alone and in blocks, finds the buckets in which a vector has a partner that differs in at most ``far``
bits: only there its vector is sent. A bucket is cut
into tiles of about ``tile`` vectors, and each pair of tiles is a group of bounded size; a group returns how many
links each vector has there and a spanning forest of them, never pairs. Equal vectors are one class with a size, so copies of
a vector are never compared with each other.

Defined results: null, empty and zero vectors and those with null or non-finite components link with nothing, others only with vectors of
their length (each length is searched by itself); a null id takes part, and is the smallest of nothing (its component is the smallest other id, null if there is none);
rows that repeat an id and vector count as vectors of their own; an empty table gives an empty one. Columns other than
id and vector are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage
from murmur.llm.components import connected_components
from murmur.llm.groups import map_sorted_groups, merge_labels

MAX_FIT = 20_000
TILE = 1024
#: Codes alone are compared in larger tiles.
CODE_TILE = 16_384
#: Widths of the substrings, in the order in which they are tried.
WIDTHS = (16, 12, 10, 8)
RECALL = 0.98


def learn_rotation(x: np.ndarray, bits: int, rounds: int = 50, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimensions, bits): principal axes, then the rotation of iterative quantisation."""
    mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
    c = x - mean
    bits = min(bits, x.shape[1])
    _, axes = np.linalg.eigh(c.T @ c + 1e-9 * np.eye(x.shape[1]))
    axes = axes[:, ::-1][:, :bits]
    v = c @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds if len(x) else 0):
        u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = w.T @ u.T
    return mean, axes @ turn


def codes_of(x: np.ndarray, mean: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Binary codes as unsigned 64-bit numbers."""
    b = ((x - mean) @ project) >= 0
    out = np.zeros(len(x), dtype=np.uint64)
    for i in range(b.shape[1]):
        out |= b[:, i].astype(np.uint64) << np.uint64(i)
    return out


def prepared(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, list[int]]:
    """(id, row, vec): each row with a number of its own and its vector in unit length, null if it can't link; and the vectors' lengths."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.col(vec_col).cast("array<double>").alias("vec"))
    fine = F.coalesce((F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    v = v.withColumn("high", F.when(fine, F.array_max(F.transform("vec", F.abs))))
    v = v.withColumn("vec", F.when(F.col("high") > 0, F.transform("vec", lambda x: x / F.col("high"))))  # squares neither vanish nor overflow
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    v = cut_lineage(v.withColumn("norm", norm).select("id", "row", F.transform("vec", lambda x: x / F.col("norm")).alias("vec")))
    return v, [r.n for r in v.where("vec is not null").select(F.size("vec").alias("n")).distinct().orderBy("n").collect()]


def cut_into(bits: int, width: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each table: as few as ``width`` allows, of about equal width."""
    n = max(1, -(-bits // width))
    at = [bits * i // n for i in range(n + 1)]
    return [(x, y - x) for x, y in zip(at, at[1:])]


def pairs_at(x: np.ndarray, threshold: float, seed: int = 5, most: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the sample, each once with a partner towards which another pair of sample vectors differ, and once with one in a
    random direction, at exactly the threshold."""
    rng = np.random.default_rng(seed)
    x = x[rng.permutation(len(x))[:most]]
    others = x[rng.integers(0, len(x), (2, len(x)))]
    aside = np.concatenate([others[0] - others[1], rng.standard_normal(x.shape)])
    x = np.concatenate([x, x])
    aside -= (aside * x).sum(1, keepdims=True) * x
    size = np.sqrt((aside * aside).sum(1, keepdims=True))
    good = size[:, 0] > 1e-9
    x, aside = x[good], aside[good] / size[good]
    return x, threshold * x + np.sqrt(1 - threshold * threshold) * aside


def choose_tables(x: np.ndarray, mean: np.ndarray, project: np.ndarray, threshold: float, recall: float = RECALL) -> tuple[list[tuple[int, int]], int, bool]:
    """(tables, far, exact) for the codes of vectors like the sample's."""
    bits = project.shape[1]
    exact = [(0, 0)], bits, True
    if len(x) < 2 or x.shape[1] < 2:
        return exact
    a, b = pairs_at(x, threshold)
    apart = codes_of(a, mean, project) ^ codes_of(b, mean, project)
    # sorted by sort of partner, so that neither hides behind the other
    half = np.arange(len(apart)) < len(apart) // 2
    total = np.bitwise_count(apart)
    far = max((int(np.quantile(total[h], 1 - (1 - recall) / 2, method="higher")) for h in (half, ~half) if h.any()), default=bits)
    for width in WIDTHS:
        tables = cut_into(bits, width)
        met = np.zeros(len(apart), dtype=bool)
        for s, n in tables:
            met |= np.bitwise_count(apart >> np.uint64(s) & np.uint64((1 << n) - 1)) <= 2
        met &= total <= far
        if all(met[h].mean() >= recall for h in (half, ~half) if h.any()):
            return tables, far, False
    return exact


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (col.chunks if isinstance(col, pa.ChunkedArray) else [col])]
    return np.concatenate(flat).reshape(-1, dim) if flat else np.zeros((0, dim))


def _first_shared(a: np.ndarray, b: np.ndarray, table: int, bucket: int, tables: list[tuple[int, int]]) -> np.ndarray:
    """Of code pairs that meet in this table's bucket: is it the smallest bucket that they share, in the first table?"""
    x = a ^ b
    ok = np.ones(x.shape, dtype=bool)
    for s, n in tables[:table]:
        ok &= np.bitwise_count(x >> np.uint64(s) & np.uint64((1 << n) - 1)) > 2
    s, n = tables[table]
    m = np.uint64((1 << n) - 1)
    own_a, own_b = a >> np.uint64(s) & m, b >> np.uint64(s) & m
    d = own_a ^ own_b
    low = d & (~d + np.uint64(1))
    far = np.bitwise_count(d)
    first = np.where(far == 0, np.minimum(own_a, own_b), np.where(far == 1, np.minimum(own_a, own_b), np.minimum(own_a ^ low, own_b ^ low)))
    # equal substrings share all their buckets, of which the own one counts
    return ok & (far <= 2) & (first == np.uint64(bucket))


def _part(code: str, first: int, n: int) -> Column:
    """The n bits of a code column from bit ``first`` on."""
    return F.expr(f"shiftrightunsigned({code}, {first}) & {(1 << n) - 1}L")


def _in_tiles(placed: DataFrame, by: str, tile: int) -> DataFrame:
    """Rows of a bucket dealt into tiles of about ``tile`` rows by a hash of column ``by``, each with every other tile of its bucket: (ta, tb) is a group,
    ``side`` says whether a row is of the first (0), the second (1) or the only (2) tile."""
    tiles = placed.groupBy("table", "bucket").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("n"))
    dealt = placed.join(tiles, ["table", "bucket"]).withColumn("t", F.pmod(F.xxhash64(by), F.col("n")).cast("int"))
    dealt = dealt.withColumn("u", F.explode(F.expr("sequence(0, n - 1)")))
    side = F.when(F.col("t") == F.col("u"), 2).when(F.col("t") < F.col("u"), 0).otherwise(1).cast("byte")
    return dealt.select("table", "bucket", F.least("t", "u").alias("ta"), F.greatest("t", "u").alias("tb"), side.alias("side"),
                        *[c for c in placed.columns if c not in ("table", "bucket")])


def partners(entries: DataFrame, tables: list[tuple[int, int]], far: int, tile: int = CODE_TILE) -> DataFrame:
    """(table, bucket, code): where the different codes of ``entries`` (table, bucket, code) have a partner that differs in at most ``far`` bits and that
    they meet there first. Codes are compared by blocks of numbers, in tiles of bounded size; a group returns codes, never pairs."""

    def find(t: pa.Table) -> Iterator[pa.RecordBatch]:
        side, code = t.column("side").to_numpy(), t.column("code").to_numpy().view(np.uint64)
        left, right = code[side != 1], code[side != 0]
        if not len(left) or not len(right) or len(code) < 2:
            return
        table, bucket = t.column("table")[0].as_py(), t.column("bucket")[0].as_py()
        has_l, has_r = np.zeros(len(left), bool), np.zeros(len(right), bool)
        step = max(1, (1 << 18) // len(right))
        for i in range(0, len(left), step):
            apart = np.bitwise_count(left[i:i + step, None] ^ right[None, :])
            x, y = np.nonzero((apart <= far) & (apart > 0))
            x += i
            ok = _first_shared(left[x], right[y], table, bucket, tables)
            has_l[x[ok]] = True
            has_r[y[ok]] = True
        met = np.unique(np.concatenate([left[has_l], right[has_r]])).view(np.int64)
        if len(met):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(met), table, np.int32)), pa.array(np.full(len(met), bucket, np.int32)), pa.array(met)], ["table", "bucket", "code"])

    return map_sorted_groups(_in_tiles(entries, "code", tile), ["table", "bucket", "ta", "tb"], find, "table int, bucket int, code long")


def vector_links(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", max_fit: int = MAX_FIT,
                 tile: int = TILE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    every, lengths = prepared(vectors, id_col, vec_col)
    out = every.where("vec is null").select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                            F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    for dim in lengths:
        out = out.unionByName(_links(every.where(F.size("vec") == dim), dim, threshold, max_fit, tile, recall))
    return out


def _links(good: DataFrame, dim: int, threshold: float, max_fit: int, tile: int, recall: float) -> DataFrame:
    """The result for vectors of one length."""
    spark = good.sparkSession
    # classes of equal vectors, told apart by their components and not by a hash; c is some row's number
    classes = cut_lineage(good.groupBy("vec").agg(F.min("row").alias("c"), F.min("id").alias("low"), F.count("*").alias("size")))
    n = classes.count()
    sample = classes.select("vec", F.xxhash64("vec").alias("h"))
    if n > max_fit:
        sample = sample.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * max_fit / n))
    rows = sorted((r.h, r.vec) for r in sample.toLocalIterator())
    fit = np.array([v for _, v in rows]).reshape(-1, dim)
    mean, project = learn_rotation(fit, min(64, dim))
    tables, far, exact = choose_tables(fit, mean, project, threshold, recall)
    model = spark.sparkContext.broadcast((mean, project))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = codes_of(_matrix(b.column(1), dim), *model.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(k.view(np.int64))], ["c", "code"])

    coded = cut_lineage(classes.select("c", "vec").mapInArrow(code, "c long, code long"))

    def entered(df: DataFrame) -> DataFrame:
        """A row for each table and bucket that a code enters."""
        per = []
        for t, (s, w) in enumerate(tables):
            own = F.expr(f"cast(shiftrightunsigned(code, {s}) & {(1 << w) - 1} as int)")
            per += [F.struct(F.lit(t).alias("table"), own.alias("bucket"))]
            per += [F.struct(F.lit(t).alias("table"), own.bitwiseXOR(F.lit(1 << k)).alias("bucket")) for k in range(w)]
        return df.withColumn("e", F.explode(F.array(*per))).select("*", "e.table", "e.bucket").drop("e")

    # where a code has a partner: a bucket that is the smallest one shared with some code not far away, or the first table's own bucket
    # if several vectors have the code. Only codes travel here, and none of their pairs leave a task
    alike = coded.groupBy("code").agg(F.count("*").alias("k"))
    several = alike.where("k > 1").select(F.lit(0).alias("table"), _part("code", *tables[0]).cast("int").alias("bucket"), "code")
    if exact:  # one bucket, whose tiles are all compared
        near = alike.select(F.lit(0).alias("table"), F.lit(0).alias("bucket"), "code")
    else:
        entries = cut_lineage(entered(alike.select("code")).select("table", "bucket", "code"))
        near = cut_lineage(partners(entries, tables, far).unionByName(several).distinct())
    placed = near.join(coded, "code")
    dealt = _in_tiles(placed.join(classes.select("c", "vec", "size"), "c"), "c", tile)

    def compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
        side = t.column("side").to_numpy()
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if not len(left) or not len(right) or len(side) < 2:
            return
        table, bucket = int(t.column("table")[0].as_py()), int(t.column("bucket")[0].as_py())
        c, size = t.column("c").to_numpy(), t.column("size").to_numpy()
        code_, vec = t.column("code").to_numpy().view(np.uint64), _matrix(t.column("vec"), dim)
        links, labels = np.zeros(len(c), dtype=np.int64), np.arange(len(c))
        for i in range(0, len(left), 256):
            rows = left[i:i + 256]
            hit = vec[rows] @ vec[right].T >= threshold
            x, y = np.nonzero(hit)  # few: only these are asked where they meet first
            p, q = rows[x], right[y]
            fine = _first_shared(code_[p], code_[q], table, bucket, tables) & (c[p] != c[q])
            fine &= (side[p] + side[q] != 4) | (c[p] < c[q])  # both of one tile: each pair is met from either end
            hit[x, y] = fine
            if not fine.any():
                continue
            links[rows] += hit @ size[right]
            links[right] += size[rows] @ hit
            for k in np.flatnonzero(hit.any(1)):
                merge_labels(labels, np.append(right[hit[k]], rows[k]))
        with_links = np.flatnonzero(links)
        if len(with_links):
            yield pa.RecordBatch.from_arrays([pa.array(c[with_links]), pa.array(c[labels[with_links]]), pa.array(links[with_links])], ["c", "root", "links"])

    out = cut_lineage(map_sorted_groups(dealt, ["table", "bucket", "ta", "tb"], compare, "c long, root long, links long"))
    comp = connected_components(out, "c", "root")
    count = out.groupBy("c").agg(F.sum("links").alias("links"))
    named = (classes.select("c", "low", "size").join(comp.withColumnRenamed("node", "c"), "c", "left").join(count, "c", "left")
             .select("c", "low", F.coalesce("component", "c").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    member = good.join(classes.select("vec", "c"), "vec").select("id", "row", "c")
    linked = member.join(named.join(low, "root").select("c", "n_links", "component_id"), "c").select("id", "n_links", "component_id")
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
    return linked.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept.alias("kept"))
