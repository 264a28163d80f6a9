"""Exact nearest neighbours of many vectors among many, by pivots and the triangle inequality.

A hash-chosen sample of the points are the pivots, at most ``MAX_PIVOTS``; each point belongs to the cell of its nearest
pivot, whose radius is the largest distance of its points. A query first meets the nearest cells that hold enough points,
which bounds the distance of its k-th neighbour; then every other cell that can hold a point within this bound: by the cell's radius, by the
plane halfway between its pivot and the query's own, and, in few dimensions, by the cell's box. No
other cell can hold a nearer point, so nothing is lost, and cells far away are never compared. Points and queries of a cell meet
in tiles of at most ``TILE`` by ``TILE`` rows, one group each; at most k neighbours a query leave a tile, and of a later cell only those within the bound."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE, MAX_PIVOTS = 8192, 2048
#: Rounding of distances is allowed for where cells are skipped, and of products where points are.
SLACK, ROUNDING = 1e-9, 1e-12
#: Boxes are kept up to so many dimensions.
BOXED = 16


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's checkpoint folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = a.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(a), -1) if len(a) else flat.reshape(0, 0)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, from the differences (exact for equal vectors), some rows at a time."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        d = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def _within(a: np.ndarray, bound: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``a``, place in ``b``, distance) of each row's k nearest by (distance, id) that are no farther than its bound, in that order.

    Products find what may be that near, some rows at a time; the distances are those of the differences."""
    middle = b.mean(axis=0)
    x, y = a - middle, b - middle
    x2, y2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    slack = ROUNDING * (float(x2.max()) + float(y2.max()))
    some = min(len(b), max(k, 32 * k))
    rows, places, far = [], [], []
    step = max(1, 2_000_000 // len(b))
    for s in range(0, len(a), step):
        e = min(len(a), s + step)
        d2 = x2[s:e, None] + y2[None, :] - 2 * (x[s:e] @ y.T)
        limit = bound[s:e] ** 2
        if len(b) > k:  # the k-th of a part is no nearer than the k-th of all
            limit = np.minimum(limit, np.maximum(np.partition(d2[:, :some], k - 1, axis=1)[:, k - 1], 0))
        r, c = np.nonzero(d2 <= limit[:, None] * (1 + SLACK) + slack)
        gap = a[s + r] - b[c]
        d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        near = d <= bound[s + r]
        r, c, d = r[near], c[near], d[near]
        order = np.lexsort((ids[c], d, r))
        r, c, d = r[order], c[order], d[order]
        nth = np.arange(len(r)) - np.searchsorted(r, r)
        rows.append(s + r[nth < k])
        places.append(c[nth < k])
        far.append(d[nth < k])
    return np.concatenate(rows), np.concatenate(places), np.concatenate(far)


def nearest(queries: DataFrame, points: DataFrame, k: int, tile: int = TILE, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(id, found, cell): for each query (id long, vec array<double>) its k nearest points (id, vec, [weight long]) as (d, id, [weight]), by distance, then
    id, and the number of its nearest pivot. Vectors have one length and no nulls; fewer than k points are all found; without points ``found`` is empty."""
    spark = queries.sparkSession
    weighed = "weight" in points.columns
    found_type = f"array<struct<d: double, id: bigint{', weight: bigint' if weighed else ''}>>"
    n = points.count()
    if n == 0:
        return queries.select("id", F.array().cast(found_type).alias("found"), F.lit(0).alias("cell"))
    m = min(max_pivots, max(1, -(-2 * n // tile)))
    pivots = np.array([r.vec for r in points.orderBy(F.xxhash64("id"), "id").limit(m).select("vec").collect()], dtype=float)
    m = len(pivots)
    shared = spark.sparkContext.broadcast(pivots)
    points = points.select("id", "vec", *["weight"] * weighed)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = _distances(_matrix(b.column("vec")), shared.value)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])], [*b.schema.names, "cell", "d"])

    placed = written(points.mapInArrow(assign, f"id long, vec array<double>, {'weight long, ' * weighed}cell int, d double"), "points")
    dim = pivots.shape[1]
    boxed = dim <= BOXED
    size, radius = np.zeros(m, np.int64), np.zeros(m)
    low, high = np.zeros((m, dim)), np.zeros((m, dim))
    edges = [f(F.col("vec")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(dim if boxed else 0)]
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("r"), *edges).collect():  # one row a pivot
        size[r.cell], radius[r.cell] = r.n, r.r
        if boxed:
            low[r.cell], high[r.cell] = ([r[f"{name}{i}"] for i in range(dim)] for name in ("low", "high"))
    tiles = spark.createDataFrame([(int(c), int(-(-s // tile))) for c, s in enumerate(size) if s], "cell int, tiles int")
    placed = placed.join(F.broadcast(tiles), "cell")
    placed = placed.select("cell", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("tile"), "id", "vec", *["weight"] * weighed)

    def first_cells(d: np.ndarray) -> np.ndarray:
        """The nearest cells that hold k points."""
        order = np.argsort(d, axis=1, kind="stable")
        before = np.cumsum(size[order], axis=1) - size[order]
        out = np.zeros(d.shape, bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out & (size > 0)

    def reached(q: np.ndarray, d: np.ndarray, own: np.ndarray, apart: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Cells that can hold a point within each query's bound. What can't be told (nan) can."""
        limit = (bound * (1 + SLACK) + SLACK)[:, None]
        with np.errstate(all="ignore"):
            gap = apart[own]
            # a point of the cell is no nearer to the own pivot than to the cell's
            plane = (d ** 2 - d[np.arange(len(d)), own][:, None] ** 2) / (2 * gap) - ROUNDING * (d ** 2 + radius ** 2) / gap
            out = ~(d - radius > limit) & ~(plane > limit)
            if boxed:
                row, cell = np.nonzero(out)
                out_of = np.maximum(np.maximum(low[cell] - q[row], q[row] - high[cell]), 0)
                out[row, cell] = ~(np.sqrt((out_of ** 2).sum(axis=1)) > limit[row, 0])
        return out

    def visits(rest: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            apart = _distances(shared.value, shared.value) if rest else np.zeros(0)
            for whole in batches:
                for s in range(0, whole.num_rows, 2048):
                    b = whole.slice(s, 2048)
                    q = _matrix(b.column("vec"))
                    d = _distances(q, shared.value)
                    own, go = d.argmin(1), first_cells(d)
                    bound = np.full(len(q), np.inf)
                    if rest:
                        bound = b.column("bound").to_numpy(zero_copy_only=False)
                        go = ~go & (size > 0) & reached(q, d, own, apart, bound)
                    row, cell = np.nonzero(go)
                    take = pa.array(row)
                    cols = [pa.array(cell, pa.int32()), b.column("id").take(take), b.column("vec").take(take), pa.array(bound[row]), pa.array(own[row], pa.int32())]
                    yield pa.RecordBatch.from_arrays(cols, ["cell", "id", "vec", "bound", "own"])
        return run

    def compare(t: pa.Table) -> pa.Table:
        mine = t.column("side").to_numpy() == 1
        ids, vec = t.column("id").to_numpy(), _matrix(t.column("vec"))
        asks, own = ids[mine], t.column("own").to_numpy()[mine]
        row, place, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(asks) and len(asks) < len(ids):
            row, place, d = _within(vec[mine], t.column("bound").to_numpy()[mine], vec[~mine], ids[~mine], k)
        which, first = np.unique(row, return_index=True)
        parts = {"d": pa.array(d), "id": pa.array(ids[~mine][place], pa.int64())}
        if weighed:
            parts["weight"] = pa.array(t.column("weight").to_numpy()[~mine][place], pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.StructArray.from_arrays(list(parts.values()), list(parts)))
        return pa.table({"id": pa.array(asks[which], pa.int64()), "found": lists, "cell": pa.array(own[which], pa.int32())})

    def meet(asked: DataFrame) -> DataFrame:
        """Found in the visited cells, tile by tile: (id, found, cell)."""
        asked = written(asked, "visits")
        blocks = F.broadcast(asked.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks")).join(F.broadcast(tiles), "cell"))  # one row a pivot
        none = [F.lit(0).cast("long").alias("weight")] * weighed
        asked = asked.join(blocks, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
            F.lit(1).alias("side"), "id", "vec", "bound", "own", *none)
        here = placed.join(blocks, "cell").select("cell", "tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"), "id", "vec",
                                                  F.lit(0.0).alias("bound"), F.lit(0).alias("own"), *["weight"] * weighed)
        return here.unionByName(asked).groupBy("cell", "tile", "block").applyInArrow(compare, f"id long, found {found_type}, cell int")

    queries = queries.select("id", "vec")
    visited = "cell int, id long, vec array<double>, bound double, own int"
    first = written(meet(queries.mapInArrow(visits(False), visited)), "nearest")
    # the k-th neighbour in any tile is no nearer than the k-th of all
    bound = F.min(F.when(F.size("found") >= k, F.try_element_at("found", F.lit(k))["d"]))
    again = queries.join(first.groupBy("id").agg(F.coalesce(bound, F.lit(float("inf"))).alias("bound")), "id")
    both = first.unionByName(meet(again.mapInArrow(visits(True), visited)))
    return both.groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"), F.min("cell").alias("cell"))
