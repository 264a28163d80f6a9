"""SimHash near-duplicates: exact tiled comparison of fingerprints.

A fingerprint's bit is 1 if it is set in over half of the hashes of the text's word shingles,
repeats included. Two fingerprints link if they differ in at most ``max_bits`` bits.

Distinct fingerprints are laid out in cells by the population counts of their ``parts`` equal
slices; the counts of two linked fingerprints differ by at most ``max_bits`` in total, so only
cells within that distance are compared (exact: nothing is lost). Cells are cut into tiles of
about ``tile`` fingerprints; each pair of tiles is one group of bounded size, compared by
exclusive-or and bit counts. A pair of tiles reports a spanning forest of its links, not the
links, so a group of n near copies gives n rows and not n squared.

Defined results: null and empty texts and texts without words have fingerprint 0 and link like any
other; rows with a null id take part and have a component; a repeated row gives a repeated row; an
empty table gives an empty one. Other columns of the input are not read."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage, kept_by_worker
from murmur.llm.components import connected_components
from murmur.llm.groups import map_sorted_groups, merge_labels

SEED = 42
TILE = 8192
PARTS = 3
_CHUNK = 1 << 16


def fingerprint(text: str | None, width: int) -> int:
    """Fingerprint (unsigned) of one text. Hashes are gathered 65,536 at a time, so memory does not
    grow with the text beyond the text itself."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    starts, ends = starts[:n], ends[width - 1:]
    ones = np.zeros(64, np.int64)
    hash64 = xxhash.xxh64_intdigest
    for i in range(0, n, _CHUNK):
        h = np.array([hash64(joined[x:y], SEED) for x, y in zip(starts[i:i + _CHUNK].tolist(), ends[i:i + _CHUNK].tolist())],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text", carry: Column | None = None) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long; with ``carry`` also a long column ``carried`` of the same row."""
    carry = F.lit(0) if carry is None else carry
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), carry.cast("long").alias("carried"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker(("simhash",), dict)  # what another operator remembered goes
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), width) for x in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2)], ["doc_id", "fp", "carried"])

    return ids.mapInArrow(run, "doc_id long, fp long, carried long")


def slice_bounds(parts: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each slice."""
    at = [64 * i // parts for i in range(parts + 1)]
    return [(x, y - x) for x, y in zip(at, at[1:])]


def tile_pairs(fps: DataFrame, max_bits: int, tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """Deal distinct fingerprints (fp) out to the pairs of tiles that have to be compared:
    (cell_a, tile_a, cell_b, tile_b, side, fp), side 0 or 1, 2 where a tile meets itself."""
    bounds = slice_bounds(parts)
    base = [n + 1 for _, n in bounds]
    counts = [F.bit_count(F.expr(f"shiftrightunsigned(fp, {s})").bitwiseAND(F.lit((1 << n) - 1) if n < 64 else F.lit(-1)))
              for s, n in bounds]

    def code(xs):
        out = F.lit(0)
        for x, b in zip(xs, base):
            out = out * F.lit(b) + x
        return out.cast("int")

    rows = fps.select("fp", F.array(*[c.cast("int") for c in counts]).alias("pops"))
    rows = rows.withColumn("cell", code([F.col("pops")[i] for i in range(parts)]))
    # at most the product of (slice bits + 1) rows, 10,648 for three slices, whatever the input
    tiles = F.broadcast(rows.groupBy(F.col("cell").alias("c")).agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("n")))
    near = [d for d in itertools.product(range(-max_bits, max_bits + 1), repeat=parts) if sum(map(abs, d)) <= max_bits]
    ok = [F.when(F.greatest(*[F.lit(0)] * 2, *[(-F.col("pops")[i] - x) for i, x in enumerate(d)],
                            *[(F.col("pops")[i] + x - (base[i] - 1)) for i, x in enumerate(d)]) == 0,
                 code([F.col("pops")[i] + x for i, x in enumerate(d)])) for d in near]
    rows = (rows.join(tiles, F.col("cell") == F.col("c"))
            .withColumn("t", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")).drop("c", "n")
            .withColumn("other", F.explode(F.array_compact(F.array(*ok)))).drop("pops"))
    rows = rows.join(tiles, F.col("other") == F.col("c")).withColumn("u", F.explode(F.expr("sequence(0, n - 1)")))
    own, far = F.struct(F.col("cell").alias("c"), F.col("t").alias("t")), F.struct(F.col("other").alias("c"), F.col("u").alias("t"))
    a, b = F.least(own, far), F.greatest(own, far)
    return rows.select(a["c"].alias("cell_a"), a["t"].alias("tile_a"), b["c"].alias("cell_b"), b["t"].alias("tile_b"),
                       F.when(own == far, 2).when(own == a, 0).otherwise(1).cast("byte").alias("side"), "fp")


def _compare(max_bits: int):
    def each(t: pa.Table) -> Iterator[pa.RecordBatch]:
        side, fp = t.column("side").to_numpy(), t.column("fp").to_numpy().view(np.uint64)
        left = np.flatnonzero(side != 1)
        right = np.flatnonzero(side != 0)
        if not len(left) or not len(right):
            return
        labels = np.arange(len(fp))
        other = fp[right]
        for i in range(0, len(left), 128):
            rows = left[i:i + 128]
            hit = np.bitwise_count(fp[rows, None] ^ other[None, :]) <= max_bits
            for k in np.flatnonzero(hit.any(1)):
                merge_labels(labels, np.append(right[hit[k]], rows[k]))
        member = np.flatnonzero(labels != np.arange(len(fp)))
        if len(member):
            yield pa.RecordBatch.from_arrays([pa.array(fp[labels[member]].view(np.int64)), pa.array(fp[member].view(np.int64))], ["a", "b"])
    return each


def links(fps: DataFrame, max_bits: int, tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """(a, b): edges between distinct fingerprints whose components are those of all links."""
    return map_sorted_groups(tile_pairs(fps, max_bits, tile, parts), ["cell_a", "tile_a", "cell_b", "tile_b"],
                             _compare(max_bits), "a long, b long")


def simhash_classes(sig: DataFrame, max_bits: int, tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """(fp, root, component_id) of every fingerprint in ``sig`` (doc_id, fp): root names the component, component_id is its
    smallest id, null if it has none."""
    classes = cut_lineage(sig.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comp = connected_components(links(classes.select("fp"), max_bits, tile, parts), "a", "b")
    named = classes.join(comp, classes.fp == comp.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    return named.drop("low").join(named.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "root", "component_id")


def simhash_groups(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
                   tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """(doc_id, fp long, component_id): every row with its fingerprint and the smallest id that its links reach."""
    sig = cut_lineage(fingerprints(docs, width, id_col, text_col).drop("carried"))
    classes = simhash_classes(sig, max_bits, tile, parts)
    return sig.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row of each group. The row is the one with the smallest id (rows
    without an id come last); rows that share this id but not the text are told apart by fingerprint and a hash of the text."""
    key, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    sig = cut_lineage(fingerprints(docs.select(key.alias("doc_id"), text.alias("text")), width, carry=F.xxhash64("text")))
    classes = simhash_classes(sig.select("doc_id", "fp"), max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", F.col("carried").alias("h"))).alias("first")
    stay = sig.join(classes.select("fp", "root"), "fp").groupBy("root").agg(first).select("first.*")
    # what names a row: its id, if it has one, and its text's hash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("_row"), key.isNull().alias("_none"), F.coalesce(key, F.lit(0)).alias("_id"), F.xxhash64(text).alias("_h"))
    stay = stay.select(F.col("none").alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("h").alias("_h"))
    kept = rows.join(stay, ["_none", "_id", "_h"], "left_semi").dropDuplicates(["_none", "_id", "_h"])
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
