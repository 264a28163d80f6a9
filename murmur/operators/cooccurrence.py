"""M-3: text vectors from the corpus itself: co-occurrence counts, positive pointwise mutual information, truncated SVD.

Two vocabulary words co-occur where they stand at most ``window`` tokens apart. The counts are a table of word pairs, however many;
so is the matrix of their positive pointwise mutual information. Only what is as wide as the factorisation comes to the driver: for a
vocabulary of at most ``MAX_TERMS`` words (checked) and ``dim`` + ``EXTRA`` columns, the product of the matrix with a block of vectors, one aggregate by row.
The SVD is a randomised one: a random block, ``power`` rounds of products with the (symmetric) matrix and orthogonalisation, and
the small matrix's eigenvectors. A word's vector is its row scaled by the roots of the singular values; a text's is the mean of its words' vectors,
each by a / (a + p), p its share of all words (smooth inverse frequency), scaled to length 1.

Defined results: words outside the vocabulary count for nothing (but keep their place in the window); a null, empty or unknown text has
the zero vector; columns of singular values that are 0 are 0; a corpus without pairs gives zero vectors."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Tp

from murmur.operators.guided import numbers
from murmur.operators.neighbours import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TERMS, EXTRA = 50_000, 10
SIF = 1e-3


@dataclass
class WordVectors:
    terms: list[str]
    share: np.ndarray
    vectors: np.ndarray
    singular: np.ndarray


def cooccurrences(tokens: DataFrame, terms: list[str], window: int = 5) -> DataFrame:
    """(i, j, n), i <= j: how often the i-th and the j-th term stand at most ``window`` places apart in ``tokens`` (a column ``tokens``,
    an array of words)."""
    if len(terms) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms")
    shared = tokens.sparkSession.sparkContext.broadcast(terms)
    v = len(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.string())
        for b in batches:
            row, number = numbers(b.column(0), wanted)
            if not len(row):
                continue
            x = np.full(len(row) + (row[-1] + 1) * window, -1, np.int32 if v * v < 2**31 else np.int64)
            x[np.arange(len(row)) + row * window] = number  # a gap behind each text: texts don't meet
            keys = []
            for step in range(1, window + 1):
                p, q = x[:-step], x[step:]
                ok = (p >= 0) & (q >= 0)
                p, q = p[ok], q[ok]
                keys.append(np.minimum(p, q) * x.dtype.type(v) + np.maximum(p, q))
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((key // v).astype(np.int32)), pa.array((key % v).astype(np.int32)), pa.array(n)], ["i", "j", "n"])

    return tokens.select("tokens").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))


def ppmi(counts: DataFrame) -> DataFrame:
    """(i, j, v), both halves: the positive pointwise mutual information, log(n_ij N / (n_i n_j)), where above 0. A pair of a word
    with itself counts for both sides."""
    both = counts.select("i", "j", "n").unionByName(counts.select(F.col("j").alias("i"), F.col("i").alias("j"), "n"))
    both = written(both.groupBy("i", "j").agg(F.sum("n").alias("n")), "pairs")  # read for pairs and for both sides' totals
    total = both.groupBy("i").agg(F.sum("n").alias("row"))
    everything = F.broadcast(total.agg(F.sum("row").alias("all")))  # one row
    v = F.log(F.col("n") * F.col("all") / (F.col("row") * F.col("col")))
    out = both.join(total, "i").join(total.select(F.col("i").alias("j"), F.col("row").alias("col")), "j").join(everything)
    return out.select("i", "j", v.alias("v")).where("v > 0")


def times(matrix: DataFrame, block: np.ndarray) -> np.ndarray:
    """The product of (i, j, v) with a block of vectors: one aggregate by row; as many rows as the vocabulary come back."""
    shared = matrix.sparkSession.sparkContext.broadcast(block)
    width = block.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        total: np.ndarray = np.zeros(block.shape)
        seen = np.zeros(len(block), bool)
        for b in batches:
            i, j, v = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            for s in range(0, len(i), 20_000):
                order = s + np.argsort(i[s:s + 20_000], kind="stable")
                at, first = np.unique(i[order], return_index=True)
                total[at] += np.add.reduceat(block[j[order]] * v[order, None], first, axis=0)
                seen[at] = True
        rows = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)),
                                          pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * width, pa.int32()), pa.array(total[rows].reshape(-1)))], ["i", "p"])

    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    parts = matrix.select("i", "j", "v").mapInArrow(run, "i int, p array<double>")
    sums = parts.groupBy("i").agg(Summarizer.sum(array_to_vector("p")).alias("p")).select("i", vector_to_array("p").alias("p"))
    out = np.zeros(block.shape)
    for r in sums.collect():
        out[r.i] = r.p
    return out


def truncated_svd(matrix: DataFrame, size: int, dim: int, power: int = 3, extra: int = EXTRA, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The ``dim`` largest singular values of a symmetric matrix (i, j, v) with ``size`` rows, and their left vectors as columns."""
    width = min(size, dim + extra)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))[0]
    for _ in range(power + 1):
        q = np.linalg.qr(times(matrix, q))[0]
    small = q.T @ times(matrix, q)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(value), kind="stable")[:dim]
    u = q @ vector[:, order]
    u = u * np.where(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])] < 0, -1.0, 1.0)  # one sign of two
    return np.abs(value[order]), u


def learn_vectors(docs: DataFrame, tokens: str, terms: list[str], dim: int = 64, window: int = 5, power: int = 3, seed: int = 42) -> WordVectors:
    """Vectors of ``terms`` from the token arrays in column ``tokens``, which are read twice."""
    rows = docs.select(F.col(tokens).alias("tokens"))
    matrix = written(ppmi(written(cooccurrences(rows, terms, window), "cooccurrences")), "ppmi")
    s, u = truncated_svd(matrix, len(terms), dim, power, seed=seed)
    wanted = docs.sparkSession.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, i int")
    often = rows.select(F.explode("tokens").alias("term")).join(F.broadcast(wanted), "term").groupBy("i").agg(F.count("*").alias("n")).collect()
    share = np.zeros(len(terms))
    for r in often:
        share[r.i] = r.n
    vectors = np.zeros((len(terms), dim))
    vectors[:, :u.shape[1]] = u * np.sqrt(s)[None, :]
    return WordVectors(terms, share / max(1.0, share.sum()), vectors, s)


def embed_tokens(docs: DataFrame, tokens: str, model: WordVectors, out: str = "embedding", a: float = SIF) -> DataFrame:
    """``docs`` with the text vector of the token arrays in column ``tokens``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.vectors * (a / (a + model.share))[:, None]))
    dim, names = model.vectors.shape[1], docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weighted = shared.value
        wanted = pa.array(terms, pa.string())
        for b in batches:
            found = np.zeros((b.num_rows, dim))
            row, number = numbers(b.column(b.num_columns - 1), wanted)
            row, number = row[number >= 0], number[number >= 0]
            for s in range(0, len(row), 65_536):
                at, first = np.unique(row[s:s + 65_536], return_index=True)
                found[at] += np.add.reduceat(weighted[number[s:s + 65_536]], first, axis=0)
            found /= np.maximum(np.sqrt((found * found).sum(axis=1, keepdims=True)), 1e-12)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * dim, pa.int32()), pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], vectors], [*names, out])

    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{tokens}`").alias("_tokens"))
    return rows.mapInArrow(run, Tp.StructType([*docs.schema.fields, Tp.StructField(out, Tp.ArrayType(Tp.DoubleType()))]))
