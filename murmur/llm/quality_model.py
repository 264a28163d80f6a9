"""Naive Bayes support vectors for document quality.

Features are indicators of n-grams (one and two tokens) of a text's pieces: runs of letters, runs of digits and runs of
other marks, each as itself (A-Z in lower case) and as its shape, so that words never seen still tell
something. They are hashed to ``2 ** bits`` columns. An indicator is scaled by the logarithm of the ratio of its smoothed
shares in the two classes; on the scaled rows a linear model with hinge loss is fitted by dual coordinate
descent. Margins become scores by a logistic curve that is fitted to the margins of labelled rows the linear
model has not seen.

The model is fitted on at most ``max_rows`` labelled ids, about (default 20,000, those with the smallest hashes; all of them if
there are fewer), one row of each. A score depends on the text alone.

Defined results: a very long text is handled whole, like any other (a task holds one batch of texts); null, empty and wordless texts are scored by the model's constant; labels that are null are left
out, several labels of an id count as one (the smallest); without labels of both kinds every score is the share of 1
among the labels, one half if there are none; rows with a null id or a repeated id are scored like any other; an
empty table gives no rows. Other columns are not read."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage

BITS = 18
MAX_ROWS = 20_000
_PIECE = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def shape(piece: str) -> str:
    """Class of a piece, a bounded set: letters by case, digits, or marks by their first one and whether they repeat."""
    c = piece[0]
    if c.isalpha():
        return "U" if len(piece) > 1 and piece.isupper() else "T" if c.isupper() else "l"
    if c.isdigit():
        return "9"
    return f"{c}+" if len(piece) > 1 else c


class Featuriser:
    """Hashed features of texts; remembers what it has hashed, up to a bound."""

    def __init__(self, bits: int = BITS, memory: int = 200_000):
        self.mask, self.memory = (1 << bits) - 1, memory
        self.pieces: dict[str, tuple[int, int]] = {}
        self.shapes: dict[str, int] = {}

    def _piece(self, p: str) -> tuple[int, int]:
        s = shape(p)
        return (xxhash.xxh64_intdigest(p.lower()) >> 1, self.shapes.setdefault(s, xxhash.xxh64_intdigest(s, 7) >> 1))

    def __call__(self, text: str | None) -> np.ndarray:
        """The columns that are set, sorted; never none: the last one is the constant."""
        found = _PIECE.findall(text or "")
        if len(self.pieces) > self.memory:
            self.pieces.clear()
        for p in set(found).difference(self.pieces):
            self.pieces[p] = self._piece(p)
        if not found:
            return np.array([self.mask], dtype=np.int32)
        a = np.array([self.pieces[p] for p in found], dtype=np.uint64)
        word, form = a[:, 0], a[:, 1]
        k = np.uint64(0x9E3779B97F4A7C15)
        mixed = lambda x, y, salt: ((x * k) ^ (y + np.uint64(salt))) * k
        every = np.concatenate([word * k, form * k, mixed(word[:-1], word[1:], 1), mixed(form[:-1], form[1:], 2),
                                mixed(mixed(form[:-2], form[1:-1], 3), form[2:], 4), k * (word[1:] == word[:-1]).any(keepdims=True)])
        # the last column is the constant
        return np.unique(np.append((every >> np.uint64(20)).astype(np.int64) & self.mask, self.mask)).astype(np.int32)


def fit_linear(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float = 1.0, rounds: int = 30, seed: int = 5) -> np.ndarray:
    """Weights of a linear model with hinge loss: dual coordinate descent over the scaled rows, in a fresh random order each round.
    A row's values are the scales of its columns divided by their norm."""
    rng, w, alpha = np.random.default_rng(seed), np.zeros(len(scale)), np.zeros(len(rows))
    values = [scale[r] for r in rows]
    norm = np.array([max(1e-12, float(np.sqrt(v @ v))) for v in values])
    values = [v / n for v, n in zip(values, norm)]
    diag = np.array([max(1e-12, float(v @ v)) for v in values])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * float(w[rows[i]] @ values[i]) - 1.0
            new = min(max(alpha[i] - g / diag[i], 0.0), cost)
            step = new - alpha[i]
            if step:
                w[rows[i]] += step * y[i] * values[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def fit_curve(margin: np.ndarray, good: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve by Newton's method, with smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        grad = x.T @ (target - p)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a, b = a + np.clip(step[0], -5, 5), b + np.clip(step[1], -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


class Model:
    """Scales, weights and curve; ``score`` takes columns that are set."""

    def __init__(self, share: float, scale=None, weight=None, curve=(1.0, 0.0)):
        self.share, self.curve = share, curve
        self.scale, self.product = scale, None if scale is None else scale * weight
        self.square = None if scale is None else scale * scale

    def score(self, columns: np.ndarray) -> float:
        if self.scale is None:
            return self.share
        margin = self.product[columns].sum() / max(1e-6, float(np.sqrt(self.square[columns].sum())))
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -40, 40))))


def fit(rows: list[np.ndarray], good: np.ndarray, bits: int = BITS, smooth: float = 1.0) -> Model:
    """The model from sampled rows. Each fourth row is kept out of the linear fit and used for the curve."""
    if len(rows) == 0 or good.all() or not good.any():
        return Model(float(good.mean()) if len(rows) else 0.5)
    for_curve = np.arange(len(rows)) % 4 == 3
    if len(rows) < 40 or good[for_curve].all() or not good[for_curve].any() or good[~for_curve].all() or not good[~for_curve].any():
        for_curve = np.zeros(len(rows), dtype=bool)
    used = np.flatnonzero(~for_curve)
    count = np.full((2, 1 << bits), smooth)
    for i in used:
        count[int(good[i]), rows[i]] += 1
    scale = np.log((count[1] / count[1].sum()) / (count[0] / count[0].sum()))
    scale[(count.sum(0) <= 2 * smooth + 1) & (np.arange(1 << bits) != (1 << bits) - 1)] = 0.0  # seen once: no evidence
    weight = fit_linear([rows[i] for i in used], np.where(good[used], 1.0, -1.0), scale)
    plain = Model(0.5, scale, weight)

    def margin(r):
        return plain.product[r].sum() / max(1e-6, float(np.sqrt(plain.square[r].sum())))
    at = np.flatnonzero(for_curve) if for_curve.any() else used
    return Model(0.5, scale, weight, fit_curve(np.array([margin(rows[i]) for i in at]), good[at]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_rows: int = MAX_ROWS, bits: int = BITS) -> Model:
    """Fit on labelled rows for which ``learn`` holds. The features of at most ``max_rows`` of them come to the driver."""
    truth = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.min(label_col) > 0).alias("good")))
    rows = docs.where(learn).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    # ids are chosen before texts are moved: those with the smallest hashes, about max_rows at most
    ids = rows.select("_id").distinct().join(truth, "_id").withColumn("_hash", F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 30)))
    ids = cut_lineage(ids)
    n = ids.count()
    if n > max_rows:
        ids = ids.where(F.col("_hash") < int((1 << 30) * max_rows / n))
    chosen = rows.join(F.broadcast(ids.select("_id", "good")), "_id").select("_id", "good", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Featuriser(bits)
        for b in batches:
            cols = [features(x.as_py()).tobytes() for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cols, pa.binary())], ["id", "good", "columns"])

    got = chosen.mapInArrow(run, "id long, good boolean, columns binary").dropDuplicates(["id"]).toLocalIterator()
    found = sorted((xxhash.xxh64_intdigest(str(r.id)), r.id, bytes(r.columns), r.good) for r in got)
    return fit([np.frombuffer(c, dtype=np.int32) for _, _, c, _ in found], np.array([g for *_, g in found], dtype=bool), bits)


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model.__dict__)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, features = object.__new__(Model), Featuriser(bits)
        m.__dict__.update(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(features(x.as_py())) for x in b.column(1)], pa.float64())],
                                             ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
