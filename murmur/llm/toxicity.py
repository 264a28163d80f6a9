"""Toxicity by compression distance: two zstandard dictionaries, one trained on toxic and one on ordinary text.

A text's windows are its words (A-Z lower-cased, ASCII marks taken as blanks), or pieces of ``WINDOW`` bytes, overlapping by half, of
longer ones. Each window is compressed with both dictionaries; the two lengths say which sort of text it is nearer to. A
fixed carrier stands before every window, in training too, as zstandard stores what is too short to shrink.

Learning, from a bounded sample of the labelled documents (``max_rows`` of each class, by a hash of their ids), in three parts:

* Half of the documents give the dictionaries. Most of a toxic document is ordinary text, so a window counts once for each word it
  follows (which copies of a document don't change), and the toxic dictionary is trained on windows that follow ``ratio`` times as many words
  in toxic documents as in ordinary ones, beyond chance; the ordinary one on the windows of ordinary documents. Of either, at
  most ``max_windows`` come to the driver.
* A quarter gives, for each pair of compressed lengths, how much likelier it is in toxic than in ordinary documents.
* The last quarter calibrates: a document's evidence is the sum of the logarithms of those ratios over its distinct windows, where they are
  above ``min_evidence``; a logistic curve of it and of the number of windows, weighted by how frequent the classes are among the labels, gives
  the score. A threshold on the score is one on a probability.

Scoring is one pass over whole texts. A worker remembers a bounded number of windows; what it remembers changes no result.

Defined results: null, empty and blank texts have no windows and are scored by their lack of evidence; rows with null or repeated ids
are scored each; several labels of an id count as toxic if one is; without toxic or ordinary labelled documents, or without any window that tells them
apart, all rows have the share of toxic labels as score (0 without labels); an empty table gives no rows; very long texts and words are scored
whole; other columns are not read."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage, kept_by_worker, written

WINDOW = 48
MAX_ROWS, MAX_WINDOWS = 8_000, 60_000
DICTIONARY = 4096
#: Longer compressed windows count as this long.
LENGTHS = 64
#: Windows that a worker remembers.
HELD = 300_000
_CARRIER = b"@0123456789=ABCDEFGHIJKLM~"
_BLANK = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else b for b in range(256))


def windows(text: str | None) -> list[bytes]:
    """The windows of a text in order."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_BLANK).split()
    if all(len(w) <= WINDOW for w in words):
        return words
    step = WINDOW // 2
    return [w[i:i + WINDOW] for w in words for i in (range(0, max(1, len(w) - step), step) if len(w) > WINDOW else (0,))]


def _parameters() -> zstandard.ZstdCompressionParameters:
    """Optimal parsing with short matches: windows are words."""
    return zstandard.ZstdCompressionParameters(
        window_log=15, chain_log=12, hash_log=12, search_log=5, min_match=3, target_length=64, strategy=zstandard.STRATEGY_BTULTRA2,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary from windows, eight of them a sample; of too few for training, the windows themselves are the dictionary."""
    parts = [_CARRIER + b" " + b" ".join(samples[i:i + 8]) + b" " for i in range(0, max(1, len(samples) - 4), 4)]
    try:
        return zstandard.train_dictionary(size, parts, k=64, d=6, level=19).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:] + b" " + _CARRIER


class Distance:
    """Compressed lengths of windows with either dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        p = _parameters()
        self._with = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=p) for d in (toxic, ordinary)]

    def lengths(self, found: list[bytes]) -> np.ndarray:
        """A row for each window: its length with the toxic and with the ordinary dictionary."""
        if not found:
            return np.zeros((0, 2), np.int64)
        data = [_CARRIER + b" " + w + b" " for w in found]
        out = [[len(x) for x in c.multi_compress_to_buffer(data, threads=0)] for c in self._with]
        return np.minimum(np.array(out, np.int64).T, LENGTHS - 1)


@dataclass
class Model:
    """What scoring needs; a few kilobytes."""
    toxic: bytes = b""
    ordinary: bytes = b""
    evidence: list[float] = field(default_factory=list)  # by toxic length * LENGTHS + ordinary length
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)  # constant, evidence, logarithm of the number of windows
    base: float = 0.0

    def key(self) -> str:
        return hashlib.sha256(repr((self.toxic, self.ordinary, self.evidence)).encode()).hexdigest()


class Scorer:
    """Evidence of texts, with a memory of windows."""

    def __init__(self, model: Model, held: int = HELD):
        self.distance, self.table, self.known, self.held = Distance(model.toxic, model.ordinary), np.array(model.evidence), {}, held

    def evidence(self, texts: list[str | None]) -> list[tuple[float, int]]:
        """(sum of evidence, number) of each text's distinct windows."""
        sets = [set(windows(t)) for t in texts]
        if len(self.known) > self.held:
            self.known.clear()
        new = list(set().union(*sets).difference(self.known))
        at = self.distance.lengths(new)
        self.known.update(zip(new, self.table[at[:, 0] * LENGTHS + at[:, 1]].tolist()))
        return [(math.fsum(map(self.known.__getitem__, s)), len(s)) for s in sets]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve by Newton steps; the constant is not penalised."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.0] + [penalty] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sampled(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic, part) of the labelled documents that are learned from; part is 0 and 1 (dictionaries), 2 (lengths) or 3
    (calibration). The ids are chosen first, so that texts are not shuffled."""
    truth = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    truth = truth.where(learn).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).withColumn("h", F.xxhash64("doc_id"))
    ids = None
    for c in (0, 1):
        some = truth.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(max_rows)
        ids = some if ids is None else ids.unionByName(some)
    ids = F.broadcast(cut_lineage(ids.select(F.col("doc_id").alias("_id"), "toxic", F.pmod(F.shiftright("h", 8), F.lit(4)).cast("int").alias("part"))))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_own"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.join(ids, F.col("_own") == F.col("_id")).select("text", "toxic", "part")


def _contexts(rows: DataFrame) -> DataFrame:
    """(toxic, before, window), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, toxic in zip(b.column(0), b.column(1).to_pylist()):
                w = windows(text.as_py())
                pairs = list(set(zip([b"", *w], w)))
                yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(pairs), pa.int32()), pa.array([p for p, _ in pairs], pa.binary()),
                                                  pa.array([p for _, p in pairs], pa.binary())], ["toxic", "before", "window"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, before binary, window binary").distinct()


def training_windows(rows: DataFrame, ratio: float = 7.0, least: int = 3, max_windows: int = MAX_WINDOWS) -> tuple[list[bytes], list[bytes]]:
    """Windows for the toxic and the ordinary dictionary, one for each context, in the order of a hash."""
    pairs = cut_lineage(_contexts(rows))
    n = {r.toxic: r.n for r in pairs.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return [], []
    a, b = F.sum("toxic"), F.sum(1 - F.col("toxic"))
    by = pairs.groupBy("window").agg(a.alias("a"), b.alias("b"))
    expected = (F.col("b") + 1) * F.lit(n[1] / n[0])
    odd = by.where((F.col("a") >= least) & ((F.col("a") + 0.5) / n[1] >= ratio * (F.col("b") + 0.5) / n[0]) & (F.col("a") - 2 * F.sqrt("a") > expected)).select("window")

    def some(found: DataFrame) -> list[bytes]:
        return [bytes(r.window) for r in found.orderBy(F.xxhash64("before", "window"), "before", "window").limit(max_windows).select("window").collect()]

    return some(pairs.where("toxic = 1").join(odd, "window", "left_semi")), some(pairs.where("toxic = 0"))


def _length_counts(rows: DataFrame, toxic: bytes, ordinary: bytes) -> Counter:
    """Documents' distinct windows by (class, length with either dictionary): at most 2 * LENGTHS ** 2 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(Model(toxic, ordinary, list(range(LENGTHS * LENGTHS))))
        out: Counter = Counter()
        for b in batches:
            for text, c in zip(b.column(0), b.column(1).to_pylist()):
                found = set(windows(text.as_py()))
                s.evidence([text.as_py()])
                out.update((c, int(s.known[w])) for w in found)
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int32()), pa.array([k for _, k in out], pa.int32()),
                                          pa.array(list(out.values()), pa.int64())], ["toxic", "cell", "n"])

    found = rows.select("text", "toxic").mapInArrow(run, "toxic int, cell int, n long").groupBy("toxic", "cell").agg(F.sum("n").alias("n"))
    return Counter({(r.toxic, r.cell): r.n for r in found.collect()})


def evidence_table(counts: Counter, min_evidence: float, prior: float = 2.0) -> list[float]:
    """The logarithm of how much likelier each pair of lengths is in toxic documents, smoothed; 0 where it is below ``min_evidence``."""
    total = [sum(n for (c, _), n in counts.items() if c == k) for k in (0, 1)]
    out = [0.0] * (LENGTHS * LENGTHS)
    for cell in {k for _, k in counts}:
        a, b = counts[1, cell], counts[0, cell]
        pooled = (a + b) / sum(total)
        gain = math.log((a + prior * pooled * total[1] / (a + b)) / (total[1] + prior)) - math.log((b + prior * pooled * total[0] / (a + b)) / (total[0] + prior))
        if gain >= min_evidence:
            out[cell] = gain
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_rows: int = MAX_ROWS, max_windows: int = MAX_WINDOWS, ratio: float = 7.0,
          min_evidence: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from the labelled documents for whose ``doc_id`` ``learn`` holds (all by default)."""
    learn = F.lit(True) if learn is None else learn
    seen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(learn).agg(F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("int")).alias("a")).first()
    base = (seen.a or 0) / seen.n if seen.n else 0.0
    rows = written(sampled(docs, labels, learn, max_rows, id_col, text_col), "toxic-sample")
    toxic, ordinary = training_windows(rows.where("part < 2"), ratio, 3, max_windows)
    if not toxic or not ordinary:
        return Model(base=base)
    model = Model(train_dictionary(toxic), train_dictionary(ordinary), base=base)
    counts = _length_counts(rows.where("part = 2"), model.toxic, model.ordinary)
    if {c for c, _ in counts} != {0, 1}:
        return Model(base=base)
    model.evidence = evidence_table(counts, min_evidence)
    held = evidence(rows.where("part = 3"), model, ["toxic"], "text").collect()  # at most a quarter of twice max_rows
    y = np.array([r.toxic for r in held], float)
    if not len(y) or y.min() == y.max():
        return Model(base=base)
    x = np.array([[1.0, r.evidence, math.log1p(r.n)] for r in held])
    share = np.where(y == 1, base / y.mean(), (1 - base) / (1 - y.mean()))
    model.weights = tuple(logistic(x, y, share).tolist())
    return model


def evidence(docs: DataFrame, model: Model, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` columns with the evidence and the number of distinct windows of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = kept_by_worker(("toxicity",), dict)  # one model's memory at a time
        if model.key() not in kept:
            kept.clear()
            kept[model.key()] = Scorer(model)
        s = kept[model.key()]
        for b in batches:
            texts = b.column(b.num_columns - 1)
            got = [e for i in range(0, b.num_rows, 256) for e in s.evidence(texts.slice(i, 256).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([e for e, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int64())],
                                             [*b.schema.names[:-1], "evidence", "n"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("_text"))
    types = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{types}, evidence double, n long")


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    if not model.evidence:
        return rows.select("doc_id", F.lit(model.base).alias("score"))
    w0, w1, w2 = (F.lit(w) for w in model.weights)
    score = 1 / (1 + F.exp(-(w0 + w1 * F.col("evidence") + w2 * F.log1p("n"))))
    return evidence(rows, model, ["doc_id"], "text").select("doc_id", score.alias("score"))
