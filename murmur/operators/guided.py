"""M-6: the guided topic model, fitted to the documents.

A topic's word distribution is the softmax over the vocabulary of the products of its vector with the words' vectors; a document is a
mixture of topics. Word vectors stay; topic vectors start at the keyword classes' blends and are moved by expectation-maximisation: in each
round the tasks infer every document's mixture and share its words out to the topics, one aggregate of topics x dimensions adds up the
vectors of the words that each topic got, and the driver, which holds only topics and vocabulary (at most ``max_features`` terms),
moves each topic's vector by damped Newton steps to where those words are likeliest. ``guide`` pulls the vectors towards where they started.

The bound is the penalised log-likelihood of all documents. A round is kept only if it raises the bound; the fit ends at the
first that doesn't, or that raises it by less than ``tolerance`` of itself.

Defined results: a document without a vocabulary word has the uniform mixture; repeated documents count each time; an empty table leaves
the topics where they are."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.operators.neighbours import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS, INNER = 20, 30
#: Pseudo-count of every topic in a document's mixture.
SMOOTH = 0.05
#: Documents are inferred side by side, so many words at once.
CELLS = 8192


@dataclass
class GuidedModel:
    terms: list[str]
    words: np.ndarray  # terms x dimensions
    topics: np.ndarray  # topics x dimensions
    bounds: list[float]

    def beta(self) -> np.ndarray:
        return softmax_rows(self.topics @ self.words.T)


def softmax_rows(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _blocks(docs: list[tuple[np.ndarray, np.ndarray]], cells: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which, at, n): documents of about the same length side by side, filled up with a count of 0; at most ``cells`` places, one document at least."""
    size = np.array([len(at) for at, _ in docs], dtype=np.int64)
    order = np.argsort(size, kind="stable")
    first = 0
    while first < len(order):
        last = first + 1
        while last < len(order) and (last + 1 - first) * max(1, size[order[last]]) <= cells:
            last += 1
        which = order[first:last]
        at, n = np.zeros((len(which), max(1, size[which[-1]])), dtype=np.int64), np.zeros((len(which), max(1, size[which[-1]])))
        for row, d in enumerate(which):
            at[row, :size[d]], n[row, :size[d]] = docs[d]
        yield which, at, n
        first = last


def mixtures(mine: np.ndarray, n: np.ndarray, inner: int = INNER, smooth: float = SMOOTH) -> np.ndarray:
    """Documents' mixtures from the rows of beta for their words (documents x words x topics) and the words' counts: fixed-point steps
    from the uniform one."""
    theta = np.full((len(mine), mine.shape[2]), 1.0 / mine.shape[2])
    for _ in range(inner):
        p = (mine @ theta[:, :, None])[:, :, 0]
        got = theta * ((n / p)[:, None, :] @ mine)[:, 0, :] + smooth
        theta = got / got.sum(axis=1, keepdims=True)
    return theta


def _rows_of_beta(beta_t: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    mine = beta_t[at]
    mine[n == 0] = 1.0  # what fills up has a probability, and no count
    return mine


def bags(vbow: DataFrame, terms: list[str], doc: str = "doc_id") -> DataFrame:
    """(doc, at, n): each document's vocabulary words by number, and their counts."""
    number = vbow.sparkSession.createDataFrame(list(enumerate(terms)), "at int, term string")
    rows = vbow.join(F.broadcast(number), "term").groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("at", F.col("n").cast("double").alias("n")))).alias("w"))
    return rows.select(doc, F.col("w.at").alias("at"), F.col("w.n").alias("n"))


def numbers(column: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a column of token lists: each token's row and its number in ``terms`` (-1: none), in order."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), size), pc.fill_null(pc.index_in(column.flatten(), value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def token_counts(toks: DataFrame) -> DataFrame:
    """(term, df, tf) of one column of token lists: in how many rows a term stands, and how often, for each batch of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(0)
            words = column.flatten()
            if not len(words):
                continue
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            words = words.dictionary_encode()
            known = words.indices.is_valid().to_numpy(zero_copy_only=False)
            code = pc.fill_null(words.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)[known]
            row, v = np.repeat(np.arange(len(size)), size)[known], len(words.dictionary)
            order = np.argsort(code.astype(np.int32), kind="stable")  # rows stay in order
            new = np.append(True, (np.diff(code[order]) != 0) | (np.diff(row[order]) != 0))[:len(code)]
            df, tf = np.bincount(code[order][new], minlength=v), np.bincount(code, minlength=v)
            yield pa.RecordBatch.from_arrays([words.dictionary, pa.array(df), pa.array(tf)], ["term", "df", "tf"])

    return toks.mapInArrow(run, "term string, df long, tf long")


def token_bags(toks: DataFrame, terms: list[str], doc: str = "doc_id") -> DataFrame:
    """``bags`` from one row a document with its ``tokens``: counted inside the row, nothing is shuffled."""
    shared, v = toks.sparkSession.sparkContext.broadcast(terms), max(1, len(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.string())
        for b in batches:
            row, at = numbers(b.column(1), wanted)
            key, n = np.unique(row[at >= 0] * v + at[at >= 0], return_counts=True)
            which, first = np.unique(key // v, return_index=True)
            cuts = pa.array(np.append(first, len(key)), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(which)), pa.ListArray.from_arrays(cuts, pa.array((key % v).astype(np.int32))),
                                              pa.ListArray.from_arrays(cuts, pa.array(n.astype(float)))], [doc, "at", "n"])

    return toks.select(doc, "tokens").mapInArrow(run, f"`{doc}` {dict(toks.dtypes)[doc]}, at array<int>, n array<double>")


def word_means(rows: DataFrame, docs: DataFrame, size: int, doc: str = "doc_id", vec: str = "embedding") -> DataFrame:
    """(at, w): the mean vector of the documents that hold a word, for each of the ``size`` words of ``rows`` (doc, at, n).

    Vectors meet a document's whole bag, and a task adds up its documents' vectors by word in one matrix product, so a row is sent for
    each document and for each word and task, none for each (document, word). Null vectors are skipped."""
    met = rows.join(docs.select(doc, F.col(vec).cast("array<double>").alias("_vec")).where("_vec is not null"), doc).select("at", "_vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = None, np.zeros(size)
        for b in batches:
            if not b.num_rows:
                continue
            vecs = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            total = np.zeros((size, vecs.shape[1])) if total is None else total
            at = b.column(0).flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), b.column(0).value_lengths().to_numpy())
            count += np.bincount(at, minlength=size)
            finite = np.isfinite(vecs).all(axis=1)
            odd = ~finite[row]
            if odd.any():  # only their own words
                np.add.at(total, at[odd], vecs[row[odd]])
            step = max(1, 4_000_000 // size)
            for s in range(0, b.num_rows, step):
                mine = np.flatnonzero(finite[s:s + step])
                holds = np.zeros((min(step, b.num_rows - s), size))
                x, y = np.searchsorted(row, [s, s + step])
                np.add.at(holds, (row[x:y] - s, at[x:y]), 1.0)
                total += holds[mine].T @ vecs[s:s + step][mine]
        if total is not None:
            words, dim = np.flatnonzero(count), total.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int32)), pa.array(count[words]),
                                              pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * dim, pa.int32()), pa.array(total[words].reshape(-1)))], ["at", "c", "s"])

    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    sums = met.mapInArrow(run, "at int, c double, s array<double>").groupBy("at").agg(Summarizer.sum(array_to_vector("s")).alias("s"), F.sum("c").alias("c"))
    return sums.select("at", F.transform(vector_to_array("s"), lambda x: x / F.col("c")).alias("w"))


def _documents(b: pa.RecordBatch, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at, n = b.column(first), b.column(first + 1)
    cuts = at.offsets.to_numpy() - at.offsets[0].as_py()
    at, n = at.flatten().to_numpy(), n.flatten().to_numpy()
    for x, y in zip(cuts, cuts[1:]):
        yield at[x:y], n[x:y]


def expectations(rows: DataFrame, words: np.ndarray, topics: np.ndarray, inner: int = INNER) -> tuple[float, np.ndarray, np.ndarray]:
    """(log-likelihood, words' vectors summed by topic, words by topic) of all documents, given the topics."""
    k, dim = topics.shape
    shared = rows.sparkSession.sparkContext.broadcast((softmax_rows(topics @ words.T), words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta, vec = shared.value
        beta_t = np.ascontiguousarray(beta.T)
        total, loglik = np.zeros((k, dim + 1)), 0.0
        for b in batches:
            for _, at, n in _blocks(list(_documents(b, 0))):
                mine = _rows_of_beta(beta_t, at, n)
                theta = mixtures(mine, n, inner)
                p = (mine @ theta[:, :, None])[:, :, 0]
                got = (mine * theta[:, None, :] * (n / p)[:, :, None]).reshape(-1, k).T
                total[:, :dim] += got @ vec[at.reshape(-1)]
                total[:, dim] += got.sum(axis=1)
                loglik += float((n * np.log(p)).sum()) + SMOOTH * float(np.log(theta).sum())
        topic, place = np.divmod(np.arange(k * (dim + 1)), dim + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(topic, -1), pa.int32()), pa.array(np.append(place, 0), pa.int32()),
                                          pa.array(np.append(total.reshape(-1), loglik))], ["topic", "place", "value"])

    out = np.zeros((k, dim + 1))
    loglik = 0.0
    for r in rows.select("at", "n").mapInArrow(run, "topic int, place int, value double").groupBy("topic", "place").agg(F.sum("value").alias("value")).collect():
        if r.topic < 0:
            loglik = r.value
        else:
            out[r.topic, r.place] = r.value
    return loglik, out[:, :dim], out[:, dim]


def move(topic: np.ndarray, words: np.ndarray, got: np.ndarray, count: float, start: np.ndarray, guide: float, steps: int = 8) -> np.ndarray:
    """A topic's vector where the words it got are likeliest: got . a - count log sum exp(words a) - guide / 2 |a - start|^2 is concave."""
    def value(a):
        z = words @ a
        top = z.max()
        return got @ a - count * (top + np.log(np.exp(z - top).sum())) - guide / 2 * ((a - start) ** 2).sum()

    now = value(topic)
    for _ in range(steps):
        b = softmax_rows((words @ topic)[None, :])[0]
        mean = b @ words
        slope = got - count * mean - guide * (topic - start)
        curve = count * ((words * b[:, None]).T @ words - np.outer(mean, mean)) + (guide + 1e-9) * np.eye(len(topic))
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and value(topic + size * step) < now:
            size /= 2
        if size <= 1e-6:
            break
        topic = topic + size * step
        gain, now = value(topic) - now, value(topic)
        if gain < 1e-9 * abs(now):
            break
    return topic


def fit_guided(rows: DataFrame, terms: list[str], words: np.ndarray, topics: np.ndarray, rounds: int = ROUNDS, inner: int = INNER, guide: float = 1.0,
               tolerance: float = 1e-5) -> GuidedModel:
    """Fit topic vectors to ``rows`` (at, n). ``words`` are the terms' vectors, ``topics`` where the topics start."""
    start, now = topics.copy(), topics.copy()
    bound = lambda loglik, a: loglik - guide / 2 * ((a - start) ** 2).sum()
    loglik, got, count = expectations(rows, words, now, inner)
    bounds = [bound(loglik, now)]
    for _ in range(rounds):
        new = np.stack([move(a, words, g, c, s, guide) for a, g, c, s in zip(now, got, count, start)])
        loglik, got_new, count_new = expectations(rows, words, new, inner)
        b = bound(loglik, new)
        if not b > bounds[-1]:
            break
        now, got, count = new, got_new, count_new
        bounds.append(b)
        if b - bounds[-2] < tolerance * abs(b):
            break
    return GuidedModel(terms, words, now, bounds)


def thetas(rows: DataFrame, docs: DataFrame, model: GuidedModel, doc: str = "doc_id", inner: int = INNER) -> DataFrame:
    """(doc, theta map<topic_id, double>) of every document; topic ids from 1."""
    shared = rows.sparkSession.sparkContext.broadcast(model.beta())
    k = len(model.topics)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta_t = np.ascontiguousarray(shared.value.T)
        for b in batches:
            got = np.zeros((b.num_rows, k))
            for which, at, n in _blocks(list(_documents(b, 1))):
                got[which] = mixtures(_rows_of_beta(beta_t, at, n), n, inner)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * k, pa.int32()), pa.array(got.reshape(-1)))], [doc, "theta"])

    kind = dict(rows.dtypes)[doc]
    found = rows.select(doc, "at", "n").mapInArrow(run, f"`{doc}` {kind}, theta array<double>")
    uniform = F.array(*[F.lit(1.0 / k)] * k)
    theta = F.coalesce("theta", uniform)
    return docs.select(doc).join(found, doc, "left").select(doc, F.map_from_arrays(F.array(*[F.lit(i + 1) for i in range(k)]), theta).alias("theta"))


def beta_table(spark, model: GuidedModel) -> DataFrame:
    """(term, beta map<topic_id, double>): at most max_features rows."""
    beta = model.beta()
    return spark.createDataFrame([(t, {i + 1: float(x) for i, x in enumerate(beta[:, j])}) for j, t in enumerate(model.terms)], "term string, beta map<int,double>")


def guided_fit(docs: DataFrame, vbow: DataFrame, start: DataFrame, doc: str = "doc_id", vec: str = "embedding", learn=None, **how) -> tuple[GuidedModel, DataFrame, DataFrame]:
    """(model, beta, theta) with topics that start at ``start`` (topic_id 1, 2 ..., vector), fitted to the documents for which ``learn``
    holds (all by default). A word's vector is the mean of the vectors of the documents that hold it; vectors are scaled to length 1."""
    words_met = sorted(r.term for r in vbow.select("term").distinct().collect())  # the vocabulary
    rows = written(bags(vbow, words_met, doc), "bags")
    found = word_means(rows, docs, len(words_met), doc, vec).orderBy("at").collect()
    unit = lambda m: m / np.maximum(np.sqrt((m * m).sum(axis=1, keepdims=True)), 1e-12)
    terms, words = [words_met[r.at] for r in found], unit(np.array([r.w for r in found], dtype=float))
    if len(terms) < len(words_met):  # words of documents without a vector
        rows = written(bags(vbow, terms, doc), "bags")
    topics = unit(np.array([r.vector for r in start.orderBy("topic_id").collect()], dtype=float))
    fit_on = rows if learn is None else rows.join(docs.where(learn).select(doc), doc, "left_semi")
    model = fit_guided(written(fit_on, "bags") if learn is not None else rows, terms, words, topics, **how)
    return model, beta_table(docs.sparkSession, model), thetas(rows, docs, model, doc)
