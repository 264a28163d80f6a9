"""Deleted-interpolation bigram model over all training documents, and scores of all documents.

Tokens are a text's words (A-Z in lower case) and one end. The counts of all tokens of all training
documents are exact (tokens are told apart by 64-bit XXH64 hashes). Every token of the training documents is a class of
its own, whatever the corpus' size; unseen tokens are the class "rest". A caller may give ``head``: then the ``head`` most frequent tokens
at most (ties at the border are left out together) are classes, and every other token belongs to "rest". The model is

    P(w | h) = (l2[b] c(H, W) / c(H) + l1[b] c(W) / N + l0[b] / n_classes) * P(w | W)

H and W are the classes of the previous and the present token (H of the first one is "start"), b is the
bucket of the context frequency c(H) (its logarithm to base 2, rounded down), P(w | W) is 1 for a class
of one token and, for "rest", (c(w) + 1/2) / (C + (V_rest + 1)/2): the exact corpus count of w over those
of the tokens in that class, with one more for all unseen ones. The three weights l sum to 1 in every
bucket; they are learned by expectation-maximisation: n-gram counts come from ``retained`` training
documents, the events to predict are the bigrams of the other training documents (held-out counts).
For that step alone the maximum-likelihood estimates are rounded to 1/8 of a power of two, so that all events
fit a histogram of bounded size. Scores use unrounded estimates from all training documents.

How it runs: token counts are combined in each task and summed by one shuffle. Bigrams travel as packed
32-bit keys: a pair of classes is mixed to a pseudo-random whole number, its leading bits name the
bucket, the rest is the key. A bucket meets the occurrences of its share of the bigrams, each at most
once a document, and takes their counts; a document's score is the sum of what the buckets return. Only the
``named`` most frequent tokens have short numbers, which are broadcast. Bigrams with any other token travel as hashes to
buckets by their rarer token (the word, if neither is named), where they meet the counts of the tokens that are met there.
``named`` changes the way, never the results. With a ``head`` the terms of "rest" come from a join with the token counts. The model
so grows with the corpus and is never held in one place.

Defined results: a very long text is handled whole, like any other (a task holds one batch of texts); a null text is empty (one token, the end); each row is scored, also where ids repeat
or are null; an empty table gives no scores. Columns other than id and text are not read."""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage, written
from murmur.llm.groups import gathered, map_sorted_groups, stream_groups

END = b"\n"  # never a word
HEAD = sys.maxsize  # no bound: all tokens are classes
NAMED = 250_000  # tokens that travel by number
WIDE = 1 << 24  # buckets from here on hold pairs of hashes
KEY_BITS = 36  # two classes of 18 bits
_CLASS_BITS = 18
_HASHED = np.uint64(1 << _CLASS_BITS)  # numbers are below, hashes from here on
_MASK = (1 << KEY_BITS) - 1
#: Odd factors of the mixing, and their inverses modulo 2 to the 36th.
_MIX = (0x9E3779B97 | 1, 0xC2B2AE3D2 | 1)
_UNMIX = tuple(pow(x, -1, 1 << KEY_BITS) for x in _MIX)
STEPS = 8  # of a power of two, for the histogram of the estimates


def mix(key: np.ndarray) -> np.ndarray:
    """A one-to-one map of the whole numbers below 2 to the 36th onto themselves."""
    m = np.uint64(_MASK)
    key = (key * np.uint64(_MIX[0])) & m
    key ^= key >> np.uint64(18)
    return (key * np.uint64(_MIX[1])) & m


def unmix(key: np.ndarray) -> np.ndarray:
    m = np.uint64(_MASK)
    key = (key * np.uint64(_UNMIX[1])) & m
    key ^= key >> np.uint64(18)
    return (key * np.uint64(_UNMIX[0])) & m


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only, as bytes), then the end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def hash64(token: bytes) -> int:
    """XXH64 as a signed whole number."""
    h = xxhash.xxh64_intdigest(token)
    return h - (1 << 64) if h >> 63 else h


END_HASH = hash64(END)


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, n, kept): counts over training documents, and over the retained ones among them, by token hash.
    ``rows``: text and group (0 not training, 1 training, 2 training and retained)."""

    def out(train: Counter, kept: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([hash64(w) for w in train], pa.int64()), pa.array(list(train.values()), pa.int64()),
                                           pa.array([kept[w] for w in train], pa.int64())], ["token", "n", "kept"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, kept = Counter(), Counter()
        for b in batches:
            for text, group in zip(b.column(0), b.column(1).to_pylist()):
                words = tokens(text.as_py())
                train.update(words)
                if group == 2:
                    kept.update(words)
                if len(train) > 400_000:
                    yield out(train, kept)
                    train, kept = Counter(), Counter()
        yield out(train, kept)

    return (rows.where("group > 0").select("text", "group").mapInArrow(run, "token long, n long, kept long")
            .groupBy("token").agg(F.sum("n").alias("n"), F.sum("kept").alias("kept")))


class Classes:
    """The head tokens and all that a task has to know of them. Classes: 0 rest, 1 end, then the head; start is one more,
    only ever a context."""

    def __init__(self, head: list[tuple[int, int, int]], totals: dict, docs: int, kept_docs: int, whole: bool):
        head = sorted((x for x in head if x[0] != END_HASH), key=lambda x: (-x[1], x[0]))
        self.of = {x[0]: i + 2 for i, x in enumerate(head)}
        self.of[END_HASH] = 1
        self.n = len(head) + 2
        self.start = self.n
        c = [docs, *(x[1] for x in head)]
        k = [kept_docs, *(x[2] for x in head)]
        self.total, self.kept_total = totals["n"], totals["kept"]
        self.rest, self.rest_kinds = self.total - sum(c), totals["kinds"] - sum(x > 0 for x in c)
        self.kinds = totals["kinds"]
        #: Are the tokens that aren't here classes too? They never count as rest then.
        self.whole = whole
        self.classes = self.kinds + (1 if docs else 2) if whole else self.n
        self.count = np.array([self.rest, *c, docs], dtype=np.int64)  # as word and as context alike, but for start and end
        self.kept = np.array([self.kept_total - sum(k), *k, kept_docs], dtype=np.int64)
        self.base = np.log10((self.count + 0.5) / (self.total + 0.5 * (self.kinds + 1)))

    @classmethod
    def load(cls, state: dict) -> Classes:
        """Of what was broadcast: plain values, which need no copy of this package."""
        out = object.__new__(cls)
        out.__dict__.update(state)
        return out

    def context(self, kept: bool = False) -> np.ndarray:
        """How often each class is a context: an end is none."""
        c = (self.kept if kept else self.count).astype(np.float64)
        c[1] = 0
        return c

    def word(self, kept: bool = False) -> np.ndarray:
        """How often each class is a word: start is none."""
        c = (self.kept if kept else self.count).astype(np.float64)
        c[self.start] = 0
        return c


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Bucket of a context frequency; 0 for a context never seen."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


FOUND = ("bucket int, base long, groups array<int>, sizes binary, keys binary, times binary, "
         "docs array<struct<rid: bigint, doc_id: bigint, n_tokens: bigint, n_known: bigint, base: double, rare: binary, rare_times: binary>>")


def occurrences(rows: DataFrame, classes, bits: int, wide_bits: int) -> DataFrame:
    """Three kinds of rows, by ``bucket``. From WIDE on: as from 0 on, for pairs with a token without a number, each occurrence by itself: ``keys``
    are the contexts, then the words, numbers or hashes. From 0 on: the bigram occurrences of a part of an Arrow batch in that bucket. A part's
    documents are numbered from ``base`` on, those of group 0 first, then 1, then 2; ``groups`` says how many there are, ``sizes`` how many
    keys each has there, ``times`` how often each key occurs. Below 0, spread over as many numbers: what the head alone tells
    of the documents, and the hashes and counts of their rare tokens."""
    docs_kind = pa.list_(pa.struct([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                                    ("base", pa.float64()), ("rare", pa.binary()), ("rare_times", pa.binary())]))
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), docs_kind]
    names = ["bucket", "base", "groups", "sizes", "keys", "times", "docs"]
    low = KEY_BITS - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classes.load(classes.value)
        known: dict[bytes, int] = {}
        rid = TaskContext.get().partitionId() << 40  # the same whenever the task is run again
        for b in batches:
            ends = np.cumsum(b.column(2).to_numpy())
            cuts = [0, *(np.flatnonzero(np.diff(ends // 4_000_000)) + 1).tolist(), b.num_rows]
            for x, y in zip(cuts, cuts[1:]):
                if y > x:
                    yield part(b.slice(x, y - x), c, known, rid)
                    rid += y - x

    def part(b: pa.RecordBatch, c: Classes, known: dict, rid: int) -> pa.RecordBatch:
        group = b.column(1).to_numpy()
        by_group = np.argsort(group, kind="stable")
        groups = np.bincount(group, minlength=3).tolist()
        ids_of, texts = b.column(0).to_pylist(), b.column(3)
        keys, which, times, docs, wide, wide_doc = [], [], [], [], [], []
        for i, at in enumerate(by_group.tolist()):
            words = tokens(texts[at].as_py())
            if len(known) > 300_000:
                known.clear()
            for w in set(words).difference(known):
                known[w] = c.of.get(h := hash64(w), h & (1 << 64) - 1 if c.whole else 0)
            ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            before = np.concatenate((np.array([c.start], dtype=np.uint64), ids[:-1]))
            if c.whole:
                far = (ids >= _HASHED) | (before >= _HASHED)
                if far.any():
                    wide.append((before[far], ids[far]))
                    wide_doc.append(np.full(len(wide[-1][0]), i, dtype=np.int32))
                ids, before = ids[ids < _HASHED], before[~far] << np.uint64(_CLASS_BITS) | ids[~far]
            else:
                before = before << np.uint64(_CLASS_BITS) | ids
            rare = Counter([w for w in words if not known[w]])
            docs.append({"rid": rid + i, "doc_id": ids_of[at], "n_tokens": len(words),
                         "n_known": int(((ids > 1) | ((ids == 1) & (c.count[1] > 0))).sum()), "base": float(c.base[ids[ids > 0].astype(np.int64)].sum()),
                         "rare": np.array([hash64(w) for w in rare], dtype="<i8").tobytes(),
                         "rare_times": np.array(list(rare.values()), dtype="<u4").tobytes()})
            k, n = np.unique(before, return_counts=True)
            keys.append(k)
            times.append(n)
            which.append(np.full(len(k), i, dtype=np.int32))
        key, doc, n = mix(np.concatenate(keys)), np.concatenate(which), np.concatenate(times).astype("<u4")
        bucket = (key >> np.uint64(low)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, doc, n = bucket[order], doc[order], n[order]
        key = (key[order] & np.uint64((1 << low) - 1)).astype("<u4")
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else []
        out = []
        for x, y in zip(cuts, cuts[1:]):
            sizes = np.bincount(doc[x:y], minlength=len(docs)).astype("<u4")
            # the bytes of a number apart: the upper ones are nearly all 0 and take no room when compressed
            out.append((int(bucket[x]), rid, groups, _planes(sizes), key[x:y].tobytes(), _planes(n[x:y]), None))
        if wide:
            h, w, doc = np.concatenate([x for x, _ in wide]), np.concatenate([x for _, x in wide]), np.concatenate(wide_doc)
            bucket = (np.where(w >= _HASHED, w, h) >> np.uint64(64 - wide_bits)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, h, w, doc = bucket[order], h[order], w[order], doc[order]
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for x, y in zip(cuts, cuts[1:]):
                sizes = np.bincount(doc[x:y], minlength=len(docs)).astype("<u4")
                out.append((WIDE + int(bucket[x]), rid, groups, _planes(sizes), _pack_pairs(h[x:y], w[x:y]), None, None))
        for i in range(0, len(docs), 64):
            out.append((-1 - ((rid + i) * 0x9E3779B97F4A7C15 >> 40 & 0xFFFF), None, None, None, None, None, docs[i:i + 64]))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)

    return rows.select("doc_id", "group", F.length("text").alias("size"), "text").mapInArrow(run, FOUND)


def _small(x: bytes) -> bytes:
    return len(x).to_bytes(4, "little") + pa.compress(x, codec="zstd", asbytes=True)


def _large(x: bytes) -> bytes:
    return pa.decompress(x[4:], int.from_bytes(x[:4], "little"), codec="zstd", asbytes=True)


def _planes(x: np.ndarray) -> bytes:
    """Checkpoints are not compressed by Spark."""
    return _small(x.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unplanes(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_large(x), dtype=np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _pack_pairs(h: np.ndarray, w: np.ndarray) -> bytes:
    """Which are hashes, then the numbers, then the hashes."""
    a, b = h >= _HASHED, w >= _HASHED
    numbers, hashes = np.concatenate((h[~a], w[~b])).astype("<u4"), np.concatenate((h[a], w[b])).astype("<u8")
    return _small(b"".join((len(h).to_bytes(4, "little"), (a | b.view(np.uint8) << 1).astype(np.uint8).tobytes(),
                            numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), hashes.tobytes())))


def _unpack_pairs(x: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = _large(x)
    n = int.from_bytes(x[:4], "little")
    kind = np.frombuffer(x, np.uint8, n, 4)
    a, b = (kind & 1) > 0, (kind & 2) > 0
    k, m = 2 * n - int(a.sum()) - int(b.sum()), n - int(a.sum())
    numbers = np.ascontiguousarray(np.frombuffer(x, np.uint8, 4 * k, 4 + n).reshape(4, k).T).view("<u4").reshape(-1)
    hashes = np.frombuffer(x, "<u8", -1, 4 + n + 4 * k) if 2 * n > k else np.zeros(0, dtype=np.uint64)
    h, w = np.empty(n, dtype=np.uint64), np.empty(n, dtype=np.uint64)
    h[~a], w[~b], h[a], w[b] = numbers[:m], numbers[m:], hashes[:n - m], hashes[n - m:]
    return h, w


def _open(t: pa.Table, bits: int):
    """A bucket's occurrences: document (numbered over all parts at hand) and its group, class pair, times; the pairs' classes; the parts' first
    row numbers and sizes."""
    low = KEY_BITS - bits
    key = np.frombuffer(b"".join(t.column("keys").to_pylist()), dtype="<u4")
    sizes = [_unplanes(x) for x in t.column("sizes").to_pylist()]
    group = np.concatenate([np.repeat(np.arange(3, dtype=np.int8), g) for g in t.column("groups").to_pylist()])
    doc = np.repeat(np.arange(len(group), dtype=np.int32), np.concatenate(sizes))
    pairs, at = np.unique(key, return_inverse=True)
    full = unmix((np.uint64(int(t.column("bucket")[0].as_py())) << np.uint64(low)) | pairs.astype(np.uint64))
    h, w = (full >> np.uint64(_CLASS_BITS)).astype(np.int64), (full & np.uint64((1 << _CLASS_BITS) - 1)).astype(np.int64)
    times = np.concatenate([_unplanes(x) for x in t.column("times").to_pylist()])
    return doc, group, at.reshape(-1).astype(np.int32), times, h, w, t.column("base").to_pylist(), [len(x) for x in sizes]


def _open_wide(t: pa.Table, known: pa.Table, c: Classes):
    """As ``_open``, for a bucket of pairs of hashes and the counts of its tokens: document, its group, pair; counts of the pairs' contexts and words, in
    training and retained documents; is the word a hash, the parts' first row numbers and sizes."""
    sizes = [_unplanes(x) for x in t.column("sizes").to_pylist()]
    group = np.concatenate([np.repeat(np.arange(3, dtype=np.int8), g) for g in t.column("groups").to_pylist()])
    doc = np.repeat(np.arange(len(group), dtype=np.int32), np.concatenate(sizes))
    halves = [_unpack_pairs(x) for x in t.column("keys").to_pylist()]
    h, w = (np.concatenate([x[i] for x in halves]) for i in (0, 1))
    order = np.lexsort((w, h))
    h, w = h[order], w[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])))
    at = np.empty(len(order), dtype=np.int32)
    at[order] = np.cumsum(new) - 1
    h, w = h[new], w[new]
    token, n, kept = (np.frombuffer(b"".join(map(_large, known.column(x).to_pylist())), dtype="<u8") for x in ("token", "n", "kept"))
    token, first = np.unique(token, return_index=True)
    n, kept = (np.append(x[first].astype(np.float64), 0.0) for x in (n, kept))

    def look(code: np.ndarray, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        where = np.searchsorted(token, code)
        where[(where == len(token)) | (np.append(token, np.uint64(0))[where] != code)] = len(token)  # unseen
        return np.where(code < _HASHED, own[np.minimum(code, _HASHED - np.uint64(1)).astype(np.int64) % len(own)], counts[where])

    return (doc, group, at, look(h, c.context(), n), look(w, c.word(), n), look(h, c.context(True), kept), look(w, c.word(True), kept), w >= _HASHED,
            t.column("base").to_pylist(), [len(x) for x in sizes])


def _level(p: np.ndarray) -> np.ndarray:
    """An estimate as a whole number of steps below 1; -1 where it is 0."""
    return np.where(p > 0, np.rint(-STEPS * np.log2(np.maximum(p, 1e-300))), -1).astype(np.int64)


def estimate(hist: list[tuple[int, int, int, float]], n_classes: int, rounds: int = 60) -> np.ndarray:
    """Weights (bucket, 3) of bigram, unigram and uniform by expectation-maximisation from counts of events by
    (bucket, level of the bigram estimate, level of the unigram estimate). Buckets without events take the weights learned from all
    events; a context never seen has no bigram weight."""
    x = np.array(hist, dtype=np.float64).reshape(-1, 4)
    back = lambda v: np.where(v < 0, 0.0, 2.0 ** (-v / STEPS))
    terms = np.stack([back(x[:, 1]), back(x[:, 2]), np.full(len(x), 1.0 / n_classes)], axis=1)

    def learn(rows: np.ndarray) -> np.ndarray:
        w, t, n = np.array([0.4, 0.4, 0.2]), terms[rows], x[rows, 3:4]
        for _ in range(rounds):
            share = t * w
            share /= share.sum(1, keepdims=True)
            w = (share * n).sum(0) + 1e-6  # never quite 0: every token keeps a probability
            w /= w.sum()
        return w

    out = np.tile(learn(np.arange(len(x))) if len(x) else np.array([0.4, 0.4, 0.2]), (66, 1))
    for b in range(1, 66):
        if len(rows := np.flatnonzero(x[:, 0] == b)) and x[rows, 3].sum() >= 100:
            out[b] = learn(rows)
    out[0] = out[0] * [0, 1, 1] + [0, 0, 1e-6]
    out[0] /= out[0].sum()
    return out


def lm_scores(docs: DataFrame, train: Column, retained: Column, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD,
              bucket_keys: int = 2_000_000, named: int = NAMED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score. ``train`` and ``retained`` are conditions on
    ``docs``: which documents are learned from, and which of them give the counts for the weights."""
    whole = head == HEAD
    named = named if whole else head
    if not 0 <= named <= (1 << _CLASS_BITS) - 4:
        raise ValueError("head tokens have to fit into 18 bits")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.when(~train, 0).when(retained, 2).otherwise(1).cast("int").alias("group"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if(F.col("group") > 0).alias("train"), F.count_if(F.col("group") == 2).alias("kept")).first()
    counts = written(token_counts(rows), "token-counts")
    totals = counts.agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"), F.count_if(F.col("n") > 0).alias("kinds")).first()
    cut, held = 1, 0
    # different counts are few: at most the square root of twice the number of tokens
    for n, k in counts.where("n > 0").groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        if held + k > named:
            cut = n + 1
            break
        held += k
    cl = Classes([tuple(x) for x in counts.where(F.col("n") >= cut).collect()], {k: totals[k] or 0 for k in ("n", "kept", "kinds")},
                 size["train"], size["kept"], whole)
    classes = docs.sparkSession.sparkContext.broadcast(cl.__dict__)
    bits = min(24, max(6, round(math.log2(max(1, (size["bytes"] or 0) / 6.5 / bucket_keys)))))
    wide_bits = max(4, bits - 2)
    # each bucket in one partition, its rows together; the checkpoint keeps partitions and order
    found = cut_lineage(gathered(occurrences(rows, classes, bits, wide_bits), ["bucket"]))

    def learn(t: pa.Table) -> Iterator[pa.RecordBatch]:
        c = Classes.load(classes.value)
        doc, group, at, times, h, w, _, _ = _open(t, bits)
        kept = np.bincount(at, times * (group[doc] == 2), len(h))
        event = np.bincount(at, times * (group[doc] == 1), len(h))
        ctx, word = c.context(True), c.word(True)
        use = event > 0
        h, w, kept, event = h[use], w[use], kept[use], event[use]
        yield from events(kept, ctx[h], word[w], event, c)

    def events(kept: np.ndarray, ctx: np.ndarray, word: np.ndarray, event: np.ndarray, c: Classes) -> Iterator[pa.RecordBatch]:
        p2 = _level(kept / np.maximum(ctx, 1)) + 1
        p1 = _level(word / max(1, c.kept_total)) + 1
        code, where = np.unique((bucket_of(ctx) * 4096 + p2) * 4096 + p1, return_inverse=True)
        if len(code):
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (code // 4096 ** 2, code // 4096 % 4096 - 1, code % 4096 - 1)),
                                              pa.array(np.bincount(where.reshape(-1), event, len(code)), pa.float64())], ["b", "p2", "p1", "n"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, keys in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h, w = _unpack_pairs(keys)
                h = np.unique(h[(h >= _HASHED) & (w >= _HASHED)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), bucket, dtype=np.int32)), pa.array(h)], ["bucket", "token"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, *cols = (x.to_numpy() for x in b.columns)
            order = np.argsort(bucket, kind="stable")
            cuts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)] if len(order) else []
            rows = [(int(bucket[order[x]]), *(_small(c[order[x:y]].astype("<i8").tobytes()) for c in cols)) for x, y in zip(cuts, cuts[1:])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))], ["bucket", "token", "n", "kept"])

    def learn_wide(t: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if t.num_rows:
            c = Classes.load(classes.value)
            doc, group, at, _, _, ctx, word, _, _, _ = _open_wide(t, known, c)
            kept, event = (np.bincount(at, group[doc] == g, len(ctx)) for g in (2, 1))
            use = event > 0
            out = list(events(kept[use], ctx[use], word[use], event[use], c))
        return pa.Table.from_batches(out, pa.schema([("b", pa.int64()), ("p2", pa.int64()), ("p1", pa.int64()), ("n", pa.float64())]))

    bigrams = found.where(f"bucket >= 0 and bucket < {WIDE}").drop("docs")
    hist = bigrams.mapInArrow(stream_groups(["bucket"], learn), "b long, p2 long, p1 long, n double")
    if whole:
        wide = found.where(f"bucket >= {WIDE}").select("bucket", "base", "groups", "sizes", "keys")
        rarer = counts.where(F.col("n") < cut)
        asks = wide.select("bucket", "keys").mapInArrow(asked, "bucket int, token long").join(rarer, "token")
        own = (F.shiftrightunsigned("token", 64 - wide_bits) + WIDE).cast("int").alias("bucket")
        met = rarer.select(own, "token", "n", "kept").unionAll(asks.select("bucket", "token", "n", "kept"))
        met = cut_lineage(met.mapInArrow(packed, "bucket int, token binary, n binary, kept binary").repartition("bucket"))
        # a bucket's pairs and the counts of its tokens, at one place
        both = wide.groupBy("bucket").cogroup(met.groupBy("bucket"))
        hist = hist.unionAll(both.applyInArrow(learn_wide, "b long, p2 long, p1 long, n double"))
    hist = hist.groupBy("b", "p2", "p1").agg(F.sum("n"))
    # at most 65 buckets by the levels of two estimates, whatever the corpus: some ten thousand rows
    weights = estimate([tuple(x) for x in hist.collect()], cl.classes)

    def score(t: pa.Table) -> Iterator[pa.RecordBatch]:
        c = Classes.load(classes.value)
        doc, group, at, times, h, w, base, sizes = _open(t, bits)
        count = np.bincount(at, times * (group[doc] > 0), len(h))
        ctx, word = c.context(), c.word()
        part = np.bincount(doc, times * logs_of(count, ctx[h], word[w], c)[at], len(group))
        yield from parts_of(base, sizes, [part])

    def logs_of(count: np.ndarray, ctx: np.ndarray, word: np.ndarray, c: Classes) -> np.ndarray:
        lam = weights[bucket_of(ctx)]
        return np.log10(lam[:, 0] * count / np.maximum(ctx, 1) + lam[:, 1] * word / max(1, c.total) + lam[:, 2] / c.classes)

    def parts_of(base: list[int], sizes: list[int], sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cut = np.cumsum([0, *sizes])
        cols = [pa.array([_small(s[x:y].tobytes()) for x, y in zip(cut, cut[1:])], pa.binary()) for s in sums]
        cols += [pa.nulls(len(base), pa.binary())] * (3 - len(sums))
        yield pa.RecordBatch.from_arrays([pa.array(base, pa.int64()), *cols], ["base", "part", "logs", "known"])

    def score_wide(t: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if t.num_rows:
            c = Classes.load(classes.value)
            doc, group, at, ctx, word, _, _, hashed, base, sizes = _open_wide(t, known, c)
            count = np.bincount(at, group[doc] > 0, len(ctx))
            plain = np.where(hashed, np.log10((word + 0.5) / (c.total + 0.5 * (c.kinds + 1))), 0.0)
            sums = [np.bincount(doc, x[at], len(group)) for x in (logs_of(count, ctx, word, c), plain, (hashed & (word > 0)).astype(np.float64))]
            out = list(parts_of(base, sizes, [*sums[:2], sums[2].astype("<u4")]))
        return pa.Table.from_batches(out, pa.schema([("base", pa.int64()), ("part", pa.binary()), ("logs", pa.binary()), ("known", pa.binary())]))

    def add(t: pa.Table) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(_large(x)) for x in t.column("part").to_pylist())
        more = [sum((np.frombuffer(_large(x), k) for x in t.column(name).to_pylist() if x is not None), np.zeros(len(total), k)) for name, k in (("logs", "<f8"), ("known", "<u4"))]
        yield pa.RecordBatch.from_arrays([pa.array(t.column("base")[0].as_py() + np.arange(len(total)), pa.int64()), pa.array(total, pa.float64()),
                                          pa.array(more[0], pa.float64()), pa.array(more[1].astype(np.int64))], ["rid", "bigram", "wide_logs", "wide_known"])

    sums = "base long, part binary, logs binary, known binary"
    scored = bigrams.mapInArrow(stream_groups(["bucket"], score), sums)
    if whole:
        scored = scored.unionAll(both.applyInArrow(score_wide, sums))
    scored = map_sorted_groups(scored, ["base"], add, "rid long, bigram double, wide_logs double, wide_known long")
    info = found.where("bucket < 0").select(F.explode("docs").alias("d")).select("d.*")
    if whole:
        return info.join(scored, "rid").select("doc_id", "n_tokens", (F.col("n_known") + F.col("wide_known")).alias("n_known"),
                                               F.lit(cl.total).cast("long").alias("train_tokens"),
                                               (F.col("base") + F.col("wide_logs")).alias("base_score"), F.col("bigram").alias("score"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, n = b.column(1).to_pylist(), b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(b.column(0).to_numpy(), [len(x) // 8 for x in raw]), pa.int64()),
                pa.array(np.frombuffer(b"".join(raw), dtype="<i8"), pa.int64()),
                pa.array(np.frombuffer(b"".join(n), dtype="<u4").astype(np.int64))], ["rid", "token", "times"])

    rare = info.select("rid", "rare", "rare_times").mapInArrow(spread, "rid long, token long, times long")
    rare = (rare.join(counts.select("token", "n"), "token", "left").select("rid", "times", F.coalesce("n", F.lit(0)).alias("n"))
            .repartition("rid").groupBy("rid").agg(F.sum("times").alias("rares"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("known"),
                                                   F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("logs")))
    total = info.drop("rare", "rare_times").join(scored, "rid").join(rare, "rid", "left")
    logs, rares = F.coalesce("logs", F.lit(0.0)), F.coalesce("rares", F.lit(0))
    of = lambda n, kinds: F.lit(math.log10(n + 0.5 * (kinds + 1)))
    return total.select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                        F.lit(cl.total).cast("long").alias("train_tokens"),
                        (F.col("base") + logs - rares * of(cl.total, cl.kinds)).alias("base_score"),
                        (F.col("bigram") + logs - rares * of(cl.rest, cl.rest_kinds)).alias("score"))
