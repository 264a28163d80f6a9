"""Phrase collocations: contiguous phrases of 2 to ``max_words`` words, found level by level and counted by double-array tries.

Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and pieces into words at spaces and tabs. Everything is
counted within a language. A phrase is a candidate if it occurs at least ``min_count`` times, overlaps included. Cut after its
first k words into parts that occur l and r times, a candidate that occurs a times among n words scores floor(1000 a n / (l r)); its lowest
cut counts, the first among equals. Candidates that lie inside a longer one which occurs at least ``swallow`` hundredths as often
are dropped.

How: words are counted first. Each text is then written as the 64-bit hashes of its frequent words, in order, with 0 for all else.
Level by level, a phrase is looked at only where both phrases of one word less that it holds (its first and its last words) have passed
the level before (Apriori: none of its parts is rarer than it is). It is counted by 64 bits, half of them for its last word and half for what stands
before it; that count is never below the phrase's. Each task adds up and sorts what it holds and sends it on as differences of ordered numbers, in buckets whose
number grows with the words. The phrases whose counts reach ``min_count`` are Apriori-safe: all candidates are among them. Their words are
those of the shorter phrases with that half, found in the level before, and the last words with the other: about one row a phrase, whatever the texts. They are dealt
out to blocks of bounded size and made into one double-array trie a block, inside Spark. Some tries at a time are broadcast; each task steps through all
positions of its texts at once, counts the accepting states reached, and the sums over all tasks are the exact counts from which candidates are
chosen. More phrases mean more rounds over the texts, not larger broadcasts.

What passed a level reaches the next one as a bit array of fixed size (``log_bits``), which may let a few others through; they are
counted like the rest and don't matter for the result. Words are told apart by 64-bit hashes.

Defined results: a null text is empty, a null language ``und``; rows that repeat, with or without ids, count each time; a very long text
is like any other (a task holds one batch of texts); ties in the score go to the more frequent phrase, then to the smaller one in UTF-8; an
empty table gives no rows; columns other than text and lang are not read."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm import bits as B
from murmur.llm.common import written
from murmur.llm.trie import Trie

MIN_COUNT, MAX_WORDS, TOP, SWALLOW = 100, 5, 2000, 100
#: Words that a task counts or remembers before it passes them on; texts and words of a row, hashes that it looks at together.
HELD = 150_000
TEXTS, WORDS, HASHES = 512, 200_000, 750_000
#: Words of the texts that come to one bucket of a level's phrases.
BUCKET = 1_000_000
#: Phrases of a trie, and tries that are broadcast together.
BLOCK, ROUND = 65_536, 4
_BREAK = 0xFF  # no byte of UTF-8
_FOLD = bytes(_BREAK if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_STOP = bytes([_BREAK])
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
#: Odd factor of the mixing of keys, and its inverse modulo 2 to the 64th.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in order, with a break (0xFF) between pieces."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).replace(_STOP, b" \xff ").split()


def _hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))) or 1


def _grow(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one word more."""
    z = h * np.uint64(0x9E3779B97F4A7C15) + x
    z ^= z >> np.uint64(31)
    z *= np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(29))


def _code(h: np.ndarray) -> np.ndarray:
    """32 bits of a hash."""
    return (h ^ (h >> _HALF)) & _LOW


def code_of(column: str) -> Column:
    """The same in Spark."""
    return F.shiftrightunsigned(column, 32).bitwiseXOR(F.col(column)).bitwiseAND(F.lit(0xFFFFFFFF))


def keys_of(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One number for the codes of a phrase's first words and its last one, mixed one-to-one so that all buckets get alike."""
    z = (_code(head) << _HALF | _code(word)) * _MIX
    return (z ^ (z >> _HALF)) * _MIX


def codes_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes that such numbers were made of."""
    z = keys * _UNMIX
    z = (z ^ (z >> _HALF)) * _UNMIX
    return z >> _HALF, z & _LOW


def word_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, word, n) of texts (lang, text), a null word for the sum of all words; summed up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        totals: Counter = Counter()

        def rows():
            for lang, c in counts.items():
                c.pop(_STOP, None)
                totals[lang] += c.total()
                for part in B.chunks(c, 1):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([w for w, _ in part], pa.binary()),
                                                      pa.array([n for _, n in part], pa.int64())], ["lang", "word", "n"])
            counts.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                counts[lang].update(words_of(text.as_py()))
                if sum(map(len, counts.values())) > held:
                    yield from rows()
        yield from rows()
        n = len(totals)
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.nulls(n, pa.binary()),
                                          pa.array(list(totals.values()), pa.int64())], ["lang", "word", "n"])
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def with_hashes(counts: DataFrame) -> DataFrame:
    """(lang, word, h, n): with the hashes of the words, 0 for a null one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, word, n = b.columns
            h = [0 if w is None else _hash(x, w) for x, w in zip(lang.to_pylist(), word.to_pylist())]
            yield pa.RecordBatch.from_arrays([lang, word, pa.array(np.array(h, np.uint64).view(np.int64)), n], ["lang", "word", "h", "n"])

    return counts.mapInArrow(run, "lang string, word binary, h long, n long")


def _packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(x: bytes) -> bytes:
    return pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)


def pack_words(x: np.ndarray) -> bytes:
    """Word hashes (uint64), compressed: frequent words repeat."""
    return _packed(x.tobytes())


def pack_counts(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Ordered numbers (uint64) and their counts, compressed: the bytes of the differences, all first ones, all second ones and so on, then those
    of the counts."""
    steps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return _packed(steps.T.tobytes() + n.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_counts(x: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers and counts that ``pack_counts`` was given."""
    raw = np.frombuffer(_unpacked(x), np.uint8).reshape(12, -1)
    steps, n = (np.ascontiguousarray(part.T) for part in (raw[:8], raw[8:]))
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64), n.view(np.uint32).ravel()


def encoded(docs: DataFrame, frequent: np.ndarray, held: int = HELD) -> DataFrame:
    """(words): the hashes of the texts' frequent words in order, one 0 for what stands between and behind each text; about
    ``WORDS`` of them a row, packed."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        known: dict[str, dict[bytes, int]] = defaultdict(lambda: {_STOP: 0})

        def code(lang: str, text: str | None) -> np.ndarray:
            if sum(map(len, known.values())) > held:
                known.clear()
            words, memo = words_of(text), known[lang]
            for w in set(words).difference(memo):
                h = _hash(lang, w)
                memo[w] = h if B.one_member(bits, h) else 0
            x = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
            x = np.append(x, np.uint64(0))
            keep = x != 0
            keep[1:] |= x[:-1] != 0  # a 0 stays behind a word
            return x[keep]

        def row() -> pa.RecordBatch:
            packed = pack_words(np.concatenate(texts))
            texts.clear()
            return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["words"])

        texts: list[np.ndarray] = []
        size = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                texts.append(code(lang, text.as_py()))
                size += len(texts[-1])
                if size > WORDS or len(texts) >= TEXTS:
                    yield row()
                    size = 0
        if texts:
            yield row()
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "words binary")


def passing(x: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of two words more than there are bit arrays whose parts have passed the levels before: the hashes of all
    words but the last (of the one word, the word's), and the last words. ``sets`` holds the bit arrays of 2, 3 ... words."""
    ok, h = x != 0, x.copy()
    m = 1
    for bits in [*sets, None]:
        m += 1
        at = np.flatnonzero(ok[:-1] & ok[1:])
        at = at[at + m <= len(x)]
        if bits is None:
            return h[at], x[at + m - 1]
        new = _grow(h[at], x[at + m - 1])
        ok = np.zeros(len(x), bool)
        ok[at] = B.members(bits, new)
        h[at] = new


def _flat(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The words of a batch's rows, a row at a time."""
    for x in b.column(0):
        yield np.frombuffer(_unpacked(x.as_py()), np.uint64)


def level(texts: DataFrame, sets: list[np.ndarray], min_count: int = 1, buckets: int = 64, words: bool = False) -> DataFrame:
    """(head, word, n): the next level's phrases that reach ``min_count``, each as the codes of all its words but the last, and of the last one;
    added up in so many ``buckets``. With ``words`` also the whole hashes of all words in the texts, each once, with a null head."""
    shared = texts.sparkSession.sparkContext.broadcast(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        met: list[np.ndarray] = []

        def rows(x: list[np.ndarray], sign: int):
            keys = np.concatenate(x)
            x.clear()
            keys.sort()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
            keys, n = keys[first], np.diff(np.append(first, len(keys)))
            bucket = ((keys >> _HALF) * np.uint64(buckets) >> _HALF).astype(np.int32)  # grows with the keys
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else []
            yield pa.RecordBatch.from_arrays([pa.array(sign * (bucket[cuts[:-1]] + 1)),
                                              pa.array([pack_counts(keys[i:j], n[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary())], ["bucket", "counts"])

        for b in batches:
            for x in _flat(b):
                held.append(keys_of(*passing(x, shared.value)))
                if words:
                    met.append(np.unique(x[x != 0]))
                if sum(map(len, held)) > HASHES:
                    yield from rows(held, 1)
                if sum(map(len, met)) > HASHES:
                    yield from rows(met, -1)
        if held:
            yield from rows(held, 1)
        if met:
            yield from rows(met, -1)
        pa.default_memory_pool().release_unused()

    def add(t: pa.Table) -> pa.Table:
        keys, n = (np.concatenate(c) for c in zip(*(unpack_counts(x) for x in t.column("counts").to_pylist())))
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, n = keys[first], np.add.reduceat(n, first, dtype=np.int64)
        if t.column("bucket")[0].as_py() < 0:
            return pa.table({"head": pa.nulls(len(keys), pa.int64()), "word": keys.view(np.int64), "n": pa.nulls(len(keys), pa.int64())})
        enough = n >= min_count
        head, word = codes_of(keys[enough])
        return pa.table({"head": head.view(np.int64), "word": word.view(np.int64), "n": n[enough]})

    return texts.mapInArrow(run, "bucket int, counts binary").groupBy("bucket").applyInArrow(add, "head long, word long, n long")


def hashed(found: DataFrame) -> DataFrame:
    """(h, ids) of (h, ids, word), the hash and words of a phrase and a word behind it: the hash and words of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = _grow(*(b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h", "word")))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column("ids")], ["h", "ids"])

    return found.select("h", F.concat("ids", F.array("word")).alias("ids"), "word").mapInArrow(run, "h long, ids array<long>")


def safe_phrases(texts: DataFrame, min_count: int, max_words: int, log_bits: int, words: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """(ids): the Apriori-safe phrases of 2 to ``max_words`` words; each level's are added up in so many ``buckets``. ``words`` are the hashes (h) of
    the words in the texts, where they are known; else the first level finds them."""
    sets, tables = [], []
    for _ in range(2, max_words + 1):
        found = written(level(texts, sets, min_count, buckets, words=words is None), "codes")  # so that no task has two Python workers at a time
        if not sets:
            words = found.where("head is null").select(F.col("word").alias("h")) if words is None else words
            last = words.select(code_of("h").alias("word"), F.col("h").alias("last"))
            before = words.select("h", F.array("h").alias("ids"))
        # a phrase's first words are a phrase of the level before, or they are too rare
        found = found.join(before.withColumn("head", code_of("h")), "head").join(last, "word")
        found = written(hashed(found.select("h", "ids", F.col("last").alias("word"))), "level")
        if found.isEmpty():
            break
        sets.append(B.bit_set(found, "h", log_bits))
        tables.append(found)
        before = found
    if not sets:
        return texts.sparkSession.createDataFrame([], "ids array<long>")
    passed = tables[0]
    for t in tables[1:]:
        passed = passed.unionByName(t)
    return passed.select("ids")


def build_tries(blocks: DataFrame) -> DataFrame:
    """One row a block of phrases (block, no, ids) with the packed trie."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        t = Trie.build([np.array(x, np.int64).view(np.uint64) for x in pdf["ids"]])
        return pd.DataFrame([(pdf["block"].iloc[0], *t.pack())], columns=["block", "words", "labels", "base", "check", "accept", "longest"])

    return blocks.groupBy("block").applyInPandas(
        build, "block long, words binary, labels binary, base binary, check binary, accept binary, longest long")


def trie_counts(texts: DataFrame, tries: list) -> DataFrame:
    """(block, no, n) of all phrases of some tries that occur."""
    sc = texts.sparkSession.sparkContext
    shared = sc.broadcast([tuple(t) for t in tries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [(block, Trie.unpack(*packed)) for block, *packed in shared.value]
        sums: list = [0] * len(mine)
        for x in (x for b in batches for x in _flat(b)):
            for i, (_, t) in enumerate(mine):
                sums[i] = sums[i] + t.count(x)
        for (block, _), s in zip(mine, sums):
            no = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(no), block)), pa.array(no), pa.array(np.asarray(s)[no] if len(no) else no)], ["block", "no", "n"])

    # a task returns a row for each phrase that it meets: with a fixed number of tasks, rows grow with the phrases alone
    return texts.coalesce(2 * sc.defaultParallelism).mapInArrow(run, "block long, no long, n long").groupBy("block", "no").agg(F.sum("n").alias("n"))


def phrase_counts(texts: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, log_bits: int = 26, block: int = BLOCK,
                  per_round: int = ROUND, words: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """(block, no, ids, a): the candidates with their exact counts. ``words`` and ``buckets`` as in ``safe_phrases``."""
    safe = written(safe_phrases(texts, min_count, max_words, log_bits, words, buckets), "safe")
    n_blocks = max(1, -(-safe.count() // block))
    dealt = safe.withColumn("block", F.pmod(F.xxhash64("ids"), F.lit(n_blocks)))
    blocks = written(dealt.withColumn("no", F.row_number().over(Window.partitionBy("block").orderBy("ids")) - 1), "blocks")
    tries = written(build_tries(blocks), "tries")
    counts = None
    for i in range(0, n_blocks, per_round):  # a bounded number of tries of bounded size at a time
        some = tries.where(F.col("block").between(i, i + per_round - 1)).collect()
        if some:
            part = written(trie_counts(texts, some), "counts")
            counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        return blocks.select("block", "no", "ids", F.lit(0).cast("long").alias("a")).limit(0)
    return counts.where(F.col("n") >= min_count).join(blocks, ["block", "no"]).select("block", "no", "ids", F.col("n").alias("a"))


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, swallow: int = SWALLOW,
            text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases."""
    docs = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = written(with_hashes(word_counts(docs).where((F.col("n") >= min_count) | F.col("word").isNull())), "words")
    totals = counted.where("word is null").select("lang", F.col("n").alias("total"))
    words = counted.where("word is not null").select("lang", F.expr("decode(word, 'UTF-8')").alias("word"), "h", "n")
    texts = written(encoded(docs, B.bit_set(words, "h", how.get("log_bits", 26))), "encoded")
    n_words = words.agg(F.sum("n").alias("n")).first().n or 0
    buckets = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-n_words // BUCKET))
    found = phrase_counts(texts, min_count, max_words, words=words.select("h").distinct(), buckets=buckets, **how)
    # hashes back to words
    spelled = found.select("block", "no", "a", F.posexplode("ids").alias("i", "h")).join(words.select("h", "lang", "word"), "h")
    spelled = spelled.groupBy("block", "no", "a").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
    text = lambda words: F.array_join(words, " ")
    found = written(spelled.select("lang", "a", F.col("w.word").alias("words")).withColumn("phrase", text(F.col("words"))), "phrases")
    known = words.select("lang", F.col("word").alias("part"), "n").unionByName(found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("n")))
    # all cuts
    size = F.size("words")
    cuts = found.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", text(F.slice("words", 1, F.col("k"))).alias("left"), text(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("right"))
    cuts = cuts.join(known.select("lang", F.col("part").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("part").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals.withColumnRenamed("total", "n"), "lang")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    product = F.lit(1000).cast("decimal(4,0)") * whole("a")
    score = F.call_function("div", product * whole("n"), whole("l") * whole("r"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # inside a longer one: one word longer is enough, as counts don't grow with length
    longer = found.where(size > 2).select("lang", "a", F.explode(F.array(text(F.slice("words", 1, size - 1)), text(F.slice("words", 2, size - 1)))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    left = best.join(longer, ["lang", "phrase"], "left").where(F.col("around").isNull() | (whole("around") * 100 < whole("a") * swallow))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return out.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
