"""Source divergence audit: how far the term shares of a language's sources lie apart.

Terms are runs of letters A-Z (lower-cased) and of characters beyond ASCII. A language keeps the terms found in at least
``min_docs`` of its documents. They are found by iceberg prefix refinement: for the first 12 bytes of the terms (closed by a zero
byte), then 24, 48 and so on, documents are counted by distinct prefix. A prefix under the threshold is discarded with all
terms that begin with it, as none of them can be in more documents than it is; a prefix that ends in the closing byte is a complete
term, and kept. The next level counts only what extends the prefixes that are left, until none is. Levels grow with the
logarithm of the longest kept term.

Each document's distinct terms and their counts are written once, ranged by language and source (and a hash, so that a hot source lies in
many ranges); every level is one pass over that table. A task counts one language's prefixes at a time in a dictionary of bounded size,
which is emptied into a shuffle by prefix. The prefixes left over reach the next level's
tasks as a bit array of fixed size (``bits``): it lets all of them through and, by chance, a few others, which are counted and
discarded then; so the result doesn't depend on its size.

A term's share in a group is 1 + floor(10^9 (count + 5) / (N + 5 V)), N the group's occurrences of kept terms, V their number, in
exact whole numbers. Sources are compared in tiles of terms and sources of bounded size.

Defined results: null text, language and source are empty strings; a row is a document, also if rows or ids repeat; a very long
text or term is like any other (a task holds one batch of texts); a group without terms has the smallest share everywhere; a
language without kept terms gives differences of 0; ties go to the smaller item in the order of UTF-8; an empty table gives no
rows; columns other than text, lang and source are not read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm import bits as B
from murmur.llm.common import written

MIN_DOCS = 30
TOP = 50
FIRST_LEVEL = 12
#: What a task holds before it passes it on: counted prefixes or terms, and remembered terms.
HELD = 300_000
#: Rows that are looked at together, and terms that are added up together.
ROWS, ADDED = 256, 1_000_000
#: Terms and sources of a tile.
TILE_TERMS, TILE_SOURCES = 1024, 128
_SEPARATORS = [*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order. Bytes beyond ASCII belong to characters beyond ASCII, so bytes can be told apart alone."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _seed(lang: str) -> int:
    """Prefixes are hashed with a seed that stands for their language."""
    return xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))


def hashed(found: DataFrame) -> DataFrame:
    """(lang, prefix, n) with h, the prefix's hash in its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.array([xxhash.xxh64_intdigest(p, _seed(g)) for g, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64))], ["lang", "prefix", "n", "h"])

    return found.select("lang", "prefix", "n").mapInArrow(run, "lang string, prefix binary, n long, h long")


def term_bags(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, h, terms, counts) of every row: its distinct terms, separated by spaces, how often each occurs, and a hash of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bags = [Counter(terms_of(x.as_py())) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([b" ".join(c) for c in bags], pa.binary()),
                                              pa.array([list(c.values()) for c in bags], pa.list_(pa.int32()))],
                                             ["lang", "source", "terms", "counts"])

    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    found = docs.select(*text).mapInArrow(run, "lang string, source string, terms binary, counts array<int>")
    return found.select("lang", "source", F.xxhash64("terms").alias("h"), "terms", "counts")


def arranged(bags: DataFrame) -> DataFrame:
    """The bags with each language's and source's rows side by side."""
    return bags.repartitionByRange("lang", "source", "h").sortWithinPartitions("lang", "source")


def _runs(keys: list, *columns: pa.Array) -> Iterator[tuple]:
    """(key, slice of each column) of rows with the same key one after another, ``ROWS`` of them at most."""
    first = 0
    while first < len(keys):
        last = first + 1
        while last < len(keys) and last - first < ROWS and keys[last] == keys[first]:
            last += 1
        yield (keys[first], *(c.slice(first, last - first) for c in columns))
        first = last


def prefix_counts(bags: DataFrame, size: int, before: int = 0, left: np.ndarray | None = None, held: int = HELD) -> DataFrame:
    """(lang, prefix, n): in how many documents a term begins with each prefix of at most ``size`` bytes, partly summed. Only terms
    that extend a prefix of ``before`` bytes in ``left`` (a bit array of hashes) are counted."""
    shared = None if left is None else bags.sparkSession.sparkContext.broadcast(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else shared.value
        now, seed, names, sums, met, size_met = "", _seed(""), [b""], np.zeros(1024, np.int64), [], 0
        number: dict[bytes, int] = {}  # of each prefix, twice its place in names, and 1 if it is cut

        class Known(dict):
            """Numbers of terms' prefixes; 0 for a term that isn't counted."""

            def __missing__(self, t: bytes) -> int:
                closed = t + b"\0"
                if not t or before and (len(closed) <= before or not B.one_member(bits, xxhash.xxh64_intdigest(closed[:before], seed))):
                    self[t] = 0
                    return 0
                p = closed[:size]
                k = number.get(p)
                if k is None:
                    k = 2 * len(names) + (len(closed) > size)
                    names.append(p)
                    if k & 1:  # only a cut prefix is several terms'
                        number[p] = k
                self[t] = k
                return k

        known = Known()

        def add():
            nonlocal sums, size_met
            if met:
                n = np.bincount(np.concatenate(met) >> 1, minlength=len(sums))
                n[:len(sums)] += sums
                sums, size_met = n, 0
                met.clear()

        def rows():
            nonlocal sums
            add()
            sums[0] = 0
            at = np.flatnonzero(sums)
            for i in range(0, len(at), 50_000):
                part = at[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.repeat(now, len(part)), pa.array([names[k] for k in part.tolist()], pa.binary()), pa.array(sums[part])],
                                                 ["lang", "prefix", "n"])
            known.clear()
            number.clear()
            del names[1:]
            sums = np.zeros(1024, np.int64)

        for b in batches:
            for lang, bag in _runs(b.column(0).to_pylist(), b.column(1)):
                if lang != now:
                    yield from rows()
                    now, seed = lang, _seed(lang)
                parts = [x.split(b" ") for x in bag.to_pylist()]
                row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
                k = np.fromiter(map(known.__getitem__, chain.from_iterable(parts)), np.int64, len(row))
                cut = k & 1 == 1
                met.append(k[~cut])
                if cut.any():  # a document counts once for each prefix
                    top = 2 * len(names)
                    met.append(np.unique(row[cut] * top + k[cut]) % top)
                size_met += len(k)
                if size_met > ADDED:
                    add()
                if len(known) > held:
                    yield from rows()
        yield from rows()

    return bags.select("lang", "terms").mapInArrow(run, "lang string, prefix binary, n long")


def kept_terms(bags: DataFrame, min_docs: int = MIN_DOCS, first: int = FIRST_LEVEL, log_bits: int = 26) -> DataFrame:
    """(lang, term, h, n_docs): the terms in at least ``min_docs`` of their language's documents, level by level."""
    complete = F.substring("prefix", -1, 1) == F.lit(b"\0")
    kept, size, before, left = [], first, 0, None
    while True:
        counts = prefix_counts(bags, size, before, left)
        found = written(hashed(counts.groupBy("lang", "prefix").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)), "prefixes")
        kept.append(found.where(complete))
        rest = found.where(~complete)
        if rest.isEmpty():
            break
        before, size, left = size, 2 * size, B.bit_set(rest, "h", log_bits)
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    term = F.expr("decode(substring(prefix, 1, length(prefix) - 1), 'UTF-8')")
    return out.select("lang", term.alias("term"), "h", F.col("n").alias("n_docs"))


def group_counts(bags: DataFrame, kept: DataFrame, log_bits: int = 26, held: int = HELD) -> DataFrame:
    """(lang, source, term, n): how often each kept term occurs in each group that has it."""
    shared = bags.sparkSession.sparkContext.broadcast(B.bit_set(kept, "h", log_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        now, seed, names, sums, met, size_met = ("", ""), _seed(""), [b""], np.zeros(1024, np.int64), [], 0

        class Known(dict):
            """Places of kept terms in names; 0 for others."""

            def __missing__(self, t: bytes) -> int:
                k = 0
                if t and B.one_member(bits, xxhash.xxh64_intdigest(t + b"\0", seed)):
                    k = len(names)
                    names.append(t)
                self[t] = k
                return k

        known = Known()

        def add():
            nonlocal sums, size_met
            if met:
                k, n = np.concatenate([k for k, _ in met]), np.concatenate([n for _, n in met])
                got = np.bincount(k, weights=n, minlength=len(sums)).astype(np.int64)  # far below 2**53 each time
                got[:len(sums)] += sums
                sums, size_met = got, 0
                met.clear()

        def rows():
            nonlocal sums
            add()
            sums[0] = 0
            at = np.flatnonzero(sums)
            for i in range(0, len(at), 50_000):
                part = at[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.repeat(now[0], len(part)), pa.repeat(now[1], len(part)), pa.array([names[k] for k in part.tolist()], pa.binary()),
                                                  pa.array(sums[part])], ["lang", "source", "term", "n"])
            sums = np.zeros(1024, np.int64)

        def forget():
            known.clear()
            del names[1:]

        for b in batches:
            for group, bag, n in _runs(list(zip(b.column(0).to_pylist(), b.column(1).to_pylist())), b.column(2), b.column(3)):
                if group != now:
                    yield from rows()
                    if group[0] != now[0]:
                        forget()
                    now, seed = group, _seed(group[0])
                parts = [x.split(b" ") for x in bag.to_pylist() if x]  # no term, no count
                n = n.flatten().to_numpy()
                met.append((np.fromiter(map(known.__getitem__, chain.from_iterable(parts)), np.int64, len(n)), n))
                size_met += len(n)
                if size_met > ADDED:
                    add()
                if len(known) > held:
                    yield from rows()
                    forget()
        yield from rows()

    found = bags.select("lang", "source", "terms", "counts").mapInArrow(run, "lang string, source string, term binary, n long")
    found = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).withColumn("term", F.expr("decode(term, 'UTF-8')"))
    return found.join(kept.select("lang", "term"), ["lang", "term"], "left_semi")  # what passed the bits by chance goes


def share(count: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 n_terms)), exact: the products go beyond 64 bits."""
    whole = lambda c: c.cast("decimal(19,0)")
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * whole(count + 5)
    return F.call_function("div", top, whole(total + 5 * n_terms)) + 1


def pair_differences(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the summed differences of any two of a language's sources, a < b by their ordinals.

    ``shares``: lang, o, term, p of the terms that a group has; ``groups``: lang, o, p0 (the share of a term that it hasn't), n_terms,
    n_groups. A tile holds the terms of one bucket and the sources of two blocks of ordinals; its sums are added up by pair."""
    n_tiles = F.greatest(F.lit(1), F.ceil(F.col("n_terms") / TILE_TERMS)).cast("int")
    spread = F.explode(F.sequence(F.lit(0), n_tiles - 1))
    own = groups.select("lang", "o", "n_groups", spread.alias("bucket"), F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    size = groups.select("lang", "o", "n_groups", n_tiles.alias("n"))
    have = shares.join(size, ["lang", "o"]).select("lang", "o", "n_groups", F.pmod(F.xxhash64("term"), F.col("n")).cast("int").alias("bucket"), "term", "p")
    block = (F.col("o") / TILE_SOURCES).cast("int")
    rows = own.unionByName(have).withColumn("other", F.explode(F.sequence(F.lit(0), ((F.col("n_groups") - 1) / TILE_SOURCES).cast("int"))))
    rows = rows.withColumn("ta", F.least(block, "other")).withColumn("tb", F.greatest(block, "other"))

    def compare(key, pdf: pd.DataFrame) -> pd.DataFrame:
        lang, _, ta, tb = key
        base = pdf["term"].isna().to_numpy()
        ids, p0 = pdf["o"].to_numpy()[base], pdf["p"].to_numpy()[base]
        order = np.argsort(ids)
        ids, p0 = ids[order], p0[order]
        have = pdf[~base]
        at, names = pd.factorize(have["term"])
        m = np.repeat(p0[:, None], len(names), axis=1)
        m[np.searchsorted(ids, have["o"].to_numpy()), at] = have["p"].to_numpy()
        out = []
        for i in np.flatnonzero(ids // TILE_SOURCES == ta):
            js = np.flatnonzero((ids // TILE_SOURCES == tb) & (ids > ids[i]))
            out.append(pd.DataFrame({"lang": lang, "a": ids[i], "b": ids[js], "value": np.abs(m[js] - m[i]).sum(axis=1)}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})

    tiles = rows.select("lang", "bucket", "ta", "tb", "o", "term", "p").groupBy("lang", "bucket", "ta", "tb").applyInPandas(compare, "lang string, a long, b long, value long")
    return tiles.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence_report(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source", first: int = FIRST_LEVEL, log_bits: int = 26) -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair``: every other source of the language, by the summed difference of the
    shares. Part ``term``: the ``top`` terms whose share in the group is most above the language's."""
    bags = written(arranged(written(term_bags(docs, text_col, lang_col, source_col), "bags")), "bags")
    kept = written(kept_terms(bags, min_docs, first, log_bits), "terms")
    counts = written(group_counts(bags, kept, log_bits), "counts")
    n_terms = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = bags.select("lang", "source").distinct().join(n_terms, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.withColumn("n_terms", F.coalesce("n_terms", F.lit(0))).withColumn("total", F.coalesce("total", F.lit(0)))
    by_lang = Window.partitionBy("lang")
    none = F.lit(0).cast("long")
    groups = written(groups.select(
        "lang", "source", "total", "n_terms", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("o"),
        F.count("*").over(by_lang).alias("n_groups"), F.sum("total").over(by_lang).alias("lang_total"),
        F.when(F.col("n_terms") > 0, share(none, F.col("total"), F.col("n_terms"))).otherwise(none).alias("p0")), "groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("n_terms")))
    # pairs, from both sides
    sums = pair_differences(shares.select("lang", "o", "term", "p"), groups)
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = groups.select("lang", "o", "source")
    pairs = both.join(name.withColumnRenamed("o", "a"), ["lang", "a"]).join(name.select("lang", F.col("o").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    # terms, against the whole language
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    terms = shares.join(whole, ["lang", "term"]).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")))
    terms = terms.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    pairs = pairs.select("lang", "source", "item", "value").withColumn("rank", F.row_number().over(order))
    cols = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return cols(pairs, "pair").unionByName(cols(terms, "term"))
