import random
import re
import threading
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.llm import phrases
from murmur.llm.trie import Trie


def plain(docs, min_count, max_words, top, swallow=100):
    """The definition on rows (lang, text)."""
    fold = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    out = []
    f = {}
    for lang, text in docs:
        c = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", fold(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            c.update(tuple(w[i:i + m]) for m in range(1, max_words + 1) for i in range(len(w) - m + 1))
    for lang, c in f.items():
        n = sum(k for p, k in c.items() if len(p) == 1)
        cand = {p: k for p, k in c.items() if len(p) > 1 and k >= min_count}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= swallow * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, lo, hi = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, lo, hi, n, score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return out


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 2) for r in rows], "lang string, text string, word string, h int").repartition(partitions)


@pytest.mark.parametrize("seed,how", [(0, {}), (1, {"block": 7, "per_round": 2}), (2, {"log_bits": 16})])
def test_against_brute_force(spark, seed, how):
    rng = random.Random(seed)
    words = ["a", "b", "Ce", "dé", "e'f", "ÉÉ", "#", "\x01"]
    rows = []
    for _ in range(120):
        text = "".join(rng.choices(words, weights=[8, 6, 4, 3, 3, 2, 1, 1])[0] + rng.choices([" ", "\t ", ". ", "\n", ",", "  "], weights=[30, 2, 1, 1, 1, 1])[0]
                       for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "de", None]), text))
    rows += [("fr", None), ("fr", ""), ("fr", "x y"), *rows[:10]]
    got = [tuple(r) for r in phrases.phrases(table(spark, rows), min_count=5, max_words=5, top=40, **how).collect()]
    want = plain(rows, 5, 5, 40)
    assert Counter(got) == Counter(want) and len(want) > 60


def test_repeats_overlap_and_swallow(spark):
    rows = [("en", "a a a a")] * 3 + [("en", "x y z")] * 4 + [("en", "x y")] * 4
    for swallow in (50, 100):
        got = [tuple(r) for r in phrases.phrases(table(spark, rows), min_count=3, max_words=4, top=10, swallow=swallow).collect()]
        assert Counter(got) == Counter(plain(rows, 3, 4, 10, swallow))
    assert ("en", "x y") in {(r[0], r[2]) for r in got}


def test_safe_phrases_hold_all_candidates(spark):
    rng = random.Random(4)
    texts = [[rng.randint(1, 6) for _ in range(30)] + [0] for _ in range(40)]
    df = spark.createDataFrame([(phrases.pack_words(np.array(t, np.uint64)),) for t in texts], "words binary").repartition(3)
    safe = {tuple(r.ids) for r in phrases.safe_phrases(df, 10, 4, 20).collect()}
    c = Counter(tuple(t[i:i + m]) for t in texts for m in (2, 3, 4) for i in range(30 - m + 1))
    assert {p for p, n in c.items() if n >= 10} <= safe
    assert all(c[p[:-1]] >= 10 and c[p[1:]] >= 10 for p in safe if len(p) > 2)


@pytest.mark.parametrize("seed", range(4))
def test_trie_counts(seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(1, 2**64, [3, 40, 400, 2000][seed], dtype=np.uint64)
    ps = sorted({tuple(rng.choice(pool, rng.integers(1, 6)).tolist()) for _ in range(600)})
    t = Trie.unpack(*Trie.build([np.array(p, np.uint64) for p in ps]).pack())
    x = np.concatenate([np.array(p, np.uint64) for p in rng.permutation(np.array(ps, dtype=object))] + [np.zeros(1, np.uint64), rng.choice(pool, 3000)])
    xs = x.tolist()
    want = Counter(tuple(xs[i:i + m]) for m in range(1, 6) for i in range(len(xs) - m + 1))
    assert t.count(x).tolist() == [want[p] for p in ps]
    assert Trie.build([]).count(x).tolist() == []


def test_scores_beyond_64_bits(spark):
    """The score's expression at 10^13 words."""
    big = 10**13
    row = spark.range(1).select(F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.lit(big // 7).cast("decimal(19,0)") * F.lit(big).cast("decimal(19,0)"),
                                                F.lit(big // 3).cast("decimal(19,0)") * F.lit(big // 5).cast("decimal(19,0)")).alias("s")).first()
    assert row.s == 1000 * (big // 7) * big // ((big // 3) * (big // 5))


def test_odd_rows_and_empty_table(make, odd):
    got = [tuple(r) for r in phrases.phrases(make(odd), min_count=3, max_words=5, top=30).collect()]
    assert Counter(got) == Counter(plain([("en", t) for _, t in odd], 3, 5, 30))
    assert phrases.phrases(make([]).limit(0)).collect() == []


def shuffled_bytes(spark, run):
    """What ``run`` gives, and the size of all shuffle files that were there meanwhile (Spark removes those that it no longer needs)."""
    dirs = [str(d) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}
    old, seen, done = files(), {}, threading.Event()

    def watch():
        while not done.wait(0.02):
            for f in files() - old:
                try:
                    seen[f] = f.stat().st_size
                except FileNotFoundError:
                    pass

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        return run(), sum(seen.values())
    finally:
        done.set()
        watcher.join()


def test_pairs_are_sent_in_few_bytes(spark):
    """Pairs of words took 13 bytes each as rows of hashes."""
    rng = np.random.default_rng(5)
    pool = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    texts = [rng.choice(pool, 10_000) for _ in range(40)]
    df = spark.createDataFrame([(phrases.pack_words(t),) for t in texts], "words binary").repartition(2).cache()
    assert df.count() == 40
    safe, size = shuffled_bytes(spark, lambda: phrases.safe_phrases(df, 100, 3, 20).collect())
    assert safe == [] and 0 < size < 10 * 40 * 9_999


@pytest.mark.parametrize("buckets", [1, 5, 3000])
def test_words_with_equal_codes_are_all_found(spark, buckets):
    rng = random.Random(6)
    pool = [5, 1 << 32 | 4, 7, 3 << 32 | 4, 2**64 - 1]  # 5 and the next one, 7 and the next one have the same code
    assert len(set(phrases._code(np.array(pool, np.uint64)).tolist())) == 3
    texts = [rng.choices(pool, k=30) + [0] for _ in range(40)]
    df = spark.createDataFrame([(phrases.pack_words(np.array(t, np.uint64)),) for t in texts], "words binary").repartition(3)
    safe = [tuple(w % 2**64 for w in r.ids) for r in phrases.safe_phrases(df, 10, 4, 20, buckets=buckets).collect()]
    c = Counter(tuple(t[i:i + m]) for t in texts for m in (2, 3, 4) for i in range(30 - m + 1))
    assert {p for p, n in c.items() if n >= 10} <= set(safe) and len(set(safe)) == len(safe)


@pytest.mark.parametrize("n", [1, 2, 5000])
def test_keys_and_counts_come_back(n):
    rng = np.random.default_rng(n)
    head, word = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
    keys = phrases.keys_of(head, word)
    codes = phrases.codes_of(keys)
    assert (codes[0] == phrases._code(head)).all() and (codes[1] == phrases._code(word)).all()
    keys, counts = np.unique(keys), rng.integers(1, 2**32, n)
    back = phrases.unpack_counts(phrases.pack_counts(keys, counts))
    assert (back[0] == keys).all() and (back[1] == counts).all()
