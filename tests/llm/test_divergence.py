import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.llm import bits, divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def fold(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain(docs, min_docs=30, top=50):
    """The definition on rows (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    bags = [(g, s, Counter(TERM.findall(fold(t)))) for g, s, t in docs]
    df = defaultdict(Counter)
    for g, _, c in bags:
        df[g].update(set(c))
    kept = {g: {t for t, n in c.items() if n >= min_docs} for g, c in df.items()}
    sums = defaultdict(Counter)
    for g, s, c in bags:
        sums[g, s].update({t: n for t, n in c.items() if t in kept[g]})
    out = []
    key = lambda x: (-x[1], x[0].encode())
    for g, s in sums:
        v = len(kept[g])
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v)
        whole = Counter()
        for (g2, _), c in sums.items():
            if g2 == g:
                whole.update(c)
        pairs = [(o, sum(abs(share(sums[g, s], t) - share(sums[g, o], t)) for t in kept[g])) for g2, o in sums if g2 == g and o != s]
        terms = [(t, share(sums[g, s], t) - share(whole, t)) for t in kept[g] if sums[g, s][t]]
        for part, xs in (("pair", sorted(pairs, key=key)), ("term", sorted([x for x in terms if x[1] > 0], key=key)[:top])):
            out += [(g, s, part, i, n, r) for r, (i, n) in enumerate(xs, 1)]
    return out


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(partitions)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "Zürich", "zür", "żółć", "漢字", "x" * 70, "x" * 71, "Q", "it's", "e-mail", "\U0001f600"]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, "é"]), " ".join(rng.choices(pool, k=rng.randint(0, 12)))) for _ in range(150)]
    rows += [("fr", "only", "nothing kept"), ("fr", "other", None), ("it", "alone", "")] + rows[:5]
    got = [tuple(r) for r in divergence.divergence_report(table(spark, rows), min_docs=6, top=4).collect()]
    assert Counter(got) == Counter(plain(rows, 6, 4))


def test_refinement_discards_prefixes_level_by_level(spark):
    rows = [("en", "s", f"common{'abc'[i % 3]} rare{chr(256 + i)} longcommonprefix{chr(256 + i)} longcommonterm") for i in range(40)]
    bags = divergence.term_bags(table(spark, rows))
    kept = {r.term: r.n_docs for r in divergence.kept_terms(bags, 10).collect()}
    assert kept == {"commona": 14, "commonb": 13, "commonc": 13, "longcommonterm": 40}
    first = {bytes(r.prefix): r.n for r in divergence.prefix_counts(bags, 4).groupBy("prefix").agg(F.sum("n").alias("n")).collect()}
    assert first == {b"comm": 40, b"rare": 40, b"long": 40}  # documents, not terms
    # a full bit array lets all through, and the result stays
    assert {r.term for r in divergence.kept_terms(bags, 10, first=2, log_bits=16).collect()} == set(kept)


def test_held_dictionaries_of_any_size(spark):
    rows = [("en", f"s{i % 4}", f"{chr(97 + i % 7) * 5} both {chr(97 + i % 3) * 9}") for i in range(60)]
    bags = divergence.term_bags(table(spark, rows))
    kept = divergence.kept_terms(bags, 5)
    small = Counter(tuple(r) for r in divergence.group_counts(bags, kept, held=2).collect())
    assert small == Counter(tuple(r) for r in divergence.group_counts(bags, kept).collect()) and len(small) > 20
    a = Counter(tuple(r) for r in divergence.prefix_counts(bags, 4, held=1).groupBy("prefix").agg(F.sum("n")).collect())
    assert a == Counter(tuple(r) for r in divergence.prefix_counts(bags, 4).groupBy("prefix").agg(F.sum("n")).collect())


def test_many_sources_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_SOURCES", 4)
    monkeypatch.setattr(divergence, "TILE_TERMS", 3)
    rng = random.Random(1)
    rows = [("en", f"s{i % 11}", " ".join(rng.choices([chr(97 + k) * 2 for k in range(20)], k=9))) for i in range(120)]
    got = [tuple(r) for r in divergence.divergence_report(table(spark, rows), min_docs=5, top=3).collect()]
    assert Counter(got) == Counter(plain(rows, 5, 3))


def test_shares_beyond_64_bits(spark):
    n = 9_000_000_000_000
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(3 * n), F.lit(77)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (3 * n + 5 * 77)


def test_bit_sets(spark):
    rng = np.random.default_rng(0)
    h = rng.integers(-2**63, 2**63 - 1, 5000)
    s = bits.bit_set(spark.createDataFrame([(int(x),) for x in h], "h long"), "h", 20)
    assert len(s) == 1 << 17 and bits.members(s, h.view(np.uint64)).all()
    others = rng.integers(0, 2**63, 5000).astype(np.uint64)
    hit = bits.members(s, others)
    assert hit.mean() < 0.02 and [bits.one_member(s, int(x)) for x in others[:200]] == hit[:200].tolist()


def test_odd_rows_and_empty_table(make, odd):
    docs = make(odd).withColumn("source", F.lit("s"))
    got = [tuple(r) for r in divergence.divergence_report(docs, min_docs=2, top=5).collect()]
    assert Counter(got) == Counter(plain([("en", "s", t) for _, t in odd], 2, 5))
    assert divergence.divergence_report(docs.limit(0)).collect() == []
