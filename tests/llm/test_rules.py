import math
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from murmur.llm import rules

def good(i):
    return " ".join(f"word{(i * 7919 + k * k * 31) % 4001}" + ("\n" if k % 20 == 19 else "") for k in range(80))


def bad(i):
    return " ".join(f"w{i}k{k}***" for k in range(70))


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    w3 = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if w3[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@pytest.mark.parametrize("text", [None, "", "a a a", "a a a a", "a b c a b c", "x#y* <z>\nx#y* <z>\n\n \n \n", "é\x1c  ü", "q " * 500,
                                  " ".join(str(i % 7) for i in range(300))])
def test_base_counts(text):
    assert rules.measure(text)[:5] == plain_base(text)


def test_binomial_tail_is_exact():
    for n, k, p in ((10, 3, Fraction(1, 4)), (40, 0, Fraction(1, 100)), (25, 25, Fraction(1, 2))):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.exp(rules.log_binomial_cdf(k, n, float(p))) == pytest.approx(float(want), rel=1e-9)


def test_certified_cutoffs_keep_their_bound():
    """Over many draws, a used cutoff's true rate of false rejections exceeds the limit no more often than the level allows."""
    import numpy as np
    rng, limit, level, wrong, used = np.random.default_rng(1), 0.05, 0.1, 0, 0
    true = np.exp(-np.arange(256) / 30.0)  # P(value >= t) among good documents
    for _ in range(300):
        values = np.minimum(255, (30.0 * rng.exponential(size=400)).astype(int))
        bads = Counter(rng.integers(60, 256, size=200).tolist())
        t = rules.certify(Counter(values.tolist()), bads, limit, level, cost=1.0)
        if t is not None:
            used += 1
            wrong += true[t] > limit
    assert used > 250 and wrong / 300 <= level + 0.03


def test_too_few_labels_certify_nothing():
    assert rules.certify({0: 20}, {200: 20}, 0.01, 0.01, 10.0) is None
    assert rules.certify({}, {3: 4}, 0.5, 0.5, 1.0) is None


@pytest.fixture(scope="module")
def corpus(spark, make):
    rows = [(i, good(i)) for i in range(1000)] + [(1000 + i, bad(i)) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1000)] + [(1000 + i, 0, 0) for i in range(30)] + [(5, None, None), (None, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    return rows, make(rows), labels


def test_rules_reject_bad_and_keep_good(corpus, odd, make):
    rows, docs, labels = corpus
    got = {r.doc_id: r for r in rules.quality_verdicts(docs, labels).collect()}
    assert all(got[i].kept for i in range(1000))
    assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(60))  # also those without a label
    for i, t in rows[:5]:
        assert tuple(got[i][c] for c in rules.BASE) == plain_base(t)
    kept = rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 1000


def test_odd_rows_and_empty_tables(corpus, odd, make):
    _, _, labels = corpus
    docs = make(odd)
    got = rules.quality_verdicts(docs, labels).collect()
    assert Counter((r.doc_id, *(r[c] for c in rules.BASE)) for r in got) == Counter((i, *plain_base(t)) for i, t in odd)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and (not r.kept or not r.base_failed)
    assert rules.keep_good(docs, labels).count() == sum(r.kept for r in got)
    assert rules.quality_verdicts(docs.limit(0), labels).count() == 0
    none = rules.quality_verdicts(docs, labels.limit(0)).where(F.col("kept") == F.col("base_failed")).count()
    assert none == 0  # without labels, the base alone decides
    nulls = docs.withColumn("lang", F.lit(None).cast("string"))
    assert rules.quality_verdicts(nulls, labels).count() == len(odd)
