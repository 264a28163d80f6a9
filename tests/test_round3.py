"""Scans in slices, candidate search at any size, keyed split, repeatable sinks."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from murmur.functions import vectors as V
from murmur.operators import clustering as CL
from murmur.operators import sentiment as SE
from murmur.sources import crawl as CR
from murmur.sources import files as FI


def plain_cutoff(rows, stop):
    out, groups = [], {}
    for r in sorted(rows, key=lambda r: (str(r[:2]), r[2])):
        groups.setdefault(r[:2], []).append(r)
    for rs in groups.values():
        run = 0
        for r in rs:
            if not r[3]:
                run += 1
                if run >= stop:
                    break
            else:
                run = 0
                out.append(r)
    return out


@pytest.mark.parametrize("stop,empty", [(2, 0.3), (5, 0.75), (9, 0.9), (1, 0.1)])
def test_cutoff_over_many_slices(spark, stop, empty):
    """One hot group lies in all slices; runs of empty pages cross their borders."""
    rng = random.Random(stop)
    rows = [("d", "hot", p, 0 if rng.random() < empty else rng.choice([1, 3])) for p in range(1, 1200, 3)]
    rows += [("d", k, p, rng.choice([0, 0, None, 2])) for k in ("a", "b", None) for p in range(1, 60, 10)]
    df = spark.createDataFrame(rows, "day string, keyword string, page_start int, n_links int").repartition(5)
    got = CR.empty_run_cutoff(df, max_empty=stop)
    assert got.columns == df.columns
    assert Counter(map(tuple, got.collect())) == Counter(plain_cutoff(rows, stop))


def test_long_run_through_whole_slices(spark):
    rows = [("d", "k", p, int(p < 10 or p >= 900)) for p in range(1000)]
    df = spark.createDataFrame(rows, "day string, keyword string, page_start int, n_links int")
    for stop in (890, 891):
        got = sorted(r.page_start for r in CR.empty_run_cutoff(df, max_empty=stop).collect())
        assert got == [p for p in range(1000) if p < 10 or (p >= 900 and stop == 891)]


def plain_best(v, cands):
    best = None
    for o, name, c in sorted(cands):
        den = (sum(x * x for x in v) * sum(x * x for x in c)) ** 0.5
        s = sum(x * y for x, y in zip(v, c)) / den if den else 0.0
        if best is None or s > best[1] + 1e-12:
            best = (name, s)
    return best


@pytest.mark.parametrize("zero", [False, True])
def test_candidates_beyond_the_inlined_ones(spark, zero):
    rng = random.Random(7)
    vec = lambda: [rng.gauss(0, 1) for _ in range(4)]
    cands = [(i, f"c{i}", vec()) for i in range(60)]
    cands += [(100 + i, f"copy{i}", cands[i][2]) for i in range(5)] + ([(50_000, "zero", [0.0] * 4), (70_000, "zero2", [0.0] * 4)] if zero else [])
    if zero:  # all candidates on one side, so that a zero vector can win
        cands = [(o, n, [abs(x) for x in c]) for o, n, c in cands]
    rows = [(i, vec()) for i in range(80)] + [(900, [0.0] * 4), (901, cands[3][2]), (902, [-1.0, -1.0, -1.0, -1.0]), (903, None), (901, cands[3][2])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    cd = spark.createDataFrame(cands, "ord long, candidate string, embedding array<double>")
    got = CL.nearest_candidate(df, cd, inline=10).collect()
    assert Counter(r.id for r in got) == Counter(i for i, _ in rows)
    for r in got:
        if r.id == 903:
            assert r.candidate is None
            continue
        name, score = plain_best(r.embedding, cands)
        assert (r.candidate, round(r.candidate_score, 9)) == (name, round(score, 9))
    small = {(r.id, r.candidate) for r in CL.nearest_candidate(df.where("id <> 903"), cd, inline=1000).collect()}
    assert small == {(r.id, r.candidate) for r in got if r.id != 903}
    assert V.MAX_INLINE_CANDIDATES == 4096


def test_split_is_the_same_in_any_layout(spark):
    df = spark.range(3000).select(F.concat(F.lit("text "), F.col("id")).alias("text"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    held = [{r.text for r in df.repartition(n).filter(SE.held_out("text", "label")).collect()} for n in (1, 2, 5)]
    assert held[0] == held[1] == held[2] and 0.08 < len(held[0]) / 3000 < 0.12
    by = Counter(int(t.split()[1]) % 3 == 0 for t in held[0])
    assert 0.07 < by[True] / 1000 < 0.13 and 0.08 < by[False] / 2000 < 0.12


def test_bootstrap_metrics(spark):
    rng = random.Random(3)
    rows = [(f"t{i}", float(i % 4 == 0), float((i % 4 == 0) ^ (rng.random() < 0.2))) for i in range(400)] + [("many", 1.0, 1.0)] * 40
    got = [SE.bootstrap_metrics(spark.createDataFrame(rows, "text string, label double, prediction double").repartition(n)).first() for n in (1, 4)]
    assert got[0] == got[1]
    m, n = got[0], len(rows)
    acc = sum(a == b for _, a, b in rows) / n
    f1 = 0.0
    for c in (0.0, 1.0):
        hit, lab, pre = (sum(f(r) for r in rows) for f in (lambda r: r[1] == r[2] == c, lambda r: r[1] == c, lambda r: r[2] == c))
        f1 += 2 * hit / (lab + pre) * lab / n
    assert m.accuracy == pytest.approx(acc) and m.f1 == pytest.approx(f1)
    se = (acc * (1 - acc) / n) ** 0.5
    assert m.accuracy_low == pytest.approx(acc - 1.96 * se, abs=se) and m.accuracy_high == pytest.approx(acc + 1.96 * se, abs=se)
    assert m.f1_low < m.f1 < m.f1_high


def test_results_of_two_methods_stay(spark, tmp_path):
    out = str(tmp_path / "out")
    make = lambda m, ids: spark.createDataFrame([(i, t, m, f"text \"{i}\"\nmore") for i in ids for t in ("0101_0107", "0108_0114")],
                                                "comment_id long, time_label string, topic_method string, comment_text string")
    for fmt in ("parquet", "csv"):
        lda, clusters = make("lda", range(3)), make("cluster", range(2))
        for df in (lda, clusters, lda, clusters):  # each sent twice
            FI.write_assignments(df, f"{out}-{fmt}", fmt)
        r = spark.read.option("header", True).option("escape", '"').option("multiLine", True).format(fmt).load(f"{out}-{fmt}")
        assert Counter((int(x.comment_id), x.topic_method, x.comment_text) for x in r.collect()) == \
            Counter((x.comment_id, x.topic_method, x.comment_text) for x in lda.union(clusters).collect())
        FI.write_assignments(make("lda", [9]).where("time_label = '0101_0107'"), f"{out}-{fmt}", fmt)  # replaces one directory
        assert sorted(os.listdir(f"{out}-{fmt}/topic_method=lda")) == ["time_label=0101_0107", "time_label=0108_0114"]
        assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').format(fmt).load(f"{out}-{fmt}").count() == 2 * 3 + 2 * 2 - 2


def test_append_of_a_run_is_repeatable(spark, tmp_path):
    arts = lambda *ks: spark.createDataFrame([(k, f"t, \"{k}\"\nx", "2025-05-19", "u") for k in ks], "keyword string, title string, date string, url string")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        FI.append_articles(arts("a", "a"), path, fmt, run="r1")
        FI.append_articles(arts("b"), path, fmt, run="r2")
        FI.append_articles(arts("a", "a"), path, fmt, run="r1")
        back = FI.read_articles(spark, path, fmt)
        assert back.columns == ["Keyword", "Title", "Date", "URL"]
        assert Counter((r.Keyword, r.Title) for r in back.collect()) == Counter({("a", 't, "a"\nx'): 2, ("b", 't, "b"\nx'): 1})


def test_long_keyword_lists(spark):
    """5,000 keywords in one expression, equal to one count after another."""
    from murmur.functions import text as T
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(5000)] + ["aa", "aba", "ABA", "A.b", "x y", "한국", "ana"]
    texts = ["".join(rng.choices("abcdeéABC xy.한국", k=rng.randint(0, 120))) for _ in range(25)] + [None, "", "aaaaa", "ababa aba", "banana ana", "a"]
    plain = [sum((t or "").lower().count(w.lower()) for w in words) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.n for r in df.select("i", T.keyword_hits("t", words).alias("n")).collect()}
    assert [got[i] for i in range(len(texts))] == plain and max(plain) > 100
    few = words[:40] + words[-7:]
    one = {r.i: r.n for r in df.select("i", sum((T.keyword_count("t", w) for w in few), F.lit(0)).alias("n")).collect()}
    many = {r.i: r.n for r in df.select("i", T.keyword_hits("t", few).alias("n")).collect()}
    assert one == many
    axes = {"first": words[:2500], "second": words[2500:]}
    label = {r.i: r.c for r in df.select("i", T.keyword_classify(F.col("t"), axes, "none").alias("c")).collect()}
    for i, t in enumerate(texts):
        s = [sum((t or "").lower().count(w.lower()) for w in ws) for ws in axes.values()]
        assert label[i] == ("none" if max(s) == 0 else "first" if s[0] >= s[1] else "second")
