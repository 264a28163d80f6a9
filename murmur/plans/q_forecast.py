"""Registered queries for targets, entity features and the period split
(A-4, A-5, A-11, A-14, J-1, J-7 .. J-10, PF-2, PF-3, PF-6, PF-9, PF-11, S-3,
F-2 .. F-6, T-20, T-21, E-6) with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.functions import vectors as V
from murmur.operators import evaluate as EV
from murmur.operators import forecast as FC
from murmur.plans.catalog import register
from murmur.plans.oracle import ORACLE, q, r6, rnd
from murmur.plans.q_topics import detail_cte, norm_sql, ta_cte, dot_sql
from murmur.schemas import coerce_numeric, require_values
from murmur.sources import fixtures as FX

CANDS = FX.candidate_names()
DIM = FX.EMBEDDING_DIM
ZEROS = "[" + ", ".join(["0.0"] * DIM) + "]::DOUBLE[]"


def cand_of_sql(x: str) -> str:
    whens = " ".join(f"WHEN contains({x}, {q(c)}) THEN {q(c)}" for c in CANDS)
    return f"(CASE WHEN {x} IS NULL THEN 'unknown' {whens} ELSE 'other' END)"


CLIST = "(VALUES " + ", ".join(f"({i}, {q(c)})" for i, c in enumerate(CANDS)) + ") t(cand_ord, candidate)"
IN_CANDS = "(" + ", ".join(q(c) for c in CANDS) + ")"


def ep_cte() -> str:
    return f"""{detail_cte()},
clist AS (SELECT * FROM {CLIST}),
sc AS (SELECT *, {cand_of_sql('final_cluster')} AS candidate FROM summary),
agg AS (SELECT time_label, candidate, avg(positive) AS ap, avg(negative) AS an, count(*) AS cc
        FROM sc WHERE candidate IN {IN_CANDS} GROUP BY ALL),
grid AS (SELECT DISTINCT s.time_label, c.cand_ord, c.candidate FROM summary s, clist c),
cvec AS (SELECT final_cluster, list(v ORDER BY i) AS vector FROM (
           SELECT final_cluster, r.i, avg(embedding[r.i]) AS v FROM clustered, range(1, {DIM + 1}) r(i) GROUP BY ALL)
         GROUP BY final_cluster),
ev AS (SELECT s.time_label, s.candidate, r.i, avg(cv.vector[r.i]) AS v
       FROM sc s JOIN cvec cv USING (final_cluster), range(1, {DIM + 1}) r(i)
       WHERE s.candidate IN {IN_CANDS} GROUP BY ALL),
evl AS (SELECT time_label, candidate, list(v ORDER BY i) AS embedding FROM ev GROUP BY ALL),
ep AS (SELECT g.time_label, g.cand_ord, g.candidate, coalesce(a.ap, 0.5) AS avg_positive,
              coalesce(a.an, 0.5) AS avg_negative, coalesce(a.cc, 0) AS cluster_count,
              coalesce(a.ap, 0.5) - coalesce(a.an, 0.5) AS sentiment_score,
              coalesce(e.embedding, {ZEROS}) AS embedding
       FROM grid g LEFT JOIN agg a USING (time_label, candidate) LEFT JOIN evl e USING (time_label, candidate))"""


def _ep(spark, sf_dir):
    return FX.entity_period(spark, sf_dir, DIM)


def _summary(spark, sf_dir):
    return FX.sentiment_summary(spark, sf_dir)


# ---------------------------------------------------------------------------
# Entity features
# ---------------------------------------------------------------------------
@register("entity_period")
def q_entity_period(spark, sf_dir):
    """A-5 / F-1: unweighted cluster means per (period, candidate), defaults .5/.5/0/0."""
    return _ep(spark, sf_dir).select("time_label", "candidate", "avg_positive", "avg_negative",
                                     "sentiment_score", "cluster_count")


ORACLE["entity_period"] = (f"WITH {ep_cte()}\nSELECT time_label, candidate, {r6('avg_positive', 'avg_positive')}, "
                           f"{r6('avg_negative', 'avg_negative')}, {r6('sentiment_score', 'sentiment_score')}, "
                           "CAST(cluster_count AS BIGINT) AS cluster_count FROM ep")


@register("candidate_of_cluster")
def q_candidate_of_cluster(spark, sf_dir):
    """PF-6: first listed candidate contained in the cluster name."""
    return FC.with_candidate(_summary(spark, sf_dir), CANDS).select("time_label", "final_cluster", "candidate")


ORACLE["candidate_of_cluster"] = (f"WITH {ep_cte()}\nSELECT time_label, final_cluster, candidate FROM sc")


@register("cluster_phrase")
def q_cluster_phrase(spark, sf_dir):
    """PF-9: cluster name as a phrase for the text encoder."""
    s = _summary(spark, sf_dir).select("final_cluster").distinct()
    return s.select("final_cluster", T.cluster_phrase(F.col("final_cluster")).alias("phrase"))


ORACLE["cluster_phrase"] = (f"WITH {detail_cte()}\nSELECT final_cluster, coalesce(replace(final_cluster, '_', "
                            "' 관련 '), '알 수 없음') AS phrase FROM (SELECT DISTINCT final_cluster FROM summary)")


@register("period_x_entity")
def q_period_x_entity(spark, sf_dir):
    """J-8: the dense period x candidate grid with its fill-in flag."""
    ep = _ep(spark, sf_dir)
    return ep.select("time_label", "candidate", (F.col("cluster_count") == 0).alias("filled_default"))


ORACLE["period_x_entity"] = (f"WITH {ep_cte()}\nSELECT time_label, candidate, cluster_count = 0 AS filled_default "
                             "FROM ep")


@register("group_mean_vector")
def q_group_mean_vector(spark, sf_dir):
    """A-11: element-wise mean vector per topic (long form)."""
    mv = V.mean_vector(FX.topic_base(spark, sf_dir), ["topic_id"], "embedding", "vector")
    return mv.select("topic_id", F.posexplode("vector").alias("pos", "value"))


ORACLE["group_mean_vector"] = (
    f"WITH {ta_cte()}\nSELECT CAST(topic_id AS BIGINT) AS topic_id, CAST(r.i - 1 AS BIGINT) AS pos, "
    f"{r6('avg(embedding[r.i])', 'value')} FROM ta_base, range(1, 65) r(i) GROUP BY topic_id, r.i")


@register("cluster_x_embedding")
def q_cluster_x_embedding(spark, sf_dir):
    """J-9: each summary cluster with its vector (long form); clusters without
    a vector would drop out here."""
    s = _summary(spark, sf_dir).select("time_label", "final_cluster")
    cv = FX.cluster_vectors(spark, sf_dir, DIM)
    return (s.join(cv, "final_cluster")
            .select("time_label", "final_cluster", F.posexplode("vector").alias("pos", "value")))


ORACLE["cluster_x_embedding"] = (
    f"WITH {ep_cte()}\nSELECT s.time_label, s.final_cluster, CAST(r.i - 1 AS BIGINT) AS pos, "
    f"{r6('cv.vector[r.i]', 'value')} FROM summary s JOIN cvec cv USING (final_cluster), range(1, {DIM + 1}) r(i)")


@register("entity_vector")
def q_entity_vector(spark, sf_dir):
    """F-2: mean cluster vector per (period, candidate); zeros if none (long form)."""
    return _ep(spark, sf_dir).select("time_label", "candidate", F.posexplode("embedding").alias("pos", "value"))


ORACLE["entity_vector"] = (
    f"WITH {ep_cte()}\nSELECT time_label, candidate, CAST(r.i - 1 AS BIGINT) AS pos, "
    f"{r6('embedding[r.i]', 'value')} FROM ep, range(1, {DIM + 1}) r(i)")


def _wide_sql(cols_per_cand):
    parts = []
    for c in CANDS:
        for name, expr in cols_per_cand:
            parts.append(f"max(CASE WHEN candidate = {q(c)} THEN {expr} END) AS {c}_{name}")
    return ", ".join(parts)


PIVOT_COLS = ([("positive", rnd("avg_positive")), ("negative", rnd("avg_negative")),
               ("sentiment", rnd("sentiment_score")), ("cluster_count", "CAST(cluster_count AS BIGINT)")]
              + [(f"embedding_{i}", rnd(f"embedding[{i + 1}]")) for i in range(DIM)])


@register("pivot_features")
def q_pivot_features(spark, sf_dir):
    """F-3: one wide row per period over the explicit candidate list."""
    return FC.pivot_features(_ep(spark, sf_dir), CANDS, DIM)


ORACLE["pivot_features"] = f"WITH {ep_cte()}\nSELECT time_label, {_wide_sql(PIVOT_COLS)} FROM ep GROUP BY time_label"


@register("relative_sentiment")
def q_relative_sentiment(spark, sf_dir):
    """F-4: share of the period's summed sentiment; 1/n when the sum is 0."""
    return FC.relative_sentiment(_ep(spark, sf_dir), len(CANDS)).select("time_label", "candidate",
                                                                         "relative_sentiment")


REL_SQL = (f"CASE WHEN sum(sentiment_score) OVER (PARTITION BY time_label) <> 0 THEN sentiment_score / "
           f"sum(sentiment_score) OVER (PARTITION BY time_label) ELSE {1.0 / len(CANDS)!r} END")
ORACLE["relative_sentiment"] = (f"WITH {ep_cte()}\nSELECT time_label, candidate, {r6(REL_SQL, 'relative_sentiment')} "
                                "FROM ep")


@register("relative_share")
def q_relative_share(spark, sf_dir):
    """T-21: share of the period total of the candidates' cluster counts."""
    ep = _ep(spark, sf_dir).withColumn("sentiment_score", F.col("cluster_count").cast("double"))
    return FC.relative_sentiment(ep, len(CANDS)).select("time_label", "candidate",
                                                         F.col("relative_sentiment").alias("share"))


ORACLE["relative_share"] = (
    f"WITH {ep_cte()}\nSELECT time_label, candidate, "
    + r6(f"CASE WHEN sum(cluster_count) OVER (PARTITION BY time_label) <> 0 THEN cluster_count / "
         f"sum(cluster_count) OVER (PARTITION BY time_label) ELSE {1.0 / len(CANDS)!r} END", "share") + " FROM ep")

PAIRS_SQL = """pairs AS (SELECT a.time_label, a.candidate AS a, b.candidate AS b, a.embedding AS va, b.embedding AS vb
  FROM ep a JOIN ep b ON a.time_label = b.time_label AND a.cand_ord < b.cand_ord)"""


@register("entity_pairs")
def q_entity_pairs(spark, sf_dir):
    """J-10: unordered candidate pairs i < j per period (theta self-join)."""
    return FC.pair_similarity(_ep(spark, sf_dir)).select("time_label", "a", "b")


ORACLE["entity_pairs"] = f"WITH {ep_cte()},\n{PAIRS_SQL}\nSELECT time_label, a, b FROM pairs"


def _cos(a, b):
    den = f"({norm_sql(a)} * {norm_sql(b)})"
    return f"(CASE WHEN {den} = 0 THEN 0.0 ELSE {dot_sql(a, b)} / {den} END)"


@register("pair_similarity")
def q_pair_similarity(spark, sf_dir):
    """F-5: cosine of every candidate pair per period (zero vector -> 0)."""
    return FC.pair_similarity(_ep(spark, sf_dir))


ORACLE["pair_similarity"] = (f"WITH {ep_cte()},\n{PAIRS_SQL}\nSELECT time_label, a, b, "
                             f"{r6(_cos('va', 'vb'), 'similarity')} FROM pairs")


@register("embedding_strength")
def q_embedding_strength(spark, sf_dir):
    """F-5: L2 norm of each candidate's period vector."""
    return FC.embedding_strength(_ep(spark, sf_dir)).select("time_label", "candidate", "embedding_strength")


ORACLE["embedding_strength"] = (f"WITH {ep_cte()}\nSELECT time_label, candidate, "
                                f"{r6(norm_sql('embedding'), 'embedding_strength')} FROM ep")

STATS_SQL = """st AS (SELECT time_label, avg(x) AS embedding_mean, stddev_pop(x) AS embedding_std,
                   max(x) AS embedding_max, min(x) AS embedding_min
            FROM (SELECT time_label, unnest(embedding) AS x FROM ep) GROUP BY time_label)"""


@register("matrix_stats")
def q_matrix_stats(spark, sf_dir):
    """A-14: mean / population std / max / min of all vector elements per period."""
    return FC.embedding_stats(_ep(spark, sf_dir))


ORACLE["matrix_stats"] = (f"WITH {ep_cte()},\n{STATS_SQL}\nSELECT time_label, {r6('embedding_mean', 'embedding_mean')}, "
                          f"{r6('embedding_std', 'embedding_std')}, {r6('embedding_max', 'embedding_max')}, "
                          f"{r6('embedding_min', 'embedding_min')} FROM st")


@register("embedding_stats")
def q_embedding_stats(spark, sf_dir):
    """F-6: the statistics appended to the wide feature row."""
    ep = _ep(spark, sf_dir)
    wide = FC.pivot_features(ep, CANDS, DIM).select("time_label", *[f"{c}_sentiment" for c in CANDS])
    return wide.join(FC.embedding_stats(ep), "time_label")


ORACLE["embedding_stats"] = (
    f"WITH {ep_cte()},\n{STATS_SQL}\nSELECT w.time_label, "
    + ", ".join(f"w.{c}_sentiment" for c in CANDS)
    + f", {r6('embedding_mean', 'embedding_mean')}, {r6('embedding_std', 'embedding_std')}, "
      f"{r6('embedding_max', 'embedding_max')}, {r6('embedding_min', 'embedding_min')} FROM (SELECT time_label, "
    + _wide_sql([("sentiment", rnd("sentiment_score"))]) + " FROM ep GROUP BY time_label) w JOIN st USING (time_label)")


@register("features")
def q_features(spark, sf_dir):
    """F-3 .. F-6 assembled: the full wide feature row per period."""
    return FC.features(_ep(spark, sf_dir), CANDS, DIM)


def features_sql() -> str:
    """The parts' SQL (F-3 .. F-6) joined on the period: an independent
    assembly of what ``features`` computes in one aggregation."""
    pairs = [(CANDS[i], CANDS[j]) for i in range(len(CANDS)) for j in range(i + 1, len(CANDS))]
    sim = ", ".join(f"max(CASE WHEN a = {q(a)} AND b = {q(b)} THEN {rnd(_cos('va', 'vb'))} END) AS similarity_{a}_{b}"
                    for a, b in pairs)
    return (f"WITH {ep_cte()},\n{STATS_SQL},\n{PAIRS_SQL},\n"
            f"w AS (SELECT time_label, {_wide_sql(PIVOT_COLS)} FROM ep GROUP BY time_label),\n"
            f"rel AS (SELECT time_label, {_wide_sql([('relative_sentiment', rnd('rs'))])} FROM ("
            f"SELECT *, {REL_SQL} AS rs FROM ep) GROUP BY time_label),\n"
            f"strw AS (SELECT time_label, {_wide_sql([('embedding_strength', rnd(norm_sql('embedding')))])} "
            "FROM ep GROUP BY time_label),\n"
            f"simw AS (SELECT time_label, {sim} FROM pairs GROUP BY time_label)\n"
            "SELECT w.*, rel.* EXCLUDE (time_label), simw.* EXCLUDE (time_label), strw.* EXCLUDE (time_label), "
            f"{rnd('embedding_mean')} AS embedding_mean, {rnd('embedding_std')} AS embedding_std, "
            f"{rnd('embedding_max')} AS embedding_max, {rnd('embedding_min')} AS embedding_min "
            "FROM w JOIN rel USING (time_label) JOIN simw USING (time_label) JOIN strw USING (time_label) "
            "JOIN st USING (time_label)")


ORACLE["features"] = features_sql()


# ---------------------------------------------------------------------------
# Targets from polls
# ---------------------------------------------------------------------------
def ranges_sql() -> str:
    return f"""ranges AS (
  SELECT o AS ordinal, CAST(trim(split_part(r, ':', 1)) AS DATE) AS start_day, CAST(trim(split_part(r, ':', 2)) AS DATE) AS end_day
  FROM (SELECT unnest(s) AS r, unnest(range(1, len(s) + 1)) AS o FROM (SELECT string_split('{FX.POLL_RANGES_SPEC}', ',') AS s)))"""


POLLS_SQL = f"""polls AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS date, l_extendedprice AS cand_0,
                   l_discount AS cand_1, l_tax AS cand_2, l_quantity AS weight FROM lineitem),
{ranges_sql()},
pj AS (SELECT r.ordinal, p.* FROM polls p JOIN ranges r
       ON p.date >= CAST(r.start_day AS TIMESTAMP) AND p.date <= CAST(r.end_day AS TIMESTAMP)
       WHERE p.date IS NOT NULL AND p.cand_0 IS NOT NULL AND p.cand_1 IS NOT NULL AND p.cand_2 IS NOT NULL
         AND p.weight IS NOT NULL),
targets AS (SELECT {', '.join(f'sum({c} * weight) / sum(weight) AS {c}' for c in CANDS)}, ordinal AS time_label
            FROM pj GROUP BY ordinal HAVING sum(weight) <> 0)"""


def _targets(spark, sf_dir):
    return FC.weighted_target(FX.polls(spark, sf_dir), FX.ranges(spark), CANDS)


@register("weighted_target")
def q_weighted_target(spark, sf_dir):
    """A-4: weighted mean per range; empty / zero-weight ranges skipped."""
    return _targets(spark, sf_dir)


ORACLE["weighted_target"] = (f"WITH {POLLS_SQL}\nSELECT " + ", ".join(r6(c, c) for c in CANDS)
                             + ", CAST(time_label AS BIGINT) AS time_label FROM targets")


@register("poll_range_join")
def q_poll_range_join(spark, sf_dir):
    """J-7: rows per range of the inclusive (midnight-bounded) range join."""
    j = FC.poll_range_join(FX.polls(spark, sf_dir), FX.ranges(spark))
    return j.groupBy("ordinal").agg(F.count("*").alias("n_rows"), F.min("date").alias("first"),
                                    F.max("date").alias("last"))


ORACLE["poll_range_join"] = (f"WITH {POLLS_SQL}\nSELECT CAST(ordinal AS BIGINT) AS ordinal, count(*) AS n_rows, "
                             "strftime(min(date), '%Y-%m-%d %H:%M:%S.%f') AS first, "
                             "strftime(max(date), '%Y-%m-%d %H:%M:%S.%f') AS last FROM pj GROUP BY ordinal")


@register("coerce_numeric")
def q_coerce_numeric(spark, sf_dir):
    """PF-3: non-numeric values become null."""
    p = FX.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return coerce_numeric(p, ["p_brand", "p_size", "p_retailprice"])


ORACLE["coerce_numeric"] = ("SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS p_brand, "
                            "TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE) AS p_size, "
                            f"{r6('TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE)', 'p_retailprice')} FROM part")


@register("require_values")
def q_require_values(spark, sf_dir):
    """PF-2: drop rows missing a required value (comments without a label)."""
    c = FX.comments(spark, sf_dir, overlay=False).select("comment_id")
    lab = FX.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("comment_id"), "quality")
    return require_values(c.join(lab, "comment_id", "left"), ["quality"])


ORACLE["require_values"] = ("SELECT d.doc_id AS comment_id, CAST(l.quality AS BIGINT) AS quality FROM documents d "
                            "LEFT JOIN labels l ON l.doc_id = d.doc_id "
                            "WHERE l.quality IS NOT NULL")


# ---------------------------------------------------------------------------
# Period split and the training table
# ---------------------------------------------------------------------------
def _feature_ordinals(spark, sf_dir):
    ep = _ep(spark, sf_dir)
    return FC.period_ordinals(ep)


@register("pick_label_split")
def q_pick_label_split(spark, sf_dir):
    """PF-11: train = target periods; predict = feature periods without a target."""
    feats = _feature_ordinals(spark, sf_dir).select(F.col("ordinal").alias("time_label"))
    return FC.pick_label_split(feats, _targets(spark, sf_dir))


PERIODS_SQL = "periods AS (SELECT time_label AS label, row_number() OVER (ORDER BY time_label) AS ordinal " \
              "FROM (SELECT DISTINCT time_label FROM ep))"

ORACLE["pick_label_split"] = (
    f"WITH {ep_cte()},\n{POLLS_SQL},\n{PERIODS_SQL}\n"
    "SELECT CAST(time_label AS BIGINT) AS time_label, 'train' AS role FROM targets UNION ALL "
    "SELECT CAST(ordinal AS BIGINT), 'predict' FROM periods WHERE ordinal NOT IN (SELECT time_label FROM targets)")


@register("except_labels")
def q_except_labels(spark, sf_dir):
    """S-3: feature periods minus target periods."""
    feats = _feature_ordinals(spark, sf_dir).select(F.col("ordinal").alias("time_label"))
    return feats.join(_targets(spark, sf_dir).select("time_label"), "time_label", "left_anti")


ORACLE["except_labels"] = (f"WITH {ep_cte()},\n{POLLS_SQL},\n{PERIODS_SQL}\nSELECT CAST(ordinal AS BIGINT) AS "
                           "time_label FROM periods WHERE ordinal NOT IN (SELECT time_label FROM targets)")


def _training_table(spark, sf_dir):
    ep = _ep(spark, sf_dir)
    feats = FC.features(ep, CANDS, DIM)
    per = FC.period_ordinals(ep).withColumnRenamed("time_label", "label")
    feats = feats.join(per, feats.time_label == per.label).drop("label")
    tg = _targets(spark, sf_dir).select("time_label", *[F.col(c).alias(f"target_{c}") for c in CANDS])
    return FC.features_x_target(feats.withColumnRenamed("time_label", "label")
                                .withColumnRenamed("ordinal", "time_label"), tg)


@register("features_x_target")
def q_features_x_target(spark, sf_dir):
    """J-1: features joined to targets on the period key (the period ordinal)."""
    t = _training_table(spark, sf_dir)
    return t.select("time_label", "label", *[f"{c}_sentiment" for c in CANDS], *[f"target_{c}" for c in CANDS])


ORACLE["features_x_target"] = (
    f"WITH {ep_cte()},\n{POLLS_SQL},\n{PERIODS_SQL}\nSELECT CAST(p.ordinal AS BIGINT) AS time_label, p.label, "
    + ", ".join(f"w.{c}_sentiment" for c in CANDS) + ", "
    + ", ".join(r6(f"t.{c}", f"target_{c}") for c in CANDS)
    + " FROM (SELECT time_label, " + _wide_sql([("sentiment", rnd("sentiment_score"))])
    + " FROM ep GROUP BY time_label) w JOIN periods p ON w.time_label = p.label JOIN targets t ON t.time_label = "
      "p.ordinal")


@register("row_percent")
def q_row_percent(spark, sf_dir):
    """T-20: targets as percentages of their row sum."""
    return FC.row_percent(_targets(spark, sf_dir), CANDS)


_ROWSUM = " + ".join(CANDS)
ORACLE["row_percent"] = (f"WITH {POLLS_SQL}\nSELECT " + ", ".join(r6(f"{c} / ({_ROWSUM}) * 100", c) for c in CANDS)
                         + ", CAST(time_label AS BIGINT) AS time_label FROM targets")


@register("mae_percent")
def q_mae_percent(spark, sf_dir):
    """E-6: absolute error per (period, target) between row-percent targets and
    the uniform forecast (the prediction for unfitted targets)."""
    actual = FC.row_percent(_targets(spark, sf_dir), CANDS)
    pred = actual.select("time_label", *[F.lit(100.0 / len(CANDS)).alias(c) for c in CANDS])
    return EV.mae_percent(actual, pred, ["time_label"], CANDS)


ORACLE["mae_percent"] = (
    f"WITH {POLLS_SQL},\nrp AS (SELECT time_label, " + ", ".join(f"{c} / ({_ROWSUM}) * 100 AS {c}" for c in CANDS)
    + " FROM targets)\nSELECT CAST(time_label AS BIGINT) AS time_label, target, " + r6("actual", "actual") + ", "
    + r6(repr(100.0 / len(CANDS)), "predicted") + ", "
    + r6(f"abs(actual - {100.0 / len(CANDS)!r})", "abs_error")
    + " FROM (UNPIVOT rp ON " + ", ".join(CANDS) + " INTO NAME target VALUE actual)")
