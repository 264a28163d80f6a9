"""Registered queries for the model stages (2.10, E-2 .. E-4, E-7) and the
guided topic model (M-6, T-18, T-19, E-3).

ML fits are checked rows-only (their outputs depend on optimisers); the guided
topic model is deterministic joins, windows and aggregates, so it has a SQL
oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import embed as EM
from murmur.operators import evaluate as EV
from murmur.operators import forecast as FC
from murmur.operators import sentiment as SE
from murmur.operators import topics as TP
from murmur.operators.neighbours import written
from murmur.plans.catalog import register
from murmur.plans.oracle import ORACLE, comments_cte, q, r6
from murmur.plans.q_forecast import CANDS, _targets
from murmur.plans.q_topics import CTFIDF_SQL, TEST_ISSUE_AXIS, TEST_PERSON_AXIS, classify_sql, ta_cte
from murmur.functions import text as T
from murmur.session import ensure_checkpoint_dir
from murmur.sources import fixtures as FX

LETTER = T.LETTER_TOKEN
LDA_TOP_WORDS = 10

# Fitted models are shared by the queries that read them (same application,
# same input directory): a fit is deterministic given its seed and input. One fit of each kind is kept, the last one.
_FITS: dict = {}


def _memo(kind, spark, sf_dir, fit):
    key = (spark.sparkContext.applicationId, sf_dir)
    if _FITS.get(kind, (None,))[0] != key:
        _FITS[kind] = (key, fit())
    return _FITS[kind][1]


def _documents(spark, sf_dir):
    """Every document, with the period of its comment."""
    c = FX.comments(spark, sf_dir, overlay=False)
    return c.select(F.col("comment_id").alias("doc_id"), "time_label", "comment_text")


# ---------------------------------------------------------------------------
# M-1 / M-2 / E-4: LDA
# ---------------------------------------------------------------------------
def _lda(spark, sf_dir):
    return _memo("lda", spark, sf_dir, lambda: TP.lda_fit(_documents(spark, sf_dir), "comment_text", LETTER))


@register("lda_topics")
def q_lda_topics(spark, sf_dir):
    """M-1: online LDA (k=10, 20 passes, alpha 1.0, eta 0.1, seed 42): top words."""
    cv, lda, _ = _lda(spark, sf_dir)
    return TP.lda_top_words(spark, cv, lda, LDA_TOP_WORDS)


@register("lda_assign")
def q_lda_assign(spark, sf_dir):
    """M-2: dominant topic, probability and keywords of every document, in the contract."""
    cv, lda, feats = _lda(spark, sf_dir)
    kw = TP.keyword_map(TP.lda_top_words(spark, cv, lda, LDA_TOP_WORDS))
    return TP.lda_assign(feats, lda, kw)


@register("perplexity_lda")
def q_perplexity_lda(spark, sf_dir):
    """E-4: held-in perplexity of the fitted LDA, and the bound per word that it comes from."""
    _, lda, _ = _lda(spark, sf_dir)
    bound = lda.logPerplexity(lda.vectors)
    return spark.range(1).select(F.lit(-bound).alias("bound_per_word"), F.exp(F.lit(bound)).alias("perplexity"))


@register("lda_evaluation")
def q_lda_evaluation(spark, sf_dir):
    """E-1, E-2 of the fitted LDA by its own top words: coherence of each topic, and the diversity of all."""
    cv, lda, feats = _lda(spark, sf_dir)
    top = TP.lda_top_words(spark, cv, lda, LDA_TOP_WORDS)
    toks = feats.select(F.col("_tokens").alias("tokens"))
    return EV.coherence_of_documents(toks, top, LDA_TOP_WORDS).crossJoin(EV.topic_diversity(top, LDA_TOP_WORDS))


# ---------------------------------------------------------------------------
# M-3 / M-4 / M-5
# ---------------------------------------------------------------------------
@register("embed_text")
def q_embed_text(spark, sf_dir):
    """M-3: hashing encoder over every document (unit-norm vectors)."""
    e = EM.embed_text(_documents(spark, sf_dir), "comment_text", "embedding", "hashing", 256)
    return e.select("doc_id", "embedding")


@register("reduce_dims")
def q_reduce_dims(spark, sf_dir):
    """M-4: centred PCA of the comment vectors to 10 dimensions, rows normalised."""
    base = FX.topic_base(spark, sf_dir)
    red, explained = EM.reduce_dims(base, "embedding", 10)
    return red.select("comment_id", "reduced", F.lit(explained).alias("explained"))


@register("cluster_topics")
def q_cluster_topics(spark, sf_dir):
    """M-5: KMeans topics with a distance-quantile outlier class, in the contract."""
    # written once: distances read the vectors, keywords the texts, the result both
    out = TP.cluster_topics(written(FX.topic_base(spark, sf_dir), "topic-base"), "embedding", k=8)
    return TP.cluster_assign(out, pattern=LETTER, lower=True)


# ---------------------------------------------------------------------------
# M-7 / M-8: sentiment classifier
# ---------------------------------------------------------------------------
def _trained(spark, sf_dir):
    return _memo("sentiment", spark, sf_dir, lambda: SE.train_sentiment(FX.train_text(spark, sf_dir)))


@register("train_sentiment")
def q_train_sentiment(spark, sf_dir):
    """M-7: 90/10 split, hashed TF-IDF + logistic regression; held-out metrics."""
    _, metrics = _trained(spark, sf_dir)
    return metrics


@register("score_sentiment")
def q_score_sentiment(spark, sf_dir):
    """M-8: batch inference over every clustered comment, mapped by T-15."""
    model, _ = _trained(spark, sf_dir)
    cl = FX.clustered(spark, sf_dir).select("comment_id", "time_label", "final_cluster", "comment_text")
    return SE.score_sentiment(model, cl).select("comment_id", "time_label", "final_cluster", "sentiment_class")


# ---------------------------------------------------------------------------
# M-9 .. M-11: boosted trees per target, period by period
# ---------------------------------------------------------------------------
def _forecaster(spark, sf_dir):
    return _memo("forecast", spark, sf_dir, lambda: _fit_forecaster(spark, sf_dir))


GROUP_SEP = "#"


def _grouped_table(spark, sf_dir):
    """Features at the grain (period, channel), each row with its period's ordinal: the chain behind the period features, keyed
    by both. Written once, as the boosters read it many times."""
    cl = FX.clustered(spark, sf_dir, texts=False).withColumn("time_label", F.concat_ws(GROUP_SEP, "time_label", "channel"))
    cl = written(cl.select("comment_id", "time_label", "comment_text", "final_cluster", "candidate", "embedding"), "clustered")
    ep = FC.entity_period(FX.sentiment_summary(spark, sf_dir, cl), CANDS, FX.cluster_vectors(spark, sf_dir, FX.EMBEDDING_DIM, cl), FX.EMBEDDING_DIM)
    feats = FC.features(ep, CANDS, FX.EMBEDDING_DIM)
    feats = feats.withColumn("label", F.split_part("time_label", F.lit(GROUP_SEP), F.lit(1))).withColumn(
        "channel", F.split_part("time_label", F.lit(GROUP_SEP), F.lit(2))).drop("time_label")
    ensure_checkpoint_dir(spark)
    feats = feats.checkpoint(eager=True)
    per = FC.period_ordinals(feats, "label").withColumnRenamed("ordinal", "time_label")
    return feats.join(F.broadcast(per), "label")


def _training(spark, sf_dir):
    """(rows with features and targets, targets, feature names, periods in order, features alone), written once."""
    def make():
        feats = _grouped_table(spark, sf_dir)
        # targets as shares: the three measures have very different sizes
        tg = FC.row_percent(_targets(spark, sf_dir), CANDS).select("time_label", *[F.col(c).alias(f"target_{c}") for c in CANDS])
        train = FC.features_x_target(feats, tg).checkpoint(eager=True)
        targets = [f"target_{c}" for c in CANDS]
        names = [c for c in train.columns if c not in targets and c not in ("time_label", "label", "channel")]
        return train, targets, names, [r[0] for r in train.select("time_label").distinct().orderBy("time_label").collect()], feats
    return _memo("training", spark, sf_dir, make)


def _fit_forecaster(spark, sf_dir):
    train, targets, names, periods, feats = _training(spark, sf_dir)
    model = FC.SequentialForecaster(targets, names)
    for p in periods:
        model.fit_period(train.filter(F.col("time_label") == p))
    return model, train, periods, feats


@register("fit_per_target")
def q_fit_per_target(spark, sf_dir):
    """M-9: one booster per target column, a row for each (period, channel); in-sample predictions."""
    model, train, _, _ = _forecaster(spark, sf_dir)
    pred = model.predict(train)
    return pred.select("time_label", "channel", *[F.col(f"pred_target_{c}").alias(f"pred_{c}") for c in CANDS],
                       *[f"target_{c}" for c in CANDS])


@register("fit_sequential")
def q_fit_sequential(spark, sf_dir):
    """M-10: boosters continued period after period (residual stacking): predictions before and after each."""
    model, train, periods, _ = _forecaster(spark, sf_dir)
    return model.stage_errors(train, "time_label", periods, ["time_label", "channel"])


def _predicted(spark, sf_dir):
    model, _, _, feats = _forecaster(spark, sf_dir)
    pred = model.predict(feats)
    cols = [f"pred_target_{c}" for c in CANDS]
    means = pred.groupBy("time_label").agg(*[F.avg(c).alias(c) for c in cols])
    return FC.row_percent(means, cols)


@register("predict_targets")
def q_predict_targets(spark, sf_dir):
    """M-11: predictions for every feature period (means over its channels), as row percentages."""
    return _predicted(spark, sf_dir)


@register("mae_forecast")
def q_mae_forecast(spark, sf_dir):
    """E-6 on M-11: absolute error per (period, target) of the fitted model's predictions."""
    pred = _predicted(spark, sf_dir).select("time_label", *[F.col(f"pred_target_{c}").alias(c) for c in CANDS])
    return EV.mae_percent(FC.row_percent(_targets(spark, sf_dir), CANDS), pred, ["time_label"], CANDS)


# ---------------------------------------------------------------------------
# E-2 / E-7
# ---------------------------------------------------------------------------
def _assignments(spark, sf_dir):
    """The topic assignments with their tokens in place of the texts, written once for all metrics."""
    ta = FX.topic_assignments(spark, sf_dir)
    return TP.tokenised(ta, "comment_id", "comment_text", LETTER, lower=True, keep=["topic_id", "topic_prob"])


def _top(ta):
    counts = TP.bow(ta.select("topic_id", F.explode("tokens").alias("term")), "topic_id")
    return TP.top_words(TP.class_tfidf(counts, "topic_id"), TP.DIVERSITY_TOP_K).checkpoint(eager=True)


def _coherence(ta, top):
    return EV.coherence_of_documents(ta, top, 10)


@register("coherence_cv")
def q_coherence_cv(spark, sf_dir):
    """E-2: C_v coherence per topic (boolean window 110, NPMI, indirect cosine)."""
    ta = _assignments(spark, sf_dir)
    return _coherence(ta, _top(ta))


@register("model_report")
def q_model_report(spark, sf_dir):
    """E-7: one row of model metrics."""
    ta = _assignments(spark, sf_dir)
    top = _top(ta)
    return EV.model_report(
        coherence=_coherence(ta, top).agg(F.avg("coherence")),
        topic_diversity=EV.topic_diversity(top),
        perplexity=EV.perplexity_prob(ta),
        n_topics=ta.filter(F.col("topic_id") != TP.OUTLIER).agg(F.countDistinct("topic_id")))


# ---------------------------------------------------------------------------
# M-6 guided topics, T-18, T-19, E-3
# ---------------------------------------------------------------------------
GUIDED = TP.GUIDED_VOCAB
PERSONS = list(TEST_PERSON_AXIS) + ["neutral"]
ISSUES = list(TEST_ISSUE_AXIS)


def _guided(spark, sf_dir):
    n = FX.vector_count(spark, sf_dir)
    d = _documents(spark, sf_dir).withColumnRenamed("comment_text", "text")
    e = FX.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    docs = d.join(e, d.doc_id % n == e.vec_id).drop("vec_id")
    ensure_checkpoint_dir(spark)
    toks = TP.tokenised(docs, "doc_id", "text", LETTER, lower=True)
    vocab = TP.token_vocabulary(toks, GUIDED["min_df"], GUIDED["max_df"], GUIDED["max_features"])
    # at most max_features terms; the restricted bag of words feeds the word vectors, theta and perplexity: written once
    vbow = written(TP.vocabulary_counts(toks, [r.term for r in vocab.select("term").orderBy("term").collect()]), "guided-bow")
    topics, beta, theta = TP.guided_topics(docs, vbow, person_axis=TEST_PERSON_AXIS, person_default="neutral",
                                           issue_axis=TEST_ISSUE_AXIS, issue_default="general")
    return docs, topics, beta, theta, vbow


@register("vector_blend")
def q_vector_blend(spark, sf_dir):
    """T-18: topic vectors 0.6 person + 0.4 issue (long form)."""
    _, topics, _, _, _ = _guided(spark, sf_dir)
    return topics.select("topic_id", "person", "issue", F.posexplode("vector").alias("pos", "value"))


@register("softmax")
def q_softmax(spark, sf_dir):
    """T-19: topic-word beta = softmax over the vocabulary of cos(topic, word)."""
    _, _, beta, _, _ = _guided(spark, sf_dir)
    return beta.select("term", F.explode("beta").alias("topic_id", "beta"))


@register("guided_topics")
def q_guided_topics(spark, sf_dir):
    """M-6: document-topic theta by fold-in against beta, for every document."""
    _, _, _, theta, _ = _guided(spark, sf_dir)
    return theta.select("doc_id", F.explode("theta").alias("topic_id", "theta"))


@register("guided_assign")
def q_guided_assign(spark, sf_dir):
    """M-6: every document in the topic-assignment contract."""
    docs, _, beta, theta, _ = _guided(spark, sf_dir)
    return TP.guided_assign(docs.select("doc_id", "time_label", F.col("text").alias("comment_text")), theta, beta)


@register("perplexity_bow")
def q_perplexity_bow(spark, sf_dir):
    """E-3: exp(-sum n log(theta beta + 1e-8) / sum n)."""
    _, _, beta, theta, vbow = _guided(spark, sf_dir)
    return EV.perplexity_bow(vbow, theta, beta)


def _guided_sql() -> str:
    grid = ", ".join(f"({pi * len(ISSUES) + ii + 1}, {q(p)}, {q(i)})"
                     for pi, p in enumerate(PERSONS) for ii, i in enumerate(ISSUES))
    return f"""gdocs AS (SELECT d.doc_id, d.text, CAST(e.embedding AS DOUBLE[]) AS embedding
          FROM (SELECT *, doc_id % greatest(1, (SELECT count(*) FROM embeddings)) AS vid FROM documents) d
          JOIN embeddings e ON d.vid = e.vec_id),
gbow0 AS (SELECT doc_id, term, count(*) AS n
          FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), {q(LETTER)}, 1)) AS term FROM gdocs) GROUP BY ALL),
gst AS (SELECT term, count(*) AS df, sum(n) AS tf FROM gbow0 GROUP BY term),
gvocab AS (SELECT term FROM gst WHERE df >= {GUIDED['min_df']} AND df <= {GUIDED['max_df']} * (SELECT count(*) FROM gdocs)
           ORDER BY tf DESC, term LIMIT {GUIDED['max_features']}),
gbow AS (SELECT * FROM gbow0 WHERE term IN (SELECT term FROM gvocab)),
glab AS (SELECT doc_id, embedding, {classify_sql('text', TEST_PERSON_AXIS, 'neutral')} AS person,
                {classify_sql('text', TEST_ISSUE_AXIS, 'general')} AS issue FROM gdocs),
pv AS (SELECT person, r.i, avg(embedding[r.i]) AS v FROM glab, range(1, 65) r(i) GROUP BY ALL),
iv AS (SELECT issue, r.i, avg(embedding[r.i]) AS v FROM glab, range(1, 65) r(i) GROUP BY ALL),
ggrid AS (SELECT * FROM (VALUES {grid}) t(topic_id, person, issue)),
tvec AS (SELECT g.topic_id, g.person, g.issue, pv.i, pv.v * {TP.GUIDED_WEIGHTS[0]} + iv.v * {TP.GUIDED_WEIGHTS[1]} AS v
         FROM ggrid g JOIN pv ON pv.person = g.person JOIN iv ON iv.issue = g.issue AND iv.i = pv.i),
wvec AS (SELECT b.term, r.i, avg(d.embedding[r.i]) AS v FROM gbow b JOIN gdocs d USING (doc_id), range(1, 65) r(i)
         GROUP BY ALL),
tn AS (SELECT topic_id, sqrt(sum(v * v)) AS nt FROM tvec GROUP BY topic_id),
wn AS (SELECT term, sqrt(sum(v * v)) AS nw FROM wvec GROUP BY term),
sims AS (SELECT t.topic_id, w.term, CASE WHEN tn.nt * wn.nw = 0 THEN 0.0 ELSE sum(t.v * w.v) / (tn.nt * wn.nw) END AS logit
         FROM tvec t JOIN wvec w USING (i) JOIN tn USING (topic_id) JOIN wn USING (term)
         GROUP BY t.topic_id, w.term, tn.nt, wn.nw),
b1 AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY topic_id)) AS e FROM sims),
beta AS (SELECT topic_id, term, e / sum(e) OVER (PARTITION BY topic_id) AS beta FROM b1),
dlen AS (SELECT doc_id, sum(n) AS len FROM gbow GROUP BY doc_id),
sc AS (SELECT b.doc_id, be.topic_id, sum(b.n / (d.len + 1e-8) * ln(be.beta)) AS s
       FROM gbow b JOIN dlen d USING (doc_id) JOIN beta be USING (term) GROUP BY ALL),
t1 AS (SELECT *, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM sc),
theta AS (SELECT doc_id, topic_id, e / sum(e) OVER (PARTITION BY doc_id) AS theta FROM t1
          UNION ALL
          SELECT g.doc_id, t.topic_id, 1.0 / (SELECT count(DISTINCT topic_id) FROM tvec)
          FROM gdocs g, (SELECT DISTINCT topic_id FROM tvec) t WHERE g.doc_id NOT IN (SELECT doc_id FROM gbow))"""


ORACLE["vector_blend"] = (f"WITH {_guided_sql()}\nSELECT CAST(topic_id AS BIGINT) AS topic_id, person, issue, "
                          f"CAST(i - 1 AS BIGINT) AS pos, {r6('v', 'value')} FROM tvec")
ORACLE["softmax"] = f"WITH {_guided_sql()}\nSELECT CAST(topic_id AS BIGINT) AS topic_id, term, {r6('beta', 'beta')} FROM beta"
ORACLE["guided_topics"] = (f"WITH {_guided_sql()}\nSELECT doc_id, CAST(topic_id AS BIGINT) AS topic_id, "
                           f"{r6('theta', 'theta')} FROM theta")
ORACLE["guided_assign"] = f"""WITH {_guided_sql()}, {comments_cte(False, 'plain')},
kw AS (SELECT topic_id, string_agg(term, ', ' ORDER BY rk) AS topic_keywords
       FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY round(beta, {TP.TIE_DIGITS}) DESC, term) AS rk FROM beta) WHERE rk <= {TP.TOP_K_KEYWORDS}
       GROUP BY topic_id),
own AS (SELECT doc_id, topic_id, theta FROM theta
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(theta, {TP.TIE_DIGITS}) DESC, topic_id) = 1)
SELECT p.comment_id, p.time_label, p.comment_text, CAST(o.topic_id AS BIGINT) AS topic_id, {r6('o.theta', 'topic_prob')},
       kw.topic_keywords, 'etm' AS topic_method
FROM plain p JOIN own o ON o.doc_id = p.comment_id JOIN kw USING (topic_id)"""
ORACLE["perplexity_bow"] = f"""WITH {_guided_sql()},
pp AS (SELECT b.doc_id, b.term, any_value(b.n) AS n, sum(t.theta * be.beta) AS p
       FROM gbow b JOIN theta t USING (doc_id) JOIN beta be ON be.topic_id = t.topic_id AND be.term = b.term
       GROUP BY b.doc_id, b.term)
SELECT {r6(f'exp(-sum(n * ln(p + {EV.EPS_PERPLEXITY})) / (SELECT sum(n) FROM gbow WHERE doc_id IN (SELECT doc_id FROM theta)))', 'perplexity')}
FROM pp"""


# ---------------------------------------------------------------------------
# The whole chain
# ---------------------------------------------------------------------------
@register("opinion_chain")
def q_opinion_chain(spark, sf_dir):
    """Comments -> bot filter -> topics -> clusters -> trained sentiment -> summaries -> entity features, each stage fed by the one before."""
    from murmur import pipeline as PL
    return PL.entity_features(FX.comments(spark, sf_dir), FX.train_text(spark, sf_dir), CANDS, pattern=LETTER, lower=True)


def _coherence_sql() -> str:
    """C_v by its definition: the words present in every window start, counted by topic and set of words."""
    w = EV.CV_WINDOW
    return f"""{ta_cte()},
{CTFIDF_SQL},
cw AS (SELECT topic_id, term, rk - 1 AS bit
       FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS rk FROM ctf) WHERE rk <= 10),
ctok AS (SELECT comment_id, unnest(t) AS term, unnest(range(len(t))) AS pos
         FROM (SELECT comment_id, regexp_extract_all(lower(comment_text), {q(LETTER)}, 1) AS t FROM topic_assignments)),
cwin AS (SELECT comment_id, greatest(1, max(pos) + 1 - {w} + 1) AS nwin FROM ctok GROUP BY comment_id),
cpres AS (SELECT DISTINCT topic_id, comment_id, bit, unnest(range(greatest(0, pos - {w} + 1), least(pos, nwin - 1) + 1)) AS start
          FROM ctok JOIN cw USING (term) JOIN cwin USING (comment_id)),
cmask AS (SELECT topic_id, mask, count(*) AS cnt
          FROM (SELECT topic_id, comment_id, start, bit_or(CAST(1 AS BIGINT) << bit) AS mask FROM cpres GROUP BY ALL) GROUP BY ALL),
cn AS (SELECT CAST(sum(nwin) AS DOUBLE) AS n FROM cwin),
c1 AS (SELECT w.topic_id, w.bit, coalesce(sum(m.cnt), 0) AS c
       FROM cw w LEFT JOIN cmask m ON m.topic_id = w.topic_id AND (m.mask >> w.bit) & 1 = 1 GROUP BY ALL),
c2 AS (SELECT a.topic_id, a.bit AS i, b.bit AS j, coalesce(sum(m.cnt), 0) AS c
       FROM cw a JOIN cw b USING (topic_id)
       LEFT JOIN cmask m ON m.topic_id = a.topic_id AND (m.mask >> a.bit) & 1 = 1 AND (m.mask >> b.bit) & 1 = 1 GROUP BY ALL),
cnp AS (SELECT g.topic_id, i, j, CASE WHEN i = j THEN 1.0 ELSE
               coalesce(ln((g.c / n + {EV.EPS_NPMI}) / ((a.c / n) * (b.c / n))) / -ln(g.c / n + {EV.EPS_NPMI}), 0.0) END AS v
        FROM c2 g JOIN c1 a ON a.topic_id = g.topic_id AND a.bit = i JOIN c1 b ON b.topic_id = g.topic_id AND b.bit = j, cn),
csum AS (SELECT topic_id, j, sum(v) AS s FROM cnp GROUP BY ALL),
ccos AS (SELECT topic_id, i, sum(v * s) / (sqrt(sum(v * v)) * sqrt(sum(s * s))) AS c FROM cnp JOIN csum USING (topic_id, j) GROUP BY ALL),
coh AS (SELECT topic_id, avg(c) AS coherence FROM ccos GROUP BY topic_id)"""


ORACLE["coherence_cv"] = (f"WITH {_coherence_sql()}\nSELECT CAST(topic_id AS BIGINT) AS topic_id, {r6('coherence', 'coherence')} FROM coh")
ORACLE["model_report"] = f"""WITH {_coherence_sql()},
dw AS (SELECT term FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS rk FROM ctf)
       WHERE rk <= {TP.DIVERSITY_TOP_K})
SELECT {r6('(SELECT avg(coherence) FROM coh)', 'coherence')},
       {r6('(SELECT count(DISTINCT term) / count(*) FROM dw)', 'topic_diversity')},
       {r6('(SELECT exp(-avg(ln(topic_prob))) FROM topic_assignments WHERE topic_prob > 0)', 'perplexity')},
       (SELECT count(DISTINCT topic_id) FROM topic_assignments WHERE topic_id <> -1) AS n_topics"""
