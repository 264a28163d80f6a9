"""Registered queries for text, topics, clustering and sentiment (2.8, K-2,
K-3, K-5, W-2, W-3, J-4 .. J-6, A-3, A-6 .. A-9, A-12, A-13, S-4, E-1, E-5,
PF-5, PF-7, PF-8) with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.functions import vectors as V
from murmur.operators import clustering as CL
from murmur.operators import evaluate as EV
from murmur.operators import sentiment as SE
from murmur.operators import topics as TP
from murmur.plans.catalog import register
from murmur.plans.oracle import ORACLE, comments_cte, q, r6
from murmur.sources import fixtures as FX

WS = T.WS_RUN
LETTER = T.LETTER_TOKEN


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, " + q(f"^{WS}|{WS}$") + ", '', 'g')"


# ---------------------------------------------------------------------------
# Fixture CTEs (SQL side)
# ---------------------------------------------------------------------------
def abs_all(v: str) -> str:
    return f"list_transform({v}, lambda x: abs(x))"


def ta_cte() -> str:
    return f"""{comments_cte(False, 'plain')},
ta_base AS (
  SELECT c.comment_id, c.time_label, c.comment_text, c.channel,
         CAST(CASE WHEN e.label = {FX.OUTLIER_LABEL} THEN -1 ELSE e.label END AS INTEGER) AS topic_id,
         CAST(e.embedding AS DOUBLE[]) AS embedding
  FROM (SELECT *, comment_id % greatest(1, (SELECT count(*) FROM embeddings)) AS vid FROM plain) c JOIN embeddings e ON c.vid = e.vec_id),
ta_cnt AS (
  SELECT topic_id, term, count(*) AS n
  FROM (SELECT topic_id, unnest(regexp_extract_all(lower(comment_text), {q(LETTER)}, 1)) AS term FROM ta_base)
  GROUP BY ALL),
ta_kw AS (
  SELECT topic_id, CASE WHEN topic_id = -1 THEN 'outlier' ELSE string_agg(term, ', ' ORDER BY rk) END AS topic_keywords
  FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY n DESC, term) AS rk FROM ta_cnt)
  WHERE rk <= {TP.TOP_K_KEYWORDS} GROUP BY topic_id),
topic_assignments AS (
  SELECT b.comment_id, b.time_label, b.comment_text, b.topic_id,
         (CASE WHEN b.topic_id >= 0 AND b.topic_id < len(b.embedding) THEN abs(b.embedding[b.topic_id + 1])
               ELSE list_max({abs_all('b.embedding')}) END) / list_sum({abs_all('b.embedding')}) AS topic_prob,
         coalesce(k.topic_keywords, 'topic_' || b.topic_id) AS topic_keywords,
         '{FX.FIXTURE_METHOD}' AS topic_method, b.embedding, b.channel
  FROM ta_base b LEFT JOIN ta_kw k USING (topic_id))"""


def dot_sql(a: str, b: str) -> str:
    return f"list_sum(list_transform({a}, lambda x, i: x * {b}[i]))"


def norm_sql(a: str) -> str:
    return f"sqrt(list_sum(list_transform({a}, lambda x: x * x)))"


def cos_sql(a: str, b: str) -> str:
    den = f"({norm_sql(a)} * {norm_sql(b)})"
    return f"(CASE WHEN {den} = 0 THEN 0.0 ELSE {dot_sql(a, b)} / {den} END)"


def topic_label_sql(kw: str, tid: str) -> str:
    k = strip_sql(f"coalesce({kw}, '')")
    first = strip_sql(f"split_part({k}, ',', 1)")
    clean = f"regexp_replace({first}, {q(WS)}, '_', 'g')"
    return (f"(CASE WHEN {k} = '' OR lower({k}) = 'nan' OR {clean} = '' THEN 'topic_' || CAST({tid} AS VARCHAR) "
            f"ELSE {clean} END)")


def clustered_cte() -> str:
    return f"""{ta_cte()},
cands AS (SELECT CAST(vec_id AS INTEGER) AS ord, 'cand_' || vec_id AS candidate, CAST(embedding AS DOUBLE[]) AS cvec
          FROM embeddings WHERE vec_id < {FX.N_CANDIDATES}),
scored AS (SELECT t.*, c.candidate, c.ord, {cos_sql('t.embedding', 'c.cvec')} AS score
           FROM topic_assignments t, cands c WHERE t.comment_text IS NOT NULL),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY score DESC, ord) = 1),
clustered AS (SELECT *, {topic_label_sql('topic_keywords', 'topic_id')} AS topic_label,
                     {topic_label_sql('topic_keywords', 'topic_id')} || '_' || candidate AS final_cluster FROM best)"""


def detail_cte() -> str:
    return f"""{clustered_cte()},
classes AS (SELECT doc_id AS comment_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
                   ELSE 'neutral' END AS sentiment_class FROM labels),
detail AS (SELECT c.*, coalesce(s.sentiment_class, 'neutral') AS sentiment_class
           FROM clustered c LEFT JOIN classes s USING (comment_id)),
summary AS (
  SELECT final_cluster,
         round_even(avg(CAST(sentiment_class = 'positive' AS DOUBLE)), 6) AS positive,
         round_even(avg(CAST(sentiment_class = 'negative' AS DOUBLE)), 6) AS negative,
         round_even(avg(CAST(sentiment_class = 'neutral' AS DOUBLE)), 6) AS neutral,
         count(*) AS total_comments, time_label, '{FX.FIXTURE_MODEL_PATH}' AS model_path
  FROM detail WHERE comment_text IS NOT NULL AND final_cluster IS NOT NULL AND time_label IS NOT NULL
  GROUP BY time_label, final_cluster)"""


def docs_tokens_sql(lower: bool = False) -> str:
    t = "lower(text)" if lower else "text"
    return f"(SELECT doc_id, unnest(regexp_extract_all({t}, {q(LETTER)}, 1)) AS term FROM documents)"


# ---------------------------------------------------------------------------
# Text functions on documents
# ---------------------------------------------------------------------------
def _docs(spark, sf_dir):
    return FX.spread(FX.table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("hangul_tokens")
def q_hangul_tokens(spark, sf_dir):
    """T-4: regex tokens (letter-run pattern on testdata; Hangul by default)."""
    toks = T.regex_tokens("text", LETTER)
    return _docs(spark, sf_dir).select("doc_id", F.size(toks).alias("n_tokens"),
                                       F.size(F.array_distinct(toks)).alias("n_distinct"))


ORACLE["hangul_tokens"] = (f"SELECT doc_id, len(regexp_extract_all(text, {q(LETTER)}, 1)) AS n_tokens, "
                           f"len(list_distinct(regexp_extract_all(text, {q(LETTER)}, 1))) AS n_distinct FROM documents")


@register("ws_tokens")
def q_ws_tokens(spark, sf_dir):
    """T-5: whitespace tokens of length >= 2."""
    return _docs(spark, sf_dir).select("doc_id", F.size(T.ws_tokens("text")).alias("n_ws_tokens"))


ORACLE["ws_tokens"] = (f"SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), {q(WS)}), "
                       "lambda x: length(x) >= 2)) AS n_ws_tokens FROM documents")

TEST_KEYWORDS = ["the", "eau", "sch", "ción"]


@register("keyword_count")
def q_keyword_count(spark, sf_dir):
    """T-6: non-overlapping keyword occurrences in lower-cased text."""
    cols = [T.keyword_count("text", k).alias(f"n_{i}") for i, k in enumerate(TEST_KEYWORDS)]
    return _docs(spark, sf_dir).select("doc_id", *cols)


def kwc_sql(t: str, k: str) -> str:
    lt = f"lower(coalesce({t}, ''))"
    return f"CAST((length({lt}) - length(replace({lt}, {q(k.lower())}, ''))) // {len(k)} AS BIGINT)"


ORACLE["keyword_count"] = ("SELECT doc_id, " + ", ".join(f"{kwc_sql('text', k)} AS n_{i}"
                                                         for i, k in enumerate(TEST_KEYWORDS)) + " FROM documents")

# Keyword axes bound to testdata words (the reference axes are Korean).
TEST_PERSON_AXIS = {"p_the": ["the"], "p_eau": ["eau"]}
TEST_ISSUE_AXIS = {"i_sch": ["sch"], "i_cion": ["ción"], "i_and": ["and", "und"], "general": ["que"]}


def classify_sql(t: str, axes: dict, default: str) -> str:
    labels = list(axes)
    scores = {lbl: "(" + " + ".join(kwc_sql(t, k) for k in axes[lbl]) + ")" for lbl in labels}
    best = "greatest(" + ", ".join(scores.values()) + ")" if len(labels) > 1 else scores[labels[0]]
    whens = " ".join(f"WHEN {scores[lbl]} = {best} AND {best} > 0 THEN '{lbl}'" for lbl in labels)
    return f"(CASE {whens} ELSE '{default}' END)"


@register("keyword_classify")
def q_keyword_classify(spark, sf_dir):
    """T-8: two keyword axes, first max in declared order, all-zero -> default."""
    return _docs(spark, sf_dir).select(
        "doc_id", T.keyword_classify(F.col("text"), TEST_PERSON_AXIS, "neutral").alias("person"),
        T.keyword_classify(F.col("text"), TEST_ISSUE_AXIS, "general").alias("issue"))


ORACLE["keyword_classify"] = (f"SELECT doc_id, {classify_sql('text', TEST_PERSON_AXIS, 'neutral')} AS person, "
                              f"{classify_sql('text', TEST_ISSUE_AXIS, 'general')} AS issue FROM documents")


@register("label_distribution")
def q_label_distribution(spark, sf_dir):
    """A-8: distinct person labels with counts."""
    lab = _docs(spark, sf_dir).select(T.keyword_classify(F.col("text"), TEST_PERSON_AXIS, "neutral").alias("person"))
    return TP.label_distribution(lab, "person")


ORACLE["label_distribution"] = (f"SELECT person, count(*) AS count FROM (SELECT "
                                f"{classify_sql('text', TEST_PERSON_AXIS, 'neutral')} AS person FROM documents) "
                                "GROUP BY person")


# ---------------------------------------------------------------------------
# Bag of words and vocabulary
# ---------------------------------------------------------------------------
def _bow(spark, sf_dir, lower=False):
    return TP.doc_bow(_docs(spark, sf_dir), "doc_id", "text", LETTER, lower=lower)


@register("bow")
def q_bow(spark, sf_dir):
    """T-9: term counts per document (case kept)."""
    return _bow(spark, sf_dir)


ORACLE["bow"] = f"SELECT doc_id, term, count(*) AS n FROM {docs_tokens_sql()} GROUP BY ALL"

VOCAB_MIN_DF, VOCAB_MAX_DF, VOCAB_MAX_FEATURES = TP.GUIDED_VOCAB["min_df"], TP.GUIDED_VOCAB["max_df"], \
    TP.GUIDED_VOCAB["max_features"]


@register("vocab_filter")
def q_vocab_filter(spark, sf_dir):
    """T-10: df >= 3 and df <= 0.8 N."""
    docs = _docs(spark, sf_dir)
    return TP.vocab_filter(_bow(spark, sf_dir), docs.select(F.count("*")).scalar(), VOCAB_MIN_DF, VOCAB_MAX_DF)


VOCAB_SQL = f"""bow AS (SELECT doc_id, term, count(*) AS n FROM {docs_tokens_sql()} GROUP BY ALL),
st AS (SELECT term, count(doc_id) AS df, sum(n) AS tf FROM bow GROUP BY term),
vf AS (SELECT * FROM st WHERE df >= {VOCAB_MIN_DF} AND df <= {VOCAB_MAX_DF} * (SELECT count(*) FROM documents))"""

ORACLE["vocab_filter"] = f"WITH {VOCAB_SQL}\nSELECT term, df, CAST(tf AS BIGINT) AS tf FROM vf"


@register("vocab_cut")
def q_vocab_cut(spark, sf_dir):
    """K-5: the max_features most frequent filtered terms (tf desc, term asc)."""
    return TP.vocabulary(_bow(spark, sf_dir), _docs(spark, sf_dir), VOCAB_MIN_DF, VOCAB_MAX_DF, VOCAB_MAX_FEATURES)


ORACLE["vocab_cut"] = (f"WITH {VOCAB_SQL}\nSELECT term, df, CAST(tf AS BIGINT) AS tf FROM vf "
                       f"ORDER BY tf DESC, term LIMIT {VOCAB_MAX_FEATURES}")

TEST_VOCAB = ["The", "und", "de", "la", "que", "eau", "Sch", "the"]


@register("fixed_vocab_counts")
def q_fixed_vocab_counts(spark, sf_dir):
    """T-11: counts of a supplied vocabulary only (both sides lower-cased)."""
    toks = TP.doc_tokens(_docs(spark, sf_dir), "doc_id", "text", LETTER)
    return TP.fixed_vocab_counts(toks, TEST_VOCAB)


ORACLE["fixed_vocab_counts"] = (
    f"SELECT doc_id, lower(term) AS term, count(*) AS n FROM {docs_tokens_sql()} "
    f"WHERE lower(term) IN ({', '.join(q(w.lower()) for w in dict.fromkeys(TEST_VOCAB))}) GROUP BY ALL")


# ---------------------------------------------------------------------------
# Class TF-IDF, top words, keyword strings (topic fixture)
# ---------------------------------------------------------------------------
def _class_weights(spark, sf_dir):
    ta = FX.topic_assignments(spark, sf_dir)
    toks = TP.doc_tokens(ta, "topic_id", "comment_text", LETTER, lower=True)
    return TP.class_tfidf(toks.groupBy("topic_id", "term").agg(F.count("*").alias("n")))


CTFIDF_SQL = """cb AS (SELECT topic_id, term, count(*) AS n FROM (SELECT topic_id,
        unnest(regexp_extract_all(lower(comment_text), {pat}, 1)) AS term FROM topic_assignments) GROUP BY ALL),
tot AS (SELECT topic_id, sum(n) AS cn FROM cb GROUP BY topic_id),
ft AS (SELECT term, sum(n) AS f FROM cb GROUP BY term),
ctf AS (SELECT cb.topic_id, cb.term, (cb.n / tot.cn) * ln(1 + (SELECT floor(avg(cn)) FROM tot) / ft.f) AS weight
        FROM cb JOIN tot USING (topic_id) JOIN ft USING (term)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS rank FROM ctf)""".format(
    pat=q(LETTER))


@register("class_tfidf")
def q_class_tfidf(spark, sf_dir):
    """T-12: class-based TF-IDF per (topic, term)."""
    return _class_weights(spark, sf_dir)


ORACLE["class_tfidf"] = f"WITH {ta_cte()},\n{CTFIDF_SQL}\nSELECT topic_id, term, {r6('weight', 'weight')} FROM ctf"


@register("topic_top_words")
def q_topic_top_words(spark, sf_dir):
    """K-2: top 10 words per topic by c-TF-IDF weight (term asc on ties)."""
    return TP.top_words(_class_weights(spark, sf_dir), 10).select("topic_id", "rank", "term", "weight")


ORACLE["topic_top_words"] = (f"WITH {ta_cte()},\n{CTFIDF_SQL}\nSELECT topic_id, CAST(rank AS BIGINT) AS rank, term, "
                             f"{r6('weight', 'weight')} FROM ranked WHERE rank <= 10")


@register("keyword_string")
def q_keyword_string(spark, sf_dir):
    """T-13: top-5 words joined with ', '; the outlier topic -> 'outlier'."""
    return TP.keyword_map(TP.top_words(_class_weights(spark, sf_dir), TP.TOP_K_KEYWORDS))


ORACLE["keyword_string"] = (f"WITH {ta_cte()},\n{CTFIDF_SQL}\nSELECT topic_id, CASE WHEN topic_id = -1 THEN 'outlier' "
                            "ELSE string_agg(term, ', ' ORDER BY rank) END AS topic_keywords FROM ranked "
                            f"WHERE rank <= {TP.TOP_K_KEYWORDS} GROUP BY topic_id")


@register("topic_word_union")
def q_topic_word_union(spark, sf_dir):
    """S-4: union of every topic's top-25 words."""
    return TP.topic_word_union(TP.top_words(_class_weights(spark, sf_dir), TP.DIVERSITY_TOP_K))


ORACLE["topic_word_union"] = (f"WITH {ta_cte()},\n{CTFIDF_SQL}\nSELECT DISTINCT term FROM ranked "
                              f"WHERE rank <= {TP.DIVERSITY_TOP_K}")


@register("topic_diversity")
def q_topic_diversity(spark, sf_dir):
    """E-1: distinct / total words over the top 25 per topic."""
    return EV.topic_diversity(TP.top_words(_class_weights(spark, sf_dir), TP.DIVERSITY_TOP_K))


ORACLE["topic_diversity"] = (f"WITH {ta_cte()},\n{CTFIDF_SQL}\nSELECT "
                             + r6("coalesce(count(DISTINCT term) / nullif(count(*), 0), 0.0)", "topic_diversity")
                             + f" FROM ranked WHERE rank <= {TP.DIVERSITY_TOP_K}")


# ---------------------------------------------------------------------------
# Topic assignment fixture: lookup, probability, summaries
# ---------------------------------------------------------------------------
def _ta(spark, sf_dir):
    return FX.topic_assignments(spark, sf_dir)


@register("keyword_lookup")
def q_keyword_lookup(spark, sf_dir):
    """J-4: each comment's topic keyword string (top-5 by count per topic)."""
    return _ta(spark, sf_dir).select("comment_id", "topic_id", "topic_keywords")


ORACLE["keyword_lookup"] = (f"WITH {ta_cte()}\nSELECT comment_id, CAST(topic_id AS BIGINT) AS topic_id, "
                            "topic_keywords FROM topic_assignments")


@register("topic_probability")
def q_topic_probability(spark, sf_dir):
    """T-14: own entry of the distribution, max for the outlier topic."""
    return _ta(spark, sf_dir).select("comment_id", "topic_prob")


ORACLE["topic_probability"] = (f"WITH {ta_cte()}\nSELECT comment_id, {r6('topic_prob', 'topic_prob')} "
                               "FROM topic_assignments")


@register("dominant_topic")
def q_dominant_topic(spark, sf_dir):
    """W-2: argmax (1-based, first max wins) of each document's distribution."""
    b = FX.topic_base(spark, sf_dir)
    d = F.transform("embedding", lambda x: F.abs(x))
    dist = T.let(d, lambda a: T.let(F.aggregate(a, F.lit(0.0), lambda s, y: s + y),
                                    lambda tot: F.transform(a, lambda x: x / tot)))
    dom = TP.dominant_topic(dist)
    return b.select("comment_id", dom["topic"].alias("dominant_topic"), dom["prob"].alias("dominant_prob"))


ORACLE["dominant_topic"] = f"""WITH {ta_cte()},
d AS (SELECT comment_id, list_transform({abs_all('embedding')}, lambda x: x / list_sum({abs_all('embedding')})) AS dist
      FROM ta_base)
SELECT comment_id, CAST(list_position(dist, list_max(dist)) AS BIGINT) AS dominant_topic,
       {r6('list_max(dist)', 'dominant_prob')} FROM d"""


@register("perplexity_prob")
def q_perplexity_prob(spark, sf_dir):
    """E-5: exp(-mean log p) over the assigned probabilities."""
    return EV.perplexity_prob(_ta(spark, sf_dir))


ORACLE["perplexity_prob"] = (f"WITH {ta_cte()}\nSELECT {r6('exp(-avg(ln(topic_prob)))', 'perplexity')} "
                             "FROM topic_assignments WHERE topic_prob > 0")


@register("non_outlier")
def q_non_outlier(spark, sf_dir):
    """PF-5: assignments outside the outlier topic."""
    return _ta(spark, sf_dir).filter(F.col("topic_id") != TP.OUTLIER).select("comment_id", "topic_id")


ORACLE["non_outlier"] = (f"WITH {ta_cte()}\nSELECT comment_id, CAST(topic_id AS BIGINT) AS topic_id "
                         "FROM topic_assignments WHERE topic_id <> -1")


@register("topic_info")
def q_topic_info(spark, sf_dir):
    """A-7: topic sizes, largest first."""
    return TP.topic_info(_ta(spark, sf_dir))


ORACLE["topic_info"] = (f"WITH {ta_cte()}\nSELECT CAST(topic_id AS BIGINT) AS topic_id, count(*) AS count "
                        "FROM topic_assignments GROUP BY topic_id ORDER BY count DESC, topic_id")


@register("topic_head")
def q_topic_head(spark, sf_dir):
    """K-3: the 15 largest non-outlier topics."""
    return TP.topic_head(_ta(spark, sf_dir), 15)


ORACLE["topic_head"] = (f"WITH {ta_cte()}\nSELECT CAST(topic_id AS BIGINT) AS topic_id, count(*) AS count "
                        "FROM topic_assignments WHERE topic_id <> -1 GROUP BY topic_id "
                        "ORDER BY count DESC, topic_id LIMIT 15")

TBP_SQL = """tbp AS (SELECT time_label, topic_id, count(*) AS count FROM topic_assignments GROUP BY ALL),
tbp2 AS (SELECT *, sum(count) OVER (PARTITION BY time_label) AS period_total FROM tbp)"""


@register("topic_by_period")
def q_topic_by_period(spark, sf_dir):
    """A-6: count per (period, topic), period total and percent."""
    return TP.topic_by_period(_ta(spark, sf_dir))


ORACLE["topic_by_period"] = (f"WITH {ta_cte()},\n{TBP_SQL}\nSELECT time_label, CAST(topic_id AS BIGINT) AS topic_id, "
                             "count, CAST(period_total AS BIGINT) AS period_total, "
                             f"{r6('count * 100.0 / period_total', 'percent')} FROM tbp2")


@register("topic_top5_by_period")
def q_topic_top5_by_period(spark, sf_dir):
    """W-3: top five topics per period, outlier removed after the cut."""
    return TP.topic_top5_by_period(_ta(spark, sf_dir))


ORACLE["topic_top5_by_period"] = (
    f"WITH {ta_cte()},\n{TBP_SQL},\nr AS (SELECT *, row_number() OVER (PARTITION BY time_label ORDER BY count DESC, "
    "topic_id) AS rank FROM tbp2)\nSELECT time_label, CAST(topic_id AS BIGINT) AS topic_id, count, "
    f"CAST(period_total AS BIGINT) AS period_total, {r6('count * 100.0 / period_total', 'percent')}, "
    "CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 5 AND topic_id <> -1")


@register("topic_documents")
def q_topic_documents(spark, sf_dir):
    """A-12: documents concatenated per topic in id order, in bounded pieces."""
    return TP.topic_documents(_ta(spark, sf_dir))


ORACLE["topic_documents"] = (f"WITH {ta_cte()}\nSELECT CAST(topic_id AS BIGINT) AS topic_id, "
                             f"CAST(floor(comment_id / {TP.DOC_CHUNK_IDS}) AS BIGINT) AS chunk, "
                             "string_agg(comment_text, ' ' ORDER BY comment_id) AS documents "
                             f"FROM topic_assignments GROUP BY topic_id, floor(comment_id / {TP.DOC_CHUNK_IDS})")


@register("corpus_stats")
def q_corpus_stats(spark, sf_dir):
    """A-13: files, documents, outliers, topics."""
    return TP.corpus_stats(_ta(spark, sf_dir))


ORACLE["corpus_stats"] = (f"WITH {ta_cte()}\nSELECT count(DISTINCT channel) AS n_files, count(*) AS n_documents, "
                          "count(*) FILTER (WHERE topic_id = -1) AS n_outliers, "
                          "count(DISTINCT topic_id) FILTER (WHERE topic_id <> -1) AS n_topics FROM topic_assignments")


@register("meta_join")
def q_meta_join(spark, sf_dir):
    """J-5: results joined to document metadata by key (never by position)."""
    ta = _ta(spark, sf_dir).select("comment_id", "topic_id")
    meta = FX.comments(spark, sf_dir, overlay=False).select("comment_id", "comment_author_id", "channel")
    return ta.join(meta, "comment_id")


ORACLE["meta_join"] = (f"WITH {ta_cte()}\nSELECT t.comment_id, CAST(t.topic_id AS BIGINT) AS topic_id, "
                       "p.comment_author_id, p.channel FROM topic_assignments t JOIN plain p USING (comment_id)")


# ---------------------------------------------------------------------------
# Clustering
# ---------------------------------------------------------------------------
def _clustered(spark, sf_dir):
    return FX.clustered(spark, sf_dir)


@register("nearest_candidate")
def q_nearest_candidate(spark, sf_dir):
    """J-6: most cosine-similar candidate, first wins ties."""
    return _clustered(spark, sf_dir).select("comment_id", "candidate", F.col("candidate_score").alias("score"))


ORACLE["nearest_candidate"] = (f"WITH {clustered_cte()}\nSELECT comment_id, candidate, {r6('score', 'score')} "
                               "FROM clustered")


@register("cosine")
def q_cosine(spark, sf_dir):
    """T-16: cosine of each comment vector with each candidate vector."""
    arr = V.candidate_array(FX.candidates(spark, sf_dir))
    ta = FX.topic_base(spark, sf_dir)
    pairs = F.transform(arr, lambda c: F.struct(c["name"].alias("candidate"),
                                                V.cosine(F.col("embedding"), c["vec"]).alias("cosine")))
    return ta.select("comment_id", F.explode(pairs).alias("p")).select("comment_id", "p.candidate", "p.cosine")


ORACLE["cosine"] = (f"WITH {clustered_cte()}\nSELECT comment_id, candidate, {r6('score', 'cosine')} FROM scored")


@register("vector_norm")
def q_vector_norm(spark, sf_dir):
    """T-17: L2 norm of each comment vector."""
    return FX.topic_base(spark, sf_dir).select("comment_id", V.norm("embedding").alias("norm"))


ORACLE["vector_norm"] = f"WITH {ta_cte()}\nSELECT comment_id, {r6(norm_sql('embedding'), 'norm')} FROM ta_base"


@register("topic_label")
def q_topic_label(spark, sf_dir):
    """T-7: first keyword, whitespace runs -> '_', blank -> topic_{id}."""
    return _clustered(spark, sf_dir).select("comment_id", "topic_label")


ORACLE["topic_label"] = f"WITH {clustered_cte()}\nSELECT comment_id, topic_label FROM clustered"


@register("final_cluster")
def q_final_cluster(spark, sf_dir):
    """PF-7: topic_label + '_' + candidate."""
    return _clustered(spark, sf_dir).select("comment_id", "final_cluster")


ORACLE["final_cluster"] = f"WITH {clustered_cte()}\nSELECT comment_id, final_cluster FROM clustered"


@register("contract_projection")
def q_contract_projection(spark, sf_dir):
    """PF-8: clustered rows in the cluster-output contract."""
    return CL.contract(_clustered(spark, sf_dir))


ORACLE["contract_projection"] = (f"WITH {clustered_cte()}\nSELECT comment_id, time_label, comment_text, "
                                 "CAST(topic_id AS BIGINT) AS topic_id, topic_keywords, candidate, final_cluster "
                                 "FROM clustered")


@register("cluster_counts")
def q_cluster_counts(spark, sf_dir):
    """A-9: ten most frequent clusters."""
    return CL.cluster_counts(_clustered(spark, sf_dir))


ORACLE["cluster_counts"] = (f"WITH {clustered_cte()}\nSELECT final_cluster, count(*) AS count FROM clustered "
                            "GROUP BY final_cluster ORDER BY count DESC, final_cluster LIMIT 10")


# ---------------------------------------------------------------------------
# Sentiment
# ---------------------------------------------------------------------------
# Classifier label strings derived per document (covers every mapping rule).
RAW_LABELS = ["LABEL_0", "LABEL_1", "LABEL_2", "positive", "Negative", "neutral", "hate", "offensive",
              "label_x", "other"]
ID2LABEL = {0: "negative", 1: "positive", 2: "hate speech"}


@register("sentiment_label")
def q_sentiment_label(spark, sf_dir):
    """T-15: classifier label -> positive / negative / neutral."""
    lab = FX.table(spark, sf_dir, "labels").select("doc_id")
    raw = F.element_at(F.array(*[F.lit(x) for x in RAW_LABELS]), (F.col("doc_id") % len(RAW_LABELS) + 1).cast("int"))
    return lab.select("doc_id", raw.alias("raw_label"),
                      T.sentiment_label(raw, ID2LABEL, 3).alias("sentiment"),
                      T.sentiment_label(raw, None, 2).alias("sentiment_binary"))


def _label_sql(raw: str, id2label: dict | None, num_labels: int) -> str:
    s = f"lower({strip_sql(raw)})"

    def any_of(x, keys):
        return "(" + " OR ".join(f"contains({x}, {q(k)})" for k in keys) + ")"

    idx = (f"(CASE WHEN starts_with({s}, 'label_') THEN TRY_CAST({strip_sql(f'split_part({s}, chr(95), 2)')} "
           "AS INTEGER) END)")
    if id2label:
        name = "coalesce(CASE " + " ".join(f"WHEN {idx} = {k} THEN {q(v.lower())}" for k, v in id2label.items()) \
               + " END, '')"
    else:
        name = "''"
    binary = (f" WHEN {idx} = 1 THEN 'positive' WHEN {idx} IS NOT NULL THEN 'negative'" if num_labels == 2 else "")
    via = (f"(CASE WHEN {any_of(name, T.POSITIVE_KEYS)} THEN 'positive' "
           f"WHEN {any_of(name, T.NEGATIVE_KEYS + T.HOSTILE_KEYS)} THEN 'negative' "
           f"WHEN {any_of(name, T.NEUTRAL_KEYS)} THEN 'neutral'{binary} ELSE 'neutral' END)")
    return (f"(CASE WHEN {any_of(s, T.POSITIVE_KEYS)} THEN 'positive' WHEN {any_of(s, T.NEGATIVE_KEYS)} THEN "
            f"'negative' WHEN {any_of(s, T.NEUTRAL_KEYS)} THEN 'neutral' WHEN {any_of(s, T.HOSTILE_KEYS)} THEN "
            f"'negative' WHEN {idx} IS NOT NULL THEN {via} ELSE 'neutral' END)")


_RAW_SQL = "(" + "[" + ", ".join(q(x) for x in RAW_LABELS) + f"])[doc_id % {len(RAW_LABELS)} + 1]"
ORACLE["sentiment_label"] = (f"SELECT doc_id, raw_label, {_label_sql('raw_label', ID2LABEL, 3)} AS sentiment, "
                             f"{_label_sql('raw_label', None, 2)} AS sentiment_binary "
                             f"FROM (SELECT doc_id, {_RAW_SQL} AS raw_label FROM labels)")

SUMMARY_COLS = ("final_cluster, " + ", ".join(r6(c, c) for c in SE.CLASSES)
                + ", total_comments, time_label, model_path")


@register("sentiment_summary")
def q_sentiment_summary(spark, sf_dir):
    """A-3: class shares per (time_label, final_cluster), half-even to 6 digits."""
    return FX.sentiment_summary(spark, sf_dir)


ORACLE["sentiment_summary"] = f"WITH {detail_cte()}\nSELECT {SUMMARY_COLS} FROM summary"


@register("summary_order")
def q_summary_order(spark, sf_dir):
    """K-4: the summary ordered by (time_label, final_cluster)."""
    return FX.sentiment_summary(spark, sf_dir).orderBy("time_label", "final_cluster")


ORACLE["summary_order"] = f"WITH {detail_cte()}\nSELECT {SUMMARY_COLS} FROM summary ORDER BY time_label, final_cluster"
