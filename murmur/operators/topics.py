"""Topic modelling as Spark plans (T-9 .. T-14, K-2, K-5, W-2, W-3, J-4,
A-6 .. A-8, A-12, A-13, K-3, S-4, M-1, M-2, M-5, M-6).

Document-term data stays in long form ``(doc, term, n)``; vocabularies and
topic-word tables are bounded by ``max_features`` x ``k`` and are the only
things that ever reach the driver (to label model outputs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.functions import vectors as V
from murmur.operators import guided as GU
from murmur.operators import lda as LD
from murmur.operators.neighbours import written
from murmur.schemas import TOPIC_ASSIGNMENT_COLUMNS
from murmur.session import ensure_checkpoint_dir

# Model and vocabulary settings of the three topic methods.
LDA_SETTINGS = dict(k=10, max_iter=20, doc_concentration=1.0, topic_concentration=0.1, seed=42,
                    learning_decay=0.7, learning_offset=10.0)
LDA_VOCAB = dict(min_df=2, max_df=0.95, max_features=1000)
GUIDED_VOCAB = dict(min_df=3, max_df=0.8, max_features=1000)
GUIDED_WEIGHTS = (0.6, 0.4)
TOP_K_KEYWORDS = 5
DIVERSITY_TOP_K = 25
OUTLIER = -1
MAX_BROADCAST_TERMS = 100_000
# Reference keyword axes of the guided model (person, issue), in declared order.
PERSON_AXIS = {
    "yoon": ["윤석열", "윤", "대통령", "현정부", "정부", "여당", "국민의힘"],
    "lee": ["이재명", "이", "민주당", "야당", "더불어민주당"],
}
PERSON_DEFAULT = "neutral"
ISSUE_AXIS = {
    "policy": ["정책", "공약", "법안", "제도", "개혁", "예산", "경제", "복지"],
    "scandal": ["수사", "검찰", "재판", "혐의", "비리", "논란", "의혹"],
    "campaign": ["선거", "캠페인", "유세", "공천", "후보", "지지율"],
    "general": ["발언", "회견", "성명", "입장", "반응", "비판"],
}
ISSUE_DEFAULT = "general"


# ---------------------------------------------------------------------------
# Tokens, bag of words, vocabulary
# ---------------------------------------------------------------------------
def doc_tokens(df: DataFrame, doc: str, text: str, pattern: str | None = T.HANGUL_TOKEN,
               lower: bool = False, min_len: int = 2, keep_pos: bool = False) -> DataFrame:
    """T-4 / T-5 exploded: ``(doc, [pos,] term)``. ``pattern=None`` means
    whitespace tokens of length >= ``min_len``."""
    t = F.lower(F.col(text)) if lower else F.col(text)
    toks = T.regex_tokens(t, pattern) if pattern else T.ws_tokens(t, min_len)
    if keep_pos:
        return df.select(doc, F.posexplode(toks).alias("pos", "term"))
    return df.select(doc, F.explode(toks).alias("term"))


def bow(tokens: DataFrame, doc: str = "doc_id") -> DataFrame:
    """T-9: term counts per document."""
    return tokens.groupBy(doc, "term").agg(F.count("*").alias("n"))


def doc_bow(docs: DataFrame, doc: str, text: str, pattern: str | None = T.HANGUL_TOKEN,
            lower: bool = False, min_len: int = 2) -> DataFrame:
    """T-4 / T-5 + T-9 keyed by a *unique* document id: ``(doc, term, n)``.

    A document's counts need nothing but the document: its tokens are sorted inside the row and the lengths of the runs are the
    counts. No exchange, so neither texts nor counts are moved. For keys that repeat (topics, channels) use ``doc_tokens`` + ``bow``."""
    t = F.lower(F.col(text)) if lower else F.col(text)
    toks = T.regex_tokens(t, pattern) if pattern else T.ws_tokens(t, min_len)

    def runs(s):
        first = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.element_at(s, i) != F.try_element_at(s, F.greatest(i - 1, F.lit(1)))))
        return T.let(first, lambda at: F.transform(at, lambda i, k: F.struct(
            F.element_at(s, i).alias("term"),
            (F.coalesce(F.try_element_at(at, k + 2), F.size(s) + 1) - i).cast("long").alias("n"))))

    counts = T.let(F.array_sort(toks), lambda s: F.when(F.size(s) > 0, runs(s)))
    return docs.select(doc, F.explode(counts).alias("_r")).select(doc, "_r.term", "_r.n")


def tokenised(docs: DataFrame, doc: str, text: str, pattern: str = T.HANGUL_TOKEN, lower: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """(doc, [keep ...,] tokens), written once: vocabulary and counts read the tokens and don't search the texts again."""
    t = F.lower(F.col(text)) if lower else F.col(text)
    return written(docs.select(doc, *keep, T.regex_tokens(t, pattern).alias("tokens")), "tokens")


def token_vocabulary(toks: DataFrame, min_df=2, max_df=0.95, max_features=1000) -> DataFrame:
    """``vocabulary`` of one row a document with its ``tokens``: the document frequency comes from a row's different tokens."""
    n_docs = toks.select(F.count("*")).scalar()
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(F.lit(min_df) * n_docs)
    hi = F.lit(max_df) if isinstance(max_df, int) else F.lit(float(max_df)) * n_docs
    counts = GU.token_counts(toks.select("tokens")).groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    return vocab_cut(counts.where((F.col("df") >= lo) & (F.col("df") <= hi)), max_features)


def vocabulary_counts(toks: DataFrame, terms: Sequence[str], doc: str = "doc_id") -> DataFrame:
    """(doc, term, n) of the vocabulary's terms, for one row a document with its ``tokens``. Only a vocabulary's tokens
    are counted; the terms (at most max_features) are broadcast."""
    wanted = F.broadcast(toks.sparkSession.createDataFrame(list(enumerate(terms)), "at int, term string"))
    rows = GU.token_bags(toks.select(doc, "tokens"), list(terms), doc).select(doc, F.explode(F.arrays_zip("at", "n")).alias("_r"))
    return rows.select(doc, "_r.at", F.col("_r.n").cast("long").alias("n")).join(wanted, "at").select(doc, "term", "n")


def term_stats(bow_df: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Document frequency and corpus frequency per term."""
    return bow_df.groupBy("term").agg(F.count(doc).alias("df"), F.sum("n").alias("tf"))


def vocab_filter(bow_df: DataFrame, n_docs: Column | int, min_df: int | float = 2,
                 max_df: int | float = 0.95, doc: str = "doc_id") -> DataFrame:
    """T-10: keep terms with ``df >= min_df`` and ``df <= max_df``; float
    thresholds are proportions of ``n_docs`` (a scalar or scalar subquery)."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(F.lit(min_df) * n)
    hi = F.lit(max_df) if isinstance(max_df, int) else F.lit(float(max_df)) * n
    st = term_stats(bow_df, doc)
    return st.filter((F.col("df") >= lo) & (F.col("df") <= hi))


def vocab_cut(vocab: DataFrame, max_features: int | None = 1000) -> DataFrame:
    """K-5: the ``max_features`` most frequent terms (tf desc, term asc) — a
    top-k (per-partition top-k, then merge), never a global sort."""
    if max_features is None:
        return vocab
    return vocab.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)


def vocabulary(bow_df: DataFrame, docs: DataFrame, min_df=2, max_df=0.95, max_features=1000,
               doc: str = "doc_id") -> DataFrame:
    """T-10 then K-5 (the order of the count-vectoriser rules)."""
    n_docs = docs.select(F.count("*")).scalar()
    return vocab_cut(vocab_filter(bow_df, n_docs, min_df, max_df, doc), max_features)


def fixed_vocab_counts(tokens: DataFrame, vocab: Sequence[str], doc: str = "doc_id") -> DataFrame:
    """T-11: counts of a supplied vocabulary only, both sides lower-cased.
    The vocabulary is a parameter list (bounded), joined by broadcast."""
    spark = tokens.sparkSession
    v = spark.createDataFrame([(w,) for w in dict.fromkeys(x.lower() for x in vocab)], "term string")
    return (tokens.withColumn("term", F.lower("term"))
            .join(F.broadcast(v), "term").groupBy(doc, "term").agg(F.count("*").alias("n")))


def class_tfidf(class_bow: DataFrame, cls: str = "topic_id") -> DataFrame:
    """T-12: class-based TF-IDF ``tf(t,c) * ln(1 + A / f(t))``.

    ``tf`` is the L1-normalised count of term t in class c, ``f(t)`` its total
    count over all classes and ``A`` the integer part of the mean number of
    words per class. The counts are written once and read for all three.
    """
    class_bow = written(class_bow.select(cls, "term", "n"), "class-counts")
    totals = class_bow.groupBy(cls).agg(F.sum("n").alias("_cn"))
    avg_words = totals.select(F.floor(F.avg("_cn"))).scalar()
    ft = class_bow.groupBy("term").agg(F.sum("n").alias("_ft"))
    return (class_bow.join(totals, cls).join(ft, "term")
            .select(cls, "term", ((F.col("n") / F.col("_cn"))
                                  * F.log(1 + avg_words / F.col("_ft"))).alias("weight")))


def top_words(weights: DataFrame, k: int = 10, group: str = "topic_id", weight: str = "weight") -> DataFrame:
    """K-2: top-k terms per topic by weight desc, term asc, with their rank.
    ``row_number <= k`` lets Spark cut each group map-side before the shuffle."""
    w = Window.partitionBy(group).orderBy(F.desc(weight), F.asc("term"))
    return (weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))


def keyword_map(top: DataFrame, group: str = "topic_id", k: int = TOP_K_KEYWORDS) -> DataFrame:
    """T-13: ``(topic, "w1, w2, ...")`` from ranked top words; outlier topic -> ``outlier``."""
    agg = top.filter(F.col("rank") <= k).groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_rt"))
    words = F.transform("_rt", lambda s: s["term"])
    return agg.select(group, T.keyword_string(words, F.col(group), OUTLIER, k).alias("topic_keywords"))


def keyword_lookup(df: DataFrame, kw: DataFrame, topic: str = "topic_id") -> DataFrame:
    """J-4: attach each topic's keyword string, default ``topic_{id}``.
    The keyword table has one row per topic (k rows), so it is broadcast."""
    return (df.join(F.broadcast(kw), topic, "left")
            .withColumn("topic_keywords", F.coalesce(
                F.col("topic_keywords"), F.concat(F.lit("topic_"), F.col(topic).cast("string")))))


def dominant_topic(dist, one_based: bool = True) -> Column:
    """W-2: struct(topic, prob) — argmax of a distribution, first max wins;
    an all-zero distribution (empty document) counts as uniform."""
    d = F.col(dist) if isinstance(dist, str) else dist

    def pick(arr):
        k = F.size(arr)
        mx = F.array_max(arr)
        pos = F.array_position(arr, mx)
        uniform = mx == 0
        topic = F.when(uniform, F.lit(1)).otherwise(pos).cast("int")
        prob = F.when(uniform, F.lit(1.0) / k).otherwise(mx)
        return F.struct((topic - (0 if one_based else 1)).alias("topic"), prob.alias("prob"))

    return T.let(d, pick)


# ---------------------------------------------------------------------------
# Topic summaries
# ---------------------------------------------------------------------------
def topic_info(assign: DataFrame, topic: str = "topic_id") -> DataFrame:
    """A-7: topic sizes, ordered by size (ties by topic id)."""
    return assign.groupBy(topic).agg(F.count("*").alias("count")).orderBy(F.desc("count"), topic)


def topic_head(assign: DataFrame, n: int = 15, topic: str = "topic_id") -> DataFrame:
    """K-3: the ``n`` largest non-outlier topics."""
    return (assign.filter(F.col(topic) != OUTLIER).groupBy(topic).agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), topic).limit(n))


def topic_by_period(assign: DataFrame, topic: str = "topic_id", period: str = "time_label") -> DataFrame:
    """A-6: count per (period, topic), the period total and the percentage."""
    c = assign.groupBy(period, topic).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(period))
    return (c.withColumn("period_total", total)
            .withColumn("percent", F.col("count") * 100.0 / F.col("period_total")))


def topic_top5_by_period(assign: DataFrame, n: int = 5, topic: str = "topic_id",
                         period: str = "time_label") -> DataFrame:
    """W-3: top ``n`` topics per period by count (ties: topic id), the outlier
    removed *after* the cut, so a period may keep fewer than ``n``."""
    c = topic_by_period(assign, topic, period)
    w = Window.partitionBy(period).orderBy(F.desc("count"), F.asc(topic))
    return (c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .filter(F.col(topic) != OUTLIER))


def label_distribution(df: DataFrame, col: str) -> DataFrame:
    """A-8: distinct values with counts."""
    return df.groupBy(col).agg(F.count("*").alias("count"))


DOC_CHUNK_IDS = 1000


def topic_documents(assign: DataFrame, topic: str = "topic_id", text: str = "comment_text",
                    order: str = "comment_id", sep: str = " ", chunk_ids: int = DOC_CHUNK_IDS) -> DataFrame:
    """A-12: document text concatenated per topic in id order (``listagg``
    within group), in bounded pieces: one row per (topic, block of
    ``chunk_ids`` consecutive ids), so no group holds more than ``chunk_ids``
    documents however large a topic is. The topic's full text is the pieces
    in ``chunk`` order. (Modelling uses term counts per topic instead.)"""
    return (assign.withColumn("chunk", F.floor(F.col(order) / chunk_ids))
            .groupBy(topic, "chunk")
            .agg(F.expr(f"listagg({text}, '{sep}') WITHIN GROUP (ORDER BY {order})").alias("documents")))


def corpus_stats(assign: DataFrame, file_col: str = "channel", topic: str = "topic_id") -> DataFrame:
    """A-13: distinct files, documents, outlier documents, non-outlier topics."""
    return assign.agg(
        F.countDistinct(file_col).alias("n_files"),
        F.count("*").alias("n_documents"),
        F.count_if(F.col(topic) == OUTLIER).alias("n_outliers"),
        F.countDistinct(F.when(F.col(topic) != OUTLIER, F.col(topic))).alias("n_topics"))


def topic_word_union(top: DataFrame, k: int = DIVERSITY_TOP_K) -> DataFrame:
    """S-4: the set of words over every topic's top ``k``."""
    return top.filter(F.col("rank") <= k).select("term").distinct()


# ---------------------------------------------------------------------------
# M-1 / M-2: LDA
# ---------------------------------------------------------------------------
def lda_fit(docs: DataFrame, text: str = "text", pattern: str = T.HANGUL_TOKEN, settings: dict | None = None,
            vocab: dict | None = None):
    """M-1: count vectoriser + online LDA with the reference's priors and
    learning schedule; each iteration is a pass over all documents. Tokens are written once, with the rest of the row; the vocabulary (the most frequent
    words, ties by the word) and the count vectors come from them. The vectors are written without the rest of the row and dealt out evenly: a pass reads
    nothing else, and all cores share it however few row groups the texts came in. Spark makes the first topics, ``lda.fit`` the passes.
    Returns ``(cv_model, lda_model, features_df)``; the last has the tokens as ``_tokens``, and its vectors are made as it is read."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizerModel

    s = {**LDA_SETTINGS, **(settings or {})}
    v = {**LDA_VOCAB, **(vocab or {})}
    spark = docs.sparkSession
    toks = written(docs.withColumn("_tokens", T.regex_tokens(F.col(text), pattern)), "tokens")
    wanted = token_vocabulary(toks.select(F.col("_tokens").alias("tokens")), v["min_df"], v["max_df"], v["max_features"])
    terms = [r.term for r in wanted.select("term", "tf").orderBy(F.desc("tf"), "term").collect()]  # at most max_features
    if not terms:
        raise ValueError("no word is in the vocabulary")
    cv_model = CountVectorizerModel.from_vocabulary(terms, inputCol="_tokens", outputCol="features")
    feats = cv_model.transform(toks.withColumn("_tokens", F.coalesce("_tokens", F.array().cast("array<string>"))))
    dealt = written(feats.select("features").repartition(2 * spark.sparkContext.defaultParallelism), "features")
    lda = LDA(k=s["k"], maxIter=0, optimizer="online", seed=s["seed"],
              docConcentration=[float(s["doc_concentration"])], topicConcentration=float(s["topic_concentration"]),
              learningDecay=s["learning_decay"], learningOffset=s["learning_offset"], subsamplingRate=1.0,
              featuresCol="features", topicDistributionCol="topicDistribution")
    model = LD.fit(dealt, lda.fit(dealt), s["max_iter"], s["learning_decay"], s["learning_offset"])
    return cv_model, model, feats


def lda_top_words(spark, cv_model, lda_model, k: int = 10) -> DataFrame:
    """K-2 for LDA: ``(topic_id 1-based, rank, term, weight)`` from the model's
    topic-term matrix (k x vocabulary: the only model table on the driver)."""
    vocab = cv_model.vocabulary
    rows = []
    for r in lda_model.describeTopics(k).collect():
        for rank, (ti, w) in enumerate(zip(r["termIndices"], r["termWeights"]), start=1):
            rows.append((int(r["topic"]) + 1, rank, vocab[ti], float(w)))
    return spark.createDataFrame(rows, "topic_id int, rank int, term string, weight double")


def lda_assign(feats: DataFrame, lda_model, keywords: DataFrame, method: str = "lda", doc: str = "doc_id") -> DataFrame:
    """M-2: per document the dominant topic (1-based), its probability and the
    topic's keyword string, in the topic-assignment contract. ``feats`` has time_label and comment_text."""
    out = lda_model.mixtures(feats.drop("_tokens"), "_dist")
    out = out.withColumn("_dom", dominant_topic("_dist"))
    out = out.select("*", F.col("_dom.topic").alias("topic_id"), F.col("_dom.prob").alias("topic_prob"))
    return in_contract(keyword_lookup(out, keywords), doc, method)


# ---------------------------------------------------------------------------
# M-5: embedding-cluster topics
# ---------------------------------------------------------------------------
def cluster_topics(docs: DataFrame, vec: str = "embedding", k: int = 8, outlier_quantile: float = 0.95,
                   seed: int = 42, hold: bool = False) -> DataFrame:
    """M-5: KMeans over document vectors; documents farther from their centre
    than the ``outlier_quantile`` of all distances become the outlier topic;
    cluster ids are renumbered by size (0 = largest); ``topic_dist`` is the
    softmax of negative distances to every centre. With ``hold`` the rows are written with their distances, which are then found once."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = docs.withColumn("_features", array_to_vector(F.col(vec).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_cluster").fit(data)
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    v = F.col(vec).cast("array<double>")
    dists = F.transform(centers, lambda c: F.sqrt(F.aggregate(
        F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)))
    out = model.transform(data).withColumn("_dists", dists)
    out = out.withColumn("_own", F.element_at("_dists", (F.col("_cluster") + 1).cast("int"))).drop("_features")
    if hold:
        out = written(out, "distances")
    cut = out.select(F.percentile_approx("_own", outlier_quantile, 10000)).scalar()
    sizes = (out.groupBy("_cluster").agg(F.count("*").alias("_n"))
             .withColumn("_tid", F.row_number().over(Window.orderBy(F.desc("_n"), "_cluster")) - 1))
    mx = F.array_min("_dists")
    soft = T.let(F.transform("_dists", lambda d: F.exp(mx - d)),
                 lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y)))
    return (out.join(F.broadcast(sizes.select("_cluster", "_tid")), "_cluster")
            .withColumn("topic_id", F.when(F.col("_own") > cut, F.lit(OUTLIER)).otherwise(F.col("_tid")))
            .withColumn("topic_dist", soft)
            .drop("_cluster", "_dists", "_own", "_tid"))


def cluster_assign(clustered: DataFrame, doc: str = "comment_id", text: str = "comment_text", pattern: str = T.HANGUL_TOKEN,
                   lower: bool = False, k: int = TOP_K_KEYWORDS, method: str = "bertopic", keep: Sequence[str] = ()) -> DataFrame:
    """M-5 in the topic-assignment contract: every document with its cluster, the cluster's entry of its distribution (its maximum for the
    outlier topic) and the cluster's k words of highest class TF-IDF. ``keep``: columns that stay behind the contract's."""
    return named_topics(clustered.withColumn("topic_prob", T.topic_probability(F.col("topic_id"), F.col("topic_dist"))),
                        doc, text, pattern, lower, k, method, keep=keep)


def named_topics(assigned: DataFrame, doc: str = "comment_id", text: str = "comment_text", pattern: str = T.HANGUL_TOKEN,
                 lower: bool = False, k: int = TOP_K_KEYWORDS, method: str = "bertopic", counts: DataFrame | None = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Documents with topic_id and topic_prob in the topic-assignment contract, with each topic's k words of highest class TF-IDF.
    ``counts`` (topic_id, term, n): the topics' words, where the documents were tokenised before."""
    if counts is None:
        counts = bow(doc_tokens(assigned, "topic_id", text, pattern, lower), "topic_id")
    kw = keyword_map(top_words(class_tfidf(counts, "topic_id"), k))
    return in_contract(keyword_lookup(assigned, kw), doc, method, keep)


# ---------------------------------------------------------------------------
# M-6: guided (keyword-seeded) embedding topics
# ---------------------------------------------------------------------------
def guided_topics(docs: DataFrame, vbow: DataFrame, doc: str = "doc_id",
                  text: str = "text", vec: str = "embedding", person_axis=PERSON_AXIS,
                  person_default=PERSON_DEFAULT, issue_axis=ISSUE_AXIS, issue_default=ISSUE_DEFAULT,
                  weights=GUIDED_WEIGHTS):
    """M-6: topic vectors from keyword classes, topic-word β and document θ.

    1. T-8 labels every document on both axes; A-11 averages document vectors
       per person label and per issue label.
    2. T-18: one topic per (person, issue): ``0.6 p + 0.4 i`` (declared order).
    3. Word vectors are the mean vector of the documents containing the word.
    4. T-19: β = softmax over the vocabulary of cos(topic, word).
    5. θ_d = softmax over topics of Σ_w bow_dw / (|d| + 1e-8) · log β_kw; a document
       without a vocabulary word has the uniform θ.

    ``vbow(doc, term, n)`` is the bag of words restricted to the vocabulary (at most its ``max_features`` terms).
    Returns ``(topics, beta, theta)``: ``topics(topic_id, person, issue, vector)``,
    ``beta(term, beta map<topic_id, double>)``, one row a term, and ``theta(doc, theta map<topic_id, double>)``, one
    row a document. Topic ids are 1-based in declared order. β is written to the checkpoint folder, as it is used more than once.
    """
    spark = docs.sparkSession
    persons = list(person_axis) + [person_default] if person_default not in person_axis else list(person_axis)
    issues = list(issue_axis) + ([issue_default] if issue_default not in issue_axis else [])
    lab = docs.select(doc, vec,
                      T.keyword_classify(F.col(text), person_axis, person_default).alias("person"),
                      T.keyword_classify(F.col(text), issue_axis, issue_default).alias("issue"))
    pv = V.mean_vector(lab, ["person"], vec, "pvec")
    iv = V.mean_vector(lab, ["issue"], vec, "ivec")
    grid = spark.createDataFrame(
        [(pi * len(issues) + ii + 1, p, i) for pi, p in enumerate(persons) for ii, i in enumerate(issues)],
        "topic_id int, person string, issue string")
    ensure_checkpoint_dir(spark)
    # one row for each pair of the axes' labels; pvec and ivec have one row a label
    topics = (grid.join(F.broadcast(pv), "person").join(F.broadcast(iv), "issue")
              .select("topic_id", "person", "issue", V.blend("pvec", "ivec", *weights).alias("vector"))).checkpoint(eager=True)
    terms = sorted(r.term for r in vbow.select("term").distinct().collect())  # the vocabulary
    means = GU.word_means(GU.bags(vbow, terms, doc), docs, len(terms), doc, vec)
    wv = means.join(F.broadcast(spark.createDataFrame(list(enumerate(terms)), "at int, term string")), "at").select("term", F.col("w").alias("wvec"))
    tv = V.candidate_array(topics.withColumnRenamed("topic_id", "ord").withColumn("candidate", F.col("ord").cast("string")),
                           name="candidate", vec="vector", order="ord")
    sims = (wv.select("term", F.explode(F.transform(tv, lambda t: F.struct(
        t["ord"].alias("topic_id"), V.cosine(F.col("wvec"), t["vec"]).alias("logit")))).alias("s"))
            .select("term", "s.topic_id", "s.logit"))
    beta = (V.softmax_over(sims, ["topic_id"], "logit", "beta").groupBy("term")
            .agg(F.map_from_entries(F.collect_list(F.struct("topic_id", "beta"))).alias("beta")).checkpoint(eager=True))
    ids = range(1, len(persons) * len(issues) + 1)
    # one row a (document, term): the topics' scores are columns of one aggregate, not rows
    # at most the vocabulary's terms; checked, as it is the caller's
    met = vbow.join(F.broadcast(beta) if beta.count() <= MAX_BROADCAST_TERMS else beta, "term")
    score = met.groupBy(doc).agg(F.sum("n").alias("_len"), *[F.sum(F.col("n") * F.log(F.try_element_at("beta", F.lit(k)))).alias(f"_s{k}") for k in ids])
    logits = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), (F.col(f"_s{k}") / (F.col("_len") + 1e-8)).alias("s")) for k in ids]),
                      lambda x: x["s"].isNotNull())
    top = F.array_max(F.transform("_l", lambda x: x["s"]))
    score = score.select(doc, logits.alias("_l")).withColumn("_e", F.transform("_l", lambda x: F.struct(x["k"].alias("k"), F.exp(x["s"] - top).alias("e"))))
    total = F.aggregate("_e", F.lit(0.0), lambda acc, x: acc + x["e"])
    score = score.select(doc, F.map_from_entries(F.transform("_e", lambda x: F.struct(x["k"], (x["e"] / total).alias("theta")))).alias("theta"))
    n = topics.count()
    uniform = F.map_from_entries(F.array(*[F.struct(F.lit(r.topic_id).cast("int").alias("k"), F.lit(1.0 / n).alias("t"))
                                           for r in topics.select("topic_id").orderBy("topic_id").collect()]))
    theta = docs.select(doc).join(score, doc, "left").withColumn("theta", F.coalesce("theta", uniform))
    return topics, beta, theta


TIE_DIGITS = 10


def guided_assign(docs: DataFrame, theta: DataFrame, beta: DataFrame, doc: str = "doc_id", k: int = 10, method: str = "etm") -> DataFrame:
    """M-6 in the topic-assignment contract: every document with its topic (the largest θ, the smallest id among equals), its
    probability and the topic's k most probable words. Values that agree to ten digits are ties (sums of floating-point numbers differ in the
    last digits with their order). ``docs``: doc, time_label, comment_text."""
    entries = F.map_entries("theta")
    best = F.array_max(F.transform(entries, lambda x: F.struct(F.round(x["value"], TIE_DIGITS).alias("p"), (-x["key"]).alias("k"))))
    own = theta.select(doc, best.alias("b")).select(doc, (-F.col("b.k")).alias("topic_id"), F.col("b.p").alias("topic_prob"))
    words = beta.select("term", F.explode("beta").alias("topic_id", "weight")).withColumn("weight", F.round("weight", TIE_DIGITS))
    kw = keyword_map(top_words(words, k))
    return in_contract(keyword_lookup(docs.join(own, doc), kw), doc, method)


def in_contract(assigned: DataFrame, doc: str, method: str, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of the topic-assignment contract, whichever model made them, and those to ``keep``."""
    return (assigned.withColumn("topic_method", F.lit(method)).withColumnRenamed(doc, "comment_id")
            .select(*TOPIC_ASSIGNMENT_COLUMNS, *keep))
