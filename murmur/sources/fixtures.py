"""Bind the driver's testdata tables to the pipeline's contract tables.

Every derivation here is a Spark plan over the given parquet tables (column
pruned at the scan), so its work grows with the data. The SQL oracle builds the
same tables with the same rules (see ``murmur.plans.oracle``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.operators import forecast as FC

N_CANDIDATES = 3
OVERLAY_START = "2024-01-01 00:00:00"
OVERLAY_STEP_SEC = 30
OVERLAY_COMMENTS = 6
OVERLAY_OFFSET = 1_000_000_000  # derived ids lie above all given ones


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a small table out to all cores if it is read in fewer partitions than there are cores (a file of one row group can't be
    split). A table of many files or row groups is left as it is read: its texts are not moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def day_label(ts) -> F.Column:
    """Period label of a one-day bucket in the ``MMDD_MMDD`` format."""
    d = F.date_format(ts, "MMdd")
    return F.concat(d, F.lit("_"), d)


def comments(spark: SparkSession, sf_dir: str, overlay: bool = True, texts: bool = True) -> DataFrame:
    """All ``documents`` as the comments contract: document i has the time and author of event i * stride, stride being
    how many events there are for each document, so the comments span the events' whole time.

    With ``overlay``, rows are added for authors that trip the bot rules: every tenth comment gives a derived author with six comments at
    regular intervals, whose text is one repeated word, the text's first 120 characters, or the text. Without ``texts``, comment_text is
    an empty one where there is a text, and the joins carry none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    stride = max(1, ev.count() // max(1, docs.count()))
    if not texts:
        docs = docs.withColumn("text", F.when(F.col("text").isNotNull(), F.lit("")))
    docs = spread(docs)
    base = docs.join(ev, docs.doc_id * stride == ev.event_id).select(
        F.col("doc_id").alias("comment_id"),
        F.col("user_id").alias("comment_author_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts0"),
        F.col("text").alias("text0"),
        F.col("source").alias("channel"),
    )
    if overlay:
        m = F.floor(F.col("comment_id") / 10) % 3
        start = F.lit(OVERLAY_START).cast("timestamp_ntz")
        made = base.where(F.col("comment_id") % 10 == 0).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(OVERLAY_COMMENTS).cast("long"))))
        base = base.unionByName(made.select(
            (F.col("comment_id") + F.col("k") * OVERLAY_OFFSET).alias("comment_id"),
            (F.col("comment_id") + OVERLAY_OFFSET).alias("comment_author_id"),
            F.timestamp_add("SECOND", F.col("k") * OVERLAY_STEP_SEC, start).alias("ts0"),
            F.when(m == 0, F.repeat(F.concat(F.split_part("text0", F.lit(" "), F.lit(1)), F.lit(" ")), 6))
            .when(m == 1, F.substring("text0", 1, 120)).otherwise(F.col("text0")).alias("text0"),
            "channel"))
    published, text = F.col("ts0"), F.col("text0")
    return base.select(
        "comment_id", "comment_author_id",
        published.alias("comment_published"),
        text.alias("comment_text"),
        "channel",
        day_label(published).alias("time_label"),
    )


def candidates(spark: SparkSession, sf_dir: str, n: int = N_CANDIDATES) -> DataFrame:
    """Candidate entities: the first ``n`` embedding rows, named ``cand_{i}``."""
    e = table(spark, sf_dir, "embeddings")
    return (e.filter(F.col("vec_id") < n)
            .select(F.col("vec_id").cast("int").alias("ord"),
                    F.concat(F.lit("cand_"), F.col("vec_id").cast("string")).alias("candidate"),
                    F.col("embedding").cast("array<double>").alias("embedding")))


def candidate_names(n: int = N_CANDIDATES) -> list[str]:
    return [f"cand_{i}" for i in range(n)]


def sentiment_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels``: toxic -> negative, else quality -> positive, else neutral."""
    lab = table(spark, sf_dir, "labels")
    cls = (F.when(F.col("toxic") == 1, "negative")
           .when(F.col("quality") == 1, "positive").otherwise("neutral"))
    return lab.select(F.col("doc_id").alias("comment_id"), cls.alias("sentiment_class"))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll rows: ``lineitem`` date = ship date, weight = quantity, three
    candidate columns from price, discount and tax."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("date"),
        F.col("l_extendedprice").alias("cand_0"),
        F.col("l_discount").alias("cand_1"),
        F.col("l_tax").alias("cand_2"),
        F.col("l_quantity").alias("weight"),
    )


# The period dimension used with ``polls`` (1-based ordinal,
# inclusive start and end day), given the way the forecaster takes it: as a
# ``start:end,...`` parameter string (T-22). It has a range with no rows (2),
# an overlap (ranges 1 and 3), a gap (1996-07..1996-12) and a one-day range (5).
POLL_RANGES_SPEC = ("1995-01-01:1995-12-31, 2010-01-01:2010-12-31, 1995-07-01:1996-06-30, "
                    "1997-01-01:1997-03-31, 1998-02-01:1998-02-01")


def ranges(spark: SparkSession, spec: str = POLL_RANGES_SPEC) -> DataFrame:
    """Period dimension ``(ordinal, label, start, end)``."""
    return FC.ranges_frame(spark, spec)


def train_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled text for the sentiment trainer: documents x labels, label = toxic."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return docs.join(lab, "doc_id").select("doc_id", "text", F.col("toxic").alias("label"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


__all__ = [
    "table", "comments", "candidates", "candidate_names", "sentiment_classes", "polls",
    "ranges", "POLL_RANGES_SPEC", "train_text", "pages", "day_label", "T",
]


# ---------------------------------------------------------------------------
# Topic assignments, clustered comments, sentiment detail
# ---------------------------------------------------------------------------
FIXTURE_METHOD = "fixture"
FIXTURE_MODEL_PATH = "labels"
EMBEDDING_DIM = 64    # the given vectors, whole
OUTLIER_LABEL = 0      # embeddings.label 0 plays the outlier topic (-1)


def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")


def vector_count(spark: SparkSession, sf_dir: str) -> int:
    return max(1, table(spark, sf_dir, "embeddings").count())


def topic_base(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """Every comment (no overlay) with a vector of ``embeddings``: vector number comment_id modulo the number of vectors.
    The topic id is ``label`` (label 0 becomes the outlier topic -1), the
    comment vector ``embedding``. Without ``texts`` (see ``comments``) no text is moved."""
    c = comments(spark, sf_dir, overlay=False, texts=texts)
    e = _embeddings(spark, sf_dir)
    topic = F.when(F.col("label") == OUTLIER_LABEL, F.lit(-1)).otherwise(F.col("label")).cast("int")
    return c.join(e, c.comment_id % vector_count(spark, sf_dir) == e.vec_id).select(
        "comment_id", "time_label", "comment_text", "channel", topic.alias("topic_id"), "embedding")


def topic_assignments(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """The topic-assignment contract over the testdata (plus ``embedding`` and
    ``channel``): keywords are each topic's five most frequent lower-cased
    letter tokens (count desc, term asc); the document's topic distribution is
    the L1-normalised absolute value of its vector."""
    from murmur.operators import topics as TP
    from murmur.operators.neighbours import written
    base = topic_base(spark, sf_dir)
    if texts:  # read for the keywords and again for the rows
        base = written(base, "topic-base")
    toks = TP.doc_tokens(base, "topic_id", "comment_text", T.LETTER_TOKEN, lower=True)
    counts = toks.groupBy("topic_id", "term").agg(F.count("*").alias("weight"))
    kw = TP.keyword_map(TP.top_words(counts, TP.TOP_K_KEYWORDS))
    d = F.transform("embedding", lambda x: F.abs(x))
    dist = T.let(d, lambda a: F.transform(a, lambda x: x / F.aggregate(a, F.lit(0.0), lambda s, y: s + y)))
    out = (base if texts else topic_base(spark, sf_dir, False)).withColumn("topic_prob", T.topic_probability(F.col("topic_id"), dist))
    return (TP.keyword_lookup(out, kw)
            .withColumn("topic_method", F.lit(FIXTURE_METHOD))
            .select("comment_id", "time_label", "comment_text", "topic_id", "topic_prob", "topic_keywords",
                    "topic_method", "embedding", "channel"))


def clustered(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    from murmur.operators.clustering import cluster_topic_pairs
    return cluster_topic_pairs(topic_assignments(spark, sf_dir, texts), candidates(spark, sf_dir))


def sentiment_detail(spark: SparkSession, sf_dir: str, cl: DataFrame | None = None) -> DataFrame:
    """Clustered comments with a sentiment class; one without a label is neutral."""
    cl = clustered(spark, sf_dir) if cl is None else cl
    return (cl.join(sentiment_classes(spark, sf_dir), "comment_id", "left")
            .withColumn("sentiment_class", F.coalesce("sentiment_class", F.lit("neutral"))))


def sentiment_summary(spark: SparkSession, sf_dir: str, cl: DataFrame | None = None) -> DataFrame:
    from murmur.operators.sentiment import sentiment_summary as summarize
    return summarize(sentiment_detail(spark, sf_dir, cl), FIXTURE_MODEL_PATH)


def cluster_vectors(spark: SparkSession, sf_dir: str, dim: int = EMBEDDING_DIM,
                    cl: DataFrame | None = None) -> DataFrame:
    """Cluster vector = mean of its member comments' vectors."""
    from murmur.operators.forecast import cluster_vectors_from_members
    cl = clustered(spark, sf_dir) if cl is None else cl
    return cluster_vectors_from_members(cl, dim=dim)


def entity_period(spark: SparkSession, sf_dir: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Both branches (summary, cluster vectors) read the clustered comments, written once: of a text, only whether there is one."""
    from murmur.operators.forecast import entity_period as ep
    from murmur.operators.neighbours import written
    cl = written(clustered(spark, sf_dir, texts=False).select("comment_id", "time_label", "comment_text", "final_cluster", "candidate", "embedding"), "clustered")
    return ep(sentiment_summary(spark, sf_dir, cl), candidate_names(), cluster_vectors(spark, sf_dir, dim, cl), dim)
