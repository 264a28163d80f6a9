"""Sentiment: label mapping, classifier training/scoring and the per-cluster
summary (T-15, M-7, M-8, A-3, K-4)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.text import sentiment_label
from murmur.operators.neighbours import written

CLASSES = ("positive", "negative", "neutral")
SUMMARY_DIGITS = 6
TRAIN_FRACTION = 0.9
SEED = 42
BOOTSTRAP = 200


def sentiment_summary(detail: DataFrame, model_path: str, cls: str = "sentiment_class") -> DataFrame:
    """A-3 + K-4: per (time_label, final_cluster) the share of each class,
    rounded half-to-even to 6 digits, and the row count; ordered by
    (time_label, final_cluster). Rows missing any key are dropped first (PF-2)."""
    d = detail.dropna(subset=["comment_text", "final_cluster", "time_label"])
    aggs = [F.bround(F.avg((F.col(cls) == c).cast("double")), SUMMARY_DIGITS).alias(c) for c in CLASSES]
    return (d.groupBy("time_label", "final_cluster")
            .agg(*aggs, F.count("*").alias("total_comments"))
            .select("final_cluster", *CLASSES, "total_comments", "time_label",
                    F.lit(model_path).alias("model_path"))
            .orderBy("time_label", "final_cluster"))


def held_out(text: str, label: str, seed: int = SEED, fraction: float = 1 - TRAIN_FRACTION) -> Column:
    """Is a row in the held-out part? A hash of seed, class and text decides, so the split is the same however the rows lie in partitions, holds
    about the same share of each class, and never parts copies of a text."""
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(label).cast("string"), F.col(text)), F.lit(1_000_000))
    return at < int(round(fraction * 1_000_000))


def bootstrap_metrics(pred: DataFrame, rounds: int = BOOTSTRAP, seed: int = SEED) -> DataFrame:
    """One row: accuracy and weighted F1 of (text, label, prediction), each with the bounds of its 95 % interval.

    Round 0 counts every row once; in each other round a row counts as often as a Poisson number with mean 1, taken from a hash of its text, its
    classes and the round (for n copies of a row: with mean n, for which the rounded normal number stands). One aggregate over (round, label,
    prediction) gives all rounds, whose metrics are computed from these counts."""
    draw = lambda salt: (F.pmod(F.xxhash64(F.lit(seed + salt), "round", "text", "label", "prediction"), F.lit(1 << 30)) + 0.5) / F.lit(float(1 << 30))
    poisson, below, term = F.lit(0), 0.0, math.exp(-1)
    for k in range(1, 11):
        below += term
        term /= k
        poisson = poisson + (draw(0) >= F.lit(below)).cast("int")
    normal = F.sqrt(-2 * F.log(draw(0))) * F.cos(2 * math.pi * draw(1))
    poisson = F.when(F.col("n") == 1, poisson).otherwise(F.greatest(F.lit(0), F.round(F.col("n") + F.sqrt("n") * normal)))
    rows = pred.groupBy("text", "label", "prediction").agg(F.count("*").alias("n")).withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds))))
    rows = rows.withColumn("w", F.when(F.col("round") == 0, F.col("n")).otherwise(poisson))
    # rounds x classes x classes; written, or each of its uses would predict and draw anew (one of them on rows that a filter takes first)
    cells = written(rows.groupBy("round", "label", "prediction").agg(F.sum("w").cast("double").alias("w")), "cells")
    by = lambda c: cells.groupBy("round", F.col(c).alias("class")).agg(F.sum("w").alias(c))
    hit = cells.where("label = prediction").select("round", F.col("label").alias("class"), F.col("w").alias("hit"))
    f1 = by("label").join(by("prediction"), ["round", "class"], "full").join(hit, ["round", "class"], "left").fillna(0.0, ["label", "prediction", "hit"])
    f1 = f1.withColumn("f", F.coalesce(F.try_divide(2 * F.col("hit"), F.col("label") + F.col("prediction")), F.lit(0.0)))
    total = f1.groupBy("round").agg(F.try_divide(F.sum("hit"), F.sum("label")).alias("accuracy"), F.try_divide(F.sum(F.col("f") * F.col("label")), F.sum("label")).alias("f1"))
    out = []
    for m in ("accuracy", "f1"):
        drawn = F.when(F.col("round") > 0, F.col(m))
        out += [F.max(F.when(F.col("round") == 0, F.col(m))).alias(m), F.percentile(drawn, F.lit(0.025)).alias(f"{m}_low"), F.percentile(drawn, F.lit(0.975)).alias(f"{m}_high")]
    return total.agg(*out)


def train_sentiment(labelled: DataFrame, text: str = "text", label: str = "label",
                    num_features: int = 1 << 18, seed: int = SEED, max_iter: int = 50):
    """M-7: 90/10 split by a keyed hash within each class, whitespace tokens -> hashed TF -> IDF -> logistic
    regression. Returns ``(model, metrics_df)``; metrics and their intervals come from the held-out
    tenth. Texts are tokenised once: the counts of their tokens are written, and all passes of the fits and the evaluation read
    those; of the texts, only the held-out ones are kept beside them."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    data = labelled.select(F.col(text).alias("text"), F.col(label).cast("double").alias("label"))
    tok = RegexTokenizer(inputCol="text", outputCol="_tok", pattern=r"(?U)\s+", toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    counted = tf.transform(tok.transform(data.withColumn("_test", held_out("text", "label", seed))))
    counted = written(counted.select("label", "_tf", "_test", F.when(F.col("_test"), F.col("text")).alias("text")), "counted")
    train = counted.filter(~F.col("_test"))
    idf = IDF(inputCol="_tf", outputCol="features").fit(train)
    lr = LogisticRegression(maxIter=max_iter, featuresCol="features", labelCol="label").fit(idf.transform(train))
    pred = lr.transform(idf.transform(counted.filter("_test"))).select("text", "label", "prediction")
    return PipelineModel([tok, tf, idf, lr]), bootstrap_metrics(pred, seed=seed).checkpoint(eager=True)


def score_sentiment(model, comments: DataFrame, text: str = "comment_text",
                    id2label: dict[int, str] | None = None, num_labels: int = 2) -> DataFrame:
    """M-8: batch inference, then T-15 on the model's ``LABEL_n`` output."""
    scored = model.transform(comments.withColumn("text", F.col(text)))
    lbl = F.concat(F.lit("LABEL_"), F.col("prediction").cast("int").cast("string"))
    return (scored.withColumn("sentiment_class", sentiment_label(lbl, id2label, num_labels))
            .drop("text", "_tok", "_tf", "features", "rawPrediction", "probability", "prediction"))
