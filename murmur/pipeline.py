"""The whole chain with real hand-offs: comments without automated authors -> vectors and topics -> entity clusters -> sentiment ->
period summaries -> entity features -> boosted targets and predicted shares (T-, M-, F-, E- rows of the blueprint).

Each stage takes what the one before it made; a stage whose result is used more than once is written to the checkpoint folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.operators import boosting, bots, clustering, embed, forecast, sentiment, topics
from murmur.operators.neighbours import written
from murmur.session import ensure_checkpoint_dir


def assigned_topics(comments: DataFrame, dim: int, k: int, pattern: str, lower: bool) -> DataFrame:
    """Topic assignments in the contract, with each comment's vector (M-3, M-5). The vectors are written once, for the centres and the distances, and
    so are the distances, for the quantile, the sizes, the keywords and the result; the vector stays in its row."""
    vectors = embed.embed_text(comments, "comment_text", "embedding", "hashing", dim)
    vectors = written(vectors.select("comment_id", "time_label", "comment_text", "embedding"), "vectors")
    found = topics.cluster_topics(vectors, "embedding", k=k, hold=True)
    return topics.cluster_assign(found, pattern=pattern, lower=lower, keep=["embedding"])


def candidate_vectors(spark, candidates: Sequence[str], dim: int) -> DataFrame:
    """Candidates in declared order with the vectors of their names, by the comments' encoder."""
    names = spark.createDataFrame([(i, c) for i, c in enumerate(candidates)], "ord int, candidate string")
    return embed.embed_text(names, "candidate", "embedding", "hashing", dim).select("ord", "candidate", "embedding")


def cluster_name_vectors(clusters: DataFrame, dim: int, reduced: int) -> DataFrame:
    """PF-9 + M-3 + M-4: each cluster's name as a phrase, encoded and reduced (F-2's input)."""
    names = clusters.select("final_cluster").distinct().withColumn("phrase", T.cluster_phrase("final_cluster"))
    vectors = embed.embed_text(names, "phrase", "embedding", "hashing", dim)
    out, _ = embed.reduce_dims(vectors, "embedding", reduced)
    return out.select("final_cluster", F.col("reduced").alias("vector"))


def entity_features(comments: DataFrame, labelled: DataFrame, candidates: Sequence[str], variant: str = "news", dim: int = 256, k: int = 8,
                    reduced: int = 10, pattern: str = T.HANGUL_TOKEN, lower: bool = False) -> DataFrame:
    """One row a (period, candidate): mean sentiment, cluster count and cluster-name vector. ``labelled`` (text, label) trains the
    sentiment classifier."""
    spark = comments.sparkSession
    ensure_checkpoint_dir(spark)
    kept, _ = bots.bot_filter(comments, variant)
    assigned = assigned_topics(kept, dim, k, pattern, lower)
    clustered = clustering.cluster_topic_pairs(assigned, candidate_vectors(spark, candidates, dim))
    model, _ = sentiment.train_sentiment(labelled)
    detail = sentiment.score_sentiment(model, clustered.select("comment_id", "time_label", "final_cluster", "comment_text"))
    # of a text the summary needs whether there is one
    detail = written(detail.select("comment_id", "time_label", "final_cluster", F.when(F.col("comment_text").isNotNull(), F.lit("")).alias("comment_text"), "sentiment_class"), "detail")
    summary = sentiment.sentiment_summary(detail, "trained")
    vectors = cluster_name_vectors(summary, dim, reduced).checkpoint(eager=True)
    width = vectors.select(F.max(F.size("vector"))).first()[0] or reduced
    return forecast.entity_period(summary, candidates, vectors, width)


def forecast_shares(entities: DataFrame, targets: DataFrame, candidates: Sequence[str], period: str = "time_label", **how) -> DataFrame:
    """F-3 .. F-6, J-1, M-9 .. M-11, E-6 behind ``entity_features``: one row a (period, candidate) with the predicted share (percent of all
    candidates), the target's share where the period has one, and the absolute error.

    ``targets``: time_label (the period's ordinal) and a column a candidate. Periods that have a target are learned from, in order, each
    one's trees added to those before; all periods are predicted."""
    names = list(candidates)
    width = entities.select(F.max(F.size("embedding"))).first()[0] or 0
    feats = forecast.features(entities, names, width, period).withColumnRenamed(period, "label")
    feats = written(feats.join(F.broadcast(forecast.period_ordinals(feats, "label")), "label").withColumnRenamed("ordinal", "time_label"), "features")
    actual = forecast.row_percent(targets, names).select("time_label", *names)
    wanted = [f"target_{c}" for c in names]
    train = written(forecast.features_x_target(feats, actual.select("time_label", *[F.col(c).alias(t) for c, t in zip(names, wanted)])), "train")
    model = boosting.BoostModel(wanted, [c for c in feats.columns if c not in ("label", "time_label")])
    for r in train.select("time_label").distinct().orderBy("time_label").collect():  # one row a period
        model = boosting.boost(train.where(F.col("time_label") == r.time_label), ["time_label"], model, **how)
    pred = boosting.predict(feats, model).select("time_label", "label", *[F.col(f"pred_{t}").alias(c) for c, t in zip(names, wanted)])
    pred = forecast.row_percent(pred, names)
    long = pred.unpivot(["time_label", "label"], names, "candidate", "predicted")
    known = actual.unpivot(["time_label"], names, "candidate", "actual")
    out = long.join(known, ["time_label", "candidate"], "left")
    return out.select(F.col("label").alias("period"), "candidate", "predicted", "actual", F.abs(F.col("predicted") - F.col("actual")).alias("abs_error"))
