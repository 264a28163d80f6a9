"""Streaming extension (not a reference capability; SURVEY 2.13).

The reference is batch only. The same per-comment measures run unchanged on
a Structured Streaming source: event-time tumbling windows per author with a
watermark, so late comments inside the watermark still count and state is
dropped once a window closes. Output mode ``append`` emits each window once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.operators.bots import AUTHOR, PUBLISHED, TEXT, VARIANTS


def author_activity(stream: DataFrame, window: str = "1 hour", watermark: str = "1 day",
                    variant: str = "news") -> DataFrame:
    """Per (author, event-time window): comment count, length sum and sum of
    squares (sample variance is derived from them), mean repetition ratio and
    mean AI-likeness. Works on batch and streaming DataFrames alike."""
    single_var = VARIANTS[variant][0]
    ts = F.col(PUBLISHED).cast("timestamp")
    ln = T.text_length(TEXT).cast("double")
    s = (stream.withColumn("_ts", ts).filter(F.col("_ts").isNotNull() & F.col(AUTHOR).isNotNull())
         .withWatermark("_ts", watermark))
    out = (s.groupBy(F.window("_ts", window).alias("window"), AUTHOR)
           .agg(F.count("*").alias("comment_count"),
                F.sum(ln).alias("len_sum"), F.sum(ln * ln).alias("len_sq_sum"),
                F.avg(T.repetition_ratio(TEXT)).alias("avg_rep_ratio"),
                F.avg(T.ai_likeness(TEXT, single_var)).alias("avg_ai_prob")))
    n = F.col("comment_count")
    var = F.when(n >= 2, (F.col("len_sq_sum") - F.col("len_sum") * F.col("len_sum") / n) / (n - 1))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      AUTHOR, "comment_count", var.alias("length_var"), "avg_rep_ratio", "avg_ai_prob")


def run_to_memory(stream_df: DataFrame, name: str, checkpoint: str):
    """Drive a streaming query to completion into a memory table (tests, demos)."""
    q = (stream_df.writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
