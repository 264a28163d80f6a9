"""Table contracts (IO-5, PF-8, K-6) and the period dimension.

Checks here are plan-time: they read ``df.schema`` / ``df.columns`` and never
run a job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Tp

# The column contracts between pipeline stages.
TOPIC_ASSIGNMENT_COLUMNS = ["comment_id", "time_label", "comment_text", "topic_id", "topic_prob",
                            "topic_keywords", "topic_method"]
CLUSTER_OUTPUT_COLUMNS = ["comment_id", "time_label", "comment_text", "topic_id", "topic_keywords",
                          "candidate", "final_cluster"]
FORECAST_INPUT_COLUMNS = ["final_cluster", "negative", "positive", "time_label"]

COMMENTS_SCHEMA = Tp.StructType([
    Tp.StructField("comment_id", Tp.LongType()),
    Tp.StructField("comment_author_id", Tp.LongType()),
    Tp.StructField("comment_published", Tp.TimestampType()),
    Tp.StructField("comment_text", Tp.StringType()),
    Tp.StructField("channel", Tp.StringType()),
    Tp.StructField("time_label", Tp.StringType()),
])

TOPIC_ASSIGNMENT_SCHEMA = Tp.StructType([
    Tp.StructField("comment_id", Tp.LongType()),
    Tp.StructField("time_label", Tp.StringType()),
    Tp.StructField("comment_text", Tp.StringType()),
    Tp.StructField("topic_id", Tp.IntegerType()),
    Tp.StructField("topic_prob", Tp.DoubleType()),
    Tp.StructField("topic_keywords", Tp.StringType()),
    Tp.StructField("topic_method", Tp.StringType()),
])

SENTIMENT_SUMMARY_SCHEMA = Tp.StructType([
    Tp.StructField("final_cluster", Tp.StringType()),
    Tp.StructField("positive", Tp.DoubleType()),
    Tp.StructField("negative", Tp.DoubleType()),
    Tp.StructField("neutral", Tp.DoubleType()),
    Tp.StructField("total_comments", Tp.LongType()),
    Tp.StructField("time_label", Tp.StringType()),
    Tp.StructField("model_path", Tp.StringType()),
])

BOT_STATS_COLUMNS = ["comment_author_id", "comment_count", "time_var_sec", "length_var", "avg_rep_ratio",
                     "time_var_hr", "avg_ai_prob", "cond_speed", "cond_ai", "suspicious_score",
                     "cond_suspicious", "high_rep", "low_len_var", "is_bot"]


def contract_faults(df: DataFrame, contract: Tp.StructType | Sequence[str]) -> dict[str, str]:
    """IO-5: what stands against a contract, by column: ``missing``, or the type found where another one is
    asked for. A contract given by names alone asks for no types; any integer or any floating type stands for the others of its sort."""
    kinds = {Tp.ByteType: "integer", Tp.ShortType: "integer", Tp.IntegerType: "integer", Tp.LongType: "integer",
             Tp.FloatType: "floating", Tp.DoubleType: "floating", Tp.TimestampNTZType: "timestamp", Tp.TimestampType: "timestamp"}
    found = {f.name: f.dataType for f in df.schema.fields}
    faults = {}
    for want in contract.fields if isinstance(contract, Tp.StructType) else [Tp.StructField(c, Tp.NullType()) for c in contract]:
        if want.name not in found:
            faults[want.name] = "missing"
        elif want.dataType != Tp.NullType():
            have = found[want.name]
            if kinds.get(type(have), have) != kinds.get(type(want.dataType), want.dataType):
                faults[want.name] = f"{have.simpleString()} instead of {want.dataType.simpleString()}"
    return faults


def require_columns(df: DataFrame, contract: Tp.StructType | Sequence[str], what: str = "input") -> DataFrame:
    """IO-5 / K-6: raise if ``df`` doesn't meet a contract (schema only, no job)."""
    if faults := contract_faults(df, contract):
        raise ValueError(f"{what} does not meet its contract: {faults}")
    return df


def contract_projection(df: DataFrame, columns: Sequence[str],
                        types: Tp.StructType | None = None, keep_extra: bool = False) -> DataFrame:
    """PF-8: project to a contract; absent contract columns become typed nulls."""
    tmap = {f.name: f.dataType for f in types.fields} if types else {}
    cols = []
    for c in columns:
        if c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast(tmap.get(c, Tp.StringType())).alias(c))
    if keep_extra:
        cols += [F.col(c) for c in df.columns if c not in columns]
    return df.select(*cols)


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PF-2: drop rows with a null in any of ``columns``."""
    return df.dropna(subset=list(columns))


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PF-3: non-numeric values become null (``try_cast`` to double)."""
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("string").try_cast("double"))
    return df
