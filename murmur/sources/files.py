"""File sources and sinks (IO-1 .. IO-8, IO-15, PF-8, PF-12, W-8).

Inputs are read with explicit schemas (no inference); the source file of each
row comes from the ``_metadata`` column, so "per file" rules are ordinary
column keys and the read stays one distributed scan over all files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Tp

from murmur.functions.text import time_label_from_path, unicode_strip
from murmur.schemas import COMMENTS_SCHEMA, require_columns  # noqa: F401
from murmur.session import ensure_checkpoint_dir

# Tokens pandas reads as missing in CSV (its default ``na_values``), kept so
# a CSV round trip matches the reference's NaN handling.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]


def expand(spark: SparkSession, path: str) -> list[str]:
    """The existing paths that ``path`` names, wildcards expanded, sorted. The path's own file system is asked (local, HDFS, object
    store ...), so this holds for every path that Spark can read. Only names pass the driver."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    names = [f.getPath().toString() for f in found or []]
    return sorted(n.removeprefix("file:") if n.startswith("file:/") and "://" not in path else n for n in names)


def existing_inputs(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """IO-2: keep the paths that exist; missing files are skipped, not fatal."""
    return [found for p in paths for found in expand(spark, p)]


def topic_file_scan(spark: SparkSession, method: str, data_dir: str, explicit: Sequence[str] | None = None,
                    pattern: str | None = None) -> list[str]:
    """IO-3: explicit list > glob pattern > ``topic_assignments_*_{method}.csv``; sorted."""
    if explicit:
        return sorted(explicit)
    return expand(spark, pattern or f"{data_dir.rstrip('/')}/topic_assignments_*_{method}.csv")


def read_csv(spark: SparkSession, paths: Sequence[str], schema: Tp.StructType | str | None = None,
             na_tokens: Sequence[str] | None = None) -> DataFrame:
    """CSV with embedded newlines, doubled quotes and a BOM, plus the source
    file path as ``file_path``. ``na_tokens`` lists values read as null."""
    r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
         .option("encoding", "UTF-8").option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(list(paths))
    df = df.withColumn("file_path", F.col("_metadata.file_path"))
    if na_tokens:
        for name, dtype in df.dtypes:
            if dtype == "string" and name != "file_path":
                df = df.withColumn(name, F.when(~F.col(name).isin(list(na_tokens)), F.col(name)))
    return df


def clean_texts(df: DataFrame, text: str = "text", file_col: str = "file_path") -> DataFrame:
    """IO-1 rule on any (file, text) table: per file drop null text, drop exact
    duplicates *before* stripping, strip, drop blanks. Duplicates across files
    and duplicates that only appear after stripping are kept."""
    return (df.filter(F.col(text).isNotNull())
            .dropDuplicates([file_col, text])
            .withColumn(text, unicode_strip(F.col(text)))
            .filter(F.col(text) != ""))


def scan_comments(spark: SparkSession, paths: Sequence[str], text_col: str = "comment_text") -> DataFrame:
    """IO-1 + IO-2 + IO-4: load many comment CSVs into ``(file_path,
    time_label, text)`` rows."""
    files = existing_inputs(spark, paths)
    if not files:
        return spark.createDataFrame([], "file_path string, time_label string, text string")
    df = read_csv(spark, files, na_tokens=PANDAS_NA_TOKENS).select(
        "file_path", F.col(text_col).alias("text"))
    return (clean_texts(df, "text", "file_path")
            .withColumn("time_label", time_label_from_path(F.col("file_path")))
            .select("file_path", "time_label", "text"))


def label_fallback(df: DataFrame, label: str = "time_label", path: str = "file_path") -> DataFrame:
    """PF-12: keep a row's own period label, else derive it from its path."""
    return df.withColumn(label, F.coalesce(F.col(label), time_label_from_path(F.col(path))))


def union_frames(spark: SparkSession, frames: Sequence[DataFrame], schema: Tp.StructType | str) -> DataFrame:
    """IO-15 / S-1: concatenate by name; no input gives a typed empty table."""
    if not frames:
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def stable_id(df: DataFrame, order_cols: Sequence[str], out: str = "comment_id") -> DataFrame:
    """W-8: consecutive 0-based ids in a total order, without one-task windows.

    A range-partitioned sort puts rows in global order across partitions;
    per-partition row counts (one small row per partition) give each
    partition's offset, and ``monotonically_increasing_id`` the position inside
    it. The sorted, tagged rows are written to the checkpoint folder once and both uses read them from there: planned
    twice, the sort's sampled borders would differ and the tags would not mean the same.
    """
    ensure_checkpoint_dir(df.sparkSession)
    s = (df.orderBy(*order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    sizes = s.groupBy("_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_base"))
    offsets = sizes.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("_pid", "_base", F.coalesce("_off", F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_base"))
            .drop("_pid", "_mid", "_base", "_off"))


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------
def write_assignments(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """IO-6: one output directory per (topic_method, time_label). Only the directories that ``df`` has rows for are replaced, so
    results of several methods and periods stay side by side and a repeated run changes nothing."""
    _sink(df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic_method", "time_label"), fmt).save(path)


def _sink(writer: DataFrameWriter, fmt: str) -> DataFrameWriter:
    """CSV with a header, doubled quotes and blanks kept, so that texts with quotes and line feeds come back as they were."""
    writer = writer.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return writer


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """IO-7: overwriting sink (parquet by default, CSV with header on request)."""
    _sink(df.write.mode(mode).partitionBy(*partition_by), fmt).save(path)


ARTICLE_SINK_COLUMNS = [("keyword", "Keyword"), ("title", "Title"), ("date", "Date"), ("url", "URL")]
RUN = "run"


def append_articles(df: DataFrame, path: str, fmt: str = "parquet", run: str | None = None) -> None:
    """IO-8: append articles with the sink's column names and order.

    With ``run``, the articles go to a directory of that run, which a repetition of the run replaces: an append that failed midway
    or is sent twice doubles nothing, and other runs are not read or touched (``read_articles`` reads them all). Without it, every
    call adds its rows. A path holds either sort."""
    out = df.select(*[F.col(src).alias(dst) for src, dst in ARTICLE_SINK_COLUMNS])
    if run is None:
        return write_table(out, path, fmt, mode="append")
    _sink(out.withColumn(RUN, F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN), fmt).save(path)


def read_articles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All runs' articles, in the sink's columns."""
    names = [dst for _, dst in ARTICLE_SINK_COLUMNS]
    schema = Tp.StructType([Tp.StructField(n, Tp.StringType()) for n in [*names, RUN]])
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
    return reader.load(path).select(*names)
