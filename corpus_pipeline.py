"""Corpus pipeline: quality rules, line deduplication, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and gives the next one's documents; ``run`` writes each stage's documents as Parquet into
the folder that the cluster names in ``spark.checkpoint.dir`` and reads them again. The stages that change a text set
``n_chars`` anew.

Defined results: null and empty texts are rejected by the quality rules; very long texts go through whole; further columns are carried along,
also where their names are ones that an operator uses inside; an id that repeats is judged and cleaned row by row,
and of its rows with unlinked texts all stay behind the near-duplicate stage; a null id is kept as it is; an empty table gives no pieces."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import lines, pii, queries, rules, simhash
from murmur.llm.common import table
from murmur.session import ensure_checkpoint_dir


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; cutoffs per language, from the labels."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines of 50 words or more that occur earlier."""
    out, info = lines.dedup_lines(docs, min_words=50)
    return _counted(out.drop(info))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: 3-word shingles, at most 2 bits apart."""
    return simhash.keep_one(docs, width=3, max_bits=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    return _counted(pii.redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens. Executors hold what the stages before left behind, so fewer words are remembered
    than where packing runs alone."""
    return queries.packed(docs, words=200_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL has no XXH64 with a seed, no boosted trees and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the documents."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
