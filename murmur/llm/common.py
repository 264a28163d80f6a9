"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.session import ensure_checkpoint_dir

#: The words of every operator here: runs of anything but space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and go on from there: what follows neither
    recomputes it nor depends on any one executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """As ``cut_lineage``, as a Parquet table in that folder: smaller, where the partitioning needn't be kept."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_by_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker and kept for its later tasks, until another operator (the key's first part) works
    there. For memories of pure functions only, of bounded size: a result never depends on what is kept."""
    kept = sys.__dict__.setdefault("_murmur_kept", {})
    for k in [k for k in kept if k[0] != key[0]]:
        del kept[k]
    if key not in kept:
        kept[key] = make()
    return kept[key]


def fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``n``. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have in any case, made from ``base``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base
