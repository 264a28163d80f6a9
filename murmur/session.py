"""Spark session and cluster-facing settings.

The library never owns cluster settings: it reads what the session has and
only fills gaps (tests, local runs).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let row_number() <= N filters insert a partial per-group limit before
    # the shuffle for caps up to this size (collection caps reach 6000)
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, partitions: int = 8, app: str = "murmur",
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on:
    UTC session time zone, AQE with skew-join splitting, no UI."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf["spark.driver.memory"] = os.environ.get("MURMUR_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint directory that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a single-machine session (``local[...]``, tests) gets a scratch directory;
    on a cluster that is an error, as executors on other machines could not read such a folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="murmur-ckpt-")
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
