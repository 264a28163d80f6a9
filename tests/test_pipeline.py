"""Stage-level invariants: contracts, encoders, model fits, guided topics, target provisioning."""

import importlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from murmur import schemas as S
from murmur.operators import embed as EM
from murmur.operators import forecast as FC
from murmur.operators import topics as TP
from murmur.plans.q_models import _guided
from murmur.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_import_without_session():
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as E; print(len(E.queries()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=".")
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.strip()) > 100


def test_require_columns_and_projection(spark):
    df = spark.createDataFrame([(1, "a")], "comment_id long, comment_text string")
    assert S.contract_faults(df, ["comment_id", "time_label", "topic_id"]) == {"time_label": "missing", "topic_id": "missing"}
    wrong = spark.createDataFrame([("1", 2)], "comment_id string, topic_id bigint")
    faults = S.contract_faults(wrong, S.TOPIC_ASSIGNMENT_SCHEMA)
    assert faults["comment_id"] == "string instead of bigint" and "topic_id" not in faults and faults["topic_prob"] == "missing"
    with pytest.raises(ValueError):
        S.require_columns(df, S.TOPIC_ASSIGNMENT_COLUMNS)
    p = S.contract_projection(df, S.TOPIC_ASSIGNMENT_COLUMNS, S.TOPIC_ASSIGNMENT_SCHEMA)
    assert p.columns == S.TOPIC_ASSIGNMENT_COLUMNS
    assert dict(p.dtypes)["topic_prob"] == "double" and p.first().topic_id is None


def test_embed_and_reduce(spark):
    d = FX.table(spark, SF, "documents").select("doc_id", "text")
    e = EM.embed_text(d, "text", "v", "hashing", 64)
    norms = e.select(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-9 for r in norms)
    red, explained = EM.reduce_dims(e, "v", 5)
    assert red.select(F.size("reduced")).distinct().first()[0] == 5 and 0 < explained <= 1.0 + 1e-9


def test_cluster_topics_ids_by_size_and_outliers(spark):
    out = TP.cluster_topics(FX.topic_base(spark, SF), "embedding", k=4, outlier_quantile=0.8)
    sizes = {r.topic_id: r.count for r in out.groupBy("topic_id").count().collect()}
    assert -1 in sizes
    ranked = [sizes[i] for i in sorted(k for k in sizes if k >= 0)]
    assert len(ranked) >= 1
    sums = out.select(F.aggregate("topic_dist", F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sums)


def test_lda_is_reproducible(spark):
    d = FX.table(spark, SF, "documents").select("doc_id", "text")
    from murmur.functions.text import LETTER_TOKEN
    cv1, m1, _ = TP.lda_fit(d, "text", LETTER_TOKEN, settings={"max_iter": 5})
    cv2, m2, _ = TP.lda_fit(d, "text", LETTER_TOKEN, settings={"max_iter": 5})
    t1 = [r.termIndices for r in m1.describeTopics(5).collect()]
    t2 = [r.termIndices for r in m2.describeTopics(5).collect()]
    assert t1 == t2


def test_guided_theta_and_beta_are_distributions(spark):
    _, topics, beta, theta, _ = _guided(spark, SF)
    b = beta.select(F.explode("beta").alias("topic_id", "beta")).groupBy("topic_id").agg(F.sum("beta").alias("s")).collect()
    t = theta.select("doc_id", F.explode("theta").alias("k", "theta")).groupBy("doc_id").agg(F.sum("theta").alias("s")).collect()
    assert len(t) == 200
    assert b and t
    assert all(abs(r.s - 1.0) < 1e-9 for r in b + t)


def test_ensure_target_builds_then_reads(spark, tmp_path):
    polls = FX.polls(spark, SF)
    ranges = FX.ranges(spark)
    path = str(tmp_path / "target")
    built = FC.ensure_target(spark, path, polls, ranges, ["cand_0", "cand_1", "cand_2"])
    again = FC.ensure_target(spark, path, None, ranges, ["cand_0"])
    assert built.count() == again.count() > 0
    with pytest.raises(FileNotFoundError):
        FC.ensure_target(spark, str(tmp_path / "none"), None, ranges, ["cand_0"])
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception):
        FC.ensure_target(spark, str(broken), polls, ranges, ["cand_0"]).count()
    assert (broken / "part-0.parquet").read_text() == "not a table"  # what can't be read is left alone


def test_parse_ranges_column(spark):
    df = spark.createDataFrame([(" 2025-01-01:2025-01-02, ,2025-02-01 : 2025-02-03",)], "r string")
    got = df.select(F.explode(FC.parse_ranges_column(F.col("r"))).alias("x")).select("x.*").collect()
    assert [(r.ordinal, r.start, r.end) for r in got] == [(1, "2025-01-01", "2025-01-02"),
                                                           (2, "2025-02-01", "2025-02-03")]
    importlib.import_module("murmur.streaming.author_activity")
