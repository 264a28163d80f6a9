"""Targets, per-period entity features and sequential boosted forecasts
(A-4, J-7, PF-2, PF-3, PF-6, PF-9, PF-11, S-3, A-5, J-8, J-9, F-2 .. F-6,
J-1, J-10, T-20, T-21, M-9 .. M-11, E-6, IO-16).

Grain: one row per (period, candidate) in long form; the wide feature row per
period is a pivot over an explicit candidate list (no extra job to discover
pivot values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.functions import vectors as V
from murmur.schemas import coerce_numeric, require_values
from murmur.session import ensure_checkpoint_dir

# Default poll periods and the booster settings.
DEFAULT_POLL_DATE_RANGES = [
    ("2025-05-19", "2025-05-21"),
    ("2025-05-24", "2025-05-26"),
    ("2025-05-28", "2025-05-30"),
]
DEFAULT_CANDIDATES = ["이재명", "김문수", "이준석"]
BOOSTER = dict(n_estimators=50, learning_rate=0.1, max_depth=4, subsample=0.8, colsample=0.8)
DEFAULT_POSITIVE = 0.5
DEFAULT_NEGATIVE = 0.5


# ---------------------------------------------------------------------------
# T-22 / A-4: targets from polls
# ---------------------------------------------------------------------------
def parse_ranges_column(raw: Column) -> Column:
    """T-22 as a column expression: array<struct<ordinal, start, end>> from a
    ``'a:b,c:d'`` string column; a bad token raises at run time."""
    toks = F.filter(F.transform(F.split(raw, ","), lambda t: F.trim(t)), lambda t: t != "")
    checked = F.transform(toks, lambda t: F.when(t.contains(":"), t).otherwise(
        F.raise_error(F.concat(F.lit("bad date range token: "), t))))
    return F.transform(checked, lambda t, i: F.struct(
        (i + 1).alias("ordinal"),
        F.trim(F.split_part(t, F.lit(":"), F.lit(1))).alias("start"),
        F.trim(F.substring_index(t, ":", -1)).alias("end")))


def ranges_frame(spark, spec: str | None = None) -> DataFrame:
    """T-22: the period dimension ``(ordinal, label, start, end)`` of an ``'a:b,c:d'`` parameter, by ``parse_ranges_column``;
    the default periods if it is empty. No valid range at all is an error when the result is computed."""
    raw = spec or ",".join(f"{a}:{b}" for a, b in DEFAULT_POLL_DATE_RANGES)
    parsed = parse_ranges_column(F.lit(raw))
    checked = F.when(F.size(parsed) > 0, parsed).otherwise(F.raise_error(F.lit("no valid date ranges")))
    rows = spark.range(1).select(F.explode(checked).alias("r"))
    return rows.select("r.ordinal", F.col("r.ordinal").cast("string").alias("label"), F.col("r.start").cast("date").alias("start"),
                       F.col("r.end").cast("date").alias("end"))


def poll_range_join(polls: DataFrame, ranges: DataFrame, date: str = "date") -> DataFrame:
    """J-7: every poll row in every inclusive range that holds it (overlapping
    ranges duplicate rows). The upper bound is *midnight* of the end day, so
    a timed row later that day falls out.

    An equi-join on the day: each range is unfolded to its days, a poll has one day, and the exact bounds are checked on what meets.
    Neither side has to be small."""
    d = F.col(date).cast("timestamp_ntz")
    days = ranges.where(F.col("start") <= F.col("end")).withColumn("_day", F.explode(F.sequence("start", "end")))
    return (polls.withColumn("_on", F.to_date(d)).join(days, F.col("_on") == F.col("_day"))
            .where((d >= F.col("start").cast("timestamp_ntz")) & (d <= F.col("end").cast("timestamp_ntz"))).drop("_on", "_day"))


def weighted_target(polls: DataFrame, ranges: DataFrame, candidates: Sequence[str],
                    weight: str = "weight", date: str = "date") -> DataFrame:
    """A-4: per range ``Σ(x·w)/Σw`` for each candidate column.

    Unparsable dates and non-numeric values are dropped first (PF-1, PF-3,
    PF-2); empty and zero-weight ranges are skipped; ``time_label`` is the
    range's 1-based ordinal. No surviving range is an error, raised when the
    result is computed."""
    cols = list(candidates) + [weight]
    p = polls.withColumn(date, F.col(date).cast("timestamp_ntz")).filter(F.col(date).isNotNull())
    p = require_values(coerce_numeric(p, cols), cols)
    j = poll_range_join(p, ranges, date)
    agg = j.groupBy("ordinal").agg(F.sum(weight).alias("_w"),
                                   *[F.sum(F.col(c) * F.col(weight)).alias(f"_s_{c}") for c in candidates])
    out = (agg.filter(F.col("_w") != 0)
           .select(*[(F.col(f"_s_{c}") / F.col("_w")).alias(c) for c in candidates],
                   F.col("ordinal").alias("time_label")))
    # one row if nothing is left: it raises. The ranges are few, so that row costs a look at the aggregated table
    none = out.agg(F.count("*").alias("_n")).where("_n = 0").select(
        *[F.raise_error(F.lit("no poll row with a weight in any date range")).cast("double").alias(c) for c in candidates],
        F.lit(None).cast("int").alias("time_label"))
    return out.unionByName(none)


def ensure_target(spark, target_path: str | None, polls: DataFrame | None, ranges: DataFrame,
                  candidates: Sequence[str]) -> DataFrame:
    """IO-16: the stored target table if it exists, else build it from polls (A-4) and store it, else error.

    Whether it exists is asked of the path's own file system. A table that exists but can't be read is an error: it is never
    overwritten."""
    from murmur.sources.files import expand
    if target_path and expand(spark, target_path):
        return spark.read.parquet(target_path)
    if polls is None:
        raise FileNotFoundError(f"no target table at {target_path} and no polls to build it from")
    t = weighted_target(polls, ranges, candidates)
    if target_path:
        t.write.mode("error").parquet(target_path)
        return spark.read.parquet(target_path)
    return t


# ---------------------------------------------------------------------------
# A-5 / F-1 .. F-6: entity features per period
# ---------------------------------------------------------------------------
def with_candidate(summary: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """PF-6 on the sentiment summary."""
    return summary.withColumn("candidate", T.candidate_of_cluster(F.col("final_cluster"), candidates))


def candidate_grid(periods: DataFrame, candidates: Sequence[str], period: str = "time_label") -> DataFrame:
    """J-8 dense grid: every period x every candidate (candidates generated
    per period row, so the grid is a generator, not a join)."""
    return periods.select(period).distinct().select(
        period, F.posexplode(F.array(*[F.lit(c) for c in candidates])).alias("cand_ord", "candidate"))


def entity_period(summary: DataFrame, candidates: Sequence[str], cluster_vectors: DataFrame | None = None,
                  dim: int | None = None, period: str = "time_label") -> DataFrame:
    """A-5 + F-2 (+ J-8, J-9): one row per (period, candidate).

    Unweighted means of positive / negative over the candidate's clusters,
    ``sentiment_score = avg_positive - avg_negative``, cluster count; periods
    where a candidate has no cluster get .5 / .5 / 0 / 0. With
    ``cluster_vectors(final_cluster, vector)``, ``embedding`` is the mean of
    the candidate's cluster vectors — clusters without a vector are left out
    of the mean, and no vector at all gives zeros of length ``dim``.
    """
    s = with_candidate(summary, candidates).filter(F.col("candidate").isin(list(candidates)))
    agg = s.groupBy(period, "candidate").agg(
        F.avg("positive").alias("avg_positive"), F.avg("negative").alias("avg_negative"),
        F.count("*").alias("cluster_count"))
    grid = candidate_grid(summary, candidates, period)
    out = (grid.join(agg, [period, "candidate"], "left")
           .select(period, "cand_ord", "candidate",
                   F.coalesce("avg_positive", F.lit(DEFAULT_POSITIVE)).alias("avg_positive"),
                   F.coalesce("avg_negative", F.lit(DEFAULT_NEGATIVE)).alias("avg_negative"),
                   F.coalesce("cluster_count", F.lit(0)).cast("long").alias("cluster_count")))
    out = out.withColumn("sentiment_score", F.col("avg_positive") - F.col("avg_negative"))
    if cluster_vectors is None:
        return out
    vec = (s.select(period, "candidate", "final_cluster")
           .join(cluster_vectors, "final_cluster")           # J-9: missing vectors drop out
           .select(period, "candidate", "vector"))
    mv = V.mean_vector(vec, [period, "candidate"], "vector", "embedding")
    zeros = F.array_repeat(F.lit(0.0), dim)
    return (out.join(mv, [period, "candidate"], "left")
            .withColumn("embedding", F.coalesce(F.col("embedding"), zeros)))


def cluster_vectors_from_members(clustered: DataFrame, member_vectors: DataFrame | None = None,
                                 key: str = "comment_id", vec: str = "embedding",
                                 dim: int | None = None) -> DataFrame:
    """Cluster vector = mean of its member comments' vectors (A-11),
    optionally truncated to the first ``dim`` dimensions. Without
    ``member_vectors`` the vectors are read from ``clustered`` itself (no join)."""
    if member_vectors is None:
        j = clustered.select("final_cluster", vec)
    else:
        j = clustered.select(key, "final_cluster").join(member_vectors.select(key, vec), key)
    out = V.mean_vector(j, ["final_cluster"], vec, "vector")
    if dim:
        out = out.withColumn("vector", F.slice("vector", 1, dim))
    return out


def pivot_features(ep: DataFrame, candidates: Sequence[str], dim: int, period: str = "time_label") -> DataFrame:
    """F-3: one wide row per period with ``{c}_positive``, ``{c}_negative``,
    ``{c}_sentiment``, ``{c}_cluster_count`` and ``{c}_embedding_{i}``. The
    pivot values are the explicit candidate list."""
    fields = [F.first("avg_positive").alias("positive"), F.first("avg_negative").alias("negative"),
              F.first("sentiment_score").alias("sentiment"), F.first("cluster_count").alias("cluster_count")]
    fields += [F.first(F.element_at("embedding", i + 1)).alias(f"embedding_{i}") for i in range(dim)]
    wide = ep.groupBy(period).pivot("candidate", list(candidates)).agg(*fields)
    return wide


def relative_sentiment(ep: DataFrame, n_candidates: int, period: str = "time_label") -> DataFrame:
    """F-4 / T-21: each candidate's share of the period's summed sentiment;
    ``1/n`` when the sum is exactly 0."""
    total = F.sum("sentiment_score").over(Window.partitionBy(period))
    return ep.withColumn("relative_sentiment", F.when(total != 0, F.col("sentiment_score") / total)
                         .otherwise(F.lit(1.0 / n_candidates)))


def pair_similarity(ep: DataFrame, period: str = "time_label") -> DataFrame:
    """F-5 / J-10: cosine of every unordered candidate pair i < j per period
    (self-join on period with an ordinal inequality)."""
    a = ep.select(period, F.col("cand_ord").alias("i"), F.col("candidate").alias("a"), F.col("embedding").alias("va"))
    b = ep.select(period, F.col("cand_ord").alias("j"), F.col("candidate").alias("b"), F.col("embedding").alias("vb"))
    return (a.join(b, period).filter(F.col("i") < F.col("j"))
            .select(period, "a", "b", V.cosine("va", "vb").alias("similarity")))


def embedding_strength(ep: DataFrame) -> DataFrame:
    """F-5 / T-17: L2 norm of each candidate's vector."""
    return ep.withColumn("embedding_strength", V.norm("embedding"))


def embedding_stats(ep: DataFrame, period: str = "time_label") -> DataFrame:
    """F-6 / A-14: mean, population std, max, min over all candidates' vector
    elements per period."""
    x = ep.select(period, F.explode("embedding").alias("_x"))
    return x.groupBy(period).agg(F.avg("_x").alias("embedding_mean"), F.stddev_pop("_x").alias("embedding_std"),
                                 F.max("_x").alias("embedding_max"), F.min("_x").alias("embedding_min"))


def features(ep: DataFrame, candidates: Sequence[str], dim: int, period: str = "time_label") -> DataFrame:
    """F-3 .. F-6 assembled: the wide feature row per period.
    3 candidates and 10 dimensions give 3*14 + 3 + 3 + 3 + 4 = 55 features.

    One shuffle: ``ep`` is grouped by period once, each period's candidate
    rows (one per candidate of the explicit, size-checked list) are gathered,
    and every feature is an array expression over them. Assembling the parts
    (pivot, shares, pairs, norms, stats) by joins would evaluate ``ep``'s whole
    upstream once per part."""
    c = list(candidates)
    if len(c) > V.MAX_INLINE_CANDIDATES:
        raise ValueError(f"{len(c)} candidates exceed {V.MAX_INLINE_CANDIDATES}")
    rows = ep.groupBy(period).agg(F.collect_list(F.struct(
        "candidate", "avg_positive", "avg_negative", "sentiment_score", "cluster_count", "embedding")).alias("_rows"))
    def row_of(name):   # a one-argument lambda: Spark reads a second one as the element index
        return F.try_element_at(F.filter("_rows", lambda r: r["candidate"] == F.lit(name)), F.lit(1))

    pick = [row_of(x).alias(f"_r{k}") for k, x in enumerate(c)]
    flat = F.filter(F.flatten(F.transform("_rows", lambda r: r["embedding"])), lambda x: x.isNotNull())
    total = F.aggregate("_rows", F.lit(0.0), lambda acc, r: acc + r["sentiment_score"])
    g = rows.select(period, *pick, total.alias("_total"), flat.alias("_flat")).filter(F.size("_flat") > 0)
    cols = []
    for k, x in enumerate(c):
        r = F.col(f"_r{k}")
        cols += [r["avg_positive"].alias(f"{x}_positive"), r["avg_negative"].alias(f"{x}_negative"),
                 r["sentiment_score"].alias(f"{x}_sentiment"), r["cluster_count"].alias(f"{x}_cluster_count")]
        cols += [F.element_at(r["embedding"], i + 1).alias(f"{x}_embedding_{i}") for i in range(dim)]
    cols += [F.when(F.col("_total") != 0, F.col(f"_r{k}")["sentiment_score"] / F.col("_total"))
             .otherwise(F.lit(1.0 / len(c))).alias(f"{x}_relative_sentiment") for k, x in enumerate(c)]
    cols += [V.cosine(F.col(f"_r{i}")["embedding"], F.col(f"_r{j}")["embedding"]).alias(f"similarity_{c[i]}_{c[j]}")
             for i in range(len(c)) for j in range(i + 1, len(c))]
    cols += [V.norm(F.col(f"_r{k}")["embedding"]).alias(f"{x}_embedding_strength") for k, x in enumerate(c)]
    n = F.size("_flat")
    mean = F.aggregate("_flat", F.lit(0.0), lambda acc, v: acc + v) / n
    g = g.withColumn("_mean", mean)
    sq = F.aggregate("_flat", F.lit(0.0), lambda acc, v: acc + (v - F.col("_mean")) * (v - F.col("_mean")))
    cols += [F.col("_mean").alias("embedding_mean"), F.sqrt(sq / n).alias("embedding_std"),
             F.array_max("_flat").alias("embedding_max"), F.array_min("_flat").alias("embedding_min")]
    return g.select(period, *cols)


# ---------------------------------------------------------------------------
# PF-11 / S-3 / J-1: label split and training table
# ---------------------------------------------------------------------------
def period_ordinals(periods: DataFrame, period: str = "time_label") -> DataFrame:
    """The period dimension for labels: ``ordinal`` = rank of the label among
    the distinct labels (a window over the small distinct-period table)."""
    d = periods.select(period).distinct()
    return d.withColumn("ordinal", F.row_number().over(Window.orderBy(period)).cast("int"))


def pick_label_split(input_labels: DataFrame, target_labels: DataFrame, label: str = "time_label") -> DataFrame:
    """PF-11 / S-3: ``role`` = train for labels present in the target, predict
    for input labels absent from it (left anti join)."""
    i = input_labels.select(label).distinct()
    t = target_labels.select(label).distinct()
    train = t.select(label, F.lit("train").alias("role"))
    pred = i.join(t, label, "left_anti").select(label, F.lit("predict").alias("role"))
    return train.unionByName(pred)


def features_x_target(feats: DataFrame, targets: DataFrame, key: str = "time_label") -> DataFrame:
    """J-1: inner equi-join on the period key."""
    return feats.join(targets, key, "inner")


def row_percent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T-20: divide each value by the row sum, x100 (null when the sum is 0)."""
    total = sum((F.col(c) for c in cols), F.lit(0.0))
    df = df.withColumn("_rowsum", total)
    for c in cols:
        df = df.withColumn(c, F.try_divide(F.col(c), F.col("_rowsum")) * 100)
    return df.drop("_rowsum")


# ---------------------------------------------------------------------------
# M-9 .. M-11: boosted trees, fitted period by period
# ---------------------------------------------------------------------------
def _gbt(label: str, features_col: str = "features", seed: int = 42, **kw):
    from pyspark.ml.regression import GBTRegressor
    p = {**BOOSTER, **kw}
    return GBTRegressor(featuresCol=features_col, labelCol=label, maxIter=int(p["n_estimators"]),
                        stepSize=float(p["learning_rate"]), maxDepth=int(p["max_depth"]),
                        subsamplingRate=float(p["subsample"]), featureSubsetStrategy=str(p["colsample"]),
                        seed=seed)


class SequentialForecaster:
    """M-9 .. M-11: one boosted-tree regressor per target column, trained
    period after period.

    Spark's GBT has no warm start, so continuing a model is residual stacking
    (squared loss): the next period's booster fits ``y - f(x)`` of the current
    ensemble, and the prediction is the sum. Targets never fitted predict the
    uniform ``1/n``. Feature vectors are assembled with ``VectorAssembler``.
    """

    def __init__(self, targets: Sequence[str], feature_cols: Sequence[str], **params):
        self.targets = list(targets)
        self.feature_cols = list(feature_cols)
        self.params = params
        self.models: dict[str, list] = {}

    def _assemble(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        cols = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in self.feature_cols]
        keep = [F.col(f"`{c}`") for c in df.columns if c not in self.feature_cols]
        df = df.select(*keep, *cols)
        return VectorAssembler(inputCols=self.feature_cols, outputCol="features",
                               handleInvalid="keep").transform(df)

    def _predict_one(self, df: DataFrame, target: str, stages: int | None = None, out: str | None = None) -> DataFrame:
        """The sum of the target's first ``stages`` boosters (all by default)."""
        name = out or f"_pred_{target}"
        total, parts = F.lit(0.0), []
        for i, m in enumerate(self.models.get(target, [])[:stages]):
            parts.append(f"_p{i}")
            df = m.copy({m.predictionCol: f"_p{i}"}).transform(df)
            total = total + F.col(f"_p{i}")
        return df.withColumn(name, total).drop(*parts)

    def fit_period(self, train: DataFrame) -> "SequentialForecaster":
        """M-9 on the first call, M-10 (residual continuation) afterwards.

        The assembled period table is checkpointed (reliable storage) so each
        booster's many passes do not recompute the feature lineage; the
        per-target boosters are independent and are submitted concurrently.
        """
        from concurrent.futures import ThreadPoolExecutor

        ensure_checkpoint_dir(train.sparkSession)
        data = self._assemble(train).checkpoint(eager=True)

        def fit_one(t):
            cur = self._predict_one(data, t)
            resid = cur.withColumn("_resid", F.col(t).cast("double") - F.col(f"_pred_{t}"))
            return t, _gbt("_resid", **self.params).fit(resid)

        todo = [t for t in self.targets if t in train.columns]
        with ThreadPoolExecutor(max_workers=max(1, len(todo))) as pool:
            for t, m in pool.map(fit_one, todo):
                self.models.setdefault(t, []).append(m)
        return self

    def predict(self, df: DataFrame, stages: int | None = None) -> DataFrame:
        """M-11: one prediction column per target (uniform 1/n if unfitted); with ``stages``, by the first boosters only."""
        data = self._assemble(df)
        n = len(self.targets)
        for t in self.targets:
            if self.models.get(t) and stages != 0:
                data = self._predict_one(data, t, stages, f"pred_{t}")
            else:
                data = data.withColumn(f"pred_{t}", F.lit(1.0 / n))
        return data.drop("features")

    def stage_errors(self, train: DataFrame, period: str, periods: Sequence, keys: Sequence[str]) -> DataFrame:
        """M-10: for each period's rows and target, the value and the predictions before and after that period's booster."""
        out = None
        for k, p in enumerate(periods):
            part = self._assemble(train.filter(F.col(period) == p))
            for t in self.targets:
                both = self._predict_one(self._predict_one(part, t, k, "pred_before"), t, k + 1, "pred_after")
                rows = both.select(*keys, F.lit(k + 1).alias("stage"), F.lit(t).alias("target"), F.col(t).cast("double").alias("actual"),
                                   "pred_before", "pred_after")
                out = rows if out is None else out.unionByName(rows)
        return out
