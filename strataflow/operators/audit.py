"""Latent-space and reconstruction audits.

Array columns are handled with ``posexplode`` into tall (row, dim, value)
data and grouped by (class, dim) or dim, so work spreads over dimensions;
per-row terms use higher-order array functions (``zip_with``, ``aggregate``).
Only dimension-sized results (means, bounds) go to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.ranking import exact_quantiles
from strataflow.operators.profile import pairwise_correlation


def _r(x, nd=6):
    return F.round(x, nd)


def asum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, v: a + v)


def kl_terms(mu: Column, log_var: Column) -> Column:
    """Per-dimension KL of N(mu, exp(lv)) from N(0, 1)."""
    return F.zip_with(mu, log_var, lambda m, lv: -0.5 * (1 + lv - m * m - F.exp(lv)))


def tall2(df: DataFrame, a: str, b: str, keep: list[str] = ()) -> DataFrame:
    """Two aligned arrays -> tall (keep..., dim, a, b)."""
    z = F.arrays_zip(F.col(a).cast("array<double>").alias("a"), F.col(b).cast("array<double>").alias("b"))
    return df.select(*keep, F.posexplode(z).alias("dim", "s")).select(*keep, "dim", F.col("s.a").alias(a),
                                                                       F.col("s.b").alias(b))


def tall1(df: DataFrame, a: str, keep: list[str] = ()) -> DataFrame:
    return df.select(*keep, F.posexplode(F.col(a).cast("array<double>")).alias("dim", a))


# ------------------------------------------------------------------ posterior

def posterior_variance(post: DataFrame, label: str = "label", log_var: str = "log_var",
                       active: float = 0.5, collapsed: float = 0.9) -> DataFrame:
    """Mean posterior variance per class and dim -> per class: mean,
    active (< 0.5) and collapsed (> 0.9) dimension counts."""
    t = tall1(post, log_var, [label])
    per = t.groupBy(label, "dim").agg(F.avg(F.exp(log_var)).alias("var"))
    return per.groupBy(label).agg(
        F.count(F.lit(1)).alias("n_dims"), _r(F.avg("var")).alias("mean_var"),
        F.count(F.when(F.col("var") < active, 1)).alias("n_active"),
        F.count(F.when(F.col("var") > collapsed, 1)).alias("n_collapsed"))


def kl_by_class(post: DataFrame, label: str = "label", mu: str = "mu", log_var: str = "log_var") -> DataFrame:
    """Mean per-sample KL (sum over dims) per class."""
    kl = asum(kl_terms(F.col(mu).cast("array<double>"), F.col(log_var).cast("array<double>")))
    return post.groupBy(label).agg(F.count(F.lit(1)).alias("n"), _r(F.avg(kl)).alias("mean_kl"))


def kl_by_dim(post: DataFrame, mu: str = "mu", log_var: str = "log_var", inactive: float = 0.01) -> DataFrame:
    """Mean KL per dimension; dims below ``inactive`` are flagged."""
    t = tall2(post, mu, log_var)
    kl = -0.5 * (1 + F.col(log_var) - F.col(mu) * F.col(mu) - F.exp(log_var))
    per = t.groupBy("dim").agg(F.avg(kl).alias("_kl"))
    return per.select(F.col("dim").cast("int").alias("dim"), _r(F.col("_kl")).alias("mean_kl"),
                      (F.col("_kl") < inactive).alias("inactive"))


def elbo_terms(df: DataFrame, x: str, x_hat: str, mu: str, log_var: str, beta: float = 1.0, by=()) -> DataFrame:
    """I4: mean reconstruction MSE, mean KL and ``mse + beta * kl``."""
    by = [by] if isinstance(by, str) else list(by)
    se = F.zip_with(F.col(x).cast("array<double>"), F.col(x_hat).cast("array<double>"), lambda a, b: (a - b) * (a - b))
    mse = asum(se) / F.size(x)
    kl = asum(kl_terms(F.col(mu).cast("array<double>"), F.col(log_var).cast("array<double>")))
    agg = df.groupBy(*by).agg(F.avg(mse).alias("_mse"), F.avg(kl).alias("_kl"), F.count(F.lit(1)).alias("n"))
    return agg.select(*by, "n", _r(F.col("_mse")).alias("recon_mse"), _r(F.col("_kl")).alias("kl"),
                      _r(F.col("_mse") + F.lit(beta) * F.col("_kl")).alias("loss"))


# ------------------------------------------------------------------ geometry

def centroids(df: DataFrame, vec: str, group: str) -> DataFrame:
    """Mean vector per group: (group, dim, mean)."""
    return tall1(df, vec, [group]).groupBy(group, "dim").agg(F.avg(vec).alias("mean"))


def centroid_distance(df: DataFrame, vec: str, group: Column, ref: str, a: str, b: str) -> DataFrame:
    """Distances between the ``ref`` centroid and those of ``a`` and
    ``b`` (e.g. real minority vs synthetic and vs majority) and their ratio."""
    c = centroids(df.withColumn("_g", group), vec, "_g")
    w = c.groupBy("dim").agg(*[F.max(F.when(F.col("_g") == g, F.col("mean"))).alias(f"_{i}")
                               for i, g in enumerate((ref, a, b))])
    agg = w.agg(F.sqrt(F.sum(F.pow(F.col("_0") - F.col("_1"), 2))).alias("d_a"),
                F.sqrt(F.sum(F.pow(F.col("_0") - F.col("_2"), 2))).alias("d_b"))
    return agg.select(_r(F.col("d_a")).alias("dist_ref_a"), _r(F.col("d_b")).alias("dist_ref_b"),
                      _r(F.col("d_a") / F.col("d_b")).alias("ratio"))


def class_separation(df: DataFrame, vec: str, group: Column, pos: str, neg: str, k: int | None = None) -> DataFrame:
    """Per dim ``|mean_pos - mean_neg| / max(std_pos, 1e-6)`` (sample
    std), ranked; optional top-k."""
    t = tall1(df.withColumn("_g", group), vec, ["_g"])
    s = t.groupBy("dim").agg(F.avg(F.when(F.col("_g") == pos, F.col(vec))).alias("mp"),
                             F.stddev_samp(F.when(F.col("_g") == pos, F.col(vec))).alias("sp"),
                             F.avg(F.when(F.col("_g") == neg, F.col(vec))).alias("mn"))
    sep = F.abs(F.col("mp") - F.col("mn")) / F.greatest(F.coalesce("sp", F.lit(0.0)), F.lit(1e-6))
    out = s.select(F.col("dim").cast("int").alias("dim"), _r(F.col("mp") - F.col("mn")).alias("mean_diff"),
                   _r(sep).alias("separation"))
    out = out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("separation"), "dim")).cast("bigint"))
    return out.where(F.col("rank") <= k) if k else out


def box_overlap(df: DataFrame, vec: str, group: Column, pos: str, neg: str, width: float = 2.0) -> DataFrame:
    """Share of ``neg`` rows inside the ``pos`` mean +/- width*std box
    on ALL dims.  The bounds (two p-length arrays) are broadcast as a one-row
    table; the test is ``forall`` over ``zip_with``."""
    g = df.withColumn("_g", group)
    t = tall1(g.where(F.col("_g") == pos), vec)
    st = t.groupBy("dim").agg(F.avg(vec).alias("m"), F.stddev_samp(vec).alias("s")).orderBy("dim").collect()
    # one (lo, hi) per dimension -> two p-length literal arrays
    lo = F.array(*[F.lit(None if r["s"] is None else float(r["m"] - width * r["s"])).cast("double") for r in st])
    hi = F.array(*[F.lit(None if r["s"] is None else float(r["m"] + width * r["s"])).cast("double") for r in st])
    neg_rows = g.where(F.col("_g") == neg).select(F.col(vec).cast("array<double>").alias("_v"))
    j = neg_rows.select("_v", F.arrays_zip(lo.alias("lo"), hi.alias("hi")).alias("b"))
    inside = F.forall(F.zip_with("_v", "b", lambda v, bd: (v >= bd["lo"]) & (v <= bd["hi"])), lambda x: x)
    return j.agg(F.count(F.lit(1)).alias("n_neg"), _r(F.avg(inside.cast("double"))).alias("overlap"))


def grade(value: Column, good: Column, ok: Column, higher_is_better: Column) -> Column:
    """Healthy / borderline / problem for one metric row."""
    g = F.when(higher_is_better, value >= good).otherwise(value <= good)
    o = F.when(higher_is_better, value >= ok).otherwise(value <= ok)
    return F.when(g, F.lit("healthy")).when(o, F.lit("borderline")).otherwise(F.lit("problem"))


def grade_audit(metrics: DataFrame) -> DataFrame:
    """Grade each (metric, value, good, ok, higher_is_better) row and
    add the overall verdict (the worst grade)."""
    graded = metrics.withColumn("grade", grade(F.col("value"), F.col("good"), F.col("ok"), F.col("higher_is_better")))
    sev = F.when(F.col("grade") == "problem", 2).when(F.col("grade") == "borderline", 1).otherwise(0)
    worst = F.max(sev).over(Window.partitionBy(F.lit(1)))  # over the handful of metric rows
    return graded.withColumn("verdict", F.when(worst == 2, "problem").when(worst == 1, "borderline")
                             .otherwise("healthy"))


# ------------------------------------------------------------------ reconstruction

def reconstruction_error(df: DataFrame, x: str, x_hat: str, label: str = "label") -> DataFrame:
    """Per class: mean, exact median and p95 of the per-row MSE, RMSE."""
    se = F.zip_with(F.col(x).cast("array<double>"), F.col(x_hat).cast("array<double>"), lambda a, b: (a - b) * (a - b))
    rows = df.select(label, (asum(se) / F.size(x)).alias("mse"))
    basic = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg("mse").alias("_m"))
    q = exact_quantiles(rows, "mse", [0.5, 0.95], by=label)
    qw = q.groupBy(label).agg(F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("_med"),
                              F.max(F.when(F.col("q") == 0.95, F.col("value"))).alias("_p95"))
    return basic.join(qw, label).select(label, "n", _r(F.col("_m")).alias("mean_mse"),
                                        _r(F.col("_med")).alias("median_mse"), _r(F.col("_p95")).alias("p95_mse"),
                                        _r(F.sqrt("_m")).alias("rmse"))


def feature_error(df: DataFrame, x: str, x_hat: str) -> DataFrame:
    """M18 per feature: MSE per input dimension, ranked worst first."""
    t = tall2(df, x, x_hat)
    per = t.groupBy("dim").agg(F.avg(F.pow(F.col(x) - F.col(x_hat), 2)).alias("_m"))
    return per.select(F.col("dim").cast("int").alias("dim"), _r(F.col("_m")).alias("mse")).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc("mse"), "dim")).cast("bigint"))


def recon_moments(df: DataFrame, x: str, x_hat: str) -> DataFrame:
    """Real vs reconstructed mean / std (sample) per feature and deltas."""
    t = tall2(df, x, x_hat)
    a = t.groupBy("dim").agg(F.avg(x).alias("mr"), F.stddev_samp(x).alias("sr"), F.avg(x_hat).alias("mh"),
                             F.stddev_samp(x_hat).alias("sh"))
    return a.select(F.col("dim").cast("int").alias("dim"), _r(F.col("mr")).alias("mean_real"),
                    _r(F.col("mh")).alias("mean_recon"), _r(F.col("sr")).alias("std_real"),
                    _r(F.col("sh")).alias("std_recon"), _r(F.col("mh") - F.col("mr")).alias("delta_mean"),
                    _r(F.col("sh") - F.col("sr")).alias("delta_std"))


def mape_report(df: DataFrame, x: str, x_hat: str, floor: float = 0.01, reliable_share: float = 0.10) -> DataFrame:
    """MAPE per feature on rows with |real| > floor; share used and a
    reliability flag (share >= 10 %)."""
    t = tall2(df, x, x_hat)
    used = F.abs(F.col(x)) > floor
    a = t.groupBy("dim").agg(
        F.avg(F.when(used, F.abs(F.col(x) - F.col(x_hat)) / F.abs(F.col(x)))).alias("_mape"),
        F.avg(used.cast("double")).alias("_share"))
    return a.select(F.col("dim").cast("int").alias("dim"), _r(F.col("_mape") * 100, 4).alias("mape_pct"),
                    _r(F.col("_share")).alias("share_used"), (F.col("_share") >= reliable_share).alias("reliable"))


def latent_feature_corr(df: DataFrame, latent: list[Column | str], inputs: list[str], min_abs: float = 0.2,
                        latent_names: list[str] | None = None) -> DataFrame:
    """Correlation of every latent dim with every input feature in ONE
    pass (masked X'X); constant columns give 0; inputs ranked per latent dim;
    only |r| > min_abs are kept."""
    names = latent_names or [f"z{i}" for i in range(len(latent))]
    lat = [F.col(x) if isinstance(x, str) else x for x in latent]
    cols = [f"_l{i}" for i in range(len(lat))] + [f"_f{i}" for i in range(len(inputs))]
    data = df.select(*[x.alias(a) for x, a in zip([*lat, *[F.col(f) for f in inputs]], cols)])
    r = pairwise_correlation(data, cols)
    rows = [(n, f, 0.0 if np.isnan(v := r[i, len(lat) + j]) else float(v))
            for i, n in enumerate(names) for j, f in enumerate(inputs)]
    t = df.sparkSession.createDataFrame(rows, "latent string, feature string, corr double")
    w = Window.partitionBy("latent").orderBy(F.desc(F.abs("corr")), "feature")  # per latent dim: p inputs
    t = t.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return t.where(F.abs("corr") > min_abs).select("latent", "feature", _r(F.col("corr")).alias("corr"), "rank")
