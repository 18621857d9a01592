"""Model explanation as Spark jobs.

Both methods are "score many perturbed copies of a few rows": the copies
are generated with array expressions and ``explode`` in executors, scored
by the (Spark) model in one ``transform``, and reduced with windows /
grouped aggregates.  The blow-up is rows x permutations x features (P1) or
rows x samples (P2), all bounded by parameters.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _h(*cols) -> F.Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in cols])), 1, 8), 16, 10).cast(
        "bigint")


def shapley_values(predict, rows: DataFrame, background: DataFrame, feature_names: list[str],
                   n_perm: int = 10, key: str = "row_id", features: str = "features",
                   seed: int = 42) -> DataFrame:
    """Permutation Shapley values per (row, feature, class).

    For each explained row and permutation a background row is chosen by
    hash; coalition j takes the first j features of the permutation from the
    row and the rest from the background.  Adjacent coalitions differ in one
    feature; their score difference is that feature's contribution.
    ``predict(df)`` must return the input columns plus ``probs``.
    """
    p = len(feature_names)
    bg = background.select(F.col(features).cast("array<double>").alias("_b"))
    bg = bg.withColumn("_bi", F.row_number().over(Window.orderBy(_h(F.col("_b")))) - 1)  # bounded background
    n_bg = bg.count()
    r = rows.select(F.col(key).alias("_rid"), F.col(features).cast("array<double>").alias("_x"))
    r = r.withColumn("_perm", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))))
    r = r.withColumn("_bi", F.pmod(_h(F.col("_rid"), F.col("_perm"), F.lit(seed)), F.lit(n_bg)))
    r = r.join(F.broadcast(bg), "_bi")  # background: a bounded sample
    idx = F.sequence(F.lit(0), F.lit(p - 1))
    order = F.array_sort(F.transform(idx, lambda i: F.struct(
        _h(F.col("_rid"), F.col("_perm"), i, F.lit(seed)).alias("k"), i.alias("i"))))
    r = r.withColumn("_pi", F.transform(order, lambda s: s["i"]))
    r = r.withColumn("_pos", F.transform(idx, lambda i: F.array_position("_pi", i) - 1))
    steps = r.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(p))))
    xj = F.transform(idx, lambda i: F.when(F.col("_pos")[i] < F.col("_j"), F.col("_x")[i]).otherwise(F.col("_b")[i]))
    coal = steps.select("_rid", "_perm", "_j", "_pi", xj.alias(features))
    scored = predict(coal)
    w = Window.partitionBy("_rid", "_perm").orderBy("_j")
    d = scored.select("_rid", "_perm", "_j", "_pi", "probs",
                      F.lag("probs").over(w).alias("_prev")).where(F.col("_j") > 0)
    contrib = d.select("_rid", F.col("_pi")[F.col("_j") - 1].alias("_f"),
                       F.posexplode(F.zip_with("probs", "_prev", lambda a, b: a - b)).alias("cls", "phi"))
    names = F.array(*[F.lit(n) for n in feature_names])
    out = contrib.groupBy("_rid", "_f", "cls").agg(F.avg("phi").alias("phi"))
    return out.select(F.col("_rid").alias(key), names[F.col("_f")].alias("feature"), F.col("cls").cast("int"),
                      F.round("phi", 6).alias("phi"))


def shapley_ranking(phi: DataFrame) -> DataFrame:
    """P1 summary: mean |phi| per (class, feature), ranked within class."""
    agg = phi.groupBy("cls", "feature").agg(F.round(F.avg(F.abs("phi")), 6).alias("mean_abs_phi"))
    w = Window.partitionBy("cls").orderBy(F.desc("mean_abs_phi"), "feature")
    return agg.withColumn("rank", F.row_number().over(w))


def local_surrogates(predict, rows: DataFrame, feature_names: list[str], n_samples: int = 200,
                     key: str = "row_id", features: str = "features", scale: DataFrame | None = None,
                     kernel_width: float | None = None, seed: int = 42, top_k: int = 5) -> DataFrame:
    """Perturb each row, weight samples by proximity, fit a weighted
    linear model per (row, class), keep the top-k coefficients.

    Perturbations are ``x + sigma * N(0,1)`` with per-feature sigma (default
    1); the per-group weighted least squares runs in ``applyInPandas`` on
    ``n_samples`` rows per group.
    """
    p = len(feature_names)
    width = kernel_width or 0.75 * np.sqrt(p)
    sig = [1.0] * p
    if scale is not None:
        sig = [float(v) for v in scale.collect()[0]]
    r = rows.select(F.col(key).alias("_rid"), F.col(features).cast("array<double>").alias("_x"))
    r = r.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    # Box-Muller on two hashes of (row, sample, dimension): the same however rows are dealt to tasks
    def uniform(i, stream):
        return (_h(F.col("_rid"), F.col("_s"), F.lit(i), F.lit(seed), F.lit(stream)) + F.lit(0.5)) / F.lit(float(16 ** 8))

    noise = F.array(*[F.sqrt(-2.0 * F.log(uniform(i, 0))) * F.cos(F.lit(2.0 * np.pi) * uniform(i, 1)) * F.lit(sig[i])
                      for i in range(p)])
    r = r.withColumn("_n", F.when(F.col("_s") == 0, F.array_repeat(F.lit(0.0), p)).otherwise(noise))
    r = r.withColumn(features, F.zip_with("_x", "_n", lambda a, b: a + b))
    d2 = F.aggregate(F.transform("_n", lambda v: v * v), F.lit(0.0), lambda a, v: a + v)
    r = r.withColumn("_w", F.exp(-d2 / F.lit(width * width)))
    scored = predict(r.select("_rid", "_s", "_n", "_w", features))
    ex = scored.select("_rid", "_n", "_w", F.posexplode("probs").alias("cls", "y"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        X = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["_n"].values])
        X = np.hstack([np.ones((len(X), 1)), X])
        w = np.sqrt(pdf["_w"].to_numpy())
        coef, *_ = np.linalg.lstsq(X * w[:, None], pdf["y"].to_numpy() * w, rcond=None)
        order = np.argsort(-np.abs(coef[1:]))[:top_k]
        return pd.DataFrame({"_rid": pdf["_rid"].iloc[0], "cls": int(pdf["cls"].iloc[0]),
                             "feature": [feature_names[i] for i in order],
                             "weight": [float(round(coef[1 + i], 6)) for i in order],
                             "rank": np.arange(1, len(order) + 1, dtype=np.int64)})

    schema = f"_rid {rows.schema[key].dataType.simpleString()}, cls int, feature string, weight double, rank long"
    return ex.groupBy("_rid", "cls").applyInPandas(fit, schema).withColumnRenamed("_rid", key)
