"""Class imbalance and augmentation (H1-H6).

Synthetic rows are generated in executors from ``spark.range(n)``: the only
thing that goes through the driver is the fitted distribution (a mean vector
and a p x p covariance), never data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.arrow import lists, matrix
from strataflow.functions.columns import c


def _label_grid(spark: SparkSession, n_classes: int, label: str) -> DataFrame:
    return spark.range(n_classes).select(F.col("id").cast("int").alias(label))


def class_weights(df: DataFrame, label: str = "label", n_classes: int = 3) -> DataFrame:
    """H1: ``N / (k * n_c)`` per class, 0 for a class with no rows."""
    counts = df.groupBy(c(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    grid = _label_grid(df.sparkSession, n_classes, label)
    j = grid.join(counts, label, "left").select(label, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    tot = F.sum("n").over(_all())
    return j.select(label, "n", F.when(F.col("n") > 0, tot / (F.lit(n_classes) * F.col("n")))
                    .otherwise(F.lit(0.0)).alias("weight"))


def _all():
    from pyspark.sql import Window
    # windows over per-class tables (k rows) only
    return Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def with_row_weights(df: DataFrame, weights: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """H1 per-row: broadcast the k-row weight table onto the rows."""
    return df.join(F.broadcast(weights.select(label, F.col("weight").alias(out))), label, "left")


def class_priors(df: DataFrame, label: str = "label", n_classes: int = 3, clip: float = 1e-9) -> DataFrame:
    """H2: prior and log prior (clipped at ``clip``; an empty class gets log(clip))."""
    counts = df.groupBy(c(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    grid = _label_grid(df.sparkSession, n_classes, label)
    j = grid.join(counts, label, "left").select(label, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    prior = F.col("n") / F.sum("n").over(_all())
    return j.select(label, "n", F.round(prior, 9).alias("prior"),
                    F.round(F.log(F.greatest(prior, F.lit(clip))), 9).alias("log_prior"))


def synthetic_count(df: DataFrame, label: str, minority, target_ratio: float, min_rows: int = 10) -> DataFrame:
    """H3: rows to add, ``max(0, ceil((t*N - n_min) / (1 - t)))``.

    Raises (at execution) when the minority has fewer than ``min_rows``.
    """
    agg = df.agg(F.count(F.lit(1)).alias("n_total"),
                 F.count(F.when(c(label) == F.lit(minority), 1)).alias("n_minority"))
    need = F.ceil((F.lit(target_ratio) * F.col("n_total") - F.col("n_minority")) / F.lit(1.0 - target_ratio))
    n_syn = F.greatest(F.lit(0), need).cast("bigint")
    guard = F.when(F.col("n_minority") < min_rows,
                   F.raise_error(F.lit(f"fewer than {min_rows} minority rows for augmentation"))
                   ).otherwise(n_syn)
    return agg.select("n_total", "n_minority", guard.cast("bigint").alias("n_synthetic"))


def fit_gaussian(df: DataFrame, features: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean and covariance (sample) of an array column, in one distributed pass.

    Each partition reduces its rows to (n, sum x, X^T X) with numpy (a BLAS
    product per Arrow batch); the per-partition partials are summed in Spark
    as (index, value) rows, so only p + p^2 numbers reach the driver.
    """
    head = df.select(features).first()
    shift = np.asarray(head[0], dtype=np.float64) if head else 0.0  # raw sums of large values would cancel

    def part(batches):
        n, s, ss = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0)) - shift
            n += len(x)
            s = x.sum(0) if s is None else s + x.sum(0)
            ss = x.T @ x if ss is None else ss + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), lists(s[None]), lists(ss.reshape(1, -1))], ["n", "s", "ss"])

    parts = df.select(features).mapInArrow(part, "n long, s array<double>, ss array<double>")
    flat = parts.select(F.col("n"), F.posexplode(F.concat("s", "ss")).alias("i", "v"))
    tot = flat.groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect()  # p + p^2 rows
    if not tot:
        raise ValueError("no rows to fit")
    m = len(tot)
    p = int((-1 + math.isqrt(1 + 4 * m)) // 2)  # m = p + p^2
    vals = np.zeros(m)
    for r in tot:
        vals[r["i"]] = r["v"]
    n = int(tot[0]["n"])
    mean = vals[:p] / n
    sxy = vals[p:].reshape(p, p)
    cov = (sxy - n * np.outer(mean, mean)) / max(n - 1, 1)
    return mean + shift, cov, n


ROWS_PER_TASK = 50_000


def keyed_normals(ids: np.ndarray, p: int, seed: int) -> np.ndarray:
    """Standard normals by row and dimension: Box-Muller on two hashed counters each."""
    def uniform(stream: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (ids.astype(np.uint64)[:, None] * np.uint64(2 * p) + np.arange(p, dtype=np.uint64) * np.uint64(2)
                 + np.uint64(stream))
            x = (x ^ np.uint64(seed % 2 ** 32) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(0x9E3779B97F4A7C15)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            x ^= x >> np.uint64(31)
        return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53

    return np.sqrt(-2.0 * np.log(uniform(0))) * np.cos(2.0 * np.pi * uniform(1))


def sample_gaussian(spark: SparkSession, n: int, mean: np.ndarray, cov: np.ndarray, seed: int,
                    out: str = "features", ridge: float = 1e-6, num_partitions: int | None = None) -> DataFrame:
    """Draw ``n`` rows of N(mean, cov) in executors: ``mean + L @ randn``.

    ``L`` (Cholesky of ``cov + ridge*I``) is a p x p literal; a row's normals
    follow from the seed and its id, however rows are dealt to tasks.
    """
    p = len(mean)
    chol = np.linalg.cholesky(cov + ridge * np.eye(p))
    mu = np.asarray(mean, dtype=np.float64)
    base = spark.range(0, n, 1, num_partitions or n // ROWS_PER_TASK + 1)

    def gen(batches):
        for pdf in batches:
            if len(pdf):
                ids = pdf["id"].to_numpy()
                yield pd.DataFrame({"id": ids, out: list(mu + keyed_normals(ids, p, seed) @ chol.T)})

    return base.mapInPandas(gen, f"id long, `{out}` array<double>")


def _synthetic_key(df: DataFrame, key: str) -> Column:
    """Keys for generated rows (from ``spark.range`` id) of the key's type:
    negative numbers for numeric keys, ``syn-<id>`` for strings."""
    from pyspark.sql import types as T
    kt = df.schema[key].dataType
    if isinstance(kt, T.StringType):
        return F.concat(F.lit("syn-"), F.col("id").cast("string")).alias(key)
    return (-(F.col("id") + 1)).cast(kt).alias(key)


def augment_minority(df: DataFrame, label: str, features: str, minority: int, target_ratio: float,
                     seed: int = 42, key: str = "row_id", min_rows: int = 10) -> DataFrame:
    """H4: append Gaussian synthetic minority rows until the minority share
    reaches ``target_ratio``; original rows are untouched and flagged
    ``is_synthetic = false``."""
    counts = synthetic_count(df, label, minority, target_ratio, min_rows).first()
    n_syn = int(counts["n_synthetic"])
    base = df.withColumn("is_synthetic", F.lit(False))
    if n_syn == 0:
        return base
    mean, cov, _ = fit_gaussian(df.where(c(label) == minority), features)
    syn = sample_gaussian(df.sparkSession, n_syn, mean, cov, seed, out=features)
    syn = syn.select(_synthetic_key(df, key), F.col(features).cast(df.schema[features].dataType).alias(features),
                     F.lit(minority).cast(df.schema[label].dataType).alias(label),
                     F.lit(True).alias("is_synthetic"))
    return base.unionByName(syn, allowMissingColumns=True)


def augment_latent(df: DataFrame, label: str, z: str, minority: int, target_ratio: float, seed: int = 42,
                   key: str = "row_id") -> DataFrame:
    """H5: per-dimension N(centroid, std) draws for the minority class until
    the target ratio; independent dimensions (no covariance)."""
    counts = synthetic_count(df, label, minority, target_ratio).first()
    n_syn = int(counts["n_synthetic"])
    base = df.withColumn("is_synthetic", F.lit(False))
    if n_syn == 0:
        return base
    stats = (df.where(c(label) == minority).select(F.posexplode(z).alias("i", "v"))
               .groupBy("i").agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"))
               .orderBy("i").collect())  # one row per dimension
    centre = np.array([float(r["m"]) for r in stats])
    syn = sample_gaussian(df.sparkSession, n_syn, centre, np.diag([float(r["s"] or 0.0) ** 2 for r in stats]), seed,
                          out=z, ridge=1e-12)
    syn = syn.select(_synthetic_key(df, key), z,
                     F.lit(minority).cast(df.schema[label].dataType).alias(label), F.lit(True).alias("is_synthetic"))
    return base.unionByName(syn.withColumn(z, F.col(z).cast(df.schema[z].dataType)), allowMissingColumns=True)


def augment_report(df: DataFrame, label: str, minority, flag: str = "is_synthetic") -> DataFrame:
    """H6: minority share before (real rows) and after (all rows)."""
    is_min = (c(label) == F.lit(minority)).cast("int")
    agg = df.agg(F.count(F.when(~c(flag), 1)).alias("n_real"),
                 F.count(F.when(c(flag), 1)).alias("n_synthetic"),
                 F.sum(F.when(~c(flag), is_min)).alias("_mr"), F.sum(is_min).alias("_ma"),
                 F.count(F.lit(1)).alias("n_after"))
    return agg.select("n_real", "n_synthetic", "n_after",
                      F.round(F.col("_mr") / F.col("n_real"), 6).alias("ratio_before"),
                      F.round(F.col("_ma") / F.col("n_after"), 6).alias("ratio_after"))
