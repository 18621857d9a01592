"""Latent projection.

The latent space is learned with MLlib PCA from one distributed pass for mean
and covariance; scoring is a frozen feed-forward encoder applied per Arrow batch with numpy
(``mapInArrow``): the weights are a few small matrices shipped with the task,
rows never leave their partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame

from strataflow.functions.arrow import with_vectors
from strataflow.operators.imbalance import fit_gaussian


@dataclass
class Layer:
    weight: np.ndarray          # (in, out)
    bias: np.ndarray            # (out,)
    layer_norm: bool = False
    activation: str = "none"    # none | relu


@dataclass
class Encoder:
    """Frozen encoder: hidden layers, then mu (and optional log_var) heads."""

    hidden: list[Layer] = field(default_factory=list)
    mu: Layer | None = None
    log_var: Layer | None = None

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        h = x
        for layer in self.hidden:
            h = h @ layer.weight + layer.bias
            if layer.layer_norm:
                m = h.mean(axis=1, keepdims=True)
                v = h.var(axis=1, keepdims=True)
                h = (h - m) / np.sqrt(v + 1e-5)
            if layer.activation == "relu":
                h = np.maximum(h, 0.0)
        mu = h @ self.mu.weight + self.mu.bias
        lv = h @ self.log_var.weight + self.log_var.bias if self.log_var is not None else None
        return mu, lv


def encode_batch(df: DataFrame, encoder: Encoder, features: str = "features", out_mu: str = "mu",
                 out_log_var: str | None = "log_var") -> DataFrame:
    """Score every row through the frozen encoder (deterministic);
    row count unchanged, all other columns kept."""
    has_lv = encoder.log_var is not None and out_log_var is not None
    return with_vectors(df, features, [out_mu, out_log_var] if has_lv else [out_mu],
                        lambda x: encoder.forward(x) if has_lv else encoder.forward(x)[:1])


def decode_batch(df: DataFrame, decoder: Encoder, latent: str = "mu", out: str = "x_hat") -> DataFrame:
    """Mean-path reconstruction with a frozen decoder (same scorer)."""
    return with_vectors(df, latent, [out], lambda z: decoder.forward(z)[:1])


@dataclass
class PcaFit:
    mean: np.ndarray
    components: np.ndarray      # (p, k)
    explained: np.ndarray       # (k,)

    def encoder(self) -> Encoder:
        """Centered projection as a one-layer encoder: mu = (x - mean) V."""
        w = self.components
        return Encoder(mu=Layer(w, -self.mean @ w))

    def decoder(self) -> Encoder:
        """Mean-path reconstruction: x_hat = mu V^T + mean."""
        return Encoder(mu=Layer(self.components.T, self.mean.copy()))


def latent_pca(train: DataFrame, features: str, k: int) -> PcaFit:
    """MLlib PCA on the train rows.  Mean and covariance come from one distributed pass; MLlib gets 2 p rows of the
    same covariance (a pair on each of its axes), so that it does not read the train rows once more."""
    mean, cov, n = fit_gaussian(train, features)
    p = len(mean)
    if n < 2 or k > p or not np.isfinite(cov).all():
        raise ValueError(f"{k} components need as many dimensions and at least 2 rows of numbers, not {n} rows of {p}")
    var, axes = np.linalg.eigh(cov)
    half = np.sqrt(np.maximum(var, 0.0) * (2 * p - 1) / 2)[:, None] * axes.T
    pairs = train.sparkSession.createDataFrame([(Vectors.dense(r),) for r in np.concatenate([half, -half])], ["_v"])
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(pairs)
    return PcaFit(mean, model.pc.toArray(), model.explainedVariance.toArray())


def explained_variance_table(spark, fit: PcaFit, target: float = 0.90) -> DataFrame:
    """I3 report: per component explained and cumulative share, and the
    number of components reaching ``target``."""
    cum = np.cumsum(fit.explained)
    need = int(np.searchsorted(cum, target) + 1) if cum[-1] >= target else None
    rows = [(i, float(e), float(c), need) for i, (e, c) in enumerate(zip(fit.explained, cum))]
    return spark.createDataFrame(rows, "component int, explained double, cumulative double, dims_for_target int")
