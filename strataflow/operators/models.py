"""Classifier families on MLlib (J1, J3-J7) and model-based rules (K3, K5); see ``training`` for J2 and the focal loss.

Training data is one table ``row_id, split, label, features array<double>``.
MLlib estimators do the distributed fitting; the driver only holds model
parameters.  Scoring is ``model.transform`` or, for the Gaussian-mixture
rule, numpy per Arrow batch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.arrow import with_vectors
from strataflow.functions.rules import predict_argmax, predict_threshold
from strataflow.operators import metrics as L
from strataflow.operators.boosting import fit_trees
from strataflow.operators.imbalance import class_weights, fit_gaussian, with_row_weights

VEC = "_fv"


def with_vector(df: DataFrame, features: str = "features") -> DataFrame:
    return df.withColumn(VEC, array_to_vector(F.col(features).cast("array<double>")))


# ------------------------------------------------------------------ J1 one-vs-rest boosted trees

@dataclass
class OvrTrees:
    models: list
    n_classes: int

    def predict(self, df: DataFrame, features: str = "features", tau: float | None = None) -> DataFrame:
        out = with_vector(df, features)
        cols = []
        for k, m in enumerate(self.models):
            m = m.copy()
            m.setPredictionCol(f"_pred{k}").setRawPredictionCol(f"_raw{k}").setProbabilityCol(f"_prob{k}")
            out = m.transform(out)
            cols.append(vector_to_array(F.col(f"_prob{k}"))[1])
        # a projection each, so that a row's scores and their sum are computed once and not for each element
        out = out.withColumn("_scores", F.array(*cols)).withColumn("_sum", F.aggregate("_scores", F.lit(0.0), lambda a, v: a + v))
        out = out.withColumn("probs", F.transform("_scores", lambda v: F.when(F.col("_sum") > 0, v / F.col("_sum")).otherwise(
            F.lit(1.0) / F.size("_scores"))))
        out = out.drop(VEC, "_scores", "_sum", *[f"_{p}{k}" for k in range(self.n_classes) for p in ("pred", "raw", "prob")])
        pred = predict_argmax(F.col("probs")) if tau is None else predict_threshold(F.col("probs"), tau)
        return out.withColumn("prediction", pred)


def train_trees(data: DataFrame, n_classes: int = 3, features: str = "features", label: str = "label",
                split: str = "split", weight: str | None = "weight", max_iter: int = 20, max_depth: int = 4,
                seed: int = 0, val_split: str = "val") -> OvrTrees:
    """One binary GBT per class with per-row weights and early stopping
    on the validation rows, as MLlib's ``GBTClassifier`` fits it (see
    ``boosting``); the k scores are normalised into probabilities."""
    d = data.where(F.col(split).isin("train", val_split)).withColumn("_is_val", F.col(split) == val_split)
    by_class = None
    if weight and weight not in d.columns:
        made = class_weights(d.where(~F.col("_is_val")), label, n_classes).orderBy(label).collect()  # k rows
        by_class, weight = [r["weight"] for r in made], None
    models = fit_trees(d, n_classes, features, label, "_is_val", weight, by_class, max_iter, max_depth, seed)
    for m in models:
        m.setFeaturesCol(VEC)
    return OvrTrees(models, n_classes)


# ------------------------------------------------------------------ J3 focal re-weighting

@dataclass
class LrModel:
    model: object

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        out = self.model.transform(with_vector(df, features))
        out = out.withColumn("probs", vector_to_array("probability")).drop(VEC, "rawPrediction", "probability")
        return out.withColumn("prediction", predict_argmax(F.col("probs")))


def train_focal(data: DataFrame, n_classes: int = 3, gamma: float = 2.0, features: str = "features",
                label: str = "label", reg: float = 0.01, max_iter: int = 50) -> LrModel:
    """Two-pass focal weighting: fit a class-weighted logistic model,
    score the train rows, set ``weight = alpha_t * (1 - p_t)^gamma`` and refit."""
    tr = data.where(F.col("split") == "train")
    alpha = class_weights(tr, label, n_classes)
    tr = with_vector(with_row_weights(tr, alpha, label, "_alpha"), features).select(
        VEC, label, "_alpha", F.col(label).cast("double").alias("_y"))  # each fit keeps these in blocks of its own
    lr = LogisticRegression(featuresCol=VEC, labelCol="_y", weightCol="_alpha", regParam=reg, maxIter=max_iter,
                            family="multinomial")
    first = lr.fit(tr)
    scored = first.transform(tr).withColumn("probs", vector_to_array("probability"))
    fw = L.focal_weights(scored.drop("rawPrediction", "probability", "prediction"), alpha, gamma, label=label)
    second = lr.copy().setWeightCol("focal_weight").fit(fw)
    return LrModel(second)


# ------------------------------------------------------------------ J4 / K3 Gaussian-mixture MAP rule

@dataclass
class GmmClassifier:
    """Per class: mixture weights, means, covariances; plus log priors."""

    params: dict              # class -> list of (weight, mean, cov)
    log_priors: dict          # class -> log prior
    ridge: float = 1e-6

    def predict(self, df: DataFrame, features: str = "features", boost: float = 1.0, minority: int = 2) -> DataFrame:
        """K3 + K4: ``argmax_c log p(z|c) + log P(c) (+ log boost)`` with the
        log density by log-sum-exp (never log of a product of small
        probabilities); probabilities are the softmax of the log posteriors."""
        classes = sorted(self.params)
        comps = []
        for c in classes:
            for w, mu, cov in self.params[c]:
                d = len(mu)
                cv = cov + self.ridge * np.eye(d)
                chol = np.linalg.cholesky(cv)
                inv_chol = np.linalg.inv(chol)
                logdet = 2.0 * np.log(np.diag(chol)).sum()
                comps.append((c, math.log(max(w, 1e-300)), mu, inv_chol, logdet, d))
        lp = {c: self.log_priors.get(c, math.log(1e-9)) + (math.log(boost) if c == minority else 0.0)
              for c in classes}

        def posteriors(z):
            out = np.full((len(z), len(classes)), -np.inf)
            per = {c: [] for c in classes}
            for c, lw, mu, ic, ld, d in comps:
                y = (z - mu) @ ic.T
                per[c].append(lw - 0.5 * (d * math.log(2 * math.pi) + ld + (y * y).sum(1)))
            for j, c in enumerate(classes):
                a = np.stack(per[c], 1)
                m = a.max(1, keepdims=True)
                out[:, j] = (m[:, 0] + np.log(np.exp(a - m).sum(1))) + lp[c]
            return [out]

        scored = with_vectors(df, features, ["log_post"], posteriors)
        from strataflow.functions.rules import softmax
        return scored.withColumn("probs", softmax(F.col("log_post"))).withColumn(
            "prediction", predict_argmax(F.col("log_post")))


def train_gmm_classifier(data: DataFrame, components: dict[int, int], features: str = "features",
                         label: str = "label", n_init: int = 3, seed: int = 0, max_iter: int = 100,
                         n_classes: int = 3) -> GmmClassifier:
    """One Gaussian mixture per class (full covariance, EM in MLlib),
    best of ``n_init`` seeds by log-likelihood; one component = the class
    Gaussian from a single distributed moment pass."""
    from strataflow.operators.imbalance import class_priors
    tr = data.where(F.col("split") == "train").select(label, features)  # no copy kept: each class's fit reads its own rows
    params = {}
    for c, k in sorted(components.items()):
        rows = tr.where(F.col(label) == c)
        if k <= 1:
            mean, cov, _ = fit_gaussian(rows, features)
            params[c] = [(1.0, mean, cov)]
            continue
        vec = with_vector(rows, features)
        best, best_ll = None, -np.inf
        for i in range(n_init):
            m = GaussianMixture(k=k, featuresCol=VEC, seed=seed + i, maxIter=max_iter).fit(vec)
            ll = m.summary.logLikelihood
            if ll > best_ll:
                best, best_ll = m, ll
        g = best.gaussiansDF.collect()  # k rows
        params[c] = [(float(w), np.asarray(r["mean"].toArray()), np.asarray(r["cov"].toArray()))
                     for w, r in zip(best.weights, g)]
    pri = {r["label"]: r["log_prior"] for r in class_priors(tr, label, n_classes).collect()}
    return GmmClassifier(params, pri)


# ------------------------------------------------------------------ J5 seed sweep

def evaluate_splits(scored: DataFrame, minority: int = 2, n_classes: int = 3) -> dict:
    """Macro F1 and minority recall per split (one small collect)."""
    cm = L.confusion_matrix(scored, list(range(n_classes)), by="split")
    f1 = {r["split"]: r["macro_f1"] for r in L.f1_scores(cm, "split").collect()}
    rec = {r["split"]: r["recall"] for r in L.per_class(cm, "split").where(F.col("label") == minority)
           .select("split", "recall").collect()}
    return {"f1": f1, "recall": rec}


def seed_sweep(data: DataFrame, fit, seeds: list[int], experiment: str, minority: int = 2) -> tuple[DataFrame, object]:
    """One fit per seed, one run record per seed, best by VALIDATION
    macro F1.  Returns (run records, best model).  ``data`` is read for every fit and score, so it should be a
    written table; no copy of it is kept beside those of the fits."""
    from datetime import datetime, timezone
    spark = data.sparkSession
    rows, best, best_f1 = [], None, -1.0
    for s in seeds:
        model = fit(s)
        ev = evaluate_splits(model.predict(data), minority)
        f1v = ev["f1"].get("val", 0.0)
        rows.append((experiment, f"{experiment}-seed{s}", s, "FINISHED",
                     datetime.now(timezone.utc).replace(tzinfo=None),
                     {"seed": str(s)},
                     {"val_macro_f1": f1v, "test_macro_f1": ev["f1"].get("test", 0.0),
                      "train_macro_f1": ev["f1"].get("train", 0.0),
                      "test_class_recall": ev["recall"].get("test", 0.0),
                      "val_class_recall": ev["recall"].get("val", 0.0)}))
        if f1v > best_f1:
            best, best_f1 = model, f1v
    from strataflow.operators.registry import LEDGER_SCHEMA
    return spark.createDataFrame(rows, LEDGER_SCHEMA), best


# ------------------------------------------------------------------ J6 generative argmin

@dataclass
class SubspaceClassifier:
    subspaces: dict    # class -> (mean, V)

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Predict the class whose PCA subspace reconstructs the row best."""
        classes = sorted(self.subspaces)
        subs = [self.subspaces[c] for c in classes]

        def errors(x):
            errs = []
            for mean, v in subs:
                d = x - mean
                r = d - (d @ v) @ v.T
                errs.append((r * r).mean(1))
            return [np.stack(errs, 1)]

        out = with_vectors(df, features, ["recon_error"], errors)
        neg = F.transform("recon_error", lambda e: -e)
        from strataflow.functions.rules import softmax
        return out.withColumn("probs", softmax(neg)).withColumn(
            "prediction", (F.array_position("recon_error", F.array_min("recon_error")) - 1).cast("int"))


def generative_argmin(data: DataFrame, k: int, features: str = "features", label: str = "label",
                      n_classes: int = 3) -> SubspaceClassifier:
    """One generator per class - here a per-class PCA subspace (MLlib)."""
    from strataflow.operators.latent import latent_pca
    tr = data.where(F.col("split") == "train")
    subs = {}
    for c in range(n_classes):
        fit = latent_pca(tr.where(F.col(label) == c), features, k)
        subs[c] = (fit.mean, fit.components)
    return SubspaceClassifier(subs)


# ------------------------------------------------------------------ J7 surrogate tree

def surrogate_tree(scored: DataFrame, feature_names: list[str], features: str = "features",
                   prediction: str = "prediction", max_depth: int = 3) -> tuple[DataFrame, DataFrame]:
    """A depth-3 tree fitted to the model's predictions; fidelity =
    agreement with the model; rules as one row per tree line."""
    d = with_vector(scored, features).withColumn("_y", F.col(prediction).cast("double"))
    tree = DecisionTreeClassifier(featuresCol=VEC, labelCol="_y", maxDepth=max_depth, seed=0,
                                  predictionCol="_tp", rawPredictionCol="_traw", probabilityCol="_tprob").fit(d)
    agree = tree.transform(d).agg(F.avg((F.col("_tp") == F.col("_y")).cast("double")).alias("fidelity"),
                                  F.count(F.lit(1)).alias("n"))
    lines = tree.toDebugString.splitlines()[1:]
    rules = []
    for i, ln in enumerate(lines):
        text = ln.strip()
        for j, name in enumerate(feature_names):
            text = text.replace(f"feature {j} ", f"{name} ")
        rules.append((i, (len(ln) - len(ln.lstrip())) // 1, text))
    spark = scored.sparkSession
    return agree, spark.createDataFrame(rules, "line int, indent int, rule string")


# ------------------------------------------------------------------ K5 champion scoring

@dataclass
class Champion:
    """features -> latent encoder -> classifier -> label."""

    encoder: object        # strataflow.operators.latent.Encoder or None
    classifier: object     # any of the models above (has .predict)
    tau: float | None = None

    def score(self, df: DataFrame, features: str = "features") -> DataFrame:
        from strataflow.operators.latent import encode_batch
        x = df
        if self.encoder is not None:
            x = encode_batch(df, self.encoder, features, out_mu="_z", out_log_var=None)
            x = x.withColumnRenamed(features, "_in").withColumnRenamed("_z", features)
        out = self.classifier.predict(x, features)
        if self.tau is not None:
            out = out.withColumn("prediction", predict_threshold(F.col("probs"), self.tau))
        return out
