"""Classification metrics (L1-L14) from a ``label, prediction[, probs]`` table.

Everything reduces the scored rows ONCE to a small table (a confusion matrix,
per-threshold counts, per-score counts) and derives the metrics from it, so
the metric cost is one partial aggregate over the data whatever the number of
metrics.  Every function takes ``by`` grouping columns (split, model, ...).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.ranking import count_below, value_counts_cumulative
from strataflow.functions.rules import predict_threshold
from strataflow.session import materialize

EPS = float.fromhex("0x1.0p-52")  # float64 machine epsilon


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def _r(x: Column, nd: int = 6) -> Column:
    return F.round(x, nd)


def confusion_matrix(df: DataFrame, labels: list[int] = (0, 1, 2), by=(), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """L1: counts for every (label, prediction) pair of the fixed label set,
    zeros kept.  Grid = distinct groups x labels x labels, built by
    ``explode`` on the (small) group table."""
    by = _by(by)
    counts = materialize(df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")))  # groups x k^2 rows: the scored rows are read once
    groups = counts.select(*by).distinct() if by else df.sparkSession.range(1).select()
    lab = F.array(*[F.lit(int(x)) for x in labels])
    grid = groups.select(*by, F.explode(lab).alias("label")).select(*by, "label",
                                                                    F.explode(lab).alias("prediction"))
    cm = grid.join(counts, by + ["label", "prediction"], "left").select(
        *by, "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    return cm


def per_class(cm: DataFrame, by=()) -> DataFrame:
    """L2: precision / recall / F1 / support per class (0 on zero division)."""
    by = _by(by)
    diag = cm.groupBy(*by, F.col("label").alias("cls")).agg(
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("support"))
    pred = cm.groupBy(*by, F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    j = diag.join(pred, by + ["cls"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return j.select(*by, F.col("cls").alias("label"), F.col("tp").cast("bigint").alias("tp"),
                    F.col("support").cast("bigint").alias("support"),
                    F.col("predicted").cast("bigint").alias("predicted"),
                    _r(p).alias("precision"), _r(r).alias("recall"), _r(f1).alias("f1"), f1.alias("_f1"))


def f1_scores(cm: DataFrame, by=()) -> DataFrame:
    """L3: macro F1 over labels present in truth or prediction, and the
    support-weighted F1."""
    by = _by(by)
    pc = per_class(cm, by)
    present = (F.col("support") > 0) | (F.col("predicted") > 0)
    agg = pc.groupBy(*by).agg(
        F.avg(F.when(present, F.col("_f1"))).alias("macro_f1"),
        (F.sum(F.col("_f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").cast("bigint").alias("n"))
    return agg.select(*by, _r(F.coalesce("macro_f1", F.lit(0.0))).alias("macro_f1"),
                      _r(F.coalesce("weighted_f1", F.lit(0.0))).alias("weighted_f1"), "n")


def class_recall(df: DataFrame, cls: int = 2, by=(), label: str = "label", prediction: str = "prediction") -> DataFrame:
    """L4: recall of one class; 0.0 when it has no rows."""
    by = _by(by)
    pos = F.col(label) == cls
    agg = df.groupBy(*by).agg(F.count(F.when(pos, 1)).alias("positives"),
                              F.count(F.when(pos & (F.col(prediction) == cls), 1)).alias("hits"))
    return agg.select(*by, "positives", "hits",
                      _r(F.when(F.col("positives") > 0, F.col("hits") / F.col("positives")).otherwise(0.0))
                      .alias("recall"))


def _p_true(probs: str, label: str) -> Column:
    return F.element_at(F.col(probs), F.col(label) + 1)


def log_loss(df: DataFrame, probs: str = "probs", label: str = "label", by=()) -> DataFrame:
    """Mean cross-entropy in nats, probabilities clipped to [eps, 1-eps]."""
    by = _by(by)
    p = F.least(F.greatest(_p_true(probs, label), F.lit(EPS)), F.lit(1 - EPS))
    return df.groupBy(*by).agg(_r(F.avg(-F.log(p))).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def focal_loss(df: DataFrame, alpha: DataFrame, gamma: float = 2.0, probs: str = "probs",
               label: str = "label", by=()) -> DataFrame:
    """Mean ``-alpha_t (1 - p_t)^gamma ln p_t``; ``alpha`` is a per-class
    table (label, weight) such as :func:`class_weights` (k rows, broadcast)."""
    by = _by(by)
    j = df.join(F.broadcast(alpha.select(F.col("label").alias(label), F.col("weight").alias("_a"))), label, "left")
    p = F.least(F.greatest(_p_true(probs, label), F.lit(EPS)), F.lit(1 - EPS))
    term = -F.coalesce(F.col("_a"), F.lit(1.0)) * F.pow(1 - p, F.lit(float(gamma))) * F.log(p)
    return j.groupBy(*by).agg(_r(F.avg(term)).alias("focal_loss"), F.count(F.lit(1)).alias("n"))


def focal_weights(df: DataFrame, alpha: DataFrame, gamma: float = 2.0, probs: str = "probs",
                  label: str = "label", out: str = "focal_weight") -> DataFrame:
    """J3 weight column: ``alpha_t * (1 - p_t)^gamma`` for a re-weighted refit."""
    j = df.join(F.broadcast(alpha.select(F.col("label").alias(label), F.col("weight").alias("_a"))), label, "left")
    p = F.least(F.greatest(_p_true(probs, label), F.lit(EPS)), F.lit(1 - EPS))
    return j.withColumn(out, F.coalesce(F.col("_a"), F.lit(1.0)) * F.pow(1 - p, F.lit(float(gamma)))).drop("_a")


def _ovr_scores(df: DataFrame, probs: str, label: str, n_classes: int, by: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("cls"), F.col(probs)[k].alias("score"),
                              (F.col(label) == k).cast("int").alias("pos")) for k in range(n_classes)])
    return df.select(*by, F.explode(rows).alias("s")).select(*by, "s.*")


def roc_curve(df: DataFrame, n_classes: int = 3, probs: str = "probs", label: str = "label", by=()) -> DataFrame:
    """One-vs-rest ROC points, one per (class, distinct score), score
    descending: cumulative TP / FP and their rates.  Built on the two-level
    cumulative plan (no task holds a whole class)."""
    by = _by(by)
    s = _ovr_scores(df, probs, label, n_classes, by)
    cum = value_counts_cumulative(s, "score", by=by + ["cls"],
                                  weights={"pos": F.col("pos"), "neg": 1 - F.col("pos")}, descending=True)
    return cum.select(*by, "cls", _r(F.col("score")).alias("threshold"),
                      F.col("pos_cum").cast("bigint").alias("tp"), F.col("neg_cum").cast("bigint").alias("fp"),
                      _r(F.when(F.col("pos_total") > 0, F.col("pos_cum") / F.col("pos_total"))).alias("tpr"),
                      _r(F.when(F.col("neg_total") > 0, F.col("neg_cum") / F.col("neg_total"))).alias("fpr"))


def auc_ovr(df: DataFrame, n_classes: int = 3, probs: str = "probs", label: str = "label", by=()) -> DataFrame:
    """One-vs-rest AUC by the trapezoid rule over distinct scores (ties
    are one step, so tie-safe); 0.0 when the class has no positives or no
    negatives.  Each step's area is local to its row: no lag window."""
    by = _by(by)
    s = _ovr_scores(df, probs, label, n_classes, by)
    cum = value_counts_cumulative(s, "score", by=by + ["cls"],
                                  weights={"pos": F.col("pos"), "neg": 1 - F.col("pos")}, descending=True)
    area = F.col("neg") * (F.col("pos_before") + F.col("pos_cum"))
    agg = cum.groupBy(*by, "cls").agg(F.sum(area).alias("_a"), F.first("pos_total").alias("P"),
                                      F.first("neg_total").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_a") / (2.0 * F.col("P") * F.col("N"))).otherwise(0.0)
    return agg.select(*by, "cls", _r(auc).alias("auc"))


def generalisation_gap(cm: DataFrame, group: str = "split", train: str = "train", test: str = "test",
                       by=()) -> DataFrame:
    """Train macro F1 - test macro F1 (positive = overfit)."""
    by = _by(by)
    f = f1_scores(cm, by + [group])
    return f.groupBy(*by).agg(
        F.max(F.when(F.col(group) == train, F.col("macro_f1"))).alias("train_f1"),
        F.max(F.when(F.col(group) == test, F.col("macro_f1"))).alias("test_f1")).withColumn(
        "gap", _r(F.col("train_f1") - F.col("test_f1")))


def thresholds(lo: float = 0.15, hi: float = 0.50, step: float = 0.01) -> list[float]:
    n = int(round((hi - lo) / step)) + 1
    return [round(lo + i * step, 10) for i in range(n)]


def threshold_confusion(df: DataFrame, taus: list[float], probs: str = "probs", label: str = "label",
                        minority: int = 2, by=()) -> DataFrame:
    """Confusion counts of the threshold rule for EVERY tau in one pass.

    A row is predicted minority exactly for the taus <= p_min, otherwise it
    gets the argmax of the other classes, which does not depend on tau.  So
    rows are reduced to counts per (group, label, other-argmax, tau bucket);
    that small table is expanded over the taus with ``explode`` - the data
    is never multiplied by the number of thresholds.
    """
    by = _by(by)
    tarr = F.array(*[F.lit(float(t)) for t in taus])
    other = predict_threshold(F.col(probs), F.lit(2.0), minority)  # tau > 1: never minority
    pm = F.col(probs)[minority]
    small = (df.select(*by, F.col(label).alias("label"), other.alias("_other"),
                       count_below([F.lit(float(t)) for t in taus], len(taus), pm, inclusive=True).alias("_b"))
               .groupBy(*by, "label", "_other", "_b").agg(F.count(F.lit(1)).alias("n")))
    small = materialize(small)  # groups x k x k x (taus + 1) rows; the data is read once
    ex = small.select(*by, "label", "_other", "_b", "n",
                      F.posexplode(tarr).alias("_j", "tau"))
    pred = F.when(F.col("_b") >= F.col("_j") + 1, F.lit(minority)).otherwise(F.col("_other"))
    return ex.groupBy(*by, "tau", "label", pred.alias("prediction")).agg(F.sum("n").cast("bigint").alias("n"))


def threshold_scan(df: DataFrame, taus: list[float] | None = None, probs: str = "probs", label: str = "label",
                   minority: int = 2, by=("split",), f1_gate: float = 0.35, recall_gate: float = 0.50,
                   labels: list[int] = (0, 1, 2)) -> DataFrame:
    """Macro F1 and minority recall per (tau, group) with gate flags."""
    by = _by(by)
    taus = taus or thresholds()
    tc = threshold_confusion(df, taus, probs, label, minority, by)
    def cells(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    wide = tc.groupBy(*by, "tau").agg(*[x for k in labels for x in (
        cells((F.col("label") == k) & (F.col("prediction") == k)).alias(f"tp{k}"),
        cells(F.col("label") == k).alias(f"support{k}"), cells(F.col("prediction") == k).alias(f"predicted{k}"))])

    def f1(k):  # 2 tp / (support + predicted); null for a label that is in neither
        both = F.col(f"support{k}") + F.col(f"predicted{k}")
        return F.when(both > 0, 2 * F.col(f"tp{k}") / both)

    scores = F.filter(F.array(*[f1(k) for k in labels]), lambda x: x.isNotNull())
    macro = F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores)).otherwise(0.0)
    recall = F.when(F.col(f"support{minority}") > 0, F.col(f"tp{minority}") / F.col(f"support{minority}")).otherwise(0.0)
    out = wide.select(*by, "tau", macro.alias("f"), recall.alias("r"))
    return out.select(*by, _r(F.col("tau"), 2).alias("tau"), _r(F.col("f")).alias("macro_f1"),
                      _r(F.col("r")).alias("minority_recall"), (F.col("f") > f1_gate).alias("passes_f1"),
                      (F.col("r") >= recall_gate).alias("passes_recall"))


def pick_threshold(scan: DataFrame, split: str = "val", f1_gate: float = 0.35,
                   recall_gate: float = 0.50, group: str = "split") -> DataFrame:
    """Highest val F1 among taus passing both gates (first tau on ties);
    if none passes, the tau with the smallest Euclidean gap to the gates."""
    v = scan.where(F.col(group) == split)
    both = F.col("passes_f1") & F.col("passes_recall")
    gap = F.sqrt(F.pow(F.greatest(F.lit(0.0), recall_gate - F.col("minority_recall")), 2)
                 + F.pow(F.greatest(F.lit(0.0), f1_gate - F.col("macro_f1")), 2))
    any_pass = F.max(both.cast("int")).over(Window.partitionBy(F.lit(1)))  # over the few scan rows
    ranked = v.select("*", both.alias("both_pass"), _r(gap).alias("gap_distance"), any_pass.alias("_any"))
    # passing rows first; among them best F1, else smallest gap; then lowest tau
    key2 = F.when(F.col("_any") == 1, -F.col("macro_f1")).otherwise(F.col("gap_distance"))
    return (ranked.orderBy((~F.col("both_pass")).cast("int"), key2, "tau").limit(1)
                  .select("tau", "macro_f1", "minority_recall", "both_pass", "gap_distance"))


def compare_rules(df: DataFrame, probs: str = "probs", label: str = "label", tau: float = 0.04,
                  minority: int = 2, labels: list[int] = (0, 1, 2)) -> DataFrame:
    """Threshold rule vs argmax per class: P/R/F1 of each and deltas."""
    from strataflow.functions.rules import predict_argmax
    stacked = df.select(F.col(label).alias("label"), F.explode(F.array(
        F.struct(F.lit("argmax").alias("rule"), predict_argmax(F.col(probs)).alias("prediction")),
        F.struct(F.lit("threshold").alias("rule"), predict_threshold(F.col(probs), tau, minority)
                 .alias("prediction")))).alias("s")).select("label", "s.*")
    pc = per_class(confusion_matrix(stacked, labels, by="rule"), by="rule")
    w = pc.groupBy("label").pivot("rule", ["argmax", "threshold"]).agg(
        F.first("precision").alias("precision"), F.first("recall").alias("recall"), F.first("f1").alias("f1"))
    return w.select("label", *[c for c in w.columns if c != "label"],
                    _r(F.col("threshold_f1") - F.col("argmax_f1")).alias("delta_f1"),
                    _r(F.col("threshold_recall") - F.col("argmax_recall")).alias("delta_recall"))


def compare_models(df: DataFrame, model_a: str, model_b: str, model: str = "model", probs: str = "probs",
                   label: str = "label", prediction: str = "prediction", n_classes: int = 3) -> DataFrame:
    """Per-class P/R/F1 and AUC of two models side by side, deltas
    (b - a) and the winner per metric."""
    labels = list(range(n_classes))
    pc = per_class(confusion_matrix(df, labels, by=model, label=label, prediction=prediction), by=model)
    auc = auc_ovr(df, n_classes, probs, label, by=model).withColumnRenamed("cls", "label")
    m = pc.join(auc, [model, "label"])
    metrics = ["precision", "recall", "f1", "auc"]
    w = m.groupBy("label").pivot(model, [model_a, model_b]).agg(*[F.first(x).alias(x) for x in metrics])
    out = [F.col("label")]
    for x in metrics:
        a, b = F.col(f"{model_a}_{x}"), F.col(f"{model_b}_{x}")
        out += [a.alias(f"a_{x}"), b.alias(f"b_{x}"), _r(b - a).alias(f"delta_{x}"),
                F.when(b > a, F.lit(model_b)).when(a > b, F.lit(model_a)).otherwise(F.lit("tie")).alias(f"winner_{x}")]
    return w.select(*out)


def seed_variability(ledger: DataFrame, metric: str = "macro_f1", recall: str = "class_recall",
                     group: str = "experiment", f1_gate: float = 0.30, recall_gate: float = 0.50,
                     in_sample: str | None = None) -> DataFrame:
    """Per experiment: runs, distinct metric values, mean, std, min, max,
    mean recall and the gate result on the means; with ``in_sample``, the
    metric on the train rows, also its mean and the gap to ``metric``
    (positive = overfit)."""
    agg = ledger.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_runs"), F.countDistinct(metric).alias("n_distinct"),
        F.avg(metric).alias("_m"), F.stddev_samp(metric).alias("_s"), F.min(metric).alias("_lo"),
        F.max(metric).alias("_hi"), F.avg(recall).alias("_r"), *([F.avg(in_sample).alias("_in")] if in_sample else []))
    overfit = [_r(F.col("_in")).alias("mean_in"), _r(F.col("_m")).alias("mean_out"), _r(F.col("_in") - F.col("_m")).alias("gap")]
    return agg.select(group, "n_runs", "n_distinct", _r(F.col("_m")).alias("mean_f1"),
                      _r(F.col("_s")).alias("std_f1"), _r(F.col("_lo")).alias("min_f1"),
                      _r(F.col("_hi")).alias("max_f1"), _r(F.col("_r")).alias("mean_recall"),
                      ((F.col("_m") > f1_gate) & (F.col("_r") > recall_gate)).alias("gates_passed"),
                      *(overfit if in_sample else []))


def softmax_rows(df: DataFrame, logits: str, out: str = "probs") -> DataFrame:
    """K4 on a table."""
    from strataflow.functions.rules import softmax
    return df.withColumn(out, softmax(F.col(logits)))


