"""Statistical comparison of model families (M1-M6).

Per-group moments come from one aggregate over the run table; the pair
table is built from that k-row summary (k = number of groups), so its size
does not depend on the number of runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.mathx import t_p_value, t_quantile


def _r(x, nd=6):
    return F.round(x, nd)


def group_moments(runs: DataFrame, group: str = "experiment", metric: str = "macro_f1") -> DataFrame:
    return runs.where(F.col(metric).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(metric).alias("mean"), F.var_samp(metric).alias("var"))


def pair_table(moments: DataFrame, group: str = "experiment") -> DataFrame:
    """All unordered group pairs (a < b) of the k-row moment table."""
    a = moments.select(*[F.col(x).alias(f"{x}_a") for x in moments.columns])
    b = moments.select(*[F.col(x).alias(f"{x}_b") for x in moments.columns])
    return a.join(b, F.col(f"{group}_a") < F.col(f"{group}_b"))  # k rows a side, one for each group


def welch_pairs(runs: DataFrame, group: str = "experiment", metric: str = "macro_f1",
                alpha: float = 0.05, with_p: bool = False) -> DataFrame:
    """M1 + M2: Welch t statistic and Welch-Satterthwaite df for every pair,
    Bonferroni alpha = alpha / number of pairs; optionally the two-sided p
    (NaN p -> 1.0)."""
    m = group_moments(runs, group, metric)
    p = pair_table(m, group)
    se2a, se2b = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    # zero variance on both sides -> null t (p treated as 1.0), not an ANSI error
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(se2a + se2b))
    dfw = F.try_divide(F.pow(se2a + se2b, 2),
                       F.pow(se2a, 2) / (F.col("n_a") - 1) + F.pow(se2b, 2) / (F.col("n_b") - 1))
    n_pairs = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))  # over the k*(k-1)/2 pair rows
    out = p.select(F.col(f"{group}_a").alias("group_a"), F.col(f"{group}_b").alias("group_b"),
                   "n_a", "n_b", _r(F.col("mean_a")).alias("mean_a"), _r(F.col("mean_b")).alias("mean_b"),
                   t.alias("_t"), dfw.alias("_df"), (F.lit(alpha) / n_pairs).alias("alpha_bonferroni"))
    out = out.withColumn("t", _r(F.col("_t"))).withColumn("df", _r(F.col("_df")))
    if with_p:
        out = out.withColumn("p_value", F.coalesce(t_p_value(F.col("_t"), F.col("_df")), F.lit(1.0)))
    return out.drop("_t", "_df").withColumn("alpha_bonferroni", _r(F.col("alpha_bonferroni"), 9))


def cohens_d(runs: DataFrame, group: str = "experiment", metric: str = "macro_f1") -> DataFrame:
    """M3: (mean_a - mean_b) / pooled sample std; null when the pooled std is 0."""
    m = group_moments(runs, group, metric)
    p = pair_table(m, group)
    pooled = F.sqrt(((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"))
                    / (F.col("n_a") + F.col("n_b") - 2))
    d = F.when(pooled > 0, (F.col("mean_a") - F.col("mean_b")) / pooled)
    return p.select(F.col(f"{group}_a").alias("group_a"), F.col(f"{group}_b").alias("group_b"),
                    _r(d).alias("cohens_d"))


def mean_ci(runs: DataFrame, group: str = "experiment", metric: str = "macro_f1",
            confidence: float = 0.95) -> DataFrame:
    """M4: t confidence interval of each group's mean (null for n < 2)."""
    m = runs.where(F.col(metric).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"))
    q = t_quantile(F.lit((1 + confidence) / 2), (F.col("n") - 1).cast("double"))
    margin = F.when(F.col("n") > 1, F.col("sd") / F.sqrt(F.col("n")) * q)
    return m.select(group, "n", _r(F.col("mean")).alias("mean"), _r(F.col("mean") - margin).alias("ci_low"),
                    _r(F.col("mean") + margin).alias("ci_high"))


def select_winner(pairs_with_p: DataFrame, tiebreak: list[str]) -> DataFrame:
    """M5: candidates = groups significantly better than at least one other
    (p < Bonferroni alpha and higher mean); winner = best mean among them,
    else the first tiebreak entry.  One row: winner, n_candidates."""
    sig = F.col("p_value") < F.col("alpha_bonferroni")
    a_wins = pairs_with_p.where(sig & (F.col("mean_a") > F.col("mean_b"))).select(
        F.col("group_a").alias("g"), F.col("mean_a").alias("mean"))
    b_wins = pairs_with_p.where(sig & (F.col("mean_b") > F.col("mean_a"))).select(
        F.col("group_b").alias("g"), F.col("mean_b").alias("mean"))
    cands = a_wins.unionByName(b_wins).distinct()
    place = F.coalesce(F.array_position(F.array(*[F.lit(g) for g in tiebreak]), F.col("g")), F.lit(0))
    # of equal means the first in the tiebreak order, groups outside it last
    first = F.struct("mean", F.when(place > 0, -place).otherwise(F.lit(-1 - len(tiebreak))), F.lit(0))
    agg = cands.agg(F.max_by("g", first).alias("best"), F.count(F.lit(1)).alias("n_candidates"))
    return agg.select(F.coalesce("best", F.lit(tiebreak[0])).alias("winner"), "n_candidates")


def quality_gates(runs: DataFrame, group: str = "experiment", f1: str = "macro_f1", recall: str = "class_recall",
                  f1_gate: float = 0.30, recall_gate: float = 0.50) -> DataFrame:
    """M6: per group mean F1 > gate and mean minority recall > gate (strict)."""
    m = runs.where(F.col(f1).isNotNull() & F.col(recall).isNotNull()).groupBy(group).agg(
        F.avg(f1).alias("_f"), F.avg(recall).alias("_r"))
    return m.select(group, _r(F.col("_f")).alias("mean_f1"), _r(F.col("_r")).alias("mean_recall"),
                    ((F.col("_f") > f1_gate) & (F.col("_r") > recall_gate)).alias("gates_passed"))


def evaluate_families(runs: DataFrame, tiebreak: list[str], group: str = "experiment", metric: str = "macro_f1",
                      recall: str = "class_recall", alpha: float = 0.05, f1_gate: float = 0.30,
                      recall_gate: float = 0.50, families: list[str] = ()) -> DataFrame:
    """M1-M6 together: the evaluation report row (winner, its means, gates).  Each of ``families`` must have a
    run with both metrics."""
    complete = {r[group] for r in runs.where(F.col(metric).isNotNull() & F.col(recall).isNotNull())
                .select(group).distinct().collect()}  # one row per family
    if absent := [g for g in families if g not in complete]:
        raise ValueError(f"no complete run of {absent}")
    pairs = welch_pairs(runs, group, metric, alpha, with_p=True)
    win = select_winner(pairs, tiebreak)
    gates = quality_gates(runs, group, metric, recall, f1_gate, recall_gate)
    return win.join(gates, win["winner"] == gates[group], "left").select(
        "winner", "n_candidates", "mean_f1", "mean_recall", F.coalesce("gates_passed", F.lit(False)).alias("gates_passed"))
