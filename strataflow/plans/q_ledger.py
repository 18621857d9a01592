"""Catalog entries on the run ``ledger`` view: A5-A7, M1-M6, L14, N1, N4, N5,
Q1, Q2."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataflow.operators import metrics as L
from strataflow.operators import registry as RG
from strataflow.operators import search as N
from strataflow.operators import stats as M
from strataflow.plans.catalog import register
from strataflow.sources import io as IO
from strataflow.sources.tables import tables

METRICS = ["macro_f1", "class_recall"]
LR = """lr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC,
              run_id DESC) AS rn FROM ledger WHERE status = 'FINISHED')
        WHERE rn <= 10 AND macro_f1 IS NOT NULL AND class_recall IS NOT NULL)"""


def ledger(spark, sf_dir):
    return tables(spark, sf_dir).ledger()


def latest(spark, sf_dir, n=10):
    return RG.latest_runs(ledger(spark, sf_dir), n, METRICS)


def _r(c, nd=6):
    return F.round(F.col(c), nd).alias(c)


@register("log_runs", """
SELECT experiment, CAST(run_id AS VARCHAR) AS run_id, metric, round(value, 6) AS value FROM (
  SELECT experiment, run_id, 'macro_f1' AS metric, macro_f1 AS value FROM ledger
  UNION ALL SELECT experiment, run_id, 'class_recall', class_recall FROM ledger) WHERE value IS NOT NULL""")
def q_log_runs(spark, sf_dir):
    rec = RG.run_records(ledger(spark, sf_dir), METRICS, ["seed"])
    path = IO.fresh_path(spark, "ledger")
    RG.log_runs(rec.where("seed % 2 = 0"), path)
    RG.log_runs(rec.where("seed % 2 <> 0 or seed is null"), path)  # a later session's runs, appended
    return RG.tall_metrics(RG.read_ledger(spark, path)).select("experiment", "run_id", "metric", _r("value"))


@register("latest_runs", f"""WITH {LR}
SELECT experiment, run_id, start_time, round(macro_f1, 6) AS macro_f1, round(class_recall, 6) AS class_recall FROM lr""")
def q_latest_runs(spark, sf_dir):
    return latest(spark, sf_dir).select("experiment", "run_id", "start_time", _r("macro_f1"), _r("class_recall"))


@register("best_run", """
SELECT experiment, run_id, round(macro_f1, 6) AS macro_f1 FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY macro_f1 DESC, run_id) AS rn
  FROM ledger WHERE macro_f1 IS NOT NULL) WHERE rn = 1""")
def q_best_run(spark, sf_dir):
    return RG.best_run(ledger(spark, sf_dir), "macro_f1").select("experiment", "run_id", _r("macro_f1"))


MOM = "m AS (SELECT experiment, count(*) AS n, avg(macro_f1) AS mean, var_samp(macro_f1) AS var FROM lr GROUP BY 1)"


@register("welch_pairs", f"""WITH {LR}, {MOM}
SELECT a.experiment AS group_a, b.experiment AS group_b, a.n AS n_a, b.n AS n_b,
       round(a.mean, 6) AS mean_a, round(b.mean, 6) AS mean_b,
       round(0.05 / count(*) OVER (), 9) AS alpha_bonferroni,
       round((a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n), 6) AS t,
       round(pow(a.var / a.n + b.var / b.n, 2) / (pow(a.var / a.n, 2) / (a.n - 1) + pow(b.var / b.n, 2) / (b.n - 1)), 6)
         AS df
FROM m a JOIN m b ON a.experiment < b.experiment""")
def q_welch_pairs(spark, sf_dir):
    return M.welch_pairs(latest(spark, sf_dir))


@register("welch_p")
def q_welch_p(spark, sf_dir):
    return M.welch_pairs(latest(spark, sf_dir), with_p=True)


@register("cohens_d", f"""WITH {LR}, {MOM}
SELECT a.experiment AS group_a, b.experiment AS group_b,
       round(CASE WHEN sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2)) > 0 THEN (a.mean - b.mean)
             / sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2)) END, 6) AS cohens_d
FROM m a JOIN m b ON a.experiment < b.experiment""")
def q_cohens_d(spark, sf_dir):
    return M.cohens_d(latest(spark, sf_dir))


@register("mean_ci")
def q_mean_ci(spark, sf_dir):
    return M.mean_ci(latest(spark, sf_dir))


@register("select_winner")
def q_select_winner(spark, sf_dir):
    return M.evaluate_families(latest(spark, sf_dir), tiebreak=["click", "view", "purchase"],
                               families=["click", "view", "purchase"])


@register("quality_gates", f"""WITH {LR}
SELECT experiment, round(avg(macro_f1), 6) AS mean_f1, round(avg(class_recall), 6) AS mean_recall,
       avg(macro_f1) > 0.3 AND avg(class_recall) > 0.5 AS gates_passed FROM lr GROUP BY 1""")
def q_quality_gates(spark, sf_dir):
    return M.quality_gates(latest(spark, sf_dir))


@register("seed_variability", """
SELECT experiment, count(*) AS n_runs, count(DISTINCT macro_f1) AS n_distinct, round(avg(macro_f1), 6) AS mean_f1,
       round(stddev_samp(macro_f1), 6) AS std_f1, round(min(macro_f1), 6) AS min_f1, round(max(macro_f1), 6) AS max_f1,
       round(avg(class_recall), 6) AS mean_recall, avg(macro_f1) > 0.3 AND avg(class_recall) > 0.5 AS gates_passed,
       round(avg(macro_f1 + 0.125 * class_recall), 6) AS mean_in, round(avg(macro_f1), 6) AS mean_out,
       round(avg(macro_f1 + 0.125 * class_recall) - avg(macro_f1), 6) AS gap
FROM ledger WHERE status = 'FINISHED' GROUP BY 1""")
def q_seed_variability(spark, sf_dir):
    # stand-in for the score on the train rows, which the ledger view lacks
    runs = ledger(spark, sf_dir).where(F.col("status") == "FINISHED").withColumn(
        "train_f1", F.col("macro_f1") + 0.125 * F.col("class_recall"))
    return L.seed_variability(runs, in_sample="train_f1")


@register("fitness", """
SELECT run_id, round(0.5 * macro_f1 + 0.5 * class_recall - pow(greatest(0.0, 0.35 - class_recall), 2) * 4.0, 6)
         AS fitness_penalised,
       round(macro_f1 * CASE WHEN class_recall >= 0.5 THEN 1.0 ELSE 0.5 END, 6) AS fitness_gated,
       round(0.6 * macro_f1 + 0.4 * class_recall, 6) AS fitness_blend FROM ledger""")
def q_fitness(spark, sf_dir):
    lg = ledger(spark, sf_dir)
    f, r = F.col("macro_f1"), F.col("class_recall")
    return lg.select("run_id", F.round(N.fitness_penalised(f, r), 6).alias("fitness_penalised"),
                     F.round(N.fitness_gated(f, r), 6).alias("fitness_gated"),
                     F.round(N.fitness_blend(f, r), 6).alias("fitness_blend"))


TRIALS_SQL = """tr AS (SELECT user_id % 50 AS trial, ts, event_id, value / (1 + value) AS value FROM events),
tp AS (SELECT trial, row_number() OVER (PARTITION BY trial ORDER BY ts, event_id) - 1 AS step, value,
              min(ts) OVER (PARTITION BY trial) AS trial_start FROM tr)"""


def trials(spark, sf_dir):
    ev = tables(spark, sf_dir).base("events")
    t = ev.select((F.col("user_id") % 50).alias("trial"), "ts", "event_id",
                  (F.col("value") / (1 + F.col("value"))).alias("value"))
    w = Window.partitionBy("trial").orderBy("ts", "event_id")
    return t.select("trial", (F.row_number().over(w) - 1).cast("bigint").alias("step"), "value",
                    F.min("ts").over(Window.partitionBy("trial")).alias("trial_start"))


@register("median_prune", f"""WITH {TRIALS_SQL},
ti AS (SELECT trial, dense_rank() OVER (ORDER BY trial_start, trial) - 1 AS trial_index
       FROM (SELECT DISTINCT trial, trial_start FROM tp)),
j AS (SELECT tp.*, trial_index, quantile_cont(value, 0.5) OVER (PARTITION BY step ORDER BY trial_index
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_median FROM tp JOIN ti USING (trial)),
f AS (SELECT *, trial_index >= 8 AND step >= 30 AND prior_median IS NOT NULL AND value < prior_median AS below_median
      FROM j)
SELECT trial, step, round(prior_median, 6) AS prior_median, below_median,
       min(CASE WHEN below_median THEN step END) OVER (PARTITION BY trial) AS pruned_at FROM f""")
def q_median_prune(spark, sf_dir):
    p = N.median_prune(trials(spark, sf_dir))
    return p.select(F.col("trial").cast("bigint"), "step", _r("prior_median"), "below_median", "pruned_at")


@register("best_trials", """
SELECT run_id, round(fitness, 6) AS fitness, rank FROM (
  SELECT run_id, fitness, row_number() OVER (ORDER BY fitness DESC, run_id) AS rank FROM (
    SELECT run_id, 0.5 * macro_f1 + 0.5 * class_recall - pow(greatest(0.0, 0.35 - class_recall), 2) * 4.0 AS fitness
    FROM ledger WHERE status = 'FINISHED' AND macro_f1 IS NOT NULL))
WHERE rank <= 5""")
def q_best_trials(spark, sf_dir):
    lg = ledger(spark, sf_dir).where((F.col("status") == "FINISHED") & F.col("macro_f1").isNotNull())
    t = lg.select("run_id", N.fitness_penalised(F.col("macro_f1"), F.col("class_recall")).alias("fitness"))
    return N.best_trials(t, "fitness", 5, trial="run_id").select("run_id", _r("fitness"), "rank")


PUB_SQL = f"""{LR},
br AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY macro_f1 DESC, run_id) AS rn
       FROM ledger WHERE macro_f1 IS NOT NULL) WHERE rn = 1),
qg AS (SELECT experiment, avg(macro_f1) > 0.3 AND avg(class_recall) > 0.35 AS gates_passed FROM lr GROUP BY 1),
reg AS (SELECT 'severity' AS name, row_number() OVER (ORDER BY start_time, run_id) AS version,
        CAST(run_id AS VARCHAR) AS run_id, experiment, start_time AS published_at
        FROM br JOIN qg USING (experiment) WHERE gates_passed),
regv AS (SELECT *, CASE WHEN version = max(version) OVER (PARTITION BY name) THEN 'champion' END AS alias FROM reg)"""


def registry(spark, sf_dir):
    lg = ledger(spark, sf_dir)
    best = RG.best_run(lg, "macro_f1")
    gates = M.quality_gates(latest(spark, sf_dir), recall_gate=0.35)  # stand-in recalls sit near 0.4
    cands = best.join(gates.select("experiment", "gates_passed"), "experiment")
    return RG.publish_champion(cands, "severity", order="start_time")


@register("publish_champion", f"WITH {PUB_SQL} SELECT name, version, run_id, experiment, alias, published_at FROM regv")
def q_publish_champion(spark, sf_dir):
    return registry(spark, sf_dir)


@register("resolve_champion", f"""WITH {PUB_SQL}
SELECT name, version, run_id, experiment, alias, published_at FROM regv
WHERE name = 'severity' AND alias = 'champion' ORDER BY version DESC LIMIT 1""")
def q_resolve_champion(spark, sf_dir):
    return RG.resolve_champion(registry(spark, sf_dir), "severity")
