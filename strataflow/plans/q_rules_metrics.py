"""Catalog entries for decision rules (K1, K2, K4) and metrics (L1-L13) on the
``predictions`` view (label 0/1/2, probabilities p0, p1, p2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions import rules as K
from strataflow.operators import imbalance as H
from strataflow.operators import metrics as L
from strataflow.plans.catalog import register
from strataflow.operators import sampling as E
from strataflow.plans.q_sampling import SPLIT_CTES
from strataflow.sources.tables import tables

TAU = 0.04
ARGMAX = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"
THRESH = f"CASE WHEN p2 >= {TAU} THEN 2 WHEN p0 >= p1 THEN 0 ELSE 1 END"
SCORED = f"sc AS (SELECT row_id, label, p0, p1, p2, {ARGMAX} AS prediction FROM predictions)"


def scored(spark, sf_dir, rule: str = "argmax"):
    p = tables(spark, sf_dir).predictions().withColumn("probs", K.probs_array("p0", "p1", "p2"))
    pred = K.predict_argmax(F.col("probs")) if rule == "argmax" else K.predict_threshold(F.col("probs"), TAU)
    return p.withColumn("prediction", pred)


def cm_sql(src: str, g: list[str] = ()) -> str:
    """Confusion matrix over labels 0..2 with zeros, per group."""
    gs = "".join(f"{x}, " for x in g)
    groups = f"(SELECT DISTINCT {', '.join(g)} FROM {src})" if g else "(SELECT 1 AS _one)"
    gsel = "".join(f"gr.{x}, " for x in g)
    on = " AND ".join([f"c.{x} = gr.{x}" for x in g] + ["c.label = l.label", "c.prediction = p.prediction"])
    return f"""(SELECT {gsel}l.label, p.prediction, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM {groups} gr CROSS JOIN (VALUES (0), (1), (2)) l(label) CROSS JOIN (VALUES (0), (1), (2)) p(prediction)
  LEFT JOIN (SELECT {gs}label, prediction, count(*) AS n FROM {src} GROUP BY ALL) c ON {on})"""


def pc_sql(cm: str, g: list[str] = ()) -> str:
    gs = "".join(f"{x}, " for x in g)
    using = ", ".join(list(g) + ["cls"])
    return f"""(SELECT {gs}cls AS label, CAST(tp AS BIGINT) AS tp, CAST(support AS BIGINT) AS support,
       CAST(predicted AS BIGINT) AS predicted,
       CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
       CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc
  FROM (SELECT {gs}label AS cls, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp, sum(n) AS support
        FROM {cm} GROUP BY ALL) d
  JOIN (SELECT {gs}prediction AS cls, sum(n) AS predicted FROM {cm} GROUP BY ALL) p USING ({using}))"""


def pcf_sql(cm: str, g: list[str] = ()) -> str:
    return f"""(SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f FROM {pc_sql(cm, g)})"""


def f1_sql(cm: str, g: list[str] = ()) -> str:
    gs = "".join(f"{x}, " for x in g)
    grp = f"GROUP BY {', '.join(g)}" if g else ""
    return f"""(SELECT {gs}round(coalesce(avg(f) FILTER (WHERE support > 0 OR predicted > 0), 0.0), 6) AS macro_f1,
       round(coalesce(sum(f * support) / sum(support), 0.0), 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS n
  FROM {pcf_sql(cm, g)} {grp})"""


@register("predict_argmax", f"SELECT row_id, {ARGMAX} AS prediction FROM predictions")
def q_predict_argmax(spark, sf_dir):
    return scored(spark, sf_dir).select("row_id", "prediction")


@register("predict_threshold", f"SELECT row_id, {THRESH} AS prediction FROM predictions")
def q_predict_threshold(spark, sf_dir):
    return scored(spark, sf_dir, "threshold").select("row_id", "prediction")


@register("softmax_rows", """
SELECT row_id, round(exp(l0 - m) / s, 6) AS q0, round(exp(l1 - m) / s, 6) AS q1, round(exp(l2 - m) / s, 6) AS q2
FROM (SELECT *, exp(l0 - m) + exp(l1 - m) + exp(l2 - m) AS s FROM (
  SELECT *, greatest(l0, l1, l2) AS m FROM (
    SELECT row_id, 2 * ln(p0) AS l0, 2 * ln(p1) AS l1, 2 * ln(p2) AS l2 FROM predictions)))""")
def q_softmax_rows(spark, sf_dir):
    p = tables(spark, sf_dir).predictions()
    logits = F.array(*[2 * F.log(F.col(x)) for x in ("p0", "p1", "p2")])
    q = K.softmax(logits)
    return p.select("row_id", *[F.round(q[i], 6).alias(f"q{i}") for i in range(3)])


@register("confusion_matrix", f"WITH {SCORED} SELECT * FROM {cm_sql('sc')}")
def q_confusion_matrix(spark, sf_dir):
    return L.confusion_matrix(scored(spark, sf_dir))


@register("per_class_matrix", f"""WITH {SCORED}
SELECT label, tp, support, predicted, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f, 6) AS f1
FROM {pcf_sql(cm_sql('sc'))}""")
def q_per_class_matrix(spark, sf_dir):
    return L.per_class(L.confusion_matrix(scored(spark, sf_dir))).drop("_f1")


@register("f1_scores", f"WITH {SCORED} SELECT * FROM {f1_sql(cm_sql('sc'))}")
def q_f1_scores(spark, sf_dir):
    return L.f1_scores(L.confusion_matrix(scored(spark, sf_dir)))


@register("class_recall", f"""
SELECT count(*) FILTER (WHERE label = 2) AS positives, count(*) FILTER (WHERE label = 2 AND ({THRESH}) = 2) AS hits,
       round(CASE WHEN count(*) FILTER (WHERE label = 2) > 0 THEN count(*) FILTER (WHERE label = 2 AND ({THRESH}) = 2)
             / count(*) FILTER (WHERE label = 2) ELSE 0.0 END, 6) AS recall FROM predictions""")
def q_class_recall(spark, sf_dir):
    return L.class_recall(scored(spark, sf_dir, "threshold"), 2)


_PT = "CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END"
_EPS = "2.220446049250313e-16"


@register("log_loss", f"""
SELECT round(avg(-ln(least(greatest({_PT}, {_EPS}), 1 - {_EPS}))), 6) AS log_loss, count(*) AS n FROM predictions""")
def q_log_loss(spark, sf_dir):
    return L.log_loss(scored(spark, sf_dir))


_ALPHA = """cw AS (SELECT label, (SELECT count(*) FROM predictions) / (3 * count(*)) AS a FROM predictions GROUP BY 1)"""


@register("focal_loss", f"""WITH {_ALPHA}
SELECT round(avg(-a * pow(1 - pt, 2.0) * ln(pt)), 6) AS focal_loss, count(*) AS n FROM (
  SELECT a, least(greatest({_PT}, {_EPS}), 1 - {_EPS}) AS pt FROM predictions JOIN cw USING (label))""")
def q_focal_loss(spark, sf_dir):
    s = scored(spark, sf_dir)
    return L.focal_loss(s, H.class_weights(s, "label", 3), gamma=2.0)


@register("focal_weights", f"""WITH {_ALPHA}
SELECT row_id, round(a * pow(1 - least(greatest({_PT}, {_EPS}), 1 - {_EPS}), 2.0), 6) AS focal_weight
FROM predictions JOIN cw USING (label)""")
def q_focal_weights(spark, sf_dir):
    s = scored(spark, sf_dir)
    w = L.focal_weights(s, H.class_weights(s, "label", 3), gamma=2.0)
    return w.select("row_id", F.round("focal_weight", 6).alias("focal_weight"))


_OVR = """s AS (SELECT 0 AS cls, p0 AS score, CAST(label = 0 AS INTEGER) AS pos FROM predictions
  UNION ALL SELECT 1, p1, CAST(label = 1 AS INTEGER) FROM predictions
  UNION ALL SELECT 2, p2, CAST(label = 2 AS INTEGER) FROM predictions),
d AS (SELECT cls, score, sum(pos) AS pos, sum(1 - pos) AS neg FROM s GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER w AS pc, sum(neg) OVER w AS nc, sum(pos) OVER (PARTITION BY cls) AS P,
             sum(neg) OVER (PARTITION BY cls) AS N FROM d
      WINDOW w AS (PARTITION BY cls ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@register("roc_curve", f"""WITH {_OVR}
SELECT cls, round(score, 6) AS threshold, CAST(pc AS BIGINT) AS tp, CAST(nc AS BIGINT) AS fp,
       round(CASE WHEN P > 0 THEN pc / P END, 6) AS tpr, round(CASE WHEN N > 0 THEN nc / N END, 6) AS fpr FROM c""")
def q_roc_curve(spark, sf_dir):
    return L.roc_curve(scored(spark, sf_dir))


AUC_SQL = f"""(WITH {_OVR}
SELECT cls, round(CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(neg * (pc - pos + pc)) / (2.0 * max(P) * max(N))
       ELSE 0.0 END, 6) AS auc FROM c GROUP BY 1)"""


@register("auc_ovr", f"SELECT * FROM {AUC_SQL}")
def q_auc_ovr(spark, sf_dir):
    return L.auc_ovr(scored(spark, sf_dir))


def scored_split(spark, sf_dir, rule="argmax"):
    # predictions hold the key and the label that the split goes by: no join
    return E.stratified_split(scored(spark, sf_dir, rule), "label", "row_id", 0.2, 0.2, seed=42)


SCORED_SPLIT = f"""{SPLIT_CTES},
ss AS (SELECT p.row_id, p.label, p0, p1, p2, {ARGMAX} AS prediction, s.split
       FROM predictions p JOIN splits s USING (row_id))"""


@register("generalisation_gap", f"""WITH {SCORED_SPLIT},
f AS {f1_sql(cm_sql('ss', ['split']), ['split'])}
SELECT max(macro_f1) FILTER (WHERE split = 'train') AS train_f1, max(macro_f1) FILTER (WHERE split = 'test') AS test_f1,
       round(max(macro_f1) FILTER (WHERE split = 'train') - max(macro_f1) FILTER (WHERE split = 'test'), 6) AS gap
FROM f""")
def q_generalisation_gap(spark, sf_dir):
    return L.generalisation_gap(L.confusion_matrix(scored_split(spark, sf_dir), by="split"))


_TAUS = L.thresholds()
_SCAN_SQL = f"""(WITH {SCORED_SPLIT},
t AS (SELECT CAST(round(0.15 + range * 0.01, 2) AS DOUBLE) AS tau FROM range(36)),
tp AS (SELECT ss.split, t.tau, ss.label, CASE WHEN p2 >= t.tau THEN 2 WHEN p0 >= p1 THEN 0 ELSE 1 END AS prediction
       FROM ss, t),
f AS {f1_sql(cm_sql('tp', ['split', 'tau']), ['split', 'tau'])},
r AS (SELECT split, tau, round(rc, 6) AS minority_recall FROM {pc_sql(cm_sql('tp', ['split', 'tau']), ['split', 'tau'])}
      WHERE label = 2)
SELECT split, round(tau, 2) AS tau, macro_f1, minority_recall, macro_f1 > 0.35 AS passes_f1,
       minority_recall >= 0.5 AS passes_recall FROM f JOIN r USING (split, tau))"""


@register("threshold_scan", f"SELECT * FROM {_SCAN_SQL}")
def q_threshold_scan(spark, sf_dir):
    s = scored_split(spark, sf_dir).withColumn("probs", K.probs_array("p0", "p1", "p2"))
    return L.threshold_scan(s, _TAUS, by="split")


@register("pick_threshold", f"""
SELECT tau, macro_f1, minority_recall, both_pass, gap_distance FROM (
  SELECT *, passes_f1 AND passes_recall AS both_pass,
         round(sqrt(pow(greatest(0.0, 0.5 - minority_recall), 2) + pow(greatest(0.0, 0.35 - macro_f1), 2)), 6)
           AS gap_distance,
         max(CAST(passes_f1 AND passes_recall AS INTEGER)) OVER () AS anyp
  FROM {_SCAN_SQL} WHERE split = 'val')
ORDER BY CAST(NOT both_pass AS INTEGER), CASE WHEN anyp = 1 THEN -macro_f1 ELSE gap_distance END, tau LIMIT 1""")
def q_pick_threshold(spark, sf_dir):
    return L.pick_threshold(q_threshold_scan(spark, sf_dir))


@register("compare_rules", f"""
WITH st AS (SELECT 'argmax' AS rule, label, {ARGMAX} AS prediction FROM predictions
            UNION ALL SELECT 'threshold', label, {THRESH} FROM predictions),
pc AS {pcf_sql(cm_sql('st', ['rule']), ['rule'])}
SELECT a.label, round(a.pr, 6) AS argmax_precision, round(a.rc, 6) AS argmax_recall, round(a.f, 6) AS argmax_f1,
       round(t.pr, 6) AS threshold_precision, round(t.rc, 6) AS threshold_recall, round(t.f, 6) AS threshold_f1,
       round(round(t.f, 6) - round(a.f, 6), 6) AS delta_f1, round(round(t.rc, 6) - round(a.rc, 6), 6) AS delta_recall
FROM pc a JOIN pc t ON a.label = t.label AND a.rule = 'argmax' AND t.rule = 'threshold'""")
def q_compare_rules(spark, sf_dir):
    s = scored(spark, sf_dir).select("label", "probs")
    return L.compare_rules(s, tau=TAU)


def two_models(spark, sf_dir):
    p = tables(spark, sf_dir).predictions()
    s = p.select("row_id", "label", F.col("p0").alias("a0"), F.col("p1").alias("a1"), F.col("p2").alias("a2"),
                 (F.col("p0") + 2 * F.col("p1") + 4 * F.col("p2")).alias("z"))
    a = s.select("label", F.lit("a").alias("model"), K.probs_array("a0", "a1", "a2").alias("probs"))
    b = s.select("label", F.lit("b").alias("model"),
                 F.array(F.col("a0") / F.col("z"), 2 * F.col("a1") / F.col("z"), 4 * F.col("a2") / F.col("z"))
                 .alias("probs"))
    both = a.unionByName(b)
    return both.withColumn("prediction", K.predict_argmax(F.col("probs")))


_TWO = """tm AS (SELECT 'a' AS model, label, p0 AS q0, p1 AS q1, p2 AS q2 FROM predictions
        UNION ALL SELECT 'b', label, p0 / (p0 + 2 * p1 + 4 * p2), 2 * p1 / (p0 + 2 * p1 + 4 * p2),
                         4 * p2 / (p0 + 2 * p1 + 4 * p2) FROM predictions),
tmp AS (SELECT *, CASE WHEN q0 >= q1 AND q0 >= q2 THEN 0 WHEN q1 >= q2 THEN 1 ELSE 2 END AS prediction FROM tm),
ovr AS (SELECT model, 0 AS cls, q0 AS score, CAST(label = 0 AS INTEGER) AS pos FROM tm
        UNION ALL SELECT model, 1, q1, CAST(label = 1 AS INTEGER) FROM tm
        UNION ALL SELECT model, 2, q2, CAST(label = 2 AS INTEGER) FROM tm),
od AS (SELECT model, cls, score, sum(pos) AS pos, sum(1 - pos) AS neg FROM ovr GROUP BY 1, 2, 3),
oc AS (SELECT *, sum(pos) OVER w AS pc, sum(pos) OVER (PARTITION BY model, cls) AS P,
              sum(neg) OVER (PARTITION BY model, cls) AS N FROM od
       WINDOW w AS (PARTITION BY model, cls ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
auc AS (SELECT model, cls AS label, round(CASE WHEN max(P) > 0 AND max(N) > 0
        THEN sum(neg * (pc - pos + pc)) / (2.0 * max(P) * max(N)) ELSE 0.0 END, 6) AS auc FROM oc GROUP BY 1, 2)"""


@register("compare_models", f"""WITH {_TWO},
pc AS (SELECT model, label, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f, 6) AS f1
       FROM {pcf_sql(cm_sql('tmp', ['model']), ['model'])}),
m AS (SELECT * FROM pc JOIN auc USING (model, label))
SELECT a.label,
""" + ",\n".join(
    f"a.{x} AS a_{x}, b.{x} AS b_{x}, round(b.{x} - a.{x}, 6) AS delta_{x}, "
    f"CASE WHEN b.{x} > a.{x} THEN 'b' WHEN a.{x} > b.{x} THEN 'a' ELSE 'tie' END AS winner_{x}"
    for x in ("precision", "recall", "f1", "auc")) + """
FROM m a JOIN m b ON a.label = b.label AND a.model = 'a' AND b.model = 'b'""")
def q_compare_models(spark, sf_dir):
    return L.compare_models(two_models(spark, sf_dir), "a", "b")
