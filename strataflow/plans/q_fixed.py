"""Catalog entries of scorers and rules whose parameters are given, so that SQL can follow them exactly
(I1, I2, K3 on the ``latent`` view, G4 on ``records``)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from strataflow.operators import latent as LT
from strataflow.operators import models as J
from strataflow.operators import selection as G
from strataflow.plans.catalog import register
from strataflow.sources.tables import tables

X = "x AS (SELECT row_id, CAST(z AS DOUBLE[]) AS zd FROM latent)"
HIDDEN, OUT = 8, 4


def _w(rows: int, cols: int, a: int, b: int) -> np.ndarray:
    """Weights that doubles hold exactly."""
    return np.array([[((i * a + j * b) % 9 - 4) / 8 for j in range(cols)] for i in range(rows)])


def _encoder(out: int) -> LT.Encoder:
    hidden = LT.Layer(_w(64, HIDDEN, 7, 13), (np.arange(HIDDEN) - 3) / 16, layer_norm=True, activation="relu")
    return LT.Encoder([hidden], LT.Layer(_w(HIDDEN, out, 5, 3), np.arange(out) / 8), LT.Layer(_w(HIDDEN, out, 4, 7), -np.arange(out) / 4))


def _layer_sql(name: str, layer: LT.Layer) -> str:
    rows = ", ".join(f"({j}, CAST({layer.weight[:, j].tolist()} AS DOUBLE[]), CAST({float(layer.bias[j])} AS DOUBLE))"
                     for j in range(layer.weight.shape[1]))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) AS t(j, w, b))"


def _forward_sql(out: int) -> str:
    e = _encoder(out)
    return f"""{X}, {_layer_sql("w1", e.hidden[0])}, {_layer_sql("wm", e.mu)}, {_layer_sql("wl", e.log_var)},
h AS (SELECT row_id, j, list_dot_product(zd, w) + b AS v FROM x, w1),
a AS (SELECT row_id, list(greatest((v - m) / sqrt(s + 1e-5), 0) ORDER BY j) AS a FROM (
        SELECT *, avg(v) OVER (PARTITION BY row_id) AS m, var_pop(v) OVER (PARTITION BY row_id) AS s FROM h) GROUP BY 1)"""


@register("encode_fixed", f"""WITH {_forward_sql(OUT)}
SELECT row_id, CAST(wm.j AS INTEGER) AS dim, round(list_dot_product(a, wm.w) + wm.b, 6) AS mu,
       round(list_dot_product(a, wl.w) + wl.b, 6) AS log_var FROM a, wm JOIN wl USING (j)""")
def q_encode_fixed(spark, sf_dir):
    coded = LT.encode_batch(tables(spark, sf_dir).latent().select("row_id", "z"), _encoder(OUT), "z")
    tall = coded.select("row_id", F.posexplode(F.arrays_zip("mu", "log_var")).alias("dim", "v"))
    return tall.select("row_id", F.col("dim").cast("int"), F.round("v.mu", 6).alias("mu"), F.round("v.log_var", 6).alias("log_var"))


@register("decode_fixed", f"""WITH {_forward_sql(12)}
SELECT row_id, CAST(wm.j AS INTEGER) AS feature, round(list_dot_product(a, wm.w) + wm.b, 6) AS x_hat FROM a, wm""")
def q_decode_fixed(spark, sf_dir):
    made = LT.decode_batch(tables(spark, sf_dir).latent().select("row_id", "z"), _encoder(12), "z")
    return made.select("row_id", F.posexplode("x_hat").alias("feature", "v")).select(
        "row_id", F.col("feature").cast("int"), F.round("v", 6).alias("x_hat"))


# class -> components (weight, mean, variance of every dimension); prior of each class
MIXTURES = {0: [(1.0, 0.0, 0.015625)], 1: [(1.0, 0.015625, 0.03125)], 2: [(0.25, -0.03125, 0.015625), (0.75, 0.03125, 0.03125)]}
PRIORS = {0: 0.75, 1: 0.1875, 2: 0.0625}
BOOST, RIDGE = 3.0, 1e-6


def _density_sql(weight: float, mean: float, variance: float) -> str:
    """Log of the weighted Gaussian density of ``zd``."""
    return (f"(ln({weight}) - 0.5 * (64 * ln(2 * pi()) + 64 * ln({variance} + {RIDGE}) + "
            f"list_sum(list_transform(zd, lambda v: (v - {mean}) * (v - {mean}))) / ({variance} + {RIDGE})))")


def _posterior_sql(c: int) -> str:
    parts = [_density_sql(*m) for m in MIXTURES[c]]
    top = f"greatest({', '.join(parts)})" if len(parts) > 1 else parts[0]
    total = " + ".join(f"exp({p} - {top})" for p in parts)
    return f"({top} + ln({total}) + ln({PRIORS[c]}){f' + ln({BOOST})' if c == 2 else ''})"


@register("predict_map_fixed", f"""WITH {X},
p AS (SELECT row_id, {", ".join(f"{_posterior_sql(c)} AS p{c}" for c in range(3))} FROM x),
e AS (SELECT row_id, p0, p1, p2, exp(p0 - greatest(p0, p1, p2)) AS e0, exp(p1 - greatest(p0, p1, p2)) AS e1,
             exp(p2 - greatest(p0, p1, p2)) AS e2 FROM p)
SELECT row_id, CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS INTEGER) AS prediction,
       {", ".join(f"round(e{c} / (e0 + e1 + e2), 6) AS prob{c}" for c in range(3))} FROM e""")
def q_predict_map_fixed(spark, sf_dir):
    params = {c: [(w, np.full(64, m), np.eye(64) * v) for w, m, v in own] for c, own in MIXTURES.items()}
    rule = J.GmmClassifier(params, {c: math.log(p) for c, p in PRIORS.items()}, RIDGE)
    scored = rule.predict(tables(spark, sf_dir).latent().select("row_id", F.col("z").alias("features")), boost=BOOST)
    return scored.select("row_id", "prediction", *[F.round(F.get("probs", F.lit(c)), 6).alias(f"prob{c}") for c in range(3)])


SELECTED = ["x1", "x2", "x3", "hour", "speed_limit", "n_vehicles", "n_harmed", "x1_twin", "x2_twin"]
LIMIT = 0.95


def _greedy_sql() -> str:
    """The strongest kept pair loses its second column, until none is above the limit."""
    pairs = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, abs(corr({SELECTED[i]}, {SELECTED[j]})) AS r FROM t"
                               for i in range(len(SELECTED)) for j in range(i + 1, len(SELECTED)))
    steps, last = [], f"k0 AS (SELECT {list(range(len(SELECTED)))} AS kept)"
    for n in range(1, len(SELECTED)):
        steps.append(last)
        last = (f"k{n} AS (SELECT list_filter(kept, lambda c: c IS DISTINCT FROM gone) AS kept FROM (SELECT kept, "
                f"(SELECT arg_max(j, [round(r, 9), -i, -j]) FROM p WHERE r > {LIMIT} AND list_contains(kept, i) "
                f"AND list_contains(kept, j)) AS gone FROM k{n - 1}))")
    return f"""WITH t AS (SELECT *, 2 * x1 + 1 AS x1_twin, 3 - x2 AS x2_twin FROM records), p AS ({pairs}),
{", ".join([*steps, last])}
SELECT CAST({SELECTED} AS VARCHAR[])[c + 1] AS feature, list_contains(kept, c) AS selected
FROM k{len(SELECTED) - 1}, range({len(SELECTED)}) AS r(c)"""


@register("select_correlation_mask", _greedy_sql())
def q_select_correlation_mask(spark, sf_dir):
    r = tables(spark, sf_dir).records().withColumn("x1_twin", 2 * F.col("x1") + 1).withColumn("x2_twin", 3 - F.col("x2"))
    return G.select_correlation(r, SELECTED, threshold=LIMIT).select("feature", "selected")
