"""Catalog entries for latent audits and reconstruction checks.

Posterior and reconstruction stand-ins are deterministic functions of the
``latent`` view: mu = z, log_var = ln(0.05 + z^2), x_hat = 0.9 z + 0.05.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.operators import audit as AU
from strataflow.operators import drift as DR
from strataflow.plans.catalog import register
from strataflow.sources.tables import tables

POST = """post AS (SELECT row_id, label, CAST(z AS DOUBLE[]) AS mu,
                 list_transform(CAST(z AS DOUBLE[]), lambda v: ln(0.05 + v * v)) AS log_var,
                 list_transform(CAST(z AS DOUBLE[]), lambda v: 0.9 * v + 0.05) AS x_hat FROM latent),
pt AS (SELECT row_id, label, generate_subscripts(mu, 1) - 1 AS dim, unnest(mu) AS mu, unnest(log_var) AS lv,
              unnest(x_hat) AS xh FROM post)"""


def post(spark, sf_dir):
    lat = tables(spark, sf_dir).latent()
    z = F.col("z").cast("array<double>")
    return lat.select("row_id", "label", z.alias("mu"),
                      F.transform(z, lambda v: F.log(0.05 + v * v)).alias("log_var"),
                      F.transform(z, lambda v: 0.9 * v + 0.05).alias("x_hat"))


@register("posterior_variance", f"""WITH {POST},
v AS (SELECT label, dim, avg(exp(lv)) AS var FROM pt GROUP BY 1, 2)
SELECT label, count(*) AS n_dims, round(avg(var), 6) AS mean_var, count(*) FILTER (WHERE var < 0.5) AS n_active,
       count(*) FILTER (WHERE var > 0.9) AS n_collapsed FROM v GROUP BY 1""")
def q_posterior_variance(spark, sf_dir):
    return AU.posterior_variance(post(spark, sf_dir))


@register("kl_by_class", f"""WITH {POST},
s AS (SELECT row_id, label, sum(-0.5 * (1 + lv - mu * mu - exp(lv))) AS kl FROM pt GROUP BY 1, 2)
SELECT label, count(*) AS n, round(avg(kl), 6) AS mean_kl FROM s GROUP BY 1""")
def q_kl_by_class(spark, sf_dir):
    return AU.kl_by_class(post(spark, sf_dir))


@register("kl_report", f"""WITH {POST}
SELECT CAST(dim AS INTEGER) AS dim, round(avg(-0.5 * (1 + lv - mu * mu - exp(lv))), 6) AS mean_kl,
       avg(-0.5 * (1 + lv - mu * mu - exp(lv))) < 0.01 AS inactive FROM pt GROUP BY 1""")
def q_kl_report(spark, sf_dir):
    return AU.kl_by_dim(post(spark, sf_dir))


@register("elbo_terms", f"""WITH {POST},
s AS (SELECT row_id, avg((mu - xh) * (mu - xh)) AS mse, sum(-0.5 * (1 + lv - mu * mu - exp(lv))) AS kl
      FROM pt GROUP BY 1)
SELECT count(*) AS n, round(avg(mse), 6) AS recon_mse, round(avg(kl), 6) AS kl,
       round(avg(mse) + 0.15 * avg(kl), 6) AS loss FROM s""")
def q_elbo_terms(spark, sf_dir):
    return AU.elbo_terms(post(spark, sf_dir), "mu", "x_hat", "mu", "log_var", beta=0.15)


CENT = """ct AS (SELECT label, dim, avg(mu) AS m FROM pt GROUP BY 1, 2),
cw AS (SELECT dim, max(m) FILTER (WHERE label = 2) AS c2, max(m) FILTER (WHERE label = 1) AS c1,
              max(m) FILTER (WHERE label = 0) AS c0 FROM ct GROUP BY 1),
cd AS (SELECT sqrt(sum(pow(c2 - c1, 2))) AS da, sqrt(sum(pow(c2 - c0, 2))) AS db FROM cw)"""


@register("centroid_distance", f"""WITH {POST}, {CENT}
SELECT round(da, 6) AS dist_ref_a, round(db, 6) AS dist_ref_b, round(da / db, 6) AS ratio FROM cd""")
def q_centroid_distance(spark, sf_dir):
    return AU.centroid_distance(post(spark, sf_dir), "mu", F.col("label").cast("string"), "2", "1", "0")


SEP = """sp AS (SELECT dim, avg(mu) FILTER (WHERE label = 2) AS mp, stddev_samp(mu) FILTER (WHERE label = 2) AS sdp,
              avg(mu) FILTER (WHERE label = 0) AS mn FROM pt GROUP BY 1),
sep AS (SELECT CAST(dim AS INTEGER) AS dim, round(mp - mn, 6) AS mean_diff,
               round(abs(mp - mn) / greatest(coalesce(sdp, 0.0), 1e-6), 6) AS separation FROM sp)"""


@register("class_separation", f"""WITH {POST}, {SEP}
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY separation DESC, dim) AS rank FROM sep) WHERE rank <= 10""")
def q_class_separation(spark, sf_dir):
    return AU.class_separation(post(spark, sf_dir), "mu", F.col("label").cast("string"), "2", "0", k=10)


BOX = """bx AS (SELECT dim, avg(mu) - 2 * stddev_samp(mu) AS lo, avg(mu) + 2 * stddev_samp(mu) AS hi
       FROM pt WHERE label = 2 GROUP BY 1),
ins AS (SELECT row_id, bool_and(mu >= lo AND mu <= hi) AS inside FROM pt JOIN bx USING (dim) WHERE label = 0
        GROUP BY 1),
ov AS (SELECT count(*) AS n_neg, round(avg(CAST(inside AS DOUBLE)), 6) AS overlap FROM ins)"""


@register("box_overlap", f"WITH {POST}, {BOX} SELECT * FROM ov")
def q_box_overlap(spark, sf_dir):
    return AU.box_overlap(post(spark, sf_dir), "mu", F.col("label").cast("string"), "2", "0")


@register("grade_audit", f"""WITH {POST}, {CENT}, {SEP}, {BOX},
act AS (SELECT count(*) FILTER (WHERE var < 0.5) AS n FROM (SELECT dim, avg(exp(lv)) AS var FROM pt WHERE label = 2
        GROUP BY 1)),
mt AS (SELECT 'active_dims' AS metric, CAST((SELECT n FROM act) AS DOUBLE) AS value, CAST(3.0 AS DOUBLE) AS good,
              CAST(1.0 AS DOUBLE) AS ok,
              true AS higher_is_better
       UNION ALL SELECT 'centroid_ratio', (SELECT round(da / db, 6) FROM cd), 0.5, 1.0, false
       UNION ALL SELECT 'separated_dims', CAST((SELECT count(*) FROM sep WHERE separation > 1) AS DOUBLE), 3.0, 1.0, true
       UNION ALL SELECT 'box_overlap', (SELECT overlap FROM ov), 0.1, 0.3, false),
g AS (SELECT *, CASE WHEN CASE WHEN higher_is_better THEN value >= good ELSE value <= good END THEN 'healthy'
                     WHEN CASE WHEN higher_is_better THEN value >= ok ELSE value <= ok END THEN 'borderline'
                     ELSE 'problem' END AS grade FROM mt)
SELECT *, CASE max(CASE grade WHEN 'problem' THEN 2 WHEN 'borderline' THEN 1 ELSE 0 END) OVER ()
            WHEN 2 THEN 'problem' WHEN 1 THEN 'borderline' ELSE 'healthy' END AS verdict FROM g""")
def q_grade_audit(spark, sf_dir):
    return AU.grade_audit(_metrics(post(spark, sf_dir)))


def _metrics(p):
    g = F.col("label").cast("string")
    act = AU.posterior_variance(p.where(F.col("label") == 2)).select(
        F.lit("active_dims").alias("metric"), F.col("n_active").cast("double").alias("value"),
        F.lit(3.0).alias("good"), F.lit(1.0).alias("ok"), F.lit(True).alias("higher_is_better"))
    cr = AU.centroid_distance(p, "mu", g, "2", "1", "0").select(
        F.lit("centroid_ratio"), F.col("ratio"), F.lit(0.5), F.lit(1.0), F.lit(False))
    sp = AU.class_separation(p, "mu", g, "2", "0").agg(
        F.count(F.when(F.col("separation") > 1, 1)).cast("double").alias("v")).select(
        F.lit("separated_dims"), F.col("v"), F.lit(3.0), F.lit(1.0), F.lit(True))
    ov = AU.box_overlap(p, "mu", g, "2", "0").select(
        F.lit("box_overlap"), F.col("overlap"), F.lit(0.1), F.lit(0.3), F.lit(False))
    return act.union(cr).union(sp).union(ov)


# all six metrics of the audit; class 1 stands in for the synthetic rows, as in centroid_ratio
@register("grade_audit_full", f"""WITH {POST}, {CENT}, {SEP}, {BOX},
act AS (SELECT count(*) FILTER (WHERE var < 0.5) AS n FROM (SELECT dim, avg(exp(lv)) AS var FROM pt WHERE label = 2
        GROUP BY 1)),
kls AS (SELECT row_id, label, sum(-0.5 * (1 + lv - mu * mu - exp(lv))) AS kl FROM pt GROUP BY 1, 2),
klm AS (SELECT avg(kl) FILTER (WHERE label = 2) > avg(kl) FILTER (WHERE label = 0) AS above FROM kls),
kn AS (SELECT dim, count(*) FILTER (WHERE label = 2) AS n2, count(*) FILTER (WHERE label = 1) AS n1 FROM pt GROUP BY 1),
kv AS (SELECT dim, mu, count(*) FILTER (WHERE label = 2) AS c2, count(*) FILTER (WHERE label = 1) AS c1
       FROM pt WHERE label IN (1, 2) GROUP BY 1, 2),
kc AS (SELECT dim, sum(c2) OVER w AS c2, sum(c1) OVER w AS c1 FROM kv WINDOW w AS (PARTITION BY dim ORDER BY mu)),
ks AS (SELECT dim, round(max(abs(c2 / n2 - c1 / n1)), 6) AS d FROM kc JOIN kn USING (dim) GROUP BY 1),
mt AS (SELECT 'active_dims' AS metric, CAST((SELECT n FROM act) AS DOUBLE) AS value, CAST(3.0 AS DOUBLE) AS good,
              CAST(1.0 AS DOUBLE) AS ok,
              true AS higher_is_better
       UNION ALL SELECT 'centroid_ratio', (SELECT round(da / db, 6) FROM cd), 0.5, 1.0, false
       UNION ALL SELECT 'separated_dims', CAST((SELECT count(*) FROM sep WHERE separation > 1) AS DOUBLE), 3.0, 1.0, true
       UNION ALL SELECT 'box_overlap', (SELECT overlap FROM ov), 0.1, 0.3, false
       UNION ALL SELECT 'minority_kl_above', (SELECT CAST(above AS DOUBLE) FROM klm), 1.0, 0.0, true
       UNION ALL SELECT 'ks_aligned_share', (SELECT round(count(*) FILTER (WHERE d < 0.1) / count(*), 6) FROM ks), 0.5, 0.25, true),
g AS (SELECT *, CASE WHEN CASE WHEN higher_is_better THEN value >= good ELSE value <= good END THEN 'healthy'
                     WHEN CASE WHEN higher_is_better THEN value >= ok ELSE value <= ok END THEN 'borderline'
                     ELSE 'problem' END AS grade FROM mt)
SELECT *, CASE max(CASE grade WHEN 'problem' THEN 2 WHEN 'borderline' THEN 1 ELSE 0 END) OVER ()
            WHEN 2 THEN 'problem' WHEN 1 THEN 'borderline' ELSE 'healthy' END AS verdict FROM g""")
def q_grade_audit_full(spark, sf_dir):
    p = post(spark, sf_dir)
    term = AU.asum(AU.kl_terms(F.col("mu"), F.col("log_var")))
    kl = p.agg(F.avg(F.when(F.col("label") == 2, term)).alias("a"), F.avg(F.when(F.col("label") == 0, term)).alias("b")).select(
        F.lit("minority_kl_above"), (F.col("a") > F.col("b")).cast("double"), F.lit(1.0), F.lit(0.0), F.lit(True))
    d = DR.ks_two_sample(*[DR.array_tall(p.where(F.col("label") == i), "mu") for i in (2, 1)])
    ks = d.agg(F.round(F.avg((F.col("statistic") < 0.1).cast("double")), 6).alias("v")).select(
        F.lit("ks_aligned_share"), F.col("v"), F.lit(0.5), F.lit(0.25), F.lit(True))
    return AU.grade_audit(_metrics(p).union(kl).union(ks))


@register("reconstruction_error", f"""WITH {POST},
s AS (SELECT row_id, label, avg((mu - xh) * (mu - xh)) AS mse FROM pt GROUP BY 1, 2)
SELECT label, count(*) AS n, round(avg(mse), 6) AS mean_mse, round(quantile_cont(mse, 0.5), 6) AS median_mse,
       round(quantile_cont(mse, 0.95), 6) AS p95_mse, round(sqrt(avg(mse)), 6) AS rmse FROM s GROUP BY 1""")
def q_reconstruction_error(spark, sf_dir):
    return AU.reconstruction_error(post(spark, sf_dir), "mu", "x_hat")


@register("feature_error", f"""WITH {POST}
SELECT *, row_number() OVER (ORDER BY mse DESC, dim) AS rank FROM (
  SELECT CAST(dim AS INTEGER) AS dim, round(avg((mu - xh) * (mu - xh)), 6) AS mse FROM pt GROUP BY 1)""")
def q_feature_error(spark, sf_dir):
    return AU.feature_error(post(spark, sf_dir), "mu", "x_hat")


@register("recon_moments", f"""WITH {POST}
SELECT CAST(dim AS INTEGER) AS dim, round(avg(mu), 6) AS mean_real, round(avg(xh), 6) AS mean_recon,
       round(stddev_samp(mu), 6) AS std_real, round(stddev_samp(xh), 6) AS std_recon,
       round(avg(xh) - avg(mu), 6) AS delta_mean, round(stddev_samp(xh) - stddev_samp(mu), 6) AS delta_std
FROM pt GROUP BY 1""")
def q_recon_moments(spark, sf_dir):
    return AU.recon_moments(post(spark, sf_dir), "mu", "x_hat")


@register("mape_report", f"""WITH {POST}
SELECT CAST(dim AS INTEGER) AS dim, round(avg(abs(mu - xh) / abs(mu)) FILTER (WHERE abs(mu) > 0.01) * 100, 4)
         AS mape_pct, round(avg(CAST(abs(mu) > 0.01 AS DOUBLE)), 6) AS share_used,
       avg(CAST(abs(mu) > 0.01 AS DOUBLE)) >= 0.1 AS reliable FROM pt GROUP BY 1""")
def q_mape_report(spark, sf_dir):
    return AU.mape_report(post(spark, sf_dir), "mu", "x_hat")


def _lfc_sql() -> str:
    feats = {"x_a": "zd[9] + zd[10]", "x_b": "2 * zd[1]", "x_c": "CAST(label AS DOUBLE)", "x_d": "1.0"}
    parts = []
    for i in range(8):
        for f, e in feats.items():
            parts.append(f"SELECT 'z{i}' AS latent, '{f}' AS feature, coalesce(corr(zd[{i + 1}], {e}), 0.0) AS corr "
                         f"FROM (SELECT label, CAST(z AS DOUBLE[]) AS zd FROM latent)")
    u = "\nUNION ALL ".join(parts)
    return f"""WITH c AS (SELECT latent, feature, CASE WHEN isnan(corr) THEN 0.0 ELSE corr END AS corr FROM ({u})),
r AS (SELECT *, row_number() OVER (PARTITION BY latent ORDER BY abs(corr) DESC, feature) AS rank FROM c)
SELECT latent, feature, round(corr, 6) AS corr, rank FROM r WHERE abs(corr) > 0.2"""


@register("latent_feature_corr", _lfc_sql())
def q_latent_feature_corr(spark, sf_dir):
    lat = tables(spark, sf_dir).latent()
    z = F.col("z").cast("array<double>")
    df = lat.select(z.alias("zd"), (z[8] + z[9]).alias("x_a"), (2 * z[0]).alias("x_b"),
                    F.col("label").cast("double").alias("x_c"), F.lit(1.0).alias("x_d"))
    return AU.latent_feature_corr(df, [F.col("zd")[i] for i in range(8)], ["x_a", "x_b", "x_c", "x_d"])


@register("latent_feature_corr_full", """
WITH t AS (SELECT generate_subscripts(zd, 1) - 1 AS d, unnest(zd) AS v, zd[9] + zd[10] AS x_a, 2 * zd[1] AS x_b,
                  CAST(label AS DOUBLE) AS x_c FROM (SELECT label, CAST(z AS DOUBLE[]) AS zd FROM latent)),
u AS (SELECT d, 'x_a' AS feature, corr(v, x_a) AS corr FROM t GROUP BY 1
      UNION ALL SELECT d, 'x_b', corr(v, x_b) FROM t GROUP BY 1
      UNION ALL SELECT d, 'x_c', corr(v, x_c) FROM t GROUP BY 1
      UNION ALL SELECT DISTINCT d, 'x_d', 0.0 FROM t),
c AS (SELECT 'z' || d AS latent, feature, CASE WHEN corr IS NULL OR isnan(corr) THEN 0.0 ELSE corr END AS corr FROM u),
r AS (SELECT *, row_number() OVER (PARTITION BY latent ORDER BY abs(corr) DESC, feature) AS rank FROM c)
SELECT latent, feature, round(corr, 6) AS corr, rank FROM r WHERE abs(corr) > 0.2""")
def q_latent_feature_corr_full(spark, sf_dir):
    lat = tables(spark, sf_dir).latent()
    dims = lat.agg(F.max(F.size("z"))).first()[0] or 0
    z = F.col("z").cast("array<double>")
    df = lat.select(z.alias("zd"), (z[8] + z[9]).alias("x_a"), (2 * z[0]).alias("x_b"),
                    F.col("label").cast("double").alias("x_c"), F.lit(1.0).alias("x_d"))
    return AU.latent_feature_corr(df, [F.get("zd", F.lit(i)) for i in range(dims)], ["x_a", "x_b", "x_c", "x_d"])
