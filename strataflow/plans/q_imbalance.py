"""Catalog entries for class imbalance and augmentation (H1-H6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.operators import imbalance as H
from strataflow.plans.catalog import register
from strataflow.plans.q_sampling import SPLIT_CTES, split_records
from strataflow.sources.tables import tables


@register("class_weights", f"""WITH {SPLIT_CTES},
tr AS (SELECT label FROM splits WHERE split = 'train'),
g AS (SELECT CAST(range AS INTEGER) AS label FROM range(4))
SELECT g.label, CAST(coalesce(n, 0) AS BIGINT) AS n,
       CASE WHEN coalesce(n, 0) > 0 THEN sum(coalesce(n, 0)) OVER () / (4 * n) ELSE 0.0 END AS weight
FROM g LEFT JOIN (SELECT label, count(*) AS n FROM tr GROUP BY 1) USING (label)""")
def q_class_weights(spark, sf_dir):
    tr = split_records(spark, sf_dir).where(F.col("split") == "train")
    return H.class_weights(tr, "label", n_classes=4)


@register("class_priors", f"""WITH {SPLIT_CTES},
g AS (SELECT CAST(range AS INTEGER) AS label FROM range(4)),
c AS (SELECT g.label, CAST(coalesce(n, 0) AS BIGINT) AS n FROM g
      LEFT JOIN (SELECT label, count(*) AS n FROM splits WHERE split = 'train' GROUP BY 1) USING (label))
SELECT label, n, round(n / sum(n) OVER (), 9) AS prior, round(ln(greatest(n / sum(n) OVER (), 1e-9)), 9) AS log_prior
FROM c""")
def q_class_priors(spark, sf_dir):
    tr = split_records(spark, sf_dir).where(F.col("split") == "train")
    return H.class_priors(tr, "label", n_classes=4)


@register("synthetic_count", f"""WITH {SPLIT_CTES}
SELECT count(*) AS n_total, count(*) FILTER (WHERE label = 2) AS n_minority,
       CAST(greatest(0, ceil((0.15 * count(*) - count(*) FILTER (WHERE label = 2)) / (1 - 0.15))) AS BIGINT)
         AS n_synthetic
FROM splits WHERE split = 'train'""")
def q_synthetic_count(spark, sf_dir):
    tr = split_records(spark, sf_dir).where(F.col("split") == "train")
    return H.synthetic_count(tr, "label", 2, 0.15)


@register("augment_report", """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 2) AS m FROM latent),
s AS (SELECT n, m, CAST(greatest(0, ceil((0.15 * n - m) / (1 - 0.15))) AS BIGINT) AS k FROM c)
SELECT n AS n_real, k AS n_synthetic, n + k AS n_after, round(m / n, 6) AS ratio_before,
       round((m + k) / (n + k), 6) AS ratio_after FROM s""")
def q_augment_report(spark, sf_dir):
    lat = tables(spark, sf_dir).latent()
    aug = H.augment_latent(lat, "label", "z", 2, 0.15, seed=42)
    return H.augment_report(aug, "label", 2)


@register("augment_minority")
def q_augment_minority(spark, sf_dir):
    lat = tables(spark, sf_dir).latent().withColumn("z", F.col("z").cast("array<double>"))
    return H.augment_minority(lat, "label", "z", 2, 0.15, seed=42)


@register("augment_latent")
def q_augment_latent(spark, sf_dir):
    return H.augment_latent(tables(spark, sf_dir).latent(), "label", "z", 2, 0.15, seed=42)
