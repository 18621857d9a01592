"""Catalog entries for splitting and sampling (E1-E6, D14) on ``records``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.config import SEVERITY_CODES
from strataflow.functions import columns as B
from strataflow.operators import profile as D
from strataflow.operators import sampling as E
from strataflow.plans.catalog import register
from strataflow.sources.tables import tables

LABEL_SQL = ("CAST(CASE severity WHEN 'Property Damage Only' THEN 0 WHEN 'Injury' THEN 1 "
             "WHEN 'Fatal' THEN 2 END AS INTEGER)")


def _alloc_sql(src: str, n: str, share: str, out: str, carry: str = "") -> str:
    carry_sel = f", {carry}" if carry else ""
    return f"""(SELECT label, {n}{carry_sel}, base + CAST(row_number() OVER (ORDER BY rem DESC, label)
        <= k - sum(base) OVER () AS BIGINT) AS {out}
   FROM (SELECT label, {n}{carry_sel}, k, (k * {n}) // nn AS base, (k * {n}) % nn AS rem
         FROM (SELECT label, {n}{carry_sel}, CAST(ceil({share} * sum({n}) OVER ()) AS BIGINT) AS k,
                      sum({n}) OVER () AS nn FROM {src})))"""


# Split of the records view: (row_id, label, split) - shared by later oracles.
SPLIT_CTES = f"""
lab AS (SELECT row_id, {LABEL_SQL} AS label FROM records),
cnt AS (SELECT label, count(*) AS n FROM lab GROUP BY 1),
q1 AS {_alloc_sql('cnt', 'n', '0.2', 'n_test')},
r1 AS (SELECT label, n - n_test AS n_rest, n_test FROM q1),
q2 AS {_alloc_sql('r1', 'n_rest', '0.25', 'n_val', 'n_test')},
rk AS (SELECT lab.*, row_number() OVER (PARTITION BY label ORDER BY md5('split|' || row_id || '|42'), row_id) AS rnk FROM lab),
splits AS (SELECT row_id, label, CASE WHEN rnk <= n_test THEN 'test' WHEN rnk <= n_test + n_val THEN 'val'
                  ELSE 'train' END AS split FROM rk JOIN q2 USING (label))"""


def labelled(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    return B.encode_label(r, "severity", SEVERITY_CODES)


def split_records(spark, sf_dir):
    """The split records: a projection of the scan, so nothing is kept between queries."""
    return E.stratified_split(labelled(spark, sf_dir), "label", "row_id", 0.2, 0.2, seed=42)


@register("stratified_split", f"WITH {SPLIT_CTES}\nSELECT row_id, label, split FROM splits")
def q_stratified_split(spark, sf_dir):
    return split_records(spark, sf_dir).select("row_id", "label", "split")


@register("class_coverage", f"""WITH {SPLIT_CTES}
SELECT split, label, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share,
       round(sum(n) OVER (PARTITION BY split) / n, 2) AS one_in
FROM (SELECT split, label, count(*) AS n FROM splits GROUP BY 1, 2)""")
def q_class_coverage(spark, sf_dir):
    return D.class_coverage(split_records(spark, sf_dir))


@register("k_fold", f"""
SELECT label, CAST((rnk - 1) % 5 AS INTEGER) AS fold, count(*) AS n FROM (
  SELECT {LABEL_SQL} AS label, row_number() OVER (PARTITION BY severity ORDER BY md5('fold|' || row_id || '|7'), row_id) AS rnk
  FROM records) GROUP BY 1, 2""")
def q_k_fold(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("label", "row_id")  # folds need no other column: ranking writes all it is given
    f = E.k_fold(rows, "label", "row_id", k=5, seed=7)
    return f.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("hash_sample", """
SELECT row_id, severity FROM records ORDER BY md5('sample|' || row_id || '|42'), row_id LIMIT 5000""")
def q_hash_sample(spark, sf_dir):
    return E.hash_sample(tables(spark, sf_dir).records().select("row_id", "severity"), 5000, "row_id", 42)


@register("balanced_resample", f"""
WITH x AS (SELECT row_id, {LABEL_SQL} AS label FROM records),
cw AS (SELECT label, CAST((SELECT count(*) FROM x) AS DOUBLE) / (3 * count(*)) AS w FROM x GROUP BY 1),
j AS (SELECT x.row_id, x.label, cw.w FROM x JOIN cw USING (label)),
e AS (SELECT row_id, label, (SELECT count(*) FROM x) * w / (SELECT sum(w) FROM j) AS e FROM j),
c AS (SELECT row_id, label, CAST(floor(e) AS BIGINT) + CAST(
        CAST(CAST('0x' || substr(md5('copies|' || row_id || '|42'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < e - floor(e)
        AS BIGINT) AS copies FROM e)
SELECT label, count(*) AS n_rows, count(DISTINCT row_id) AS n_distinct, max(copies) AS max_copies
FROM c, range(1, copies + 1) GROUP BY 1""")
def q_balanced_resample(spark, sf_dir):
    from strataflow.operators.imbalance import class_weights
    x = labelled(spark, sf_dir).select("row_id", "label")
    w = class_weights(x, "label", n_classes=3)
    xw = x.join(F.broadcast(w.select("label", "weight")), "label")  # one row per class
    rs = E.balanced_resample(xw, F.col("weight"), None, "row_id", seed=42)
    return rs.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_distinct"),
                                   F.max("copy").cast("bigint").alias("max_copies"))


@register("ordered_holdout", """
SELECT holdout, count(*) AS n, round(min(x1), 6) AS min_x1, round(max(x1), 6) AS max_x1 FROM (
  SELECT x1, row_number() OVER (ORDER BY x1, row_id) > floor(0.9 * count(*) OVER ()) AS holdout FROM records)
GROUP BY 1""")
def q_ordered_holdout(spark, sf_dir):
    r = tables(spark, sf_dir).records().select("row_id", "x1")
    h = E.ordered_holdout(r, ["x1", "row_id"], 0.9)
    return h.groupBy("holdout").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("x1"), 6).alias("min_x1"),
                                    F.round(F.max("x1"), 6).alias("max_x1"))


@register("stack_splits", f"""WITH {SPLIT_CTES}
SELECT split, count(*) AS n, CAST(sum(CAST(x2 AS DECIMAL(18, 2))) AS DOUBLE) AS sum_x2
FROM splits JOIN records USING (row_id) GROUP BY 1""")
def q_stack_splits(spark, sf_dir):
    s = split_records(spark, sf_dir)
    parts = {k: s.where(F.col("split") == k).drop("split") for k in ("train", "val", "test")}
    st = E.stack_splits(parts)
    return st.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.col("x2").cast("decimal(18,2)")).cast("double").alias("sum_x2"))
