"""Catalog entries for projection, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.config import WEEKDAY_NAMES, SEVERITY_CODES
from strataflow.functions import columns as B
from strataflow.plans.catalog import register
from strataflow.sources.tables import tables


def R(col, name=None, nd=6):
    return F.round(F.col(col), nd).alias(name or col)


@register("select_present", "SELECT hour, weekday, severity FROM records")
def q_select_present(spark, sf_dir):
    return B.select_present(tables(spark, sf_dir).records(), ["hour", "weekday", "no_such_column", "severity"])


@register("sentinel_to_null", """
SELECT row_id, CASE WHEN driver_age = 999 THEN NULL ELSE driver_age END AS driver_age,
       CASE WHEN hour = 99 THEN NULL ELSE hour END AS hour FROM records""")
def q_sentinel_to_null(spark, sf_dir):
    df = tables(spark, sf_dir).records().select("row_id", "driver_age", "hour")
    return B.sentinel_to_null(B.sentinel_to_null(df, ["driver_age"], 999), ["hour", "absent"], [99])


@register("interaction_flags", """
SELECT row_id, CAST(coalesce(n_vehicles = 1 AND speed_limit >= 45, false) AS INTEGER) AS solo_highspeed,
       CAST(coalesce(age < 25 OR age > 70, false) AND coalesce(speed_limit > 40, false) AS INTEGER)
         AS vulnerability_interaction
FROM (SELECT *, CASE WHEN driver_age = 999 THEN NULL ELSE driver_age END AS age FROM records)""")
def q_interaction_flags(spark, sf_dir):
    df = tables(spark, sf_dir).records().select("row_id", "n_vehicles", "speed_limit", "driver_age")
    df = B.sentinel_to_null(df, ["driver_age"], 999)
    out = B.interaction_flags(df, "n_vehicles", "speed_limit", "driver_age")
    return out.select("row_id", "solo_highspeed", "vulnerability_interaction")


@register("cyclical_encode", """
SELECT row_id, round(sin(2 * pi() * hour / 24), 6) AS hour_sin, round(cos(2 * pi() * hour / 24), 6) AS hour_cos,
       round(sin(2 * pi() * (month_no - 1) / 12), 6) AS month_no_sin,
       round(cos(2 * pi() * (month_no - 1) / 12), 6) AS month_no_cos FROM records""")
def q_cyclical_encode(spark, sf_dir):
    df = tables(spark, sf_dir).records().select("row_id", "hour", "month_no")
    df = B.cyclical_encode(df, "hour", 24)
    df = B.cyclical_encode(df, "month_no", 12, values=(F.col("month_no") - 1).cast("double"))
    return df.select("row_id", R("hour_sin"), R("hour_cos"), R("month_no_sin"), R("month_no_cos"))


@register("name_to_ordinal", """
SELECT row_id, CAST(CASE weekday WHEN 'Monday' THEN 0 WHEN 'Tuesday' THEN 1 WHEN 'Wednesday' THEN 2
       WHEN 'Thursday' THEN 3 WHEN 'Friday' THEN 4 WHEN 'Saturday' THEN 5 WHEN 'Sunday' THEN 6 END AS INTEGER)
       AS weekday_ord,
       CAST(CASE weather WHEN 'Monday' THEN 0 END AS INTEGER) AS unknown_ord FROM records""")
def q_name_to_ordinal(spark, sf_dir):
    df = tables(spark, sf_dir).records()
    return df.select("row_id", B.name_to_ordinal(F.col("weekday"), WEEKDAY_NAMES).alias("weekday_ord"),
                     B.name_to_ordinal(F.col("weather"), WEEKDAY_NAMES[:1]).alias("unknown_ord"))


@register("encode_label", """
SELECT row_id, CAST(CASE severity WHEN 'Property Damage Only' THEN 0 WHEN 'Injury' THEN 1 WHEN 'Fatal' THEN 2 END
       AS INTEGER) AS label FROM records""")
def q_encode_label(spark, sf_dir):
    df = tables(spark, sf_dir).records().select("row_id", "severity")
    return B.encode_label(df, "severity", SEVERITY_CODES).select("row_id", "label")


@register("drop_null_target", "SELECT row_id, weather FROM records WHERE weather IS NOT NULL")
def q_drop_null_target(spark, sf_dir):
    return B.drop_null_target(tables(spark, sf_dir).records().select("row_id", "weather"), "weather")


@register("coerce_columns", """
SELECT CAST(month(TRY_CAST(CAST(l_shipdate AS VARCHAR) AS TIMESTAMP)) AS INTEGER) AS ship_month,
       count(*) AS n, count(TRY_CAST(l_returnflag AS DOUBLE)) AS n_numeric_flag,
       round(sum(TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE)), 6) AS qty
FROM lineitem GROUP BY 1""")
def q_coerce_columns(spark, sf_dir):
    li = tables(spark, sf_dir).base("lineitem").select(
        F.col("l_shipdate").cast("string").alias("ship"), F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").cast("string").alias("qty"))
    df = B.coerce_columns(li, numeric=["flag", "qty"], timestamps=["ship"])
    return (df.groupBy(F.month("ship").alias("ship_month"))
              .agg(F.count(F.lit(1)).alias("n"), F.count("flag").alias("n_numeric_flag"),
                   F.round(F.sum("qty"), 6).alias("qty")))


_FLAG_SQL = """(SELECT CASE WHEN weather = 'R' THEN 'Yes' WHEN weather = 'A' THEN 'yes, noted' ELSE 'No' END AS f_wet,
        CASE WHEN surface = 'F' THEN 'YES' END AS f_final,
        CASE WHEN speed_limit >= 60 THEN 'Yes' ELSE 'no' END AS f_fast FROM records)"""


@register("flag_counts", f"""
SELECT flag, n FROM (
  SELECT 'f_wet' AS flag, CAST(sum(CAST(coalesce(contains(lower(f_wet), 'yes'), false) AS INTEGER)) AS BIGINT) AS n
  FROM {_FLAG_SQL}
  UNION ALL SELECT 'f_final', CAST(sum(CAST(coalesce(contains(lower(f_final), 'yes'), false) AS INTEGER)) AS BIGINT)
  FROM {_FLAG_SQL}
  UNION ALL SELECT 'f_fast', CAST(sum(CAST(coalesce(contains(lower(f_fast), 'yes'), false) AS INTEGER)) AS BIGINT)
  FROM {_FLAG_SQL})""")
def q_flag_counts(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    txt = r.select(
        F.when(F.col("weather") == "R", "Yes").when(F.col("weather") == "A", "yes, noted").otherwise("No")
        .alias("f_wet"),
        F.when(F.col("surface") == "F", "YES").alias("f_final"),
        F.when(F.col("speed_limit") >= 60, "Yes").otherwise("no").alias("f_fast"))
    return B.flag_counts(txt, {k: B.yes_flag(F.col(k)) for k in ("f_wet", "f_final", "f_fast")})


@register("bbox_filter", """
SELECT row_id, x2, x3 FROM records WHERE x2 BETWEEN 0.02 AND 0.06 AND x3 BETWEEN 0.01 AND 0.05""")
def q_bbox_filter(spark, sf_dir):
    r = tables(spark, sf_dir).records().select("row_id", "x2", "x3")
    return B.bbox_filter(r, {"x2": (0.02, 0.06), "x3": (0.01, 0.05)})


@register("clip_counts", "SELECT least(n_harmed, 40.0) AS value, count(*) AS n FROM records GROUP BY 1")
def q_clip_counts(spark, sf_dir):
    return B.clip_counts(tables(spark, sf_dir).records(), "n_harmed", 40.0)


_AGE_EDGES = [15, 25, 35, 45, 55, 65, 100]


@register("bucketize", """
SELECT CASE WHEN age > 15 AND age <= 25 THEN '(15, 25]' WHEN age > 25 AND age <= 35 THEN '(25, 35]'
            WHEN age > 35 AND age <= 45 THEN '(35, 45]' WHEN age > 45 AND age <= 55 THEN '(45, 55]'
            WHEN age > 55 AND age <= 65 THEN '(55, 65]' WHEN age > 65 AND age <= 100 THEN '(65, 100]' END AS age_band,
       count(*) AS n
FROM (SELECT CASE WHEN driver_age = 999 THEN NULL ELSE driver_age END AS age FROM records) GROUP BY 1""")
def q_bucketize(spark, sf_dir):
    r = B.sentinel_to_null(tables(spark, sf_dir).records().select("driver_age"), ["driver_age"], 999)
    return r.groupBy(B.bucket_label(F.col("driver_age"), _AGE_EDGES).alias("age_band")).agg(
        F.count(F.lit(1)).alias("n"))


@register("drop_rate_gate", """
SELECT count(*) AS n_before, count(*) FILTER (WHERE weather IS NOT NULL) AS n_after,
       round(1 - count(*) FILTER (WHERE weather IS NOT NULL) / count(*), 6) AS drop_rate,
       1 - count(*) FILTER (WHERE weather IS NOT NULL) / count(*) <= 0.05 AS passed FROM records""")
def q_drop_rate_gate(spark, sf_dir):
    return B.drop_rate_gate(tables(spark, sf_dir).records(), F.col("weather").isNotNull(), 0.05)


@register("sample_complexity", """
SELECT count(*) AS n_train, CAST(16 * 128 + 128 + 128 * 64 + 64 + 65 AS BIGINT) AS n_params,
       round(count(*) / (16 * 128 + 128 + 128 * 64 + 64 + 65), 6) AS ratio,
       count(*) / (16 * 128 + 128 + 128 * 64 + 64 + 65) >= 3.0 AS passed FROM records""")
def q_sample_complexity(spark, sf_dir):
    return B.sample_complexity(tables(spark, sf_dir).records(), 16, 3.0)


@register("row_minmax", """
SELECT row_id, round((x1 - least(x1, x2, x3)) / (greatest(x1, x2, x3) - least(x1, x2, x3) + 1e-10), 6) AS x1_norm,
       round((x2 - least(x1, x2, x3)) / (greatest(x1, x2, x3) - least(x1, x2, x3) + 1e-10), 6) AS x2_norm,
       round((x3 - least(x1, x2, x3)) / (greatest(x1, x2, x3) - least(x1, x2, x3) + 1e-10), 6) AS x3_norm
FROM records""")
def q_row_minmax(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    return r.select("row_id", *B.row_minmax(["x1", "x2", "x3"])).select(
        "row_id", R("x1_norm"), R("x2_norm"), R("x3_norm"))
