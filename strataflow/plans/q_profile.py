"""Catalog entries for profiling (D1-D16) on the ``records`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions import columns as B
from strataflow.operators import profile as D
from strataflow.plans.catalog import register
from strataflow.sources.tables import tables


def recs(spark, sf_dir):
    """records with the age sentinel already recoded to null."""
    return B.sentinel_to_null(tables(spark, sf_dir).records(), ["driver_age"], 999)


AGE = "CASE WHEN driver_age = 999 THEN NULL ELSE driver_age END"
RECS = f"(SELECT * REPLACE ({AGE} AS driver_age) FROM records)"


def _union(template: str, cols: list[str]) -> str:
    return "\nUNION ALL ".join(template.format(col=x) for x in cols)


NULL_COLS = ["hour", "weekday", "driver_age", "weather", "speed_limit", "x1"]


@register("null_profile", "SELECT * FROM (" + _union(
    "SELECT '{col}' AS column_name, count(*) - count({col}) AS n_null, "
    "round((count(*) - count({col})) / count(*), 6) AS null_rate FROM " + RECS, NULL_COLS) + ") WHERE n_null > 0")
def q_null_profile(spark, sf_dir):
    return D.null_profile(recs(spark, sf_dir), NULL_COLS)


RECORD_COLS = ["row_id", "hour", "weekday", "year", "month_no", "speed_limit", "driver_age", "weather", "surface",
               "n_vehicles", "x1", "x2", "x3", "n_harmed", "severity"]


@register("null_profile_full", "SELECT * FROM (" + _union(
    "SELECT '{col}' AS column_name, count(*) - count({col}) AS n_null, "
    "round((count(*) - count({col})) / count(*), 6) AS null_rate FROM " + RECS, RECORD_COLS) + ") WHERE n_null > 0")
def q_null_profile_full(spark, sf_dir):
    return D.null_profile(recs(spark, sf_dir))


@register("value_counts", """
SELECT o.value, o.position, CAST(coalesce(v.n, 0) AS BIGINT) AS n,
       round(coalesce(v.n, 0) / (SELECT count(*) FROM records), 6) AS share
FROM (VALUES ('A', 0), ('N', 1), ('R', 2), ('Z', 3)) o(value, position)
LEFT JOIN (SELECT weather AS value, count(*) AS n FROM records GROUP BY 1) v USING (value)""")
def q_value_counts(spark, sf_dir):
    return D.value_counts(tables(spark, sf_dir).records(), "weather", order=["A", "N", "R", "Z"]).select(
        "value", F.col("position").cast("integer").alias("position"), "n", "share")


@register("value_counts_top", """
SELECT hour AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM records), 6) AS share
FROM records GROUP BY 1 ORDER BY n DESC, value LIMIT 5""")
def q_value_counts_top(spark, sf_dir):
    return D.value_counts(tables(spark, sf_dir).records(), "hour", top_k=5)


@register("crosstab_share", """
WITH c AS (SELECT weekday AS row_key, weather AS col_key, count(*) AS n FROM records GROUP BY 1, 2),
top AS (SELECT weekday AS row_key FROM records GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
SELECT row_key, col_key, n, round(n / sum(n) OVER (PARTITION BY row_key), 6) AS share
FROM c WHERE row_key IN (SELECT row_key FROM top)""")
def q_crosstab_share(spark, sf_dir):
    return D.crosstab_share(tables(spark, sf_dir).records(), "weekday", "weather", top_k=3)


DESC_COLS = ["hour", "x1", "x2", "x3", "n_harmed", "driver_age"]


@register("describe_exact", _union(
    "SELECT '{col}' AS feature, count({col}) AS count, "
    "round(CAST(sum(CAST({col} AS DECIMAL(25, 9))) AS DOUBLE) / count({col}), 6) AS mean, "
    "round(stddev_samp({col}), 6) AS std, CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, "
    "round(quantile_cont({col}, 0.25), 6) AS q25, round(quantile_cont({col}, 0.5), 6) AS q50, "
    "round(quantile_cont({col}, 0.75), 6) AS q75 FROM " + RECS, DESC_COLS))
def q_describe_exact(spark, sf_dir):
    d = D.describe_exact(recs(spark, sf_dir), DESC_COLS)
    return d.select("feature", "count", "min", "max", *[F.round(x, 6).alias(x) for x in ("mean", "std", "q25", "q50", "q75")])


@register("group_means", f"""
SELECT CASE WHEN driver_age > 15 AND driver_age <= 35 THEN '(15, 35]' WHEN driver_age > 35 AND driver_age <= 100
       THEN '(35, 100]' END AS key, count(*) AS n, round(CAST(sum(CAST(x1 AS DECIMAL(25, 9))) AS DOUBLE) / count(x1), 6) AS mean_x1,
       round(CAST(sum(CAST(x2 AS DECIMAL(25, 9))) AS DOUBLE) / count(x2), 6) AS mean_x2
FROM {RECS} GROUP BY 1""")
def q_group_means(spark, sf_dir):
    g = D.group_means(recs(spark, sf_dir), B.bucket_label(F.col("driver_age"), [15, 35, 100]), ["x1", "x2"])
    return g.select("key", "n", *[F.round(x, 6).alias(x) for x in ("mean_x1", "mean_x2")])


CORR_COLS = ["x1", "x2", "x3", "n_harmed", "driver_age"]


def _corr_sql(cols):
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM {RECS}")
    return "\nUNION ALL ".join(parts)


@register("corr_matrix", _corr_sql(CORR_COLS))
def q_corr_matrix(spark, sf_dir):
    return D.corr_matrix(recs(spark, sf_dir), CORR_COLS)


TC_COLS = ["x1", "x2", "x3", "hour", "speed_limit", "n_vehicles"]
FATAL = "CAST(severity = 'Fatal' AS INTEGER)"
TC_SQL = "SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM (" + _union(
    "SELECT '{col}' AS feature, corr({col}, " + FATAL + ") AS corr FROM records", TC_COLS) + ")"


@register("target_correlation", f"""
SELECT *, row_number() OVER (ORDER BY abs_corr DESC, feature) AS rank FROM ({TC_SQL})""")
def q_target_correlation(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    return D.target_correlation(r, TC_COLS, (F.col("severity") == "Fatal").cast("int"))


MI_NUM = ["x2", "x3", "n_vehicles", "hour"]
MI_CAT = ["weekday", "weather"]


def _bins_sql(num, cat, nb=10):
    t = _union("SELECT row_id, '{col}' AS feature, CAST({col} AS DOUBLE) AS value FROM records "
               "WHERE {col} IS NOT NULL", num)
    cats = _union("SELECT row_id, '{col}' AS feature, CAST({col} AS VARCHAR) AS bin FROM records "
                  "WHERE {col} IS NOT NULL", cat)
    cats = f"UNION ALL {cats}" if cat else ""
    return f"""(WITH t AS ({t}),
d AS (SELECT feature, value, count(*) AS cnt FROM t GROUP BY 1, 2),
b AS (SELECT feature, value, CAST(CAST(least({nb - 1}, floor((sum(cnt) OVER (PARTITION BY feature ORDER BY value
        ROWS UNBOUNDED PRECEDING) - cnt) * {nb} / sum(cnt) OVER (PARTITION BY feature))) AS BIGINT) AS VARCHAR) AS bin
      FROM d)
SELECT t.row_id, t.feature, b.bin FROM t JOIN b USING (feature, value)
{cats})"""


def _mi_sql(joint: str, group: str) -> str:
    return f"""(SELECT {group}, sum(n / t * ln(n * t / (na * nb))) AS mi FROM (
  SELECT {group}, n, sum(n) OVER (PARTITION BY {group}) AS t, sum(n) OVER (PARTITION BY {group}, a) AS na,
         sum(n) OVER (PARTITION BY {group}, b) AS nb FROM {joint}) GROUP BY {group})"""


MI_TARGET_SQL = _mi_sql(f"""(SELECT feature, bin AS a, severity AS b, count(*) AS n FROM {_bins_sql(MI_NUM, MI_CAT)}
  JOIN records USING (row_id) GROUP BY 1, 2, 3)""", "feature")


@register("mutual_info_target", f"""
SELECT feature, round(mi, 6) AS mi, row_number() OVER (ORDER BY round(mi, 6) DESC, feature) AS rank
FROM {MI_TARGET_SQL}""")
def q_mutual_info_target(spark, sf_dir):
    return D.mutual_info_target(tables(spark, sf_dir).records(), MI_NUM, MI_CAT, "severity", "row_id")


MI_MATRIX_SQL = f"""(WITH bins AS {_bins_sql(MI_NUM, MI_CAT)},
m AS {_mi_sql('''(SELECT x.feature AS feature_a, y.feature AS feature_b, x.bin AS a, y.bin AS b, count(*) AS n
     FROM bins x JOIN bins y ON x.row_id = y.row_id AND x.feature < y.feature GROUP BY 1, 2, 3, 4)''',
              "feature_a, feature_b")}
SELECT feature_a, feature_b, round(mi, 6) AS mi,
       round(CASE WHEN max(mi) OVER () > 0 THEN mi / max(mi) OVER () ELSE 0.0 END, 6) AS mi_scaled FROM m)"""


@register("mutual_info_matrix", f"SELECT * FROM {MI_MATRIX_SQL}")
def q_mutual_info_matrix(spark, sf_dir):
    return D.mutual_info_matrix(tables(spark, sf_dir).records(), MI_NUM, MI_CAT, "row_id")


@register("top_pairs", f"SELECT * FROM {MI_MATRIX_SQL} ORDER BY mi DESC, feature_a, feature_b LIMIT 5")
def q_top_pairs(spark, sf_dir):
    return D.top_pairs(q_mutual_info_matrix(spark, sf_dir), 5)


FR_NUM = ["x2", "x3", "n_vehicles", "hour"]
FR_CAT = ["weekday", "weather"]


def _fr_sql():
    num = _union("SELECT '{col}' AS feature, 'numeric' AS dtype, 1 - count({col}) / count(*) AS null_rate, "
                 "CASE WHEN avg({col}) <> 0 THEN least(1.0, stddev_samp({col}) / abs(avg({col}))) "
                 "ELSE least(1.0, stddev_samp({col})) END AS variance_score FROM records", FR_NUM)
    cat = _union("SELECT '{col}' AS feature, 'categorical' AS dtype, null_rate, "
                 "CASE WHEN r > 0.95 AND nn > 50 THEN 0.05 WHEN r < 0.01 THEN 0.05 ELSE least(1.0, r * 5) END "
                 "AS variance_score FROM (SELECT count({col}) AS nn, CASE WHEN count({col}) > 0 THEN "
                 "count(DISTINCT {col}) / count({col}) ELSE 0.0 END AS r, "
                 "1 - count({col}) / count(*) AS null_rate FROM records)", FR_CAT)
    return f"""
WITH s AS ({num} UNION ALL {cat}),
mi AS (SELECT feature, round(mi, 6) AS mi FROM {_mi_sql(f'''(SELECT feature, bin AS a, severity AS b, count(*) AS n
       FROM {_bins_sql(FR_NUM, FR_CAT)} JOIN records USING (row_id) GROUP BY 1, 2, 3)''', "feature")}),
j AS (SELECT s.feature, dtype, round(null_rate, 4) AS null_rate, round(1 - null_rate, 4) AS null_score,
             round(variance_score, 4) AS variance_score, mi.mi,
             round(CASE WHEN (SELECT max(mi) FROM mi) > 0 THEN coalesce(mi.mi, 0.0) / (SELECT max(mi) FROM mi)
                   ELSE 0.0 END, 4) AS mi_norm
      FROM s LEFT JOIN mi USING (feature))
SELECT *, round(0.10 * null_score + 0.15 * variance_score + 0.75 * mi_norm, 4) AS composite,
       row_number() OVER (ORDER BY round(0.10 * null_score + 0.15 * variance_score + 0.75 * mi_norm, 4) DESC,
       feature) AS rank
FROM j"""


@register("feature_ranking", _fr_sql())
def q_feature_ranking(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    mi = D.mutual_info_target(r, FR_NUM, FR_CAT, "severity", "row_id")
    return D.feature_ranking(r, FR_NUM, FR_CAT, mi)


GC_COLS = ["x1", "x2", "x3", "hour"]


_GC_MI = _mi_sql(f"""(SELECT feature, bin AS a, severity AS b, count(*) AS n FROM {_bins_sql(GC_COLS, [])}
  JOIN records USING (row_id) GROUP BY 1, 2, 3)""", "feature")
_GC_TC = "SELECT feature, round(corr, 6) AS corr FROM (" + _union(
    "SELECT '{col}' AS feature, corr({col}, " + FATAL + ") AS corr FROM records", GC_COLS) + ")"


@register("group_comparison", "SELECT g.*, c.corr, m.mi FROM (SELECT feature, round(tm, 6) AS target_mean, round(rm, 6) AS rest_mean, "
          "round(tmed, 6) AS target_median, round(rmed, 6) AS rest_median, round(tm - rm, 6) AS difference, "
          "round((tm - rm) / (rm + 1e-10) * 100, 4) AS pct_change FROM (" + _union(
              "SELECT '{col}' AS feature, avg({col}) FILTER (WHERE severity = 'Fatal') AS tm, "
              "avg({col}) FILTER (WHERE severity <> 'Fatal') AS rm, "
              "quantile_cont({col}, 0.5) FILTER (WHERE severity = 'Fatal') AS tmed, "
              "quantile_cont({col}, 0.5) FILTER (WHERE severity <> 'Fatal') AS rmed FROM records", GC_COLS) + f""")) AS g
JOIN ({_GC_TC}) AS c USING (feature) JOIN (SELECT feature, round(mi, 6) AS mi FROM {_GC_MI}) AS m USING (feature)""")
def q_group_comparison(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    corr = D.target_correlation(r, GC_COLS, (F.col("severity") == "Fatal").cast("int"))
    mi = D.mutual_info_target(r, GC_COLS, [], "severity", "row_id")
    return D.group_comparison(r, GC_COLS, F.col("severity") == "Fatal", corr, mi)


IJ_NUM = ["x2", "x3", "n_vehicles", "hour", "x1", "speed_limit"]
_IJ_MI = _mi_sql(f"""(SELECT feature, bin AS a, severity AS b, count(*) AS n FROM {_bins_sql(IJ_NUM, [])}
  JOIN records USING (row_id) GROUP BY 1, 2, 3)""", "feature")
_IJ_TC = "SELECT feature, round(abs(corr), 6) AS abs_corr FROM (" + _union(
    "SELECT '{col}' AS feature, corr({col}, " + FATAL + ") AS corr FROM records", IJ_NUM) + ")"


@register("importance_join", f"""
SELECT * FROM (SELECT feature, abs_corr, mi, row_number() OVER (ORDER BY abs_corr DESC, feature) AS corr_rank,
       row_number() OVER (ORDER BY mi DESC, feature) AS mi_rank
FROM ({_IJ_TC}) JOIN (SELECT feature, round(mi, 6) AS mi FROM {_IJ_MI}) USING (feature))
WHERE corr_rank <= 3 OR mi_rank <= 3""")
def q_importance_join(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    corr = D.target_correlation(r, IJ_NUM, (F.col("severity") == "Fatal").cast("int"))
    mi = D.mutual_info_target(r, IJ_NUM, [], "severity", "row_id")
    return D.importance_join(corr, mi, 3)


@register("table_summary", """
SELECT count(*) AS n_rows, CAST(sum(CAST(x1 AS DECIMAL(18, 2))) AS DOUBLE) AS sum_x1,
       CAST(sum(CAST(n_harmed AS DECIMAL(18, 2))) AS DOUBLE) AS sum_n_harmed,
       min(x2) AS min_x2, min(hour) AS min_hour, max(x2) AS max_x2, max(hour) AS max_hour,
       count(DISTINCT weekday) AS distinct_weekday, count(DISTINCT weather) AS distinct_weather,
       count(DISTINCT row_id) AS distinct_row_id FROM records""")
def q_table_summary(spark, sf_dir):
    return D.table_summary(tables(spark, sf_dir).records(), sums=["x1", "n_harmed"], ranges=["x2", "hour"],
                           distinct=["weekday", "weather", "row_id"])


@register("subgroup_rates", f"""
SELECT subgroup, n, round(rate, 6) AS rate, round(overall, 6) AS overall_rate, round(rate / overall, 4) AS relative_risk
FROM (SELECT 'fast' AS subgroup, count(*) FILTER (WHERE speed_limit >= 60) AS n,
             avg({FATAL}) FILTER (WHERE speed_limit >= 60) AS rate FROM records
      UNION ALL SELECT 'rain', count(*) FILTER (WHERE weather = 'R'), avg({FATAL}) FILTER (WHERE weather = 'R')
      FROM records
      UNION ALL SELECT 'solo', count(*) FILTER (WHERE n_vehicles = 1), avg({FATAL}) FILTER (WHERE n_vehicles = 1)
      FROM records), (SELECT avg({FATAL}) AS overall FROM records)""")
def q_subgroup_rates(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    flags = {"fast": F.col("speed_limit") >= 60, "rain": F.col("weather") == "R", "solo": F.col("n_vehicles") == 1}
    return D.subgroup_rates(r, flags, F.col("severity") == "Fatal")


@register("histogram", """
SELECT bin, round(CAST(0.0 + bin * 5500.0 AS DOUBLE), 6) AS bin_start, count(*) AS n FROM (
  SELECT CAST(least(greatest(floor((x1 - 0.0) / 5500.0), 0), 19) AS BIGINT) AS bin FROM records WHERE x1 IS NOT NULL)
GROUP BY 1""")
def q_histogram(spark, sf_dir):
    return D.histogram(tables(spark, sf_dir).records(), "x1", 0.0, 110000.0, 20)


@register("select_mutual_info", f"""
SELECT feature, round(mi, 6) AS score, row_number() OVER (ORDER BY round(mi, 6) DESC, feature) <= 3 AS selected
FROM {MI_TARGET_SQL}""")
def q_select_mutual_info(spark, sf_dir):
    from strataflow.operators import selection as G
    return G.select_mutual_info(tables(spark, sf_dir).records(), MI_NUM, MI_CAT, "severity", "row_id", k=3)


@register("selection_report", f"""
SELECT feature, row_number() OVER (ORDER BY round(mi, 6) DESC, feature) <= 2 AS selected, round(mi, 6) AS score
FROM {MI_TARGET_SQL}""")
def q_selection_report(spark, sf_dir):
    from strataflow.operators import selection as G
    return G.selection_report(tables(spark, sf_dir).records(), "mutual_info", MI_NUM + MI_CAT, "severity", k=2,
                              categorical=MI_CAT)
