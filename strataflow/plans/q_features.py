"""Catalog entries for feature preparation (F1-F8) on the split ``records``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.config import records_feature_config
from strataflow.functions import columns as B
from strataflow.operators import features as FE
from strataflow.plans.catalog import register
from strataflow.plans.q_sampling import SPLIT_CTES, split_records
from strataflow.operators import sampling as E
from strataflow.sources import io as IO
from strataflow.sources.tables import tables

AGE = "CASE WHEN driver_age = 999 THEN NULL ELSE driver_age END"
SPLIT_RECS = f"""{SPLIT_CTES},
sr AS (SELECT r.* REPLACE ({AGE} AS driver_age), s.split, s.label FROM records r JOIN splits s USING (row_id)),
tr AS (SELECT * FROM sr WHERE split = 'train')"""


def split_recs(spark, sf_dir):
    s = split_records(spark, sf_dir)
    return B.sentinel_to_null(s, ["driver_age"], 999)


def train_of(df):
    return df.where(F.col("split") == "train")


@register("impute_median", f"""WITH {SPLIT_RECS}
SELECT row_id, coalesce(driver_age, (SELECT quantile_cont(driver_age, 0.5) FROM tr)) AS driver_age,
       round(coalesce(x1, (SELECT quantile_cont(x1, 0.5) FROM tr)), 6) AS x1 FROM sr""")
def q_impute_median(spark, sf_dir):
    sr = split_recs(spark, sf_dir)
    cols = ["driver_age", "x1"]
    med = FE.fit_median(train_of(sr), cols)
    out = FE.impute(sr.select("row_id", F.col("driver_age").cast("double"), "x1"), med, "median", cols)
    return out.select("row_id", "driver_age", F.round("x1", 6).alias("x1"))


@register("impute_mode", f"""WITH {SPLIT_RECS}
SELECT row_id, coalesce(weather, (SELECT weather FROM tr WHERE weather IS NOT NULL GROUP BY 1
                                  ORDER BY count(*) DESC, weather LIMIT 1)) AS weather FROM sr""")
def q_impute_mode(spark, sf_dir):
    sr = split_recs(spark, sf_dir)
    mode = FE.fit_mode(train_of(sr), ["weather"])
    return FE.impute(sr.select("row_id", "weather"), mode, "mode", ["weather"])


@register("impute_mean", f"""WITH {SPLIT_RECS}
SELECT row_id, round(coalesce(driver_age, (SELECT avg(driver_age) FROM tr)), 6) AS driver_age FROM sr""")
def q_impute_mean(spark, sf_dir):
    sr = split_recs(spark, sf_dir)
    mean = FE.fit_mean(train_of(sr), ["driver_age"])
    out = FE.impute(sr.select("row_id", F.col("driver_age").cast("double")), mean, "mean", ["driver_age"])
    return out.select("row_id", F.round("driver_age", 6).alias("driver_age"))


@register("standardize", f"""WITH {SPLIT_RECS},
st AS (SELECT avg(x1) AS m1, CASE WHEN stddev_pop(x1) > 0 THEN stddev_pop(x1) ELSE 1 END AS s1,
              avg(x2) AS m2, CASE WHEN stddev_pop(x2) > 0 THEN stddev_pop(x2) ELSE 1 END AS s2,
              avg(n_vehicles * 0) AS m3, CASE WHEN stddev_pop(n_vehicles * 0) > 0 THEN stddev_pop(n_vehicles * 0)
              ELSE 1 END AS s3 FROM tr)
SELECT row_id, round((x1 - m1) / s1, 6) AS x1, round((x2 - m2) / s2, 6) AS x2,
       round((n_vehicles * 0 - m3) / s3, 6) AS zero FROM sr, st""")
def q_standardize(spark, sf_dir):
    sr = split_recs(spark, sf_dir).withColumn("zero", F.col("n_vehicles") * 0)
    sc = FE.fit_scale(train_of(sr), ["x1", "x2", "zero"]).collect()
    p = {r["feature"]: (r["mean"], r["scale"]) for r in sc}
    return sr.select("row_id", *[F.round((F.col(x) - F.lit(p[x][0])) / F.lit(p[x][1]), 6).alias(x)
                                 for x in ("x1", "x2", "zero")])


@register("ordinal_encode", f"""WITH {SPLIT_RECS},
cats AS (SELECT weekday, CAST(row_number() OVER (ORDER BY weekday) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT weekday FROM tr WHERE weekday <> 'Sunday' AND weekday IS NOT NULL))
SELECT row_id, coalesce(code, -1) AS weekday_code FROM sr LEFT JOIN cats USING (weekday)""")
def q_ordinal_encode(spark, sf_dir):
    sr = split_recs(spark, sf_dir)
    cats = FE.fit_categories(train_of(sr).where(F.col("weekday") != "Sunday"), ["weekday"])
    out = FE.apply_categories(sr.select("row_id", "weekday"), ["weekday"], cats, prefix="code_")
    return out.select("row_id", F.col("code_weekday").alias("weekday_code"))


@register("ordinal_encode_fixed", """
SELECT row_id, CASE weather WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE -1 END AS weather_code FROM records""")
def q_ordinal_encode_fixed(spark, sf_dir):
    r = tables(spark, sf_dir).records()
    return r.select("row_id", FE.ordinal_fixed(F.col("weather"), ["N", "R"]).alias("weather_code"))


@register("fill_constant", f"""
SELECT row_id, coalesce({AGE}, -1) AS driver_age, coalesce(weather, '__missing__') AS weather FROM records""")
def q_fill_constant(spark, sf_dir):
    r = B.sentinel_to_null(tables(spark, sf_dir).records().select("row_id", "driver_age", "weather"),
                           ["driver_age"], 999)
    return FE.fill_constant(r)


# ------------------------------------------------------------------ F7
_NUM = ["year", "speed_limit", "driver_age", "x1", "x2", "x3", "solo_highspeed", "vulnerability_interaction"]
_CAT = ["weather", "surface"]
_CYC = ["hour_sin", "hour_cos", "month_no_sin", "month_no_cos", "weekday_sin", "weekday_cos"]
_WD = ("CASE weekday WHEN 'Monday' THEN 0 WHEN 'Tuesday' THEN 1 WHEN 'Wednesday' THEN 2 WHEN 'Thursday' THEN 3 "
       "WHEN 'Friday' THEN 4 WHEN 'Saturday' THEN 5 WHEN 'Sunday' THEN 6 END")


def _pipeline_sql() -> str:
    prep = f"""p AS (SELECT row_id, split, label, year, speed_limit, driver_age, x1, x2, x3,
  CAST(coalesce(n_vehicles = 1 AND speed_limit >= 45, false) AS INTEGER) AS solo_highspeed,
  CAST(coalesce(driver_age < 25 OR driver_age > 70, false) AND coalesce(speed_limit > 40, false) AS INTEGER)
    AS vulnerability_interaction, weather, surface,
  sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
  sin(2 * pi() * (month_no - 1) / 12) AS month_no_sin, cos(2 * pi() * (month_no - 1) / 12) AS month_no_cos,
  sin(2 * pi() * ({_WD}) / 7) AS weekday_sin, cos(2 * pi() * ({_WD}) / 7) AS weekday_cos FROM sr),
ptr AS (SELECT * FROM p WHERE split = 'train')"""
    med = "med AS (SELECT " + ", ".join(f"quantile_cont({x}, 0.5) AS {x}" for x in _NUM) + " FROM ptr)"
    imp = ("imp AS (SELECT " + ", ".join(f"coalesce({x}, (SELECT {x} FROM med)) AS {x}" for x in _NUM)
           + " FROM ptr)")
    sc = ("sc AS (SELECT " + ", ".join(
        f"avg({x}) AS m_{x}, CASE WHEN stddev_pop({x}) > 0 THEN stddev_pop({x}) ELSE 1 END AS s_{x}" for x in _NUM)
        + " FROM imp)")
    modes = ",\n".join(f"mode_{x} AS (SELECT {x} AS v FROM ptr WHERE {x} IS NOT NULL GROUP BY 1 "
                       f"ORDER BY count(*) DESC, {x} LIMIT 1)" for x in _CAT)
    cats = ",\n".join(f"cat_{x} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
                      f"(SELECT DISTINCT coalesce({x}, (SELECT v FROM mode_{x})) AS v FROM ptr))" for x in _CAT)
    cyc = "cm AS (SELECT " + ", ".join(f"avg({x}) AS {x}" for x in _CYC) + " FROM ptr)"
    cols = ["row_id", "split", "label"]
    cols += [f"round((coalesce({x}, (SELECT {x} FROM med)) - m_{x}) / s_{x}, 6) AS num__{x}" for x in _NUM]
    cols += [f"CAST(coalesce((SELECT code FROM cat_{x} WHERE v = coalesce(p.{x}, (SELECT v FROM mode_{x}))), -1) "
             f"AS DOUBLE) AS cat__{x}" for x in _CAT]
    cols += [f"round(coalesce(p.{x}, (SELECT {x} FROM cm)), 6) AS cyc__{x}" for x in _CYC]
    return (f"WITH {SPLIT_RECS},\n{prep},\n{med},\n{imp},\n{sc},\n{modes},\n{cats},\n{cyc}\n"
            f"SELECT {', '.join(cols)} FROM p, sc")


def pipeline_frame(spark, sf_dir):
    """records -> prepare -> split -> fit on train -> transform all rows."""
    cfg = records_feature_config()
    r = tables(spark, sf_dir).records()
    split = E.stratified_split(FE.prepare(r, cfg), "label", cfg.key, cfg.test_size, cfg.val_size, seed=cfg.seed)
    # read by the fit (train rows, several statistics) and by the transform: written once, to the shared folder
    path = IO.fresh_path(spark, "split")
    IO.write_splits(split, path)
    prepared = spark.read.parquet(path)
    model = FE.fit_pipeline(train_of(prepared), cfg)
    return FE.transform_pipeline(prepared, model, keep=["row_id", "split", "label"]), model


@register("feature_pipeline", _pipeline_sql())
def q_feature_pipeline(spark, sf_dir):
    out, model = pipeline_frame(spark, sf_dir)
    return out.select("row_id", "split", "label",
                      *[F.round(F.col(x), 6).alias(x) if not x.startswith("cat__") else F.col(x)
                        for x in model.output_columns])
