"""Leak-safe feature preparation (F1-F8).

Fit = a few aggregates over the TRAIN rows only, giving a small model table
(one row per feature and statistic, plus one per known category).
Transform = one projection over any split, with the small model broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import FeatureConfig, MONTH_NAMES, WEEKDAY_NAMES
from strataflow.functions import columns as B
from strataflow.functions.columns import c, present
from strataflow.functions.ranking import (column_counts, exact_quantiles, fixed_sum, global_rank, in_ranges,
                                          quantiles_of_counts)
from strataflow.session import materialize

MODEL_SCHEMA = T.StructType([
    T.StructField("grp", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("stat", T.StringType()),
    T.StructField("num", T.DoubleType()),
    T.StructField("text", T.StringType()),
])


class LeakageError(ValueError):
    pass


def _tall(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[present(df, x).cast("double").alias(x) for x in cols]).unpivot([], cols, "feature", "value")


def _tall_str(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[c(x).cast("string").alias(x) for x in cols]).unpivot([], cols, "feature", "value")


# ----------------------------------------------------------------- single-step fits

def fit_median(train: DataFrame, cols: list[str]) -> DataFrame:
    """F1 fit: exact median per column -> (feature, median)."""
    return exact_quantiles(_tall(train, cols), "value", [0.5], by="feature").select(
        "feature", F.col("value").alias("median"))


def fit_mode(train: DataFrame, cols: list[str]) -> DataFrame:
    """F2 fit: most frequent value per column, ties -> smallest value.

    Two grouped aggregates (max count, then min value at that count) instead
    of a window over all values of a column.
    """
    counts = (_tall_str(train, cols).where(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("feature").agg(F.max("n").alias("n"))
    return counts.join(best, ["feature", "n"]).groupBy("feature").agg(F.min("value").alias("mode"))


def fit_mean(train: DataFrame, cols: list[str]) -> DataFrame:
    """F3 fit: mean per column."""
    return train.agg(*[F.avg(present(train, x)).alias(x) for x in cols]).unpivot([], cols, "feature", "mean")


def fit_scale(train: DataFrame, cols: list[str]) -> DataFrame:
    """F4 fit: mean and POPULATION std; zero (or undefined) std -> 1."""
    aggs = []
    for x in cols:
        aggs += [F.avg(present(train, x)).alias(f"{x}\u0001m"), F.stddev_pop(present(train, x)).alias(f"{x}\u0001s")]
    wide = train.agg(*aggs)
    rows = [F.struct(F.lit(x).alias("feature"), F.col(f"`{x}\u0001m`").alias("mean"),
                     F.when(F.col(f"`{x}\u0001s`") > 0, F.col(f"`{x}\u0001s`")).otherwise(F.lit(1.0)).alias("scale"))
            for x in cols]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def fit_categories(train: DataFrame, cols: list[str]) -> DataFrame:
    """F5 fit: sorted categories per column -> (feature, value, code)."""
    d = _tall_str(train, cols).where(F.col("value").isNotNull()).distinct()
    return global_rank(d, "value", by="feature").select("feature", "value", (F.col("rank") - 1).cast("int").alias("code"))


def apply_categories(df: DataFrame, cols: list[str], cats: DataFrame, prefix: str = "") -> DataFrame:
    """F5 transform: code per column, unseen/null -> -1.  One left join per
    column against its categories; their measured size decides how it runs."""
    cats = materialize(cats)
    out = df
    for x in cols:
        m = cats.where(F.col("feature") == x).select(F.col("value").alias(f"_v_{x}"),
                                                     F.col("code").alias(f"_c_{x}"))
        out = out.join(m, c(x).cast("string") == F.col(f"_v_{x}"), "left")
        out = out.withColumn(prefix + x, F.coalesce(F.col(f"_c_{x}"), F.lit(-1))).drop(f"_v_{x}", f"_c_{x}")
    return out


def ordinal_fixed(col: Column, order: list) -> Column:
    """position in a given order; unseen -> -1."""
    m = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(str(v)), F.lit(i))])
    return F.coalesce(m[col.cast("string")], F.lit(-1))


def fill_constant(df: DataFrame, number: float = -1, text: str = "__missing__") -> DataFrame:
    """F8: nulls -> constant (numbers) / marker (strings)."""
    return df.fillna(number).fillna(text)


def impute(df: DataFrame, stats: DataFrame, value_col: str, cols: list[str]) -> DataFrame:
    """Replace nulls with a fitted per-column value (stats brought as literals:
    one value per column)."""
    vals = {r["feature"]: r[value_col] for r in stats.collect()}
    return df.select(*[F.coalesce(c(x), F.lit(vals.get(x))).alias(x) if x in cols else c(x) for x in df.columns])


# ----------------------------------------------------------------- F7 pipeline

@dataclass
class FeatureModel:
    """Fitted column-group transformer (a small table, saved as parquet)."""

    table: DataFrame
    numeric: list[str]
    categorical: list[str]
    cyclical: list[str]
    ordinal: dict

    @property
    def output_columns(self) -> list[str]:
        return ([f"num__{x}" for x in self.numeric] + [f"cat__{x}" for x in self.categorical]
                + [f"cyc__{x}" for x in self.cyclical] + [f"ord__{x}" for x in self.ordinal])

    def save(self, path: str) -> None:
        meta = {"numeric": self.numeric, "categorical": self.categorical, "cyclical": self.cyclical,
                "ordinal": self.ordinal}
        import json
        self.table.withColumn("meta", F.lit(json.dumps(meta))).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureModel":
        import json
        t = spark.read.parquet(path)
        meta = json.loads(t.select("meta").first()["meta"])
        return FeatureModel(t.drop("meta"), meta["numeric"], meta["categorical"], meta["cyclical"],
                            meta["ordinal"])


def prepare(df: DataFrame, cfg: FeatureConfig, helper: str | None = "n_vehicles") -> DataFrame:
    """Select -> sentinel recode -> interaction flags -> cyclical -> target.

    Raises ``LeakageError`` when a forbidden column is configured as a feature.
    """
    leaks = sorted(set(cfg.features) & set(cfg.forbidden))
    if leaks:
        raise LeakageError(f"forbidden columns requested as features: {leaks}")
    keep = [cfg.key] + ([helper] if cfg.interaction_flags and helper else [])
    out = B.select_present(df, cfg.features + [cfg.target], keep=keep)
    if cfg.sentinel_value is not None:
        out = B.sentinel_to_null(out, cfg.sentinel_columns, cfg.sentinel_value)
    if cfg.interaction_flags and helper:
        age = cfg.sentinel_columns[0] if cfg.sentinel_columns else "driver_age"
        out = B.interaction_flags(out, helper, "speed_limit", age)
    for col, period in cfg.cyclical.items():
        if col not in out.columns:
            continue
        if col in ("month_no", "MONTH"):
            vals = (c(col).cast("double") - 1) if col == "month_no" else \
                B.name_to_ordinal(c(col), MONTH_NAMES)
        elif col in ("weekday", "DAYOFWEEK"):
            vals = B.name_to_ordinal(c(col), WEEKDAY_NAMES).cast("double")
        else:
            vals = F.expr(f"try_cast(`{col}` AS double)")
        out = B.cyclical_encode(out, col, period, values=vals)
    out = B.drop_null_target(out, cfg.target)
    return B.encode_label(out, cfg.target, cfg.target_codes).drop(cfg.target) if cfg.target != "label" else out


def _groups(df: DataFrame, cfg: FeatureConfig) -> tuple[list[str], list[str], list[str], dict]:
    cols = df.columns
    num = [x for x in cfg.numeric if x in cols]
    num += [x for x in ("solo_highspeed", "vulnerability_interaction") if x in cols and x not in num]
    cyc = [f"{x}_{k}" for x in cfg.cyclical for k in ("sin", "cos") if f"{x}_{k}" in cols]
    cat = [x for x in cfg.categorical if x in cols and x not in cfg.cyclical]
    ords = {k: v for k, v in cfg.ordinal.items() if k in cols and k not in cfg.cyclical}
    return num, cat, cyc, ords


def fit_pipeline(train: DataFrame, cfg: FeatureConfig) -> FeatureModel:
    """F7 fit on the train rows (already through :func:`prepare`).

    One pass counts the values of all columns, missing ones included; medians, moments, modes and sorted
    categories all come from these counts, which are kept in ranges of (column, value).
    """
    spark = train.sparkSession
    num, cat, cyc, ords = _groups(train, cfg)
    text = cat + list(ords)
    counts = column_counts(train, num + cyc, text)
    held = in_ranges(counts, ["feature"], [F.col("num"), F.col("text")], None)
    v, n = F.col("num"), F.col("n")
    known = held.where("num is not null")
    medians = {r["feature"]: r["value"] for r in quantiles_of_counts(known, "num", [0.5], ["feature"]).collect()}
    sums = {r["feature"]: r for r in held.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum(F.when(v.isNotNull(), n)).alias("known"), fixed_sum(v, n).alias("sum")).collect()}
    # the mean of a numeric column counts its missing values as the median, that of a cyclical one leaves them out
    means = {}
    for x in num + cyc:
        r = sums.get(x)
        missing = r["n"] - (r["known"] or 0) if r and x in num and medians.get(x) is not None else 0
        total = (r["known"] or 0) + missing if r else 0
        means[x] = ((r["sum"] or 0.0) + missing * (medians.get(x) or 0.0)) / total if total else None
    away = F.lit(None).cast("double")
    for x in num:
        if means[x] is not None:
            away = F.when(F.col("feature") == x, F.coalesce(v, F.lit(float(medians[x]))) - F.lit(means[x])).otherwise(away)
    squares = {r["feature"]: r["s"] for r in held.groupBy("feature").agg((F.sum(n * away * away) / F.sum("n")).alias("s")).collect()}
    most = held.where("text is not null").groupBy("feature").agg(F.max("n").alias("n"))
    modes = {r["feature"]: r["mode"] for r in held.where("text is not null").join(most, ["feature", "n"])
             .groupBy("feature").agg(F.min("text").alias("mode")).collect()}
    rows = []  # a few for each column
    for x in num:
        scale = squares.get(x) or 0.0
        rows += [("num", x, "median", medians.get(x), None), ("num", x, "mean", means[x], None),
                 ("num", x, "scale", scale ** 0.5 if scale > 0 else 1.0, None)]
    rows += [("cyc", x, "mean", means[x], None) for x in cyc]
    rows += [("cat" if x in cat else "ord", x, "mode", None, modes.get(x)) for x in text]
    table = spark.createDataFrame(rows, MODEL_SCHEMA)
    if cat:  # missing categories became the mode, which is one of those counted
        ranked = global_rank(held.where(F.col("text").isNotNull() & F.col("feature").isin(*cat)).select("feature", "text"),
                             "text", by="feature")
        table = table.union(ranked.select(F.lit("cat"), "feature", F.lit("category"), (F.col("rank") - 1).cast("double"), "text"))
    # stays distributed (categories can be many): written once, lineage cut
    return FeatureModel(materialize(table), num, cat, cyc, ords)


def transform_pipeline(df: DataFrame, model: FeatureModel, keep: list[str] = ("row_id", "label"),
                       vector: str | None = "features") -> DataFrame:
    """F7 transform: one projection, and one join per categorical column with its categories (their measured size
    decides how it runs).  Output columns ``group__col`` and, optionally, an array."""
    # per-feature statistics only (features x stats rows); categories stay in the table
    rows = model.table.where(F.col("stat") != "category").collect()
    st = {(r["feature"], r["stat"]): (r["num"], r["text"]) for r in rows}
    sel = [c(k) for k in keep if k in df.columns]
    for x in model.numeric:
        med, mean, scale = st[(x, "median")][0], st[(x, "mean")][0], st[(x, "scale")][0]
        v = F.coalesce(c(x).cast("double"), F.lit(med))
        sel.append(((v - F.lit(mean)) / F.lit(scale)).alias(f"num__{x}"))
    for x in model.categorical:
        sel.append(F.coalesce(c(x).cast("string"), F.lit(st[(x, "mode")][1])).alias(f"cat__{x}"))
    for x in model.cyclical:
        sel.append(F.coalesce(c(x), F.lit(st[(x, "mean")][0])).alias(f"cyc__{x}"))
    for x, order in model.ordinal.items():
        v = F.coalesce(c(x).cast("string"), F.lit(st[(x, "mode")][1]))
        sel.append(ordinal_fixed(v, order).cast("double").alias(f"ord__{x}"))
    out = df.select(*sel)
    categories = model.table.where(F.col("stat") == "category")
    for x in model.categorical:
        own = categories.where(F.col("feature") == x).select(F.col("text").alias("_text"), F.col("num").alias("_code"))
        out = out.join(own, F.col(f"cat__{x}") == F.col("_text"), "left").withColumn(
            f"cat__{x}", F.coalesce("_code", F.lit(-1.0))).drop("_text", "_code")
    if vector:
        out = out.withColumn(vector, F.array(*[c(x) for x in model.output_columns]))
    return out
