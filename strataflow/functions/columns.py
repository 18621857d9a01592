"""Scalar column operators (B1-B16).  All are built-in expressions: they stay
inside whole-stage codegen and never leave the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def c(name: str) -> Column:
    return F.col(f"`{name}`")


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN (if it is floating) as null: both are missing."""
    kind = df.schema[name].dataType if name in df.columns else None
    return F.when(~F.isnan(c(name)), c(name)) if isinstance(kind, (T.DoubleType, T.FloatType)) else c(name)


def select_present(df: DataFrame, want: list[str], keep: list[str] = ()) -> DataFrame:
    """B1: wanted columns that exist (plus helper columns in ``keep``), in order."""
    cols = [x for x in dict.fromkeys(list(want) + list(keep)) if x in df.columns]
    return df.select(*[c(x) for x in cols])


def sentinel_to_null(df: DataFrame, columns: list[str], sentinels) -> DataFrame:
    """Listed sentinel values become null (absent columns are skipped)."""
    if not isinstance(sentinels, (list, tuple, set)):
        sentinels = [sentinels]
    out = df
    for col in columns:
        if col in df.columns:
            out = out.withColumn(col, F.when(~c(col).isin(*[F.lit(s) for s in sentinels]) | c(col).isNull(),
                                             c(col)))
    return out


def interaction_flags(df: DataFrame, vehicles: str, speed: str, age: str,
                      drop_helper: bool = True) -> DataFrame:
    """``solo_highspeed`` and ``vulnerability_interaction`` as 0/1.

    Comparisons with null are false (as in the column-wise original), hence
    the ``coalesce(..., false)``.
    """
    out = df
    if vehicles in df.columns and speed in df.columns:
        out = out.withColumn("solo_highspeed", F.coalesce((c(vehicles) == 1) & (c(speed) >= 45),
                                                          F.lit(False)).cast("int"))
    if age in df.columns and speed in df.columns:
        young_old = F.coalesce(c(age) < 25, F.lit(False)) | F.coalesce(c(age) > 70, F.lit(False))
        out = out.withColumn("vulnerability_interaction",
                             (young_old & F.coalesce(c(speed) > 40, F.lit(False))).cast("int"))
    if drop_helper and vehicles in out.columns:
        out = out.drop(vehicles)
    return out


def name_to_ordinal(col: Column, names: list[str], offset: int = 0) -> Column:
    """Lookup of a name list -> position (+offset); unknown -> null."""
    m = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i + offset))])
    return m[col]


def cyclical_encode(df: DataFrame, column: str, period: float, values: Column | None = None,
                    drop_source: bool = True) -> DataFrame:
    """``<col>_sin``/``<col>_cos`` of ``2*pi*x/period``; null stays null."""
    if column not in df.columns:
        return df
    x = values if values is not None else c(column).cast("double")
    ang = F.lit(2 * math.pi / period) * x
    out = df.withColumn(f"{column}_sin", F.sin(ang)).withColumn(f"{column}_cos", F.cos(ang))
    return out.drop(column) if drop_source else out


def encode_label(df: DataFrame, column: str, codes: dict[str, int], out: str = "label",
                 fail_unmapped: bool = True) -> DataFrame:
    """Target name -> int code.  An unmapped non-null name raises at
    execution time (``raise_error`` inside the projection; no extra job)."""
    m = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
    mapped = m[c(column)]
    if fail_unmapped:
        mapped = F.when(c(column).isNotNull() & mapped.isNull(),
                        F.raise_error(F.concat(F.lit("unmapped target value: "), c(column)))
                        ).otherwise(mapped)
    return df.withColumn(out, mapped.cast("int"))


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """B8."""
    return df.dropna(subset=[target])


def coerce_columns(df: DataFrame, numeric: list[str] = (), timestamps: list[str] = (),
                   ts_format: str | None = None) -> DataFrame:
    """To double / timestamp; unparsable -> null (ANSI-safe ``try_*``)."""
    out = df
    for col in numeric:
        out = out.withColumn(col, F.expr(f"try_cast(`{col}` AS double)"))
    for col in timestamps:
        fmt = F.lit(ts_format) if ts_format else None
        out = out.withColumn(col, F.try_to_timestamp(c(col).cast("string"), fmt) if fmt is not None
                             else F.try_to_timestamp(c(col).cast("string")))
    return out


def yes_flag(col: Column) -> Column:
    """Case-insensitive contains 'yes'; null -> 0."""
    return F.coalesce(F.lower(col).contains("yes"), F.lit(False)).cast("int")


def flag_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Sum of each 0/1 flag, one row per flag, sorted by count desc."""
    wide = df.agg(*[F.sum(e).cast("bigint").alias(n) for n, e in flags.items()])
    tall = wide.unpivot([], list(flags), "flag", "n")
    return tall


def bbox_filter(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Inclusive range filter on several columns (pushed to the scan)."""
    cond = F.lit(True)
    for col, (lo, hi) in bounds.items():
        cond = cond & c(col).between(lo, hi)
    return df.where(cond)


def clip_counts(df: DataFrame, column: str, upper, out: str = "value") -> DataFrame:
    """Clip at ``upper`` then count per value."""
    return df.groupBy(F.least(c(column), F.lit(upper)).alias(out)).agg(F.count(F.lit(1)).alias("n"))


def bucket_label(col: Column, edges: list[float]) -> Column:
    """Right-closed labelled bins ``(a,b]``; outside -> null."""
    expr = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        lab = f"({_fmt(lo)}, {_fmt(hi)}]"
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def _fmt(x) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def drop_rate_gate(df: DataFrame, keep: Column, max_drop: float = 0.05) -> DataFrame:
    """Rows kept by ``keep`` vs all rows in ONE aggregate; pass flag."""
    agg = df.agg(F.count(F.lit(1)).alias("n_before"), F.count(F.when(keep, 1)).alias("n_after"))
    rate = F.when(F.col("n_before") > 0, 1 - F.col("n_after") / F.col("n_before")).otherwise(F.lit(0.0))
    return agg.select("n_before", "n_after", F.round(rate, 6).alias("drop_rate"),
                      (rate <= F.lit(max_drop)).alias("passed"))


def mlp_param_count(n_features: int | Column) -> Column:
    """Parameters of the reference head p -> 128 -> 64 -> 1."""
    p = n_features if isinstance(n_features, Column) else F.lit(n_features)
    return p * 128 + 128 + (128 * 64 + 64) + (64 + 1)


def sample_complexity(train: DataFrame, n_features: int, min_ratio: float = 3.0) -> DataFrame:
    """n_train / n_params >= min_ratio."""
    n_params = mlp_param_count(n_features)
    agg = train.agg(F.count(F.lit(1)).alias("n_train"))
    ratio = F.col("n_train") / n_params
    return agg.select("n_train", n_params.cast("bigint").alias("n_params"),
                      F.round(ratio, 6).alias("ratio"), (ratio >= F.lit(min_ratio)).alias("passed"))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are non-null; null (instead
    of an ANSI divide-by-zero error) when either side is constant."""
    x, y = x.cast("double"), y.cast("double")
    xm = F.when(y.isNotNull(), x)
    ym = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_samp(xm, ym), F.stddev_samp(xm) * F.stddev_samp(ym))


def row_minmax(cols: list[str], eps: float = 1e-10) -> list[Column]:
    """Each value scaled by the row's min / max across ``cols``."""
    lo = F.least(*[c(x) for x in cols])
    hi = F.greatest(*[c(x) for x in cols])
    return [((c(x) - lo) / (hi - lo + F.lit(eps))).alias(f"{x}_norm") for x in cols]
