"""Profiling and aggregation.

Wide statistics are computed in ONE aggregate and turned tall with
``unpivot``; per-column work on tall data is partitioned by column name, so
a table with many columns spreads over many tasks.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.columns import c, present, safe_corr
from strataflow.session import materialize
from strataflow.functions.ranking import (column_counts, count_below, exact_quantiles, fixed_sum, in_ranges, quantiles_of_counts,
                                          value_counts_cumulative, with_scalar)


def _r(x: Column, nd: int = 6) -> Column:
    return F.round(x, nd)


def tall(df: DataFrame, cols: list[str], id_cols: list[str] = (), name: str = "feature",
         value: str = "value") -> DataFrame:
    """Unpivot ``cols`` (cast to double) into ``(id..., feature, value)``."""
    casted = df.select(*[c(x) for x in id_cols], *[present(df, x).cast("double").alias(x) for x in cols])
    return casted.unpivot(list(id_cols), list(cols), name, value)


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null count and rate per column, only columns with nulls."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(present(df, x)).alias(x) for x in cols])
    t = wide.unpivot(["_n"], cols, "column_name", "n_present")
    return (t.select("column_name", (F.col("_n") - F.col("n_present")).alias("n_null"),
                     _r((F.col("_n") - F.col("n_present")) / F.col("_n")).alias("null_rate"))
             .where(F.col("n_null") > 0))


def dtype_counts(df: DataFrame) -> dict[str, int]:
    """D1 (metadata part): number of columns per Spark type (no job)."""
    out: dict[str, int] = {}
    for f in df.schema.fields:
        out[f.dataType.simpleString()] = out.get(f.dataType.simpleString(), 0) + 1
    return out


def value_counts(df: DataFrame, col: str, top_k: int | None = None, order: list | None = None) -> DataFrame:
    """Count and share per value.

    ``order``: fixed category list - categories with no rows are kept with 0
    (left join from the small order table).  ``top_k``: the k most frequent
    (ties by value).
    """
    counts = df.groupBy(c(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    if order is not None:
        spark = df.sparkSession
        cats = spark.createDataFrame([(v, i) for i, v in enumerate(order)], ["value", "position"])
        counts = cats.join(counts, "value", "left").select(
            "value", "position", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    out = with_scalar(counts, total).select(*counts.columns,
                                            _r(F.col("n") / F.col("_total")).alias("share"))
    if top_k is not None:
        out = out.orderBy(F.desc("n"), F.asc("value")).limit(top_k)
    return out


def crosstab_share(df: DataFrame, row: str, col: str, top_k: int | None = None) -> DataFrame:
    """D3: row-normalised cross tab (long form) for the top-k row keys."""
    counts = df.groupBy(c(row).alias("row_key"), c(col).alias("col_key")).agg(F.count(F.lit(1)).alias("n"))
    if top_k is not None:
        top = (df.groupBy(c(row).alias("row_key")).agg(F.count(F.lit(1)).alias("_rn"))
                 .orderBy(F.desc("_rn"), F.asc("row_key")).limit(top_k).select("row_key"))
        counts = counts.join(F.broadcast(top), "row_key", "left_semi")  # k rows: bounded by parameter
    w = Window.partitionBy("row_key")
    return counts.select("row_key", "col_key", "n", _r(F.col("n") / F.sum("n").over(w)).alias("share"))


def describe_exact(df: DataFrame, cols: list[str], ranges: int | None = None) -> DataFrame:
    """Count, mean, std (sample), min, exact quartiles, max per column, unrounded.

    One scan: everything is taken from the distinct values with their counts."""
    counts = column_counts(df, cols).where("num is not null").select("feature", F.col("num").alias("value"), "n")
    held = in_ranges(counts, ["feature"], [F.col("value")], ranges)
    value, n = F.col("value"), F.col("n")
    basic = {r["feature"]: r for r in held.groupBy("feature").agg(
        F.sum("n").alias("count"), (fixed_sum(value, n) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max")).collect()}  # a row a column
    # squares of distances to the mean: no cancellation in columns with a large one
    away = F.lit(0.0)
    for x, r in basic.items():
        away = F.when(F.col("feature") == x, value - F.lit(r["mean"])).otherwise(away)
    squares = {r["feature"]: r["s"] for r in held.groupBy("feature").agg(F.sum(n * away * away).alias("s")).collect()}
    cuts = {(r["feature"], r["q"]): r["value"] for r in quantiles_of_counts(held, "value", [0.25, 0.5, 0.75], ["feature"]).collect()}
    rows = []
    for x in cols:
        r = basic.get(x)  # a column without values has a row, too
        count = r["count"] if r else 0
        rows.append((x, count, r["mean"] if r else None, math.sqrt(squares[x] / (count - 1)) if count > 1 else None,
                     r["min"] if r else None, r["max"] if r else None, *(cuts.get((x, q)) for q in (0.25, 0.5, 0.75))))
    return df.sparkSession.createDataFrame(
        rows, "feature string, count long, mean double, std double, min double, max double, q25 double, q50 double, q75 double")


def group_means(df: DataFrame, by: Column | str, cols: list[str], key_name: str = "key") -> DataFrame:
    """Mean of ``cols`` per group key (a column or expression), unrounded."""
    key = c(by) if isinstance(by, str) else by
    return df.groupBy(key.alias(key_name)).agg(
        F.count(F.lit(1)).alias("n"),
        *[(fixed_sum(present(df, x).cast("double")) / F.count(present(df, x))).alias(f"mean_{x}") for x in cols])


def pairwise_correlation(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson correlations, pairwise complete, unrounded; NaN where a column is constant or pairs are missing.

    One pass: each Arrow batch adds the products X'X, X'M, (X^2)'M and M'M of its values X and presence M, so
    only 4 p^2 numbers a task are shuffled.  Values are shifted by six digits of their mean, which keeps the sums
    exact enough for columns with a large one and does not depend on the layout."""
    p = len(cols)
    data = df.select(*[c(x).cast("double").alias(f"c{i}") for i, x in enumerate(cols)])
    about = data.agg(*[F.avg(F.when(F.abs(F.col(f"c{i}")) < float("inf"), F.col(f"c{i}"))) for i in range(p)]).first()
    shift = np.array([0.0 if m is None or not np.isfinite(m) else float(f"{m:.6g}") for m in about])

    def products(batches):
        total = np.zeros((4, p, p))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(p)]).astype(float) - shift
            m = np.isfinite(x).astype(float)
            x = np.where(m > 0, x, 0.0)
            total += np.stack([x.T @ x, x.T @ m, (x * x).T @ m, m.T @ m])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["v"])

    rows = (data.mapInArrow(products, "v array<double>").select(F.posexplode("v").alias("i", "v"))
            .groupBy("i").agg(F.sum("v").alias("v")).collect())  # 4 p^2 numbers
    flat = np.zeros(4 * p * p)
    for r in rows:
        flat[r["i"]] = r["v"]
    xy, x, xx, n = flat.reshape(4, p, p)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov, var = xy - x * x.T / n, xx - x * x / n
        var = np.where(var <= 1e-12 * xx, 0.0, var)
        r = cov / np.sqrt(var * var.T)
    return np.where(np.isfinite(r), np.clip(r, -1.0, 1.0), np.nan)


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, pairwise complete, from one pass (p^2 rows)."""
    m = pairwise_correlation(df, cols)
    rows = [(a, b, None if np.isnan(m[i, j]) else float(m[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")
    return out.withColumn("corr", _r(F.col("corr")))


def target_correlation(df: DataFrame, cols: list[str], target: Column) -> DataFrame:
    """Correlation of each feature with a (binary) target, ranked by |r|."""
    wide = df.agg(*[safe_corr(c(x), target).alias(x) for x in cols])
    t = wide.unpivot([], cols, "feature", "corr")
    return (t.select("feature", _r(F.col("corr")).alias("corr"), _r(F.abs("corr")).alias("abs_corr"))
             .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("abs_corr"), "feature")).cast("bigint")))


# ---------------------------------------------------------------- mutual information

def bin_edges(df: DataFrame, numeric: list[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Exact equal-frequency bin edges per numeric column.

    A value's bin is ``min(n_bins - 1, floor(n_before * n_bins / n))`` with
    ``n_before`` the number of smaller values (ties share a bin).  That bin
    is >= j exactly when the value is >= ``t_j``, the smallest value with
    ``n_before * n_bins >= j * n``; so ``n_bins - 1`` edges per column (a
    small result) define the binning, and rows are binned by a projection.
    """
    if not numeric:
        return {}
    t = column_counts(df, numeric).select("feature", F.col("num").alias("value"), "n")
    cum = value_counts_cumulative(t, "value", by="feature", weights={"n": F.col("n")})
    edges = cum.groupBy("feature").agg(*[
        F.min(F.when(F.col("n_before") * n_bins >= j * F.col("n_total"), F.col("value"))).alias(f"t{j}")
        for j in range(1, n_bins)]).collect()  # features x (n_bins - 1) values
    return {r["feature"]: [r[f"t{j}"] for j in range(1, n_bins) if r[f"t{j}"] is not None] for r in edges}


def binned(df: DataFrame, numeric: list[str], categorical: list[str], n_bins: int = 10,
           keep: list[str] = ()) -> DataFrame:
    """Wide table of bin labels (string) per feature, plus ``keep`` columns."""
    edges = bin_edges(df, numeric, n_bins)
    cols = [c(k) for k in keep]
    for x in numeric:
        e = edges.get(x, [])
        b = count_below([F.lit(float(v)) for v in e], len(e), c(x).cast("double"), inclusive=True) if e else F.lit(0)
        cols.append(F.when(c(x).isNotNull(), b.cast("string")).alias(x))
    cols += [c(x).cast("string").alias(x) for x in categorical]
    return df.select(*cols)


def mi_from_joint(joint: DataFrame, group: list[str]) -> DataFrame:
    """``sum p_ab ln(p_ab / (p_a p_b))`` from joint counts ``(group..., a, b, n)``."""
    g = Window.partitionBy(*group)
    ga = Window.partitionBy(*group, "a")
    gb = Window.partitionBy(*group, "b")
    j = joint.select(*group, "n", F.sum("n").over(g).alias("_t"), F.sum("n").over(ga).alias("_na"),
                     F.sum("n").over(gb).alias("_nb"))
    term = (F.col("n") / F.col("_t")) * F.log(F.col("n") * F.col("_t") / (F.col("_na") * F.col("_nb")))
    return j.groupBy(*group).agg(F.sum(term).alias("mi"))


def mutual_info_target(df: DataFrame, numeric: list[str], categorical: list[str], target: str,
                       id_col: str, n_bins: int = 10) -> DataFrame:
    """Binned MI of each feature with the target, ranked."""
    feats = list(numeric) + list(categorical)
    w = binned(df.withColumn("_y", c(target).cast("string")), numeric, categorical, n_bins, keep=["_y"])
    arr = F.array(*[F.struct(F.lit(x).alias("feature"), c(x).alias("a")) for x in feats])
    ex = w.where(F.col("_y").isNotNull()).select(F.col("_y").alias("b"), F.explode(arr).alias("s"))
    joint = (ex.select("s.feature", "s.a", "b").where(F.col("a").isNotNull())
               .groupBy("feature", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    mi = materialize(mi_from_joint(joint, ["feature"]))  # one row per feature, reused downstream
    return (mi.select("feature", _r(F.col("mi")).alias("mi"))
              .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mi"), "feature")).cast("bigint")))


def pair_counts(wide: DataFrame, feats: list[str]) -> DataFrame:
    """``feature_a, feature_b, a, b, n``: how often each two labels of each pair of columns occur together (nulls left out).

    Counted per Arrow batch on the columns' codes, so a batch hands on the label pairs that occur in it, not a row for
    each row and pair of columns."""
    def count(batches):
        for batch in batches:
            coded = []
            for x in feats:
                d = batch.column(batch.schema.get_field_index(x)).dictionary_encode()
                coded.append((d.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary))
            out = [[], [], [], [], []]
            for i, j in combinations(range(len(feats)), 2):
                (x, names), (y, others) = coded[i], coded[j]
                both = (x >= 0) & (y >= 0)
                code, n = np.unique(x[both] * max(1, len(others)) + y[both], return_counts=True)
                out[0].append(pa.array([feats[i]] * len(code), pa.string()))
                out[1].append(pa.array([feats[j]] * len(code), pa.string()))
                out[2].append(names.take(pa.array(code // max(1, len(others)))))
                out[3].append(others.take(pa.array(code % max(1, len(others)))))
                out[4].append(pa.array(n.astype(np.int64)))
            if len(feats) > 1:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([c.cast(t) for c in col]) for col, t in zip(
                    out, (pa.string(),) * 4 + (pa.int64(),), strict=True)], ["feature_a", "feature_b", "a", "b", "n"])

    found = wide.select(*[c(x) for x in feats]).mapInArrow(count, "feature_a string, feature_b string, a string, b string, n long")
    return found.groupBy("feature_a", "feature_b", "a", "b").agg(F.sum("n").alias("n"))


def distinct_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """The number of different values of each column (nulls left out), all in one pass."""
    # doubles as numbers: 0.0 and -0.0 are one value
    numbers = [x for x in cols if df.schema[x].dataType.typeName() in ("double", "float")]
    values = column_counts(df, numbers, [x for x in cols if x not in numbers]).where("num is not null or text is not null")
    found = {r["feature"]: r["count"] for r in values.groupBy("feature").count().collect()}  # one row a column
    return {x: found.get(x, 0) for x in cols}


def mutual_info_matrix(df: DataFrame, numeric: list[str], categorical: list[str], id_col: str,
                       n_bins: int = 10) -> DataFrame:
    """Binned MI for every feature pair (a < b), scaled by the maximum.

    The bins of all pairs are counted in one pass (:func:`pair_counts`).
    """
    feats = list(numeric) + list(categorical)
    wide = binned(df, numeric, categorical, n_bins)
    joint = pair_counts(wide, sorted(feats))
    mi = materialize(mi_from_joint(joint, ["feature_a", "feature_b"]))  # one row per pair; read twice
    mx = mi.agg(F.max("mi").alias("_mx"))
    return with_scalar(mi, mx).select(
        "feature_a", "feature_b", _r(F.col("mi")).alias("mi"),
        _r(F.when(F.col("_mx") > 0, F.col("mi") / F.col("_mx")).otherwise(F.lit(0.0))).alias("mi_scaled"))


def top_pairs(mi_matrix: DataFrame, k: int = 20) -> DataFrame:
    """The k strongest pairs."""
    return mi_matrix.orderBy(F.desc("mi"), "feature_a", "feature_b").limit(k)


def feature_ranking(df: DataFrame, numeric: list[str], categorical: list[str], mi: DataFrame) -> DataFrame:
    """Composite 0.10*(1-null) + 0.15*variance score + 0.75*MI/max(MI)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for x in numeric:
        aggs += [F.count(c(x)).alias(f"{x}\u0001nn"), F.stddev_samp(c(x)).alias(f"{x}\u0001sd"),
                 F.avg(c(x)).alias(f"{x}\u0001mean")]
    for x in categorical:
        aggs += [F.count(c(x)).alias(f"{x}\u0001nn")]
    wide = df.agg(*aggs)
    for x, n in distinct_counts(df, categorical).items() if categorical else ():
        wide = wide.withColumn(f"{x}\u0001nd", F.lit(n).cast("long"))
    rows = []
    for x in numeric:
        nn, sd, mean = (F.col(f"`{x}\u0001{s}`") for s in ("nn", "sd", "mean"))
        var = F.when(mean != 0, F.least(F.lit(1.0), sd / F.abs(mean))).otherwise(F.least(F.lit(1.0), sd))
        rows.append(F.struct(F.lit(x).alias("feature"), F.lit("numeric").alias("dtype"),
                             (1 - nn / F.col("_n")).alias("null_rate"), var.alias("variance_score")))
    for x in categorical:
        nn, nd = F.col(f"`{x}\u0001nn`"), F.col(f"`{x}\u0001nd`")
        ratio = F.when(nn > 0, nd / nn).otherwise(F.lit(0.0))
        var = (F.when((ratio > 0.95) & (nn > 50), F.lit(0.05)).when(ratio < 0.01, F.lit(0.05))
                .otherwise(F.least(F.lit(1.0), ratio * 5)))
        rows.append(F.struct(F.lit(x).alias("feature"), F.lit("categorical").alias("dtype"),
                             (1 - nn / F.col("_n")).alias("null_rate"), var.alias("variance_score")))
    stats = wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    stats = stats.select("feature", "dtype", _r(F.col("null_rate"), 4).alias("null_rate"),
                         _r(1 - F.col("null_rate"), 4).alias("null_score"),
                         _r(F.col("variance_score"), 4).alias("variance_score"))
    j = stats.join(mi.select("feature", "mi"), "feature", "left")
    mx = mi.agg(F.max("mi").alias("_mx"))
    j = with_scalar(j, mx).withColumn(
        "mi_norm", _r(F.when(F.col("_mx") > 0, F.coalesce("mi", F.lit(0.0)) / F.col("_mx")).otherwise(0.0), 4))
    comp = _r(0.10 * F.col("null_score") + 0.15 * F.col("variance_score") + 0.75 * F.col("mi_norm"), 4)
    j = j.withColumn("composite", comp).drop("_mx")
    return j.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("composite"), "feature")).cast("bigint"))


def group_comparison(df: DataFrame, cols: list[str], flag: Column, corr: DataFrame | None = None,
                     mi: DataFrame | None = None) -> DataFrame:
    """Target-group vs rest mean / exact median per feature, difference,
    pct change (``+1e-10``), joined with correlation and MI when given."""
    t = tall(df.withColumn("_g", flag.cast("int")), cols, ["_g"])
    means = t.groupBy("feature").agg(
        F.avg(F.when(F.col("_g") == 1, F.col("value"))).alias("target_mean"),
        F.avg(F.when(F.col("_g") == 0, F.col("value"))).alias("rest_mean"))
    med = exact_quantiles(t.where(F.col("_g").isNotNull()), "value", [0.5], by=["feature", "_g"])
    medw = med.groupBy("feature").agg(
        F.max(F.when(F.col("_g") == 1, F.col("value"))).alias("target_median"),
        F.max(F.when(F.col("_g") == 0, F.col("value"))).alias("rest_median"))
    out = means.join(medw, "feature", "left").select(
        "feature", _r(F.col("target_mean")).alias("target_mean"), _r(F.col("rest_mean")).alias("rest_mean"),
        _r(F.col("target_median")).alias("target_median"), _r(F.col("rest_median")).alias("rest_median"),
        _r(F.col("target_mean") - F.col("rest_mean")).alias("difference"),
        _r((F.col("target_mean") - F.col("rest_mean")) / (F.col("rest_mean") + F.lit(1e-10)) * 100, 4)
        .alias("pct_change"))
    if corr is not None:
        out = out.join(corr.select("feature", "corr"), "feature", "left")
    if mi is not None:
        out = out.join(mi.select("feature", "mi"), "feature", "left")
    return out


def importance_join(corr: DataFrame, mi: DataFrame, k: int = 5) -> DataFrame:
    """Correlation x MI per feature, the union of the top-k by each."""
    j = corr.select("feature", "abs_corr").join(mi.select("feature", "mi"), "feature")
    j = (j.withColumn("corr_rank", F.row_number().over(Window.orderBy(F.desc("abs_corr"), "feature")))
          .withColumn("mi_rank", F.row_number().over(Window.orderBy(F.desc("mi"), "feature"))))
    return j.where((F.col("corr_rank") <= k) | (F.col("mi_rank") <= k)).select(
        "feature", "abs_corr", "mi", F.col("corr_rank").cast("bigint"), F.col("mi_rank").cast("bigint"))


def table_summary(df: DataFrame, sums: list[str] = (), ranges: list[str] = (), distinct: list[str] = (),
                  sum_scale: int = 2) -> DataFrame:
    """Row count, sums, min/max in one aggregate, all distinct counts in one more pass.

    Sums run in fixed-point decimal (``sum_scale`` digits), so the result does
    not depend on the order partitions are combined in."""
    out = df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.sum(c(x).cast(f"decimal(18,{sum_scale})")).cast("double").alias(f"sum_{x}") for x in sums],
                  *[F.min(c(x)).alias(f"min_{x}") for x in ranges],
                  *[F.max(c(x)).alias(f"max_{x}") for x in ranges])
    for x, n in distinct_counts(df, list(distinct)).items() if distinct else ():
        out = out.withColumn(f"distinct_{x}", F.lit(n).cast("long"))
    return out


def class_coverage(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows per split and class, share within split, and '1 in k'."""
    counts = df.groupBy(c(split).alias("split"), c(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("split")
    tot = F.sum("n").over(w)
    return counts.select("split", "label", "n", _r(F.col("n") / tot).alias("share"),
                         _r(tot / F.col("n"), 2).alias("one_in"))


def subgroup_rates(df: DataFrame, flags: dict[str, Column], outcome: Column) -> DataFrame:
    """For each 0/1 flag, outcome rate inside the subgroup vs overall."""
    aggs = [F.avg(outcome.cast("double")).alias("_overall")]
    for n, f in flags.items():
        aggs += [F.count(F.when(f, 1)).alias(f"{n}\u0001n"),
                 F.avg(F.when(f, outcome.cast("double"))).alias(f"{n}\u0001rate")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("subgroup"), F.col(f"`{n}\u0001n`").alias("n"),
                     F.col(f"`{n}\u0001rate`").alias("rate")) for n in flags]
    t = wide.select("_overall", F.explode(F.array(*rows)).alias("s")).select("_overall", "s.*")
    return t.select("subgroup", "n", _r(F.col("rate")).alias("rate"), _r(F.col("_overall")).alias("overall_rate"),
                    _r(F.col("rate") / F.col("_overall"), 4).alias("relative_risk"))


def histogram(df: DataFrame, col: str, lo: float, hi: float, n_bins: int) -> DataFrame:
    """Equal-width bins over [lo, hi]; the top edge falls in the last bin,
    values outside are clamped."""
    w = (hi - lo) / n_bins
    b = F.least(F.greatest(F.floor((c(col) - F.lit(lo)) / F.lit(w)), F.lit(0)), F.lit(n_bins - 1)).cast("bigint")
    return (df.where(c(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
              .select("bin", _r(F.lit(lo) + F.col("bin") * F.lit(w)).alias("bin_start"), "n"))
