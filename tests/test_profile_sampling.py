import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.functions import ranking
from strataflow.functions.ranking import exact_quantiles, global_rank
from strataflow.operators import features as FE
from strataflow.operators import imbalance as H
from strataflow.operators import profile as D
from strataflow.operators import sampling as E


@pytest.mark.parametrize("ranges", [1200, 1, None])  # very many ranges, one, as many as the session has
def test_exact_quantiles_match_numpy(spark, ranges):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(size=500).round(2), np.full(300, 1.5)])  # heavy tie
    groups = rng.integers(0, 3, size=len(vals))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, v double")
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "v", [0.1, 0.5, 0.95], by="g", ranges=ranges).collect()}
    for g in range(3):
        for q in (0.1, 0.5, 0.95):
            assert got[(g, q)] == pytest.approx(np.quantile(vals[groups == g], q), abs=1e-9)


def test_global_rank_equals_row_number(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(i % 3), float(x), int(i)) for i, x in enumerate(rng.normal(size=400))],
                               "g int, x double, id int")
    r = global_rank(df, ["x", "id"], by="g", ranges=9).collect()
    for g in range(3):
        rows = sorted([(x["x"], x["id"], x["rank"]) for x in r if x["g"] == g])
        assert [t[2] for t in rows] == list(range(1, len(rows) + 1))


def test_null_profile_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    rows = {r["column_name"]: r for r in D.null_profile(df).collect()}
    assert list(rows) == ["b"] and rows["b"]["null_rate"] == 1.0


def test_mode_tie_smallest_and_zero_variance(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "v string")
    assert FE.fit_mode(df, ["v"]).first()["mode"] == "a"
    z = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert FE.fit_scale(z, ["x"]).first()["scale"] == 1.0


def test_unseen_category_and_leakage(spark):
    tr = spark.createDataFrame([("x",), ("y",)], "c string")
    cats = FE.fit_categories(tr, ["c"])
    out = FE.apply_categories(spark.createDataFrame([("y",), ("z",), (None,)], "c string"), ["c"], cats, "k_")
    assert sorted([r["k_c"] for r in out.collect()]) == [-1, -1, 1]
    from strataflow.config import records_feature_config
    cfg = records_feature_config()
    cfg.numeric = cfg.numeric + ["n_harmed"]
    with pytest.raises(FE.LeakageError):
        FE.prepare(spark.createDataFrame([(1,)], "n_harmed int"), cfg)


def test_value_counts_fixed_order_keeps_zero(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    r = {x["value"]: x["n"] for x in D.value_counts(df, "v", order=["a", "b", "c"]).collect()}
    assert r == {"a": 2, "b": 1, "c": 0}


def test_stratified_split_sizes_and_determinism(spark):
    rows = [(f"k{i}", 0 if i < 700 else (1 if i < 950 else 2)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, label int")
    s1 = E.stratified_split(df, "label", "k", 0.2, 0.2, seed=42)
    counts = {(r["split"], r["label"]): r["count"] for r in s1.groupBy("split", "label").count().collect()}
    assert sum(v for (s, _), v in counts.items() if s == "test") == 200
    assert sum(v for (s, _), v in counts.items() if s == "val") == 200
    assert counts[("test", 0)] == 140 and counts[("test", 1)] == 50 and counts[("test", 2)] == 10
    s2 = E.stratified_split(df, "label", "k", 0.2, 0.2, seed=42)
    a = {r["k"]: r["split"] for r in s1.collect()}
    b = {r["k"]: r["split"] for r in s2.collect()}
    assert a == b


def test_hash_sample_and_resample(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(300)], "k int, label int")
    assert E.hash_sample(df, 50, "k").count() == 50
    assert E.hash_sample(df, 500, "k").count() == 300
    w = df.withColumn("w", F.when(F.col("label") == 1, 3.0).otherwise(1.0))
    rs = E.balanced_resample(w, F.col("w"), 400, "k")
    by = {r["label"]: r["count"] for r in rs.groupBy("label").count().collect()}
    # 150 rows of weight 3 have exactly 2 copies; of 150 rows of weight 1 each has one with chance 2/3
    assert by[1] == 300 and abs(by[0] - 100) <= 3 * (150 * 2 / 3 * 1 / 3) ** 0.5


def test_synthetic_count_formula_and_guard(spark):
    y = [2] * 10 + [0] * 100 + [1] * 90
    df = spark.createDataFrame([(i, v) for i, v in enumerate(y)], "k int, label int")
    assert H.synthetic_count(df, "label", 2, 0.15).first()["n_synthetic"] == 24
    few = spark.createDataFrame([(i, 2 if i < 5 else 0) for i in range(50)], "k int, label int")
    with pytest.raises(Exception, match="fewer than 10"):
        H.synthetic_count(few, "label", 2, 0.15).collect()


def test_augment_keeps_originals_and_reaches_ratio(spark):
    rng = np.random.default_rng(3)
    y = [2] * 10 + [0] * 100 + [1] * 90
    rows = [(i, [float(v) for v in rng.normal(size=8)], lab) for i, lab in enumerate(y)]
    df = spark.createDataFrame(rows, "k long, x array<double>, label int")
    aug = H.augment_minority(df, "label", "x", 2, 0.15, seed=1, key="k")
    rep = H.augment_report(aug, "label", 2).first()
    assert rep["n_synthetic"] == 24 and rep["ratio_after"] >= 0.15
    orig = aug.where(~F.col("is_synthetic")).orderBy("k").collect()
    assert [r["x"] for r in orig] == [r[1] for r in rows]


def test_samples_of_a_split_are_not_biased(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    train = E.stratified_split(rows, "y", "k").where("split = 'train'")
    for seed in (42, 43, 44):
        share = E.hash_sample(train, 1000, "k", seed).agg(F.avg("y")).first()[0]
        assert abs(share - 0.2) < 2 * (0.2 * 0.8 / 1000) ** 0.5 + 1e-9
        u = E.hash_sample(train, 1000, "k", seed).select(E.hash_uniform("copies", F.col("k"), seed).alias("u"))
        assert abs(u.agg(F.avg("u")).first()[0] - 0.5) < 0.04


def test_split_sizes_are_exact_and_need_no_shuffle_of_the_rows(spark):
    rows = spark.range(5003).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("y"),
                                    F.lit("wide").alias("other"))
    out = E.stratified_split(rows, "y", "k")
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert n == {"test": 1001, "val": 1001, "train": 3001}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    one_key = spark.createDataFrame([("same", 1)] * 3000, "k string, y int")
    assert E.stratified_split(one_key, "y", "k").select("split").distinct().count() == 1


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert D.null_profile(df).first()["n_null"] == 2
    d = D.describe_exact(df, ["x"]).first()
    assert (d["count"], d["mean"], d["q75"]) == (2, 2.0, 2.5)


def test_pairwise_correlation_equals_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3)) + [0, 1e6, -5]
    x[:, 2] += 0.5 * x[:, 0]
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    got = D.pairwise_correlation(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
    for i in range(3):
        for j in range(3):
            both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
            assert abs(got[i, j] - np.corrcoef(both.T)[0, 1]) < 1e-9


@pytest.mark.parametrize("ranges", [1200, None])
def test_cumulative_counts_of_null_groups_and_both_orders(spark, ranges):
    rows = [(g, float(v % 7)) for g in ("a", None) for v in range(40)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for descending in (False, True):
        got = ranking.value_counts_cumulative(df, "v", by="g", descending=descending, ranges=ranges).collect()
        assert len(got) == 14
        for r in got:
            values = [v % 7 for v in range(40)]
            upto = sum(v >= r.v if descending else v <= r.v for v in values)
            assert (r.n_cum, r.n_before, r.n_total) == (upto, upto - values.count(r.v), 40)


def test_key_at_rank_with_ties_and_nulls(spark):
    rows = [(None, i) for i in range(5)] + [(1.0, i) for i in range(3000)] + [(float(i), i) for i in range(2, 500)]
    df = spark.createDataFrame(rows, "x double, id int").repartition(6)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0.0, r[1]))
    for rank in (1, 5, 6, 1500, 3005, 3006, len(rows)):
        assert tuple(ranking.key_at_rank(df, ["x", "id"], rank)) == ordered[rank - 1]
    assert ranking.key_at_rank(df, ["x", "id"], 0) is None
    held = E.ordered_holdout(df, ["x", "id"], 0.9).where("holdout").count()
    assert held == len(rows) - int(0.9 * len(rows))


def test_cutoffs_where_a_prefix_holds_many_rows(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL", 3)
    monkeypatch.setattr(ranking, "DIGITS", 1)
    df = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("y"))
    got = {r["k"]: r["split"] for r in E.stratified_split(df, "y", "k").collect()}
    monkeypatch.undo()
    assert got == {r["k"]: r["split"] for r in E.stratified_split(df, "y", "k").collect()}
    ranked = df.withColumn("h", ranking.hash_hex("split", F.col("k"), 42)).collect()
    for y in range(3):
        order = [r["k"] for r in sorted((r for r in ranked if r["y"] == y), key=lambda r: r["h"])]
        splits = [got[k] for k in order]
        assert splits == sorted(splits, key=["test", "val", "train"].index)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_means_do_not_depend_on_the_layout(spark, parts):
    df = spark.range(60_000).select((F.col("id") % 11 / 100).alias("x"), (F.col("id") % 3).alias("g")).repartition(parts)
    d = D.describe_exact(df, ["x"]).first()
    total = sum(i % 11 for i in range(60_000))
    assert d["mean"] == total / 100 / 60_000 and d["count"] == 60_000
    sizes = {r["key"]: r["mean_x"] for r in D.group_means(df, "g", ["x"]).collect()}
    assert sizes == {g: sum(i % 11 for i in range(g, 60_000, 3)) / 100 / 20_000 for g in range(3)}


def test_describe_of_other_numbers(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=400) * 1e-13, [1e18, -3e17]])
    df = spark.createDataFrame([(float(v), None) for v in x], "x double, none double")
    d = {r["feature"]: r for r in D.describe_exact(df, ["x", "none"]).collect()}
    assert d["x"]["mean"] == pytest.approx(x.mean()) and d["x"]["std"] == pytest.approx(x.std(ddof=1))
    assert d["none"]["count"] == 0 and d["none"]["mean"] is None
