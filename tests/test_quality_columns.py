import math

import pytest
from pyspark.sql import functions as F

from strataflow.config import CRASH_CONTRACT, RECORDS_CONTRACT, SEVERITY_CODES
from strataflow.functions import columns as B
from strataflow.operators import quality as Q


def test_golden_suite_counts():
    rules = Q.build_suite(CRASH_CONTRACT)
    kinds = [r.kind for r in rules]
    assert len(rules) == 56
    assert kinds.count("not_null") == 28 and kinds.count("between") == 10 and kinds.count("in_set") == 18
    sentinel_ranges = [r for r in rules if r.kind == "between" and r.sentinels]
    assert len(sentinel_ranges) == 4
    strict = [r for r in rules if r.kind == "between" and not r.sentinels]
    assert all(r.mostly == 1.0 for r in strict)


def _speed_frame(spark, bad):
    rows = [(i, 500 if i < bad else 25 + i % 40) for i in range(200)]
    return spark.createDataFrame(rows, "id int, SPEEDLIMIT int")


def test_clean_passes_corrupt_fails(spark):
    contract = {"SPEEDLIMIT": CRASH_CONTRACT["SPEEDLIMIT"]}
    ok = Q.assert_valid(Q.validate_table(_speed_frame(spark, 0), contract))
    assert ok["success"]
    with pytest.raises(Q.ValidationError, match=r"between \[SPEEDLIMIT\]"):
        Q.assert_valid(Q.validate_table(_speed_frame(spark, 10), contract))


def test_empty_and_missing_column(spark):
    empty = spark.createDataFrame([], "SPEEDLIMIT int")
    with pytest.raises(Q.ValidationError, match="empty"):
        Q.assert_valid(Q.validate_table(empty, {"SPEEDLIMIT": CRASH_CONTRACT["SPEEDLIMIT"]}))
    with pytest.raises(Q.ValidationError, match="missing"):
        Q.validate_table(_speed_frame(spark, 0), {"HOUR": CRASH_CONTRACT["HOUR"]})


def test_sentinel_rows_excluded_and_mostly(spark):
    rows = [(99,)] * 5 + [(10,)] * 95
    df = spark.createDataFrame(rows, "HOUR int")
    r = Q.validate_table(df, {"HOUR": CRASH_CONTRACT["HOUR"]}).where("rule = 'between'").first()
    assert r["n_checked"] == 95 and r["n_ok"] == 95 and r["success"]


def test_one_aggregate_plan(spark, sf_dir):
    from strataflow.sources.tables import tables
    res = Q.validate_table(tables(spark, sf_dir).records(), RECORDS_CONTRACT)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1  # whole suite from one scan


def test_flags_and_cyclical(spark):
    df = spark.createDataFrame([(1, 50, 20), (2, 50, None), (1, 30, 80)],
                               "veh int, speed int, age int")
    out = B.interaction_flags(df, "veh", "speed", "age")
    assert "veh" not in out.columns
    rows = out.collect()
    assert [r["solo_highspeed"] for r in rows] == [1, 0, 0]
    assert [r["vulnerability_interaction"] for r in rows] == [1, 0, 0]
    cyc = B.cyclical_encode(spark.createDataFrame([(6,), (None,)], "h int"), "h", 24).collect()
    assert math.isclose(cyc[0]["h_sin"], 1.0) and abs(cyc[0]["h_cos"]) < 1e-12
    assert cyc[1]["h_sin"] is None


def test_unmapped_label_raises(spark):
    df = spark.createDataFrame([("Fatal",), ("Unknown",)], "sev string")
    with pytest.raises(Exception, match="unmapped target value"):
        B.encode_label(df, "sev", SEVERITY_CODES).collect()


def test_bucket_right_closed(spark):
    df = spark.createDataFrame([(25,), (26,), (15,)], "a int")
    got = [r[0] for r in df.select(B.bucket_label(F.col("a"), [15, 25, 35])).collect()]
    assert got == ["(15, 25]", "(25, 35]", None]


def test_safe_corr_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x double, y double")
    assert df.agg(B.safe_corr(F.col("x"), F.col("y"))).first()[0] is None
