"""with_vectors: new columns of vectors, the other columns untouched and not sent to Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.functions.arrow import with_vectors


def _df(spark, n=25):
    return spark.createDataFrame([(i, f"r{i}", [float(i), None if i == 3 else -1.0 * i], None) for i in range(n)],
                                 "i int, `a.b` string, v array<double>, none string").repartition(3)


def test_one_and_two_columns(spark):
    df = _df(spark)
    one = {r["i"]: r for r in with_vectors(df, "v", ["w"], lambda x: [x * 2]).collect()}
    assert [one[i]["w"] for i in (0, 5)] == [[0.0, -0.0], [10.0, -10.0]] and one[5]["a.b"] == "r5" and one[5]["v"] == [5.0, -5.0]
    assert one[3]["w"][0] == 6.0 and np.isnan(one[3]["w"][1])  # a null entry counts as NaN
    two = with_vectors(df, "v", ["s", "t"], lambda x: [x.sum(axis=1, keepdims=True), x - 1])
    assert two.columns == ["i", "a.b", "v", "none", "s", "t"]
    got = {r["i"]: r for r in two.collect()}
    assert len(got) == 25 and got[7]["s"] == [0.0] and got[7]["t"] == [6.0, -8.0]


def test_only_the_vectors_go_to_python(spark):
    """Before, a batch held every column, there and back."""
    scored = with_vectors(_df(spark), "v", ["w"], lambda x: [x]).select("i", "w")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan


def test_computed_once_for_a_filter(spark):
    scored = with_vectors(_df(spark), "v", ["w"], lambda x: [x]).where(F.col("w")[0] > 3)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert scored.count() == 21


def test_no_rows_and_bad_vectors(spark):
    assert with_vectors(_df(spark).where("i < 0"), "v", ["w"], lambda x: [x @ np.ones((2, 1))]).collect() == []
    from pyspark.errors import PythonException
    with pytest.raises(PythonException, match="missing or differ"):
        with_vectors(spark.createDataFrame([([1.0],), (None,)], "v array<double>").coalesce(1), "v", ["w"], lambda x: [x]).collect()
