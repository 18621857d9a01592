import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from strataflow.operators import boosting as BT
from strataflow.operators import models as J


def sample(spark, n=900, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[:, 3] = rng.integers(0, 3, n)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.4 * rng.normal(size=n) > 1.2, 2, (x[:, 3] + rng.normal(size=n) > 1).astype(int))
    rows = [(i, "val" if i % 4 == 0 else "train", int(y[i]), x[i].tolist(), float(1 + i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, split string, label int, features array<double>, own double").repartition(3)


@pytest.mark.parametrize("weight", ["own", "weight", None])
def test_trees_equal_those_of_mllib(spark, weight):
    """Of a table that MLlib takes whole for its bins: the same trees, weights and places to stop."""
    df = sample(spark)
    got = J.train_trees(df, 3, max_iter=6, max_depth=3, seed=1, weight=weight)
    train = df.where("split = 'train'")
    n = {r[0]: r[1] for r in train.groupBy("label").count().collect()}
    by_class = F.create_map(*[F.lit(v) for c in n for v in (c, train.count() / (3 * n[c]))])
    d = df.select(array_to_vector("features").alias("v"), "label", "own", by_class[F.col("label")].alias("weight"), (F.col("split") == "val").alias("val"))
    for k, mine in enumerate(got.models):
        gbt = GBTClassifier(featuresCol="v", labelCol="y", maxIter=6, maxDepth=3, seed=1, validationIndicatorCol="val", validationTol=0.01)
        want = (gbt.setWeightCol(weight) if weight else gbt).fit(d.withColumn("y", (F.col("label") == k).cast("double")))
        assert mine.treeWeights == want.treeWeights and mine.getNumTrees == want.getNumTrees
        assert mine.featuresCol.name == "featuresCol" and np.allclose(mine.featureImportances.toArray(), want.featureImportances.toArray())
        for a, b in zip(mine.trees, want.trees, strict=True):
            mask = [[w if not w[-1:].isdigit() else f"{float(w):.9g}" for w in t.toDebugString.replace(")", " ").split()[7:]] for t in (a, b)]
            assert mask[0] == mask[1] and a.numNodes == b.numNodes > 1


def test_a_level_of_all_classes_is_one_pass_over_bytes(spark, monkeypatch):
    passes, one = [], BT._pass
    monkeypatch.setattr(BT, "_pass", lambda *a: (passes.append(sorted(a[4])), one(*a))[1])
    written, keep = [], BT.materialize
    monkeypatch.setattr(BT, "materialize", lambda d: (written.append(d.dtypes), keep(d))[1])
    m = J.train_trees(sample(spark), 3, max_iter=2, max_depth=3)
    assert passes[:3] == [[0, 1, 2]] * 3 and len(passes) == 2 * 3 + 1
    assert written == [[(c, "binary") for c in ("x", "y", "val", "w")]]
    assert all(1 <= x.getNumTrees <= 2 for x in m.models)


def test_rows_that_cannot_be_fitted(spark):
    for bad in ((None, [1.0, 2.0]), (1, None), (1, [1.0]), (1, [float("nan"), 1.0])):
        df = spark.createDataFrame([("train", i % 2, [float(i), 1.0]) for i in range(6)] + [("train", *bad)],
                                   "split string, label int, features array<double>")
        with pytest.raises(Exception):  # noqa: B017, PT011 - of the driver or of a task
            J.train_trees(df, 2)
    with pytest.raises(ValueError):
        J.train_trees(df.where("split = 'val'"), 2)


def test_bounds():
    assert BT.thresholds(np.array([3.0, 1.0, 1.0]), np.ones(3), 32).tolist() == [2.0]
    assert BT.thresholds(np.zeros(4), np.ones(4), 32).tolist() == []
    assert BT.thresholds(np.arange(8.0), np.ones(8), 4).tolist() == [1.5, 3.5, 5.5]
