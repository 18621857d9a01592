"""The forest on binned rows against brute force and MLlib, odd input, and what it keeps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import forest as FO
from strataflow.operators import selection as G


def _rows(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 3] = rng.integers(0, 4, n)
    y = (x[:, 0] + 0.6 * x[:, 1] + 0.3 * x[:, 3] + 0.3 * rng.normal(size=n) > 0.8).astype(int) + (x[:, 0] > 1.5)
    return [(*map(float, a), int(b)) for a, b in zip(x, y)]


SCHEMA = "a double, b double, c double, d double, e double, y int"
FEATURES = ["a", "b", "c", "d", "e"]


def _table(data):
    """Bins (rows x features), labels and (block, place) of all rows of the blocks."""
    xs, ys, at = [], [], []
    for r in data.blocks.collect():
        y = np.frombuffer(r["y"], np.uint8)
        xs.append(np.frombuffer(r["x"], np.uint8).reshape(-1, len(y)).T)
        ys.append(y)
        at.append((r["block"], len(y)))
    return np.concatenate(xs), np.concatenate(ys), at


def test_importances_like_mllib(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame(_rows(), SCHEMA)
    data = FO.binned(df, FEATURES, "y")
    own = FO.forest_importances(data, FEATURES)
    assert np.array_equal(own, FO.forest_importances(data, FEATURES))  # the same draws each time
    data.blocks.unpersist()
    rf = RandomForestClassifier(featuresCol="v", labelCol="y", numTrees=100, maxDepth=5, seed=0)
    theirs = rf.fit(VectorAssembler(inputCols=FEATURES, outputCol="v").transform(df)).featureImportances.toArray()
    assert np.abs(own - theirs).max() < 0.03
    assert list(np.argsort(own)[2:]) == list(np.argsort(theirs)[2:])


def test_one_tree_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(FO, "STRIP", 100)  # many blocks
    df = spark.createDataFrame(_rows(700), SCHEMA).repartition(3)
    data = FO.binned(df, ["a", "b"], "y")
    x, y, at = _table(data)
    w = np.concatenate([FO.bootstrap(5, block, 0, n) for block, n in at]).astype(float)
    assert len(y) == 700 and len(at) > 3

    def gini(rows):
        n = np.bincount(y[rows], w[rows], 3)
        return n.sum(), 1 - ((n / max(n.sum(), 1)) ** 2).sum(), int(n.argmax())

    def grown(rows, depth):
        """Of a subtree with both features tried at each node: its gains by feature, and the class if it is a leaf."""
        n, g, best = gini(rows)
        found = (0.0, None, None)
        for f in range(2):
            for cut in range(31):
                left, right = rows & (x[:, f] <= cut), rows & (x[:, f] > cut)
                (n1, g1, _), (n2, g2, _) = gini(left), gini(right)
                if n1 and n2 and g - (n1 * g1 + n2 * g2) / n > found[0] + 1e-12:
                    found = (g - (n1 * g1 + n2 * g2) / n, f, (left, right))
        if depth == 0 or g == 0 or found[1] is None:
            return np.zeros(2), best
        (own1, leaf1), (own2, leaf2) = (grown(part, depth - 1) for part in found[2])
        if leaf1 is not None and leaf1 == leaf2:
            return np.zeros(2), best
        own = own1 + own2
        own[found[1]] += found[0] * n
        return own, None

    whole, _ = grown(np.ones(len(y), bool), 3)
    assert np.allclose(FO.forest_importances(data, ["a", "b"], 1, 3, 5), whole / whole.sum())
    data.blocks.unpersist()


def test_groups_of_trees_give_the_same(spark, monkeypatch):
    data = FO.binned(spark.createDataFrame(_rows(500), SCHEMA), FEATURES, "y")
    whole = FO.forest_importances(data, FEATURES, 5, 3)
    monkeypatch.setattr(FO, "SUMS", 1)  # a pass for each tree
    assert np.array_equal(whole, FO.forest_importances(data, FEATURES, 5, 3))
    data.blocks.unpersist()


def test_fill_and_edges(spark):
    rows = [(float(i), float(i % 3), None, float("nan") if i % 2 else 5.0) for i in range(101)] + [(None, None, None, None)] * 9
    fill, edges = FO.fill_and_edges(spark.createDataFrame(rows, "a double, b double, c double, d double"), ["a", "b", "c", "d"])
    assert fill == [50.0, 1.0, 0.0, 5.0]
    assert len(edges[0]) == FO.BINS - 1 and max(np.diff(edges[0])) <= 4
    assert [e.tolist() for e in edges[1:]] == [[0.0, 1.0], [], []]


def test_bootstrap_is_poisson():
    w = np.concatenate([FO.bootstrap(0, block, 7, 10_000) for block in range(20)])
    share = np.bincount(w, minlength=4)[:4] / len(w)
    assert np.abs(share - [0.36788, 0.36788, 0.18394, 0.06131]).max() < 0.005
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.03
    assert not np.array_equal(FO.bootstrap(0, 1, 7, 50), FO.bootstrap(0, 1, 8, 50))


def test_rfe_keeps_a_byte_a_feature(spark, monkeypatch):
    """Before, MLlib kept each row as objects with a number for each of 100 trees, and walked all of it 20 times."""
    kept, real = [], FO.binned
    monkeypatch.setattr(FO, "binned", lambda *a: kept.append(real(*a)) or kept[0])
    rows = _rows(1200)
    rows[:50] = [(None, float("nan"), *r[2:]) for r in rows[:50]]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("none", F.lit(None).cast("double"))
    got = {r["feature"]: r for r in G.select_rfe(df, [*FEATURES, "none"], "y", 2, n_trees=20).collect()}
    assert [f for f, r in got.items() if r["selected"]] == ["a", "b"]
    assert got["none"]["score"] is None and abs(sum(r["score"] or 0.0 for r in got.values()) - 1) < 1e-9
    sizes = kept[0].blocks.select(F.sum(F.length("x")).alias("x"), F.sum(F.length("y")).alias("y")).first()
    assert (sizes["x"], sizes["y"]) == (6 * 1200, 1200) and not kept[0].blocks.is_cached


def test_rfe_odd_input(spark):
    df = spark.createDataFrame(_rows(50), SCHEMA)
    whole = G.select_rfe(df, FEATURES, "y", 5).collect()
    assert all(r["selected"] and r["score"] is None for r in whole)
    for bad in (df.limit(0), df.withColumn("y", F.lit(0.5)), df.withColumn("y", F.lit(None).cast("int")), df.withColumn("y", F.lit(-1))):
        with pytest.raises(ValueError):
            G.select_rfe(bad, FEATURES, "y", 2)
    same = G.select_rfe(df.withColumn("y", F.lit(1)), FEATURES, "y", 4, n_trees=3).collect()  # one class: nothing to split
    assert sum(r["selected"] for r in same) == 4 and all(not r["score"] for r in same)
