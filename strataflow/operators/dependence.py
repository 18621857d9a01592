"""Partial dependence (how the mean output moves with one feature) without multiplying the data by the grid.

A tree is descended once by each row with one feature ignored: at its splits
the row goes to both sides.  The rows that reach each leaf, and the range of
the ignored feature that leads to it, give the mean output at every value.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.training import log_softmax
from strataflow.session import scratch_path

STRIP = 4096


@dataclass
class Tree:
    """Arrays over nodes, the root first: ``feature`` (-1 in a leaf), ``threshold`` (left if at most), ``left``, ``right``, ``value``."""

    weight: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves_without(self, j: int) -> list[tuple[int, float, float, list[tuple[int, float, bool]]]]:
        """``leaf, low, high, conditions``: the range of feature ``j`` that leads to each leaf, and the other splits on the
        way as (feature, threshold, left)."""
        out, stack = [], [(0, -np.inf, np.inf, [])]
        while stack:
            node, low, high, way = stack.pop()
            f, t = int(self.feature[node]), float(self.threshold[node])
            if f < 0:
                out.append((node, low, high, way))
            elif f == j:
                stack.append((int(self.left[node]), low, min(high, t), way))
                stack.append((int(self.right[node]), max(low, t), high, way))
            else:
                stack.append((int(self.left[node]), low, high, [*way, (f, t, True)]))
                stack.append((int(self.right[node]), low, high, [*way, (f, t, False)]))
        return [x for x in out if x[1] < x[2]]


def trees_of(spark: SparkSession, model) -> list[Tree]:
    """The trees of a fitted boosted model of two classes, whose weighted sum is its margin (continuous splits only)."""
    path = scratch_path(spark, f"trees-{model.uid}-{np.random.default_rng().integers(1 << 62)}")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # bounded by depth and number of trees
    trees = []
    for number, weight in enumerate(model.treeWeights):
        nodes = sorted((r for r in rows if r["treeID"] == number), key=lambda r: r["id"])
        at = {r["id"]: i for i, r in enumerate(nodes)}
        inner = [r["leftChild"] >= 0 for r in nodes]
        if any(i and r["split"]["numCategories"] > 0 for r, i in zip(nodes, inner, strict=True)):
            raise ValueError("categorical splits have no order to follow")
        trees.append(Tree(
            weight, np.array([r["split"]["featureIndex"] if i else -1 for r, i in zip(nodes, inner, strict=True)]),
            np.array([r["split"]["leftCategoriesOrThreshold"][0] if i else 0.0 for r, i in zip(nodes, inner, strict=True)]),
            np.array([at.get(r["leftChild"], -1) for r in nodes]), np.array([at.get(r["rightChild"], -1) for r in nodes]),
            np.array([r["prediction"] for r in nodes])))
    return trees


def _vectors(df: DataFrame, features: str, size: int) -> DataFrame:
    x = F.col(features).cast("array<double>")
    whole = (F.size(x) == size) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v))
    return df.where(F.coalesce(whole, F.lit(False))).select(x.alias("x"))


def _totals(df: DataFrame, size: int, n: int, part) -> np.ndarray:
    """The sum of ``part(x)`` (``n`` numbers) over all batches, in one aggregate."""
    def run(batches):
        total = np.zeros(n)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for at in range(0, len(x), STRIP):
                total += part(x[at:at + STRIP])
        yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array(total)], ["pos", "value"])

    got = df.mapInArrow(run, "pos int, value double").groupBy("pos").agg(F.sum("value").alias("s")).collect()
    flat = np.zeros(n)
    for r in got:
        flat[r["pos"]] = r["s"]
    return flat


def tree_dependence(df: DataFrame, trees: list[Tree], grid: dict[int, list[float]], size: int, features: str = "features") -> DataFrame:
    """``feature, value, mean_output``: the trees' mean weighted sum over all rows, with each feature of ``grid`` set to
    each of its values in turn.

    One pass: every row descends every tree once for each feature, on both sides of that feature's splits.  Rows with
    an incomplete vector take no part; without rows the means are null.
    """
    ways = {j: [leaf for tree in trees for leaf in tree.leaves_without(j)] for j in grid}
    n = sum(map(len, ways.values())) + 1

    def reached(x):
        counts, at = np.empty(n), 0
        split: dict[tuple[int, float], np.ndarray] = {}
        for leaves in ways.values():
            for _, _, _, way in leaves:
                on = np.ones(len(x), dtype=bool)
                for f, t, left in way:
                    if (f, t) not in split:
                        split[f, t] = x[:, f] <= t
                    on = on & (split[f, t] if left else ~split[f, t])
                counts[at] = on.sum()
                at += 1
        counts[-1] = len(x)
        return counts

    total = _totals(_vectors(df, features, size), size, n, reached)
    rows, at = [], 0
    for j, values in grid.items():
        leaves = [(tree, leaf) for tree in trees for leaf in tree.leaves_without(j)]
        weight = np.array([tree.weight * tree.value[leaf[0]] for tree, leaf in leaves]) * total[at:at + len(leaves)]
        low, high = (np.array([leaf[k] for _, leaf in leaves]) for k in (1, 2))
        for v in values:
            inside = (low < v) & (v <= high)
            rows.append((j, float(v), float(weight[inside].sum() / total[-1]) if total[-1] else None))
        at += len(leaves)
    return df.sparkSession.createDataFrame(rows, "feature int, value double, mean_output double")


def logistic_dependence(df: DataFrame, coef: np.ndarray, grid: dict[int, list[float]], features: str = "features") -> DataFrame:
    """``feature, value, class, mean_prob`` of a logistic model (``coef``: size + 1 rows, the intercepts last, a column a class).

    The scores of a row are taken once and moved by each feature's own term, batch by batch; the data is read once.
    Rows with an incomplete vector take no part; without rows the means are null.
    """
    size, k = coef.shape[0] - 1, coef.shape[1]
    points = [(j, float(v)) for j, values in grid.items() for v in values]

    def means(x):
        z = x @ coef[:-1] + coef[-1]
        sums = [np.exp(log_softmax(z + (v - x[:, j])[:, None] * coef[j][None])).sum(axis=0) for j, v in points]
        return np.concatenate([*sums, [len(x)]]) if len(x) else np.zeros(len(points) * k + 1)

    total = _totals(_vectors(df, features, size), size, len(points) * k + 1, means)
    rows = [(j, v, c, float(total[i * k + c] / total[-1]) if total[-1] else None)
            for i, (j, v) in enumerate(points) for c in range(k)]
    return df.sparkSession.createDataFrame(rows, "feature int, value double, class int, mean_prob double")
