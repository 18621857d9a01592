"""Boosted trees on binned rows (J1): one-vs-rest gradient boosting as MLlib's, all classes in the same passes.

Rows are packed to blocks of bin numbers, a byte a feature, and written once.
A level of the present tree of every class is one pass: each task takes its
rows' margins from the trees so far and adds up their residuals by class, node,
feature and bin; the driver, which holds nothing but trees and these sums, takes
the splits.  The pass for a tree's root also adds up the validation loss of the
trees before it.  Loss, residuals, bins, splits, stopping and pruning follow
``GBTClassifier``, and so do the models that come out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.arrow import matrix
from strataflow.session import materialize

STRIP = 1 << 14         # rows of a block
BINS = 32               # of a feature, and
SAMPLE = 10_000         # rows whose quantiles bound them, as in MLlib
STEP, TOL = 0.1, 0.01   # learning rate; share of the validation loss that a tree must take away
STATS = 4               # of a bin: weight, weighted sum of residuals and of their squares, rows
EPSILON = 2.0 ** -52


@dataclass
class Tree:
    """A tree in heap order (children of ``i`` at ``2 i + 1`` and ``2 i + 2``); rows of bins up to ``cut`` go left."""

    depth: int
    feature: np.ndarray = field(init=False)  # -1: a leaf
    cut: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    stats: np.ndarray = field(init=False)    # STATS of each node
    open: list = field(init=False)           # nodes that the next level may split

    def __post_init__(self):
        n = 2 ** (self.depth + 1) - 1
        self.feature, self.cut, self.gain = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n)
        self.stats, self.open = np.zeros((n, STATS)), [0]

    @property
    def value(self) -> np.ndarray:
        return self.stats[:, 1] / np.where(self.stats[:, 0] > 0, self.stats[:, 0], 1.0)

    def node(self, x: np.ndarray) -> np.ndarray:
        """Where each column of the bins ``x`` ends."""
        at, rows = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1])
        for _ in range(self.depth):
            f = self.feature[at]
            if (f < 0).all():
                break
            at = np.where(f < 0, at, 2 * at + 1 + (x[f, rows] > self.cut[at]))
        return at

    def split(self, sums: np.ndarray, sizes: list[int]) -> None:
        """Split the open nodes by their ``sums`` (node, feature, bin, STATS); children that may be split are open then."""
        going = []
        for i, s in zip(self.open, sums, strict=True):
            self.stats[i] = total = s[0].sum(axis=0)
            left = np.cumsum(s, axis=1)[:, :-1]
            right = np.cumsum(s[:, ::-1], axis=1)[:, ::-1][:, 1:]  # added, not subtracted: empty is 0
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - total[1] ** 2 / total[0]) / total[0]
            real = np.arange(gain.shape[1])[None] < np.array(sizes)[:, None]
            gain = np.where(real & (left[..., 3] > 0) & (right[..., 3] > 0) & np.isfinite(gain), gain, -np.inf)
            f, b = np.unravel_index(gain.argmax(), gain.shape) if gain.size else (0, 0)
            if not gain.size or gain[f, b] <= 0:
                continue
            self.feature[i], self.cut[i], self.gain[i] = f, b, gain[f, b]
            for child, part in ((2 * i + 1, left[f, b]), (2 * i + 2, right[f, b])):
                self.stats[child] = part
                if 2 * child + 2 < len(self.feature) and abs(impurity(part)) >= EPSILON:
                    going.append(child)
        self.open = going


def impurity(stats: np.ndarray) -> float:
    return float(stats[2] - stats[1] ** 2 / stats[0]) / float(stats[0]) if stats[0] > 0 else 0.0


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Up to ``bins - 1`` bounds halfway between neighbouring values, each where the weight of the values below comes
    next to a multiple of a ``bins``-th of all."""
    v, at = np.unique(values, return_inverse=True)
    w = np.bincount(at, weights)
    middles = (v[:-1] + v[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride, upto, found = w.sum() / bins, np.cumsum(w), []
    target = stride
    for i in range(1, len(v)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _residuals(first: bool, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return y if first else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def _loss(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 2.0 * np.logaddexp(0.0, -2.0 * y * margin)


def _bins(data: DataFrame, features: str, weigh: tuple, n: int, seed: int) -> list[np.ndarray]:
    """The bounds of each feature's bins, from about ``SAMPLE`` train rows."""
    rows = data.where(~F.col("_val"))
    rows = rows.sample(False, SAMPLE / n, seed) if n > SAMPLE else rows
    held = rows.select(features, "_y", "_w").toArrow()
    if not held.num_rows:  # a sample of so many rows
        return _bins(data, features, weigh, n, seed + 1)
    x, w = matrix(held.column(0).combine_chunks()), _weights(held, weigh)
    return [thresholds(c, w, min(BINS, n)) for c in x.T]


def _weights(batch, weigh: tuple) -> np.ndarray:
    return batch.column(2).to_numpy().astype(np.float64) if weigh is None else np.array(weigh)[batch.column(1).to_numpy()]


def fit_trees(data: DataFrame, n_classes: int, features: str, label: str, is_val: str, weight: str | None,
              class_weight: list[float] | None, max_iter: int, max_depth: int, seed: int) -> list:
    """A ``GBTClassificationModel`` of each class against the rest.

    ``is_val`` marks the rows whose loss ends the boosting.  Rows weigh as ``weight`` says, or else ``class_weight`` by
    their label.  Labels that are null (or without a class weight), vectors that are missing, unequal or not finite,
    negative weights and a table without train rows raise ValueError."""
    y = F.col(label)
    code = F.when(y.between(0, n_classes - 1), y).otherwise(n_classes).cast("int")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    odd = y.isNull() | (~y.between(0, n_classes - 1) if class_weight else F.lit(False)) | w.isNull() | F.isnan(w) | (w < 0)
    n, wrong = data.agg(F.count_if(~F.col(is_val)), F.count_if(odd)).first()
    if not n or wrong:
        raise ValueError(f"{n} train rows, {wrong} rows without a usable label or weight: no trees can be fitted")
    rows = data.select(F.col(features).cast("array<double>").alias("_x"), code.alias("_y"), w.alias("_w"), F.col(is_val).alias("_val"))
    weigh = tuple(class_weight) + (0.0,) if class_weight else None if weight else (1.0,) * (n_classes + 1)
    bounds = _bins(rows, "_x", weigh, n, seed)
    size, keeps = len(bounds), weigh is None

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                part = batch.slice(at, STRIP)
                x = matrix(part.column(0))
                if x.shape[1] != size or not np.isfinite(x).all():
                    raise ValueError("vectors differ in length or hold numbers that are not finite")
                bins = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(bounds, x.T, strict=True)]).astype(np.uint8)
                cells = [bins, part.column(1).to_numpy().astype(np.uint8), part.column(3).to_numpy(zero_copy_only=False).astype("?"),
                         part.column(2).to_numpy().astype("<f8") if keeps else np.zeros(0)]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], ["x", "y", "val", "w"])

    blocks = materialize(rows.mapInArrow(pack, "x binary, y binary, val binary, w binary"))
    kept: list[list[Tree]] = [[] for _ in range(n_classes)]
    best, count, sizes = [math.nan] * n_classes, [1] * n_classes, [len(b) for b in bounds]
    going = list(range(n_classes))
    for m in range(max_iter + 1):
        new = {k: Tree(max_depth) for k in going} if m < max_iter else {}
        for level in range(max_depth + 1):
            growing = {k: t for k, t in new.items() if t.open} if max_depth else {}
            if level and not growing:
                break
            asked = [k for k in going if k in growing or (m and not level)]
            if not asked:
                break
            sums, losses = _pass(blocks, size, weigh, kept, growing, asked, bool(m) and not level)
            for k, (loss, all_w) in losses.items():  # of the trees before this one
                now = loss / all_w if all_w else math.nan
                if m == 1:
                    best[k] = now
                elif best[k] - now < TOL * max(now, 0.01):
                    going.remove(k)
                    new.pop(k, None)
                elif now < best[k]:
                    best[k], count[k] = now, m
            for k in growing:
                if k in new:
                    new[k].split(sums[k], sizes)
        for k, tree in new.items():
            kept[k].append(tree)
        if not going:
            break
    return [_model(data.sparkSession, kept[k][:count[k]], bounds, size, max_iter, max_depth, seed) for k in range(n_classes)]


def _pass(blocks: DataFrame, size: int, weigh: tuple | None, kept: list[list[Tree]], growing: dict[int, Tree], asked: list[int],
          judged: bool) -> tuple[dict, dict]:
    """Of the classes asked for: the sums of the open nodes of those ``growing`` by feature and bin, and, if ``judged``, loss and
    weight of the validation rows under the trees kept."""
    width = size * BINS * STATS
    cells = sum(len(t.open) for t in growing.values()) * width
    n_numbers = cells + 2 * len(asked)

    def run(batches):
        total = np.zeros(n_numbers)
        for batch in batches:
            for xs, ys, vs, ws in zip(*(batch.column(i) for i in range(4)), strict=True):
                y, val = np.frombuffer(ys.as_buffer(), np.uint8), np.frombuffer(vs.as_buffer(), "?")
                x = np.frombuffer(xs.as_buffer(), np.uint8).reshape(size, len(y))
                w = np.frombuffer(ws.as_buffer(), "<f8") if weigh is None else np.array(weigh)[y]
                wide, at = x.astype(np.int64), 0
                for j, k in enumerate(asked):
                    sign, margin = np.where(y == k, 1.0, -1.0), np.zeros(len(y))
                    for i, tree in enumerate(kept[k]):
                        margin += (STEP if i else 1.0) * tree.value[tree.node(x)]
                    if judged and val.any():
                        total[cells + 2 * j] += float(w[val] @ _loss(margin[val], sign[val]))
                        total[cells + 2 * j + 1] += float(w[val].sum())
                    if k not in growing:
                        continue
                    tree = growing[k]
                    n_open = len(tree.open)
                    place = np.full(len(tree.feature), -1)
                    place[tree.open] = range(n_open)
                    mine = place[tree.node(x)]
                    rows = np.flatnonzero(~val & (mine >= 0))
                    r = _residuals(not kept[k], margin[rows], sign[rows])
                    start, wr = mine[rows] * BINS, w[rows] * r
                    numbers = (w[rows], wr, wr * r, None)
                    out = total[at:at + n_open * width].reshape(n_open, size, BINS, STATS)
                    for f in range(size):
                        cell = start + wide[f][rows]
                        for s, by in enumerate(numbers):
                            out[:, f, :, s] += np.bincount(cell, by, n_open * BINS).reshape(n_open, BINS)
                    at += n_open * width
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["pos", "value"])

    flat = np.zeros(n_numbers)
    for r in blocks.mapInArrow(run, "pos int, value double").groupBy("pos").agg(F.sum("value").alias("s")).collect():
        flat[r["pos"]] = r["s"]
    sums, at = {}, 0
    for k in (k for k in asked if k in growing):
        n_open = len(growing[k].open)
        sums[k] = flat[at:at + n_open * width].reshape(n_open, size, BINS, STATS)
        at += n_open * width
    return sums, {k: tuple(flat[cells + 2 * j:cells + 2 * j + 2]) for j, k in enumerate(asked)} if judged else {}


def _model(spark, trees: list[Tree], bounds: list[np.ndarray], size: int, max_iter: int, max_depth: int, seed: int):
    """The trees as a model of MLlib; leaves of one parent that predict the same are one, as MLlib prunes them."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    est = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=seed, validationTol=TOL)

    def node(tree: Tree, i: int):
        """The node, and its prediction if it is a leaf."""
        stats = gateway.new_array(jvm.double, 3)
        for j in range(3):
            stats[j] = float(tree.stats[i, j])
        calc = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(tree.stats[i, 3]))
        value, own = float(tree.value[i]), impurity(tree.stats[i])
        if tree.feature[i] >= 0:
            (left, a), (right, b) = node(tree, 2 * i + 1), node(tree, 2 * i + 2)
            if a is None or a != b:
                f = int(tree.feature[i])
                cut = ml.tree.ContinuousSplit(f, float(bounds[f][tree.cut[i]]))
                return ml.tree.InternalNode(value, own, float(tree.gain[i]), left, right, cut, calc), None
        return ml.tree.LeafNode(value, own, calc), value

    made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        made[i] = ml.regression.DecisionTreeRegressionModel(f"{est.uid}_tree{i}", node(tree, 0)[0], size)
        weights[i] = STEP if i else 1.0
    return est._copyValues(est._create_model(ml.classification.GBTClassificationModel(est.uid, made, weights, size, 2)))
