"""Random forests on binned rows (G3): bagged classification trees by the Gini impurity.

Rows are packed to blocks of bin numbers, a byte a feature, and kept once for
all forests over them.  A level of all trees is one pass: each task adds up the
weights of its rows by tree, node, feature, class and bin, the sums are added by
tree, and the driver, which holds nothing but trees and these sums, takes the
splits.  The bootstrap weight of a row is drawn anew in every pass, from the
number of its block and tree, so nothing is kept for a row and tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.ranking import column_counts, in_ranges, parts_of_counts, quantiles_of_counts

STRIP = 1 << 15        # rows of a block
BINS = 32              # of a feature, as in MLlib
CLASSES = 100          # most classes, as MLlib allows without metadata
SUMS = 64 << 20        # bytes of sums that a task holds; trees beyond take another pass
ROWS = 4_000_000       # rows of a partition of blocks, at most about

# a draw of 32 bits is a Poisson number of mean 1: how many of these it reaches
POISSON = np.array([math.floor(2 ** 32 * sum(math.exp(-1.0) / math.factorial(i) for i in range(k + 1))) for k in range(12)], np.uint32)


@dataclass
class Binned:
    """Blocks ``block, x, y`` (bins as features x rows, labels) of the rows, and the upper edges of each feature's bins."""

    blocks: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    n_classes: int


def fill_and_edges(df: DataFrame, features: list[str]) -> tuple[list[float], list[np.ndarray]]:
    """What missing values of a feature become (its exact median, 0 if it has none) and the edges of its bins: all values
    if they are less than ``BINS``, else exact quantiles.  A bin holds the values up to its edge, the last one the rest."""
    known = in_ranges(column_counts(df, features).where("num is not null"), ["feature"], [F.col("num")], None)
    fill = {r["feature"]: r["value"] for r in quantiles_of_counts(known, "num", [0.5], ["feature"]).collect()}
    ends: dict = {}
    for r in parts_of_counts(known, "num", BINS, ["feature"]).collect():  # at most BINS a feature
        ends.setdefault(r["feature"], set()).add(r["num"])
    edges = []
    for f in features:
        own = ends.get(f, set())
        edges.append(np.array(sorted(own | {fill[f]} if f in fill and len(own) < BINS else own)[:-1], np.float64))
    return [fill.get(f, 0.0) for f in features], edges


def binned(df: DataFrame, features: list[str], label: str) -> Binned:
    """The rows of ``df`` in blocks, kept until ``blocks.unpersist()``.  Labels are whole numbers from 0."""
    y = F.col(label).cast("double")
    n, most, odd = df.agg(F.count(F.lit(1)), F.max(y), F.count_if(y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y)))).first()
    if not n or odd or most >= CLASSES:
        raise ValueError(f"{n} rows, {odd} labels that are not whole numbers from 0, largest {most}: no forest can be fitted")
    fill, edges = fill_and_edges(df, features)

    def pack(batches):
        held, seq = [], 0

        def block():
            nonlocal held, seq
            x, labels = np.concatenate([p[0] for p in held], axis=1), np.concatenate([p[1] for p in held])
            held, seq = [], seq + 1
            return pa.RecordBatch.from_arrays([pa.array([(TaskContext.get().partitionId() << 32) + seq]), pa.array([x.tobytes()], pa.binary()),
                                               pa.array([labels.tobytes()], pa.binary())], ["block", "x", "y"])

        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                part = batch.slice(at, STRIP)
                cells = [part.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(fill))]
                x = [np.searchsorted(e, np.where(np.isnan(v), m, v)).astype(np.uint8) for v, m, e in zip(cells, fill, edges)]
                held.append((np.stack(x), part.column(len(fill)).to_numpy(zero_copy_only=False).astype(np.uint8)))
                if sum(len(p[1]) for p in held) >= STRIP:
                    yield block()
        if held:
            yield block()

    cells = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], y.alias("y"))
    parts = max(min(4 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / STRIP)), math.ceil(n / ROWS))
    blocks = cells.mapInArrow(pack, "block long, x binary, y binary").repartition(parts).persist()
    return Binned(blocks, list(features), edges, int(most) + 1)


def bootstrap(seed: int, block: int, tree: int, n: int) -> np.ndarray:
    """How often a tree takes each of the ``n`` rows of a block: Poisson numbers of mean 1."""
    drawn = np.random.SFC64([seed % 2 ** 64, block, tree]).random_raw(-(-n // 2)).astype("<u8", copy=False).view("<u4")[:n]
    out = np.zeros(n, np.uint8)
    for least in POISSON[:4]:
        out += drawn >= least
    more = np.flatnonzero(drawn >= POISSON[3])  # one in fifty
    out[more] += np.searchsorted(POISSON[4:], drawn[more], "right").astype(np.uint8)
    return out


class Trees:
    """Trees of one depth in heap order (children of ``i`` at ``2 i + 1`` and ``2 i + 2``)."""

    def __init__(self, n_trees: int, max_depth: int, n_classes: int):
        inner, nodes = 2 ** max_depth - 1, 2 ** (max_depth + 1) - 1
        self.feature = np.full((n_trees, inner), -1)                 # -1: a leaf, as all nodes below ``inner`` are
        self.cut = np.zeros((n_trees, inner), np.int64)              # the last bin that goes left
        self.gain = np.zeros((n_trees, inner))
        self.count = np.zeros((n_trees, nodes, n_classes))           # rows of each class
        self.open = np.zeros((n_trees, nodes), bool)                 # nodes that the next level may split
        self.open[:, 0] = True

    def importances(self, n_features: int) -> np.ndarray:
        """Gain times rows of the splits by feature, of each tree and of all as shares; a split of two leaves that
        predict the same class counts as a leaf, as MLlib prunes it."""
        total = np.zeros(n_features)
        for feature, gain, count in zip(self.feature, self.gain, self.count):
            feature, best = feature.copy(), count.argmax(axis=1)
            leaf = np.append(feature < 0, np.ones(len(count) - len(feature), bool))
            for i in reversed(range(len(feature))):
                if not leaf[i] and leaf[2 * i + 1] and leaf[2 * i + 2] and best[2 * i + 1] == best[2 * i + 2]:
                    leaf[i], feature[i] = True, -1
            own = np.bincount(feature[feature >= 0], (gain * count[:len(gain)].sum(axis=1))[feature >= 0], n_features)
            total += own / own.sum() if own.sum() > 0 else 0.0
        return total / total.sum() if total.sum() > 0 else total


def _at_level(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """The node of each row among those of a level; rows of leaves above go left."""
    at = np.zeros(x.shape[1], np.uint8 if level <= 8 else np.uint32)
    for d in range(level):
        right, first = np.zeros(x.shape[1], bool), 2 ** d - 1
        for i in np.flatnonzero(feature[first:2 * first + 1] >= 0).tolist():  # plain numbers, so that bytes stay bytes
            right |= (at == i) & (x[int(feature[first + i])] > int(cut[first + i]))
        at += at
        at += right
    return at


def _sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, at: np.ndarray, wanted: np.ndarray, out: np.ndarray) -> None:
    """Add the weights of rows to ``out[feature, node, class, bin]`` for the features and nodes of ``wanted``."""
    live = wanted.any(axis=1)
    if not live.all():
        weight = weight * live[at]
    rows = np.flatnonzero(weight > 0)
    n_classes, bins = out.shape[2:]
    cell, w = (at[rows].astype(np.intp) * n_classes + y[rows]) * bins, weight[rows].astype(np.float64)
    for f in np.flatnonzero(wanted.any(axis=0)):
        out[f] += np.bincount(cell + x[f][rows], w, out[f].size).reshape(out[f].shape)


def _gini(count: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
    n = count.sum(axis=axis)
    return n, 1.0 - (count * count).sum(axis=axis) / np.maximum(n * n, 1.0)


def best_splits(sums: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """``feature, cut, gain, left, right`` (the last two by class) of each node, from ``[feature, node, class, bin]``."""
    left = sums.cumsum(axis=3)[..., :-1]
    all_rows = sums.sum(axis=3, keepdims=True)
    right = all_rows - left
    (n_left, g_left), (n_right, g_right), (n, g) = (_gini(c, 2) for c in (left, right, all_rows))
    gain = g - (n_left * g_left + n_right * g_right) / np.maximum(n, 1.0)      # feature, node, cut
    gain = np.where((n_left >= 1) & (n_right >= 1) & wanted.T[:, :, None], gain, -np.inf).transpose(1, 0, 2)
    node, best = np.arange(len(gain)), gain.reshape(len(gain), -1).argmax(axis=1)
    feature, cut = np.divmod(best, gain.shape[2])
    return feature, cut, gain[node, feature, cut], left[feature, node, :, cut], right[feature, node, :, cut]


def _level_sums(data: Binned, used: list[int], trees: Trees, level: int, wanted: np.ndarray, group: list[int], seed: int) -> Iterator:
    """``tree, sums`` of a group of trees, from one pass."""
    shape = (len(used), 2 ** level, data.n_classes, BINS)
    feature, cut = trees.feature, trees.cut

    def run(batches):
        total = {t: np.zeros(shape) for t in group}
        for batch in batches:
            for block, xs, ys in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                y = np.frombuffer(ys.as_buffer(), np.uint8)
                x = np.frombuffer(xs.as_buffer(), np.uint8).reshape(-1, len(y))[used]
                for t in group:
                    _sums(x, y, bootstrap(seed, block, t, len(y)), _at_level(x, feature[t], cut[t], level), wanted[t], total[t])
        for t, s in total.items():
            if s.any():
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([s.tobytes()], pa.binary())], ["tree", "sums"])

    def add(parts):
        total = np.zeros(shape)
        for s in parts.column("sums"):
            for part in s.chunks if hasattr(s, "chunks") else [s]:
                total += np.frombuffer(part.as_buffer()).reshape(shape)
        return pa.table({"tree": parts.column("tree").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "tree int, sums binary"
    found = data.blocks.mapInArrow(run, schema).groupBy("tree").applyInArrow(add, schema).toArrow()  # at most SUMS bytes
    for t, s in zip(found.column("tree").to_pylist(), found.column("sums"), strict=True):
        yield t, np.frombuffer(s.as_buffer()).reshape(shape)


def forest_importances(data: Binned, features: list[str], n_trees: int = 100, max_depth: int = 5, seed: int = 0) -> np.ndarray:
    """Importances of ``features`` in a forest fitted to them: all rows, a Poisson bootstrap a tree, the square root of
    their number (rounded up) tried at a node."""
    used = [data.features.index(f) for f in features]
    trees, tried = Trees(n_trees, max_depth, data.n_classes), math.ceil(math.sqrt(len(used)))
    rng = np.random.default_rng(seed % 2 ** 64)
    for level in range(max_depth):
        first, nodes = 2 ** level - 1, 2 ** level
        wanted = rng.random((n_trees, nodes, len(used))).argsort(axis=2).argsort(axis=2) < tried
        wanted &= trees.open[:, first:first + nodes, None]
        some = np.flatnonzero(wanted.any(axis=(1, 2))).tolist()
        most = max(1, SUMS // (8 * len(used) * nodes * data.n_classes * BINS))
        for group in (some[i:i + most] for i in range(0, len(some), most)):
            for t, sums in _level_sums(data, used, trees, level, wanted, group, seed):
                feature, cut, gain, left, right = best_splits(sums, wanted[t])
                if level == 0:
                    trees.count[t, 0] = left[0] + right[0] if gain[0] > -np.inf else 0.0
                for i in np.flatnonzero(gain > 0):
                    at = first + i
                    trees.feature[t, at], trees.cut[t, at], trees.gain[t, at] = feature[i], cut[i], gain[i]
                    for child, count in ((2 * at + 1, left[i]), (2 * at + 2, right[i])):
                        trees.count[t, child] = count
                        trees.open[t, child] = level + 1 < max_depth and np.count_nonzero(count) > 1
    return trees.importances(len(used))
