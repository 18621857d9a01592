"""Exact nearest neighbours by pivot cells, and the row filters built on them.

Rows are dealt to the cells of their nearest pivots.  The distances of a cell's
rows to its pivot bound, by the triangle inequality, how far a query's k-th
neighbour can be, and with that bound which cells hold any of its neighbours;
only those are visited.  Pivots and a few distances for each of them are all
that the driver holds.  Cells are put together (or cut) to lots of rows, and one
group is a lot with a part of the queries that visit any of its cells: a vector
is sent once for each lot or part, not for each cell, and a group hands on its
best rows of a query alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import materialize

PIVOTS = 64
BLOCK = 1 << 16  # rows of a lot, or queries of a part, at most about
CHUNK = 4096  # rows of a cell, and
STRIP = 256  # queries, compared at once
PAIRS = 16384  # of near candidates, measured exactly at once


def _form(df: DataFrame, vec: str) -> str:
    """How components are packed: those of single precision as they are, at half the bytes, others as doubles."""
    return "<f4" if df.schema[vec].dataType.elementType.typeName() == "float" else "<f8"


def _packed(df: DataFrame, vec: str, key: str, size: int) -> DataFrame:
    """``id, v``: the rows with ``size`` finite components, as little-endian numbers of :func:`_form`."""
    form = _form(df, vec)
    v = F.col(vec) if form == "<f4" else F.col(vec).cast("array<double>")
    good = (F.size(v) == size) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.where(F.col(key).isNotNull() & F.coalesce(good, F.lit(False))).select(F.col(key).alias("id"), v.alias("v"))

    def pack(batches):
        for batch in batches:
            x = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), dtype=form).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "v"])

    return kept.mapInArrow(pack, f"id {kept.schema['id'].dataType.simpleString()}, v binary")


def _matrix(cells, size: int, form: str) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=form).reshape(-1, size).astype(np.float64)


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots, exact enough for bounds (differences are squared, not products subtracted)."""
    out = np.empty((len(x), len(pivots)))
    for c, p in enumerate(pivots):
        out[:, c] = np.sqrt(((x - p) ** 2).sum(axis=1))
    return out


class _Best:
    """The ``k`` nearest rows so far of each of some queries (-1: none)."""

    def __init__(self, n: int, k: int):
        self.row, self.far = np.full((n, k), -1), np.full((n, k), np.inf)

    def add(self, asks: np.ndarray, q: np.ndarray, rows: np.ndarray, d: np.ndarray, place: np.ndarray) -> None:
        """Take ``rows`` at distances ``d`` from the queries ``asks[q]``; equally near ones by their ``place``."""
        if not len(q):
            return
        k, some = self.row.shape[1], np.unique(asks[q])
        q, rows, d = (np.concatenate(c) for c in ((asks[q], np.repeat(some, k)), (rows, self.row[some].ravel()), (d, self.far[some].ravel())))
        q, rows, d = (c[rows >= 0] for c in (q, rows, d))
        order = np.lexsort((place[rows], d, q))
        q, rows, d = q[order], rows[order], d[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        q, rows, d, rank = (c[rank < k] for c in (q, rows, d, rank))
        self.row[some], self.far[some] = -1, np.inf
        self.row[q, rank], self.far[q, rank] = rows, d


def _candidates(y: np.ndarray, asks: np.ndarray, x: np.ndarray, lo: int, hi: int, xx: np.ndarray, best: _Best, need: int,
                name: np.ndarray | None, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows ``lo`` to ``hi``, those that may be among the nearest of the queries ``asks``: number of the query,
    row and exact distance.  Rows with the ``name`` of the query are left out."""
    some = y[asks]
    yy = (some * some).sum(axis=1)
    rough = some @ x[lo:hi].T
    rough *= -2.0
    rough += yy[:, None]
    rough += xx[lo:hi][None]
    cut = best.far[asks, -1] ** 2 * (1 + 1e-12)
    few = np.flatnonzero(np.isinf(cut))
    if len(few):
        rank = min(need, hi - lo) - 1
        cut[few] = np.partition(rough[few], rank, axis=1)[:, rank]
    q, rows = np.nonzero(rough <= (cut + 2e-12 * (yy + xx[lo:hi].max()))[:, None])
    rows += lo
    if name is not None:
        other = name[asks[q]] != place[rows]
        q, rows = q[other], rows[other]
    d = np.empty(len(q))
    for i in range(0, len(q), PAIRS):
        d[i:i + PAIRS] = np.sqrt(((x[rows[i:i + PAIRS]] - some[q[i:i + PAIRS]]) ** 2).sum(axis=1))
    return q, rows, d


def knn_join(queries: DataFrame, rows: DataFrame, vec: str, key: str, k: int, exclude_self: bool = False,
             pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, id, distance``: each query's ``k`` nearest rows by Euclidean distance, exactly.

    Equally near rows are taken in order of ``key``.  ``exclude_self`` leaves out rows with the query's key.
    Vectors that are null, hold null or non-finite components or differ in length from the first pivot, and
    null keys, take no part; with fewer than ``k`` rows all are returned.
    """
    spark = queries.sparkSession
    first = rows.where(F.size(vec) > 0).select(F.size(vec).alias("d")).limit(1).collect()
    size = first[0]["d"] if first else 1
    kind = rows.schema[key].dataType.simpleString()
    r_form, q_form = _form(rows, vec), _form(queries, vec)
    held = _packed(rows, vec, key, size)
    chosen = _matrix([r["v"] for r in held.orderBy(F.xxhash64("v", F.lit("pivot")), "id").limit(pivots).collect()], size, r_form)
    chosen = np.unique(chosen, axis=0)

    def assign(batches):
        for batch in batches:
            far = _to_pivots(_matrix(batch.column(1).to_pylist(), size, r_form), chosen)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(far)), cell])],
                ["id", "v", "cell", "far"])

    if not len(chosen):
        return spark.createDataFrame([], f"query_id {queries.schema[key].dataType.simpleString()}, rank int, id {kind}, distance double")
    dealt = materialize(held.mapInArrow(assign, f"id {kind}, v binary, cell int, far double"))
    # per cell: size, radius and the distances of the rows next to the pivot
    sizes = {r["cell"]: r for r in dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    need = k + 1 if exclude_self else k
    place = F.row_number().over(Window.partitionBy("cell").orderBy("far"))
    close = (dealt.select("cell", "far", place.alias("p")).where(F.col("p") <= need)).collect()  # pivots x (k + 1)
    radius = np.array([sizes[c]["far"] if c in sizes else -np.inf for c in range(len(chosen))])
    near = np.full((len(chosen), need), np.inf)
    for r in close:
        near[r["cell"], r["p"] - 1] = r["far"]
    between = _to_pivots(chosen, chosen)
    # lots: neighbouring cells put together, cells beyond the limit cut by the hash of the key; some groups a core
    some = math.isqrt(4 * spark.sparkContext.defaultParallelism) + 1
    most = max(1, min(block, -(-sum(r["n"] for r in sizes.values()) // some)))
    first, subs, n_lots, room = [], [], 0, 0
    for c in range(len(chosen)):
        n = sizes[c]["n"] if c in sizes else 0
        if n > room:
            n_lots, room = n_lots + 1, most
        first.append(max(n_lots - 1, 0))
        subs.append(max(1, -(-n // most)))
        n_lots, room = n_lots + subs[-1] - 1, (room - n if subs[-1] == 1 else 0)
    lots_of = np.zeros((len(chosen), max(1, n_lots)), bool)
    for c, (at, n) in enumerate(zip(first, subs, strict=True)):
        lots_of[c, at:at + n] = True

    def visited(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which cells may hold a neighbour of each query, and the query's own cell."""
        far = _to_pivots(y, chosen)
        reach = far[:, :, None] + near[None]
        limit = np.partition(reach.reshape(len(far), -1), need - 1, axis=1)[:, need - 1] * (1 + 1e-9) + 1e-300
        own = far.argmin(axis=1)
        # distance to the plane between the query's own pivot and another
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (far ** 2 - far[np.arange(len(far)), own][:, None] ** 2) / (2 * between[own])
        plane[~np.isfinite(plane)] = 0.0
        least = np.maximum(far - radius[None], plane)
        rest = 1e-9 * (far + limit[:, None]) if np.isfinite(limit).all() else 1e-9 * far
        return (least <= limit[:, None] + rest) & (radius[None] >= 0), own

    def visit(batches):
        for batch in (b.slice(at, STRIP) for b in batches for at in range(0, b.num_rows, STRIP)):
            goes = visited(_matrix(batch.column(1).to_pylist(), size, q_form))[0] @ lots_of
            at = np.concatenate([[0], np.cumsum(goes.sum(axis=1))]).astype(np.int32)
            lots = pa.ListArray.from_arrays(pa.array(at), pa.array(np.nonzero(goes)[1].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lots], ["id", "v", "cell"])

    asked = _packed(queries, vec, key, size)
    q_kind = asked.schema["id"].dataType.simpleString()
    visits = materialize(asked.mapInArrow(visit, f"id {q_kind}, v binary, cell array<int>"))  # a row a query, with its lots
    asked_of = {r["lot"]: r["count"] for r in visits.select(F.explode("cell").alias("lot")).groupBy("lot").count().collect()}  # lots
    most_asked = max(1, min(block, -(-max(asked_of.values(), default=0) // some)))
    parts_of = F.lit([-(-asked_of.get(c, 0) // most_asked) or 1 for c in range(max(1, n_lots))])
    one = F.lit(1).cast("int")
    lot = (F.get(F.lit(first), F.col("cell")) + F.pmod(F.xxhash64("id", F.lit("block")), F.get(F.lit(subs), F.col("cell")))).cast("int")
    r_side = dealt.select(F.lit(None).cast(q_kind).alias("query"), "id", "v", "cell", lot.alias("lot")).select(
        "*", F.explode(F.sequence(F.lit(0), F.get(parts_of, F.col("lot")) - one)).alias("part"))
    q_side = visits.select(F.col("id").alias("query"), F.lit(None).cast(kind).alias("id"), "v", F.lit(None).cast("int").alias("cell"),
                           F.explode("cell").alias("lot")).select(
        "*", F.pmod(F.xxhash64("query", F.lit("part")), F.get(parts_of, F.col("lot"))).cast("int").alias("part"))

    def compare(table: pa.Table) -> pa.Table:
        is_row = pc.is_null(table["query"])
        theirs, mine = table.filter(is_row).sort_by("cell"), table.filter(pc.invert(is_row))
        names, ids = mine["query"].combine_chunks(), theirs["id"].combine_chunks()
        x, y = _matrix(theirs["v"].to_pylist(), size, r_form), _matrix(mine["v"].to_pylist(), size, q_form)
        both = np.concatenate([names.to_numpy(zero_copy_only=False), ids.to_numpy(zero_copy_only=False)])
        place = np.unique(both, return_inverse=True)[1]  # keys by their order
        name, place = place[:len(y)], place[len(y):]
        xx, cells = (x * x).sum(axis=1), theirs["cell"].to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(cells)) + 1), len(cells)]
        chunks = [(cells[lo], at, min(at + CHUNK, hi)) for lo, hi in zip(ends, ends[1:]) for at in range(lo, hi, CHUNK)]
        goes, own = visited(y) if len(y) else (np.zeros((0, len(chosen)), bool), np.zeros(0, int))
        by_cell, found = np.argsort(own, kind="stable"), [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        for at in range(0, len(y), STRIP):
            strip = by_cell[at:at + STRIP]
            q, best = y[strip], _Best(len(strip), k)
            for cell, lo, hi in sorted(chunks, key=lambda c: c[0] != own[strip[0]]):  # the own cell first, for close bounds
                asks = np.flatnonzero(goes[strip, cell])
                if len(asks):
                    best.add(asks, *_candidates(q, asks, x, lo, hi, xx, best, need, name[strip] if exclude_self else None, place), place)
            i, j = np.nonzero(best.row >= 0)
            found.append((strip[i], best.row[i, j], best.far[i, j]))
        q, r, d = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table([names.take(pa.array(q)), ids.take(pa.array(r)), pa.array(d)], names=["query_id", "id", "distance"])

    pairs = (q_side.unionByName(r_side).groupBy("lot", "part")
             .applyInArrow(compare, f"query_id {q_kind}, id {kind}, distance double"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return pairs.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def neighbourhood(synthetic: DataFrame, real: DataFrame, vec: str, key: str, label: str, minority, k: int = 5) -> DataFrame:
    """``key, n_neighbours, n_other, dropped``: the classes among each synthetic row's ``k`` nearest real rows.

    A row is dropped if more than half of them are of another class than ``minority``.
    """
    near = knn_join(synthetic, real, vec, key, k)
    classes = real.select(F.col(key).alias("id"), F.col(label).alias("_label"))
    other = F.sum((~F.col("_label").eqNullSafe(F.lit(minority))).cast("int"))
    return near.join(classes, "id").groupBy(F.col("query_id").alias(key)).agg(
        F.count(F.lit(1)).alias("n_neighbours"), other.alias("n_other")).withColumn(
        "dropped", 2 * F.col("n_other") > F.col("n_neighbours"))


def knn_filter(synthetic: DataFrame, real: DataFrame, vec: str, key: str, label: str, minority, k: int = 5) -> DataFrame:
    """The synthetic rows whose neighbourhood of real rows is not dominated by other classes."""
    found = neighbourhood(synthetic, real, vec, key, label, minority, k)
    return synthetic.join(found.where("dropped").select(key), key, "left_anti")


def tomek_links(df: DataFrame, vec: str, key: str, label: str) -> DataFrame:
    """``a, b, label_a, label_b, distance``: rows of different classes that are each other's nearest row (a before b).

    A row's nearest is the one of least key among equally near ones.  Rows without a class form no link.
    """
    near = materialize(knn_join(df, df, vec, key, 1, exclude_self=True).select(
        F.col("query_id").alias("a"), F.col("id").alias("b"), "distance"))
    named = near.join(df.select(F.col(key).alias("a"), F.col(label).alias("label_a")), "a")
    back = named.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("label_a").alias("label_b"))
    return named.join(back, ["a", "b"]).where((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))).select(
        "a", "b", "label_a", "label_b", "distance")


def remove_tomek(df: DataFrame, vec: str, key: str, label: str, keep: Column | None = None) -> DataFrame:
    """``df`` without the members of Tomek links that belong to the majority class (or to any class but ``keep``)."""
    links = tomek_links(df, vec, key, label)
    if keep is None:
        largest = df.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).first()
        drops = F.col("c") == F.lit(largest[0] if largest else None)
    else:
        drops = F.col("c") != keep
    members = links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("label_a").alias("c")),
                                             F.struct(F.col("b").alias("id"), F.col("label_b").alias("c")))).alias("m")).select("m.*")
    return df.join(members.where(drops).select(F.col("id").alias(key)).distinct(), key, "left_anti")
