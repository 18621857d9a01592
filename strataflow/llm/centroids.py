"""Centroid clustering with an incremental distance matrix.

Every vector is kept as integers beside its exact dot products with all centroids. A round changes the dot
products only by the components in which a centroid moved, takes the nearest centroid of each vector from
``|c|^2 - 2 x.c`` and adds the vectors that changed their cluster to the sums of the new one and takes them from
the sums of the old. One pass over the table a round; its partial sums ride in the written table, one row a task.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import cells, discard, finite_vectors, packed, write_table

STATE = "vec_id long, x binary, dots binary, cluster int, distance long, sums array<long>"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def to_integers(vectors: DataFrame, size: int, scale: int, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: ``floor(scale * component)`` of all vectors of ``size`` finite components, as 32-bit integers."""
    most = math.isqrt((1 << 62) // max(1, size)) // 2  # below it no squared distance leaves 63 bits

    def pack(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x = np.floor(scale * flat.reshape(-1, size))
            if len(x) and np.abs(x).max() > most:
                raise OverflowError(f"components beyond {most / scale:g} have distances that no long holds")
            yield pa.RecordBatch.from_arrays([batch.column(0), cells(x.astype("<i4"))], ["vec_id", "x"])

    kept = vectors.where(finite_vectors(vectors, vector_col) & (F.size(vector_col) == size))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
                       ).mapInArrow(pack, "vec_id long, x binary")


def _update(size: int, change: np.ndarray, centres: np.ndarray):
    """One round over a task's batches: the new state of each vector, then one row of partial sums."""
    k = len(centres)
    norms = (centres * centres).sum(axis=1)
    moved_in = [np.flatnonzero(row) for row in change]

    def run(batches):
        sums, counts, inertia = np.zeros((k, size), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = packed(batch, "x", "<i4", size).astype(np.int64)
            dots = packed(batch, "dots", "<i8", k).copy()
            before = batch.column(batch.schema.get_field_index("cluster")).to_numpy()
            for c, at in enumerate(moved_in):
                if len(at):
                    dots[:, c] += x[:, at] @ change[c, at]
            score = norms - 2 * dots
            now = score.argmin(axis=1)  # the first of equal ones
            distance = (x * x).sum(axis=1) + score[np.arange(len(x)), now]
            moved = before != now
            for c in range(k):
                sums[c] += x[moved & (now == c)].sum(axis=0) - x[moved & (before == c)].sum(axis=0)
                counts[c] += int((moved & (now == c)).sum()) - int((moved & (before == c)).sum())
                inertia[c] += int(distance[now == c].sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), cells(dots), pa.array(now.astype(np.int32)), pa.array(distance),
                 pa.nulls(len(x), pa.list_(pa.int64()))], ["vec_id", "x", "dots", "cluster", "distance", "sums"])
        row = [*sums.ravel().tolist(), *counts.tolist(), *inertia.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()),
             pa.nulls(1, pa.int64()), pa.array([row], pa.list_(pa.int64()))],
            ["vec_id", "x", "dots", "cluster", "distance", "sums"])

    return run


def cluster(vectors: DataFrame, centroids: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector of ``size`` components.

    Components become ``floor(scale * x)``. The start centroids are the vectors of least SHA-256 of ``seed:id``; a
    round moves every centroid that has vectors to the exact floor of their mean, and rounds end early once none
    moves. Left out: null vectors, other lengths, null or non-finite components. Rows without an id take part, the
    hash of their id being that of the empty text; repeated rows count each; equally near centroids: the smaller
    number. Fewer vectors than centroids: as many centroids as vectors. An empty table gives an empty result.
    Integers whose squared distance no long holds (components beyond 131,072 for 64 of them) raise OverflowError.
    Only centroids and their sums (``centroids * size`` numbers) reach the driver.
    """
    spark = vectors.sparkSession
    state, path = write_table(to_integers(vectors, size, scale, id_col, vector_col), "integers")
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = state.orderBy(first, "x").limit(centroids).collect()
    if not chosen:
        return spark.createDataFrame([], RESULT)
    k = len(chosen)
    centres = np.array([np.frombuffer(r["x"], "<i4") for r in chosen], dtype=np.int64).reshape(k, size)
    known, sums = np.zeros_like(centres), [0] * (k * (size + 1))
    state = state.select("vec_id", "x", F.lit(bytes(8 * k)).alias("dots"), F.lit(-1).alias("cluster"))
    for _ in range(rounds + 1):
        state, old = state.mapInArrow(_update(size, centres - known, centres), STATE), path
        written, path = write_table(state, "distances")
        discard(spark, old)
        added = {r["pos"]: int(r["s"]) for r in written.where("sums is not null").select(F.posexplode("sums")).groupBy("pos")
                 .agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()}
        sums = [s + added[i] for i, s in enumerate(sums)]
        inertia = [added[k * (size + 1) + c] for c in range(k)]
        known, state = centres, written.where("sums is null").drop("distance", "sums")
        if _ < rounds:
            centres = np.array([[sums[c * size + i] // n for i in range(size)] if (n := sums[k * size + c]) else known[c]
                                for c in range(k)], dtype=np.int64)
            if (centres == known).all():
                break
    digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in known.tolist()]

    def of(values):
        return F.array(*[F.lit(v) for v in values])[F.col("cluster")]

    return written.where("sums is null").select(
        "vec_id", "cluster", "distance", of(inertia).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"), of(digest).alias("centroid_sha256"))
