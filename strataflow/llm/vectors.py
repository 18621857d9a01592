"""Approximate nearest neighbours with a permutation index.

Every vector is represented by the order of its nearest pivots and posted, with each pivot's place in that
order, to the inverted files of these few pivots alone. A query reads the files of its own nearest pivots and
adds up the differences between its places and the posted ones, a pivot that a vector was not posted to counting
as the place after its last (the footrule distance on the query's pivots); the vectors of least footrule distance
are ranked again by their true distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import cells, packed, stage

PIVOTS = 1024    # vectors sampled as pivots, at most
POSTED = 128     # files a vector is posted to
ASKED = 64       # files a query reads
SHARE = 0.15     # of the vectors of an index block are ranked again for each query
LEAST = 64       # but so many of a block at least
STRIP = 2048     # vectors whose distances to all pivots are held at once
QUERIES = 2000   # queries in a block, on average


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return (vectors.where(F.col(id_col).isNotNull() & good & F.exists(v, lambda x: x != 0))
            .select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v")))


def _near(x: np.ndarray, pivots: np.ndarray, many: int) -> np.ndarray:
    """The numbers of each vector's ``many`` nearest pivots, nearest first; equally near ones in order of number."""
    out = np.empty((len(x), many), dtype="<u2")
    for at in range(0, len(x), STRIP):
        far = (pivots ** 2).sum(axis=1) - 2 * x[at:at + STRIP] @ pivots.T
        out[at:at + STRIP] = np.argsort(far, axis=1, kind="stable")[:, :many]
    return out


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS,
                posted: int = POSTED) -> tuple[DataFrame, int]:
    """A written table ``row, vec_id, v, near`` of every usable vector with the pivots it is posted to, and the
    vectors' length.

    Vectors that are null, zero, or hold null or non-finite components, those of another length than most
    pivots, and those with a null id are left out. Pivots: the ``pivots`` (65,536 at most) rows of least id hash.
    """
    if not 1 <= pivots <= 1 << 16:
        raise ValueError("1 to 65,536 pivots")
    valid = _valid(vectors, id_col, vector_col)
    sample = [r["v"] for r in valid.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(pivots).collect()]
    lengths = [len(v) for v in sample]
    size = max(sorted(set(lengths)), key=lengths.count) if lengths else 0
    chosen = np.array([v for v in sample if len(v) == size], dtype=np.float64).reshape(-1, size or 1)

    many = min(posted, len(chosen))

    def near(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, cells(_near(_matrix(batch, size), chosen, many))],
                                             [*batch.schema.names, "near"])

    rows = valid.where(F.size("v") == size).withColumn("row", F.monotonically_increasing_id())
    return stage(rows.mapInArrow(near, "vec_id long, v array<double>, row long, near binary"), "index"), size


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, dtype=np.float64).reshape(-1, max(size, 1))


def nearest(index: DataFrame, size: int, queries: DataFrame, k: int = 10, share: float = SHARE,
            least: int = LEAST, asked: int = ASKED) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found by Euclidean distance.

    ``queries`` are rows of the index; a query never finds its own row (but finds another row of the same id or
    vector). Equal distances go to the smaller ``vec_id``. In each block of the index (an Arrow batch) the
    ``share`` of least footrule distance, ``least`` at least and all that tie with the last, is ranked again.
    Queries are taken in blocks of bounded size against all rows. No vectors or no queries: an empty result.
    """
    spark = index.sparkSession
    blocks = max(1, -(-queries.count() // QUERIES))
    parts = []
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "vec_id", "v", "near").collect()
        shipped = spark.sparkContext.broadcast((
            np.array([r["row"] for r in own], dtype=np.int64), np.array([r["vec_id"] for r in own], dtype=np.int64),
            np.array([r["v"] for r in own], dtype=np.float64),
            np.array([np.frombuffer(r["near"], dtype="<u2")[:asked] for r in own], dtype=np.int64)))
        found = index.mapInArrow(_search(shipped, size, k, share, least),
                                 "query_row long, query_id long, row long, vec_id long, score double")
        parts.append(stage(found, "found") if blocks > 1 else found)
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    best = Window.partitionBy("query_row").orderBy("score", "vec_id", "row")
    return (every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


class Files:
    """The inverted files of one block: for each pivot the vectors posted to it and their places."""

    def __init__(self, near: np.ndarray):
        n, self.posted = near.shape
        flat = near.ravel().astype(np.int64)
        order = np.argsort(flat, kind="stable")
        self.rows, self.places = order // self.posted, order % self.posted
        self.ends = np.cumsum(np.bincount(flat, minlength=int(flat.max(initial=-1)) + 1))
        self.n = n

    def footrule(self, asked: np.ndarray) -> np.ndarray:
        """Every vector's distance to a query whose nearest pivots are ``asked``; only their files are read."""
        asked = asked[asked < len(self.ends)]
        lo = np.where(asked > 0, self.ends[asked - 1], 0)
        sizes = self.ends[asked] - lo
        at = np.repeat(lo - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        own = np.repeat(np.arange(len(asked)), sizes)
        # what a posted place is nearer than an absent one
        less = (self.posted - own) - np.abs(self.places[at] - own)
        return -np.bincount(self.rows[at], weights=less, minlength=self.n)


def _search(shipped, size: int, k: int, share: float, least: int):
    def search(batches):
        query_rows, query_ids, query_vectors, query_near = shipped.value
        best: list[list[tuple[float, int, int]]] = [[] for _ in query_rows]
        for batch in batches:
            x, n = _matrix(batch, size), batch.num_rows
            if not n:
                continue
            rows, ids = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("row", "vec_id"))
            width = len(batch.column(batch.schema.get_field_index("near"))[0].as_py()) // 2
            files = Files(packed(batch, "near", "<u2", width))
            again = min(n, max(least, int(np.ceil(share * n))))
            for q in range(len(query_rows)):
                total = files.footrule(query_near[q])
                near = np.flatnonzero(total <= np.partition(total, again - 1)[again - 1])
                near = near[rows[near] != query_rows[q]]
                score = np.sqrt(((x[near] - query_vectors[q]) ** 2).sum(axis=1))
                if len(near) > k:
                    short = score <= np.partition(score, k - 1)[k - 1]
                    near, score = near[short], score[short]
                best[q] = sorted(best[q] + list(zip(score.tolist(), ids[near].tolist(), rows[near].tolist(), strict=True)))[:k]
        flat = [(int(query_rows[q]), int(query_ids[q]), r, i, s) for q, found in enumerate(best) for s, i, r in found]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        columns = list(zip(*flat, strict=True)) if flat else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                         ["query_row", "query_id", "row", "vec_id", "score"])

    return search
