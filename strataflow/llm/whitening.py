"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows ``X`` stay where they are. Each step takes ``u = X v`` and ``X'u`` in one distributed pass, task by
task, and orthogonalises both sides against all earlier vectors. A left vector is as long as the table, so it is
kept as the ``w`` with ``u = X w``: products with earlier ones are then ``U'u = W'(X'u)``, which the driver has. The
singular value decomposition of the small bidiagonal matrix gives components and deviations.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import cells, finite_vectors, packed, write_table

RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
RANK = 1e-10  # deviations below this share of the largest are rounding, not components


def _sums(partials: DataFrame) -> dict[int, float]:
    """The totals by ``pos`` of the tasks' partial sums; ``pos`` counts numbers bounded by the vectors' length."""
    return {r["pos"]: r["s"] for r in partials.groupBy("pos").agg(F.sum("value").alias("s")).collect()}


class CentredRows:
    """All usable vectors as integers ``floor(scale * c) + offset`` in a written table, with exact sums."""

    def __init__(self, vectors: DataFrame, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id",
                 vector_col: str = "embedding"):
        usable = vectors.where(finite_vectors(vectors, vector_col)).select(
            F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        common = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        self.size = size = common["d"] if common else 0

        def pack(batches):
            n, sums, low, high = 0, np.zeros(size, object), None, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                small = max(abs(int(x.max())), abs(int(x.min()))) * len(x) < 1 << 63
                n, sums = n + len(x), sums + x.astype(np.int64 if small else object).sum(axis=0).astype(object)
                low = x.min() if low is None else min(low, x.min())
                high = x.max() if high is None else max(high, x.max())
                yield pa.RecordBatch.from_arrays([batch.column(0), cells(x.astype("<i8")), pa.nulls(len(x), pa.list_(pa.int64()))],
                                                 ["vec_id", "x", "sums"])
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                     pa.array([[*map(int, sums), n, int(low), int(high)]], pa.list_(pa.int64()))], ["vec_id", "x", "sums"])

        def whole(c):
            scaled = F.lit(float(scale)) * c
            return F.when(F.abs(scaled) < 2.0 ** 62, F.floor(scaled) + F.lit(offset)).otherwise(
                F.raise_error(F.lit("an entry's integer does not fit a long")).cast("long"))

        table, _ = write_table(usable.where(F.size("v") == size).select("vec_id", F.transform("v", whole).alias("v")).mapInArrow(
            pack, "vec_id long, x binary, sums array<long>"), "rows")
        parts = table.where("sums is not null").select(F.posexplode("sums")).groupBy("pos").agg(
            F.sum(F.col("col").cast("decimal(38,0)")).alias("s"), F.min("col").alias("low"), F.max("col").alias("high"))
        found = {r["pos"]: r for r in parts.collect()}
        self.rows = table.where("sums is null").select("vec_id", "x")
        self.n = int(found[size]["s"]) if found else 0
        self.totals = [int(found[i]["s"]) for i in range(size)] if found else []
        # the largest |n x - S| over all rows and dimensions, at most
        self.spread = self.n * (found[size + 2]["high"] - found[size + 1]["low"]) if found else 0
        self.base = np.array([s // self.n for s in self.totals], dtype=np.int64)
        self.rest = [s % self.n for s in self.totals]

    def centred(self) -> Callable[[pa.RecordBatch], np.ndarray]:
        """A function from a batch of ``rows`` to its rows minus the mean: whole parts first, so that no digit is lost."""
        base, part, size = self.base, np.array([r / self.n for r in self.rest]), self.size
        return lambda batch: (packed(batch, "x", "<i8", size) - base).astype(np.float64) - part

    def product(self, w: np.ndarray) -> tuple[np.ndarray, float, float]:
        """``X'(X w)``, ``|X w|^2`` and ``|X|^2`` in one pass; each task hands on ``size + 2`` numbers."""
        centred, size = self.centred(), self.size

        def run(batches):
            back, square, whole = np.zeros(size), 0.0, 0.0
            for batch in batches:
                y = centred(batch)
                u = y @ w
                back, square, whole = back + y.T @ u, square + float(u @ u), whole + float(np.einsum("ij,ij", y, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size + 2), pa.int32()), pa.array([*back.tolist(), square, whole])], ["pos", "value"])

        got = _sums(self.rows.mapInArrow(run, "pos int, value double"))
        return np.array([got[i] for i in range(size)]), got[size], got[size + 1]


def bidiagonalise(rows: CentredRows, steps: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """``V`` (orthonormal columns), the upper bidiagonal ``B`` with ``X V = U B``, and ``|X|^2``.

    Both sides are orthogonalised against all their predecessors. Where a space is exhausted (repeated or zero
    deviations) a new direction orthogonal to all earlier ones goes on, so that no component is missed.
    """
    d, rng = rows.size, np.random.default_rng(seed)
    right, left, back = np.zeros((d, steps)), np.zeros((d, steps)), np.zeros((d, steps))
    small, alpha, beta, whole = 0.0, np.zeros(steps), np.zeros(steps), 0.0
    for j in range(steps):
        if j == 0 or beta[j - 1] == 0:
            v = rng.normal(size=d)
            for _ in range(3):
                v -= right[:, :j] @ (right[:, :j].T @ v)
                v /= np.linalg.norm(v)
        right[:, j] = v
        w = v - (beta[j - 1] * left[:, j - 1] if j else 0)
        for _ in range(4):
            z, square, whole = rows.product(w)
            small = small or 1e-14 * np.sqrt(whole)
            h = left[:, :j].T @ z
            lost = np.sqrt(float(h @ h))
            if np.sqrt(square) <= small:
                break
            w, z, square = w - left[:, :j] @ h, z - back[:, :j] @ h, square - float(h @ h)
            if lost <= 1e-8 * np.sqrt(max(square, 0.0)):  # corrected to the last digit; otherwise measured anew
                break
        if square > 0 and np.sqrt(square) > small:
            alpha[j] = np.sqrt(square)
            left[:, j], back[:, j] = w / alpha[j], z / alpha[j]
            v = back[:, j] - alpha[j] * right[:, j]
            for _ in range(2):
                v -= right[:, :j + 1] @ (right[:, :j + 1].T @ v)
            beta[j] = np.linalg.norm(v)
            if beta[j] <= small:
                beta[j] = 0.0
            else:
                v /= beta[j]
                back[:, j] = alpha[j] * right[:, j] + beta[j] * v
    return right, np.diag(alpha) + np.diag(beta[:-1], 1), whole


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000, steps: int | None = None,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component.

    Entries become ``x = floor(scale * c) + offset``. ``deviation`` is the exact sum over dimensions of
    ``(n x - S)^2`` (a decimal: it grows with the square of ``n``); ``whitened`` the centred row projected on the
    component, over its standard deviation; ``explained`` the component's share of the variance;
    ``identity_error`` the largest entry, in one pass over all rows, of the whitened covariance minus the identity.

    Left out: null vectors, null or non-finite entries, and vectors of another length than the most frequent one
    (the longer of equally frequent ones). Repeated rows and rows without an id count each. Components whose
    deviation is zero cannot be whitened and are left out, so constant or dependent dimensions give fewer
    components, and a table of one vector or none, or of equal ones, gives no rows. Entries whose integer (or whose
    sum over a task) no long holds raise an error. ``steps`` (the vectors' length if None, which is exact) bounds the passes
    for very long vectors, at least a few more than ``components``; the driver holds ``3 * size * steps`` numbers.
    """
    rows = CentredRows(vectors, scale, offset, id_col, vector_col)
    spark, d, n = vectors.sparkSession, rows.size, rows.n
    if not n or not d:
        return spark.createDataFrame([], RESULT)
    right, b, whole = bidiagonalise(rows, min(d, steps or d))
    _, sigma, turned = np.linalg.svd(b)
    kept = int((sigma > RANK * sigma[0]).sum()) if sigma[0] > 0 and whole > 0 else 0
    kept = min(components, kept)
    if not kept:
        return spark.createDataFrame([], RESULT)
    project = (right @ turned.T)[:, :kept] / (sigma[:kept] / np.sqrt(n))
    explained = sigma[:kept] ** 2 / whole
    centred, size = rows.centred(), rows.size

    def moments(batches):
        first, second = np.zeros(kept), np.zeros((kept, kept))
        for batch in batches:
            y = centred(batch) @ project
            first, second = first + y.sum(axis=0), second + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(kept * (kept + 1)), pa.int32()),
                                          pa.array([*first.tolist(), *second.ravel().tolist()])], ["pos", "value"])

    got = _sums(rows.rows.mapInArrow(moments, "pos int, value double"))
    flat = np.array([got[i] for i in range(kept * (kept + 1))])
    mean = flat[:kept] / n
    error = float(np.abs(flat[kept:].reshape(kept, kept) / n - np.outer(mean, mean) - np.eye(kept)).max())
    kind = np.int64 if d * rows.spread ** 2 < 1 << 63 else object  # both exact; Python's integers where longs end
    base, rest = rows.base, np.array(rows.rest, dtype=object).astype(kind)

    def finish(batches):
        for batch in batches:
            m = batch.num_rows
            part = n * (packed(batch, "x", "<i8", size) - base).astype(kind) - rest
            deviation = [f"{int(v)}" for v in (part * part).sum(axis=1)]
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation).cast(pa.decimal128(38, 0))], ["vec_id", "deviation"])
            made = made.take(pa.array(np.repeat(np.arange(m), kept)))
            yield pa.RecordBatch.from_arrays(
                [made.column(0), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * kept, n, dtype=np.int64)), made.column(1), pa.array((centred(batch) @ project).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * kept, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.rows.mapInArrow(finish, RESULT)
