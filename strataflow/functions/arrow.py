"""Vectors of Arrow batches as matrices and back, without an object a row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def matrix(column) -> np.ndarray:
    """A list column as rows of doubles; null entries become NaN.  Null or unequal vectors raise ValueError."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    size = len(flat) // n if n else 0
    if column.null_count or (n and (np.diff(column.offsets.to_numpy()) != size).any()):
        raise ValueError("vectors are missing or differ in length")
    return flat.reshape(n, size)


def lists(x: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column of doubles."""
    at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.ascontiguousarray(x, dtype=np.float64).ravel()))


def with_vectors(df: DataFrame, features: str, names: list[str], made: Callable[[np.ndarray], list[np.ndarray]]) -> DataFrame:
    """``df`` with an array column for each of ``names``: the matrices that ``made`` gives for a batch of ``features``.

    Only ``features`` go to Python and only the new columns come back; the others stay where they are.  Not taken as
    deterministic, so that no rule of the optimizer computes a vector a second time for a filter on it."""
    kind = T.ArrayType(T.DoubleType())

    def run(cells: pa.Array) -> pa.Array:
        found = [lists(x) for x in made(matrix(cells))] if len(cells) else [pa.array([], pa.list_(pa.float64())) for _ in names]
        return found[0] if len(names) == 1 else pa.StructArray.from_arrays(found, names)

    if len(names) == 1:
        return df.select("*", F.arrow_udf(run, kind).asNondeterministic()(F.col(f"`{features}`")).alias(names[0]))
    both = F.arrow_udf(run, T.StructType([T.StructField(n, kind) for n in names])).asNondeterministic()
    held = df.select("*", both(F.col(f"`{features}`")).alias("_vectors"))
    return held.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_vectors")[n].alias(n) for n in names])
