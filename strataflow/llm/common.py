"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strataflow.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it back.

    Later uses read the files: nothing upstream runs twice, row ids stay fixed, and a lost
    executor costs only the tasks it ran.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written below the shared checkpoint folder and read back, with the path for ``discard``."""
    spark, path, schema = df.sparkSession, scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}"), df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of ``write_table`` that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def finite_vectors(vectors: DataFrame, vector_col: str):
    """A condition: the vector is not null and none of its components is null, NaN or infinite."""
    v = F.col(vector_col).cast("array<double>")
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def packed(batch: pa.RecordBatch, name: str, kind: str, width: int) -> np.ndarray:
    """A binary column whose cells hold ``width`` numbers each, as a matrix that shares the batch's memory."""
    column = batch.column(batch.schema.get_field_index(name))
    cells = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[cells[0]:cells[-1]]
    return data.view(kind).reshape(len(column), width)


def cells(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary cell."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(matrix)]).cast(pa.binary())


def map_batches(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], dict]],
                fields: list[T.StructField], drop: tuple[str, ...] = ()) -> DataFrame:
    """Append (or replace) columns computed per Arrow batch; columns in ``drop`` are read but not returned.

    ``start()`` runs once per task and returns a function from a batch to ``{name: list or array}``.
    Columns of ``df`` named like one of ``fields`` are replaced, in any letter case; all others
    pass through unchanged.
    """
    new = {f.name.lower() for f in fields} | {c.lower() for c in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept] + [f.name for f in fields]
    types = {f.name: to_arrow_type(f.dataType) for f in fields}
    keep_names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            made = compute(batch)
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in keep_names]
            arrays += [v if isinstance(v := made[n], pa.Array) else pa.array(v, types[n]) for n in types]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, T.StructType(kept + list(fields)))


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty."""
    return [b or b"" for b in batch.column(name).cast(pa.binary()).to_pylist()]


def crc_bucket(col: str, n: int):
    """crc32 of the id's text modulo n; a null id counts as the empty text (bucket 0)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % n


def hash_cut(share: float) -> int:
    """The largest signed 64-bit hash that is in a share of all hashes; at least one hash is."""
    return -(1 << 63) + max(1, min(1 << 64, int(share * (1 << 64)))) - 1


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge list ``(a, b)`` of longs; root is the smallest reachable node.

    Alternating large-star and small-star rounds: each links neighbours to the smallest node seen,
    until the edges are stars. Every round is two keyed joins whose minima are pre-aggregated on the
    map side; a node with very many links is a skewed join, which Spark splits. The edges of a round
    are written to the shared folder. Empty input gives an empty result; self links are ignored.
    """
    def directed(df: DataFrame) -> DataFrame:
        return (df.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())

    current, seen = stage(directed(edges), "links"), None
    while True:
        stat = current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(stat) == seen:
            return (current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
                    .union(current.select(F.col("lo"), F.col("lo")).distinct()))
        seen = tuple(stat)
        both = current.union(current.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        up = directed(large)
        least = up.groupBy("hi").agg(F.min("lo").alias("m"))
        small = up.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("lo").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("hi").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        current = stage(directed(small), "links")
