"""Sources and sinks (A1-A4): CSV scan, ingest copy, split tables, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.session import scratch_path

# Strings read as missing by the original CSV reader's defaults.
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

FIRST_ROWS = 1000  # of a CSV file without a schema, tried before the others


class MissingInputError(FileNotFoundError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True,
             na_values: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """A1: CSV with header; a declared schema (preferred) or inferred types.

    Quotes inside a quoted field are doubled.  With ``multi_line`` a quoted
    field may hold line breaks; a file is then read by one task, otherwise it
    is split over tasks.  ``nullValue`` accepts one token, so the full NA list is applied as
    one projection on string columns before casting.  Inference is one
    aggregate over all present values (of the types that the first rows leave
    open): bigint, else double, else string.
    """
    if not _exists(spark, path):
        raise MissingInputError(path)
    na = na_values if na_values is not None else NA_STRINGS
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    reader = spark.read.option("header", header).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    raw = reader.csv(path)
    present = {n: F.when(~F.trim(F.col(f"`{n}`")).isin(*na), F.col(f"`{n}`")) for n in raw.columns}
    if schema is None:
        kinds = ("bigint", "double")

        def fitting(rows, tests):
            """Which of the (column, kind) every present value of the rows fits."""
            got = rows.agg(*[F.coalesce(F.bool_and(present[raw.columns[i]].try_cast(k).isNotNull() | present[raw.columns[i]].isNull()),
                                        F.lit(False)).alias(f"{i}_{k}") for i, k in tests]).first() if tests else ()
            return {test: bool(ok) for test, ok in zip(tests, got, strict=True)}

        # a kind that a few rows rule out need not be tried on all (a failed cast costs far more than one that fits)
        some = raw.limit(FIRST_ROWS)
        every = [(i, k) for i in range(len(raw.columns)) for k in kinds]
        fits = dict.fromkeys(every, False)
        if some.limit(1).count():
            fits |= fitting(raw, [test for test, ok in fitting(some, every).items() if ok])
        found = [next((k for k in kinds if fits[i, k]), "string") for i in range(len(raw.columns))]
        schema = T.StructType([T.StructField(n, T._parse_datatype_string(k)) for n, k in zip(raw.columns, found)])
    return raw.select(*[present[f.name].alias(f.name) if isinstance(f.dataType, T.StringType)
                        else present[f.name].try_cast(f.dataType).alias(f.name)  # malformed numbers -> null
                        for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("escape", '"').csv(path)


def ingest(spark: SparkSession, in_path: str, out_path: str, fmt: str = "parquet") -> dict:
    """A2: schema-agnostic copy with the row count observed during the write
    (no second pass).  Missing input raises."""
    if not _exists(spark, in_path):
        raise MissingInputError(in_path)
    from pyspark.sql import Observation
    src = spark.read.format(fmt).load(in_path)
    obs = Observation("ingest")
    src.observe(obs, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite").parquet(out_path)
    return {"row_count": int(obs.get["row_count"]), "path": out_path}


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """A3: one table partitioned by split; reading one split prunes the rest."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """A3: partition-pruned read of one split."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


def write_report(df: DataFrame, path: str) -> None:
    """A4: a (small) report table as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A unique folder under the shared scratch location."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
