"""Run ledger and champion registry as tables.

The ledger is an append-only parquet table of run records; the registry an
append-only table of published versions.  Reads are window / aggregate
queries; ``row_number() <= n`` filters are planned by Catalyst with a
per-partition group limit before the shuffle (WindowGroupLimit), so only n
rows per group and partition move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("seed", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


def run_records(df: DataFrame, metric_cols: list[str], param_cols: list[str] = (), experiment: str = "experiment",
                run_id: str = "run_id", seed: str = "seed", status: str = "status",
                start_time: str = "start_time") -> DataFrame:
    """Wide run rows -> ledger records with params / metrics maps."""
    params = F.create_map(*[x for p in param_cols for x in (F.lit(p), F.col(p).cast("string"))]) if param_cols \
        else F.create_map().cast("map<string,string>")
    metrics = F.map_filter(F.create_map(*[x for m in metric_cols for x in (F.lit(m), F.col(m).cast("double"))]),
                           lambda k, v: v.isNotNull())
    return df.select(F.col(experiment).cast("string").alias("experiment"), F.col(run_id).cast("string").alias("run_id"),
                     F.col(seed).cast("bigint").alias("seed"), F.col(status).alias("status"),
                     F.col(start_time).cast("timestamp_ntz").alias("start_time"),
                     params.alias("params"), metrics.alias("metrics"))


def log_runs(records: DataFrame, path: str) -> None:
    """A5: append run records to the ledger table (partitioned by experiment)."""
    records.write.mode("append").partitionBy("experiment").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def tall_metrics(records: DataFrame) -> DataFrame:
    """A5 tall form: one row per (run, metric)."""
    return records.select("experiment", "run_id", F.explode(F.map_entries("metrics")).alias("e")).select(
        "experiment", "run_id", F.col("e.key").alias("metric"), F.col("e.value").alias("value"))


def latest_runs(ledger: DataFrame, n: int, metrics: list[str], experiment: str = "experiment",
                start_time: str = "start_time", tiebreak: str = "run_id", status: str = "status") -> DataFrame:
    """Latest ``n`` FINISHED runs per experiment, THEN drop runs with a
    null metric (so fewer than n can remain)."""
    w = Window.partitionBy(experiment).orderBy(F.desc(start_time), F.desc(tiebreak))
    top = (ledger.where(F.col(status) == "FINISHED").withColumn("_rn", F.row_number().over(w))
                 .where(F.col("_rn") <= n).drop("_rn"))
    return top.dropna(subset=metrics)


def best_run(ledger: DataFrame, metric: str, experiment: str = "experiment", tiebreak: str = "run_id") -> DataFrame:
    """The run with the highest metric per experiment (ties: smallest id)."""
    w = Window.partitionBy(experiment).orderBy(F.desc_nulls_last(metric), F.asc(tiebreak))
    return (ledger.where(F.col(metric).isNotNull()).withColumn("_rn", F.row_number().over(w))
                  .where(F.col("_rn") == 1).drop("_rn"))


def publish_champion(candidates: DataFrame, name: str, order: str = "start_time",
                     existing: DataFrame | None = None, gate: str = "gates_passed") -> DataFrame:
    """Q1: registry rows for candidates that passed their gates, versions
    continuing after ``existing``, in ``order``; the newest gets the
    'champion' alias.  A ``path`` column (where the artefacts are) goes along.
    Returns the full registry (existing + new)."""
    base_version = 0
    if existing is not None:
        mx = existing.where(F.col("name") == name).agg(F.max("version").alias("v")).first()["v"]
        base_version = int(mx or 0)
    passed = candidates.where(F.col(gate))
    w = Window.orderBy(order, "run_id")  # publications: a handful of rows
    new = passed.select(F.lit(name).alias("name"),
                        (F.lit(base_version) + F.row_number().over(w)).cast("bigint").alias("version"),
                        F.col("run_id").cast("string").alias("run_id"), F.col("experiment").cast("string"),
                        F.lit(None).cast("string").alias("alias"),
                        F.col(order).cast("timestamp_ntz").alias("published_at"),
                        *([F.col("path")] if "path" in candidates.columns else []))
    reg = new if existing is None else existing.unionByName(new, allowMissingColumns=True)
    latest = F.max("version").over(Window.partitionBy("name"))
    return reg.withColumn("alias", F.when(F.col("version") == latest, F.lit("champion")))


def resolve_champion(registry: DataFrame, name: str, alias: str = "champion") -> DataFrame:
    """Q2: the version row behind ``name@alias`` (newest if several)."""
    r = registry.where((F.col("name") == name) & (F.col("alias") == alias))
    return r.agg(F.max_by(F.struct(*registry.columns), "version").alias("r")).select("r.*").where(
        F.col("version").isNotNull())
