"""Micro-batch application of the batch operators with Structured Streaming.

The original pipeline is batch-only; these helpers run the same contract
validation (C1-C6) and champion scoring (K5) on data that keeps arriving in
a folder.  ``foreachBatch`` hands each micro-batch to the batch operator.  A
batch may be handed out again after a failure, so each writes a folder of its
own, ``batch_id=<n>``, over what an earlier attempt has left: the output holds
every batch exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators import quality as Q


def validate_stream(spark: SparkSession, source_dir: str, schema: T.StructType, contracts, out_path: str,
                    checkpoint: str, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Validate every arriving micro-batch against the contract suite; rule
    results (one row per rule and batch) are added to ``out_path``."""
    rules = Q.build_suite(contracts)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    Q.pre_validate(stream, rules)
    # built once: making some hundred expressions takes longer than a small batch's rows do
    counts, results = Q.suite_counts(rules, schema), Q.suite_results()

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        Q.run_rules(batch, rules, counts, results).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def rule_totals(results: DataFrame) -> DataFrame:
    """Combine per-batch rule results into whole-stream totals."""
    agg = results.groupBy("rule_id", "column_name", "rule", "mostly").agg(
        F.sum("n_checked").alias("n_checked"), F.sum("n_ok").alias("n_ok"))
    share = F.when(F.col("n_checked") > 0, F.col("n_ok") / F.col("n_checked"))
    return agg.select("rule_id", "column_name", "rule", "mostly", "n_checked", "n_ok",
                      F.round(share, 6).alias("ok_share"), F.coalesce(share >= F.col("mostly"), F.lit(True))
                      .alias("success"))


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, champion, out_path: str,
                 checkpoint: str, features: str = "features", keep: list[str] = ("row_id",),
                 available_now: bool = True):
    """Score arriving rows with a champion (features -> latent -> label)."""
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        scored = champion.score(batch, features)
        scored.select(*keep, "prediction").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
