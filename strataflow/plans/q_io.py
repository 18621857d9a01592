"""Catalog entries for sources and sinks (A1-A4).

Each query writes data derived from the given tables to a fresh folder under
the shared scratch location and reads it back through the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.operators import metrics as L
from strataflow.plans.catalog import register
from strataflow.plans.q_rules_metrics import f1_sql, cm_sql, SCORED, scored
from strataflow.plans.q_sampling import SPLIT_CTES, split_records
from strataflow.sources import io as IO
from strataflow.sources.tables import tables


@register("scan_csv", "SELECT row_id, weather, x1, driver_age FROM records")
def q_scan_csv(spark, sf_dir):
    r = tables(spark, sf_dir).records().select("row_id", "weather", "x1", "driver_age")
    path = IO.fresh_path(spark, "csv")
    IO.write_csv(r, path)
    return IO.scan_csv(spark, path, "row_id string, weather string, x1 double, driver_age bigint")


@register("scan_csv_inferred", "SELECT row_id, weather, x1, driver_age FROM records")
def q_scan_csv_inferred(spark, sf_dir):
    """The same file without a schema: types from the present values."""
    r = tables(spark, sf_dir).records().select("row_id", "weather", "x1", "driver_age")
    path = IO.fresh_path(spark, "csv")
    IO.write_csv(r, path)
    return IO.scan_csv(spark, path)


@register("ingest", "SELECT count(*) AS row_count, round(sum(l_quantity), 2) AS sum_qty FROM lineitem")
def q_ingest(spark, sf_dir):
    out = IO.fresh_path(spark, "ingest")
    res = IO.ingest(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", out)
    copy = spark.read.parquet(res["path"])
    return copy.agg(F.lit(res["row_count"]).cast("bigint").alias("row_count"),
                    F.round(F.sum("l_quantity"), 2).alias("sum_qty"))


@register("read_split", f"WITH {SPLIT_CTES} SELECT row_id, label FROM splits WHERE split = 'test'")
def q_read_split(spark, sf_dir):
    path = IO.fresh_path(spark, "splits")
    IO.write_splits(split_records(spark, sf_dir).select("row_id", "label", "split"), path)
    return IO.read_split(spark, path, "test").select("row_id", "label")


@register("write_report", f"WITH {SCORED} SELECT * FROM {f1_sql(cm_sql('sc'))}")
def q_write_report(spark, sf_dir):
    rep = L.f1_scores(L.confusion_matrix(scored(spark, sf_dir)))
    path = IO.fresh_path(spark, "report")
    IO.write_report(rep, path)
    return IO.read_report(spark, path, rep.schema)
