"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strataflow", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with AQE on and the UI off.

    On a cluster the master comes from spark-submit; ``master`` is only used
    for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:  # otherwise the cluster's own value holds
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("STRATAFLOW_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when nothing is configured (local
    tests) is a fresh private folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            # executors on other machines cannot read a driver-local folder
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="strataflow-ckpt-")  # local mode / tests only
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def materialize(df):
    """Compute ``df`` once into a table below the shared checkpoint folder and
    read it back: later references read the files instead of recomputing the
    input, and a lost executor does not force a recomputation from the source.
    (``checkpoint`` would run the last stage twice, once to count and once to
    write; it is left for columns without a type, which files cannot hold.)"""
    checkpoint_dir(df.sparkSession)
    schema = df.schema
    if any(f.dataType.typeName() == "void" for f in schema.fields):
        return df.checkpoint(eager=True)
    path = scratch_path(df.sparkSession, uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
