"""Base tables and the stand-in views used by tests, bench and the catalog.

The driver tables are TPC-H-like parquet files.  The four stand-in views map
them onto the shapes the operators work on: crash-like ``records``, a
``latent`` vector table, a run ``ledger`` and a ``predictions`` table.  The
view text is plain SQL that runs unchanged in Spark and DuckDB, so the same
text is used by the oracle queries.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Stand-in view definitions (shared verbatim with the DuckDB oracle).
RECORDS_SQL = """
SELECT md5(concat_ws('|', cast(l_orderkey AS string), cast(l_linenumber AS string), cast(l_partkey AS string),
           cast(l_suppkey AS string), cast(cast(round(l_extendedprice * 100) AS bigint) AS string),
           cast(cast(l_shipdate AS date) AS string))) AS row_id,
       CASE WHEN l_suppkey % 97 = 5 THEN 99 ELSE l_partkey % 24 END AS hour,
       CASE l_partkey % 7 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday'
            WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END AS weekday,
       cast(year(l_shipdate) AS int) AS year, cast(month(l_shipdate) AS int) AS month_no,
       CASE WHEN l_suppkey % 50 = 3 THEN 99 ELSE 25 + 5 * (l_partkey % 10) END AS speed_limit,
       CASE WHEN l_discount >= 0.095 THEN 999 WHEN l_tax < 0.005 THEN NULL
            ELSE 14 + cast(floor(l_extendedprice) AS bigint) % 80 END AS driver_age,
       CASE WHEN l_tax > 0.075 THEN NULL ELSE l_returnflag END AS weather,
       l_linestatus AS surface, 1 + l_linenumber % 4 AS n_vehicles,
       l_extendedprice AS x1, l_discount AS x2, l_tax AS x3, l_quantity AS n_harmed,
       CASE WHEN l_quantity >= 50 THEN 'Fatal' WHEN l_quantity >= 41 THEN 'Injury'
            ELSE 'Property Damage Only' END AS severity
FROM lineitem
"""

LATENT_SQL = """
SELECT vec_id AS row_id, embedding AS z, CASE WHEN label = 0 THEN 2 WHEN label <= 2 THEN 1 ELSE 0 END AS label
FROM embeddings
"""

LEDGER_SQL = """
SELECT event_type AS experiment, event_id AS run_id, user_id % 10 AS seed, ts AS start_time,
       CASE WHEN event_id % 11 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / (1 + value) END AS macro_f1,
       value / (50 + value) AS class_recall
FROM events
"""

PREDICTIONS_SQL = """
SELECT row_id, CASE severity WHEN 'Fatal' THEN 2 WHEN 'Injury' THEN 1 ELSE 0 END AS label,
       (1 + x2 * 10) / s AS p0, (0.5 + x3 * 10) / s AS p1, (0.02 * n_vehicles * n_harmed / 10) / s AS p2
FROM (SELECT *, 1.5 + x2 * 10 + x3 * 10 + 0.02 * n_vehicles * n_harmed / 10 AS s FROM records)
"""

STANDIN_SQL = {
    "records": RECORDS_SQL,
    "latent": LATENT_SQL,
    "ledger": LEDGER_SQL,
    "predictions": PREDICTIONS_SQL,
}


def oracle_prelude() -> str:
    """``WITH`` clause defining the stand-in views for DuckDB."""
    parts = [f"{name} AS ({sql.strip()})" for name, sql in STANDIN_SQL.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """The scan as it is, unless the session sets ``spark.strataflow.scan.partitions``: then its rows are dealt to
    that many partitions.  For local runs on files of a single row group, which one task reads; a cluster leaves
    the setting alone."""
    n = df.sparkSession.conf.get("spark.strataflow.scan.partitions", "")
    return df.repartition(int(n)) if n else df


class Tables:
    """Lazy access to base tables and stand-in views of one data directory.

    Stand-ins are plain lazy DataFrames (no caching), so Catalyst prunes and
    pushes filters from every query into the parquet scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def _view(self, name: str, sources: tuple[str, ...]) -> DataFrame:
        """The stand-in SQL over DataFrame arguments (``spark.sql`` binds each
        ``{name}`` to a private view), so no session-wide view is replaced."""
        if name not in self._cache:
            args = {s: (self.base(s) if s in BASE_TABLES else self._cache[s]) for s in sources}
            sql = STANDIN_SQL[name]
            for s in sources:
                sql = re.sub(rf"\bFROM {s}\b", f"FROM {{{s}}}", sql)
            self._cache[name] = self.spark.sql(sql, **args)
        return self._cache[name]

    def records(self) -> DataFrame:
        return self._view("records", ("lineitem",))

    def latent(self) -> DataFrame:
        return self._view("latent", ("embeddings",))

    def ledger(self) -> DataFrame:
        return self._view("ledger", ("events",))

    def predictions(self) -> DataFrame:
        self.records()
        return self._view("predictions", ("records",))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
