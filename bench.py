"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and forces full evaluation through the ``noop`` sink
(no collect to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataflow.plans.catalog import queries  # noqa: E402
from strataflow.session import get_spark  # noqa: E402

HEADLINE = [
    "validate_table", "null_profile", "describe_exact", "corr_matrix", "mutual_info_target",
    "mutual_info_matrix", "feature_ranking", "stratified_split", "class_coverage", "balanced_resample",
    "feature_pipeline", "confusion_matrix", "f1_scores", "roc_curve", "auc_ovr", "threshold_scan",
    "log_loss", "latest_runs", "welch_pairs", "median_prune", "ks_two_sample", "median_bandwidth", "mmd_rbf",
    "posterior_variance", "reconstruction_error",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                      extra={"spark.strataflow.scan.partitions": str(cpus)})  # the tables are files of one row group
    qs = queries()
    spark.range(1000).selectExpr("sum(id)").collect()  # session start-up is not query time
    times = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
