from pyspark.sql import functions as F

from strataflow.plans.catalog import queries
from strataflow.plans.q_profile import RECORD_COLS
from strataflow.sources.tables import tables


def test_null_profile_full_reads_every_column(spark, sf_dir, tmp_path):
    assert tables(spark, sf_dir).records().columns == RECORD_COLS
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(50).withColumn("l_linestatus", F.lit(None).cast("string"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r["column_name"]: r["n_null"] for r in queries()["null_profile_full"](spark, str(tmp_path)).collect()}
    assert got["surface"] == 50


def test_latent_feature_corr_full_takes_all_dimensions(spark, sf_dir):
    got = {(r["latent"], r["feature"]) for r in queries()["latent_feature_corr_full"](spark, sf_dir).collect()}
    assert {("z0", "x_b"), ("z8", "x_a"), ("z9", "x_a")} <= got


def test_grade_audit_full_has_six_metrics(spark, sf_dir):
    got = {r["metric"] for r in queries()["grade_audit_full"](spark, sf_dir).collect()}
    assert len(got) == 6 and {"minority_kl_above", "ks_aligned_share"} <= got
