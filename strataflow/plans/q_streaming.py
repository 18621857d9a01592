"""Catalog entry for the streaming validation monitor."""

from __future__ import annotations

from strataflow.config import RECORDS_CONTRACT
from strataflow.operators import quality as Q
from strataflow.plans.catalog import register
from strataflow.plans.q_quality import rules_sql
from strataflow.sources import io as IO
from strataflow.sources.tables import tables
from strataflow.streaming import monitor as S

FILE_ROWS = 20_000  # rows of an arriving file
FILES = 8           # files in a micro-batch


@register("stream_validate", rules_sql(Q.build_suite(RECORDS_CONTRACT)))
def q_stream_validate(spark, sf_dir):
    """records land as several files; the stream validates each micro-batch
    and the per-batch counts add up to the whole-table rule results."""
    r = tables(spark, sf_dir).records()
    src = IO.fresh_path(spark, "stream-src")
    r.write.option("maxRecordsPerFile", FILE_ROWS).parquet(src)
    out, ck = IO.fresh_path(spark, "stream-out"), IO.fresh_path(spark, "stream-ck")
    q = S.validate_stream(spark, src, r.schema, RECORDS_CONTRACT, out, ck, max_files_per_trigger=FILES)
    q.awaitTermination()
    return S.rule_totals(spark.read.parquet(out))


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """Feature rows arrive as files, those of the feature table; they are scored by
    the champion (PCA encoder + focal logistic model)."""
    from strataflow.operators import models as J
    from strataflow.plans.q_fitted import feature_files, feature_table, latent_table, pca_fit
    feats, _ = feature_table(spark, sf_dir)
    champ = J.Champion(pca_fit(spark, sf_dir).encoder(), J.train_focal(latent_table(spark, sf_dir), 3))
    out, ck = IO.fresh_path(spark, "score-out"), IO.fresh_path(spark, "score-ck")
    q = S.score_stream(spark, feature_files(spark, sf_dir), feats.schema, champ, out, ck, keep=["row_id", "label"])
    q.awaitTermination()
    return spark.read.parquet(out)
