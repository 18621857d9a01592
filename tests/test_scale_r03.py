"""Steps that must not grow with columns, failed casts or hot cells."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector

from strataflow.functions import arrow as A
from strataflow.operators import latent as LT
from strataflow.operators import models as J
from strataflow.operators import neighbours as NB
from strataflow.operators import quality as Q
from strataflow.operators import sampling as E
from strataflow.operators import training as TR
from strataflow.plans import q_sampling
from strataflow.sources import io as IO
from strataflow.streaming import monitor as S


def test_folds_rank_no_more_than_they_need(spark, sf_dir, monkeypatch):
    seen, rank = [], E.global_rank
    monkeypatch.setattr(E, "global_rank", lambda df, *a, **k: (seen.append(df.dtypes), rank(df, *a, **k))[1])
    q_sampling.q_k_fold(spark, sf_dir)
    assert seen == [[("label", "int"), ("row_id", "string"), ("_h", "binary")]]


def test_inference_reads_rows_after_the_first(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(IO, "FIRST_ROWS", 2)
    rows = [(str(i), "x" if i < 2 else "1", "1" if i < 5 else "1.5", "1" if i < 5 else "late") for i in range(6)]
    IO.write_csv(spark.createDataFrame(rows, "a string, b string, c string, d string").coalesce(1), str(tmp_path / "t"))
    assert IO.scan_csv(spark, str(tmp_path / "t")).dtypes == [("a", "bigint"), ("b", "string"), ("c", "double"), ("d", "string")]


def test_neighbours_of_a_hot_cell_and_equal_rows(spark):
    x = np.random.default_rng(0).integers(0, 3, (150, 3)).astype(float)  # many equal rows
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "id long, v array<double>")
    got = sorted((r[0], r[1], r[2]) for r in NB.knn_join(df, df, "v", "id", 3, exclude_self=True, pivots=2, block=16).collect())
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = [(i, n + 1, j) for i in range(150) for n, j in enumerate(
        [j for j in sorted(range(150), key=lambda j: (far[i, j], j)) if j != i][:3])]
    assert got == want


def test_matrix_and_lists():
    x = np.arange(6.0).reshape(3, 2)
    assert np.array_equal(A.matrix(A.lists(x)), x)
    assert np.array_equal(A.matrix(A.lists(x).slice(1, 2)), x[1:])
    for bad in ([[1.0], None], [[1.0], [1.0, 2.0]]):
        with pytest.raises(ValueError):
            A.matrix(pa.array(bad))


def _split_rows(spark):
    rows = [(i, "val" if i % 4 == 0 else "train", i % 3, [float(i % 7), float(i % 3)]) for i in range(60)]
    return spark.createDataFrame(rows, "row_id long, split string, label int, features array<double>")


def test_training_rows_are_written_as_blocks(spark, monkeypatch):
    monkeypatch.setattr(TR, "STRIP", 8)
    rows = TR.prepared_rows(_split_rows(spark).coalesce(1), 2, 3, "features", "label", "split", "row_id", ("train", "val"))
    assert rows.columns == ["x", "y", "h", "val"] and 8 <= rows.count() <= 60
    back = sorted((tuple(r["features"]), r["label"]) for r in TR.validation_rows(rows, 2).collect())
    assert back == sorted(((float(i % 7), float(i % 3)), i % 3) for i in range(0, 60, 4))


def test_a_sweep_keeps_no_copy_of_its_rows(spark):
    df, kept = _split_rows(spark), []

    class Model:
        def predict(self, rows):
            return rows.withColumn("prediction", rows["label"])

    J.seed_sweep(df, lambda s: (kept.append(df.storageLevel.useMemory), Model())[1], [0, 1], "m")
    assert kept == [False, False]


def test_rules_of_a_stream_are_built_once(spark, tmp_path, monkeypatch):
    built, count = [], Q._rule_counts
    monkeypatch.setattr(Q, "_rule_counts", lambda rule, schema: (built.append(rule.name), count(rule, schema))[1])
    df = spark.createDataFrame([(i if i else None,) for i in range(6)], "a int").repartition(3)
    df.write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "in"))
    query = S.validate_stream(spark, str(tmp_path / "in"), df.schema, {"a": {"min": 2, "max": 9}}, str(tmp_path / "out"),
                              str(tmp_path / "ck"), max_files_per_trigger=2)
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert built == ["not_null [a]", "between [a]"] and out.select("batch_id").distinct().count() == 3
    assert [(r["n_checked"], r["n_ok"]) for r in S.rule_totals(out).orderBy("rule_id").collect()] == [(6, 5), (5, 4)]


def test_latent_space_in_one_pass_as_mllib(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5)) + 1000.0
    df = spark.createDataFrame([(r.tolist(),) for r in x], "f array<double>")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    fit = LT.latent_pca(df.mapInArrow(counted, df.schema), "f", 3)
    assert read.value < 2 * len(x)  # all rows once, and the first one to shift by
    model = PCA(k=3, inputCol="v", outputCol="p").fit(df.select(array_to_vector("f").alias("v")))
    assert np.allclose(fit.components, model.pc.toArray(), atol=1e-7)  # signs included
    assert np.allclose(fit.explained, model.explainedVariance.toArray()) and np.allclose(fit.mean, x.mean(axis=0))
    with pytest.raises(ValueError):
        LT.latent_pca(df.limit(1), "f", 3)
