"""Queries that must not write their rows more often than they need."""

import os

import numpy as np
from pyspark.sql import functions as F

from strataflow.operators import counterfactuals as CF
from strataflow.operators import latent as LT
from strataflow.operators import training as TR
from strataflow.operators import tuning as TU
from strataflow.plans import q_fitted, q_streaming
from strataflow.sources import io as IO


def test_a_stream_of_features_reads_the_files_of_their_table(spark, sf_dir, monkeypatch):
    feats, _ = q_fitted.feature_table(spark, sf_dir)
    q_fitted.latent_table(spark, sf_dir)
    made, fresh = [], IO.fresh_path
    monkeypatch.setattr(IO, "fresh_path", lambda spark, name: (made.append(name), fresh(spark, name))[1])
    scored = q_streaming.q_stream_score(spark, sf_dir)
    assert sorted(made) == ["score-ck", "score-out"]  # no copy of the features
    got, want = scored.select("row_id", "label"), feats.select("row_id", "label")
    assert scored.columns[:3] == ["row_id", "label", "prediction"] and scored.where("prediction is null").count() == 0
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_counterfactuals_write_the_kept_states_alone(spark, monkeypatch):
    def predict(df):
        total = F.aggregate("features", F.lit(0.0), lambda a, v: a + v)
        return df.withColumn("probs", F.array(-total, total)).withColumn("prediction", (total > 3).cast("int"))

    rows = spark.createDataFrame([(i, [0.0, 0.1 * (i % 7), 0.0]) for i in range(30)], "id long, features array<double>")
    written, keep = [], CF.materialize
    monkeypatch.setattr(CF, "materialize", lambda d: (written.append((m := keep(d)).count()), m)[1])
    moves = {j: [0.5, 1.0, 2.0] for j in range(3)}
    found = CF.counterfactuals(predict, rows, "id", moves, 1, beam=2, max_changes=2).collect()
    assert written == [30, 60, 30]  # nine states were tried of each row, then twice as many
    assert {(r["n_changes"], r["cost"], str(r["changes"])) for r in found if r["id"] % 7 == 0} == {
        (2, 4.0, "[Row(feature=0, value=2.0), Row(feature=1, value=2.0)]")}


def test_tables_of_a_session_are_packed(spark, sf_dir):
    path = q_fitted.feature_files(spark, sf_dir)
    names = os.listdir(path.removeprefix("file:"))
    assert any(n.endswith(".zstd.parquet") for n in names)


def test_a_search_writes_the_real_rows_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) * [4, 3, 2, 1]
    rows = [(i, "val" if i % 4 == 0 else "train", 2 if i % 12 == 1 else i % 2, x[i].tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, split string, label int, features array<double>")
    tables, written, keep = TU.TuningTables(df, widest=3), [], TR.materialize
    monkeypatch.setattr(TR, "materialize", lambda d: (written.append((m := keep(d))), m)[1])
    pairs = [(ratio, size) for ratio in (0.2, 0.3) for size in (2, 3)]
    blocks = {p: tables.encoded(*p) for p in pairs}
    sizes = [sum(len(r["y"]) // 4 for r in m.collect()) for m in written]
    assert len(written) == 3 and sorted(sizes)[-1] == 300  # the real rows, and those generated for either ratio
    for (ratio, size), rows in blocks.items():
        want = LT.encode_batch(tables.augmented(ratio).where("split = 'val'"), tables.space(size).encoder(), "features", "z", None)
        got = sorted(list(r["features"]) for r in TR.validation_rows(rows, size).collect())
        assert np.allclose(got, sorted(list(r["z"]) for r in want.collect())) and len(got) == 75
        train = tables.augmented(ratio).where("split = 'train'")
        assert TR._add_up(rows, size, 1, lambda x, y, h, val: np.array([float((~val).sum())]))[0] == train.count()
