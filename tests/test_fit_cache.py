import numpy as np

from strataflow.operators import models as J


def test_fits_read_the_same_rows_without_a_cache_of_their_own(spark, monkeypatch):
    """The estimators keep their input in a form of their own; a second copy of every row would only fill the disk."""
    from pyspark.sql import DataFrame
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self) or self)
    rng = np.random.default_rng(3)
    rows = [(i, "val" if i % 5 == 0 else "train", i % 3, [float(v) for v in rng.normal(i % 3, 0.2, 2)], "x" * 50) for i in range(90)]
    df = spark.createDataFrame(rows, "row_id long, split string, label int, features array<double>, extra string")
    for model in (J.train_focal(df, 3, max_iter=5), J.train_trees(df, 3, max_iter=2)):
        assert model.predict(df).where("prediction = label").count() > 80
    assert not kept
