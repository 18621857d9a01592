import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from strataflow.operators import drift as DR
from strataflow.plans import catalog


def vecs(spark, z, key=None):
    return spark.createDataFrame([(i if key is None else key, [float(v) for v in row]) for i, row in enumerate(z)],
                                 "k long, z array<double>")


def brute(x, y):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    h = float(np.median(d[np.triu_indices(len(x), 1)])) / math.sqrt(2)

    def own(a):
        k = np.exp(-((a[:, None] - a[None]) ** 2).sum(-1) / (2 * h * h))
        return (k.sum() - len(a)) / (len(a) * (len(a) - 1))
    cross = np.exp(-((x[:, None] - y[None]) ** 2).sum(-1) / (2 * h * h)).mean()
    return h, math.sqrt(max(own(x) + own(y) - 2 * cross, 0.0))


def test_queries_take_all_pairs_of_the_whole_table(spark, tmp_path):
    """More rows than the bounded reference, so that a sample or an approximate kernel shows."""
    x = np.random.default_rng(5).normal(size=(1300, 3)).astype(np.float32)
    pq.write_table(pa.table({"vec_id": pa.array(range(len(x)), pa.int64()), "embedding": pa.array(list(x), pa.list_(pa.float32())),
                             "label": pa.array([i % 10 for i in range(len(x))], pa.int32())}), tmp_path / "embeddings.parquet")
    wide = x.astype(np.float64)
    h, mmd = brute(wide, wide + 0.1)
    queries = catalog.queries()
    assert queries["median_bandwidth"](spark, str(tmp_path)).first()["bandwidth"] == pytest.approx(h, abs=2e-6)
    assert queries["mmd_rbf"](spark, str(tmp_path)).first()["mmd"] == pytest.approx(mmd, abs=2e-6)
    r = queries["detect_drift"](spark, str(tmp_path)).first()
    assert (r["mmd"], r["bandwidth"], r["threshold"]) == pytest.approx((mmd, h, h / 2), abs=2e-6)


def test_pairs_of_blocks_are_not_shuffled(spark):
    blocks = DR._blocks(vecs(spark, np.random.default_rng(6).normal(size=(90, 2))), "z", block=8)
    assert blocks.agg({"n": "sum"}).first()[0] == 90
    for tiles in (DR._tiles(blocks), DR._tiles(blocks, blocks)):
        plan = tiles._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan


def test_one_key_does_not_make_one_block(spark):
    z = np.random.default_rng(7).normal(size=(200, 2))
    df = vecs(spark, z, key=1)
    assert DR._blocks(df, "z", block=16).agg({"n": "max"}).first()[0] <= 16
    h, _ = brute(z, z)
    assert DR.median_bandwidth(df, "z", "k", block=16) == pytest.approx(h, rel=1e-9)


def test_median_where_the_first_range_misses_and_among_copies(spark, monkeypatch):
    z = np.random.default_rng(8).normal(size=(150, 2))
    h, _ = brute(z, z)
    for guess in ((0.001, 0.002), (30.0, 31.0)):
        monkeypatch.setattr(DR, "_first_guess", lambda b, g=guess: g)
        assert DR.median_bandwidth(vecs(spark, z), "z", "k", n_bins=64, max_collect=100) == pytest.approx(h, rel=1e-9)
    monkeypatch.undo()
    same = vecs(spark, np.repeat([[3.0, 4.0]], 60, axis=0))
    assert DR.median_bandwidth(same, "z", "k", max_collect=10) == 1e-6
    two = vecs(spark, np.array([[0.0], [5.0]] * 40))
    assert DR.median_bandwidth(two, "z", "k", n_bins=64, max_collect=10) == pytest.approx(5 / math.sqrt(2), rel=1e-9)
