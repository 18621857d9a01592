import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import drift as DR
from strataflow.operators import models as J


def _vecs(spark, z, offset=0):
    return spark.createDataFrame([(i + offset, [float(v) for v in row]) for i, row in enumerate(z)],
                                 "k long, z array<double>")


def test_bandwidth_exact_vs_numpy(spark):
    rng = np.random.default_rng(0)
    z = rng.normal(size=(101, 2))
    bw = DR.median_bandwidth(_vecs(spark, z), "z", "k", n_bins=64)
    iu = np.triu_indices(len(z), 1)
    d = np.sqrt(((z[:, None, :] - z[None, :, :]) ** 2).sum(-1))[iu]
    assert bw == pytest.approx(np.median(d) / math.sqrt(2), rel=1e-9)


def test_mmd_matches_numpy_and_detects_shift(spark):
    rng = np.random.default_rng(1)
    ref, new = rng.normal(size=(100, 2)), rng.normal(size=(50, 2))
    x, y = _vecs(spark, ref), _vecs(spark, new, 1000)
    bw = DR.median_bandwidth(x, "z", "k")
    assert 0.5 < bw < 5
    g = 1 / (2 * bw * bw)

    def k(a, b):
        return np.exp(-g * ((a[:, None] - b[None]) ** 2).sum(-1))
    kxx, kyy = k(ref, ref), k(new, new)
    mmd2 = ((kxx.sum() - np.trace(kxx)) / (100 * 99) + (kyy.sum() - np.trace(kyy)) / (50 * 49)
            - 2 * k(ref, new).mean())
    got = DR.mmd_rbf_pairs(x, y, "z", "k", bw)
    assert got == pytest.approx(math.sqrt(max(mmd2, 0)), abs=1e-9) and got >= 0
    assert not DR.detect_drift(x, y, "z", "k").first()["is_drifted"]
    assert DR.detect_drift(x, _vecs(spark, new + 10, 1000), "z", "k").first()["is_drifted"]


def test_all_pairs_count_above_one_block(spark):
    rng = np.random.default_rng(4)
    ref, new = rng.normal(size=(23, 2)), rng.normal(0.4, size=(310, 2))
    x, y = _vecs(spark, ref), _vecs(spark, new, 1000)
    d = np.sqrt(((new[:, None] - new[None]) ** 2).sum(-1))[np.triu_indices(len(new), 1)]
    assert DR.median_bandwidth(y, "z", "k", block=16, n_bins=64) == pytest.approx(np.median(d) / math.sqrt(2), rel=1e-9)

    def k(a, b):
        return np.exp(-((a[:, None] - b[None]) ** 2).sum(-1) / 2)
    kxx, kyy = k(ref, ref), k(new, new)
    mmd2 = (kxx.sum() - 23) / (23 * 22) + (kyy.sum() - 310) / (310 * 309) - 2 * k(ref, new).mean()
    for block in (16, 4096):  # 2 and 20 blocks, one block
        assert DR.mmd_rbf_pairs(x, y, "z", "k", 1.0, block) == pytest.approx(math.sqrt(mmd2), abs=1e-9)


def test_ks_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=80).round(1), rng.normal(0.5, size=60).round(1)
    ta = spark.createDataFrame([("f", float(v)) for v in a], "feature string, value double")
    tb = spark.createDataFrame([("f", float(v)) for v in b], "feature string, value double")
    got = DR.ks_two_sample(ta, tb, with_p=True).first()
    grid = np.union1d(a, b)
    d = max(abs(np.mean(a <= g) - np.mean(b <= g)) for g in grid)
    assert got["statistic"] == pytest.approx(d, abs=1e-6)
    assert 0.0 <= got["p_value"] <= 1.0


def _latent_data(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    y = np.array([0] * (n - 90) + [1] * 60 + [2] * 30)
    z = rng.normal(size=(n, 3)) + y[:, None] * 1.5
    split = np.where(np.arange(n) % 5 == 0, "val", np.where(np.arange(n) % 5 == 1, "test", "train"))
    rows = [(f"r{i}", str(s), int(t), [float(v) for v in row]) for i, (s, t, row) in enumerate(zip(split, y, z))]
    return spark.createDataFrame(rows, "row_id string, split string, label int, features array<double>")


def test_gmm_boost_increases_minority(spark):
    data = _latent_data(spark)
    m = J.train_gmm_classifier(data, {0: 1, 1: 1, 2: 1})
    base = m.predict(data).where("prediction = 2").count()
    boosted = m.predict(data, boost=50.0).where("prediction = 2").count()
    assert boosted > base


def test_trees_and_seed_sweep_pick_by_val(spark):
    data = _latent_data(spark, seed=1)
    runs, best = J.seed_sweep(data, lambda s: J.train_trees(data, 3, max_iter=3, seed=s), [0, 1], "ml")
    rows = runs.collect()
    assert len(rows) == 2
    vals = [r["metrics"]["val_macro_f1"] for r in rows]
    assert max(vals) > 0.5
    scored = best.predict(data)
    assert scored.where(F.size("probs") != 3).count() == 0


def test_stored_champions_score_alike(spark, tmp_path):
    from strataflow.operators import models as J
    from strataflow.operators.champion import load_champion, save_champion
    from strataflow.operators.latent import latent_pca
    rng = np.random.default_rng(3)
    rows = [(str(i), "train" if i % 5 else "val", i % 3, (rng.normal(size=4) + 2 * (i % 3)).tolist()) for i in range(300)]
    feats = spark.createDataFrame(rows, "row_id string, split string, label int, features array<double>")
    enc = latent_pca(feats, "features", 2).encoder()
    from strataflow.operators.latent import encode_batch
    lat = encode_batch(feats, enc, "features", out_mu="z", out_log_var=None).select(
        "row_id", "split", "label", F.col("z").alias("features"))
    for i, clf in enumerate((J.train_focal(lat, 3), J.train_trees(lat, 3, max_iter=2), J.train_gmm_classifier(lat, {0: 1, 1: 1, 2: 1}))):
        champ = J.Champion(enc, clf, tau=0.2)
        save_champion(spark, champ, str(tmp_path / f"c{i}"))
        again = load_champion(spark, str(tmp_path / f"c{i}"))
        a, b = ({r["row_id"]: r["prediction"] for r in c.score(feats).collect()} for c in (champ, again))
        assert a == b and len(a) == 300
