import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import queries, whitening

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(rows, most=32):
    """Eigenvectors of the exact covariance: ids, deviations, whitened rows, explained shares."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[n * a - b for a, b in zip(r, s)] for r in x], dtype=object)
    cov = np.array((y.T @ y).tolist(), dtype=np.float64) / n / n / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    return [i for i, _ in rows], [int((r * r).sum()) for r in y], (y.astype(np.float64) / n) @ v / np.sqrt(e), e / np.trace(cov)


def compare(got, rows, k):
    ids, deviations, white, shares = brute(rows, k)
    assert len(got) == len(rows) * k
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(k):
        mine = np.array([by[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine - sign * white[:, c]).max() < 1e-8
        assert abs(by[ids[0], c + 1].explained / shares[c] - 1) < 1e-9
    assert [int(by[i, 1].deviation) for i in ids] == deviations
    assert {r.n for r in got} == {len(rows)} and len({r.identity_error for r in got}) == 1
    assert 0 <= got[0].identity_error < 1e-8


def test_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.op13_whitening(spark, sf_dir).collect()
    assert list(got[0].asDict()) == NAMES
    compare(got, rows, 32)


def test_dependent_constant_and_equal_dimensions(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 4)) * [9, 4, 2, 1]
    whole = np.floor(64 * a) / 64
    # a doubled dimension, a constant one, and two of exactly equal, uncorrelated deviation
    turn = np.array([(1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, -1.0)] * 75)
    rows = [(i, [*r, 2 * r[0], 7.0]) for i, r in enumerate(whole.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = whitening.whiten(df).collect()
    compare(got, rows, 4)
    pairs = spark.createDataFrame([(i, r) for i, r in enumerate(turn.tolist())], "vec_id long, embedding array<float>")
    even = whitening.whiten(pairs).collect()
    assert len(even) == 600 and even[0].identity_error < 1e-10 and {round(r.explained, 12) for r in even} == {0.5}


def test_messy_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in r]) for i, r in enumerate(rng.normal(size=(40, 5)))] + [(None, [1.0] * 5), (50, [0.0] * 5)]
    bad = [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0]), (62, [float("nan")] * 5), (63, [float("inf")] * 5), (64, []), (65, [1.0])]
    repeated = [(3, good[3][1])] * 7
    df = spark.createDataFrame(good + bad + repeated, "vec_id long, embedding array<double>")
    df = df.withColumn("component", F.lit("x")).withColumn("x", F.lit(1)).withColumn("n", F.lit(2))
    got = whitening.whiten(df).collect()
    assert len(got) == 49 * 5 and got[0].n == 49 and got[0].identity_error < 1e-10
    assert len([r for r in got if r.vec_id == 3]) == 8 * 5


def test_no_variance_or_no_rows(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    with pytest.raises(Exception, match="does not fit a long"):
        whitening.whiten(spark.createDataFrame([(1, [1e30, 1.0]), (2, [2.0, 1.0])], schema))


def test_wide_values_keep_exact_deviations(spark):
    rows = [(i, [float(i % 7) * 2 ** 24, float(i % 5)]) for i in range(35)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.vec_id, int(r.deviation)) for r in got} == set(zip(range(35), brute(rows)[1]))
    assert any(int(r.deviation) >= 1 << 63 for r in got)


def test_fewer_steps_still_find_the_leading_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, r) for i, r in enumerate((rng.normal(size=(200, 30)) * 2.0 ** -np.arange(30) * 1000).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    compare(whitening.whiten(df, components=3, steps=12).collect(), rows, 3)
