import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import queries, vectors


def brute(rows, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_recall_on_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows)
    got = queries.op5_vectors(spark, sf_dir).collect()
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_recall_beyond_one_block(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(6000, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index, size = vectors.build_index(df, pivots=128)
    got = vectors.nearest(index, size, index.where("vec_id % 100 = 0")).collect()
    want = brute(rows)
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert hits >= 0.9 * 10 * len(want)
    exact = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(abs(exact.get((r.query_id, r.vec_id), r.score) - r.score) < 1e-12 for r in got)
    assert index.count() == len(rows)


def test_bad_vectors_ties_and_repeats(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(0, v), (0, v), (5, [1.0, 2.0, 4.0]), (3, [1.0, 2.0, 4.0]), (7, None), (8, [0.0, 0.0, 0.0]), (9, [1.0, None, 2.0]),
            (10, [float("nan"), 1.0, 1.0]), (11, [float("inf"), 1.0, 1.0]), (12, []), (100, [1.0]), (None, v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit(1)).withColumn("v", F.lit(2))
    index, size = vectors.build_index(df)
    assert size == 3 and index.count() == 4
    got = vectors.nearest(index, size, index.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert len(got) == 6  # two queries of id 0, three others each
    assert {(r.rank, r.vec_id, r.score) for r in got if r.vec_id in (3, 5)} == {(2, 3, 1.0), (3, 5, 1.0)}


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    index, size = vectors.build_index(df)
    assert vectors.nearest(index, size, index).count() == 0


@pytest.mark.parametrize("d", [64, 128])
def test_recall_and_rows_touched_without_structure(spark, d):
    """Gaussian vectors, the hardest case: every direction is alike."""
    rng = np.random.default_rng(d)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(10_000, d)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(1)
    index, size = vectors.build_index(df)
    got = vectors.nearest(index, size, index.where("vec_id % 100 = 0"), least=0).collect()
    want = brute(rows)
    recall = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got) / (10 * len(want))
    assert recall >= 0.9, recall
    near = np.array([np.frombuffer(r.near, "<u2") for r in index.select("near").collect()])
    files = vectors.Files(near)
    lengths = np.diff(np.concatenate([[0], files.ends]))
    read = np.mean([lengths[near[q, :vectors.ASKED]].sum() for q in range(0, 10_000, 100)])
    print(f"recall {recall}, postings read {read / near.size}")
    assert read < 0.15 * near.size, read / near.size  # of all postings


def test_footrule_is_that_of_its_definition():
    rng = np.random.default_rng(2)
    near = np.array([rng.permutation(20)[:6] for _ in range(50)])
    asked = np.array([3, 17, 0, 9])
    got = vectors.Files(near).footrule(asked)
    want = [sum(abs((list(r).index(p) if p in r else 6) - i) for i, p in enumerate(asked)) for r in near]
    assert (got - got.min()).tolist() == [w - min(want) for w in want]
    assert vectors.Files(near[:0]).footrule(asked[:0]).tolist() == []
