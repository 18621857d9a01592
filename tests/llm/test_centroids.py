import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import centroids

NAMES = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k=8, rounds=10, size=64, scale=1024, seed=3):
    kept = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()))
    centres = [x for _, x in start[:k]]

    def assign():
        found = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        of = assign()
        for c in range(len(centres)):
            own = [x for (_, x), (at, _) in zip(kept, of) if at == c]
            if own:
                centres[c] = [sum(col) // len(own) for col in zip(*own)]
    of = assign()
    inertia = [sum(d for at, d in of if at == c) for c in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i if i is not None else -1), at, d, inertia[at], sum(inertia), digest[at]) for (i, _), (at, d) in zip(kept, of))


def got(df):
    return sorted(tuple(-1 if r[n] is None else r[n] for n in NAMES) for r in df.collect())


def test_the_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(centroids.cluster(df)) == brute(rows)


def test_messy_rows_ties_and_empty_clusters(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.integers(-3, 4, 3) / 4]) for i in range(60)]
    rows += [(5, rows[5][1])] * 20 + [(None, [0.25, -0.5, 1.0]), (70, None), (71, [1.0, None, 0.0]), (72, [float("nan"), 0.0, 0.0]),
                                      (73, [float("-inf"), 0.0, 0.0]), (74, []), (75, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    df = df.withColumn("cluster", F.lit("x")).withColumn("x", F.lit(1)).withColumn("sums", F.lit(2))
    assert got(centroids.cluster(df, centroids=6, rounds=4, size=3, scale=4)) == brute(rows, 6, 4, 3, 4)
    # copies of one vector: all but the first centroid stay empty
    same = [(i, [0.5, 0.5, 0.5]) for i in range(9)]
    assert got(centroids.cluster(spark.createDataFrame(same, "vec_id long, embedding array<float>"), size=3)) == brute(same, size=3)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.3, -0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(centroids.cluster(df, size=2)) == brute(rows, size=2)
    none = centroids.cluster(df.limit(0), size=2)
    assert none.count() == 0 and none.columns == NAMES


def test_the_largest_components(spark):
    rows = [(i, [(-1) ** i * 131071.0] * 64) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(centroids.cluster(df, rounds=2)) == brute(rows, rounds=2)
    with pytest.raises(Exception, match="no long holds"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))
