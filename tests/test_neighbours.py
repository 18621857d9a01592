import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import neighbours as NB

SCHEMA = "k long, z array<double>, y int"


def clustered(seed, n, d=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d)) * 8
    return [(i, (centres[i % 6] + rng.normal(size=d)).tolist(), int(rng.integers(0, 3))) for i in range(n)]


def brute(queries, rows, k, exclude_self):
    out = {}
    for q, x, *_ in queries:
        found = sorted((float(np.sqrt(((np.array(v) - x) ** 2).sum())), i) for i, v, *_ in rows if not (exclude_self and i == q))
        out[q] = [(r + 1, i, round(d, 9)) for r, (d, i) in enumerate(found[:k])]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.id, round(r.distance, 9)))
    return out


@pytest.mark.parametrize(("pivots", "block"), [(64, 4096), (5, 16), (1, 7)])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_equals_brute_force(spark, pivots, block, exclude_self):
    rows = clustered(1, 400)
    rows += [(1000 + i, rows[3][1], 0) for i in range(40)]  # a crowd at one point
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    asked = df.where("k % 3 = 0 or k >= 1000")
    near = NB.knn_join(asked, df, "z", "k", 4, exclude_self, pivots, block)
    want = brute([r for r in rows if r[0] % 3 == 0 or r[0] >= 1000], rows, 4, exclude_self)
    assert got(near) == want


def test_few_cells_are_visited_and_no_product_is_formed(spark, monkeypatch):
    df = spark.createDataFrame(clustered(2, 1200), SCHEMA)
    seen = {}
    real = NB.materialize

    def count(frame):
        made = real(frame)
        seen[tuple(frame.columns)] = made.count()
        return made

    monkeypatch.setattr(NB, "materialize", count)
    near = NB.knn_join(df, df, "z", "k", 1, exclude_self=True, pivots=48)
    plan = near._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert near.count() == 1200
    assert seen["id", "v", "cell"] < 0.3 * 1200 * 48


def test_few_rows_bad_rows_and_none(spark):
    rows = [(1, [0.0, 0.0], 0), (2, [3.0, 4.0], 1), (None, [0.0, 1.0], 1), (4, None, 0), (5, [None, 1.0], 0), (6, [float("nan"), 1.0], 0),
            (7, [1.0], 0), (8, [], 0), (9, [float("inf"), 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.col("k").asc_nulls_last()).coalesce(1)
    assert got(NB.knn_join(df, df, "z", "k", 5, exclude_self=True)) == {1: [(1, 2, 5.0)], 2: [(1, 1, 5.0)]}
    assert NB.knn_join(df, df.limit(0), "z", "k", 5).count() == 0
    assert NB.knn_join(df.limit(0), df, "z", "k", 5).count() == 0
    assert NB.tomek_links(df.limit(0), "z", "k", "y").count() == 0


def test_filter_drops_rows_among_other_classes(spark):
    real = [(i, [float(i), 0.0], 0) for i in range(10)] + [(20 + i, [float(i), 50.0], 2) for i in range(10)]
    synthetic = [(100, [4.2, 0.1], 2), (101, [4.2, 49.0], 2), (102, [9.4, 26.0], 2), (103, [0.0, 24.0], 2)]
    r, s = spark.createDataFrame(real, SCHEMA), spark.createDataFrame(synthetic, SCHEMA)
    assert {x.k for x in NB.knn_filter(s, r, "z", "k", "y", 2, 5).collect()} == {101, 102}
    tall = {x.k: (x.n_neighbours, x.n_other, x.dropped) for x in NB.neighbourhood(s, r, "z", "k", "y", 2, 20).collect()}
    assert tall[100] == (20, 10, False)  # half is not dominated
    assert NB.knn_filter(s, r.limit(0), "z", "k", "y", 2).count() == 4


@pytest.mark.parametrize("seed", [3, 4])
def test_tomek_links(spark, seed):
    rows = clustered(seed, 200, 2)
    rows += [(500, rows[7][1], 2), (501, rows[7][1], 0), (502, [99.0, 99.0], None), (503, [99.0, 99.1], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    nearest = {q: f[0][1] for q, f in brute(rows, rows, 1, True).items()}
    label = {k: y for k, _, y in rows}
    want = {(a, b) for a, b in nearest.items() if a < b and nearest[b] == a and label[a] is not None and label[b] is not None
            and label[a] != label[b]}
    assert {(r.a, r.b) for r in NB.tomek_links(df, "z", "k", "y").collect()} == want and want
    counts = {c: sum(y == c for _, _, y in rows) for c in range(3)}
    big = min(counts, key=lambda c: (-counts[c], c))
    gone = {k for pair in want for k in pair if label[k] == big}
    assert {r.k for r in NB.remove_tomek(df, "z", "k", "y").collect()} == set(label) - gone
    kept = {r.k for r in NB.remove_tomek(df, "z", "k", "y", keep=F.lit(2)).collect()}
    assert kept == set(label) - {k for pair in want for k in pair if label[k] != 2}


def test_keys_of_text(spark):
    rows = [(f"r{i:03d}", z, y) for i, z, y in clustered(5, 60)]
    df = spark.createDataFrame(rows, "k string, z array<double>, y int")
    assert got(NB.knn_join(df, df, "z", "k", 2, True, 4, 16)) == brute(rows, rows, 2, True)


def test_a_vector_is_sent_for_each_lot_not_for_each_cell(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(2 ** 60 + i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(600, 24)).astype(np.float32))]  # every cell is visited
    df = spark.createDataFrame(rows, "k long, z array<float>, y int").repartition(4)
    seen, real = {}, NB.materialize
    monkeypatch.setattr(NB, "materialize", lambda frame: seen.setdefault(tuple(frame.columns), real(frame)))
    near = NB.knn_join(df, df, "z", "k", 3, exclude_self=True, pivots=40, block=200)
    assert got(near) == brute([(k, np.array(v, np.float32).astype(float), y) for k, v, y in rows], rows, 3, True)  # keys beyond doubles too
    visits = seen["id", "v", "cell"].collect()
    lots = {c for r in visits for c in r["cell"]}
    assert len(visits) == 600 and 3 <= len(lots) < 20 and sum(len(r["cell"]) for r in visits) > 600 * len(lots) / 2
    assert {len(r["v"]) for r in visits} == {4 * 24}
