import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.operators.sampling import allocate


def _largest_remainder(counts: dict[int, int], k: int) -> dict[int, int]:
    n = sum(counts.values())
    base = {c: (k * v) // n for c, v in counts.items()}
    rem = sorted(counts, key=lambda c: (-((k * counts[c]) % n), c))
    for c in rem[: k - sum(base.values())]:
        base[c] += 1
    return base


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 5), st.integers(1, 500), min_size=1, max_size=5),
       st.floats(0.05, 0.5))
def test_allocate_matches_largest_remainder(spark, counts, share):
    df = spark.createDataFrame(list(counts.items()), "label int, n long")
    n = sum(counts.values())
    k = math.ceil(round(share, 6) * n)
    got = {r["label"]: r["quota"] for r in allocate(df, F.lit(k).cast("bigint")).collect()}
    assert got == _largest_remainder(counts, k)
    assert sum(got.values()) == k
