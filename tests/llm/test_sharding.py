from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import sharding


def plain(keys, limit):
    """Shards of ``(bits, bytes)`` by splitting oversized buckets one bit at a time."""
    open_, done = [("", keys)], {}
    while open_:
        prefix, own = open_.pop()
        if sum(b for _, b in own) <= limit or len(own) == 1:
            done[prefix] = own
            continue
        for bit in "01":
            part = [x for x in own if x[0][len(prefix)] == bit]
            if part:
                open_.append((prefix + bit, part))
    return done


@pytest.mark.parametrize(("limit", "step"), [(10_000, 8), (3_000, 1), (600, 2), (1 << 30, 8)])
def test_against_brute_force(spark, messy, limit, step):
    docs = messy.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    got = sharding.assign(docs, max_bytes=limit, step=step).collect()
    keys = {r.doc_id: (r.bits, r.n) for r in docs.select(
        "doc_id", F.lpad(F.bin(F.xxhash64("doc_id", "text")), 64, "0").alias("bits"),
        F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()}
    want = {own[0]: prefix for prefix, part in plain([(b, n) for b, n in keys.values()], limit).items() for own in part}
    assert len(got) == len(keys)
    for r in got:
        assert r.shard == want[keys[r.doc_id][0]] and r.shard_bits == len(r.shard) and r.n_bytes == keys[r.doc_id][1]


def test_equal_rows_split_too(spark):
    docs = spark.createDataFrame([(None, "x" * 100)] * 300 + [(1, "y" * 5000), (2, None)], "doc_id long, text string")
    rows = sharding.assign(docs, max_bytes=1000).collect()
    total = defaultdict(list)
    for r in rows:
        total[r.shard].append(r.n_bytes)
    assert len(rows) == 302
    for sizes in total.values():
        assert sum(sizes) <= 1000 or sizes == [5000]
    shards = sorted(total)  # no shard's prefix starts another's
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:], strict=False))


def test_clashes_empty_and_written_shards(spark, messy, no_docs, tmp_path):
    clash = messy.withColumn("bits", F.lit("b")).withColumn("prefix", F.lit("p")).withColumn("shard", F.lit(1))
    done = sharding.assign(clash, max_bytes=2000)
    assert done.select(*[c for c in clash.columns if c != "shard"]).exceptAll(clash.drop("shard")).count() == 0
    sharding.write_shards(done, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == messy.count()
    assert sharding.assign(no_docs).count() == 0
