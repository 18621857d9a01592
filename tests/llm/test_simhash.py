import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from strataflow.llm import simhash
from strataflow.llm.common import connected_components


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    votes = Counter()
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        votes.update(b for b in range(64) if h >> b & 1)
    value = sum(1 << b for b in range(64) if 2 * votes[b] > len(grams)) if grams else 0
    return value - (1 << 64) if value >> 63 else value


def plain_components(prints, bits):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= bits:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {v: find(v) for v in values}


def test_fingerprints_equal_the_definition_and_spark_hash(spark, messy):
    got = simhash.add_fingerprints(messy).select("text", "fingerprint").collect()
    assert len(got) == messy.count()
    for r in got:
        assert r.fingerprint == plain_fingerprint(r.text)
    one = spark.sql("select xxhash64('only one') h").first().h
    assert simhash.fingerprint(b"only one", 3) == one


def families(seed=3):
    """Close families, chains, and one family that crowds its keys."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(150)]
    for centre in out[:20]:
        for _ in range(4):
            out.append(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    chain = out[21]
    for _ in range(12):
        chain ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        out.append(chain)
    crowd = out[22]
    for _ in range(250):
        out.append(crowd ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32, 64)))
    return [v - (1 << 64) if v >> 63 else v for v in out]


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_components_equal_brute_force(spark, bits):
    prints = families()
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    got = {r.node: r.root for r in connected_components(simhash.links(df, bits)).collect()}
    want = plain_components(prints, bits)
    assert {v: got.get(v, v) for v in want} == want


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint long"), 3)


def test_messy_documents(messy):
    got = simhash.near_duplicates(messy).collect()
    assert len(got) == messy.count()
    least = {}
    for r in got:
        least.setdefault(r.fingerprint, r.component_id)
        assert least[r.fingerprint] == r.component_id
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[2].component_id == 1 and by_id[4].component_id == by_id[5].component_id == by_id[6].component_id == 4
    assert by_id[4].fingerprint == 0


def test_one_row_of_each_component_stays(messy):
    clash = messy.withColumn("row", F.lit("r")).withColumn("near", F.lit("n")).withColumn("fingerprint", F.lit("f"))
    kept = simhash.drop_near_duplicates(clash)
    assert kept.columns == clash.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(4) == 1 and 5 not in ids and ids.count(None) == 1
    groups = {r.component_id for r in simhash.near_duplicates(messy).collect()}
    assert len(rows) == len(groups)  # the only component of null ids has a null id


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_components_beside_all_columns(spark, messy, no_docs):
    docs = messy.withColumn("near", F.lit(1)).withColumn("component_id", F.lit("x"))
    got = simhash.add_components(docs, drop=("text",))
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "near", "component_id"]
    want = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(messy).collect())
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got.collect()) == want
    assert simhash.add_components(no_docs).count() == 0
