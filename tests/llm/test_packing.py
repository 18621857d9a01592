import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import packing, simhash


def plain(sizes, sources, clusters, capacity):
    bins = []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(b["left"], i) for i, b in enumerate(bins)
                if b["left"] >= size and (s < 0 or s not in b["s"]) and (c < 0 or c not in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        yield i, capacity - bins[i]["left"]
        bins[i]["left"] -= size
        bins[i]["s"].add(s)
        bins[i]["c"].add(c)


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_equals_brute_force(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 300)
    sizes = [rng.randrange(1, 65) for _ in range(n)]
    sources = [rng.choice([-1, 0, 0, 0, *range(1, 12)]) for _ in range(n)]
    clusters = [rng.choice([-1, *range(60)]) for _ in range(n)]
    assert packing.best_fit(sizes, sources, clusters, 64) == list(plain(sizes, sources, clusters, 64))


@pytest.mark.parametrize("lane", [8, 4096])
def test_whole_texts_no_conflicts_no_overflow(messy, lane):
    rows = packing.pack(messy, capacity=200, lane=lane).collect()
    texts = defaultdict(list)
    for r in messy.collect():
        texts[r.doc_id].append(r.text or "")
    covered, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        covered[r.doc_id] += r.end_char - r.start_char
        assert r.n_tokens == -(-(r.end_char - r.start_char) // 4)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    assert covered == {k: sum(map(len, v)) for k, v in texts.items()}
    assert {r.doc_id for r in rows if r.bin_id is None} == {4, 5}
    for own in bins.values():
        own.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in own:
            assert r.bin_offset == at
            at += r.n_tokens
        assert at <= 200
        sources = [r.source for r in own if r.source is not None]
        assert len(sources) == len(set(sources))
        copies = [r for r in own if r.doc_id in (1, 2)]
        assert len(copies) <= 1


def test_exact_counts_and_clusters(spark):
    docs = spark.createDataFrame([(i, "x" * 50, None, 5, "same") for i in range(10)],
                                 "doc_id long, text string, source string, tokens int, family string")
    rows = packing.pack(docs, tokens_col="tokens", cluster_col="family", capacity=10).collect()
    assert len({r.bin_id for r in rows}) == 10 and {r.n_tokens for r in rows} == {5}
    free = docs.withColumn("family", F.lit(None).cast("string"))
    assert len({r.bin_id for r in packing.pack(free, tokens_col="tokens", cluster_col="family", capacity=10).collect()}) == 5


def test_empty(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_near_copies_of_other_sources_share_no_bin(spark):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for family in range(6):
        base = [rng.choice(words) for _ in range(600)]
        for copy in range(8):
            text = list(base)
            text[rng.randrange(600)] = "changed"
            rows.append((100 * family + copy, " ".join(text), f"source{copy}-{family}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clustered = simhash.add_components(docs.withColumn("n", F.char_length("text")), drop=("text",))
    component = {r.doc_id: r.component_id for r in clustered.collect()}
    assert any(list(component.values()).count(c) > 4 for c in component.values())
    bins = defaultdict(list)
    for r in packing.pack(clustered, chars_col="n", cluster_col="component_id", capacity=4096).collect():
        bins[r.bin_id].append(component[r.doc_id])
    assert all(len(own) == len(set(own)) for own in bins.values()) and any(len(own) > 1 for own in bins.values())
    free = defaultdict(list)
    for r in packing.pack(docs, capacity=4096).collect():  # copies by exact text only
        free[r.bin_id].append(component[r.doc_id])
    assert any(len(own) > len(set(own)) for own in free.values())
