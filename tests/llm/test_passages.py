import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import passages, suffix


def plain(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()),
                    hashlib.sha256(bytes(np.frombuffer(t, dtype=np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(20))
def test_suffix_arrays_and_repeats(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, rng.integers(2, 5), size=(rng.integers(2, 60), rng.integers(1, 6)))
    text[-1] = 0
    order = suffix.suffix_arrays(text.astype(np.int64))
    for g in range(text.shape[1]):
        s = text[:, g].tolist()
        assert order[:, g].tolist() == sorted(range(len(s)), key=lambda i: s[i:]) == suffix.suffix_array(s)
    length = int(rng.integers(2, 7))
    shards = [[bytes(rng.integers(97, 97 + rng.integers(1, 4), size=rng.integers(0, 40)).tolist())
               for _ in range(rng.integers(1, 4))] for _ in range(rng.integers(1, 6))]
    alone = [suffix.repeated_starts([pieces], length)[0] for pieces in shards]
    for pieces, found in [*zip(shards, suffix.repeated_starts(shards, length), strict=True), *zip(shards, alone, strict=True)]:
        seen = Counter(p[i:i + length] for p in pieces for i in range(len(p) - length + 1))
        assert [f.tolist() for f in found] == [
            [seen[p[i:i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]


def corpus(seed):
    rng = random.Random(seed)
    passage = [bytes(rng.choices(range(97, 110), k=90)) for _ in range(5)]
    out = []
    for _ in range(60):
        out.append(b"".join(rng.choice([rng.choice(passage), bytes(rng.choices(range(97, 110), k=rng.randrange(50))),
                                        passage[0][rng.randrange(40):][:45]]) for _ in range(rng.randrange(6))))
    out += [b"ab" * 300, b"z" * 500, out[3], b"", passage[1], passage[1][:29], passage[1][5:60] + b"!" + passage[1][60:]]
    return out


@pytest.mark.parametrize(("seed", "crowd", "block"), [(1, 32, 1 << 20), (2, 2, 1 << 20), (3, 4, 100)])
def test_against_brute_force(spark, monkeypatch, seed, crowd, block):
    texts = corpus(seed)
    monkeypatch.setattr(passages, "BLOCK", block)  # documents longer than a block are hashed in slices
    monkeypatch.setattr(passages, "ALONE", 120)
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    done = passages.with_digest(passages.remove_repeats(df, length=30, gram=8, with_text=False, crowd=crowd)).collect()
    want = plain(texts, 30)
    assert {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in done} == dict(enumerate(want))


def test_more_segments_under_one_anchor_than_a_task_takes(spark):
    """2,300 texts around one passage, which is too short to repeat by itself; some share what surrounds it, too."""
    rng = random.Random(8)
    letters = range(97, 123)
    passage = bytes(rng.choices(letters, k=150))
    hedge = [bytes(rng.choices(letters, k=130)) for _ in range(40)]
    texts = []
    for i in range(2300):
        before = rng.choice(hedge) if i % 9 == 0 else bytes(rng.choices(letters, k=130))
        after = rng.choice(hedge) if i % 13 == 0 else bytes(rng.choices(letters, k=130))
        texts.append(before + passage + after)
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    seen = []
    real = passages._crowded
    passages._crowded = lambda *a: seen.append(1) or real(*a)
    try:
        done = passages.with_digest(passages.remove_repeats(df, with_text=False)).collect()
    finally:
        passages._crowded = real
    want = plain(texts, 200)
    assert seen and {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in done} == dict(enumerate(want))
    assert sum(n > 0 for n, _, _ in want) > 100


def test_slices_see_every_window_once(monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 50)
    text = bytes(random.Random(1).choices(range(97, 100), k=700))
    seen = []
    for held in passages._slices([700, 10, 260], 30):
        seen += [(d, i) for d, lo, hi in held for i in range(lo, hi - 30 + 1)]
    assert sorted(seen) == [(0, i) for i in range(671)] + [(2, i) for i in range(231)]
    assert len(text) == 700


def test_messy(messy, no_docs):
    clash = messy.withColumn("n_bytes", F.lit("x")).withColumn("row", F.lit(1)).withColumn("segs", F.lit(2))
    done = passages.remove_repeats(clash).collect()
    assert len(done) == messy.count()
    by_id = {r.doc_id: r for r in done}
    assert by_id[2].kept == b"" and by_id[1].kept == b"" and by_id[4].n_bytes == 0 and by_id[9].kept == b"one two"
    assert by_id[8].kept in (b"x", b"") and by_id[8].row == 1
    assert passages.remove_repeats(no_docs).count() == 0
