import hashlib
import random
import re

import pytest

from strataflow.llm import spotsigs


def signs(text):
    words = [w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    content = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    chains = set()
    for i, w in enumerate(words):
        after = [j for j in content if j > i][:2] if w in spotsigs.ANCHORS else []
        if len(after) == 2:
            chains.add(" ".join([w, *(words[j] for j in after)]))
    if not chains and words:
        chains = {" ".join(words)}
    return sorted(hashlib.md5(c.encode()).hexdigest()[:16] for c in chains)


def alike(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def test_chains():
    found = spotsigs.signer()(b"At a rally to kick off a weeklong campaign")
    want = {"at rally kick", "a rally kick", "to kick off", "a weeklong campaign"}
    assert [s.hex() for s in found] == sorted(hashlib.md5(w.encode()).hexdigest()[:16] for w in want)
    three = spotsigs.signer(frozenset({"a"}), 3)
    assert three(b"a b c d a e f") == [hashlib.md5(b"a b c d").digest()[:8]]
    assert spotsigs.signer()(b" ... ") == [] and len(spotsigs.signer()(b"no chain")) == 1


def test_fingerprints_of_messy_rows(spark, messy, no_docs):
    got = spotsigs.fingerprints(messy).collect()
    assert got[0].asDict().keys() == {*messy.columns, "fingerprint"}
    for r in got:
        assert r.fingerprint == "".join(signs(r.text or ""))
    again = spotsigs.fingerprints(spotsigs.fingerprints(messy)).columns
    assert again == [*messy.columns, "fingerprint"]
    assert spotsigs.fingerprints(no_docs).count() == 0


@pytest.mark.parametrize("lanes", [1, 3, 16])
def test_edits(spark, lanes):
    rng = random.Random(lanes)
    common, rare = ["the", "of", "und", "la", "is"], [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(common if rng.random() < 0.4 else rare) for _ in range(rng.randrange(60))))
            for i in rng.sample(range(-50, 400), 90)]
    rows += [(1000, ""), (1001, None), (1002, "Ünï " * 50), (1003, "one"), (1004, rows[3][1]), (None, "the last of all texts")]
    spark.conf.set("spark.sql.shuffle.partitions", str(lanes))
    try:
        got = spotsigs.against_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    want = []
    for at, (i, text) in enumerate(order):
        other = order[(at + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + other[:cut]
        a, b, c = signs(text), signs(edited), signs(other)
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), alike(a, b), alike(a, c)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_edits_of_repeated_ids_one_row_and_none(spark, messy, no_docs):
    got = spotsigs.against_edits(messy).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in messy.collect())
    one = spotsigs.against_edits(messy.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert spotsigs.against_edits(no_docs).count() == 0
    words = messy.selectExpr("cast(doc_id as string) doc_id", "text")
    assert spotsigs.against_edits(words).count() == messy.count()


def test_pairs_are_those_of_brute_force(spark):
    rng = random.Random(9)
    base = [[rng.choice(["the", "of", "is"]) if j % 3 == 0 else f"w{rng.randrange(500)}" for j in range(rng.randrange(30, 240))]
            for _ in range(25)]
    texts = []
    for words in base:
        for edits in (0, 0, 1, 2, 4, 8):
            changed = list(words)
            for _ in range(edits):
                changed[rng.randrange(len(changed))] = f"x{rng.randrange(500)}"
            texts.append(" ".join(changed))
    texts += ["", "...", "the same short text here", "the same short text here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    prints = spotsigs.fingerprints(docs)
    sets = {r.fingerprint: signs(texts[r.doc_id]) for r in prints.collect() if r.fingerprint}
    for threshold in (0.5, 0.8, 0.93):
        pairs, members = spotsigs.similar(prints, threshold)
        keys = sorted(sets)
        want = {}
        for i, a in enumerate(keys):
            for b in keys[i + 1:]:
                if (s := alike(sets[a], sets[b])) >= threshold:
                    want[frozenset((hashlib.md5(a.encode()).hexdigest(), hashlib.md5(b.encode()).hexdigest()))] = s
        got = {frozenset((r.a, r.b)): r.likeness for r in pairs.collect()}
        assert got == want and len(want) > 20
        assert members.count() == len(texts)
    with pytest.raises(ValueError, match="threshold"):
        spotsigs.similar(prints, 1.0)
