import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from strataflow.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, size):
    ws, hit, found = words(text), set(), set()
    for item, other in items:
        iw = words(other)
        for window in [iw[i:i + size] for i in range(len(iw) - size + 1)] or ([iw] if iw else []):
            for at in range(len(ws) - len(window) + 1):
                if ws[at:at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    if item is not None:
                        found.add(str(item))
    return len(ws), len(hit), sorted(found)


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "the", "of", "x1", "Ünï", "rare", "deep", "blue", "42", "é"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 10, 14])))) for i in range(12)]
    items += [(3, "the of the of"), (20, items[5][1]), (21, None), (22, "!!! ,,"), (23, "")]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 25)))]
        for _ in range(rng.randrange(3)):
            parts += [(rng.choice(items)[1] or "").upper().replace(" ", rng.choice([" ", ", ", "\n"])),
                      " ".join(rng.choice(vocabulary) for _ in range(4))]
        docs.append((i, "  ".join(parts)))
    return docs + [(60, None), (61, ""), (None, items[0][1]), (62, items[0][1]), (62, items[0][1])], items


@pytest.mark.parametrize(("seed", "block"), [(1, 1 << 20), (2, 1 << 20), (3, 60)])
def test_against_brute_force(spark, seed, block):
    docs, items = fixture(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = decontaminate.with_digest(decontaminate.decontaminate(
        df, spark.createDataFrame(items, "item_id long, text string"), size=5, block_bytes=block)).collect()
    assert len(found) == len(docs)
    for r in found:
        n, hit, names = plain(r.text, items, 5)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), hit > 0), r
        assert r.hit_items == names
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_clashing_columns_and_empty_tables(spark, messy, no_docs):
    items = spark.createDataFrame([(1, "alpha beta"), (None, "gamma delta")], "item_id long, text string")
    clash = messy.withColumn("N_WORDS", F.lit("x")).withColumn("hit_items", F.lit(3)).withColumn("id", F.lit(1))
    found = decontaminate.decontaminate(clash, items)
    assert found.count() == messy.count()
    assert [c.lower() for c in found.columns].count("n_words") == 1
    assert all(set(r.hit_items) <= {"1"} for r in found.collect())
    assert decontaminate.decontaminate(no_docs, items).count() == 0
    none = decontaminate.decontaminate(messy, items.limit(0)).agg(F.sum(F.size("hit_spans"))).first()[0]
    assert none == 0


def test_codes_that_overflow(spark):
    """With very many words the shingle codes go beyond 64 bits; nothing may be lost."""
    docs, items = fixture(4)
    texts = [(str(i), (t or "").encode()) for i, t in items]
    plain_windows, wide = decontaminate.Windows(texts, 5), decontaminate.Windows(texts, 5)
    wide.base = (1 << 32) - 5
    wide.codes = {s: sorted({int(c) for r in range(len(wide.lengths)) if wide.grams[r] == s for c in wide._row_codes(r, s)})
                  for s in wide.sizes}
    assert any(c < 0 for codes in wide.codes.values() for c in codes)
    found = {}
    for name, w in (("plain", plain_windows), ("wide", wide)):
        w.order({(s, int(c)): 1 for s in w.sizes for c in w.codes[s]})
        found[name] = [sorted(zip(*(m.tolist() for m in w.matches(w.word_ids(decontaminate.words_of((t or "").encode()))))))
                       for _, t in docs]
    assert found["plain"] == found["wide"] and any(found["wide"])
