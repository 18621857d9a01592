import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import langid, queries


def test_bundle_equals_the_sum_of_bound_letters():
    enc = langid.Encoder(64)
    text = "Ab, é1c"
    slots = [0, 1, 2, 0, int(enc.slots("é")[0]), 0, 3, 0]
    want = np.zeros(64)
    for a, b, c in zip(slots, slots[1:], slots[2:], strict=False):
        want += enc.places[0][a].astype(int) * enc.places[1][b] * enc.places[2][c]
    assert (enc.bundle([enc.grams(text), enc.grams("!")])[0] == want).all()
    assert not enc.grams("12 !").size


def test_long_texts_are_added_up(monkeypatch):
    enc = langid.Encoder(64)
    texts = ["abc def ghi " * 40, "x", "the cat " * 100, "", "zz"]
    whole = {i: v for rows, m in enc.blocks(texts) for i, v in zip(rows, m, strict=True)}
    monkeypatch.setattr(langid, "BLOCK_CHARS", 37)
    monkeypatch.setattr(langid, "BLOCK_GRAMS", 5)
    cut = {i: v for rows, m in enc.blocks(texts) for i, v in zip(rows, m, strict=True)}
    assert sorted(cut) == sorted(whole) == list(range(5))
    assert all(np.allclose(cut[i], whole[i]) for i in whole)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = queries.op8_langid(spark, sf).where("held_out").join(docs.dropDuplicates(["doc_id"]), "doc_id")
    right, n = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("lang")).first()
    assert n > 100 and right >= 0.97 * n


def test_messy(messy, no_docs):
    learned = langid.learn(messy)
    assert set(learned) == {"en", "de", "fr"}
    got = langid.predict(messy.withColumn("lang_pred", F.lit(1)).withColumn("share", F.lit(1)), learned).collect()
    assert len(got) == messy.count()
    by_id = {r.doc_id: r for r in got}
    for i in (4, 5, 6, 10):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.learn(no_docs) == {}
    assert {r.lang_pred for r in langid.predict(messy, {}).collect()} == {"und"}
    assert langid.predict(no_docs, learned).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    df = spark.createDataFrame([("x", "a"), ("y", "b"), ("z", "c")], "text string, lang string")
    with pytest.raises(ValueError):
        langid.learn(df)


def test_shares_never_reach_zero_and_copies_teach_once(spark):
    from strataflow.llm.common import hash_cut
    assert hash_cut(1.0) == hash_cut(7.0) == (1 << 63) - 1 and hash_cut(1e-30) == -(1 << 63)
    assert -(1 << 63) < hash_cut(20_000 / 1e15) < hash_cut(20_000 / 1e12) < 0
    rows = [("the quick brown fox", "en"), ("over the lazy dog", "en")]
    once, copies = (langid.learn(spark.createDataFrame(r, "text string, lang string")) for r in (rows, rows + rows[:1] * 50))
    assert abs(once["en"] - copies["en"]).max() < 1e-12


def test_every_letter_has_a_vector_of_its_own():
    import numpy as np
    e, again = langid.Encoder(), langid.Encoder()
    texts = ["\u03b1", "\u03b1".replace("\u03b1", chr(0x3b1 + 37)), chr(0x4e00), chr(0x4e00 + 37), "a", "\U00020000"]
    v = e.bundle([e.grams(t) for t in texts])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert np.abs(v @ v.T - np.eye(len(texts))).max() < 0.2
    assert (again.bundle([again.grams(texts[2])]) == e.bundle([e.grams(texts[2])])).all()
