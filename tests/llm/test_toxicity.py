import random

import numpy as np
from pyspark.sql import functions as F

from strataflow.llm import queries, toxicity
from strataflow.llm.common import crc_bucket


def test_label_model_finds_good_voters_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.2
    votes = np.zeros((6000, toxicity.VOTERS), dtype=np.int64)
    for i in range(5):  # independent, good
        votes[:, i] = np.where(y, rng.random(6000) < 0.7, rng.random(6000) < 0.03)
    votes[:, 5] = rng.random(6000) < 0.3                       # noise
    for i in (6, 7, 8):                                        # copies of the noise
        votes[:, i] = np.where(rng.random(6000) < 0.95, votes[:, 5], 1 - votes[:, 5])
    known = np.where(np.arange(6000) < 300, y, -1)
    model = toxicity.LabelModel().fit(votes, np.ones(6000), known)
    post = model.posterior(votes)
    assert ((post > 0.5) == y).mean() > 0.97
    linked = {frozenset((i, p)) for i, p in enumerate(model.parent[0]) if p >= 0}
    assert len({frozenset(x) for x in ((5, 6), (5, 7), (5, 8), (6, 7), (6, 8), (7, 8))} & linked) == 3
    assert abs(model.prior - 0.2) < 0.05


def docs_and_labels(spark):
    rng = random.Random(2)
    common = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(common) for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["blorx", "zabtu"]) + rng.choice(["", "en", "er"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(1000, None), (1001, ""), (None, "blorx blorxen zabtu zabtuer"), (1002, "idiot moron loser"), (3, docs[3][1]), (3, docs[3][1])]
    labels += [(None, 1), (3, None), (4, 7), (5000, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_mined_words_generalise(spark):
    docs, labels = docs_and_labels(spark)
    model = toxicity.fit(docs, labels.where(crc_bucket("doc_id", 3) != 1))
    assert {"blorx", "zabtu"} <= {n.rstrip("*") for n in model.features.names} | {n[:5] for n in model.features.names}
    got = model.score(docs.withColumn("Score", F.lit("x"))).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic in (0, 1)}
    wrong = [r.doc_id for r in got if r.doc_id in truth and (r.score >= 0.7) != truth[r.doc_id]]
    assert len(wrong) <= 6
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[None] >= 0.7 and by_id[1000] < 0.5 and by_id[1000] == by_id[1001]


def test_empty_tables(spark, no_docs):
    docs, labels = docs_and_labels(spark)
    alone = toxicity.fit(docs, labels.limit(0)).score(docs)
    assert alone.count() == docs.count()
    assert toxicity.fit(no_docs, labels).score(docs).agg(F.max("score")).first()[0] < 0.5


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = queries.op1_toxicity(spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    ranks, bad = held.score.rank(), held.toxic == 1
    auc = (ranks[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.88
    assert held[~bad].predicted.mean() < 0.01 and held[bad].predicted.mean() > 0.7


def test_capitals_are_counted_over_the_whole_text():
    features = toxicity.Features([])
    late, early = "a" * 4000 + "A" * 9000, "A" * 4000 + "a" * 9000
    assert features.read(late)[0] >> 5 & 1 == 1 and features.read(early)[0] >> 5 & 1 == 0
