import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataflow.llm import decontaminate, pii, simhash
from strataflow.llm.common import read_table
from test_decontaminate import plain as plain_windows
from test_simhash import plain_components, plain_fingerprint


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontaminate", "pii", "packing"]


def test_stages_against_brute_force(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    items = [(r.item_id, r.text) for r in read_table(spark, sf_dir, "benchmark").collect()]
    clean = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()
    rows = clean.collect()
    single = corpus_pipeline.drop_near_duplicates(spark, clean, sf_dir)
    roots = plain_components([plain_fingerprint(r.text) for r in rows], 2)
    groups = {}
    for r in rows:
        root = roots[plain_fingerprint(r.text)]
        groups[root] = min(groups.get(root, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups.values())
    free = corpus_pipeline.drop_leaks(spark, single, sf_dir)
    assert sorted(r.doc_id for r in free.collect()) == sorted(
        r.doc_id for r in single.collect() if not plain_windows(r.text, items, 10)[1])
    safe = corpus_pipeline.redact(spark, free, sf_dir)
    assert safe.columns == docs.columns and safe.count() == free.count()
    assert all(not pii.find(r.text or "") and r.n_chars == len(r.text or "") for r in safe.collect())
    packed = corpus_pipeline.pack(spark, safe, sf_dir).collect()
    length = {}
    for r in packed:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.end_char - r.start_char
    assert length == {r.doc_id: len(r.text or "") for r in safe.collect()}


def test_run_covers_the_stages(spark, sf_dir):
    done = corpus_pipeline.run(spark, sf_dir)
    assert done.count() > 0 and done.where("bin_id is not null").groupBy("bin_id").sum("n_tokens").where("`sum(n_tokens)` > 2048").isEmpty()
    assert simhash and decontaminate


CLASHES = ("_toxicity", "N_WORDS", "hit_spans", "hit_items", "fingerprint", "component_id", "row", "near", "spans", "bin_id", "n_words_")


def clashing(docs):
    for i, name in enumerate(CLASHES):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return docs


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_stages_on_messy_rows_with_clashing_names(spark, messy, no_docs, sf_dir, stage):
    docs = clashing(messy)
    kept = stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.schema["N_WORDS"].dataType == docs.schema["N_WORDS"].dataType
    before = {}
    for r in docs.collect():
        before.setdefault(r.doc_id, set()).add(tuple(r[c] for c in ("lang", "source", *CLASHES)))
    rows = kept.collect()
    assert rows and all(tuple(r[c] for c in ("lang", "source", *CLASHES)) in before[r.doc_id] for r in rows)
    assert {r.doc_id for r in stage(spark, messy, sf_dir).collect()} == {r.doc_id for r in rows}
    assert stage(spark, clashing(no_docs), sf_dir).count() == 0
    nulls = messy.limit(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in messy.schema])
    assert stage(spark, nulls, sf_dir).count() in (1, 3)


def test_packing_of_messy_rows(spark, messy, no_docs, sf_dir):
    got = corpus_pipeline.pack(spark, clashing(messy), sf_dir)
    assert got.columns == ["doc_id", "source", "piece", "start_char", "end_char", "n_tokens", "bin_id", "bin_offset"]
    assert got.where("piece = 0").count() == messy.count()
    assert corpus_pipeline.pack(spark, no_docs, sf_dir).count() == 0
