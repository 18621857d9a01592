"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, personal data, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept. ``run`` applies them to ``documents``, each result written to the cluster's shared folder
and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import decontaminate, packing, pii, simhash, toxicity
from strataflow.llm.common import read_table, stage
from strataflow.llm.queries import toxicity_model


def _kept(docs: DataFrame, made: tuple[str, ...], stage_of) -> DataFrame:
    """``stage_of(docs)`` with the columns of ``docs``, those named like one that the stage makes put aside meanwhile."""
    taken, aside = {c.lower() for c in docs.columns}, {}
    for c in docs.columns:
        if c.lower() in made:
            name = f"{c}_"
            while name.lower() in taken | set(made):
                name += "_"
            taken.add(name.lower())
            aside[c] = name
    done = stage_of(docs.withColumnsRenamed(aside))
    return done.select(*[aside.get(c, c) for c in docs.columns]).withColumnsRenamed({v: k for k, v in aside.items()})


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay.

    A null or empty text is scored as one without words. Repeated rows are scored alike. The model is fitted on
    ``docs`` and the table of labels; without usable labels, or without documents, nothing is rejected. All columns
    stay as they are, whatever their names.
    """
    def below(d: DataFrame) -> DataFrame:
        scored = toxicity_model(spark, d, sf_dir).score(d, score_col="_toxicity")
        return scored.where(scored["_toxicity"] < toxicity.THRESHOLD)

    return _kept(docs, ("_toxicity",), below)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id.

    Null, empty and blank texts are copies of each other; a null id comes last; of repeated rows one stays. An empty
    table stays empty. All columns stay as they are, whatever their names.
    """
    return simhash.drop_near_duplicates(docs, words=3, max_bits=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window stay.

    Null and empty texts have none. Repeated rows are judged alike. An empty benchmark or an empty table drops
    nothing. All columns stay as they are, whatever their names.
    """
    benchmark = read_table(spark, sf_dir, "benchmark")
    return _kept(docs, ("n_words", "hit_spans", "hit_items"),
                 lambda d: decontaminate.decontaminate(d, benchmark).where("size(hit_spans) = 0"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its personal data replaced by placeholders and ``n_chars``, if there, counted anew.

    A null text stays null, its length too. Repeated rows stay repeated; all other columns stay as they are.
    """
    return pii.redact_pii(docs, n_chars_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their bins: ``doc_id, source, piece, start_char, end_char, n_tokens, bin_id,
    bin_offset``.

    A null or empty text is one piece without a bin; a null source conflicts with nothing; repeated rows are packed as
    often as they occur. Other columns are not read. An empty table gives no pieces.
    """
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("decontaminate", drop_leaks), ("pii", redact),
          ("packing", pack)]

# The label model, the classifier and the hash have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
