"""Splitting and sampling.

Randomness comes from a seeded hash of the row key, never from the row's
position or the partitioning, so every result is reproducible on any cluster
layout and has an exact SQL equivalent.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.columns import c
from strataflow.functions.ranking import global_rank, hash_cutoffs, hash_hex, key_at_rank, with_scalar


def _dec(x: float) -> Column:
    """Exact decimal literal for a share (like a SQL ``0.2`` literal)."""
    return F.lit(Decimal(repr(float(x)))).cast("decimal(20,12)")


def hash_uniform(purpose: str, key: Column, seed) -> Column:
    """Deterministic U[0,1) from the seeded hash of ``purpose`` and ``key`` (first 32 bits)."""
    h = hash_hex(purpose, key, seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(float(16 ** 8))


def allocate(counts: DataFrame, total_k: Column, label: str = "label", n: str = "n",
             out: str = "quota") -> DataFrame:
    """Split ``total_k`` over classes proportionally: floor share plus one
    more for the largest remainders (ties by label).  Integer arithmetic, so
    exact.  ``counts`` has one row per class (small)."""
    w = Window.orderBy(F.lit(1))  # over the per-class table only: a few rows
    tot = F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    t = counts.select(label, n, tot.alias("_N"))
    t = t.withColumn("_k", total_k)
    t = t.withColumn("_base", F.expr(f"(_k * {n}) div _N")).withColumn("_rem", F.expr(f"(_k * {n}) % _N"))
    extra = F.col("_k") - F.sum("_base").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rk = F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(label)))
    return t.select(label, n, (F.col("_base") + (rk <= extra).cast("bigint")).alias(out))


def quotas(sizes: dict, total: int) -> dict:
    """``total`` rows dealt to groups in proportion to their sizes: floors, then one more for the largest remainders
    (ties: the smaller group value).  The same as :func:`allocate`, on a dict of one entry a group."""
    whole = sum(sizes.values())
    if not whole:
        return dict.fromkeys(sizes, 0)
    base = {g: total * n // whole for g, n in sizes.items()}
    by_rest = sorted(sizes, key=lambda g: (-(total * sizes[g] % whole), g is not None, g))
    more = set(by_rest[:total - sum(base.values())])
    return {g: v + (g in more) for g, v in base.items()}


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, val_share: float = 0.2,
                     seed: int = 42, split_col: str = "split") -> DataFrame:
    """Exact stratified train / val / test split.

    Test takes ``ceil(test_share * n)`` rows, val takes
    ``ceil(val_share / (1 - test_share) * (n - n_test))`` of the rest; each is
    divided over classes by largest remainder.  A class's rows are ordered by
    the seeded hash of the key; rows up to its n_test-th hash are test, up to
    its (n_test + n_val)-th val.  Two scans of key and label look up the two
    cut-off hashes of each class (see ``hash_cutoffs``); the rows themselves
    are labelled where they are, hashed once, without a shuffle or a sort.
    Rows with one key go together.
    """
    return apply_cutoffs(df, split_cutoffs(df, label, key, test_share, val_share, seed), label, key, seed, split_col)


def split_cutoffs(df: DataFrame, label: str, key: str, test_share: float = 0.2, val_share: float = 0.2,
                  seed: int = 42) -> dict:
    """``{class: (last test hash, last val hash)}`` of :func:`stratified_split`; reads only ``label`` and ``key``."""
    ranks: dict = {}

    def wanted(sizes: dict) -> dict:
        n_test = quotas(sizes, math.ceil(Decimal(repr(float(test_share))) * sum(sizes.values())))
        rest = {g: n - n_test[g] for g, n in sizes.items()}
        of_rest = Decimal(repr(round(val_share / (1.0 - test_share), 12)))
        n_val = quotas(rest, math.ceil(of_rest * sum(rest.values())))
        ranks.update({g: (n_test[g], n_test[g] + n_val[g]) for g in sizes})
        return ranks

    last = hash_cutoffs(df.select(c(label).alias(label), c(key).alias(key)), label, hash_hex("split", c(key), seed), wanted)
    return {g: tuple(last.get((g, r), "") for r in rs) for g, rs in ranks.items()}


def apply_cutoffs(df: DataFrame, cutoffs: dict, label: str, key: str, seed: int = 42, split_col: str = "split") -> DataFrame:
    """Label rows by the cut-offs of :func:`split_cutoffs`."""
    def cut(i: int) -> Column:
        out = F.lit("")
        for g, hashes in cutoffs.items():
            out = F.when(c(label).eqNullSafe(F.lit(g)), F.lit(hashes[i])).otherwise(out)
        return out

    # a projection of its own, so that the hash is computed once a row
    hashed = df.withColumn("_h", hash_hex("split", c(key), seed))
    split = F.when(F.col("_h") <= cut(0), F.lit("test")).when(F.col("_h") <= cut(1), F.lit("val")).otherwise(F.lit("train"))
    return hashed.withColumn(split_col, split).drop("_h")


def k_fold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Stratified k-fold assignment: fold = (rank within class - 1) mod k."""
    hashed = df.withColumn("_h", F.unhex(hash_hex("fold", c(key), seed)))  # the same order in half the bytes
    ranked = global_rank(hashed, ["_h", key], by=label, out="_rank")
    return ranked.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank")


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 42, purpose: str = "sample") -> DataFrame:
    """Fixed-size sample without replacement (all rows when fewer).

    ``orderBy(hash).limit(n)`` runs as a per-partition top-n followed by one
    merge of at most partitions x n rows: bounded by the sample size.
    """
    return df.withColumn("_h", hash_hex(purpose, c(key), seed)).orderBy("_h", key).limit(n).drop("_h")


def balanced_resample(df: DataFrame, weight: Column, n_out: int | Column | None, key: str,
                      seed: int = 42, copy_col: str = "copy") -> DataFrame:
    """Weighted resample with replacement to about ``n_out`` rows.

    Each row's expected number of copies ``e = n_out * w / sum(w)`` is
    realised as ``floor(e)`` plus one more when a seeded uniform falls below
    the fraction (systematic, deterministic).  Rows are expanded with
    ``explode(sequence)`` in place - no shuffle beyond the total weight.
    """
    tot = df.agg(F.sum(weight).alias("_wsum"), F.count(F.lit(1)).alias("_nrows"))
    target = F.col("_nrows") if n_out is None else (n_out if isinstance(n_out, Column) else F.lit(n_out))
    j = with_scalar(df.withColumn("_w", weight), tot)  # one-row totals as literals
    e = target * F.col("_w") / F.col("_wsum")
    copies = (F.floor(e) + (hash_uniform("copies", c(key), seed) < (e - F.floor(e))).cast("bigint")).cast("int")
    j = j.withColumn("_copies", copies).where(F.col("_copies") > 0)
    out = j.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return out.drop("_w", "_wsum", "_nrows", "_copies")


def ordered_holdout(df: DataFrame, order: list[str] | str, share: float = 0.9, out: str = "holdout",
                    ) -> DataFrame:
    """E5: the first ``int(share * n)`` rows by an explicit order key (first
    column numeric, the others break ties, nulls first) are kept for fitting,
    the rest are the hold-out.  Only the key of the last kept row is looked up
    (:func:`key_at_rank`); rows are compared with it where they are."""
    order = [order] if isinstance(order, str) else list(order)
    last = key_at_rank(df, order, int(Decimal(repr(float(share))) * df.count()))
    if last is None:
        return df.withColumn(out, F.lit(True))
    kept, equal = F.lit(False), F.lit(True)
    for name, v in zip(order, last, strict=True):
        x, v = c(name), F.lit(v).cast(df.schema[name].dataType)
        kept = kept | (equal & F.coalesce(x < v, x.isNull() & v.isNotNull()))
        equal = equal & x.eqNullSafe(v)
    return df.withColumn(out, ~(kept | equal))


def stack_splits(parts: dict[str, DataFrame], split_col: str = "split") -> DataFrame:
    """Union-all of named splits with a split column."""
    out = None
    for name, d in parts.items():
        d = d.withColumn(split_col, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
