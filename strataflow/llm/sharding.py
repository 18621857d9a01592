"""Sharding by extendible hashing.

A row's key is 128 hash bits: 64 of its id and text, then 64 of its place, which only rows equal in both ever
need. A directory indexed by a prefix of the key names each row's bucket; a bucket over the byte limit, and
only that, splits on its next bit until every shard fits.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stage

MAX_BYTES = 64 << 20
BITS = 128


def _directory(rows: DataFrame, before: int, depth: int, max_bytes: int) -> DataFrame:
    """For every prefix of ``depth`` bits in ``rows``: its shard, or null if that is still too large.

    ``before``: bits that every row's bucket has been split on so far. The shard is the shortest prefix whose
    bytes fit (or whose row is alone), so a bucket that fits never splits.
    """
    fine = rows.groupBy(F.substring("bits", 1, depth).alias("prefix")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    levels = fine.select("prefix", "bytes", "n", F.explode(F.sequence(F.lit(before), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("shard", F.expr("substring(prefix, 1, depth)"))
    fits = (levels.groupBy("shard", "depth").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
            .where((F.col("bytes") <= max_bytes) | (F.col("n") == 1) | (F.col("depth") == BITS)))
    found = levels.select("prefix", "depth", "shard").join(fits.select("shard", "depth"), ["shard", "depth"], "left_semi")
    shortest = found.groupBy("prefix").agg(F.min_by("shard", "depth").alias("shard"))
    return stage(fine.select("prefix").join(shortest, "prefix", "left"), "directory")


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES,
           drop: tuple[str, ...] = (), step: int = 8) -> DataFrame:
    """``docs`` with ``shard`` (the bits of its bucket, empty if one shard holds all), ``shard_bits`` and ``n_bytes``
    (UTF-8 length of the text, null as 0).

    No shard holds more than ``max_bytes``, but for a single longer document, which is alone in its shard.
    Sibling shards together exceed the limit, so no split is idle. Equal ids and texts, null ids and repeated
    rows are split by their place like all others. Columns of these names are replaced; ``drop`` names columns
    not to return. An empty table gives an empty result.
    """
    made = ("shard", "shard_bits", "n_bytes")
    kept = [c for c in docs.columns if c.lower() not in {*made, *(d.lower() for d in drop)}]
    key = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)])  # no clash with the names below

    def binary(h):
        return F.lpad(F.bin(h), 64, "0")

    rows = stage(docs.select(
        key.alias("row"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"),
        F.xxhash64(id_col, text_col).alias("h"), F.monotonically_increasing_id().alias("place")), "keyed")
    rows = rows.withColumn("bits", F.concat(binary(F.col("h")), binary(F.xxhash64("place"))))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    # the first directory is about eight times as fine as shards of equal size would need
    before, depth = 0, 3 + max(0, math.ceil(math.log2(max(1, total / max_bytes))))
    rest, done = rows, None
    while True:
        directory = _directory(rest, before, depth, max_bytes)
        placed = rest.join(directory.withColumnRenamed("shard", "found"), F.substring("bits", 1, depth) == F.col("prefix"))
        own = placed.where("found is not null").select("row", "bytes", "found")
        done = own if done is None else done.union(own)
        if directory.where("shard is null").isEmpty():
            break
        rest = placed.where("found is null").select("row", "bytes", "bits")
        before, depth = depth + 1, min(BITS, depth + step)
    return done.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], F.col("found").alias("shard"),
                       F.length("found").alias("shard_bits"), F.col("bytes").alias("n_bytes"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder ``shard=<bits>`` for each shard (``_`` before the bits keeps them text)."""
    (assigned.withColumn("shard", F.concat(F.lit("_"), "shard")).repartition("shard")
     .write.partitionBy("shard").parquet(path))
