"""Best-fit packing into token windows under conflicts.

Documents are cut into pieces of at most one window. Pieces are dealt at random to lanes of a bounded
size, so a source or a family of copies that holds a third of all rows is spread evenly, and each lane is
packed on its own: largest piece first, into the open bin of least residual that fits and holds neither a
piece of the same source nor one of the same duplicate cluster.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stage

LANE = 4096  # pieces in a lane, on average


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """``(bin, offset)`` for each piece, taken in the order given; -1 as source or cluster conflicts with nothing.

    Bins are kept ordered by residual. The successor search starts at the tightest bin that fits and goes on
    until the bitmaps of sources and clusters show no conflict; a new bin opens when none is left.
    """
    order: list[tuple[int, int]] = []  # (residual, bin)
    held_sources: list[int] = []
    held_clusters: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = 1 << source if source >= 0 else 0, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and (held_sources[order[at][1]] & s or held_clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
        else:
            residual, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[b] |= s
        held_clusters[b] |= c
        placed.append((b, capacity - residual))
        if residual > size:
            insort(order, (residual - size, b))
    return placed


def _codes(values: pd.Series) -> list[int]:
    return pd.factorize(values)[0].tolist()


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster_col: str | None = None, tokens_col: str | None = None, chars_col: str | None = None, capacity: int = 2048,
         chars_per_token: int = 4, lane: int = LANE) -> DataFrame:
    """One row per piece: the id, the source, ``piece``, ``start_char``/``end_char`` (end exclusive; the piece's
    text), ``n_tokens``, ``bin_id`` (long) and ``bin_offset`` (tokens before it in its bin).

    A token is ``chars_per_token`` characters, the last one maybe fewer, unless ``tokens_col`` holds exact
    counts (then a piece's characters are its share of the text). With ``chars_col``, the texts' code points, and
    ``cluster_col`` the text itself is not read. Every document is packed whole: one of more
    than ``capacity`` tokens becomes several pieces. Documents without tokens (null or empty) give one row
    with null ``bin_id``. No bin holds two pieces of a source or of a duplicate cluster (``cluster_col``; by
    default texts equal up to letter case and white space); a null source or cluster conflicts with nothing.
    Repeated rows are packed as often as they occur. Output depends on the files of the input alone.
    """
    length = F.coalesce(F.col(chars_col).cast("int") if chars_col else F.char_length(text_col), F.lit(0))
    tokens = F.coalesce(F.col(tokens_col), F.lit(0)).cast("long") if tokens_col else F.ceil(length / chars_per_token)
    cluster = (F.xxhash64(F.col(cluster_col)) if cluster_col
               else F.xxhash64(F.lower(F.trim(F.regexp_replace(text_col, r"\s+", " ")))))
    known = F.col(cluster_col if cluster_col else text_col).isNotNull()
    sized = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.when(known, cluster).alias("_cluster"),
        length.cast("long").alias("_chars"), tokens.alias("_tokens"))
    pieces = stage(sized.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
            F.ceil(F.col("_tokens") / capacity) - 1, F.lit(0)))).alias("piece"),
        F.monotonically_increasing_id().alias("_row")), "pieces")
    size = F.least(F.col("_tokens") - F.col("piece") * capacity, F.lit(capacity)).cast("long")

    def char(token):  # character at which a token starts
        if not tokens_col:
            return F.least(token * chars_per_token, F.col("_chars"))
        return F.when(token >= F.col("_tokens"), F.col("_chars")).otherwise(
            F.floor(token * F.col("_chars") / F.col("_tokens")))

    start = F.col("piece") * capacity
    ranged = pieces.select("*", size.alias("n_tokens"), char(start).cast("long").alias("start_char"),
                           char(start + size).cast("long").alias("end_char"))
    lanes = max(1, -(-pieces.where("_tokens > 0").count() // lane))
    dealt = ranged.where("_tokens > 0").withColumn("_lane", F.pmod(F.xxhash64("_row", "piece"), F.lit(lanes)))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "_row", "piece"], ascending=[False, True, True])
        placed = best_fit(pdf["n_tokens"].tolist(), _codes(pdf["_source"]), _codes(pdf["_cluster"]), capacity)
        pdf["bin_id"] = [(int(k) << 24) + b for k, (b, _) in zip(pdf["_lane"], placed, strict=True)]
        pdf["bin_offset"] = [o for _, o in placed]
        return pdf[out]

    out = ["_id", "_source", "piece", "start_char", "end_char", "n_tokens", "bin_id", "bin_offset"]
    types = {f.name: f.dataType.simpleString() for f in ranged.schema}
    schema = ", ".join(f"{c} {types.get(c, 'long')}" for c in out)
    narrow = dealt.select("_id", "_source", F.col("_cluster").cast("string").alias("_cluster"), "piece", "_row", "n_tokens",
                          "start_char", "end_char", "_lane")
    bins = narrow.groupBy("_lane").applyInPandas(packed, schema)
    none = ranged.where("_tokens <= 0").select(
        "_id", "_source", "piece", "start_char", "end_char", F.lit(0).cast("long"),
        F.lit(None).cast("long"), F.lit(None).cast("long"))
    return bins.union(none).withColumnsRenamed({"_id": id_col, "_source": source_col})
