"""SimHash near-duplicates found through one-wildcard segment variants.

Fingerprints at most two bits apart, cut into two halves, agree in one half up to a single bit.
Every half is indexed under 32 variants, each with one bit masked, so such a pair meets under an
equal key; the full distance is verified after the equality join.

The fingerprints that meet another under some key are verified without pairing a key's members out
(families of near copies may be large, and in a large corpus many meet by chance). Two fingerprints at
most two bits apart share a neighbour one flip away from both, and all fingerprints around one such
centre are at most two bits apart from each other. So linking every centre's fingerprints verifies the
full distance exactly: at most 65 rows per fingerprint, groups of at most 65, no pair lost or added.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import connected_components, map_batches, stage, utf8

CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, words: int) -> int:
    """Signed 64-bit SimHash of a UTF-8 text; no words give zero."""
    ws = text.lower().split()
    if not ws:
        return 0
    if len(ws) < words:
        shingles = iter([b" ".join(ws)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(ws[i:] for i in range(words)), strict=False))
        n = len(ws) - words + 1
    hashes = map(partial(xxhash.xxh64_intdigest, seed=42), shingles)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        h = np.fromiter(hashes, dtype="<u8", count=min(CHUNK, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def add_fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3) -> DataFrame:
    """``docs`` with ``fingerprint`` (long): bits set in over half the XXH64 hashes of the word shingles.

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles count as often as they
    occur. A text of fewer words is one shingle; null, empty or blank texts get zero. A column named
    ``fingerprint`` is replaced.
    """
    return _mapped(docs, text_col, words, "fingerprint")


def _mapped(docs: DataFrame, text_col: str, words: int, name: str, drop: tuple[str, ...] = ()) -> DataFrame:
    def start():
        return lambda batch: {name: [fingerprint(t, words) for t in utf8(batch, text_col)]}

    return map_batches(docs, start, [T.StructField(name, T.LongType())], drop)


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the fingerprints at most ``max_bits`` (0 to 2) apart.

    ``prints`` has a long column ``fingerprint``; repeats and nulls are ignored. Two fingerprints one centre
    apart may be linked through a third one instead of to each other.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    distinct = stage(prints.select("fingerprint").where("fingerprint is not null").distinct(), "prints")
    if max_bits == 0:
        return distinct.selectExpr("fingerprint a", "fingerprint b").where("false")
    # a fingerprint makes 64 rows: the few files that hold them would be too few tasks
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = distinct.repartition(tasks, "fingerprint")
    # halves of 32 bits; the key holds the masked bit's place (which names the half) and the rest of the half
    half = "(shiftrightunsigned(fingerprint, 32 * int(p div 32)) & 4294967295L)"
    variants = (spread.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("p"))
                .selectExpr("fingerprint", f"(shiftleft(bigint(p), 32) | ({half} & ~shiftleft(1L, p % 32))) as k"))
    keys = stage(variants.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"), "keys")
    # shuffled at any size: as a broadcast the keys would do for small inputs alone
    met = stage(variants.hint("merge").join(keys, "k").select("fingerprint").distinct(), "met")
    return _through_centres(met, max_bits)


def _through_centres(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints, all of them at most ``max_bits`` (1 or 2) long: each centre's to its smallest."""
    if max_bits == 1:  # one apart: equal but for one masked bit of the whole fingerprint
        masked = prints.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("p")).selectExpr(
            "fingerprint", "p", "fingerprint & ~shiftleft(1L, p) as centre")
        groups = masked.groupBy("p", "centre")
    else:
        masked = prints.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("p")).selectExpr(
            "fingerprint", "case when p = 64 then fingerprint else fingerprint ^ shiftleft(1L, p) end as centre")
        groups = masked.groupBy("centre")
    # a centre has 65 neighbours at most, itself included
    return (groups.agg(F.min("fingerprint").alias("a"), F.collect_set("fingerprint").alias("all")).where("size(all) > 1")
            .select("a", F.explode("all").alias("b")).where("a <> b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (long) and ``component_id``.

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits; ``component_id``
    is the smallest id reachable. Equal texts (also null, empty and blank ones, all zero) share a
    fingerprint and so a component. Repeated rows stay repeated. A null id never is the smallest one;
    a component of null ids has a null ``component_id``. An empty table gives an empty result.
    """
    rows = stage(_mapped(docs.select(id_col, text_col), text_col, words, "fingerprint", (text_col,)), "fingerprints")
    return rows.join(components(rows, id_col, max_bits), "fingerprint").select(id_col, "fingerprint", "component_id")


def add_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2,
                   out: str = "component_id", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` without the columns ``drop``, each row with its component (see ``near_duplicates``) as ``out``.

    A column of that name is replaced, all others pass through; every row stays as often as it occurs.
    """
    place = _free("near", docs.columns)
    rows = stage(_mapped(docs.drop(out), text_col, words, place, drop), "near")
    found = components(rows.select(F.col(place).alias("fingerprint"), F.col(id_col).alias("_id")), "_id", max_bits)
    found = found.select(F.col("fingerprint").alias(place), F.col("component_id").alias(out))
    return rows.join(found, place).drop(place)


def components(rows: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """``(fingerprint, component_id)`` for the fingerprints of ``rows``."""
    per = stage(rows.groupBy("fingerprint").agg(F.min(id_col).alias("_least")), "least")
    roots = connected_components(links(per, max_bits)).select(F.col("node").alias("fingerprint"), F.col("root"))
    rooted = per.join(roots, "fingerprint", "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                         max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the one of smallest id (a null id comes last; of
    rows that share the smallest id, the one of smallest text, and of equal rows one). All columns stay.
    """
    columns = docs.columns
    # internal names that no column of docs has
    row, place = _free("row", columns), _free("near", columns)
    whole = stage(_mapped(docs, text_col, words, place).withColumn(row, F.monotonically_increasing_id()), "near")
    rows = whole.select(F.col(place).alias("fingerprint"), F.col(id_col).alias("_id"),
                        F.xxhash64(text_col).alias("_text"), F.col(row).alias("_row"))
    per = stage(rows.groupBy("fingerprint").agg(F.min(F.struct(
        F.col("_id").isNull().alias("none"), "_id", "_text", "_row")).alias("best")), "best")
    roots = connected_components(links(per, max_bits)).select(F.col("node").alias("fingerprint"), F.col("root"))
    kept = (per.join(roots, "fingerprint", "left").groupBy(F.coalesce("root", "fingerprint").alias("root"))
            .agg(F.min("best").alias("best")).select(F.col("best._row").alias(row)))
    return whole.join(kept, row, "left_semi").select(*columns)


def _free(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name
