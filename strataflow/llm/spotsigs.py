"""Document fingerprints from chains of content words that follow common words (SpotSigs).

Wherever a common word (an anchor) occurs, it forms a signature with the next ``chain`` content words after it; the
set of a text's signatures is its fingerprint. Running text is full of anchors, lists of links and boilerplate are
not. Fingerprints are compared by Jaccard similarity; a join does so only inside neighbouring ranges of set length
and among sets that share one of their rarest signatures.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strataflow.llm.common import hash_cut, map_batches, stage, utf8
from strataflow.llm.decontaminate import words_of

# Common words of English, German, French and Spanish.
ANCHORS = frozenset((
    "a an and are as at be been but by for from had has have he her his in is it its not of on or she that the their "
    "there they this to was we were which will with you "
    "als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich ihr im in ist "
    "mit nach nicht noch nur oder sich sie sind und von vor war werden wie wir wird zu zum zur "
    "au aux avec ce cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour "
    "que qui sa se ses son sont sur un une vous "
    "al como con de del el en era es esta este fue ha la las le lo los más no o para pero por que se ser si sin son su "
    "sus también un una y ya").split())
CHAIN = 2
HEX = 16  # letters of a signature in a fingerprint: the first 64 bits of its MD5


def signer(anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> Callable[[bytes], list[bytes]]:
    """A function from a UTF-8 text to the sorted distinct signatures of its chains, as 8 bytes each.

    Words: runs of letters and digits of ASCII (A-Z as a-z) and of all other characters. A text without a whole
    chain has one signature, of all its words; a text without words has none.
    """
    common, md5 = {a.encode() for a in anchors}, hashlib.md5

    def signatures(text: bytes) -> list[bytes]:
        words = words_of(text)
        chains, content = set(), []
        for word in reversed(words):
            if word not in common:
                content.append(word)
            elif len(content) >= chain:
                chains.add(b" ".join((word, *content[:-chain - 1:-1])))
        if not chains and words:
            chains.add(b" ".join(words))
        return sorted({md5(c).digest()[:8] for c in chains})

    return signatures


def likeness(a: list[bytes], b: list[bytes], least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets, or 0.0 as soon as their lengths rule out ``least``; two empty sets: 1."""
    short, long = sorted((len(a), len(b)))
    if not long:
        return 1.0
    if short < least * long:
        return 0.0
    same = len(set(a).intersection(b))
    found = same / (short + long - same)
    return found if found >= least else 0.0


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", anchors: frozenset[str] = ANCHORS,
                 chain: int = CHAIN, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``out``: the whole text's signatures as hexadecimal numbers of 16 digits each, sorted and joined.

    Null and wordless texts have the empty fingerprint; equal texts have equal ones. A column of that name is
    replaced, all others pass through.
    """
    def start():
        signatures = signer(anchors, chain)
        return lambda batch: {out: [b"".join(signatures(t)).hex() for t in utf8(batch, text_col)]}

    return map_batches(docs, start, [T.StructField(out, T.StringType())], drop)


def in_reading_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``lane, tail, id, text`` in tasks that hold whole lanes: ranges of descending ids, in order.

    Each lane ends with rows of ``tail`` 1, copies of the first row of the next lane (after the last one, of the
    first). Null ids come last, rows of one id follow a hash of their text, null texts are empty. The lanes are cut
    at the quantiles of a sample of about 32 rows for each shuffle partition, which only decides where work is split;
    rows equal in id and text share a lane.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "h", F.xxhash64("text"))
    lanes, n = int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count()
    drawn = sorted((r["id"], r["h"]) for r in rows.where(
        F.col("id").isNotNull() & (F.xxhash64("id", "h") <= hash_cut(32 * lanes / max(n, 1)))).select("id", "h").collect())
    cuts = sorted({drawn[len(drawn) * i // lanes] for i in range(1, lanes)}) if drawn else []
    lane = F.lit(0)
    if cuts:  # the number of cuts at or below the row, by bisection
        ids, hashes = F.lit([c[0] for c in cuts]), F.lit([c[1] for c in cuts])

        def halve(s, _):
            mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            at = F.get(ids, mid)
            up = (s["lo"] < s["hi"]) & ((at < F.col("id")) | ((at == F.col("id")) & (F.get(hashes, mid) <= F.col("h"))))
            up = F.coalesce(up, F.lit(False))
            return F.struct(F.when(up, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(up, s["hi"]).otherwise(mid).alias("hi"))

        whole = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
        found = F.aggregate(F.sequence(F.lit(0), F.lit(len(cuts).bit_length())), whole, halve)
        lane = F.lit(len(cuts)) - found["lo"]
    rows = rows.withColumn("lane", lane)
    # a null id is the least of all: last in descending order
    heads = sorted((r["lane"], r["k"]["id"], r["k"]["h"]) for r in rows.groupBy("lane").agg(
        F.max(F.struct("id", "h")).alias("k")).collect())  # a row for each lane
    kind = rows.schema["id"].dataType.simpleString()
    table = spark.createDataFrame([(*h, heads[i - 1][0]) for i, h in enumerate(heads)],
                                  f"lane int, head_id {kind}, head_h long, before int")
    marked = rows.join(F.broadcast(table), "lane")
    own = F.struct(F.col("lane"), F.lit(0).alias("tail"))
    is_head = F.col("id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    both = F.array(own, F.struct(F.col("before").alias("lane"), F.lit(1).alias("tail")))
    placed = marked.select(F.explode(F.when(is_head, both).otherwise(F.array(own))).alias("p"), "id", "h", "text")
    return (placed.select("p.lane", "p.tail", "id", "h", "text").repartition(lanes, "lane")
            .sortWithinPartitions("lane", "tail", F.col("id").desc_nulls_last(), F.col("h").desc()).drop("h"))


def against_edits(docs: DataFrame, share: int = 3, id_col: str = "doc_id", text_col: str = "text",
                  anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """How far a fingerprint follows its text: one row per document, compared with an edited text and with another one.

    The edited text has the last ``floor(n_chars / share)`` code points replaced by the first as many (or all) of the
    next document's, in descending order of ids (see ``in_reading_order``); the other text is that next document.
    ``near_edited`` and ``near_next`` are Jaccard similarities of the signature sets. A table of one document has
    itself as its next; an empty one gives no rows.
    """
    ordered = in_reading_order(docs, id_col, text_col)
    key = ordered.schema["id"].dataType
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [to_arrow_type(key), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        signatures, last = signer(anchors, chain), None
        for batch in batches:
            made = []
            for lane, tail, own_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tail and (last is None or last[0] != lane):
                    continue  # one more copy of a head that occurs more than once
                signs = signatures(text.encode())
                if last is not None and last[0] == lane:
                    _, before, own, own_signs = last
                    cut = len(own) // share
                    edited = (own[:len(own) - cut] + text[:cut]).encode()
                    edited_signs = signatures(edited)
                    made.append((before, len(own), hashlib.sha256(edited).hexdigest(), b"".join(own_signs).hex(),
                                 b"".join(edited_signs).hex(), likeness(own_signs, edited_signs), likeness(own_signs, signs)))
                last = None if tail else (lane, own_id, text, signs)
            columns = list(zip(*made, strict=True)) if made else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return ordered.mapInArrow(run, f"id {key.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("id", id_col)


def similar(prints: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", out: str = "fingerprint",
            ) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b, likeness`` of distinct fingerprints of Jaccard similarity ``threshold`` or more, and the
    membership ``id, set_id`` of every document.

    Equal fingerprints are one set (``set_id``: their MD5), so copies are not paired out. A set is compared only
    with sets of its own and the next range of lengths, the ranges growing by ``1 / threshold``, that share a
    signature of both prefixes (the rarest ``n - ceil(threshold n) + 1``); lengths and the places of the shared
    signature bound the overlap before the sets are read. Empty fingerprints are members of a set without pairs,
    null ids are kept, repeated rows are repeated members.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1; equal fingerprints share their set_id")
    members = prints.select(F.col(id_col).alias("id"), F.md5(F.col(out)).alias("set_id"))
    sets = stage(prints.where(F.col(out) != "").groupBy(F.md5(F.col(out)).alias("set_id")).agg(F.any_value(out).alias("f"))
                 .select("set_id", F.expr(f"regexp_extract_all(f, '.{{{HEX}}}', 0)").alias("signs")), "sets")
    signs = sets.select("set_id", F.size("signs").alias("n"), F.explode("signs").alias("sign"))
    rare = signs.join(signs.groupBy("sign").agg(F.count("*").alias("df")), "sign")
    place = F.row_number().over(Window.partitionBy("set_id").orderBy("df", "sign"))  # a set is one text's signatures
    width = math.log(1 / threshold) * (1 + 1e-9)
    index = stage(rare.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
                  .select("set_id", "n", "sign", "place", F.floor(F.log("n") / width).alias("lane")), "index")
    probe = index.select(F.col("set_id").alias("a"), F.col("n").alias("m"), "sign", F.col("place").alias("q"),
                         F.explode(F.array("lane", F.col("lane") + 1)).alias("lane"))
    need = F.ceil((F.col("m") + F.col("n")) * threshold / (1 + threshold) - 1e-9)
    found = (probe.join(index.withColumnRenamed("set_id", "b"), ["lane", "sign"])
             .where((F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("a") < F.col("b"))))
             .where(F.col("m") >= F.col("n") * threshold - 1e-9)
             .where(1 + F.least(F.col("m") - F.col("q"), F.col("n") - F.col("place")) >= need)
             .select("a", "b").distinct())
    both = (found.join(sets.select(F.col("set_id").alias("a"), F.col("signs").alias("x")), "a")
            .join(sets.select(F.col("set_id").alias("b"), F.col("signs").alias("y")), "b"))
    same = F.size(F.array_intersect("x", "y"))
    pairs = both.select("a", "b", (same / (F.size("x") + F.size("y") - same)).alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold), members
