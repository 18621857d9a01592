"""Removal of repeated passages with suffix arrays.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else, too.

Text is first dealt to shards by content. Of the ``GRAM``-byte strings inside a window of ``length`` bytes, the
one with the least hash (the leftmost of equals) is the window's anchor, so equal windows have equal anchors.
Consecutive windows with one anchor form a segment. Anchors that occur once cannot lie in a repeated window;
segments that are equal as a whole are repeated throughout. The segments left over, different ones around a
common anchor, go to one shard, whose suffix array is built by induced sorting; neighbours in it whose common
prefix (computed in text order, from each suffix to its predecessor) has ``length`` bytes are repeats.

An anchor under which very many different segments meet is not given to one task: its segments are dealt again by
a second, longer anchor of each window, those that still meet in crowds by a third, and so on up to an anchor as
long as the window, under which only equal windows meet. Suffix arrays find the repeats at every level.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import stage, utf8
from strataflow.llm.suffix import repeated_starts

LENGTH = 200
GRAM = 40
BLOCK = 1 << 20   # bytes hashed at once
SHARD = 2 << 20   # bytes of segments sorted by one call, on average
STACK = 1 << 20   # letters in one stack of suffix arrays
ALONE = 4 << 10   # bytes from which an anchor's segments are sorted by themselves
CROWD = 2048      # different segments under one anchor in one task; more are dealt again by longer anchors
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACE = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _grams(text: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place, put together from powers of two."""
    level, width, power = text.astype(np.uint64) + np.uint64(1), 1, _B1
    out, done, tail = None, 0, np.uint64(1)
    with np.errstate(over="ignore"):
        while True:
            if size & width:
                n = len(text) - size + 1
                part = level[done:]
                if out is None:
                    out, done = part, width
                else:
                    m = min(len(out), len(part))
                    out, done = out[:m] * power + part[:m], done + width
            if width * 2 > size:
                break
            level = level[:-width] * power + level[width:]
            power, width = power * power, width * 2
        return _mix(out[:n])


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive keys."""
    reach = 1
    while reach * 2 <= width:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    return np.minimum(keys[:len(keys) - (width - reach)], keys[width - reach:]) if reach < width else keys


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def rising(base: int) -> np.ndarray:
        factors = np.full(n + 1, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    return rising(int(_B2)), rising(pow(int(_B2), -1, 1 << 64))


def segments(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Segments of the documents ``text[start:end]``: anchor hash, content hash, first window, number of windows, document."""
    width = length - gram + 1
    hashes = _grams(text, gram)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least = _least(keys, width)
    counts = np.maximum(ends - starts - length + 1, 0)
    doc = np.repeat(np.arange(len(starts)), counts)
    window = np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
    anchor = (least[window] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])[:len(anchor)])
    n = np.diff(np.append(first, len(anchor)))
    at = window[first]
    up, down = _powers(BLOCK + 2 * length)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:len(text)])])
        content = _mix((total[at + n + length - 1] - total[at]) * down[at])
    return hashes[anchor[first]].view(np.int64), content.view(np.int64), at, n, doc[first]


def _slices(sizes: list[int], length: int):
    """Batches of ``(document, first byte, last byte)`` of about ``BLOCK`` bytes; longer documents are taken in
    slices that overlap so that no window is lost or seen twice."""
    held, total = [], 0
    for doc, size in enumerate(sizes):
        for lo in range(0, max(1, size - length + 1), BLOCK):
            hi = min(size, lo + BLOCK + length - 1)
            if held and total + hi - lo > BLOCK + length - 1:
                yield held
                held, total = [], 0
            held.append((doc, lo, hi))
            total += hi - lo
    if held:
        yield held


def _scan(text_col: str, names: list[str], length: int, gram: int):
    """Rows of all columns but the text, with the compressed text and the document's distinct segments."""
    def scan(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = utf8(batch, text_col)
            parts = []
            for held in _slices([len(t) for t in texts], length):
                text = np.frombuffer(b"".join(texts[d][lo:hi] for d, lo, hi in held), dtype=np.uint8)
                if len(text) < length:
                    continue
                ends = np.cumsum([hi - lo for _, lo, hi in held])
                starts = np.append(0, ends[:-1])
                anchor, content, at, n, own = segments(text, starts, ends, length, gram)
                doc, low = np.array([d for d, _, _ in held])[own], np.array([lo for _, lo, _ in held])[own]
                parts.append((doc, anchor, content, n, at - starts[own] + low))
            doc, anchor, content, n, at = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (
                np.empty(0, dtype=np.int64),) * 5
            order = np.lexsort((at, n, content, anchor, doc))
            doc, anchor, content, n, at = doc[order], anchor[order], content[order], n[order], at[order]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
                                                 | (content[1:] != content[:-1]) | (n[1:] != n[:-1])])[:len(doc)])
            places = pa.ListArray.from_arrays(pa.array(np.append(new, len(at)), pa.int32()), pa.array(at, pa.int64()))
            segs = pa.StructArray.from_arrays([pa.array(anchor[new]), pa.array(content[new]),
                                               pa.array(n[new].astype(np.int32)), places], ["h", "s", "n", "at"])
            bounds = np.searchsorted(doc[new], np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names),
                 pa.array([pack.compress(t) for t in texts], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(bounds), segs)], [*names, "blob", "segs"])

    return scan


def _cut(length: int):
    """The bytes of wanted segments, one document's in a row."""
    def cut(batches):
        for batch in batches:
            unpack, rows = zstandard.ZstdDecompressor(), []
            for blob, wanted in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("blob", "wanted")),
                                    strict=True):
                text = unpack.decompress(blob)
                rows += [(w["h"], w["s"], w["n"], w["place"], text[w["at"]:w["at"] + w["n"] + length - 1]) for w in wanted]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             ["h", "s", "n", "place", "bytes"])

    return cut


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _hopeful(groups: list[list[bytes]], length: int, gram: int) -> list[list[tuple[int, int, bytes]]]:
    """For each group the parts ``(piece, first window, bytes)`` whose windows can repeat in it: those of whose
    ``gram``-byte strings every one occurs again in the group's pieces."""
    pieces = [p for g in groups for p in g]
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    hashes = _grams(np.frombuffer(b"".join(pieces), dtype=np.uint8), gram)
    owner = np.repeat(np.arange(len(groups)), [sum(map(len, g)) for g in groups])[:len(hashes)]
    with np.errstate(over="ignore"):
        keys = _mix(hashes + owner.astype(np.uint64) * _B2)
    piece = np.repeat(np.arange(len(pieces)), sizes)[:len(hashes)]
    inside = np.flatnonzero(np.arange(len(hashes)) + gram <= ends[piece])
    order = inside[np.argsort(keys[inside], kind="stable")]
    equal = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(hashes), dtype=bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    alone = np.concatenate([[0], np.cumsum(~again)])
    width = length - gram + 1
    start = np.arange(len(hashes) - width + 1)
    good = (start + length <= ends[piece[start]]) & (alone[start + width] == alone[start])
    turn = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
    # a run of good windows lies within one piece, for the window before the next piece's first one is not good
    number = np.cumsum([0, *map(len, groups)])
    out: list[list[tuple[int, int, bytes]]] = [[] for _ in groups]
    for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
        p = int(piece[a])
        g, first = int(owner[a]), int(a - ends[p] + sizes[p])
        out[g].append((p - int(number[g]), first, pieces[p][first:first + b - a + length - 1]))
    return out


def _sorted_shard(length: int, gram: int):
    """Suffix arrays of a task's anchors, stacked by similar length."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "s", "n"])
        # plain lists: a pandas object for each of very many small groups would cost more than sorting them
        h, s, n, text = (pdf[c].tolist() for c in ("h", "s", "n", "bytes"))
        edges = np.flatnonzero(np.concatenate([[True], np.diff(pdf["h"].to_numpy()) != 0, [True]])).tolist()
        groups = [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        hopeful = _hopeful(groups, length, gram)
        # equal parts are one: repeated throughout, and sorted, if at all, once against the others
        parts: list[dict[bytes, list[tuple[int, int]]]] = []
        for own in hopeful:
            parts.append({})
            for piece, first, part in own:
                parts[-1].setdefault(part, []).append((piece, first))
        whole: dict[int, np.ndarray] = {}

        def mark(group: int, part: bytes, flags) -> None:
            for piece, first in parts[group][part]:
                k = edges[group] + piece
                whole.setdefault(k, np.zeros(n[k], dtype=bool))[first:first + len(part) - length + 1] |= flags

        todo = []
        for i, own in enumerate(parts):
            for part, places in own.items():
                if len(places) > 1:
                    mark(i, part, True)
            if len(own) > 1 or len(own) == 1 and len(places) == 1:
                todo.append((sum(len(part) + 1 for part in own), i))
        todo.sort()
        lo = 0
        while lo < len(todo):
            hi = lo
            while hi < len(todo) and (hi == lo or todo[hi][0] < ALONE and todo[hi][0] * (hi - lo + 1) <= STACK):
                hi += 1
            stack = [i for _, i in todo[lo:hi]]
            for i, found in zip(stack, repeated_starts([list(parts[i]) for i in stack], length), strict=True):
                for part, flags in zip(parts[i], found, strict=True):
                    mark(i, part, flags)
            lo = hi
        out = [(h[k], s[k], n[k], _bits(f)) for k, f in whole.items() if f.any()]
        return pd.DataFrame(out, columns=["h", "s", "n", "bits"])

    return run


def _resegment(length: int, gram: int):
    """The segments of segments under the anchors of ``gram`` bytes: parent ``ph, ps, pn``, first window ``off`` in it,
    and the part's own ``h, s, n, bytes``."""
    def run(batches):
        for batch in batches:
            h, s, n, pieces = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("h", "s", "n", "bytes"))
            rows = []
            for held in _slices([len(p) for p in pieces], length):
                text = np.frombuffer(b"".join(pieces[d][lo:hi] for d, lo, hi in held), dtype=np.uint8)
                if len(text) < length:
                    continue
                ends = np.cumsum([hi - lo for _, lo, hi in held])
                starts = np.append(0, ends[:-1])
                for anchor, content, at, many, own in zip(*(x.tolist() for x in segments(text, starts, ends, length, gram)), strict=True):
                    d, lo, _ = held[own]
                    off = at - int(starts[own]) + lo
                    rows.append((h[d], s[d], n[d], off, anchor, content, many, pieces[d][off:off + many + length - 1]))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             ["ph", "ps", "pn", "off", "h", "s", "n", "bytes"])

    return run


def _places(kinds: DataFrame, crowd: int, shard_bytes: int) -> DataFrame:
    """``h, place``: the shard of each anchor of ``kinds`` (h, kinds, bytes), -1 where more than ``crowd`` segments meet.

    Anchors of similar size sort together, in shards of about ``shard_bytes``."""
    sizes = (kinds.where(F.col("kinds") <= crowd).groupBy(_size_class("bytes").alias("class"))
             .agg(F.sum("bytes").alias("bytes")).collect())  # a row for each size class, under 64
    split = {int(r["class"]): max(1, -(-r["bytes"] // shard_bytes)) for r in sizes}
    by_class = F.coalesce(*[F.when(F.col("class") == c, F.pmod(F.xxhash64("h"), F.lit(k)) * 64 + c) for c, k in split.items()],
                          F.lit(-1).cast("long")) if split else F.lit(-1).cast("long")
    return kinds.withColumn("class", _size_class("bytes")).select(
        "h", F.when(F.col("kinds") > crowd, F.lit(-1)).otherwise(by_class).cast("int").alias("place"))


def _kinds(distinct: DataFrame, length: int) -> DataFrame:
    """Anchors under which different segments meet, how many and how long they are together."""
    return distinct.groupBy("h").agg(F.count("*").alias("kinds"), F.sum(F.col("n") + F.lit(length)).alias("bytes")).where("kinds > 1")


def _joined(hits: DataFrame) -> DataFrame:
    """The flags of segments ``h, s, n`` put together from those of their parts (``hits``: structs of off, n, bits)."""
    @F.pandas_udf("binary")
    def join(n: pd.Series, parts: pd.Series) -> pd.Series:
        out = []
        for size, own in zip(n, parts, strict=True):
            flags = np.zeros(size, dtype=bool)
            for p in own:
                flags[p["off"]:p["off"] + p["n"]] |= True if p["bits"] is None else np.unpackbits(
                    np.frombuffer(p["bits"], dtype=np.uint8), count=p["n"]).astype(bool)
            out.append(_bits(flags))
        return pd.Series(out, dtype=object)

    return hits.select("h", "s", "n", join("n", "hits").alias("bits"))


def _crowded(pieces: DataFrame, length: int, grams: list[int], crowd: int, shard_bytes: int) -> DataFrame:
    """The repeats ``h, s, n, bits`` inside the different segments ``h, s, n, bytes`` of crowded anchors, found under
    anchors of the next length of ``grams``, and so on."""
    parts = stage(pieces.mapInArrow(_resegment(length, grams[0]),
                                    "ph long, ps long, pn int, off long, h long, s long, n int, bytes binary"), "parts")
    distinct = stage(parts.groupBy("h", "s", "n").agg(F.count("*").alias("times"), F.any_value("bytes").alias("bytes")), "kinds")
    kinds = _kinds(distinct, length)
    last = len(grams) == 1  # under anchors as long as a window only equal windows meet
    dealt = stage(distinct.join(_places(kinds, (1 << 31) - 1 if last else crowd, shard_bytes), "h")
                  .select("h", "s", "n", "place", "bytes"), "pieces")
    found = dealt.where("place >= 0").groupBy("place").applyInPandas(
        _sorted_shard(length, grams[0]), "h long, s long, n int, bits binary")
    if not last and dealt.where("place < 0").limit(1).count():
        found = found.union(_crowded(dealt.where("place < 0").select("h", "s", "n", "bytes"), length, grams[1:], crowd, shard_bytes))
    whole = distinct.where("times > 1").select("h", "s", "n", F.lit(None).cast("binary").alias("bits"))
    found = found.join(whole.select("h", "s", "n"), ["h", "s", "n"], "left_anti").union(whole)
    hits = (parts.drop("bytes").join(found, ["h", "s", "n"]).groupBy("ph", "ps", "pn")
            .agg(F.collect_list(F.struct("off", "n", "bits")).alias("hits")))  # parts of one segment
    return _joined(hits.toDF("h", "s", "n", "hits"))


def _removed(size: int, hits: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal removed runs of a document of ``size`` bytes."""
    edge = np.zeros(size + 1, dtype=np.int64)
    for hit in hits:
        if hit["bits"] is None:
            runs = [(0, hit["n"])]
        else:
            on = np.unpackbits(np.frombuffer(hit["bits"], dtype=np.uint8), count=hit["n"])
            turn = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]]).astype(np.int8))).tolist()
            runs = list(zip(turn[::2], turn[1::2], strict=True))
        for at in hit["at"]:
            for first, last in runs:
                edge[at + first] += 1
                edge[at + last + length - 1] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))


def _finish(names: list[str], length: int, with_text: bool):
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            sizes, spans, kept = [], [], []
            for blob, hits in zip(col["blob"].to_pylist(), col["hits"].to_pylist(), strict=True):
                text = unpack.decompress(blob)
                runs = _removed(len(text), hits, length) if hits else []
                edges = [0, *(x for r in runs for x in r), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if runs else text
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(rest if with_text else hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(col[c] for c in names), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary() if with_text else pa.string())],
                [*names, "n_bytes", "removed", "kept" if with_text else "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   with_text: bool = True, crowd: int = CROWD, shard_bytes: int = SHARD) -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``removed`` (maximal runs of byte ``start``/``end``) and the rest of the
    text as ``kept`` (binary, for a run may cut a character) or, without ``with_text``, its hash ``kept_sha256``.

    A null text is empty; one shorter than ``length`` loses nothing. Repeated rows repeat each other's text and
    lose it all. Columns named like the new ones are replaced. An empty table gives an empty result.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be in 1..length")
    made = {"n_bytes", "removed", "kept", "kept_sha256", text_col.lower()}
    names = [f"c{i}" for i, c in enumerate(docs.columns) if c.lower() not in made]
    original = {f"c{i}": c for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(original[c]).alias(c) for c in names], F.col(text_col).alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    kept_fields = [plain.schema[c] for c in names]
    row_field = T.StructField("row", T.LongType())
    seg = T.StructType([T.StructField("h", T.LongType()), T.StructField("s", T.LongType()),
                        T.StructField("n", T.IntegerType()), T.StructField("at", T.ArrayType(T.LongType()))])
    scanned = stage(plain.mapInArrow(_scan("text", [*names, "row"], length, gram), T.StructType(
        [*kept_fields, row_field, T.StructField("blob", T.BinaryType()), T.StructField("segs", T.ArrayType(seg))])), "scanned")

    # anchors that occur more than once
    segs = scanned.select("row", F.inline("segs"))
    again = segs.groupBy("h").agg(F.sum(F.size("at")).alias("all")).where(F.col("all") > 1).select("h")
    shared = stage(segs.join(again, "h", "left_semi"), "shared")
    # segments by content, and how many different ones share the anchor
    distinct = stage(shared.groupBy("h", "s", "n").agg(
        F.sum(F.size("at")).alias("times"), F.min(F.struct("row", F.get("at", F.lit(0)).alias("at"))).alias("one")), "distinct")
    placed = _places(_kinds(distinct, length), crowd, shard_bytes)
    wanted = (distinct.join(placed, "h").groupBy("one.row")
              .agg(F.collect_list(F.struct("h", "s", "n", F.col("one.at").alias("at"), "place")).alias("wanted")))
    pieces = stage(scanned.select("row", "blob").join(wanted, "row").select("blob", "wanted").mapInArrow(
        _cut(length), "h long, s long, n int, place int, bytes binary"), "pieces")
    sorted_ = pieces.where("place >= 0").groupBy("place").applyInPandas(
        _sorted_shard(length, gram), "h long, s long, n int, bits binary")
    whole = distinct.where("times > 1").select("h", "s", "n", F.lit(None).cast("binary").alias("bits"))
    if pieces.where("place < 0").limit(1).count():
        longer = [*(g for g in (2 * gram, 4 * gram) if g < length), length]
        sorted_ = sorted_.union(_crowded(pieces.where("place < 0").select("h", "s", "n", "bytes"), length, longer, crowd, shard_bytes))
    found = sorted_.join(whole.select("h", "s", "n"), ["h", "s", "n"], "left_anti").union(whole)
    hits = (shared.join(found, ["h", "s", "n"]).groupBy("row")
            .agg(F.collect_list(F.struct("n", "at", "bits")).alias("hits")))  # of one document
    rest = T.BinaryType() if with_text else T.StringType()
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    done = scanned.select(*names, "row", "blob").join(hits, "row", "left").select(*names, "blob", "hits").mapInArrow(
        _finish(names, length, with_text), T.StructType([
            *kept_fields, T.StructField("n_bytes", T.LongType()), T.StructField("removed", spans),
            T.StructField("kept" if with_text else "kept_sha256", rest)]))
    return done.withColumnsRenamed({c: original[c] for c in names})


def _size_class(col: str):
    return F.least(F.floor(F.log(F.col(col).cast("double")) / float(np.log(1.25))), F.lit(63))


def with_digest(done: DataFrame) -> DataFrame:
    """``n_removed`` and ``n_spans`` from ``removed``."""
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return done.withColumns({"n_removed": total, "n_spans": F.size("removed").cast("long")})
