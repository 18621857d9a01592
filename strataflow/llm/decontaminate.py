"""Benchmark decontamination as a prefix-filtered set join.

A window (``size`` consecutive words of an item) is contained in a document only if all its word
shingles are, so its rarest shingle alone is the necessary prefix. Shingles are ordered by how often
they occur in all documents (a first pass over them); the second pass joins document positions with
the windows on that one shingle, bounds the window's start by the shingle's place in the window and
by both lengths, and verifies the words.

The benchmark is the query set: it is taken in blocks of bounded size, each shipped to the tasks
once, against all rows.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import map_batches, utf8

SHINGLE = 3
BLOCK_BYTES = 2 << 20    # benchmark text in one block (some 300,000 windows)
CHECKED = 1 << 15        # candidates verified at once
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters."""
    return text.translate(_WORD).split()


class Windows:
    """The distinct windows of one block of items."""

    def __init__(self, items: Iterable[tuple[str, bytes]], size: int):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            ws = words_of(text)
            for at in range(max(1, len(ws) - size + 1) if ws else 0):
                owners.setdefault(tuple(ws[at:at + size]), set()).add(item)
        texts = sorted(owners)
        self.items = [sorted(owners[w]) for w in texts]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        self.base = len(self.vocabulary) + 1
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.ids = np.zeros((len(texts), size), dtype=np.int64)
        for row, t in enumerate(texts):
            self.ids[row, :len(t)] = [self.vocabulary[w] for w in t]
        # short items have shingles of their own length
        self.grams = np.minimum(self.lengths, SHINGLE)
        self.sizes = [int(s) for s in np.unique(self.grams)]
        self.codes = {s: np.unique(np.concatenate([self._row_codes(r, s) for r in np.flatnonzero(self.grams == s)]))
                      for s in self.sizes}
        self.prefixes: dict[int, tuple[np.ndarray, ...]] = {}

    def _row_codes(self, row: int, s: int) -> np.ndarray:
        return self.shingles(self.ids[row, :self.lengths[row]], s)[0]

    def shingles(self, ids: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
        """A code for each run of ``s`` word ids, and whether all its words are the block's.

        Codes are taken modulo 2^64, so with very many words different runs may share one; that only adds
        candidates, whose words are verified."""
        n = len(ids) - s + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
        code, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for k in range(s):
            part = ids[k:k + n]
            code = code * np.int64(self.base) + part
            known &= part > 0
        return code, known

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Choose each window's rarest shingle (the first of equals) as its prefix."""
        for s in self.sizes:
            rows = []
            for r in np.flatnonzero(self.grams == s):
                codes = self._row_codes(r, s)
                seen = [counts.get((s, int(c)), 0) for c in codes]
                if min(seen):  # a window with a shingle that occurs nowhere cannot occur
                    at = int(np.argmin(seen))
                    rows.append((int(codes[at]), at, int(r)))
            rows.sort()
            table = np.array(rows, dtype=np.int64).reshape(-1, 3)
            keys, first = np.unique(table[:, 0], return_index=True)
            self.prefixes[s] = (keys, first, np.diff(np.append(first, len(table))), table[:, 1], table[:, 2])

    def word_ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))

    def matches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and windows of all occurrences in a document's word ids."""
        starts, found, n = [], [], len(ids)
        for s, (keys, first, many, place, window) in self.prefixes.items():
            at, slot = _lookup(*self.shingles(ids, s), keys)
            for lo in range(0, len(at), CHECKED):
                k = many[slot[lo:lo + CHECKED]]
                entry = np.repeat(first[slot[lo:lo + CHECKED]] - np.cumsum(k) + k, k) + np.arange(k.sum())
                w = window[entry]
                begin = np.repeat(at[lo:lo + CHECKED], k) - place[entry]
                fits = (begin >= 0) & (begin + self.lengths[w] <= n)
                w, begin = w[fits], begin[fits]
                same = np.ones(len(w), dtype=bool)
                for j in range(self.ids.shape[1]):
                    inside = j < self.lengths[w]
                    same &= ~inside | (ids[np.minimum(begin + j, n - 1)] == self.ids[w, j])
                starts.append(begin[same])
                found.append(w[same])
        if not starts:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate(starts), np.concatenate(found)


def _lookup(codes: np.ndarray, known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the known codes that are keys, and which keys they are (``keys`` sorted)."""
    if not len(keys) or not len(codes):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = np.flatnonzero(known)
    slot = np.minimum(np.searchsorted(keys, codes[at]), len(keys) - 1)
    hit = keys[slot] == codes[at]
    return at[hit], slot[hit]


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of ranges as maximal runs of words; touching ranges join."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return list(zip(s[new].tolist(), e[np.append(new[1:] - 1, len(s) - 1)].tolist(), strict=True))


def _shingle_counts(docs: DataFrame, text_col: str, windows) -> dict[tuple[int, int], int]:
    """How often each of the block's shingles occurs in all documents (at most as many as the block has)."""
    def count(batches):
        own = windows.value
        total = {s: np.zeros(len(own.codes[s]), dtype=np.int64) for s in own.sizes}
        for batch in batches:
            for text in utf8(batch, text_col):
                ids = own.word_ids(words_of(text))
                for s in own.sizes:
                    total[s] += np.bincount(_lookup(*own.shingles(ids, s), own.codes[s])[1], minlength=len(total[s]))
        for s in own.sizes:
            hit = np.flatnonzero(total[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(hit), s)), pa.array(own.codes[s][hit]), pa.array(total[s][hit])], ["s", "code", "n"])

    found = docs.select(text_col).mapInArrow(count, "s long, code long, n long")
    return {(r.s, r.code): r.n for r in found.groupBy("s", "code").agg(F.sum("n").alias("n")).toLocalIterator()}


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  item_text_col: str = "text", size: int = 10, drop: tuple[str, ...] = (),
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (maximal runs of hit words, ends exclusive) and ``hit_items``
    (text of the ids of items with an occurring window, sorted as strings).

    An item of fewer than ``size`` words is one window; an item without words, with a null text or a null
    id has none. Items of equal text each count, repeated ids once. A null document has no words. Touching
    spans are one. Columns named like the new ones are replaced; ``drop`` names columns not to return.
    An empty benchmark gives no hits. ``block_bytes`` bounds the benchmark text a task holds at a time (one
    longer item is a block of its own); the blocks are passed over all documents one after another.
    """
    spark = docs.sparkSession
    named = items.where(F.col(id_col).isNotNull() & F.col(item_text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPANS),
              T.StructField("hit_items", T.ArrayType(T.StringType()))]
    kept = docs.select(*[c for c in docs.columns if c.lower() not in {f.name for f in fields}])
    for b in range(blocks):
        own = named.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        windows = Windows(((r.id, r.text.encode()) for r in own.toLocalIterator()), size)
        shipped = spark.sparkContext.broadcast(windows)
        windows.order(_shingle_counts(docs, text_col, shipped) if windows.items else {})
        shipped = spark.sparkContext.broadcast(windows)
        kept = map_batches(kept, _marker(shipped, text_col, b > 0), fields, drop if b == blocks - 1 else ())
    return kept


def _marker(windows, text_col: str, more: bool):
    def start():
        own = windows.value

        def mark(batch):
            n_words, spans, items = [], [], []
            before = [batch.column(c).to_pylist() for c in ("hit_spans", "hit_items")] if more else None
            for row, text in enumerate(utf8(batch, text_col)):
                words = words_of(text)
                begin, w = own.matches(own.word_ids(words)) if own.items else (np.empty(0, int), np.empty(0, int))
                end, names = begin + own.lengths[w] if len(w) else begin, {i for x in np.unique(w) for i in own.items[x]}
                if more:
                    names |= set(before[1][row])
                    begin = np.append(begin, [x["start"] for x in before[0][row]]).astype(np.int64)
                    end = np.append(end, [x["end"] for x in before[0][row]]).astype(np.int64)
                n_words.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in _merged(begin, end)])
                items.append(sorted(names))
            return {"n_words": n_words, "hit_spans": spans, "hit_items": items}

        return mark

    return start


def with_digest(marked: DataFrame) -> DataFrame:
    """``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` from the operator's columns."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return marked.withColumns({
        "n_hit": n_hit, "n_items": F.size("hit_items").cast("long"),
        "items_sha256": F.sha2(F.array_join("hit_items", ","), 256), "contaminated": F.size("hit_spans") > 0})
