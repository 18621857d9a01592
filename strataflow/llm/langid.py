"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds its letters, each permuted (rotated) by its
place: r(r(a)) * r(b) * c. A text bundles (adds) its trigrams, a language the unit vectors of its texts, and a
text goes to the language whose prototype has the largest cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import hash_cut, map_batches

DIMENSIONS = 1024
SLOTS = 1 << 21     # more than there are letters; 0: word boundary; 1 to 26: a to z; the rest as they occur
LEARNED = 5_000     # texts a language is learned from, at most (in expectation)
LANGUAGES = 10_000  # distinct values of the language column, at most
BLOCK_DOCS, BLOCK_CHARS, BLOCK_GRAMS = 64, 1 << 19, 4096


class Encoder:
    """Texts to hypervectors."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        self.dimensions, self.seed = dimensions, seed
        self.slot = np.full(0x110000, -1, dtype=np.int32)  # by code point, numbered as letters occur
        self.places = [np.empty((0, dimensions), dtype=np.int8)] * 3
        self.add([0, *range(97, 123)])

    def add(self, points: list[int]) -> None:
        """Slots for letters; a vector is drawn by its code point and so is the same in every task."""
        self.slot[points] = np.arange(len(points)) + len(self.places[2])
        new = np.array([np.random.RandomState([self.seed, p]).randint(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
                        for p in points], dtype=np.int8)
        self.places = [np.concatenate([old, np.roll(new, by, axis=1)]) for old, by in zip(self.places, (2, 1, 0), strict=True)]

    def slots(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        slots = self.slot[points]
        if (slots < 0).any():
            seen = np.unique(points[slots < 0]).tolist()
            self.slot[[p for p in seen if not chr(p).isalpha()]] = 0
            if new := [p for p in seen if chr(p).isalpha()]:
                self.add(new)
            slots = self.slot[points]
        return slots

    def grams(self, text: str) -> np.ndarray:
        """Trigram codes; a run of other characters, and either end, is one boundary. No letter: none."""
        slots = self.slots(text)
        if not slots.any():
            return np.empty(0, dtype=np.int64)
        slots = np.concatenate([[0], slots, [0]]).astype(np.int64)
        slots = slots[np.append(True, (slots[1:] > 0) | (slots[:-1] > 0))]
        return (slots[:-2] * SLOTS + slots[1:-1]) * SLOTS + slots[2:]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        a, b, c = codes // SLOTS ** 2, codes // SLOTS % SLOTS, codes % SLOTS
        return (self.places[0][a] * self.places[1][b] * self.places[2][c]).astype(np.float32)

    def bundle(self, grams: list[np.ndarray]) -> np.ndarray:
        """A row for each text."""
        out = np.zeros((len(grams), self.dimensions), dtype=np.float32)
        codes, at = np.unique(np.concatenate(grams), return_inverse=True) if grams else (np.empty(0, int),) * 2
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        for lo in range(0, len(codes), BLOCK_GRAMS):
            n = min(BLOCK_GRAMS, len(codes) - lo)
            own = (at >= lo) & (at < lo + n)
            counts = np.bincount(owner[own] * n + at[own] - lo, minlength=len(grams) * n).reshape(len(grams), n)
            out += counts.astype(np.float32) @ self.vectors(codes[lo:lo + n])
        return out

    def blocks(self, texts: list[str]):
        """``(texts' numbers, hypervectors)`` over blocks of bounded size; long texts are added up piecewise."""
        held: list[int] = []
        grams: list[np.ndarray] = []
        size = 0
        for i, text in enumerate(texts):
            own = self.grams(text)
            if size + len(own) > BLOCK_CHARS and held:
                yield held, self.bundle(grams)
                held, grams, size = [], [], 0
            held.append(i)
            if len(own) > BLOCK_CHARS:
                yield held, sum(self.bundle([own[k:k + BLOCK_CHARS]]) for k in range(0, len(own), BLOCK_CHARS))
                held, grams, size = [], [], 0
                continue
            grams.append(own)
            size += len(own)
            if len(held) == BLOCK_DOCS:
                yield held, self.bundle(grams)
                held, grams, size = [], [], 0
        if held:
            yield held, self.bundle(grams)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", learned: int = LEARNED,
          dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit prototypes by language from at most about ``learned`` texts each, chosen by a hash of the text. Equal texts
    of a language teach once, so that a group of copies is neither many texts nor most of a prototype.

    Rows with a null text or language, and texts without letters, teach nothing. More than ``LANGUAGES``
    languages are refused. An empty table gives no prototypes.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = known.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return {}
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], hash_cut(learned / r["count"])) for r in sizes], "lang string, cut long")
    sample = (known.join(F.broadcast(shares), "lang")  # LANGUAGES rows at most
              .where(F.xxhash64("text") <= F.col("cut")).select("text", "lang").distinct())

    def sums(batches):
        encoder = Encoder(dimensions)
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for rows, vectors in encoder.blocks(batch.column("text").to_pylist()):
                for i, v in zip(rows, _unit(vectors), strict=True):
                    total[langs[i]] = total.get(langs[i], 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                          pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                                         ["lang", "v"])

    added = (sample.mapInArrow(sums, "lang string, v array<double>").select("lang", F.posexplode("v").alias("at", "x"))
             .groupBy("lang", "at").agg(F.sum("x").alias("x")).groupBy("lang")
             .agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v")))  # `dimensions` entries each
    found = {r["lang"]: np.array([e["x"] for e in r["v"]]) for r in added.collect()}
    return {k: v / np.linalg.norm(v) for k, v in sorted(found.items()) if np.linalg.norm(v) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text",
            drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the cosine, 0 to 1).

    Texts that are null or without a letter, and all texts when nothing was learned, get ``und`` and 0. Equal
    cosines go to the first language in order of name. Columns of these names are replaced; ``drop`` names
    columns not to return.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names], dtype=np.float32)

    def start():
        encoder = Encoder(matrix.shape[1]) if names else None

        def compute(batch):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            for rows, vectors in encoder.blocks(texts) if names else ():
                cosine = _unit(vectors) @ matrix.T
                best = cosine.argmax(axis=1)
                for i, b, c, v in zip(rows, best.tolist(), cosine[np.arange(len(best)), best].tolist(),
                                      vectors.any(axis=1).tolist(), strict=True):
                    if v:
                        lang[i], score[i] = names[b], round(min(1.0, max(0.0, c)), 6)
            return {"lang_pred": lang, "score": score}

        return compute

    return map_batches(docs, start, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], drop)
