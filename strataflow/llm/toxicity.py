"""Toxicity by weak supervision.

Sixteen voters (lexicons, patterns, and lexicons of words and word stems mined from the labelled rows) fire
or stay silent on every document. A generative model of the hidden label explains the votes: per class a
firing rate for each voter and a tree of its strongest correlations, fitted by expectation-maximisation on
the counts of vote patterns over all documents, with the labelled sample held at its labels. A logistic
regression on word features is trained on the resulting posterior labels and scores every document.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import hash_cut, map_batches, stage

LABELLED = 12_000   # labelled rows that words are mined from, at most (in expectation)
FITTED = 20_000     # rows with posterior labels that the classifier is trained on, at most (in expectation)
MINED = 256         # mined words and stems
VOTERS = 16
STEMS = (3, 4, 5, 6)
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
LEXICONS = {
    "insult": "idiot idiots moron morons stupid dumb loser losers fool imbecile clown pathetic worthless useless "
              "ugly scum trash garbage vermin filth jerk creep coward",
    "disgust": "disgusting disgusted gross vile repulsive revolting sick nasty rotten despicable",
    "threat": "kill die hurt destroy burn beat shoot stab hang threaten suffer",
    "profanity": "damn hell crap shit fuck fucking bastard bitch ass asshole piss",
}
_LEXICON = {w: name for name, words in LEXICONS.items() for w in words.split()}
_STRONG = frozenset(w for w, name in _LEXICON.items() if name in ("insult", "disgust"))
_SECOND = re.compile(r"\b(?:you|your|you're|ur)\b(?:\W+\w+){0,2}?\W+(?:" + "|".join(sorted(_STRONG)) + r")\b")


@dataclass
class Features:
    """Mined words and stems by number (the surest first), looked up by word or by prefix."""

    names: list[str]

    def __post_init__(self):
        self.words = {n: i for i, n in enumerate(self.names) if not n.endswith("*")}
        self.stems = {k: {n[:-1]: i for i, n in enumerate(self.names) if n.endswith("*") and len(n) == k + 1} for k in STEMS}
        # forms of like reliability vote together
        self.group = [8 * i // len(self.names) for i in range(len(self.names))]

    @property
    def size(self) -> int:
        return len(self.names) + len(LEXICONS) + 8

    def read(self, text: str) -> tuple[int, list[int]]:
        """The vote pattern of a text and the numbers of its features."""
        low = text.lower()
        words = _WORD.findall(low)
        distinct = set(words)
        hit, mined_words, lexicon = set(), 0, {}
        for w in distinct:
            before = len(hit)
            if (i := self.words.get(w)) is not None:
                hit.add(i)
            found = len(hit) > before
            for k, stems in self.stems.items():
                if len(w) > k and (i := stems.get(w[:k])) is not None:
                    hit.add(i)
                    found = True
            mined_words += found
            if w in _LEXICON:
                lexicon.setdefault(_LEXICON[w], set()).add(w)
        strong = len(lexicon.get("insult", ())) + len(lexicon.get("disgust", ()))
        density = mined_words / max(1, len(distinct))
        letters = sum(map(str.isupper, text)) / max(1, len(text))
        votes = [
            "insult" in lexicon, "disgust" in lexicon, "threat" in lexicon, "profanity" in lexicon,
            strong > 0 and _SECOND.search(low) is not None, letters > 0.5, density >= 0.01, mined_words >= 3]
        groups = {self.group[i] for i in hit}
        mask = sum(1 << i for i, v in enumerate(votes) if v) + sum(1 << (8 + g) for g in groups)
        n = len(self.names)
        extra = [i for i, name in enumerate(LEXICONS) if name in lexicon]
        extra += [len(LEXICONS) + i for i, on in enumerate((
            mined_words >= 1, mined_words >= 2, mined_words >= 3, mined_words >= 5,
            density >= 0.005, density >= 0.02, strong >= 2, votes[4])) if on]
        return mask, sorted(hit) + [n + i for i in extra]


def _forms(text: str) -> set[str]:
    forms = set()
    for w in set(_WORD.findall(text.lower())):
        if len(w) >= 3:
            forms.add(w)
        forms.update(w[:k] + "*" for k in STEMS if len(w) > k)
    return forms


def mine(sample: DataFrame, text_col: str, label_col: str) -> list[str]:
    """The words and stems of the labelled sample that speak for label 1: in at least 1 % of its documents (8 at
    least), and the lower 95 % bound of the share of label 1 among the documents that have them is over 0.6; the
    surest first, ``MINED`` at most."""
    def count(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, y in zip(batch.column(text_col).to_pylist(), batch.column(label_col).to_pylist(), strict=True):
                for f in _forms(text or ""):
                    seen.setdefault(f, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                 pa.array([v[1] for v in seen.values()], pa.int64())], ["form", "n0", "n1"])

    positives = sample.where(F.col(label_col) == 1).count()
    counts = (sample.select(text_col, label_col).mapInArrow(count, "form string, n0 long, n1 long")
              .groupBy("form").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    n, z = F.col("n0") + F.col("n1"), 1.96
    p = F.col("n1") / n
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    good = counts.where(F.col("n1") >= max(8, positives // 100)).where(bound > 0.6)
    return [r.form for r in good.orderBy(F.desc(bound), "form").limit(MINED).collect()]


class LabelModel:
    """P(votes, label) with a tree of voter correlations for each label."""

    def __init__(self, prior: float = 0.1):
        self.prior = prior
        self.fallback = True  # until fitted: every voter speaks for label 1, independently
        self.parent = np.full((2, VOTERS), -1)
        self.rates = np.zeros((2, VOTERS, 2))  # P(fires | label, parent's vote)
        self.rates[0], self.rates[1] = 0.01, 0.3

    def fit(self, votes: np.ndarray, weights: np.ndarray, known: np.ndarray, rounds: int = 15) -> LabelModel:
        """``votes``: patterns by voter; ``weights``: their counts; ``known``: label 0 or 1, or -1."""
        hidden = known < 0
        weights = weights.astype(float)
        # all documents together weigh a fifth of the labelled ones, so that these keep the classes in place
        if hidden.any() and not hidden.all():
            weights[hidden] *= min(1.0, 0.2 * weights[~hidden].sum() / weights[hidden].sum())
        for k in range(rounds):
            post = np.where(hidden, self.posterior(votes), known)
            use = weights * ~hidden if k == 0 and (known == 1).any() and (known == 0).any() else weights
            self._maximise(votes, use, post)
        return self

    def _maximise(self, votes: np.ndarray, weights: np.ndarray, post: np.ndarray) -> None:
        v = votes.astype(float)
        self.prior = float(np.clip((weights * post).sum() / max(weights.sum(), 1e-9), 1e-3, 0.5))
        for y, share in enumerate((1 - post, post)):
            w = weights * share
            total = w.sum() + 2
            both = (v * w[:, None]).T @ v + 0.5          # both fire
            on = (v * w[:, None]).sum(axis=0) + 1        # one fires
            joint = np.stack([np.stack([total - on[:, None] - on[None] + both, on[None] - both]),
                              np.stack([on[:, None] - both, both])])  # [vote of i][vote of j]
            joint = np.maximum(joint, 1e-6) / total
            single = np.stack([1 - on / total, on / total])
            gain = (joint * np.log(joint / (single[:, None, :, None] * single[None, :, None, :]))).sum(axis=(0, 1))
            self.parent[y] = _tree(gain)
            for i, p in enumerate(self.parent[y]):
                for state in (0, 1):
                    self.rates[y, i, state] = (single[1, i] if p < 0 else
                                               joint[1, state, i, p] / max(joint[0, state, i, p] + joint[1, state, i, p], 1e-9))
        self.rates = np.clip(self.rates, 1e-4, 1 - 1e-4)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = []
        for y, base in enumerate((1 - self.prior, self.prior)):
            parents = np.where(self.parent[y] < 0, 0, votes[:, np.maximum(self.parent[y], 0)])
            p = self.rates[y][np.arange(VOTERS), parents]
            logs.append(math.log(base) + np.log(np.where(votes == 1, p, 1 - p)).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def _tree(gain: np.ndarray) -> np.ndarray:
    """Parents in the spanning tree of greatest total gain, rooted at voter 0 (-1)."""
    parent, best, inside = np.full(len(gain), -1), gain[0].copy(), np.zeros(len(gain), dtype=bool)
    link = np.zeros(len(gain), dtype=int)
    inside[0] = True
    for _ in range(len(gain) - 1):
        i = int(np.argmax(np.where(inside, -np.inf, best)))
        parent[i], inside[i] = link[i], True
        closer = gain[i] > best
        best[closer], link[closer] = gain[i][closer], i
    return parent


def _votes(masks) -> np.ndarray:
    return (np.asarray(masks, dtype=np.int64)[:, None] >> np.arange(VOTERS)) & 1


@dataclass
class ToxicityModel:
    features: Features
    weights: np.ndarray
    intercept: float
    labels: LabelModel

    def score(self, docs: DataFrame, text_col: str = "text", score_col: str = "score", drop: tuple[str, ...] = ()) -> DataFrame:
        """``docs`` with ``score_col`` (0 to 1); null and empty texts score as a text without words. A column of
        that name is replaced; ``drop`` names columns not to return."""
        features, weights, intercept = self.features, self.weights, self.intercept

        def start():
            def compute(batch):
                z = [intercept + weights[features.read(t or "")[1]].sum() for t in batch.column(text_col).to_pylist()]
                return {score_col: np.round(1 / (1 + np.exp(-np.clip(z, -500, 500))), 6).tolist()}

            return compute

        return map_batches(docs, start, [T.StructField(score_col, T.DoubleType())], drop)


def _patterns(docs: DataFrame, features: Features, text_col: str, *keep: str) -> DataFrame:
    """The vote pattern and feature numbers of every document; texts are not returned."""
    def start():
        def compute(batch):
            read = [features.read(t or "") for t in batch.column(text_col).to_pylist()]
            return {"mask": [m for m, _ in read], "hits": [h for _, h in read]}

        return compute

    return map_batches(docs.select(text_col, *keep), start, [
        T.StructField("mask", T.IntegerType()), T.StructField("hits", T.ArrayType(T.IntegerType()))], (text_col,))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        labelled: int = LABELLED, fitted: int = FITTED) -> ToxicityModel:
    """Learn from ``labels`` (id, 0 or 1) and the texts of ``docs``.

    At most about ``labelled`` labelled rows (chosen by a hash of the id) and ``fitted`` rows with posterior
    labels (by a hash of the text) are used for mining and for the classifier; vote patterns are counted over
    all documents (2 to the power of 16 patterns at most reach the driver). Labels other than 0 and 1, null
    ids and ids without a document are ignored; of differing labels for an id the larger one counts. Without
    labels of both kinds the fixed lexicons and patterns vote alone. An empty table gives a model that scores
    by its prior.
    """
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label")))
    total = known.count()
    part = F.xxhash64(id_col, F.lit("labelled")) <= F.lit(hash_cut(labelled / max(1, total)))
    chosen = known.where(part).select(F.col(id_col).alias("_key"), "_label")  # bounded by `labelled`
    sample = stage(docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_key")).select(
        F.col(text_col).alias("text"), "_label"), "labelled")
    features = Features(mine(sample, "text", "_label"))
    rows = docs.count()
    pick = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.lit("fitted")) <= F.lit(hash_cut(fitted / max(1, rows)))
    patterns = stage(_patterns(docs.select(F.col(text_col).alias("text"), pick.alias("picked")), features, "text", "picked")
                     .withColumn("hits", F.when(F.col("picked"), F.col("hits"))), "patterns")
    counts = patterns.groupBy("mask").count().collect()
    seen = _patterns(sample, features, "text", "_label").groupBy("mask", "_label").count().collect()
    masks = [r["mask"] for r in counts] + [r["mask"] for r in seen]
    model = LabelModel()
    if masks:
        model.fit(_votes(masks), np.array([r["count"] for r in counts] + [r["count"] for r in seen]),
                  np.array([-1] * len(counts) + [r["_label"] for r in seen]))
    post = {m: round(float(p), 6) for m, p in zip(masks, model.posterior(_votes(masks)), strict=True)} if masks else {}
    weights, intercept = _classifier(patterns.where("picked"), post, features.size)
    if weights is None:
        weights, intercept = np.zeros(features.size), math.log(model.prior / (1 - model.prior))
    return ToxicityModel(features, weights, intercept, model)


def _classifier(rows: DataFrame, post: dict[int, float], size: int):
    """Logistic regression on both labels of each row, weighted by the posterior; equal rows are one."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(m, float(y), p if y else 1 - p) for m, p in post.items() for y in (0, 1)],
                                  "mask int, label double, share double")
    grouped = rows.groupBy("mask", "hits").count()
    joined = grouped.join(table, "mask").withColumn("weight", F.col("share") * F.col("count")).where("weight > 1e-4")
    dense = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_contains("hits", i).cast("double"))
    data = stage(joined.select(dense.alias("x"), "label", "weight").orderBy("label", "weight", F.hash("x")), "posterior")
    if data.select("label").distinct().count() < 2:
        return None, 0.0
    data = data.coalesce(4).select(array_to_vector("x").alias("features"), "label", "weight")
    fitted = LogisticRegression(weightCol="weight", regParam=1e-6, maxIter=100, standardization=False).fit(data)
    return fitted.coefficients.toArray(), float(fitted.intercept)
