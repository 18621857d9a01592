"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import map_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# digits are taken whole: a run that fails from its start fails from inside, too
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
# fewer than 13 digits never pass
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

PRIOR = {"email": 0.85, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
NEAR = 40  # code points looked at on either side
RAISE = {
    "email": ("mail", "contact", "write", "reach", "@"), "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "amex", "mastercard"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "bank", "account", "transfer", "konto"), "ssn": ("ssn", "social", "security", "taxpayer"),
}
LOWER = {
    "email": ("example", "noreply"), "ip": ("version", "release", "build", "localhost"),
    "card": ("isbn", "order", "tracking", "serial"), "phone": ("isbn", "version", "order"),
    "iban": (), "ssn": ("part", "model", "serial", "isbn"),
}
STEP = 0.15


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        # greedy runs may take in a following word: the longest end that passes counts
        for end in range(m.end(), m.start() + 14, -1):
            body = text[m.start():end].replace(" ", "")
            if text[end - 1] != " " and not text[end:end + 1].isalnum() and len(body) >= 15 and mod97(body):
                yield m.start(), end
                break


def find(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` in code points, ends exclusive, by kind as in ``KINDS``, then start."""
    spans = [("email", *x) for x in _emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    spans += [("card", *m.span()) for m in _CARD.finditer(text) if len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    spans += [("iban", *x) for x in _ibans(text)]
    spans += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    scored = [(k, s, e, score(text, k, s, e)) for k, s, e in spans]
    # a bare ddd-dd-dddd counts only with a word that speaks for it
    return [x for x in scored if x[0] in BASE or x[3] >= 0.5]


def score(text: str, kind: str, start: int, end: int) -> float:
    around = (text[max(0, start - NEAR):start] + " " + text[end:end + NEAR]).lower()
    s = PRIOR[kind] + STEP * any(w in around for w in RAISE[kind]) - STEP * any(w in around for w in LOWER[kind])
    return round(min(1.0, max(0.0, s)), 6)


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Overlapping spans become one placeholder, named by the first (of equal starts: the longest)."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_pii(docs: DataFrame, text_col: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``pii`` (array of kind, start, end, score in code points), over whole texts.

    Kinds: email, ip, card (Luhn), phone, and, confirmed by mod-97 or by words nearby, iban and ssn.
    Within a kind spans do not overlap; they are sorted by kind as listed, then start. Null and empty texts
    have none. A column ``pii`` is replaced; ``drop`` names columns not to return.
    """
    def start():
        def compute(batch):
            found = [find(t) if t else [] for t in batch.column(text_col).to_pylist()]
            return {"pii": [[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in f] for f in found]}

        return compute

    return map_batches(docs, start, [T.StructField("pii", SPAN)], drop)


def redact_pii(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = None,
               min_score: float = 0.0) -> DataFrame:
    """``docs`` with each span scoring ``min_score`` or more replaced by ``[KIND]``; all rows and columns stay.

    ``n_chars_col`` names a column that gets the new length in code points. A null text stays null.
    """
    def start():
        def compute(batch):
            texts = batch.column(text_col).to_pylist()
            return {text_col: [t and redact(t, [x for x in find(t) if x[3] >= min_score]) for t in texts]}

        return compute

    order = docs.columns
    out = map_batches(docs, start, [T.StructField(text_col, T.StringType())])
    if n_chars_col:
        out = out.withColumn(n_chars_col, F.char_length(text_col).cast(docs.schema[n_chars_col].dataType))
    return out.select(*order)


def with_digest(found: DataFrame) -> DataFrame:
    """``n_<kind>`` of the four base kinds, ``base_sha256`` and ``spans`` from ``pii``."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(*kinds):
        return F.filter("pii", lambda x: x["kind"].isin(*kinds))

    base = of(*BASE)
    counts = {f"n_{k}": F.size(of(k)).cast("long") for k in BASE}
    return found.withColumns({**counts, "base_sha256": F.sha2(joined(base), 256), "spans": joined(F.col("pii"))})
