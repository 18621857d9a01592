import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))
                    or kind == "card" and (not 13 <= len(digits) <= 19 or sum(doubled) % 10)
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((kind, *m.span()))
    return out


pieces = st.sampled_from(["a", "@", ".", "-", "+", "1", "25", "4111 1111 1111 1111", "4111-1111-1111-1112", " ", "x@y.z", "é",
                          "10.0.0.1", "300.1.1.1", "+49 (30) 1234-5678", "..", "@@", "0004111111111111111", "%_", "1.2.3"])


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=14))
def test_base_spans_equal_the_plain_patterns(parts):
    text = "".join(parts)
    assert [(k, s, e) for k, s, e, _ in pii.find(text) if k in pii.BASE] == plain(text)


def test_checksums_and_context():
    kinds = lambda t: [(k, t[s:e]) for k, s, e, _ in pii.find(t)]
    assert kinds("iban DE89 3704 0044 0532 0130 00 please") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("iban DE88 3704 0044 0532 0130 00 please") == []
    assert kinds("my ssn is 123-45-6789.") == [("ssn", "123-45-6789")]
    assert kinds("part 123-45-6789.") == [] and kinds("ssn 666-45-6789") == []
    near, far = pii.find("call +49 30 1234567")[0][3], pii.find("code +49 30 1234567")[0][3]
    assert near > far
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_hostile_texts_are_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "1." * 100_000, "+1" * 50_000, "1-" * 100_000, "AB12" * 50_000):
        pii.find(text)


def test_redaction():
    text = "é mail a@b.com or 4111 1111 1111 1111!"
    assert pii.redact(text, pii.find(text)) == "é mail [EMAIL] or [CARD]!"


def test_digest_and_messy(spark, messy, no_docs):
    rows = [(1, "x a@b.co 1.2.3.4 " + "\U0001F600" + " +4930123456789"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pii", F.lit("old"))
    got = {r.doc_id: r for r in pii.with_digest(pii.find_pii(df)).collect()}
    for i, text in rows:
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in plain(text or ""))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest() and got[i].spans == want
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 0, 1)
    assert pii.find_pii(messy).count() == messy.count() and pii.find_pii(no_docs).count() == 0
    out = pii.redact_pii(df.withColumn("n_chars", F.lit(0)), n_chars_col="n_chars")
    assert out.columns == [*df.columns, "n_chars"]
    assert {r.doc_id: r.text for r in out.collect()}[2] is None
    assert pii.redact_pii(messy).exceptAll(messy).count() == 0
