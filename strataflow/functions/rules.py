"""Decision rules over probability arrays (K1-K4) as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def probs_array(*cols: str) -> Column:
    return F.array(*[F.col(x).cast("double") for x in cols])


def predict_argmax(probs: Column) -> Column:
    """K1: index of the largest probability, ties -> lowest class."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def predict_threshold(probs: Column, tau: float | Column, minority: int = 2, n_classes: int | None = 3) -> Column:
    """K2: minority when ``p[minority] >= tau``, else the argmax of the
    other classes (ties -> lowest).  With ``n_classes`` known the masking is
    plain element access (generated code) instead of a lambda."""
    t = tau if isinstance(tau, Column) else F.lit(float(tau))
    p_min = probs[minority]
    if n_classes:
        others = F.array(*[F.lit(-1.0) if i == minority else probs[i] for i in range(n_classes)])
    else:
        others = F.transform(probs, lambda p, i: F.when(i == minority, F.lit(-1.0)).otherwise(p))
    return F.when(p_min >= t, F.lit(minority)).otherwise(predict_argmax(others)).cast("int")


def softmax(logits: Column) -> Column:
    """K4: max-shifted softmax of a logit / log-posterior array."""
    m = F.array_max(logits)
    ex = F.transform(logits, lambda v: F.exp(v - m))
    s = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(ex, lambda v: v / s)
