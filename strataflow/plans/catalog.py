"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame``.

A query may carry an equivalent DuckDB SQL text (the oracle).  The SQL text
gets the stand-in view definitions prepended as a ``WITH`` clause.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.sources.tables import oracle_prelude

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "strataflow.plans.q_quality",
    "strataflow.plans.q_io",
    "strataflow.plans.q_columns",
    "strataflow.plans.q_profile",
    "strataflow.plans.q_sampling",
    "strataflow.plans.q_features",
    "strataflow.plans.q_imbalance",
    "strataflow.plans.q_rules_metrics",
    "strataflow.plans.q_ledger",
    "strataflow.plans.q_stats",
    "strataflow.plans.q_neighbours",
    "strataflow.plans.q_audit",
    "strataflow.plans.q_fixed",
    "strataflow.plans.q_fitted",
    "strataflow.plans.q_dependence",
    "strataflow.plans.q_streaming",
)


def positive_zero_rounds(sql: str) -> str:
    """Rewrite every ``round(...)`` as ``(round(...) + 0.0)``.

    DuckDB rounds tiny negatives to -0.0 where Spark gives 0.0; adding +0.0
    turns -0.0 into 0.0 (IEEE) and changes nothing else.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = positive_zero_rounds(sql[j + 6:k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL) to the catalog."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            body = positive_zero_rounds(sql.strip())
            if body[:4].upper() == "WITH":
                ORACLE[name] = oracle_prelude() + "," + body[4:]
            else:
                ORACLE[name] = oracle_prelude() + body
        return fn

    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != m:
                raise


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
