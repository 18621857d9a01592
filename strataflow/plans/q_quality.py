"""Catalog entries for data quality (C2-C6) on the ``records`` view."""

from __future__ import annotations

from strataflow.config import RECORDS_CONTRACT
from strataflow.operators import quality as Q
from strataflow.plans.catalog import register
from strataflow.sources.tables import tables


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def rules_sql(rules: list[Q.Rule], table: str = "records") -> str:
    """Oracle: one SELECT per rule, UNION ALL (deliberately not one pass)."""
    parts = []
    for r in rules:
        c = r.column
        if r.kind == "not_null":
            checked, ok = "count(*)", f"count({c})"
        elif r.kind == "between":
            cond = " AND ".join([f"{c} IS NOT NULL"] + [f"{c} <> {_sql_lit(s)}" for s in r.sentinels])
            rng = []
            if r.min is not None:
                rng.append(f"{c} >= {r.min!r}")
            if r.max is not None:
                rng.append(f"{c} <= {r.max!r}")
            checked = f"count(*) FILTER (WHERE {cond})"
            ok = f"count(*) FILTER (WHERE {' AND '.join([cond] + rng)})"
        else:
            vals = ", ".join(_sql_lit(v) for v in r.values)
            checked, ok = f"count({c})", f"count(*) FILTER (WHERE {c} IN ({vals}))"
        parts.append(
            f"SELECT {r.rule_id}::BIGINT AS rule_id, '{c}' AS column_name, '{r.kind}' AS rule, "
            f"{float(r.mostly)!r}::DOUBLE AS mostly, {checked} AS n_checked, {ok} AS n_ok FROM {table}")
    return ("SELECT *, round(CASE WHEN n_checked > 0 THEN n_ok / n_checked END, 6) AS ok_share, "
            "coalesce(n_ok / nullif(n_checked, 0) >= mostly, true) AS success FROM (\n"
            + "\nUNION ALL\n".join(parts) + "\n) t")


_RULES = Q.build_suite(RECORDS_CONTRACT)


@register("validate_table", rules_sql(_RULES))
def q_validate_table(spark, sf_dir):
    return Q.validate_table(tables(spark, sf_dir).records(), RECORDS_CONTRACT)


@register("validate_summary", """
SELECT bool_and(success) AS success, count(*) AS n_rules, count(*) FILTER (WHERE NOT success) AS n_failed,
       list_sort(list(rule || ' [' || column_name || ']') FILTER (WHERE NOT success)) AS failed_rules,
       max(n_checked) AS n_rows
FROM (""" + rules_sql(_RULES) + ") r")
def q_validate_summary(spark, sf_dir):
    return Q.suite_summary(Q.validate_table(tables(spark, sf_dir).records(), RECORDS_CONTRACT))


@register("expect_not_null", rules_sql([Q.Rule(1, "driver_age", "not_null", 0.85)]))
def q_expect_not_null(spark, sf_dir):
    return Q.expect_not_null(tables(spark, sf_dir).records(), "driver_age", 0.85)


@register("expect_between", rules_sql([Q.Rule(1, "hour", "between", 0.996, 0, 23, None, (99,))]))
def q_expect_between(spark, sf_dir):
    return Q.expect_between(tables(spark, sf_dir).records(), "hour", 0, 23, 0.996, sentinels=(99,))


@register("expect_in_set", rules_sql([Q.Rule(1, "weather", "in_set", 1.0, values=("A", "N", "R"))]))
def q_expect_in_set(spark, sf_dir):
    return Q.expect_in_set(tables(spark, sf_dir).records(), "weather", ["A", "N", "R"], 1.0)
