"""Contract-based data quality.

A contract list becomes a rule suite (C1).  The whole suite is evaluated in a
single aggregate over the table: every rule contributes two conditional
counts, the counts of all rules land in one array of structs, and one
``explode`` turns it into one row per rule.  Spark plans this as one partial
+ final hash aggregate: the data is scanned once, whatever the rule count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import ColumnContract, contracts_from_dict


@dataclass(frozen=True)
class Rule:
    rule_id: int
    column: str
    kind: str          # not_null | between | in_set
    mostly: float
    min: float | None = None
    max: float | None = None
    values: tuple | None = None
    sentinels: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind} [{self.column}]"


RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.LongType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("mostly", T.DoubleType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("value_set", T.StringType()),
    T.StructField("sentinels", T.StringType()),
])


def build_suite(contracts: list[ColumnContract] | dict) -> list[Rule]:
    """Not-null always; range when min or max; in-set when allowed values.

    Range rules with sentinels exclude sentinel rows and use ``mostly``;
    range rules without sentinels are strict (``mostly`` = 1).
    """
    if isinstance(contracts, dict):
        contracts = contracts_from_dict(contracts)
    rules: list[Rule] = []
    for c in contracts:
        rules.append(Rule(len(rules) + 1, c.column, "not_null", c.mostly))
        if c.min is not None or c.max is not None:
            mostly = c.mostly if c.sentinel_values else 1.0
            rules.append(Rule(len(rules) + 1, c.column, "between", mostly,
                              c.min, c.max, None, tuple(c.sentinel_values)))
        if c.allowed_values is not None:
            rules.append(Rule(len(rules) + 1, c.column, "in_set", c.mostly,
                              values=tuple(c.allowed_values)))
    return rules


def suite_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rule suite as a small table (the persisted form of the suite)."""
    rows = [(r.rule_id, r.column, r.kind, float(r.mostly),
             None if r.min is None else float(r.min), None if r.max is None else float(r.max),
             None if r.values is None else "|".join(map(str, r.values)),
             "|".join(map(str, r.sentinels)) if r.sentinels else None) for r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _lit_like(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit(str(value))
    return F.lit(value)


def _rule_counts(rule: Rule, schema: T.StructType) -> tuple[Column, Column]:
    """(checked, ok) conditional-count expressions for one rule."""
    c = F.col(f"`{rule.column}`")
    dtype = schema[rule.column].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)  # NaN is missing
    if rule.kind == "not_null":
        return F.count(F.lit(1)), F.count(c)
    if rule.kind == "between":
        cond = c.isNotNull()
        for s in rule.sentinels:
            cond = cond & (c != _lit_like(s, dtype))
        ok = cond
        if rule.min is not None:
            ok = ok & (c >= F.lit(rule.min))
        if rule.max is not None:
            ok = ok & (c <= F.lit(rule.max))
        return F.count(F.when(cond, 1)), F.count(F.when(ok, 1))
    if rule.kind == "in_set":
        vals = [_lit_like(v, dtype) for v in rule.values]
        return F.count(c), F.count(F.when(c.isin(*vals), 1))
    raise ValueError(f"unknown rule kind {rule.kind}")


def expect_not_null(df: DataFrame, column: str, mostly: float = 1.0) -> DataFrame:
    """C2 as a one-rule suite."""
    return run_rules(df, [Rule(1, column, "not_null", mostly)])


def expect_between(df: DataFrame, column: str, lo=None, hi=None, mostly: float = 1.0,
                   sentinels: tuple = ()) -> DataFrame:
    """C3 as a one-rule suite."""
    return run_rules(df, [Rule(1, column, "between", mostly, lo, hi, None, tuple(sentinels))])


def expect_in_set(df: DataFrame, column: str, values, mostly: float = 1.0) -> DataFrame:
    """C4 as a one-rule suite."""
    return run_rules(df, [Rule(1, column, "in_set", mostly, values=tuple(values))])


def suite_counts(rules: list[Rule], schema: T.StructType) -> Column:
    """The counts of all rules over a table of this schema, as one aggregate; may be used for many tables."""
    structs = []
    for r in rules:
        checked, ok = _rule_counts(r, schema)
        structs.append(F.struct(
            F.lit(r.rule_id).cast("bigint").alias("rule_id"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.kind).alias("rule"),
            F.lit(float(r.mostly)).alias("mostly"),
            checked.alias("n_checked"),
            ok.alias("n_ok"),
        ))
    return F.array(*structs)


def suite_results() -> list[Column]:
    """The result columns of a rule from its counts."""
    share = F.when(F.col("n_checked") > 0, F.col("n_ok") / F.col("n_checked"))
    return [*map(F.col, ("rule_id", "column_name", "rule", "mostly", "n_checked", "n_ok")),
            F.round(share, 6).alias("ok_share"),
            F.coalesce(share >= F.col("mostly"), F.lit(True)).alias("success")]


def run_rules(df: DataFrame, rules: list[Rule], counts: Column | None = None, results: list[Column] | None = None) -> DataFrame:
    """Evaluate every rule in ONE aggregate; return one row per rule.

    Columns: rule_id, column_name, rule, mostly, n_checked, n_ok, ok_share,
    success.  A rule with nothing to check passes.  ``counts`` and ``results``
    are those of the suite, when the caller has built them before.
    """
    counts = suite_counts(rules, df.schema) if counts is None else counts
    found = df.agg(counts.alias("r")).select(F.explode("r").alias("r")).select("r.*")
    return found.select(*(results or suite_results()))


class ValidationError(RuntimeError):
    pass


def pre_validate(df: DataFrame, rules: list[Rule]) -> None:
    """Raise when rule columns are missing (a metadata check, no job)."""
    missing = sorted({r.column for r in rules} - set(df.columns))
    if missing:
        raise ValidationError(f"missing columns for suite: {missing}")


def validate_table(df: DataFrame, contracts, check_empty: bool = True) -> DataFrame:
    """Run the suite after the pre-checks.

    The emptiness check is folded into the same aggregate (``n_checked`` of a
    not-null rule is the row count) so no separate ``count()`` job runs; an
    empty table raises when the result is inspected via :func:`assert_valid`.
    """
    rules = build_suite(contracts)
    pre_validate(df, rules)
    return run_rules(df, rules)


def suite_summary(rule_results: DataFrame) -> DataFrame:
    """One row: overall success, number of rules, failed rules as ``rule [column]``."""
    return rule_results.agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("n_rules"),
        F.count(F.when(~F.col("success"), 1)).alias("n_failed"),
        F.array_sort(F.collect_list(F.when(~F.col("success"),
                                           F.concat(F.col("rule"), F.lit(" ["), F.col("column_name"), F.lit("]"))))
                     ).alias("failed_rules"),
        F.max("n_checked").alias("n_rows"),
    )


def assert_valid(rule_results: DataFrame) -> dict:
    """Gate: raise ``ValidationError`` on an empty table or any failed rule.

    Brings only the one-row summary to the driver.
    """
    row = suite_summary(rule_results).first()
    if row is None or not row["n_rows"]:
        raise ValidationError("table is empty: validation would pass on 0 rows")
    if not row["success"]:
        raise ValidationError(f"validation failed: {list(row['failed_rules'])}")
    return row.asDict()
