"""Scalable ordered statistics: cumulative counts, exact quantiles, ranks.

A window ``partitionBy(group).orderBy(value)`` puts a whole group into one
task; with three classes (or one global order) that is one task for a third
of the data or more.  These helpers use range partitioning instead:

1. pre-aggregate to distinct ``(group, value)`` with counts - hot values
   collapse to one row, so skew on a value cannot hurt;
2. deal them to ranges of ``(group, value)`` (``repartitionByRange``) and
   write them with the number of their range;
3. totals per (group, range), a small table, give each range's offset;
4. a window partitioned by ``(group, range)`` accumulates inside a range.

The result is exact: ranges only decide where work is split, and a row costs
the same however many ranges there are.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.columns import c, present
from strataflow.session import materialize


def _cols(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def _balanced_sum(terms: list[Column]) -> Column:
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def count_below(bounds: Column | list, n: int, v: Column, inclusive: bool = False) -> Column:
    """Number of the ``n`` sorted bounds below ``v`` (``<=`` if inclusive),
    as a sum of comparisons - for short lists of literals only."""
    items = bounds if isinstance(bounds, list) else [bounds[i] for i in range(n)]
    terms = [((b <= v) if inclusive else (b < v)).cast("int") for b in items]
    return _balanced_sum(terms) if terms else F.lit(0)


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the values of a ONE-row aggregate to every row as literals.

    The aggregate runs as its own small job and only its single row comes to
    the driver; the data side gets plain literal columns (no join).
    """
    row = one_row.first()
    cols = [F.lit(None if row is None else row[c]).cast(one_row.schema[c].dataType).alias(c)
            for c in one_row.columns]
    return df.select("*", *cols)


def fixed_sum(value: Column, n: Column | None = None, scale: int = 9) -> Column:
    """Sum (of ``n`` copies each) that does not depend on the order rows are added in.

    Values that are decimal numbers of ``scale`` digits after the point and 15 before it are added in fixed point; if
    any is not, all are added as doubles."""
    exact = value.try_cast(f"decimal({16 + scale},{scale})")
    fits = F.bool_and(F.coalesce(exact.cast("double") == value, value.isNull()))
    total = F.sum(exact if n is None else exact * n.cast("decimal(12,0)")).cast("double")
    return F.when(fits, total).otherwise(F.sum(value if n is None else value * n))


def column_counts(df: DataFrame, numeric: list[str], text: list[str] = ()) -> DataFrame:
    """``feature, num, text, n``: how often each value of each column occurs, missing ones (both null) included.

    ``numeric`` columns are counted as doubles (NaN is missing), ``text`` columns as strings.  Counted per Arrow batch
    first, so a batch hands on its different values and not a row for each cell."""
    cells = [present(df, x).cast("double").alias(f"n{i}") for i, x in enumerate(numeric)]
    cells += [c(x).cast("string").alias(f"t{i}") for i, x in enumerate(text)]
    names = [*numeric, *text]

    def count(batches):
        for batch in batches:
            parts = []
            for i, name in enumerate(names):
                seen = pc.value_counts(batch.column(i))
                values, n = seen.field("values"), seen.field("counts").cast(pa.int64())
                none = pa.nulls(len(values), pa.string() if i < len(numeric) else pa.float64())
                parts.append([pa.array([name] * len(values), pa.string()), *((values, none) if i < len(numeric) else (none, values)), n])
            if parts:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([col.cast(t) for col in cols]) for cols, t in zip(
                    zip(*parts, strict=True), (pa.string(), pa.float64(), pa.string(), pa.int64()), strict=True)],
                    ["feature", "num", "text", "n"])

    return (df.select(*cells).mapInArrow(count, "feature string, num double, text string, n long")
            .groupBy("feature", "num", "text").agg(F.sum("n").alias("n")))


def in_ranges(df: DataFrame, by: list[str], order: list[Column], ranges: int | None) -> DataFrame:
    """``df`` written in ranges of ``(by, order)``, each row with its range ``_part``."""
    dealt = [F.col(k) for k in by] + order
    dealt = df.repartitionByRange(ranges, *dealt) if ranges else df.repartitionByRange(*dealt)
    return materialize(dealt.withColumn("_part", F.spark_partition_id()))


def _offsets(ranged: DataFrame, by: list[str], weights: dict[str, Column]) -> DataFrame:
    """Per (group, range): each weight's sum ``_in_``, the sum of the ranges before ``_off_``, the group's ``_total``."""
    tot = ranged.groupBy(*by, "_part").agg(*[F.sum(w).alias(f"_in_{k}") for k, w in weights.items()])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)  # a row for each range
    return tot.select(*by, "_part", *[f"_in_{k}" for k in weights],
                      *[F.coalesce(F.sum(f"_in_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in weights],
                      *[F.sum(f"_in_{k}").over(whole).alias(f"{k}_total") for k in weights])


def _with_offsets(ranged: DataFrame, offsets: DataFrame, by: list[str]) -> DataFrame:
    keys = [*by, "_part"]
    named = offsets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[x for x in offsets.columns if x not in keys])
    same = F.lit(True)
    for k in keys:  # a null group is a group
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return ranged.join(named, same).drop(*[f"_k_{k}" for k in keys])


def _distinct(df: DataFrame, value: str, by: list[str], weights: dict[str, Column]) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(*[F.sum(w).alias(k) for k, w in weights.items()])


def value_counts_cumulative(df: DataFrame, value: str, by=(), weights: dict[str, Column] | None = None,
                            descending: bool = False, ranges: int | None = None) -> DataFrame:
    """Distinct values per group with cumulative sums in value order.

    Returns ``by..., value, <w>, <w>_cum, <w>_before, <w>_total`` for every
    weight ``w`` (default a single weight ``n`` = row count).  ``_cum`` is
    inclusive of the value; ``_before`` excludes it.  With
    ``descending=True`` the order is by value descending.
    """
    by = _cols(by)
    weights = weights or {"n": F.lit(1)}
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranged = in_ranges(_distinct(df, value, by, weights), by, [order], ranges)
    j = _with_offsets(ranged, _offsets(ranged, by, {k: F.col(k) for k in weights}), by)
    win = Window.partitionBy(*by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = j.select(*by, value, *weights, *[(F.col(f"_off_{k}") + F.sum(k).over(win)).alias(f"{k}_cum") for k in weights],
                   *[F.col(f"{k}_total") for k in weights])
    for k in weights:
        out = out.withColumn(f"{k}_before", F.col(f"{k}_cum") - F.col(k))
    return out


def exact_quantiles(df: DataFrame, value: str, qs: list[float], by=(), out: str = "q",
                    value_out: str = "value", ranges: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (same definition as SQL
    ``percentile`` / ``quantile_cont``) per group, without holding a group in
    one task.  Returns ``by..., q, value``."""
    by = _cols(by)
    ranged = in_ranges(_distinct(df, value, by, {"n": F.lit(1)}), by, [F.col(value)], ranges)
    return quantiles_of_counts(ranged, value, qs, by, out, value_out)


def quantiles_of_counts(ranged: DataFrame, value: str, qs: list[float], by: list[str], out: str = "q",
                        value_out: str = "value") -> DataFrame:
    """The quantiles of a table of :func:`in_ranges` of distinct values with counts ``n``; only the ranges that
    hold a wanted rank are sorted."""
    nq, q = F.col("n_total"), F.col(out)
    lo_c, hi_c = F.floor(q * (nq - 1)), F.ceil(q * (nq - 1))
    wanted = _offsets(ranged, by, {"n": F.col("n")}).withColumn(out, F.explode(F.array(*[F.lit(float(x)) for x in qs])))
    wanted = wanted.where((F.col("_off_n") <= hi_c) & (lo_c < F.col("_off_n") + F.col("_in_n")))
    at = Window.partitionBy(*by, out, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = _with_offsets(ranged, wanted, by).withColumn("_cum", F.col("_off_n") + F.sum("n").over(at))
    before = F.col("_cum") - F.col("n")
    agg = cum.groupBy(*by, out).agg(
        F.max(F.when((before <= lo_c) & (lo_c < F.col("_cum")), F.col(value))).alias("_xlo"),
        F.max(F.when((before <= hi_c) & (hi_c < F.col("_cum")), F.col(value))).alias("_xhi"),
        F.first("n_total").alias("_n"))
    frac = q * (F.col("_n") - 1) - F.floor(q * (F.col("_n") - 1))
    return agg.select(*by, out, (F.col("_xlo") + frac * (F.col("_xhi") - F.col("_xlo"))).alias(value_out))


def parts_of_counts(ranged: DataFrame, value: str, parts: int, by: list[str]) -> DataFrame:
    """``by..., value``: the values that end one of ``parts`` equal parts of a group's rows (the largest is one of them),
    or all values of a group that has fewer, from a table of :func:`in_ranges` of distinct values with counts ``n``."""
    offsets = _offsets(ranged, by, {"n": F.col("n"), "d": F.lit(1)})
    at = Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = _with_offsets(ranged, offsets, by).withColumn("_cum", F.col("_off_n") + F.sum("n").over(at))
    ends = F.expr(f"(_cum - n) * {parts} div n_total < _cum * {parts} div n_total")
    return cum.where(ends | (F.col("d_total") < parts)).select(*by, value)


def exact_median(df: DataFrame, value: str, by=(), value_out: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by, value_out=value_out).drop("q")


def hash_hex(purpose: str, key: Column, seed) -> Column:
    """Seeded pseudo-random order: ``md5(purpose | key | seed)`` in hex.

    Every operator names its own purpose: with one hash for all, a sample of a
    split would be drawn from the hashes that the split has left over.
    """
    return F.md5(F.concat(F.lit(f"{purpose}|"), key.cast("string"), F.lit(f"|{seed}")))


def global_rank(df: DataFrame, order: list[str] | str, by=(), out: str = "rank",
                ranges: int | None = None) -> DataFrame:
    """Exact ``row_number()`` over ``partitionBy(by).orderBy(*order)``, rows dealt to ranges of the order.

    The order has to tell rows apart: rows equal in all of it share a range."""
    by, keys = _cols(by), _cols(order)
    ranged = in_ranges(df, by, [F.col(k) for k in keys], ranges)
    j = _with_offsets(ranged, _offsets(ranged, by, {"n": F.lit(1)}), by)
    win = Window.partitionBy(*by, "_part").orderBy(*keys)
    return j.withColumn(out, (F.col("_off_n") + F.row_number().over(win)).cast("bigint")).select(*df.columns, out)


def key_at_rank(df: DataFrame, order: list[str], rank: int):
    """The values of ``order`` (the first numeric) of the row of that rank, counted from 1; nulls come first.

    Two scans, no sort of the table: approximate quantiles bracket the first column's value, then the rows inside
    the bracket alone are dealt to ranges and ranked.
    """
    first = F.col(order[0])
    rows = df.select(*order)
    n, n_null = rows.agg(F.count(F.lit(1)), F.count(F.when(first.isNull(), 1))).first()
    if not 1 <= rank <= n:
        return None
    if rank <= n_null:
        inside, below = rows.where(first.isNull()), 0
    else:
        share = (rank - n_null - 0.5) / (n - n_null)
        lo, hi = rows.agg(F.percentile_approx(first, [max(0.0, share - 2e-4), min(1.0, share + 2e-4)], 10_000)).first()[0]
        inside = materialize(rows.where(first.between(lo, hi)))
        below = rows.where(first.isNull() | (first < lo)).count()
        if not below < rank <= below + inside.count():  # the sketch erred by more than it says
            inside, below = rows.where(first.isNotNull()), n_null
    ranked = global_rank(inside, order, out="_rank")
    return ranked.where(F.col("_rank") == rank - below).first()[:len(order)]


DIGITS = 3     # hex digits counted at a time
SMALL = 1000   # rows whose hashes are read at last


def hash_cutoffs(df: DataFrame, group: str, hashed: Column, ranks_of) -> dict:
    """The hash of each wanted rank: ``{(group value, rank): hex}``.

    ``ranks_of`` gets the rows of each group and gives ``{group value: [rank, ...]}``, counted from 1 in order of the
    hash within the group.  One scan counts rows by group and leading hex digits, which gives the sizes and the
    prefix that holds each rank; a second one takes the rows with these prefixes (one in some thousand), which are
    written if they are many and searched digit by digit.  Nothing is sorted, and only counts (4096 for each group
    and cut) and a few hashes reach the driver.
    """
    rows = df.select(F.col(group).alias("_g"), hashed.alias("_h"))

    names: dict = {}  # each group value as Spark writes it

    def counted(own, digits):
        counts: dict = {}
        found = own.groupBy("_g", F.substring("_h", 1, digits).alias("p")).count()
        for r in found.withColumn("s", F.col("_g").cast("string")).collect():
            names[r["_g"]] = r["s"]
            counts.setdefault(r["_g"], []).append((r["p"], r["count"]))
        return {g: sorted(v) for g, v in counts.items()}

    def narrow(counts, wanted, depth):
        for key, (prefix, left, _) in wanted.items():
            for p, n in counts[key[0]]:
                if p[:depth] == prefix:
                    if left <= n:
                        wanted[key] = (p, left, n)
                        break
                    left -= n

    counts, depth = counted(rows, DIGITS), DIGITS
    ranks = ranks_of({g: sum(n for _, n in v) for g, v in counts.items()})
    wanted = {(g, r): ("", r, None) for g, rs in ranks.items() for r in rs if r > 0}  # prefix, rank inside, rows
    narrow(counts, wanted, 0)
    written = False
    while wanted and any(len(p) < 32 for p, _, _ in wanted.values()):
        # one test of the hash a row: pushed below the projection, every mention of it would be computed again
        named = F.concat(F.substring("_h", 1, depth), F.coalesce(F.concat(F.lit("="), F.col("_g").cast("string")), F.lit("")))
        inside = named.isin(*{p + ("" if g is None else f"={names[g]}") for (g, _), (p, _, _) in wanted.items()})
        last = max(n for _, _, n in wanted.values()) <= SMALL
        if not last and not written:
            rows, written = materialize(rows.where(inside)), True
        digits = 32 if last else min(32, depth + DIGITS)
        narrow(counted(rows.where(inside), digits), wanted, depth)
        depth = digits
    return {key: p for key, (p, _, _) in wanted.items()}
