"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares column names, row counts and an order-insensitive multiset of rows
with floats rounded to 6 decimals.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from strataflow.session import get_spark  # noqa: E402
from strataflow.sources.tables import BASE_TABLES  # noqa: E402
from strataflow.plans.catalog import queries, oracle_sql  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0:
            return repr(v)  # strict: -0.0 and 0.0 hash differently in a value hash
        return repr(round(v, 5))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def rows_of(cols, records):
    return Counter(tuple(norm(r[c]) for c in cols) for r in records)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    names = names or sorted(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = qs[n](spark, sf_dir)
            srows = [r.asDict(recursive=True) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if n not in sqls:
            print(f"rows {n}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[n])
            ocols = [d[0] for d in cur.description]
            orows = [dict(zip(ocols, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(ocols):
            print(f"FAIL {n}: columns spark={sorted(scols)} oracle={sorted(ocols)}")
            bad += 1
            continue
        tmap = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                "smallint": "SMALLINT", "tinyint": "TINYINT"}

        def st(t):
            if t.startswith("array<"):
                return st(t[6:-1]) + "[]"
            return tmap.get(t, t)
        stypes = dict((k, st(v)) for k, v in sdf.dtypes)
        otypes = dict((d[0], str(d[1])) for d in cur.description)
        tdiff = {k: (stypes[k], otypes[k]) for k in stypes if stypes[k] != otypes.get(k)}
        if tdiff:
            print(f"WARN {n}: types differ {tdiff}")
        cols = sorted(scols)
        a, b = rows_of(cols, srows), rows_of(cols, orows)
        if len(srows) != len(orows) or a != b:
            print(f"FAIL {n}: rows spark={len(srows)} oracle={len(orows)}")
            print("   spark-only:", list((a - b).items())[:3])
            print("   oracle-only:", list((b - a).items())[:3])
            bad += 1
        else:
            print(f"ok   {n}: {len(srows)} rows {ts:.1f}s")
    print(f"{len(names) - bad}/{len(names)} passed")


if __name__ == "__main__":
    main()
