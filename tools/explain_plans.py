"""Print the formatted physical plan of registered queries.

Usage: python tools/explain_plans.py [sf_dir] name [name ...]
Used to check scan pruning (ReadSchema), pushed filters, broadcast choices
and exchange counts of the headline queries.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from strataflow.plans.catalog import queries  # noqa: E402
from strataflow.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs = queries()
    for n in names:
        df = qs[n](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"===== {n}: exchanges={plan.count('Exchange')} broadcasts={plan.count('BroadcastExchange')}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
