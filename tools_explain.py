"""Print the executed plan of registered queries (after running them, so AQE's final plan shows).

Usage: python tools_explain.py [sf_dir] name [name ...]
"""

import sys

from venue_analytics.plans.registry import QUERIES
from venue_analytics.session import get_spark


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    for name in args or sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        df.collect()  # run on the DataFrame's own execution so its adaptive plan is final
        print(f"===== {name}")
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main()
