"""Run every query key on Spark and its oracle SQL on DuckDB; compare row
counts, column names and values (order-insensitive).

usage: python tools/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelspark.oracle import compare  # noqa: E402,F401


def main():
    from panelspark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    bad = compare(spark, sf, sys.argv[2:])
    print("mismatches:", len(bad), bad)
    spark.stop()


if __name__ == "__main__":
    main()
