"""Command line: python -m panelspark {list|run|explain|check} ...

  list                         query keys
  run KEY [--sf DIR] [--show N]  run a key over the tables in DIR, print N rows
  explain KEY [--sf DIR]       formatted physical plan
  check [--sf DIR] [KEY ...]   compare keys with their DuckDB SQL
"""

from __future__ import annotations

import argparse

DEFAULT_SF = "/root/testdata/sf0.01"


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="panelspark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("key")
    r.add_argument("--sf", default=DEFAULT_SF)
    r.add_argument("--show", type=int, default=20)
    e = sub.add_parser("explain")
    e.add_argument("key")
    e.add_argument("--sf", default=DEFAULT_SF)
    c = sub.add_parser("check")
    c.add_argument("keys", nargs="*")
    c.add_argument("--sf", default=DEFAULT_SF)
    args = ap.parse_args(argv)

    from panelspark.queries import QUERIES
    if args.cmd == "list":
        print("\n".join(QUERIES))
        return 0
    from panelspark.session import build_session
    spark = build_session("local[*]")
    try:
        if args.cmd == "run":
            QUERIES[args.key](spark, args.sf).show(args.show, truncate=60)
        elif args.cmd == "explain":
            QUERIES[args.key](spark, args.sf).explain("formatted")
        else:
            from panelspark.oracle import compare
            bad = compare(spark, args.sf, args.keys)
            print("mismatches:", bad)
            return 1 if bad else 0
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
