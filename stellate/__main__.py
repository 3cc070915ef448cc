"""Command line: run the whole load, or one registered query.

    python -m stellate star  --data /path/to/tables [--root /shared/warehouse]
    python -m stellate query fact_order_lines --data /path/to/tables [--out /shared/out/fact]
    python -m stellate list

Under spark-submit the cluster's master and settings apply; ``--master``
is for local runs only.
"""

from __future__ import annotations

import argparse
import json
import sys

from stellate.session import get_spark


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="stellate")
    p.add_argument("--master", default=None, help="local runs only, e.g. local[8]")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("star", help="load and publish calendar, dimensions, bridge and fact")
    s.add_argument("--data", required=True, help="folder holding the source tables as <name>.parquet")
    s.add_argument("--root", default=None, help="warehouse root (default: stellate.warehouse.dir / checkpoint dir)")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--out", default=None, help="write the result as parquet here (default: print 20 rows)")
    sub.add_parser("list", help="list registered queries")
    args = p.parse_args(argv)

    from stellate.plans.queries import QUERIES
    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = get_spark(args.master)
    if args.cmd == "star":
        from stellate.plans import pipeline
        snaps = pipeline.run_star(spark, args.data, args.root)
        print(json.dumps(snaps, indent=2))
    else:
        df = QUERIES[args.name](spark, args.data)
        if args.out:
            df.write.mode("errorifexists").parquet(args.out)
        else:
            df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
