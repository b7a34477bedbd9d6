"""Command line: list, run or explain registered queries.

    python -m presslens list
    python -m presslens run domain_concentration_cr3 --input /data/tables --output /data/out/cr3
    python -m presslens run top_keywords --input /data/tables --show 20
    python -m presslens explain clean_articles --input /data/tables

``--input`` is a folder with one parquet file per input table. On a cluster,
submit this module with spark-submit; the session's own configuration
(master, spark.checkpoint.dir, ...) is used as given.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="presslens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("--input", required=True, help="folder with <table>.parquet files")
        if name == "run":
            p.add_argument("--output", help="write the result as parquet here")
            p.add_argument("--show", type=int, default=0, help="print the first N rows")
    args = ap.parse_args(argv)

    from presslens.plans.registry import load_all

    reg = load_all()
    if args.cmd == "list":
        for name, q in sorted(reg.items()):
            oracle = "sql" if q.oracle else "rows"
            print(f"{name:28s} {','.join(q.ids):24s} {oracle:4s} {q.doc.splitlines()[0] if q.doc else ''}")
        return 0
    if args.query not in reg:
        print(f"unknown query {args.query!r}; see `python -m presslens list`", file=sys.stderr)
        return 2

    from pyspark.sql import SparkSession

    from presslens.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName(f"presslens-{args.query}").getOrCreate()
    ensure_checkpoint_dir(spark)
    df = reg[args.query].build(spark, args.input)
    if args.cmd == "explain":
        df.explain("formatted")
        return 0
    if args.output:
        df.write.mode("overwrite").parquet(args.output)
    if args.show:
        df.show(args.show, truncate=80)
    if not args.output and not args.show:
        print(df.count())
    return 0


if __name__ == "__main__":
    sys.exit(main())
