"""Run driver queries as batch jobs: ``python -m tidemart.cli run <query> --tables DIR --out PATH``.

Used with spark-submit on a cluster (the master comes from spark-submit). The
result is written as parquet (or json/csv) with overwrite, so a rerun after a
failure replaces the output. ``--input-bytes`` sizes shuffle partitions via
:func:`tidemart.session.cluster_conf`.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemart")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered queries")
    r = sub.add_parser("run", help="run one query and write its result")
    r.add_argument("query")
    r.add_argument("--tables", required=True, help="folder with <table>.parquet inputs")
    r.add_argument("--out", required=True, help="output path")
    r.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    r.add_argument("--input-bytes", type=int, default=0, help="input volume, to size shuffle partitions")
    r.add_argument("--cores", type=int, default=0, help="total executor cores (default: from the session)")
    args = p.parse_args(argv)

    from tidemart.plans import ORACLE, QUERIES

    if args.cmd == "list":
        for name in QUERIES:
            print(f"{name}\t{'oracle' if name in ORACLE else 'rows-only'}")
        return 0

    spark = SparkSession.builder.appName(f"tidemart-{args.query}").getOrCreate()
    if args.input_bytes:
        from tidemart.session import cluster_conf

        cores = args.cores or spark.sparkContext.defaultParallelism
        for k, v in cluster_conf(args.input_bytes, cores).items():
            if spark.conf.isModifiable(k):
                spark.conf.set(k, v)
            else:  # static settings only count at start-up
                print(f"pass --conf {k}={v} to spark-submit", file=sys.stderr)
    t0 = time.time()
    df = QUERIES[args.query](spark, args.tables)
    df.write.mode("overwrite").format(args.format).save(args.out)
    print(json.dumps({"query": args.query, "out": args.out, "seconds": round(time.time() - t0, 3)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
