"""Command line: run the whole flow over a folder of driver tables.

    python -m quire run --input /root/testdata/sf0.1 --out /shared/quire-out

On a cluster, submit with the cluster's session settings; ``spark.checkpoint.dir``
must name a shared folder.
"""

from __future__ import annotations

import argparse
import json

from quire.plans.workflow import run
from quire.session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quire")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="ingest, clean, profile, train, evaluate, recommend")
    r.add_argument("--input", required=True, help="folder with the Parquet tables")
    r.add_argument("--out", required=True, help="shared output folder")
    r.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    r.add_argument("--folds", type=int, default=5)
    r.add_argument("--seed", type=int, default=42)
    r.add_argument("--users", type=int, default=250, help="sampled users per method")
    r.add_argument("--k", type=int, default=10, help="list length")
    args = parser.parse_args(argv)

    if args.master:
        spark = build_session(args.master)
    else:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("quire").getOrCreate()
    manifest = run(spark, args.input, args.out, k=args.folds, seed=args.seed, n_users=args.users, top_k=args.k)
    print(json.dumps(manifest, indent=1, sort_keys=True))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
