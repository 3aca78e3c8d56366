"""Benchmark: the whole flow at $BENCH_SF_DIR on local[$BENCH_CPUS].

Runs ``quire.plans.workflow.run`` and times each stage: ingest (fixture tables
written once, as the reference loads its dump), clean (rule tagging, CSV export),
profile (before/after report), prepare (index + centre), sparsity, splits (5
random folds written), train (5 ALS fits, models saved), cross_eval (25 model x
test-set evaluations in one job), baseline_eval (item-mean cross-evaluation),
recommend_250x2 (the reference's 2 x 250-user top-10 lists), recommend_all_users
(top-10 lines for every user), package (per-user RMSE, model report, manifest).
Every stage ends in a distributed write. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans.workflow import run  # noqa: E402
from quire.session import build_session  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="quire-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="quire-bench",
        shuffle_partitions=int(cpus) * 2,
        driver_memory="16g",
        extra={
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": scratch,
        },
    )
    times: dict[str, float] = {}

    def timer(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    run(spark, sf_dir, f"{scratch}/out", timer=timer)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf_value: float | str = float(sf)
    except ValueError:
        sf_value = sf
    print(json.dumps({"metric": "end_to_end_sec", "value": total, "unit": "sec", "queries": times, "sf": sf_value}))
    spark.stop()


if __name__ == "__main__":
    main()
