"""Benchmark of the headline queries.

Runs each query over the whole tables of $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line.
Each query is executed to completion with the no-op sink (every row is
produced, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from launchboard.plans import catalog  # noqa: E402
from launchboard.plans import scorecard as S  # noqa: E402
from launchboard.plans.session import build_session, checkpoint_dir  # noqa: E402

HEADLINE = ("fact_enriched", "order_rank", "order_pieces", "kpi_launch_window",
            "kpi_launch_week", "benchmark_all", "scorecard_8w", "scorecard_week")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="launchboard-bench-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g"),
                                 "spark.local.dir": scratch})
    checkpoint_dir(spark)
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(HEADLINE)
    # warm-up: JIT and file listing, not timed
    run(catalog.QUERIES["dim_product"](spark, sf_dir))
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    # both dashboard tables in one job run, sharing the checkpointed order-level relations
    if not only:
        t0 = time.perf_counter()
        run_id = "bench-refresh"
        p = S.prepare(catalog._inputs(spark, sf_dir), materialize=True, run_id=run_id)
        p = S.share_kpi_state(p, run_id)
        run(S.scorecard_8w(p))
        run(S.scorecard_week(p))
        times["refresh_both_tables"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
