"""The refresh job: both dashboard tables from the eight inputs.

    spark-submit -m launchboard.plans.refresh \\
        --input order_line=db.order_lines --input member=db.members ... \\
        --out-8w db.launch_scorecard_8w --out-week db.launch_scorecard_week

Inputs are catalog tables (``name=table``) or Parquet folders
(``name=path`` with ``--parquet``). Both outputs are replaced in one
overwrite each. The order-level relations are checkpointed once into
``spark.checkpoint.dir`` (a shared folder on a cluster) and read by both
tables, so the fact is scanned twice in total and a lost executor never
replays the whole lineage.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import uuid
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from launchboard import config as C
from launchboard.config import RunParams
from launchboard.plans import scorecard as S
from launchboard.plans.session import apply_recommended_conf, checkpoint_dir, drop_run
from launchboard.sources.sink import write_full_refresh
from launchboard.sources.tables import NAMES, Inputs


def resolve_as_of(params: RunParams, time_zone: str) -> RunParams:
    """Fix "today" once, in the business's time zone, for every job of a run."""
    if params.as_of is not None:
        return params
    return dataclasses.replace(params, as_of=dt.datetime.now(ZoneInfo(time_zone)).date())


def run_refresh(spark: SparkSession, inputs: Inputs, params: RunParams, *,
                out_8w: str, out_week: str, to_tables: bool, time_zone: str | None = None) -> None:
    """``time_zone``: whose today closes the order days when ``params`` names no
    day (default: the session's)."""
    apply_recommended_conf(spark)
    checkpoint_dir(spark)
    params = resolve_as_of(params, time_zone or spark.conf.get("spark.sql.session.timeZone"))
    # a folder of its own: refreshes on one checkpoint root do not meet
    run_id = f"refresh-{uuid.uuid4().hex}"
    try:
        p = S.share_kpi_state(S.prepare(inputs, params, materialize=True, run_id=run_id), run_id)
        kw = "table" if to_tables else "path"
        write_full_refresh(S.scorecard_8w(p), C.SCORECARD_8W_COLUMNS, **{kw: out_8w})
        write_full_refresh(S.scorecard_week(p), C.SCORECARD_WEEK_COLUMNS, **{kw: out_week})
    finally:
        drop_run(spark, run_id)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", action="append", default=[], metavar="NAME=SOURCE")
    ap.add_argument("--parquet", action="store_true", help="inputs and outputs are folders")
    ap.add_argument("--out-8w", required=True)
    ap.add_argument("--out-week", required=True)
    ap.add_argument("--as-of", help="YYYY-MM-DD; default: today")
    ap.add_argument("--time-zone", help="whose today; default: the session's")
    a = ap.parse_args(argv)
    sources = dict(x.split("=", 1) for x in a.input)
    missing = [n for n in NAMES if n not in sources]
    if missing:
        ap.error(f"missing --input for {missing}")
    spark = SparkSession.builder.appName("launchboard-refresh").getOrCreate()
    inputs = (Inputs.from_parquet(spark, sources) if a.parquet
              else Inputs.from_tables(spark, sources))
    as_of = dt.date.fromisoformat(a.as_of) if a.as_of else None
    run_refresh(spark, inputs, RunParams(as_of=as_of), out_8w=a.out_8w, out_week=a.out_week,
                to_tables=not a.parquet, time_zone=a.time_zone)


if __name__ == "__main__":
    main()
