"""Brand-level benchmark shares per channel and tracking period.

For every period (period start of a tracked SKU, tracking end) and branch
of ``config.BENCHMARK_SPECS``: among members with an effective member line
of *any* SKU paid inside the period, the share that were pure new (rk = 1,
joined on or after the sold SKU's launch), existing 0-1 (rk = 1, joined
before) and repurchasers (rk >= 2).

The order summary (one row per order, member and day, with the earliest and
latest launch date of the sold SKUs) gets the members' join dates and the
order-level rank flags, all at order grain, and is then fanned out to the
branches. The distinct counts over many overlapping periods come from
``range_count.range_distinct_counts``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard import config as C
from launchboard.config import BenchmarkSpec, RunParams
from launchboard.functions import rules as R
from launchboard.operators.dims import focus_periods
from launchboard.operators import ranks as RK
from launchboard.operators.fact import Dims
from launchboard.operators.joins import Skew, left_join_skewed
from launchboard.operators.range_count import range_distinct_counts

COUNTERS = ["elig", "pure_new", "existing", "repurchase"]
BENCH_OUTPUT = ("source_channel", "launch_date", "tracking_end_date") + C.BENCHMARK_COLUMNS


def _explode_specs(df: DataFrame, structs: list) -> DataFrame:
    """One output row per spec whose struct is not NULL (no union of copies)."""
    arr = F.filter(F.array(*structs), lambda v: v.isNotNull())
    return df.withColumn("_spec", F.explode(arr))


def benchmark_periods(dims: Dims, specs: tuple[BenchmarkSpec, ...]) -> DataFrame:
    fp = focus_periods(dims.product, dims.focus)
    structs = [F.struct(F.lit(s.label).alias("source_channel"),
                        F.col(s.period_start).alias("start")) for s in specs]
    x = _explode_specs(fp, structs)
    return x.select("_spec.source_channel", "_spec.start", F.col("tracking_end_date").alias("end"))


def occurrences(summary: DataFrame, dims: Dims, info: DataFrame, params: RunParams,
                specs: tuple[BenchmarkSpec, ...], skew: dict[str, Skew]) -> DataFrame:
    """(source_channel, member_id, day, elig, pure_new, existing, repurchase), a row
    per branch and row of the order summary; ``info`` is
    ``ranks.order_flags``. Both joins run on summary rows, before the fan-out to
    branches, and rows without an order id are spread in theirs."""
    e = summary.where(F.col("has_elig") & F.col("member_id").isNotNull())
    joins = dims.member.where(F.col("member_key").isNotNull()).groupBy("member_key").agg(
        F.min("join_date").alias("_jmin"), F.max("join_date").alias("_jmax"))
    e = left_join_skewed(e, F.col("crm_key"), [(joins, "member_key")],
                         ["parent_order_id", "member_id"], skew["crm_key"])
    e = left_join_skewed(e, F.col("parent_order_id"),
                         [(info.withColumnRenamed("parent_order_id", "_oid"), "_oid")],
                         ["member_id", "day", "type_value"], skew["parent_order_id"])
    structs = []
    for s in specs:
        _, first, repeat = RK.flag_columns(s.rank_slice)
        # some sold SKU launched on/before (after) a member row's join date
        le = R.is_true(F.col(f"{s.launch_cmp}_min") <= F.col("_jmax"))
        gt = R.is_true(F.col(f"{s.launch_cmp}_max") > F.col("_jmin"))
        st = F.struct(F.lit(s.label).alias("source_channel"),
                      (R.is_true(first) & le).alias("pure_new"),
                      (R.is_true(first) & gt).alias("existing"),
                      R.is_true(repeat).alias("repurchase"))
        structs.append(st if s.rows is None else F.when(F.col("source_channel") == s.rows, st))
    return _explode_specs(e, structs).select("_spec.*", "member_id", "day", F.lit(True).alias("elig"))


def benchmarks(summary: DataFrame, dims: Dims, info: DataFrame, params: RunParams,
               specs: tuple[BenchmarkSpec, ...], skew: dict[str, Skew]) -> DataFrame:
    occ = occurrences(summary, dims, info, params, specs, skew)
    # no order is paid on or after as_of, so no day from then on counts anything
    last = params.as_of - dt.timedelta(days=1) if params.as_of else None
    counts = range_distinct_counts(occ, benchmark_periods(dims, specs), ["source_channel"],
                                   "member_id", "day", COUNTERS, last)
    return counts.select(
        "source_channel", F.col("start").alias("launch_date"),
        F.col("end").alias("tracking_end_date"),
        R.safe_ratio("pure_new", "elig").alias(C.BENCHMARK_COLUMNS[0]),
        R.safe_ratio("existing", "elig").alias(C.BENCHMARK_COLUMNS[1]),
        R.safe_ratio("repurchase", "elig").alias(C.BENCHMARK_COLUMNS[2]),
    )
