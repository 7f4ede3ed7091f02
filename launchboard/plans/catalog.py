"""Registered queries: one per operator of the dashboard, each run over the
whole test tables, each with its DuckDB oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from launchboard import config as C
from launchboard.config import ANALYST_DEFAULTS, RunParams
from launchboard.operators import dims as D
from launchboard.operators import fact as FT
from launchboard.operators import ranks as RK
from launchboard.plans import oracle as O
from launchboard.plans import scorecard as S
from launchboard.plans.session import apply_recommended_conf, drop_at_exit, scratch_root
from launchboard.sources.sink import read_refreshed, table_details, write_full_refresh
from launchboard.sources.tables import Inputs

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    apply_recommended_conf(spark)
    return Inputs.from_testdata(spark, sf_dir)


def _prepared(spark: SparkSession, sf_dir: str, params: RunParams = ANALYST_DEFAULTS):
    return S.prepare(_inputs(spark, sf_dir), params, materialize=True)


def _lines(spark, sf_dir):
    return FT.admitted_lines(_inputs(spark, sf_dir).order_line, ANALYST_DEFAULTS)


def _rank_slice(label: str) -> Query:
    def q(spark, sf_dir):
        return RK.order_rank(RK.rank_orders(_lines(spark, sf_dir), slices=(label,)))
    return q


def _order_dedup(spark, sf_dir):
    return _prepared(spark, sf_dir).rank_orders


def _kpi(label: str) -> Query:
    return lambda spark, sf_dir: S.kpi_launch_window(_prepared(spark, sf_dir), (label,))


def _bench(label: str) -> Query:
    return lambda spark, sf_dir: S.benchmark_all(_prepared(spark, sf_dir), (label,))


def _member_dim(spark, sf_dir):
    m = _inputs(spark, sf_dir).member
    return FT.build_member(m)


def _sink_full_refresh(spark, sf_dir):
    """The 8-week table written twice to one folder and read back."""
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}/scorecard_8w"
    drop_at_exit(path)
    p = _prepared(spark, sf_dir)
    for _ in range(2):
        write_full_refresh(S.scorecard_8w(p), C.SCORECARD_8W_COLUMNS, path=path)
    return read_refreshed(spark, path)


def _sink_positional_insert(spark, sf_dir):
    """The weekly table refreshed twice by position into an existing table whose
    own column names differ."""
    name = f"launchboard_sink_{uuid.uuid4().hex}"
    path = f"{scratch_root(spark)}/{name}"
    drop_at_exit(path)
    df = S.scorecard_week(_prepared(spark, sf_dir))
    columns = ", ".join(f"c{i} {df.schema[c].dataType.simpleString()}"
                        for i, c in enumerate(C.SCORECARD_WEEK_COLUMNS))
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    try:
        for _ in range(2):
            write_full_refresh(df, C.SCORECARD_WEEK_COLUMNS, table=name)
        # the table's files outlive its entry in the catalog
        files = spark.read.schema(spark.table(name).schema).parquet(table_details(spark, name)[1])
        return files.toDF(*C.SCORECARD_WEEK_COLUMNS)
    finally:
        spark.sql(f"DROP TABLE {name}")


QUERIES: dict[str, Query] = {
    # sources, filters, distincts
    "calendar_day": lambda s, d: D.calendar_days(_inputs(s, d).calendar),
    "bind_tmall": lambda s, d: D.tmall_bindings(_inputs(s, d).shopper_binding),
    "bind_douyin": lambda s, d: D.douyin_bindings(_inputs(s, d).shopper_binding),
    "city_maturity": lambda s, d: D.city_maturity(_inputs(s, d).store, _inputs(s, d).city_type),
    "member_dim": _member_dim,
    "admitted_lines": _lines,
    # dimensions and the enriched fact
    "dim_product": lambda s, d: D.dim_product(_inputs(s, d).product),
    "focus_periods": lambda s, d: D.focus_periods(D.dim_product(_inputs(s, d).product),
                                                  _inputs(s, d).focus_sku),
    "fact_enriched": lambda s, d: FT.fact_enriched(_inputs(s, d), ANALYST_DEFAULTS),
    # lifetime ranking
    "order_dedup": _order_dedup,
    "order_rank": lambda s, d: RK.order_rank(RK.rank_orders(_lines(s, d))),
    "rank_lifetime_lcs": _rank_slice("LCS"),
    "rank_lifetime_tmall": _rank_slice("TMALL"),
    "rank_lifetime_douyin": _rank_slice("DOUYIN"),
    "rank_lifetime_omni": _rank_slice("OMNI"),
    "rank_first_order": lambda s, d: RK.rank_classes(RK.rank_orders(_lines(s, d))),
    # units per order
    "order_pieces": lambda s, d: (lambda p: p.pieces)(_prepared(s, d)),
    # KPIs
    "kpi_launch_window": lambda s, d: S.kpi_launch_window(_prepared(s, d)),
    "kpi_lcs": _kpi("LCS"),
    "kpi_tmall": _kpi("TMALL"),
    "kpi_douyin": _kpi("DOUYIN"),
    "kpi_omni": _kpi("OMNI"),
    "kpi_launch_week": lambda s, d: S.kpi_launch_week(_prepared(s, d)),
    # benchmarks
    "benchmark_all": lambda s, d: S.benchmark_all(_prepared(s, d)),
    "benchmark_omni": _bench("OMNI"),
    "benchmark_lcs": _bench("LCS"),
    "benchmark_tmall": _bench("TMALL"),
    "benchmark_douyin": _bench("DOUYIN"),
    # the two dashboard tables
    "scorecard_8w": lambda s, d: S.scorecard_8w(_prepared(s, d)),
    "scorecard_week": lambda s, d: S.scorecard_week(_prepared(s, d)),
    # sinks
    "sink_full_refresh": _sink_full_refresh,
    "sink_positional_insert": _sink_positional_insert,
}

_RANK_COLS = "slice, parent_order_id, member_id, order_paid_time, rk"

ORACLE: dict[str, str] = {
    "calendar_day": O.select_from("cal_day"),
    "bind_tmall": O.select_from("bind_tmall"),
    "bind_douyin": O.select_from("bind_douyin"),
    "city_maturity": O.select_from("city_maturity"),
    "member_dim": O.select_from("member_dim"),
    "admitted_lines": O.select_from("admitted_lines"),
    "dim_product": O.select_from("dim_product"),
    "focus_periods": O.select_from("focus_periods"),
    "fact_enriched": O.select_from("fact"),
    "order_dedup": O.select_from("rank_orders"),
    "order_rank": O.select_from("order_rank"),
    "rank_lifetime_lcs": O.select_from("order_rank", _RANK_COLS, "slice = 'LCS'"),
    "rank_lifetime_tmall": O.select_from("order_rank", _RANK_COLS, "slice = 'TMALL'"),
    "rank_lifetime_douyin": O.select_from("order_rank", _RANK_COLS, "slice = 'DOUYIN'"),
    "rank_lifetime_omni": O.select_from("order_rank", _RANK_COLS, "slice = 'OMNI'"),
    "rank_first_order": O.select_from("rank_first"),
    "order_pieces": O.select_from("upt"),
    "kpi_launch_window": O.kpi_sql(),
    "kpi_lcs": O.kpi_sql(("LCS",)),
    "kpi_tmall": O.kpi_sql(("TMALL",)),
    "kpi_douyin": O.kpi_sql(("DOUYIN",)),
    "kpi_omni": O.kpi_sql(("OMNI",)),
    "kpi_launch_week": O.kpi_sql(week=True),
    "benchmark_all": O.benchmark_sql(),
    "benchmark_omni": O.benchmark_sql(("OMNI",)),
    "benchmark_lcs": O.benchmark_sql(("LCS",)),
    "benchmark_tmall": O.benchmark_sql(("TMALL",)),
    "benchmark_douyin": O.benchmark_sql(("DOUYIN",)),
    "scorecard_8w": O.scorecard_8w_sql(),
    "scorecard_week": O.scorecard_week_sql(),
    "sink_full_refresh": O.scorecard_8w_sql(),
    "sink_positional_insert": O.scorecard_week_sql(),
}

assert set(QUERIES) == set(ORACLE)
