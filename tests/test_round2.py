"""Scale and safety of the engine: sampling, scan bounds, hot keys, far-future
periods, refreshes side by side, the path without broadcasts."""

import dataclasses
import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from launchboard import config as C
from launchboard.config import ANALYST_DEFAULTS, RunParams
from launchboard.operators import kpi as K
from launchboard.operators import ranks as RK
from launchboard.operators.joins import Skew, find_skew, left_join_skewed
from launchboard.operators.range_count import range_distinct_counts, range_distinct_counts_naive
from launchboard.plans import catalog
from launchboard.plans import oracle as O
from launchboard.plans import refresh
from launchboard.plans import scorecard as S
from launchboard.plans.session import RECOMMENDED_CONF, apply_recommended_conf, scratch_root
from launchboard.sources.sink import read_refreshed, write_full_refresh
from launchboard.sources.tables import NAMES, Inputs
from tests.compare import diff
from tests.handmade import duck_inputs, spark_inputs


def test_rank_does_not_rest_on_exchange_reuse(spark):
    """2M orders, one member with a third of them: more rows than the range
    bounds are sampled from, so each sampling gives other bounds."""
    n = 2_000_000
    orders = spark.range(n).select(
        F.lit("OMNI").alias("slice"), F.col("id").alias("parent_order_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 5000)).alias("member_id"),
        F.timestamp_seconds(F.xxhash64("id") % 1_000_000).cast("timestamp_ntz").alias("order_paid_time"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ranked = RK.order_rank(orders, partitions=16)
        wrong = (ranked.groupBy("slice", "member_id")
                 .agg(F.count(F.lit(1)).alias("n"), F.max("rk").alias("top"),
                      F.sum("rk").alias("sum"))
                 .where("top <> n or sum <> n * (n + 1) / 2").count())
        assert wrong == 0 and ranked.count() == n
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_first_order_of_a_member_without_order_ids(spark):
    rows = [("OMNI", None, "a", dt.datetime(2020, 1, 1)), ("OMNI", "x", "b", dt.datetime(2020, 1, 1)),
            ("OMNI", None, "b", dt.datetime(2020, 1, 2))]
    o = spark.createDataFrame(rows, "slice string, parent_order_id string, member_id string, "
                                    "order_paid_time timestamp_ntz")
    got = {(r.parent_order_id, r.member_id): r.is_first for r in RK.rank_classes(o).collect()}
    assert got == {(None, "a"): True, ("x", "b"): True, (None, "b"): False}


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """The eight inputs as Parquet tables."""
    base = tempfile.mkdtemp(prefix="lb-stored-")
    inputs = Inputs.from_testdata(spark, sf_dir)
    for n in NAMES:
        getattr(inputs, n).write.parquet(f"{base}/{n}")
    return {n: f"{base}/{n}" for n in NAMES}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpi_scan_is_bounded_by_tracking_days(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    p = S.prepare(Inputs.from_parquet(spark, stored), ANALYST_DEFAULTS)
    plan = plan_of(K.tracked_lines(p.lines, p.dims, p.params, {"crm_key": Skew(), "type_value": Skew()}))
    lo, hi = K.tracking_bounds(p.dims)
    pushed = next(x for x in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan) if "order_paid_date" in x)
    assert f"GreaterThanOrEqual(order_paid_date,{lo})" in pushed
    assert f"LessThanOrEqual(order_paid_date,{hi})" in pushed


def test_kpi_query_reads_its_rows_once(spark, stored):
    p = S.prepare(Inputs.from_parquet(spark, stored), ANALYST_DEFAULTS, materialize=True)
    plan = plan_of(S.kpi_launch_window(p))
    assert stored["order_line"] not in plan and "kpi_state_all" in plan


def test_hot_key_of_chained_joins_is_split(spark):
    """Two right sides on one left key: runtime skew handling cannot split the
    left side, the buckets do."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 200_000
        left = spark.range(n).select(F.col("id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"))
        rights = [(spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias(f"r{i}"),
                                            F.lit(i).alias(f"v{i}"))
                   .unionByName(spark.range(1).select(F.lit("hot").alias(f"r{i}"), F.lit(9).alias(f"v{i}"))), f"r{i}")
                  for i in (0, 1)]
        skew = find_skew(left, {"k": "k"}, 0.01)["k"]
        assert skew == Skew(0, {"hot": 0.5})
        out = left_join_skewed(left, F.col("k"), rights, ["id"], skew)
        sizes = [r["c"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("c")).collect()]
        assert sum(sizes) == n and max(sizes) < 0.3 * n
        assert out.where("k = 'hot' and v0 = 9 and v1 = 9").count() == n // 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_key_lists_are_bounded(spark):
    rows = spark.range(10_000).select((F.col("id") % 500).alias("k"))
    assert find_skew(rows, {"k": "k"}, 0.01) == {"k": Skew()}
    assert len(find_skew(rows, {"k": "k"}, 0.001)["k"].hot) == 500


def test_far_future_period_ends_cost_nothing(spark):
    day = dt.date(2020, 1, 1)
    occ = spark.createDataFrame([("A", f"e{i % 7}", day + dt.timedelta(days=i * 5 % 60), i % 2 == 0, True)
                                 for i in range(80)], "g string, e string, day date, c1 boolean, c2 boolean")
    periods = [("A", day + dt.timedelta(days=s), dt.date(9999, 12, 31)) for s in range(0, 70, 7)]
    periods += [("A", day, day + dt.timedelta(days=20)), ("A", day, None), ("A", dt.date(2030, 1, 1), dt.date(9999, 12, 31))]
    per = spark.createDataFrame(periods, "g string, start date, end date")
    last = day + dt.timedelta(days=60)
    fast = range_distinct_counts(occ, per, ["g"], "e", "day", ["c1", "c2"], last)
    slow = range_distinct_counts_naive(occ, per, ["g"], "e", "day", ["c1", "c2"])
    key = lambda r: repr(r)
    assert sorted(map(tuple, fast.collect()), key=key) == sorted(map(tuple, slow.collect()), key=key)


def test_results_without_any_broadcast(spark):
    """No dimension is proven small: shuffle joins throughout, the same rows."""
    old = (O.INPUTS_AS_VIEWS, O.AS_OF)
    O.INPUTS_AS_VIEWS, O.AS_OF = True, "DATE '2020-12-31'"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        params = RunParams(as_of=dt.date(2020, 12, 31), max_broadcast_bytes=0)
        p = S.prepare(spark_inputs(spark), params, materialize=True)
        assert not any(p.dims.small.values())
        assert diff(S.scorecard_8w(p), duck_inputs(), O.scorecard_8w_sql()) is None
    finally:
        O.INPUTS_AS_VIEWS, O.AS_OF = old
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_refreshes_share_a_root_and_clean_up(spark, monkeypatch):
    """Each refresh writes into a folder of its own and removes it."""
    seen = []
    real = refresh.S.prepare
    monkeypatch.setattr(refresh.S, "prepare", lambda *a, **k: seen.append(k["run_id"]) or real(*a, **k))
    inputs = spark_inputs(spark)
    params = RunParams(as_of=dt.date(2020, 12, 31))
    base = tempfile.mkdtemp(prefix="lb-two-")
    for k in (0, 1):
        refresh.run_refresh(spark, inputs, params, out_8w=f"{base}/8w-{k}", out_week=f"{base}/w-{k}", to_tables=False)
    assert len(set(seen)) == 2
    root = scratch_root(spark).removeprefix("file:")
    assert not any(os.path.exists(f"{root}/{run}") for run in seen)
    a, b = (sorted(map(repr, read_refreshed(spark, f"{base}/8w-{k}").collect())) for k in (0, 1))
    assert a == b and a


def test_as_of_is_resolved_once_in_the_given_zone(monkeypatch):
    class Clock(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            return dt.datetime(2024, 5, 1, 20, 0, tzinfo=dt.timezone.utc).astimezone(tz)
    monkeypatch.setattr(refresh.dt, "datetime", Clock)
    assert refresh.resolve_as_of(RunParams(), "Asia/Shanghai").as_of == dt.date(2024, 5, 2)
    assert refresh.resolve_as_of(RunParams(), "UTC").as_of == dt.date(2024, 5, 1)
    fixed = dataclasses.replace(RunParams(), as_of=dt.date(2001, 7, 1))
    assert refresh.resolve_as_of(fixed, "UTC") is fixed


def test_user_settings_are_kept(spark):
    key = "spark.sql.adaptive.skewJoin.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        apply_recommended_conf(spark)
        assert spark.conf.get(key) == "false" and key in RECOMMENDED_CONF
    finally:
        spark.conf.set(key, before)


def test_existing_table_keeps_its_definition(spark):
    path = tempfile.mkdtemp(prefix="lb-table-")
    spark.sql(f"CREATE TABLE lb_kept (first int COMMENT 'own', second string) USING parquet LOCATION '{path}/t'")
    try:
        df = spark.createDataFrame([(1, "a")], "x int, y string")
        for _ in range(2):
            write_full_refresh(df, ("x", "y"), table="lb_kept")
        assert spark.table("lb_kept").columns == ["first", "second"]
        assert [tuple(r) for r in spark.table("lb_kept").collect()] == [(1, "a")]
    finally:
        spark.sql("DROP TABLE lb_kept")


@pytest.mark.parametrize("key", ["sink_full_refresh", "sink_positional_insert", "bind_tmall"])
def test_more_queries_match_the_oracle(key, spark, sf_dir, con):
    assert diff(catalog.QUERIES[key](spark, sf_dir), con, catalog.ORACLE[key]) is None


def test_reader_keeps_text_ids_and_bind_times(spark):
    lines = spark.createDataFrame([("LCS", "A-1", "S-9")], "source_channel string, parent_order_id string, sku_id string")
    from launchboard.sources import tables as T
    for c, kind in T.SCHEMAS["order_line"].items():
        if c not in lines.columns:
            lines = lines.withColumn(c, F.lit(None).cast(kind))
    assert T.conform(lines, "order_line").first()["parent_order_id"] == "A-1"
    binds = spark.createDataFrame([("k", "kyid", "taobao", f"2020-01-01 {h}:00:00") for h in ("09", "18", "18")],
                                  "platform_id_value string, platform_id_type string, platformid string, first_bind_time string")
    from launchboard.operators.dims import tmall_bindings
    assert tmall_bindings(T.conform(binds, "shopper_binding")).count() == 2
    assert C.TMALL_BIND
