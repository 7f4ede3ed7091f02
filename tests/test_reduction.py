"""What is left out before joins, reduced once, and numbered without an exchange."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from launchboard.config import ANALYST_DEFAULTS
from launchboard.operators import kpi as K
from launchboard.operators import ranks as RK
from launchboard.operators.orders import tracked_orders
from launchboard.plans import scorecard as S
from launchboard.sources.tables import Inputs


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    return S.prepare(Inputs.from_testdata(spark, sf_dir), ANALYST_DEFAULTS, materialize=True)


def test_only_tracked_orders_reach_the_joins(prepared):
    p = prepared
    lines = K.tracked_lines(p.lines, p.dims, p.params, p.skew)
    wanted = {r[0] for r in lines.select("parent_order_id").distinct().collect()} - {None}
    tracked = {r[0] for r in tracked_orders(p.summary).collect()}
    assert tracked == wanted
    every = p.summary.select("parent_order_id").distinct().count()
    assert len(tracked) < 0.9 * every
    assert {r[0] for r in p.info.select("parent_order_id").collect()} == tracked
    assert p.pieces.count() > p.info.where("pieces is not null").count()


def test_filter_lies_below_both_joins(spark, prepared):
    from launchboard.operators.orders import of_orders
    from launchboard.operators.upt import order_pieces
    p = prepared
    for small in (True, False):
        pieces = order_pieces(of_orders(p.summary, p.tracked, small), p.dims, p.params, p.skew)
        plan = pieces._jdf.queryExecution().optimizedPlan().toString()
        outer, semi = plan.rindex("Join LeftOuter"), plan.index("Join LeftSemi")
        assert outer < semi and plan.count("Join LeftOuter") == 3


def test_pieces_of_tracked_orders_are_unchanged(prepared):
    p = prepared
    some = p.info.select("parent_order_id", "pieces").where("pieces is not null")
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, p.pieces.join(
        p.tracked, "parent_order_id").select("parent_order_id", "pieces").where("pieces is not null").collect()))


def test_lines_are_exchanged_once_for_both_grains(spark, prepared):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    p = prepared
    rows = p._kept(K.kpi_rows(p.lines, p.dims, p.info, p.params, p.params.kpi_specs, p.skew), "rows")
    assert plan_of(K.state(rows)).count("Exchange hashpartitioning") == 1
    S.share_kpi_state(p, "unused")
    for table in (S.kpi_launch_window(p), S.kpi_launch_week(p)):
        plan = plan_of(table)
        assert "kpi_state_all" in plan and "order_info" not in plan


def test_weeks_of_one_member_and_order_count_once_in_the_window(spark):
    day = dt.date(2020, 1, 1)
    line = dict(source_channel="LCS", sku_id=1, sku_name="s", product_line="p", launch_date=day,
                tracking_end_date=day, rsp=1.0, price_band="b", age_mark="a", kids_vs_adult="k", fiscal_year=2020,
                order_paid_date=day, is_member_order=True, if_eff_order_tag=True, launch_cmp=day, joined_date=day)
    rows = [dict(line, fiscal_week=w, member_id=m, parent_order_id=o, sales_qty=q, order_rrp_amt=10.0, pieces=n,
                 n_rank=r, any_first=f, any_repeat=not f)
            for w, m, o, q, n, r, f in [(1, "m1", "o1", 1, 2, None, True), (2, "m1", "o1", 2, 2, 2, False),
                                        (2, "m2", "o2", -1, 1, 1, False), (2, None, None, 1, None, None, True)]]
    kinds = {"sku_id": "long", "fiscal_year": "int", "fiscal_week": "int", "sales_qty": "int", "pieces": "long", "n_rank": "long",
             "rsp": "double", "order_rrp_amt": "double"}
    schema = ", ".join(f"{c} " + kinds.get(c, "date" if isinstance(v, dt.date) else "boolean" if isinstance(v, bool) else "string")
                       for c, v in rows[0].items())
    state = K.state(spark.createDataFrame(rows, schema))
    window = K.aggregate(state, K.WINDOW_KEYS).first()
    assert (window.units_sold, window.member_shopper) == (1 + 4 - 1 + 1, 2)
    assert window.multiple_units_per_order_penetration == 0.5  # of o1 and o2
    assert (window.pure_new_0_1_purchase_member_shopper, window.lifetime_repurchase_member_shopper) == (1, 2)
    assert window.member_sales_share == pytest.approx((10 + 20 - 10 + 10) / (10 + 20 - 10 + 10))
    weeks = {r.fiscal_week: r for r in K.aggregate(state, K.WEEK_KEYS).collect()}
    assert (weeks[1].member_shopper, weeks[2].member_shopper) == (1, 2)
    assert (weeks[1].units_sold, weeks[2].units_sold) == (1, 4)


def test_ranks_take_one_exchange_and_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(RK, "ORDERS_A_PARTITION", 500)
    n = 10_000
    orders = spark.range(n).select(
        F.lit("OMNI").alias("slice"), F.concat(F.lit("o"), F.col("id")).alias("parent_order_id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("m"), F.col("id") % 7)).alias("member_id"),
        F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.xxhash64("id") % 1000).cast("timestamp_ntz")).alias("order_paid_time"))
    kept = {}

    def keep(df, name):
        if name == "ranged_orders":  # sampled bounds, one exchange
            assert plan_of(df).count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan_of(df)
        path = f"{spark.sparkContext.getCheckpointDir()}/{name}-test"
        df.write.mode("overwrite").parquet(path)
        kept[name] = spark.read.parquet(path)
        return kept[name]

    ranked = RK.order_rank(orders, keep=keep)
    assert "Exchange" not in plan_of(ranked).replace("BroadcastExchange", "")
    assert kept["ranged_orders"].select("_pid").distinct().count() > 15
    key = lambda r: (r.member_id or "~", r.order_paid_time is None, str(r.order_paid_time), r.parent_order_id)
    expected, seen = [], {}
    for r in sorted(orders.collect(), key=key):
        seen[r.member_id] = seen.get(r.member_id, 0) + 1
        expected.append((r.parent_order_id, seen[r.member_id]))
    assert sorted((r.parent_order_id, r.rk) for r in ranked.collect()) == sorted(expected)


def test_rank_of_no_orders(spark):
    none = spark.createDataFrame([], "slice string, parent_order_id string, member_id string, order_paid_time timestamp_ntz")
    assert RK.order_rank(none).count() == 0
