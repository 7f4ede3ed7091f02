"""Lifetime ranks: exact row numbers, first-order classes, tie-break."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from launchboard.operators import ranks as RK

T = dt.datetime


def _orders(spark):
    rows = [
        ("LCS", 1, "a", T(2020, 1, 1)), ("LCS", 2, "a", T(2020, 1, 1)),   # tie: order id decides
        ("LCS", 3, "a", T(2020, 1, 3)), ("LCS", 4, "a", None),            # NULL time last
        ("LCS", 5, None, T(2020, 1, 2)), ("LCS", 6, None, T(2020, 1, 1)),  # NULL member group
        ("OMNI", 1, "a", T(2020, 1, 1)), ("OMNI", 7, "a", T(2019, 1, 1)),
    ]
    return spark.createDataFrame(rows, "slice string, parent_order_id bigint, member_id string, "
                                       "order_paid_time timestamp_ntz")


def test_exact_rank(spark):
    r = {(x.slice, x.parent_order_id): x.rk for x in RK.order_rank(_orders(spark)).collect()}
    assert r == {("LCS", 1): 1, ("LCS", 2): 2, ("LCS", 3): 3, ("LCS", 4): 4,
                 ("LCS", 6): 1, ("LCS", 5): 2, ("OMNI", 7): 1, ("OMNI", 1): 2}


def test_first_order_class_agrees_with_rank(spark):
    o = _orders(spark)
    exact = {(x.slice, x.parent_order_id): x.rk == 1 for x in RK.order_rank(o).collect()}
    cls = {(x.slice, x.parent_order_id): x.is_first for x in RK.rank_classes(o).collect()}
    assert exact == cls


def test_rank_has_no_gaps_on_testdata(spark, sf_dir):
    from launchboard.config import ANALYST_DEFAULTS
    from launchboard.operators.fact import admitted_lines
    from launchboard.sources.tables import Inputs
    lines = admitted_lines(Inputs.from_testdata(spark, sf_dir).order_line, ANALYST_DEFAULTS)
    r = RK.order_rank(RK.rank_orders(lines))
    bad = (r.groupBy("slice", "member_id")
            .agg({"rk": "max", "*": "count"})
            .where("`max(rk)` != `count(1)`").count())
    assert bad == 0


def test_exact_rank_with_a_hot_member(spark):
    """One member holds a third of all orders: its rows spread over many
    range partitions and still get consecutive ranks."""
    import random
    rnd = random.Random(3)
    rows = []
    for o in range(3000):
        m = "hot" if o % 3 == 0 else f"m{rnd.randint(0, 200)}"
        t = None if rnd.random() < 0.02 else T(2020, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 500))
        rows.append(("OMNI", o, m, t))
    df = spark.createDataFrame(rows, "slice string, parent_order_id bigint, member_id string, "
                                     "order_paid_time timestamp_ntz")
    got = {r.parent_order_id: r.rk for r in RK.order_rank(df, partitions=8).collect()}
    expect = {}
    by_member = {}
    for r in rows:
        by_member.setdefault(r[2], []).append(r)
    for m, rs in by_member.items():
        rs.sort(key=lambda r: (r[3] is None, r[3] or T(1, 1, 1), r[1]))
        for i, r in enumerate(rs):
            expect[r[1]] = i + 1
    assert got == expect
    pids = (RK.order_rank(df, partitions=8).where("member_id = 'hot'").count())
    assert pids == 1000


def test_order_flags_without_a_join(spark):
    """Flags of orders by any member, without ids and of one slice alone, as the rank gives
    them; first orders are not joined back to all orders."""
    rows = [(s, o, m, t) for s, o, m, t in itertools.product(
        ("LCS", "OMNI"), (1, 2, 3, None), ("a", "b", None), ("2020-01-01 00:00:00", "2020-01-02 00:00:00", None))
        if (o, m) not in ((3, "a"), (None, "b")) and (s, o) != ("LCS", 2)]
    df = spark.createDataFrame(rows, "slice string, parent_order_id long, member_id string, t string").groupBy(
        "slice", "parent_order_id", "member_id").agg(
        F.max(F.when(F.coalesce("parent_order_id", F.lit(0)) % 2 == 1, F.col("t").cast("timestamp_ntz"))).alias("order_paid_time"))
    flags = RK.order_flags(df, ("LCS", "OMNI"))
    assert "Join" not in flags._jdf.queryExecution().optimizedPlan().toString()
    ranked = RK.rank_classes(df).collect()
    want = {}
    for o in {r.parent_order_id for r in ranked}:
        row = []
        for s in ("LCS", "OMNI"):
            own = [r.is_first for r in ranked if r.slice == s and r.parent_order_id == o]
            row += [len(own), any(own), not all(own)] if own else [None] * 3
        want[o] = tuple(row)
    assert {r[0]: tuple(r)[1:] for r in flags.collect()} == want
