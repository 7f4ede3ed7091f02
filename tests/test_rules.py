"""Column rules on tiny frames (golden values)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from launchboard.functions import rules as R

D = dt.date


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_lcs_launch_null_rules(spark):
    rows = [(D(2020, 3, 5), D(2020, 3, 1)), (D(2020, 3, 1), D(2020, 3, 5)),
            (None, D(2020, 3, 1)), (D(2020, 3, 1), None), (None, None)]
    got = one(spark, rows, "l date, s date", R.lcs_launch("l", "s"))
    assert got == [D(2020, 3, 1), D(2020, 3, 1), None, D(2020, 3, 1), None]


def test_douyin_and_brand_launch(spark):
    rows = [(D(2020, 1, 2), D(2020, 1, 1)), (None, D(2020, 1, 1)), (D(2020, 1, 2), None),
            (None, None)]
    assert one(spark, rows, "b date, f date", R.douyin_launch("b", "f")) == [
        D(2020, 1, 1), D(2020, 1, 1), D(2020, 1, 2), None]
    rows = [(D(2020, 1, 3), D(2020, 1, 2), D(2020, 1, 4)), (D(2020, 1, 3), None, D(2020, 1, 1))]
    assert one(spark, rows, "a date, b date, c date", R.brand_launch("a", "b", "c")) == [
        D(2020, 1, 2), None]


@pytest.mark.parametrize("mark,admitted,age", [
    ("18+", True, 18), ("1 1/2", True, 1), ("12 1/2", True, 12), ("1/2", True, 1),
    ("4-7", True, 4), (" 5 ", True, 5), ("N/A", False, 0), (None, False, 0),
    ("1 1/0", True, 0), ("13", True, 13), ("2  3/4", True, 2), ("abc", False, 0),
])
def test_age_mark(spark, mark, admitted, age):
    df = spark.createDataFrame([(mark,)], "a string")
    r = df.select(R.age_mark_admitted("a").alias("ok"), R.min_age("a").alias("age")).first()
    assert r["ok"] == admitted
    if admitted:
        assert r["age"] == age


def test_price_band_borders(spark):
    vals = [Decimal("0"), Decimal("299.99"), Decimal("300"), Decimal("799.99"), Decimal("800"),
            Decimal("-0.01"), None]
    got = one(spark, [(v,) for v in vals], "r decimal(18,2)", R.price_band("r"))
    assert got == ["LPP", "LPP", "MPP", "MPP", "HPP", None, None]


def test_kids_vs_adult(spark):
    got = one(spark, [(12,), (13,), (None,)], "a int", R.kids_vs_adult("a"))
    assert got == ["KIDS", "ADULT", "KIDS"]


def test_member_id_and_channel(spark):
    rows = [("CRM_memberid", "7", "m7"), ("TMALL_kyid", None, "k7"), ("GUEST", "7", "m7")]
    got = one(spark, rows, "n string, c string, v string", R.omni_member_id("n", "c", "v"))
    assert got == ["7", "k7", None]
    got = one(spark, [("DOUYIN_B2B",), ("DOUYIN",), ("LCS",)], "c string",
              R.normalize_channel("c"))
    assert got == ["DOUYIN", "DOUYIN", "LCS"]


def test_admitted_line(spark):
    rows = [("LCS", D(2020, 1, 1), 2, "presale"), ("LCS", D(2020, 1, 1), 3, "normal"),
            ("TMALL", D(2020, 1, 1), 3, "normal"), ("TMALL", D(2020, 1, 1), 1, "presale"),
            ("LCS", D(2021, 1, 1), 1, "normal"), ("OTHER", D(2020, 1, 1), 1, "normal"),
            ("LCS", D(2020, 1, 1), None, "normal")]
    got = one(spark, rows, "c string, d date, st int, ot string",
              R.admitted_line("c", "d", "st", "ot", D(2020, 12, 31)))
    assert [bool(x) for x in got] == [True, False, True, False, False, False, False]


def test_safe_ratio(spark):
    got = one(spark, [(1, 2), (1, 0), (1, None)], "n int, d int", R.safe_ratio("n", "d"))
    assert got == [0.5, None, None]
