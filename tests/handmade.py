"""Hand-made inputs for the cases the test-data mapping does not reach.

Cases (SURVEY 2.9): an order carrying two member ids (rank join by order
only), a Tmall id bound twice (fan-out), a SKU listed twice in the focus list
(same and different end), zero net sales (NULL member share), a malformed
CRM id, a NULL paid time, age marks '1 1/0' / '13+' / '12 1/2', prices on the
band borders and negative, a city with two maturity types, guests, NULL
member flag, a period whose start is after its end.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from launchboard.sources.tables import SCHEMAS, Inputs

D = dt.date
TS = dt.datetime
M = Decimal

_DUCK_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
               "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
               "decimal(18,2)": "DECIMAL(18,2)"}


def _line(ch, t, order, sku, qty, amt, *, tn="CRM_memberid", tv="m1", crm="1", st=0,
          ot="normal", eff=True, mem=True, city="C1", tier="T1", day=None):
    return (ch, t, day if day is not None else (t.date() if t else None), order, sku, st, ot,
            tn, tv, crm, qty, eff, mem, M(amt), city, tier)


ROWS = {
    "order_line": [
        # member 1: LCS history before launch, then orders on SKU 10 after launch
        _line("LCS", TS(2020, 1, 5, 10), 100, 99, 1, "10.00"),
        _line("LCS", TS(2020, 3, 2, 9), 101, 10, 2, "50.00"),
        _line("LCS", TS(2020, 3, 2, 9), 101, 11, 1, "20.00"),
        _line("LCS", TS(2020, 3, 9, 9), 102, 10, -1, "25.00"),          # return
        _line("LCS", TS(2020, 3, 9, 9), 102, 10, 1, "25.00", eff=False),  # non-effective
        # member 2 joined after launch: first lifetime order on SKU 10
        _line("LCS", TS(2020, 3, 3, 8), 103, 10, 1, "50.00", tv="m2", crm="2"),
        # an order carrying two member ids (crm 3 and crm 4)
        _line("LCS", TS(2020, 3, 4, 8), 104, 10, 1, "50.00", tv="m3", crm="3"),
        _line("LCS", TS(2020, 3, 4, 8), 104, 11, 3, "60.00", tv="m4", crm="4"),
        _line("LCS", TS(2020, 2, 1, 8), 105, 99, 1, "5.00", tv="m4", crm="4"),
        # guest and NULL member flag
        _line("LCS", TS(2020, 3, 5, 8), 106, 10, 2, "100.00", tn="GUEST", tv="g1", crm=None,
              mem=False),
        _line("LCS", TS(2020, 3, 5, 8), 107, 10, 1, "50.00", tv="m5", crm="5", mem=None),
        # malformed CRM id falls back to the channel id as member id
        _line("LCS", TS(2020, 3, 6, 8), 108, 10, 1, "50.00", tv="m6", crm="abc"),
        # NULL paid time with a paid date
        _line("LCS", None, 109, 10, 1, "50.00", tv="m7", crm="7", day=D(2020, 3, 7)),
        # excluded: LCS sales type 3, marketplace presale, other channel, after as_of
        _line("LCS", TS(2020, 3, 8, 8), 110, 10, 5, "50.00", st=3),
        _line("TMALL", TS(2020, 3, 8, 8), 111, 10, 5, "50.00", ot="presale", tn="TMALL_kyid",
              tv="k8", crm=None),
        _line("OTHER", TS(2020, 3, 8, 8), 112, 10, 5, "50.00"),
        _line("LCS", TS(2021, 1, 8, 8), 113, 10, 5, "50.00"),
        # Tmall: id k9 bound twice (fan-out), bought SKU 10 and SKU 12 (zero net)
        _line("TMALL", TS(2020, 3, 10, 8), 120, 10, 1, "50.00", tn="TMALL_kyid", tv="k9",
              crm=None),
        _line("TMALL", TS(2020, 3, 11, 8), 121, 12, 2, "80.00", tn="TMALL_kyid", tv="k9",
              crm=None),
        _line("TMALL", TS(2020, 3, 12, 8), 122, 12, -2, "80.00", tn="TMALL_kyid", tv="k10",
              crm=None),
        _line("TMALL", TS(2019, 12, 12, 8), 123, 99, 1, "9.00", tn="TMALL_kyid", tv="k10",
              crm=None),
        # k9's +80 counts twice (two bind times), so a second return nets it to 0
        _line("TMALL", TS(2020, 3, 13, 8), 124, 12, -2, "80.00", tn="TMALL_kyid", tv="k10",
              crm=None),
        # Douyin and Douyin B2B fold together
        _line("DOUYIN", TS(2020, 3, 13, 8), 130, 10, 1, "50.00", tn="DY_openid", tv="d11",
              crm=None),
        _line("DOUYIN_B2B", TS(2020, 3, 14, 8), 131, 10, 4, "200.00", tn="DY_openid",
              tv="d11", crm=None),
        _line("DOUYIN", TS(2020, 3, 14, 8), 132, 13, 1, "30.00", tn="DY_openid", tv="d12",
              crm="12", city="C2"),
    ],
    "member": [
        ("1", TS(2019, 1, 1, 9), "A"), ("2", TS(2020, 3, 1, 9), "A"), ("3", TS(2020, 2, 1, 9), "A"),
        ("4", TS(2020, 2, 15, 9), "B"), ("5", TS(2019, 5, 5, 9), "B"), ("7", TS(2020, 3, 1, 9), "B"),
        ("12", TS(2020, 1, 1, 9), "B"), ("12", TS(2020, 4, 1, 9), "B"),   # duplicate member row
        ("abc", TS(2020, 1, 1, 9), "X"),
    ],
    "shopper_binding": [
        ("k9", "kyid", "taobao", TS(2020, 3, 1, 9)), ("k9", "kyid", "taobao", TS(2019, 3, 1, 9)),
        ("k9", "kyid", "taobao", TS(2019, 3, 1, 9)),                  # exact duplicate
        ("k10", "kyid", "taobao", TS(2019, 1, 1, 9)),
        ("k10", "kyid", "douyin", TS(2021, 1, 1, 9)),                 # wrong platform
        ("d11", "openId", "douyin", TS(2020, 3, 2, 9)), ("d12", "openId", "douyin", TS(2019, 2, 2, 9)),
        ("d12", "openId", "douyin", TS(2019, 2, 2, 18)),          # twice on one day
    ],
    "product": [
        (10, "sku ten", D(2020, 3, 1), D(2020, 2, 28), D(2020, 3, 2), D(2020, 3, 5), None,
         "L1", M("299.99"), "13+"),
        (11, "sku eleven", D(2020, 3, 1), None, D(2020, 3, 1), None, None, "L1", M("300.00"),
         "12 1/2"),
        (12, "sku twelve", None, D(2020, 3, 1), D(2020, 3, 1), D(2020, 3, 1), D(2020, 2, 1),
         "L2", M("800.00"), "1 1/0"),
        (13, "sku thirteen", D(2020, 3, 1), None, D(2020, 3, 1), D(2020, 3, 3), D(2020, 3, 2),
         "L2", M("-5.00"), "4-7"),
        (14, "sku fourteen", D(2020, 3, 1), None, D(2020, 3, 1), None, None, "L3", None, "N/A"),
        (99, "old sku", D(2018, 1, 1), None, D(2018, 1, 1), D(2018, 1, 1), None, "L9",
         M("10.00"), "6+"),
    ],
    "calendar": [
        (D(2019, 12, 1) + dt.timedelta(days=i), "day", 2020, 1, 1 + i // 7, )
        for i in range(200)
    ] + [(D(2020, 3, 1), "month", 2020, 3, 9)],
    "store": [("C1",), ("C1",), ("C2",), ("C3",)],
    "city_type": [("C1", "1_tier"), ("C2", "2_tier"), ("C2", "3_tier")],
    "focus_sku": [
        (10, D(2020, 4, 30)), (10, D(2020, 3, 10)), (11, D(2020, 4, 30)),
        (11, D(2020, 4, 30)),                                     # listed twice, same end
        (12, D(2020, 4, 30)), (13, D(2020, 4, 30)), (14, D(2020, 1, 1)),  # start after end
    ],
}


def spark_inputs(spark: SparkSession) -> Inputs:
    dfs = {}
    for name, rows in ROWS.items():
        schema = ", ".join(f"{c} {t}" for c, t in SCHEMAS[name].items())
        dfs[name] = spark.createDataFrame(rows, schema=schema)
    return Inputs(**dfs)


def duck_inputs() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, rows in ROWS.items():
        cols = SCHEMAS[name]
        con.execute(f"CREATE TABLE {name} ("
                    + ", ".join(f"{c} {_DUCK_TYPES[t]}" for c, t in cols.items()) + ")")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(cols))})", rows)
    return con
