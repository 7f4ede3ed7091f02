"""The range distinct counter equals the direct range join + COUNT(DISTINCT)."""

import datetime as dt
import random

from launchboard.operators.range_count import (range_distinct_counts,
                                               range_distinct_counts_naive)
from tests.compare import _key, _norm

D0 = dt.date(2020, 1, 1)


def _rows(df, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def test_equals_naive_on_random_data(spark):
    rnd = random.Random(7)
    occ = []
    for _ in range(600):
        g = rnd.choice(["A", "B"])
        m = f"m{rnd.randint(0, 40) if rnd.random() > 0.3 else 0}"   # m0 is a hot entity
        d = D0 + dt.timedelta(days=rnd.randint(0, 60))
        occ.append((g, m, d, rnd.random() < 0.8, rnd.random() < 0.4))
    periods = []
    for _ in range(40):
        g = rnd.choice(["A", "B", "C"])
        s = D0 + dt.timedelta(days=rnd.randint(-5, 60))
        e = s + dt.timedelta(days=rnd.randint(-3, 30))
        periods.append((g, s, e))
    periods += [("A", None, D0), ("A", D0, None), ("B", D0, D0), ("B", D0, D0)]
    o = spark.createDataFrame(occ, "g string, m string, d date, c1 boolean, c2 boolean")
    p = spark.createDataFrame(periods, "g string, start date, end date")
    cols = ["g", "start", "end", "c1", "c2"]
    fast = range_distinct_counts(o, p, ["g"], "m", "d", ["c1", "c2"])
    naive = range_distinct_counts_naive(o, p, ["g"], "m", "d", ["c1", "c2"])
    assert _rows(fast, cols) == _rows(naive, cols)


def test_days_before_1970_bit_ends_and_missing_days(spark):
    base = dt.date(1969, 11, 1)
    days = [base + dt.timedelta(days=k) for k in (0, 1, 60, 61, 62, 63, 64, 124, 125, 126, 127, 128, 400)] + [None]
    occ = [(m, d, i % 3 != 0, None if i % 4 == 0 else True) for m in ("x", "y") for i, d in enumerate(days)]
    periods = [(a, b) for a in days[:-1] for b in days[:-1] if a <= b]
    o = spark.createDataFrame(occ, "m string, d date, c1 boolean, c2 boolean")
    p = spark.createDataFrame(periods, "start date, end date")
    cols = ["start", "end", "c1", "c2"]
    fast = range_distinct_counts(o, p, [], "m", "d", ["c1", "c2"])
    assert _rows(fast, cols) == _rows(range_distinct_counts_naive(o, p, [], "m", "d", ["c1", "c2"]), cols)


def test_members_are_not_sorted(spark, sf_dir):
    import re

    from launchboard.plans import catalog
    plan = catalog.QUERIES["benchmark_all"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*", plan)
    assert windows and not any("member_id" in w for w in windows)
