"""Run parameters and the per-channel specifications.

The four KPI branches and the four benchmark branches differ only in which
columns they read; they are driven from the tables below instead of being
written out four times.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the dashboard definition for identical results)
# ---------------------------------------------------------------------------
CHANNEL_LCS = "LCS"
CHANNEL_TMALL = "TMALL"
CHANNEL_DOUYIN = "DOUYIN"
CHANNEL_DOUYIN_B2B = "DOUYIN_B2B"
CHANNEL_OMNI = "OMNI"
ADMITTED_RAW_CHANNELS = ("LCS", "TMALL", "DOUYIN", "DOUYIN_B2B")
MARKETPLACE_RAW_CHANNELS = ("TMALL", "DOUYIN", "DOUYIN_B2B")
FOLDED_INTO_DOUYIN = ("DOUYIN", "DOUYIN_B2B")
MEMBER_ID_TYPES = ("CRM_memberid", "DY_openid", "TMALL_kyid")
LCS_EXCLUDED_SALES_TYPE = 3
MARKETPLACE_ORDER_TYPE = "normal"
CALENDAR_DAY_TYPE = "day"
TMALL_BIND = ("kyid", "taobao")        # (platform_id_type, platformid)
DOUYIN_BIND = ("openId", "douyin")     # (platform_id_type, platformid)
AGE_FILTER_PATTERN = r"^[0-9]+([ ]*[0-9]*/[0-9]+)?"
AGE_MIXED_FRACTION_PATTERN = r"^[0-9]+ [0-9]+/[0-9]+"
AGE_STRIP_PATTERN = r"[^0-9]+.*"
ADULT_MIN_AGE = 13
PRICE_BANDS = (("LPP", 0, 300), ("MPP", 300, 800), ("HPP", 800, None))
CITY_TIER_DEFAULT = "unspecified"
CITY_MATURITY_DEFAULT = "4_unspecified"
KIDS = "KIDS"
ADULT = "ADULT"
# ---------------------------------------------------------------------------

# Output metric names of the two dashboard tables (the sinks' public schema).
METRIC_COLUMNS = (
    "units_sold",
    "multiple_units_per_order_penetration",
    "member_sales_share",
    "member_shopper",
    "pure_new_0_1_purchase_member_shopper",
    "pure_new_0_1_purchase_member_shopper_share",
    "existing_0_1_member_shopper",
    "existing_0_1_member_shopper_share",
    "lifetime_repurchase_member_shopper",
    "lifetime_repurchase_member_shopper_share",
)
BENCHMARK_COLUMNS = (
    "benchmark_pure_new_0_1_purchase_member_shopper_share",
    "benchmark_existing_0_1_member_shopper_share",
    "benchmark_lifetime_repurchase_member_shopper_share",
)
SKU_ATTRIBUTE_COLUMNS = (
    "sku_name",
    "product_line",
    "rsp",
    "price_band",
    "age_mark",
    "kids_vs_adult",
)
SCORECARD_8W_COLUMNS = (
    ("source_channel", "launch_date", "tracking_end_date", "sku_id")
    + SKU_ATTRIBUTE_COLUMNS
    + METRIC_COLUMNS
    + BENCHMARK_COLUMNS
)
SCORECARD_WEEK_COLUMNS = (
    ("source_channel", "launch_date", "sku_id")
    + SKU_ATTRIBUTE_COLUMNS
    + ("fiscal_year", "fiscal_week")
    + METRIC_COLUMNS
)


@dataclass(frozen=True)
class KpiSpec:
    """One KPI branch.

    rows:          channel whose lines feed the branch (None = all channels)
    launch:        enriched-fact column used as launch_date and as the gate
    joined:        date the member joined the channel (membership or binding)
    launch_cmp:    launch column compared with ``joined`` for new vs existing
    rank_slice:    which lifetime ranking supplies rk
    """

    label: str
    rows: str | None
    launch: str
    joined: str
    launch_cmp: str
    rank_slice: str


@dataclass(frozen=True)
class BenchmarkSpec:
    """One benchmark branch (brand-level shares over all SKUs sold in a period).

    period_start:  product column (of the focus SKU) that opens the period
    rows:          channel whose lines are counted (None = all)
    launch_cmp:    launch column of the *sold* SKU compared with join_date
    rank_slice:    which lifetime ranking supplies rk
    """

    label: str
    period_start: str
    rows: str | None
    launch_cmp: str
    rank_slice: str


# Douyin compares against the Tmall launch date and the Douyin benchmark
# opens its periods at the brand-level launch: both as in the dashboard.
KPI_SPECS: tuple[KpiSpec, ...] = (
    KpiSpec("LCS", "LCS", "lcs_launch_date", "join_date", "lcs_launch_date", "LCS"),
    KpiSpec("TMALL", "TMALL", "tm_launch_date", "tmall_bind_date", "tm_launch_date", "TMALL"),
    KpiSpec("DOUYIN", "DOUYIN", "dy_launch_date", "douyin_bind_date", "tm_launch_date", "DOUYIN"),
    KpiSpec("OMNI", None, "bu_launch_date", "join_date", "bu_launch_date", "OMNI"),
)

BENCHMARK_SPECS: tuple[BenchmarkSpec, ...] = (
    BenchmarkSpec("OMNI", "bu_launch_date", None, "bu_launch_date", "OMNI"),
    BenchmarkSpec("LCS", "lcs_launch_date", "LCS", "bu_launch_date", "LCS"),
    BenchmarkSpec("TMALL", "tm_launch_date", "TMALL", "tm_launch_date", "TMALL"),
    BenchmarkSpec("DOUYIN", "bu_launch_date", "DOUYIN", "dy_launch_date", "DOUYIN"),
)

RANK_SLICES = ("LCS", "TMALL", "DOUYIN", "OMNI")


@dataclass(frozen=True)
class RunParams:
    """Parameters of one scorecard run.

    as_of:                 orders paid on or after this day are left out
                           (the dashboard uses the current date)
                           (None: today in the session's time zone; a refresh
                           resolves it once for all its jobs)
    max_broadcast_bytes:   dimension sides proven at most this large are
                           broadcast; larger ones take a shuffle join
    null_bypass_share:     lines without a join key go round its shuffle (and the
                           lines are read in two branches) from this share on; below
                           it they are spread over the partitions
    hot_share:             a member or channel id with more than this share of
                           the rows is split over partitions by its share (at most
                           1 / hot_share ids can be)
    """

    as_of: dt.date | None = None
    max_broadcast_bytes: int = 64 << 20
    null_bypass_share: float = 0.25
    hot_share: float = 0.001
    kpi_specs: tuple[KpiSpec, ...] = field(default=KPI_SPECS)
    benchmark_specs: tuple[BenchmarkSpec, ...] = field(default=BENCHMARK_SPECS)


# The test data ends on 2001-08-01; a fixed as_of keeps runs reproducible.
ANALYST_DEFAULTS = RunParams(as_of=dt.date(2001, 7, 1))
