"""The enriched order-line fact.

``admitted_lines`` applies the line rules and derives the ids; it only reads
the fact, so Catalyst pushes its filters into the scan. ``enrich`` adds the
six dimension joins: product, calendar and city are broadcast behind a size
check; member and platform bindings are shuffle joins (large tables)
whose NULL keys go round the shuffle and whose hot keys are spread by their share (see
``joins.left_join_skewed``). Left joins
keep the dashboard's fan-out: a dimension key present twice doubles the line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard import config as C
from launchboard.config import RunParams
from launchboard.functions import rules as R
from launchboard.operators import dims as D
from launchboard.operators.joins import (
    Skew, broadcast_if, find_skew, left_join_skewed, proven_small)
from launchboard.sources.tables import Inputs

FACT_COLUMNS = (
    "source_channel", "order_paid_time", "order_paid_date", "fiscal_year", "fiscal_month",
    "fiscal_week", "member_id", "member_detail_id", "join_date", "tmall_bind_date",
    "douyin_bind_date", "eff_reg_channel", "parent_order_id", "sku_id", "sku_name",
    "bu_launch_date", "lcs_launch_date", "tm_launch_date", "dy_launch_date", "product_line",
    "rsp", "age_mark", "kids_vs_adult", "price_band", "city_tier", "city_maturity_type",
    "sales_qty", "if_eff_order_tag", "is_member_order", "order_rrp_amt",
)


@dataclass(frozen=True)
class Dims:
    product: DataFrame      # dim_product, broadcast when bounded
    calendar: DataFrame     # day rows, broadcast when bounded
    city: DataFrame         # distinct (city_cn, city_maturity_type)
    member: DataFrame       # (member_key, member_detail_id, join_date, eff_reg_channel)
    tmall: DataFrame        # (kyid, tmall_bind_date)
    douyin: DataFrame       # (openid, douyin_bind_date)
    focus: DataFrame        # focus list (sku_id, tracking_end_date), broadcast when bounded
    small: dict             # name -> size proven under params.max_broadcast_bytes


def build_member(member: DataFrame) -> DataFrame:
    """Member dimension keyed by the numeric member id."""
    return member.select(
        R.numeric_id("member_detail_id").alias("member_key"), "member_detail_id",
        F.to_date("join_time").alias("join_date"), "eff_reg_channel")


def build_dims(inputs: Inputs, params: RunParams, keep=None) -> Dims:
    """Dimensions of one run. Product, calendar, city and focus list are
    size-checked together (one job); those proven small are broadcast, and
    with ``keep`` (a materializer) all are written once so that every later use
    reads the file instead of re-deriving them."""
    small_dims = {
        "product": D.dim_product(inputs.product),
        "calendar": D.calendar_days(inputs.calendar),
        "city": D.city_maturity(inputs.store, inputs.city_type),
        "focus": inputs.focus_sku,
    }
    small = proven_small(small_dims, params.max_broadcast_bytes)
    if keep is not None:
        small_dims = {k: keep(v, f"dim_{k}") for k, v in small_dims.items()}
    b = {k: broadcast_if(v, small[k]) for k, v in small_dims.items()}
    return Dims(
        product=b["product"], calendar=b["calendar"], city=b["city"],
        member=build_member(inputs.member),
        tmall=D.tmall_bindings(inputs.shopper_binding),
        douyin=D.douyin_bindings(inputs.shopper_binding),
        focus=b["focus"], small=small,
    )


def admitted_lines(order_line: DataFrame, params: RunParams) -> DataFrame:
    """Admitted order lines with the normalised channel and member ids."""
    ol = order_line.where(R.admitted_line("source_channel", "order_paid_date", "sales_type",
                                          "order_type", params.as_of))
    return ol.select(
        R.normalize_channel("source_channel").alias("source_channel"),
        "order_paid_time",
        F.to_date("order_paid_date").alias("order_paid_date"),
        R.omni_member_id("type_name", "crm_member_detail_id", "type_value").alias("member_id"),
        R.numeric_id("crm_member_detail_id").alias("crm_key"),
        F.col("type_value").cast("string").alias("type_value"),
        "parent_order_id", "sku_id", "city_cn", "city_tier", "sales_qty",
        "if_eff_order_tag", "is_member_order", "order_rrp_amt",
    )


def launch_of_any_channel():
    return F.least("lcs_launch_date", "tm_launch_date", "dy_launch_date", "bu_launch_date")


def tracking_ends(dims: Dims) -> DataFrame:
    """(sku_id, _fend): the last tracking day of each tracked SKU."""
    return broadcast_if(dims.focus.groupBy("sku_id").agg(F.max("tracking_end_date").alias("_fend")),
                        dims.small["focus"])


def with_product(lines: DataFrame, dims: Dims) -> DataFrame:
    """Left join of the (broadcast) product dimension."""
    return lines.join(dims.product, "sku_id", "left")


SKEW_COLUMNS = {"crm_key": "crm_key", "type_value": "type_value"}


def key_skew(rows: DataFrame, params: RunParams) -> dict[str, Skew]:
    """Hot and missing member keys and channel ids of lines or of the order summary."""
    return find_skew(rows, SKEW_COLUMNS, params.hot_share)


def enrich(lines: DataFrame, dims: Dims, params: RunParams, skew: dict[str, Skew],
           with_product_done: bool = False) -> DataFrame:
    """All dimension joins; returns FACT_COLUMNS. ``skew``: see key_skew. The shuffle joins
    by member and channel id come first, while lines are narrow; the columns of product,
    calendar and city are not shuffled with them, nor joined once for each of their branches."""
    seed = ["parent_order_id", "sku_id"]
    x = left_join_skewed(lines, F.col("crm_key"), [(dims.member, "member_key")],
                         seed, skew["crm_key"], params.null_bypass_share)
    x = left_join_skewed(x, F.col("type_value"), [(dims.tmall, "kyid"), (dims.douyin, "openid")],
                         seed, skew["type_value"], params.null_bypass_share)
    x = x if with_product_done else with_product(x, dims)
    x = x.join(dims.calendar, x.order_paid_date == dims.calendar.date_id, "left")
    x = x.join(dims.city, "city_cn", "left")
    return x.select(
        "source_channel", "order_paid_time", "order_paid_date", "fiscal_year",
        "fiscal_month", "fiscal_week", "member_id", "member_detail_id", "join_date",
        "tmall_bind_date", "douyin_bind_date", "eff_reg_channel", "parent_order_id",
        "sku_id", "sku_name", "bu_launch_date", "lcs_launch_date", "tm_launch_date",
        "dy_launch_date", "product_line", "rsp", "age_mark",
        R.kids_vs_adult("min_age").alias("kids_vs_adult"), "price_band",
        R.or_default("city_tier", C.CITY_TIER_DEFAULT).alias("city_tier"),
        R.or_default("city_maturity_type", C.CITY_MATURITY_DEFAULT).alias("city_maturity_type"),
        "sales_qty", "if_eff_order_tag", "is_member_order", "order_rrp_amt",
    )


def fact_enriched(inputs: Inputs, params: RunParams, dims: Dims | None = None) -> DataFrame:
    dims = dims or build_dims(inputs, params)
    lines = admitted_lines(inputs.order_line, params)
    return enrich(lines, dims, params, key_skew(lines, params))
