"""Per-channel launch KPIs, over the tracking window or per retail week.

One generic builder runs every branch of ``config.KPI_SPECS``. Plan:

1. Only lines of tracked SKUs inside [earliest launch, tracking end] are
   enriched (product and focus list are broadcast, so the pruning happens
   map-side before any shuffle).
2. Each branch keeps its lines from its own launch day on and joins the
   focus list (SKU equal, paid date not after the tracking end).
3. Rank flags (of every slice, side by side) and order pieces come from one
   order-level relation, joined once on the order id.
4. Distinct counts are taken in levels instead of six COUNT(DISTINCT)
   expressions (which Spark would expand into seven copies of every row): lines are
   reduced once, to one row per (week keys, member) with the member's flags and one per
   (week keys, order) with sums and the multi-unit flag (``state``). The week grain sums
   these rows; the window grain merges each member's and order's weeks first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard import config as C
from launchboard.config import KpiSpec, RunParams
from launchboard.functions import rules as R
from launchboard.operators.fact import (
    Dims, enrich, launch_of_any_channel, tracking_ends, with_product)
from launchboard.operators import ranks as RK
from launchboard.operators.joins import Skew, left_join_skewed

WINDOW_KEYS = ("source_channel", "sku_id", "sku_name", "product_line", "launch_date",
               "tracking_end_date", "rsp", "price_band", "age_mark", "kids_vs_adult")
WEEK_KEYS = WINDOW_KEYS + ("fiscal_year", "fiscal_week")

KPI_OUTPUT = WINDOW_KEYS + C.METRIC_COLUMNS
KPI_WEEK_OUTPUT = WEEK_KEYS + C.METRIC_COLUMNS


def tracking_bounds(dims: Dims):
    """(first launch day, last tracking day) of all tracked SKUs, two values."""
    r = dims.product.join(dims.focus, "sku_id").agg(
        F.min(launch_of_any_channel()).alias("lo"), F.max("tracking_end_date").alias("hi")).first()
    return r["lo"], r["hi"]


def tracked_lines(lines: DataFrame, dims: Dims, params: RunParams,
                  skew: dict[str, Skew]) -> DataFrame:
    """Enriched lines of tracked SKUs inside their widest possible window. The
    days that any tracked SKU can need bound the scan as two literals, which
    reach the reader and prune partitions."""
    lo, hi = tracking_bounds(dims)
    day = F.col("order_paid_date")
    lines = lines.where(F.lit(False) if lo is None or hi is None else
                        (day >= F.lit(lo)) & (day <= F.lit(hi)))
    x = with_product(lines, dims).join(tracking_ends(dims), "sku_id")
    earliest = launch_of_any_channel()
    x = x.where((F.col("order_paid_date") <= F.col("_fend"))
                & (F.col("order_paid_date") >= earliest)).drop("_fend")
    return enrich(x, dims, params, skew, with_product_done=True)


LINE_COLS = ["order_paid_date", "parent_order_id", "member_id", "sku_id", "sku_name",
             "product_line", "rsp", "price_band", "age_mark", "kids_vs_adult", "fiscal_year",
             "fiscal_week", "sales_qty", "if_eff_order_tag", "is_member_order", "order_rrp_amt",
             "pieces"]


def branch_rows(rows: DataFrame, specs: tuple[KpiSpec, ...]) -> DataFrame:
    """Each line once per branch it feeds (its channel's branch and OMNI),
    from one pass (``explode``), from the branch's own launch day on. Each
    branch takes the rank flags of its own slice from the order columns."""
    structs = []
    for s in specs:
        cond = F.col("order_paid_date") >= F.col(s.launch)
        if s.rows is not None:
            cond = cond & (F.col("source_channel") == s.rows)
        n, first, repeat = RK.flag_columns(s.rank_slice)
        structs.append(F.when(cond, F.struct(
            F.lit(s.label).alias("source_channel"),
            F.col(s.launch).alias("launch_date"), F.col(s.joined).alias("joined_date"),
            F.col(s.launch_cmp).alias("launch_cmp"), F.col(n).alias("n_rank"),
            F.col(first).alias("any_first"), F.col(repeat).alias("any_repeat"))))
    arr = F.filter(F.array(*structs), lambda v: v.isNotNull())
    x = rows.select(*LINE_COLS, F.explode(arr).alias("_b"))
    return x.select("_b.*", *LINE_COLS)


def kpi_rows(lines: DataFrame, dims: Dims, info: DataFrame, params: RunParams,
             specs: tuple[KpiSpec, ...], skew: dict[str, Skew]) -> DataFrame:
    """Line rows of all branches with tracking end, rank flags and pieces.
    ``info`` is ``ranks.order_info`` (one row per order): a single join, in
    which lines without an order id are spread."""
    t = left_join_skewed(
        tracked_lines(lines, dims, params, skew), F.col("parent_order_id"),
        [(info.withColumnRenamed("parent_order_id", "_oid"), "_oid")],
        ["sku_id", "member_id", "order_paid_time", "order_rrp_amt"], skew["parent_order_id"]).drop("_oid")
    b = branch_rows(t, specs)
    focus = dims.focus.select(F.col("sku_id").alias("_fsku"), "tracking_end_date")
    return b.join(focus, (F.col("sku_id") == F.col("_fsku"))
                  & (F.col("order_paid_date") <= F.col("tracking_end_date"))).drop("_fsku")


SUMS = ("_units", "_pos", "_neg", "_mpos", "_mneg")
FLAGS = ("_multi", "_pn", "_ex", "_rp")


def state(rows: DataFrame) -> DataFrame:
    """What both grains are computed from: one row per week keys and member (kind m) or
    order (kind o), with an order's sums and multi-unit flag and a member's three flags.
    Every line feeds one row of each kind; they share one exchange of the lines."""
    weight = F.coalesce(F.col("n_rank"), F.lit(1)).cast("bigint")
    qty, amt = F.col("sales_qty"), F.col("order_rrp_amt")
    member_line = R.is_true("is_member_order")
    elig = member_line & R.is_true("if_eff_order_tag") & F.col("member_id").isNotNull()
    of_order = F.struct(F.lit("o").alias("kind"), F.col("parent_order_id").cast("string").alias("id"))
    of_member = F.when(elig, F.struct(F.lit("m").alias("kind"), F.col("member_id").cast("string").alias("id")))
    first, repeat = R.is_true("any_first"), R.is_true("any_repeat")
    line = rows.select(
        *WEEK_KEYS, F.explode(F.array_compact(F.array(of_order, of_member))).alias("_of"),
        qty.alias("_qty"), amt.alias("_amt"), weight.alias("_w"), member_line.alias("_member"),
        (F.col("pieces") >= 2).alias("_many"), (first & (F.col("launch_cmp") <= F.col("joined_date"))).alias("_is_pn"),
        (first & (F.col("launch_cmp") > F.col("joined_date"))).alias("_is_ex"), repeat.alias("_is_rp"))
    order = F.col("_of.kind") == "o"

    # sums carry the fan-out weight of the rank join
    def total(cond, value):
        return F.sum(F.when(order, F.when(cond, value * F.col("_w")).otherwise(F.lit(0))))

    def flag(kind, name):
        return F.coalesce(F.max((F.col("_of.kind") == kind) & F.col(name)), F.lit(False))

    sold, returned = F.col("_qty") > 0, F.col("_qty") < 0
    return line.groupBy(*WEEK_KEYS, F.col("_of.kind").alias("kind"), F.col("_of.id").alias("id")).agg(
        F.sum(F.when(order, F.col("_qty").cast("bigint") * F.col("_w"))).alias("_units"),
        total(sold, F.col("_amt")).alias("_pos"), total(returned, F.abs("_amt")).alias("_neg"),
        total(F.col("_member") & sold, F.col("_amt")).alias("_mpos"),
        total(F.col("_member") & returned, F.abs("_amt")).alias("_mneg"),
        flag("o", "_many").alias("_multi"), flag("m", "_is_pn").alias("_pn"),
        flag("m", "_is_ex").alias("_ex"), flag("m", "_is_rp").alias("_rp"))


def aggregate(states: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """KPIs of the window or the week grain from ``state``. Members and orders of several
    weeks are reduced to one row of the window first: distinct counts do not add up."""
    keys = list(keys)
    if "fiscal_week" not in keys:
        states = states.groupBy(*keys, "kind", "id").agg(
            *[F.sum(c).alias(c) for c in SUMS], *[F.max(c).alias(c) for c in FLAGS])
    order = (F.col("kind") == "o") & F.col("id").isNotNull()
    member = F.col("kind") == "m"

    def count(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    g = states.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        count(order).alias("_orders"), count(order & F.col("_multi")).alias("_multi"),
        count(member).alias("_shoppers"),
        *[count(member & F.col(c)).alias(c) for c in ("_pn", "_ex", "_rp")])
    # groups come only from rows, so every group has an order-level row

    shoppers = F.coalesce(F.col("_shoppers"), F.lit(0))
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("_pn", "_ex", "_rp")}
    return g.select(
        *keys,
        F.col("_units").cast("bigint").alias("units_sold"),
        R.safe_ratio("_multi", "_orders").alias("multiple_units_per_order_penetration"),
        R.safe_ratio((F.col("_mpos") - F.col("_mneg")).cast("double"),
                     (F.col("_pos") - F.col("_neg")).cast("double")).alias("member_sales_share"),
        R.zero_to_null(shoppers).cast("bigint").alias("member_shopper"),
        counts["_pn"].cast("double").alias("pure_new_0_1_purchase_member_shopper"),
        R.safe_ratio(counts["_pn"], shoppers).alias("pure_new_0_1_purchase_member_shopper_share"),
        counts["_ex"].cast("double").alias("existing_0_1_member_shopper"),
        R.safe_ratio(counts["_ex"], shoppers).alias("existing_0_1_member_shopper_share"),
        counts["_rp"].cast("double").alias("lifetime_repurchase_member_shopper"),
        R.safe_ratio(counts["_rp"], shoppers).alias("lifetime_repurchase_member_shopper_share"),
    )
