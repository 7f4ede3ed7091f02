"""Order-level summary of the fact: one scan, one partial aggregation.

Rank, order pieces and benchmarks all need the fact only at order grain, so
the lines are reduced once to one row per (order, channel, member id, CRM
key, channel id, paid date), combined map-side before the shuffle (a hot
order or member costs one row per map task). Each consumer then reads this
summary instead of scanning the fact again; ``scorecard.prepare`` can
checkpoint it so both dashboard tables share it.

Columns:
  parent_order_id, source_channel, member_id, crm_key, type_value, day
  elig_time    earliest paid time among effective member lines (NULL: none)
  has_elig     the group has an effective member line
  has_member   the group has a member line (is_member_order true)
  member_qty   sum of sales_qty over member lines, times the fan-out of the
               broadcast dimensions (product, calendar, city)
  <launch>_min / <launch>_max  earliest / latest launch date of the sold
               SKUs on effective member lines, for each launch column the
               benchmark specs compare
  tracked      the group has a line of a tracked SKU inside its widest window: only
               orders with one feed the KPIs
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard.config import RunParams
from launchboard.functions.rules import is_true
from launchboard.operators.fact import Dims, launch_of_any_channel, tracking_ends
from launchboard.operators.joins import broadcast_if

GROUP = ["parent_order_id", "source_channel", "member_id", "crm_key", "type_value", "day"]


def launch_columns(params: RunParams) -> list[str]:
    return sorted({s.launch_cmp for s in params.benchmark_specs})


def key_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def tracked_orders(summary: DataFrame) -> DataFrame:
    """(parent_order_id) of the orders with a tracked line; lines without an order id
    join nothing."""
    return summary.where(F.col("tracked") & F.col("parent_order_id").isNotNull()).select(
        "parent_order_id").distinct()


def of_orders(rows: DataFrame, orders: DataFrame, proven: bool) -> DataFrame:
    """Rows of some orders alone: a semi join, without a shuffle of the rows where the
    order ids are few enough to broadcast (else Spark adds a Bloom filter of its own)."""
    return rows.join(broadcast_if(orders, proven), "parent_order_id", "left_semi")


def order_summary(lines: DataFrame, dims: Dims, params: RunParams) -> DataFrame:
    launches = launch_columns(params)
    ends = tracking_ends(dims).withColumnRenamed("sku_id", "_fsku")
    # product rows are joined as they are: a SKU listed twice doubles its
    # lines here exactly as in the enriched fact
    prod = dims.product.select("sku_id", *launches, launch_of_any_channel().alias("_opens"))
    cn = broadcast_if(key_counts(dims.calendar, "date_id", "_n_cal"), dims.small["calendar"])
    yn = broadcast_if(key_counts(dims.city, "city_cn", "_n_city"), dims.small["city"])
    x = lines.join(prod, "sku_id", "left").join(ends, F.col("sku_id") == F.col("_fsku"), "left")
    x = x.join(cn, x.order_paid_date == cn.date_id, "left").drop("date_id")
    x = x.join(yn, "city_cn", "left")
    mult = F.coalesce("_n_cal", F.lit(1)) * F.coalesce("_n_city", F.lit(1))
    member_line = is_true("is_member_order")
    elig = member_line & is_true("if_eff_order_tag")
    x = x.withColumn("day", F.col("order_paid_date"))
    aggs = [
        F.min(F.when(elig, F.col("order_paid_time"))).alias("elig_time"),
        F.max(elig).alias("has_elig"),
        F.max(member_line).alias("has_member"),
        F.max(is_true(F.col("day").between(F.col("_opens"), F.col("_fend")))).alias("tracked"),
        F.sum(F.when(member_line, F.col("sales_qty").cast("bigint") * mult)).alias("member_qty"),
    ]
    for c in launches:
        aggs.append(F.min(F.when(elig, F.col(c))).alias(f"{c}_min"))
        aggs.append(F.max(F.when(elig, F.col(c))).alias(f"{c}_max"))
    return x.groupBy(*GROUP).agg(*aggs)
