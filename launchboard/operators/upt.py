"""Units per order (UPT): pieces of each order over its member lines, all
SKUs, channels and dates.

The dashboard sums ``sales_qty`` over the *enriched* fact, so a line counts
once per matching row of every left-joined dimension (fan-out). Instead of
enriching every line, the multiplicity is applied from per-key row counts:
the order summary already carries the member quantity times the fan-out of
the broadcast dimensions; here it is summed to (order, member key, channel
id) and multiplied by the row counts of the large member and binding
tables, joined at that order level, not per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard.config import RunParams
from launchboard.functions.rules import is_true
from launchboard.operators.fact import Dims
from launchboard.operators.joins import Skew, left_join_skewed
from launchboard.operators.orders import key_counts


def large_dim_multiplier(rows: DataFrame, dims: Dims, params: RunParams,
                         skew: dict[str, Skew]) -> DataFrame:
    """Adds ``_mult_large``: fan-out from the member and binding joins, for
    rows carrying ``crm_key`` and ``type_value`` (order-level rows)."""
    seed = ["parent_order_id"]
    x = left_join_skewed(rows, F.col("crm_key"),
                         [(key_counts(dims.member, "member_key", "_n_mem"), "member_key")],
                         seed, skew["crm_key"]).drop("member_key")
    x = left_join_skewed(x, F.col("type_value"),
                         [(key_counts(dims.tmall, "kyid", "_n_tm"), "kyid"),
                          (key_counts(dims.douyin, "openid", "_n_dy"), "openid")],
                         seed, skew["type_value"]).drop("kyid", "openid")
    mult = (F.coalesce("_n_mem", F.lit(1)) * F.coalesce("_n_tm", F.lit(1))
            * F.coalesce("_n_dy", F.lit(1)))
    return x.withColumn("_mult_large", mult).drop("_n_mem", "_n_tm", "_n_dy")


def order_pieces(summary: DataFrame, dims: Dims, params: RunParams,
                 skew: dict[str, Skew]) -> DataFrame:
    """(parent_order_id, pieces) from the order summary."""
    m = summary.where(F.col("has_member"))
    per_key = m.groupBy("parent_order_id", "crm_key", "type_value").agg(
        F.sum("member_qty").alias("_q"))
    per_key = large_dim_multiplier(per_key, dims, params, skew)
    return per_key.groupBy("parent_order_id").agg(
        F.sum(F.col("_q") * F.col("_mult_large")).alias("pieces"))


def order_pieces_from_fact(fact: DataFrame) -> DataFrame:
    """Direct form over the enriched fact (reference form for tests)."""
    return fact.where(is_true("is_member_order")).groupBy("parent_order_id").agg(
        F.sum(F.col("sales_qty").cast("bigint")).alias("pieces"))
