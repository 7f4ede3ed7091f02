"""Dimension relations: product, calendar, platform bindings, city maturity,
tracked SKU periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchboard import config as C
from launchboard.functions import rules as R

PRODUCT_COLUMNS = (
    "sku_id", "sku_name", "lcs_launch_date", "tm_launch_date", "dy_launch_date",
    "bu_launch_date", "product_line", "rsp", "age_mark", "min_age", "price_band",
)


def dim_product(product: DataFrame) -> DataFrame:
    """Product master with the derived launch dates, age and price band;
    products whose age mark does not start with a number are left out."""
    p = product.where(R.age_mark_admitted("age_mark"))
    p = p.select(
        "sku_id", "sku_name",
        R.lcs_launch("lcs_launch_date", "lcs_on_street_date").alias("lcs_launch_date"),
        F.col("tm_launch_date"),
        R.douyin_launch("dy_brand_launch_date", "dy_family_launch_date").alias("dy_launch_date"),
        "product_line", "rsp", "age_mark",
        R.min_age("age_mark").alias("min_age"),
        R.price_band("rsp").alias("price_band"),
    )
    p = p.withColumn("bu_launch_date",
                     R.brand_launch("lcs_launch_date", "tm_launch_date", "dy_launch_date"))
    return p.select(*PRODUCT_COLUMNS)


def calendar_days(calendar: DataFrame) -> DataFrame:
    return calendar.where(F.col("date_type") == C.CALENDAR_DAY_TYPE).select(
        "date_id", "fiscal_year", "fiscal_month", "fiscal_week")


def _bindings(shopper_binding: DataFrame, id_type: str, platform: str, name: str,
              date_name: str) -> DataFrame:
    return (shopper_binding
            .where((F.col("platform_id_type") == id_type) & (F.col("platformid") == platform))
            .select(F.col("platform_id_value").alias(name),
                    F.col("first_bind_time").alias("_bind_time"))
            .distinct()
            .select(name, F.to_date("_bind_time").alias(date_name)))


def tmall_bindings(shopper_binding: DataFrame) -> DataFrame:
    """Distinct (Tmall id, first bind time); an id with two times stays twice."""
    return _bindings(shopper_binding, *C.TMALL_BIND, "kyid", "tmall_bind_date")


def douyin_bindings(shopper_binding: DataFrame) -> DataFrame:
    return _bindings(shopper_binding, *C.DOUYIN_BIND, "openid", "douyin_bind_date")


def city_maturity(store: DataFrame, city_type: DataFrame) -> DataFrame:
    """Distinct (store city, maturity type); unmatched cities keep a NULL type."""
    j = store.join(city_type, store.city_cn == city_type.city_chn, "left")
    return j.select(store.city_cn, F.col("city_type").alias("city_maturity_type")).distinct()


def focus_periods(product_dim: DataFrame, focus_sku: DataFrame) -> DataFrame:
    """Tracked SKUs with their product dates and tracking end (one row per
    focus-list row whose SKU passed the product filter)."""
    return product_dim.join(focus_sku, "sku_id").select(
        "sku_id", "bu_launch_date", "lcs_launch_date", "tm_launch_date", "dy_launch_date",
        "tracking_end_date")
