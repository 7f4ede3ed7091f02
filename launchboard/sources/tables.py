"""The eight inputs of a scorecard run, with their declared schemas.

``Inputs`` is a plain holder of DataFrames. Build it from the test mapping
(``from_testdata``), from catalog tables (``from_tables``) or from Parquet
folders (``from_parquet``). Every reader selects and casts to the declared
schema, so column pruning and pushed filters reach the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchboard.sources import fixtures

SCHEMAS: dict[str, dict[str, str]] = {
    "order_line": {
        "source_channel": "string",
        "order_paid_time": "timestamp_ntz",
        "order_paid_date": "date",
        "parent_order_id": "bigint",
        "sku_id": "bigint",
        "sales_type": "int",
        "order_type": "string",
        "type_name": "string",
        "type_value": "string",
        "crm_member_detail_id": "string",
        "sales_qty": "int",
        "if_eff_order_tag": "boolean",
        "is_member_order": "boolean",
        "order_rrp_amt": "decimal(18,2)",
        "city_cn": "string",
        "city_tier": "string",
    },
    "member": {"member_detail_id": "string", "join_time": "timestamp_ntz", "eff_reg_channel": "string"},
    "shopper_binding": {
        "platform_id_value": "string",
        "platform_id_type": "string",
        "platformid": "string",
        "first_bind_time": "timestamp_ntz",
    },
    "product": {
        "sku_id": "bigint",
        "sku_name": "string",
        "lcs_launch_date": "date",
        "lcs_on_street_date": "date",
        "tm_launch_date": "date",
        "dy_brand_launch_date": "date",
        "dy_family_launch_date": "date",
        "product_line": "string",
        "rsp": "decimal(18,2)",
        "age_mark": "string",
    },
    "calendar": {
        "date_id": "date",
        "date_type": "string",
        "fiscal_year": "int",
        "fiscal_month": "int",
        "fiscal_week": "int",
    },
    "store": {"city_cn": "string"},
    "city_type": {"city_chn": "string", "city_type": "string"},
    "focus_sku": {"sku_id": "bigint", "tracking_end_date": "date"},
}

NAMES = tuple(SCHEMAS)

# ids are only compared, grouped and ordered: they keep the type they are stored
# in (numbers or text), and the type above is that of the hand-made test rows
OWN_TYPE = ("parent_order_id", "sku_id")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns with their declared types (ids: their own)."""
    return df.select(*[F.col(c) if c in OWN_TYPE else F.col(c).cast(t).alias(c)
                       for c, t in SCHEMAS[name].items()])


@dataclass(frozen=True)
class Inputs:
    order_line: DataFrame
    member: DataFrame
    shopper_binding: DataFrame
    product: DataFrame
    calendar: DataFrame
    store: DataFrame
    city_type: DataFrame
    focus_sku: DataFrame

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        return cls(**{n: conform(fixtures.BUILDERS[n](spark, sf_dir), n) for n in NAMES})

    @classmethod
    def from_tables(cls, spark: SparkSession, table_names: dict[str, str]) -> "Inputs":
        """``table_names`` maps each input name to a catalog table."""
        return cls(**{n: conform(spark.table(table_names[n]), n) for n in NAMES})

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: dict[str, str]) -> "Inputs":
        return cls(**{n: conform(spark.read.parquet(paths[n]), n) for n in NAMES})
