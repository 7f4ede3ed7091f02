"""Registered queries vs their DuckDB oracle on the smallest test tables.

Set LAUNCHBOARD_ALL_QUERIES=1 to check every registered query (slower)."""

import os

import pytest

from launchboard.plans import catalog
from tests.compare import diff

CORE = ["dim_product", "fact_enriched", "order_rank", "order_pieces", "kpi_launch_week",
        "benchmark_all", "scorecard_8w"]
KEYS = list(catalog.QUERIES) if os.environ.get("LAUNCHBOARD_ALL_QUERIES") else CORE


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(key, spark, sf_dir, con):
    d = diff(catalog.QUERIES[key](spark, sf_dir), con, catalog.ORACLE[key])
    assert d is None, d


def test_scorecard_invariants(spark, sf_dir):
    from pyspark.sql import functions as F
    df = catalog.QUERIES["scorecard_8w"](spark, sf_dir)
    bad = df.where(
        (F.col("multiple_units_per_order_penetration") > 1)
        | (F.col("pure_new_0_1_purchase_member_shopper") > F.col("member_shopper"))
        | (F.col("existing_0_1_member_shopper") > F.col("member_shopper"))
        | (F.col("lifetime_repurchase_member_shopper") > F.col("member_shopper"))
        | (F.col("pure_new_0_1_purchase_member_shopper_share") > 1)).count()
    assert bad == 0
