"""Plan shape: no pair-producing joins, pushdown into the fact scan, NULL
keys spread over partitions, size-checked broadcast."""

import dataclasses
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from launchboard.config import ANALYST_DEFAULTS
from launchboard.operators.fact import admitted_lines, fact_enriched
from launchboard.operators.joins import Skew, find_skew, left_join_skewed, proven_small
from launchboard.plans import catalog
from launchboard.sources.tables import NAMES, Inputs


@pytest.mark.parametrize("key", ["fact_enriched", "order_rank", "kpi_launch_window",
                                 "kpi_launch_week", "benchmark_all", "scorecard_8w"])
def test_no_nested_loop_or_cartesian(key, spark, sf_dir):
    plan = catalog.QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert "Expand" not in plan          # no COUNT(DISTINCT) row copies


def test_fact_filters_reach_the_scan(spark, sf_dir):
    """With the inputs stored as tables, the channel and closed-day filters are
    pushed into the Parquet scan and only used columns are read."""
    inp = Inputs.from_testdata(spark, sf_dir)
    base = tempfile.mkdtemp(prefix="lb-push-")
    inp.order_line.write.parquet(base + "/order_line")
    real = spark.read.parquet(base + "/order_line")
    lines = admitted_lines(real, ANALYST_DEFAULTS).select("parent_order_id", "sales_qty")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "In(source_channel" in pushed and "LessThan(order_paid_date" in pushed
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "city_cn" not in schema and "order_rrp_amt" not in schema


def test_null_keys_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # measure the shuffle join
    try:
        left = spark.range(20000).select(
            F.col("id").alias("parent_order_id"), F.col("id").alias("sku_id"),
            F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))   # 90% NULL keys
        right = spark.range(0, 20000, 10).select(F.col("id").alias("rk"), F.lit(1).alias("v"))
        out = left_join_skewed(left, F.col("k"), [(right, "rk")], ["parent_order_id", "sku_id"], Skew(0.9))
        assert out.where("v = 1").count() == 2000 and out.count() == 20000
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(sizes) < 0.3 * 20000     # no partition holds the NULL-key rows
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_proven_small_counts_bytes(spark):
    text = spark.range(5).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert proven_small({"t": text}, 500) == {"t": False}
    got = proven_small({"a": spark.range(5), "b": spark.range(50), "c": spark.range(0)}, 160)
    assert got == {"a": True, "b": False, "c": True}


def test_hot_key_is_split_and_matches_are_unchanged(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # measure the shuffle join
    try:
        n = 30000
        left = spark.range(n).select(
            F.col("id").alias("parent_order_id"), F.col("id").alias("sku_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"))
        right = spark.range(1000).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("v"))
        right = right.unionByName(spark.range(1).select(F.lit(7).cast("bigint").alias("rk"),
                                                        F.lit(-1).cast("bigint").alias("v")))
        plain = left.join(right, left.k == right.rk, "left").select("parent_order_id", "v")
        salted = left_join_skewed(left, F.col("k"), [(right, "rk")], ["parent_order_id", "sku_id"],
                                  find_skew(left, {"k": "k"}, 0.05)["k"])
        a = sorted(map(tuple, plain.collect()), key=lambda r: (r[0], r[1] is None, r[1] or 0))
        b = sorted(map(tuple, salted.select("parent_order_id", "v").collect()),
                   key=lambda r: (r[0], r[1] is None, r[1] or 0))
        assert a == b
        sizes = [r["c"] for r in salted.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("c")).collect()]
        assert max(sizes) < 0.25 * len(a)   # the key holding a third is split
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_joined_with_products_once_and_last(spark, sf_dir):
    """The joins by member and channel id shuffle narrow lines: above them, not in each of
    their branches, products are joined."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        params = dataclasses.replace(ANALYST_DEFAULTS, max_broadcast_bytes=0, null_bypass_share=0.05)
        found = fact_enriched(Inputs.from_testdata(spark, sf_dir), params)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan     # keyless lines have a branch of their own
        joins = re.findall(r"Join LeftOuter, \((\w+)#\d+L? = (\w+)#", plan)
        assert [sorted(j) for j in joins].count(["sku_id", "sku_id"]) == 1
        depth = {k: min(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if k in line)
                 for k in ("(sku_id#", "Union")}
        assert depth["(sku_id#"] < depth["Union"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
