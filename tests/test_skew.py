"""Join keys that are mostly missing or hot, at many partitions."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from launchboard.operators.joins import Skew, find_skew, left_join_skewed


@pytest.fixture
def many_partitions(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "2000"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(spark, n):
    """60 % of the rows have no key, 30 % one key, the rest some of 20,000."""
    turn = F.col("id") % 10
    key = F.when(turn < 6, None).when(turn < 9, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.xxhash64("id") % 20_000))
    return spark.range(n).select("id", key.alias("k"))


def sides(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("r"), F.col("id").alias("v"))
    hot = spark.createDataFrame([("hot", -1), ("hot", -2)], "r string, v long")
    return keys.unionByName(hot)


def test_largest_partition_follows_the_share(spark, many_partitions):
    n = 1_000_000
    left, right = rows(spark, n), sides(spark)
    skew = find_skew(left, {"k": "k"}, 0.001)["k"]
    assert skew.nulls == pytest.approx(0.6) and list(skew.hot) == ["hot"]
    out = left_join_skewed(left, F.col("k"), [(right, "r")], ["id"], skew, bypass_share=0.25)
    sizes = [r["c"] for r in out.where("k is not null").groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("c")).collect()]
    assert len(sizes) > 1900 and max(sizes) <= 3 * median(sizes)
    # a key of two partners doubles its rows, keyless rows stay once
    assert out.groupBy().agg(F.count(F.lit(1)), F.sum(F.col("k").isNull().cast("int")),
                             F.sum((F.col("k") == "hot").cast("int"))).first()[0:3] == (
        n + 3 * n // 10, 6 * n // 10, 6 * n // 10)


def test_keyless_rows_pass_no_shuffle(spark, many_partitions):
    left, right = rows(spark, 1000), spark.range(9).select(F.concat(F.lit("k"), F.col("id")).alias("r"))
    out = left_join_skewed(left, F.col("k"), [(right, "r")], ["id"], Skew(0.6), bypass_share=0.25)
    plan = out._jdf.queryExecution().executedPlan().toString()
    branch = plan[plan.rindex("Project"):] if "Union" in plan else ""
    assert "Union" in plan and "Exchange" not in branch
    spread = left_join_skewed(left, F.col("k"), [(right, "r")], ["id"], Skew(0.1), bypass_share=0.25)
    assert "Union" not in spread._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("skew, bypass", [(Skew(), 1.0), (Skew(0.6, {"hot": 0.3}), 1.0), (Skew(0.6, {"hot": 0.3}), 0.5),
                                          (Skew(1.0), 0.5), (Skew(0.6, {"hot": 0.3, "k1": 0.01}), 0.25)])
def test_rows_do_not_depend_on_the_skew(spark, skew, bypass):
    left, right = rows(spark, 3000), sides(spark)
    other = right.select(F.col("r").alias("r2"), (F.col("v") + 7).alias("w"))
    if skew.nulls == 1.0:
        left = left.where("k is null")
    plain = left.join(right, left.k == right.r, "left").join(other, left.k == other.r2, "left")
    joined = left_join_skewed(left, F.col("k"), [(right, "r"), (other, "r2")], ["id"], skew, bypass)
    assert joined.columns == plain.columns and joined.dtypes == plain.dtypes
    key = lambda r: repr(tuple(r))
    assert sorted(joined.collect(), key=key) == sorted(plain.collect(), key=key)


def test_no_rows(spark):
    none = rows(spark, 10).where("false")
    assert find_skew(none, {"k": "k"}, 0.01) == {"k": Skew()}
