"""Build the eight input tables of the dashboard from the driver's test tables.

The production inputs are warehouse tables (order lines, members, platform
bindings, product master, retail calendar, stores, city lookup, tracked SKU
list). The test data is a TPC-H-like star schema; the mapping below derives
each input from it with deterministic rules (FIXTURES.md), so that Spark and
the DuckDB oracle start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test-data mapping.
BASE_JOIN_DATE = "1995-06-01"
BASE_LAUNCH_DATE = "1996-01-01"


_READ_CACHE: dict[str, tuple[SparkSession, DataFrame]] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet reader, memoised per session and path: the lazy plan is reused,
    so file listing and schema inference run once per table. A different
    session object reads again."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _READ_CACHE.get(path)
    if hit is None or hit[0] is not spark:
        _READ_CACHE[path] = (spark, spark.read.parquet(path))
    return _READ_CACHE[path][1]


def _days_after(base: str, n: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), n.cast("int"))


def _time_of(day: Column, hour: Column) -> Column:
    return F.timestamp_add("HOUR", hour.cast("int"), day.cast("timestamp_ntz"))


def _s(c: Column) -> Column:
    return c.cast("string")


def order_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    o = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    prio, cust, ret = F.col("o_orderpriority"), F.col("o_custkey"), F.col("l_returnflag")
    return j.select(
        F.when(prio == "1-URGENT", "LCS").when(prio == "2-HIGH", "TMALL")
         .when(prio == "3-MEDIUM", "DOUYIN").when(prio == "4-NOT SPECIFIED", "DOUYIN_B2B")
         .otherwise("OTHER").alias("source_channel"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_paid_time"),
        F.col("o_orderdate").cast("date").alias("order_paid_date"),
        F.when(F.col("o_orderkey") % 89 != 0, F.concat(F.lit("O-"), _s(F.col("o_orderkey"))))
         .alias("parent_order_id"),
        F.col("l_partkey").cast("bigint").alias("sku_id"),
        (F.col("l_linenumber") % 4).cast("int").alias("sales_type"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0), "presale")
         .otherwise("normal").alias("order_type"),
        F.when(cust % 7 == 0, "GUEST").when(prio == "1-URGENT", "CRM_memberid")
         .when(prio == "2-HIGH", "TMALL_kyid").otherwise("DY_openid").alias("type_name"),
        F.concat(F.when(prio == "2-HIGH", "k")
                  .when(prio.isin("3-MEDIUM", "4-NOT SPECIFIED"), "d").otherwise("m"),
                 _s(cust)).alias("type_value"),
        # now and then one line of an order carries another member's id
        F.when(cust % 3 == 0, F.lit(None).cast("string"))
         .when((F.col("o_orderkey") % 23 == 0) & (F.col("l_linenumber") == 2), _s(cust + 1))
         .otherwise(_s(cust)).alias("crm_member_detail_id"),
        F.when(ret == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
         .cast("int").alias("sales_qty"),
        (~((prio == "1-URGENT") & (ret == "R"))).alias("if_eff_order_tag"),
        # some guests are flagged as members: eligible lines without a member id
        F.when(cust % 41 == 0, F.lit(None).cast("boolean"))
         .otherwise((cust % 7 != 0) | (cust % 35 == 0))
         .alias("is_member_order"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("order_rrp_amt"),
        F.concat(F.lit("NATION_"), _s(cust % 25)).alias("city_cn"),
        F.when(cust % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("T"), _s(cust % 4))).alias("city_tier"),
    )


def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.where(k % 13 != 0).select(
        _s(k).alias("member_detail_id"),
        _time_of(_days_after(BASE_JOIN_DATE, k * 37 % 1500), k % 24).alias("join_time"),
        F.col("c_mktsegment").alias("eff_reg_channel"),
    )


def shopper_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # k=0 tmall, k=1 douyin, k=2 a second tmall bind time, k=3 wrong platform,
    # k=4 a later tmall bind time of the first day
    c = _read(spark, sf_dir, "customer").select("c_custkey")
    x = c.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(5)])))
    key, kk = F.col("c_custkey"), F.col("k")
    x = x.where((kk < 2) | ((kk == 2) & (key % 11 == 0)) | ((kk == 3) & (key % 17 == 0))
                | ((kk == 4) & (key % 19 == 0)))
    return x.select(
        F.concat(F.when(kk == 1, "d").otherwise("k"), _s(key)).alias("platform_id_value"),
        F.when(kk == 1, "openId").otherwise("kyid").alias("platform_id_type"),
        F.when(kk.isin(1, 3), "douyin").otherwise("taobao").alias("platformid"),
        _time_of(_days_after(BASE_JOIN_DATE, key * 53 % 1500 + F.when(kk < 4, kk * 30).otherwise(0)),
                 F.when(kk < 4, 9).otherwise(18)).alias("first_bind_time"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    base = k * 37 % 1000
    null_date = F.lit(None).cast("date")
    return p.select(
        k.cast("bigint").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.when(k % 31 == 0, null_date).otherwise(_days_after(BASE_LAUNCH_DATE, base))
         .alias("lcs_launch_date"),
        F.when(k % 6 == 0, _days_after(BASE_LAUNCH_DATE, base - 3))
         .when(k % 6 == 1, _days_after(BASE_LAUNCH_DATE, base + 3))
         .otherwise(null_date).alias("lcs_on_street_date"),
        _days_after(BASE_LAUNCH_DATE, base + (k % 3) * 7 - 7).alias("tm_launch_date"),
        F.when(k % 4 == 0, null_date)
         .otherwise(_days_after(BASE_LAUNCH_DATE, base + (k % 5) * 7 - 14))
         .alias("dy_brand_launch_date"),
        F.when(k % 3 == 0, null_date)
         .otherwise(_days_after(BASE_LAUNCH_DATE, base + (k % 7) * 7 - 21))
         .alias("dy_family_launch_date"),
        F.col("p_brand").alias("product_line"),
        F.when(k % 50 == 49, F.lit(None).cast("decimal(18,2)"))
         .otherwise((k % 100 * 12).cast("decimal(18,2)")).alias("rsp"),
        F.when(size % 6 == 0, F.concat(_s(size), F.lit("+")))
         .when(size % 6 == 1, F.concat(_s(size), F.lit(" 1/2")))
         .when(size % 6 == 2, F.concat(F.lit(" "), _s(size), F.lit(" ")))
         .when(size % 6 == 3, F.lit("N/A"))
         .when(size % 6 == 4, F.concat(_s(size), F.lit("-"), _s(size + 3)))
         .otherwise(F.lit("1/2")).alias("age_mark"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _read(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("d")).distinct()
    x = days.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    x = x.where((F.col("k") == 0) | (F.dayofmonth("d") == 1))
    return x.select(
        F.col("d").alias("date_id"),
        F.when(F.col("k") == 0, "day").otherwise("month").alias("date_type"),
        F.year("d").cast("int").alias("fiscal_year"),
        F.month("d").cast("int").alias("fiscal_month"),
        F.weekofyear("d").cast("int").alias("fiscal_week"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").select("s_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_name").alias("city_cn"))


def city_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    return n.where(F.col("n_nationkey") % 5 != 0).select(
        F.col("n_name").alias("city_chn"),
        F.concat(_s(F.col("n_regionkey") % 3 + 1), F.lit("_tier")).alias("city_type"),
    )


def focus_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.where(k % 5 == 2).select(
        k.cast("bigint").alias("sku_id"),
        _days_after(BASE_LAUNCH_DATE, k * 37 % 1000 + 400).alias("tracking_end_date"),
    )


BUILDERS = {
    "order_line": order_line,
    "member": member,
    "shopper_binding": shopper_binding,
    "product": product,
    "calendar": calendar,
    "store": store,
    "city_type": city_type,
    "focus_sku": focus_sku,
}
