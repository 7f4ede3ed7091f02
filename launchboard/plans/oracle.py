"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written as plain relational SQL over the driver's tables: the test-data
mapping, then the dashboard semantics in their most direct form (ROW_NUMBER,
COUNT(DISTINCT ...), the BETWEEN range join). It shares no code path with the
Spark operators, which use different physical formulations.
"""

from __future__ import annotations

AS_OF = "DATE '2001-07-01'"

# name -> (dependencies, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    _CTES[name] = (deps, body.strip())


# ---------------------------------------------------------------- test inputs
_cte("order_line", (), """
SELECT CASE o.o_orderpriority WHEN '1-URGENT' THEN 'LCS' WHEN '2-HIGH' THEN 'TMALL'
            WHEN '3-MEDIUM' THEN 'DOUYIN' WHEN '4-NOT SPECIFIED' THEN 'DOUYIN_B2B'
            ELSE 'OTHER' END AS source_channel,
       o.o_orderdate AS order_paid_time,
       CAST(o.o_orderdate AS DATE) AS order_paid_date,
       CASE WHEN o.o_orderkey % 89 <> 0 THEN 'O-' || CAST(o.o_orderkey AS VARCHAR) END AS parent_order_id,
       l.l_partkey AS sku_id,
       CAST(l.l_linenumber % 4 AS INT) AS sales_type,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 2 = 0 THEN 'presale' ELSE 'normal' END AS order_type,
       CASE WHEN o.o_custkey % 7 = 0 THEN 'GUEST' WHEN o.o_orderpriority = '1-URGENT' THEN 'CRM_memberid'
            WHEN o.o_orderpriority = '2-HIGH' THEN 'TMALL_kyid' ELSE 'DY_openid' END AS type_name,
       CASE WHEN o.o_orderpriority = '2-HIGH' THEN 'k'
            WHEN o.o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'd' ELSE 'm' END
         || CAST(o.o_custkey AS VARCHAR) AS type_value,
       CASE WHEN o.o_custkey % 3 = 0 THEN NULL
            WHEN o.o_orderkey % 23 = 0 AND l.l_linenumber = 2 THEN CAST(o.o_custkey + 1 AS VARCHAR)
            ELSE CAST(o.o_custkey AS VARCHAR) END AS crm_member_detail_id,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INT) AS sales_qty,
       NOT (o.o_orderpriority = '1-URGENT' AND l.l_returnflag = 'R') AS if_eff_order_tag,
       CASE WHEN o.o_custkey % 41 = 0 THEN NULL ELSE o.o_custkey % 7 <> 0 OR o.o_custkey % 35 = 0 END AS is_member_order,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_rrp_amt,
       'NATION_' || CAST(o.o_custkey % 25 AS VARCHAR) AS city_cn,
       CASE WHEN o.o_custkey % 10 = 0 THEN NULL ELSE 'T' || CAST(o.o_custkey % 4 AS VARCHAR) END AS city_tier
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")

_cte("member", (), """
SELECT CAST(c_custkey AS VARCHAR) AS member_detail_id,
       CAST(DATE '1995-06-01' + CAST(c_custkey * 37 % 1500 AS INT) AS TIMESTAMP)
         + to_hours(CAST(c_custkey % 24 AS INT)) AS join_time,
       c_mktsegment AS eff_reg_channel
FROM customer WHERE c_custkey % 13 <> 0
""")

_cte("shopper_binding", (), """
SELECT CASE WHEN k = 1 THEN 'd' ELSE 'k' END || CAST(c_custkey AS VARCHAR) AS platform_id_value,
       CASE WHEN k = 1 THEN 'openId' ELSE 'kyid' END AS platform_id_type,
       CASE WHEN k = 1 OR k = 3 THEN 'douyin' ELSE 'taobao' END AS platformid,
       CAST(DATE '1995-06-01' + CAST(c_custkey * 53 % 1500 + CASE WHEN k < 4 THEN k * 30 ELSE 0 END AS INT)
            AS TIMESTAMP) + to_hours(CASE WHEN k < 4 THEN 9 ELSE 18 END) AS first_bind_time
FROM customer CROSS JOIN (VALUES (0), (1), (2), (3), (4)) v(k)
WHERE k < 2 OR (k = 2 AND c_custkey % 11 = 0) OR (k = 3 AND c_custkey % 17 = 0)
   OR (k = 4 AND c_custkey % 19 = 0)
""")

_cte("product", (), """
SELECT p_partkey AS sku_id, p_name AS sku_name,
       CASE WHEN p_partkey % 31 = 0 THEN NULL
            ELSE DATE '1996-01-01' + CAST(p_partkey * 37 % 1000 AS INT) END AS lcs_launch_date,
       CASE p_partkey % 6 WHEN 0 THEN DATE '1996-01-01' + CAST(p_partkey * 37 % 1000 - 3 AS INT)
                          WHEN 1 THEN DATE '1996-01-01' + CAST(p_partkey * 37 % 1000 + 3 AS INT)
                          ELSE NULL END AS lcs_on_street_date,
       DATE '1996-01-01' + CAST(p_partkey * 37 % 1000 + (p_partkey % 3) * 7 - 7 AS INT) AS tm_launch_date,
       CASE WHEN p_partkey % 4 = 0 THEN NULL
            ELSE DATE '1996-01-01' + CAST(p_partkey * 37 % 1000 + (p_partkey % 5) * 7 - 14 AS INT) END AS dy_brand_launch_date,
       CASE WHEN p_partkey % 3 = 0 THEN NULL
            ELSE DATE '1996-01-01' + CAST(p_partkey * 37 % 1000 + (p_partkey % 7) * 7 - 21 AS INT) END AS dy_family_launch_date,
       p_brand AS product_line,
       CASE WHEN p_partkey % 50 = 49 THEN NULL ELSE CAST(p_partkey % 100 * 12 AS DECIMAL(18,2)) END AS rsp,
       CASE p_size % 6 WHEN 0 THEN CAST(p_size AS VARCHAR) || '+'
                       WHEN 1 THEN CAST(p_size AS VARCHAR) || ' 1/2'
                       WHEN 2 THEN ' ' || CAST(p_size AS VARCHAR) || ' '
                       WHEN 3 THEN 'N/A'
                       WHEN 4 THEN CAST(p_size AS VARCHAR) || '-' || CAST(p_size + 3 AS VARCHAR)
                       ELSE '1/2' END AS age_mark
FROM part
""")

_cte("calendar", (), """
SELECT d AS date_id, CASE WHEN k = 0 THEN 'day' ELSE 'month' END AS date_type,
       CAST(year(d) AS INT) AS fiscal_year, CAST(month(d) AS INT) AS fiscal_month,
       CAST(weekofyear(d) AS INT) AS fiscal_week
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x
CROSS JOIN (VALUES (0), (1)) v(k)
WHERE k = 0 OR day(d) = 1
""")

_cte("store", (), "SELECT n.n_name AS city_cn FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey")

_cte("city_type", (), """
SELECT n_name AS city_chn, CAST(n_regionkey % 3 + 1 AS VARCHAR) || '_tier' AS city_type
FROM nation WHERE n_nationkey % 5 <> 0
""")

_cte("focus_sku", (), """
SELECT p_partkey AS sku_id, DATE '1996-01-01' + CAST(p_partkey * 37 % 1000 + 400 AS INT) AS tracking_end_date
FROM part WHERE p_partkey % 5 = 2
""")

# ------------------------------------------------------------ dashboard logic
_cte("prod_parsed", ("product",), """
SELECT sku_id, sku_name, product_line, rsp, age_mark, trim(age_mark) AS age_t,
       CASE WHEN lcs_on_street_date IS NOT NULL AND lcs_launch_date >= lcs_on_street_date
            THEN lcs_on_street_date ELSE lcs_launch_date END AS lcs_launch_date,
       tm_launch_date,
       CASE WHEN dy_brand_launch_date IS NULL THEN dy_family_launch_date
            WHEN dy_family_launch_date IS NULL THEN dy_brand_launch_date
            WHEN dy_brand_launch_date <= dy_family_launch_date THEN dy_brand_launch_date
            ELSE dy_family_launch_date END AS dy_launch_date
FROM product
WHERE regexp_matches(trim(age_mark), '^[0-9]+([ ]*[0-9]*/[0-9]+)?')
""")

_cte("dim_product", ("prod_parsed",), """
SELECT sku_id, sku_name, lcs_launch_date, tm_launch_date, dy_launch_date,
       CASE WHEN lcs_launch_date IS NULL OR tm_launch_date IS NULL OR dy_launch_date IS NULL THEN NULL
            WHEN lcs_launch_date <= tm_launch_date AND lcs_launch_date <= dy_launch_date THEN lcs_launch_date
            WHEN tm_launch_date <= dy_launch_date THEN tm_launch_date
            ELSE dy_launch_date END AS bu_launch_date,
       product_line, rsp, age_mark,
       COALESCE(CASE WHEN regexp_matches(age_t, '^[0-9]+ [0-9]+/[0-9]+') THEN
                  TRY_CAST(split_part(age_t, ' ', 1) AS INT)
                  + TRY_CAST(split_part(split_part(age_t, ' ', 2), '/', 1) AS INT)
                    // NULLIF(TRY_CAST(split_part(split_part(age_t, ' ', 2), '/', 2) AS INT), 0)
                ELSE TRY_CAST(regexp_replace(age_t, '[^0-9]+.*', '') AS INT) END, 0) AS min_age,
       CASE WHEN rsp >= 0 AND rsp < 300 THEN 'LPP' WHEN rsp >= 300 AND rsp < 800 THEN 'MPP'
            WHEN rsp >= 800 THEN 'HPP' END AS price_band
FROM prod_parsed
""")

_cte("cal_day", ("calendar",), """
SELECT date_id, fiscal_year, fiscal_month, fiscal_week FROM calendar WHERE date_type = 'day'
""")

_cte("bind_tmall", ("shopper_binding",), """
SELECT kyid, CAST(first_bind_time AS DATE) AS tmall_bind_date FROM (
  SELECT DISTINCT platform_id_value AS kyid, first_bind_time FROM shopper_binding
  WHERE platform_id_type = 'kyid' AND platformid = 'taobao') t
""")

_cte("bind_douyin", ("shopper_binding",), """
SELECT openid, CAST(first_bind_time AS DATE) AS douyin_bind_date FROM (
  SELECT DISTINCT platform_id_value AS openid, first_bind_time FROM shopper_binding
  WHERE platform_id_type = 'openId' AND platformid = 'douyin') t
""")

_cte("city_maturity", ("store", "city_type"), """
SELECT DISTINCT s.city_cn, ct.city_type AS city_maturity_type
FROM store s LEFT JOIN city_type ct ON ct.city_chn = s.city_cn
""")

_cte("fact", ("order_line", "member", "bind_tmall", "bind_douyin", "dim_product", "cal_day",
              "city_maturity"), f"""
SELECT CASE WHEN t.source_channel IN ('DOUYIN', 'DOUYIN_B2B') THEN 'DOUYIN' ELSE t.source_channel END AS source_channel,
       t.order_paid_time, CAST(t.order_paid_date AS DATE) AS order_paid_date,
       c.fiscal_year, c.fiscal_month, c.fiscal_week,
       CASE WHEN t.type_name IN ('CRM_memberid', 'DY_openid', 'TMALL_kyid')
            THEN COALESCE(t.crm_member_detail_id, t.type_value) END AS member_id,
       m.member_detail_id, CAST(m.join_time AS DATE) AS join_date,
       bt.tmall_bind_date, bd.douyin_bind_date, m.eff_reg_channel,
       t.parent_order_id, t.sku_id, p.sku_name,
       p.bu_launch_date, p.lcs_launch_date, p.tm_launch_date, p.dy_launch_date,
       p.product_line, p.rsp, p.age_mark,
       CASE WHEN p.min_age >= 13 THEN 'ADULT' ELSE 'KIDS' END AS kids_vs_adult,
       p.price_band,
       COALESCE(t.city_tier, 'unspecified') AS city_tier,
       COALESCE(cm.city_maturity_type, '4_unspecified') AS city_maturity_type,
       t.sales_qty, t.if_eff_order_tag, t.is_member_order, t.order_rrp_amt
FROM order_line t
LEFT JOIN member m ON TRY_CAST(t.crm_member_detail_id AS BIGINT) = TRY_CAST(m.member_detail_id AS BIGINT)
LEFT JOIN bind_tmall bt ON t.type_value = bt.kyid
LEFT JOIN bind_douyin bd ON t.type_value = bd.openid
LEFT JOIN dim_product p ON t.sku_id = p.sku_id
LEFT JOIN cal_day c ON t.order_paid_date = c.date_id
LEFT JOIN city_maturity cm ON t.city_cn = cm.city_cn
WHERE t.source_channel IN ('LCS', 'TMALL', 'DOUYIN', 'DOUYIN_B2B')
  AND CAST(t.order_paid_date AS DATE) < __AS_OF__
  AND ((t.source_channel = 'LCS' AND t.sales_type <> 3)
       OR (t.source_channel IN ('TMALL', 'DOUYIN', 'DOUYIN_B2B') AND t.order_type = 'normal'))
""")

_cte("rank_orders", ("fact",), """
SELECT slice, parent_order_id, member_id, MIN(order_paid_time) AS order_paid_time
FROM (SELECT source_channel AS slice, parent_order_id, member_id, order_paid_time FROM fact
      WHERE if_eff_order_tag AND is_member_order
      UNION ALL
      SELECT 'OMNI', parent_order_id, member_id, order_paid_time FROM fact
      WHERE if_eff_order_tag AND is_member_order) x
GROUP BY slice, parent_order_id, member_id
""")

_cte("order_rank", ("rank_orders",), """
SELECT slice, parent_order_id, member_id, order_paid_time,
       ROW_NUMBER() OVER (PARTITION BY slice, member_id
                          ORDER BY order_paid_time ASC NULLS LAST, parent_order_id ASC NULLS LAST) AS rk
FROM rank_orders
""")

_cte("upt", ("fact",), """
SELECT parent_order_id, CAST(SUM(sales_qty) AS BIGINT) AS pieces FROM fact WHERE is_member_order GROUP BY parent_order_id
""")

_cte("admitted_lines", ("order_line",), f"""
SELECT CASE WHEN source_channel IN ('DOUYIN', 'DOUYIN_B2B') THEN 'DOUYIN' ELSE source_channel END AS source_channel,
       order_paid_time, CAST(order_paid_date AS DATE) AS order_paid_date,
       CASE WHEN type_name IN ('CRM_memberid', 'DY_openid', 'TMALL_kyid')
            THEN COALESCE(crm_member_detail_id, type_value) END AS member_id,
       TRY_CAST(crm_member_detail_id AS BIGINT) AS crm_key, type_value,
       parent_order_id, sku_id, city_cn, city_tier, sales_qty, if_eff_order_tag,
       is_member_order, order_rrp_amt
FROM order_line
WHERE source_channel IN ('LCS', 'TMALL', 'DOUYIN', 'DOUYIN_B2B')
  AND CAST(order_paid_date AS DATE) < __AS_OF__
  AND ((source_channel = 'LCS' AND sales_type <> 3)
       OR (source_channel IN ('TMALL', 'DOUYIN', 'DOUYIN_B2B') AND order_type = 'normal'))
""")

_cte("member_dim", ("member",), """
SELECT TRY_CAST(member_detail_id AS BIGINT) AS member_key, member_detail_id,
       CAST(join_time AS DATE) AS join_date, eff_reg_channel
FROM member
""")

_cte("focus_periods", ("dim_product", "focus_sku"), """
SELECT p.sku_id, p.bu_launch_date, p.lcs_launch_date, p.tm_launch_date, p.dy_launch_date,
       f.tracking_end_date
FROM dim_product p JOIN focus_sku f ON p.sku_id = f.sku_id
""")

_cte("rank_first", ("order_rank",), """
SELECT slice, parent_order_id, member_id, rk = 1 AS is_first FROM order_rank
""")

# KPI branches: label, rows filter, launch column, joined column, launch compared
KPI_BRANCHES = (
    ("LCS", "f.source_channel = 'LCS'", "lcs_launch_date", "join_date", "lcs_launch_date"),
    ("TMALL", "f.source_channel = 'TMALL'", "tm_launch_date", "tmall_bind_date", "tm_launch_date"),
    ("DOUYIN", "f.source_channel = 'DOUYIN'", "dy_launch_date", "douyin_bind_date", "tm_launch_date"),
    ("OMNI", "TRUE", "bu_launch_date", "join_date", "bu_launch_date"),
)


def _kpi_rows(branches) -> str:
    parts = []
    for label, cond, launch, joined, cmp_ in branches:
        parts.append(
            f"SELECT '{label}' AS branch, f.* EXCLUDE (source_channel), f.{launch} AS launch_date, "
            f"f.{joined} AS joined_date, f.{cmp_} AS launch_cmp FROM fact f WHERE {cond}")
    return "\nUNION ALL\n".join(parts)


def _kpi_body(branches, week: bool) -> str:
    wk = "k.fiscal_year, k.fiscal_week, " if week else ""
    elig = "k.is_member_order AND k.if_eff_order_tag"
    shoppers = f"COUNT(DISTINCT CASE WHEN {elig} THEN k.member_id END)"
    pn = f"COUNT(DISTINCT CASE WHEN {elig} AND r.rk = 1 AND k.launch_cmp <= k.joined_date THEN k.member_id END)"
    ex = f"COUNT(DISTINCT CASE WHEN {elig} AND r.rk = 1 AND k.launch_cmp > k.joined_date THEN k.member_id END)"
    rp = f"COUNT(DISTINCT CASE WHEN {elig} AND r.rk >= 2 THEN k.member_id END)"
    net_member = ("SUM(CASE WHEN k.is_member_order AND k.sales_qty > 0 THEN k.order_rrp_amt ELSE 0 END)"
                  " - SUM(CASE WHEN k.is_member_order AND k.sales_qty < 0 THEN abs(k.order_rrp_amt) ELSE 0 END)")
    net_all = ("SUM(CASE WHEN k.sales_qty > 0 THEN k.order_rrp_amt ELSE 0 END)"
               " - SUM(CASE WHEN k.sales_qty < 0 THEN abs(k.order_rrp_amt) ELSE 0 END)")
    return f"""
SELECT k.branch AS source_channel, k.sku_id, k.sku_name, k.product_line, k.launch_date,
       fs.tracking_end_date, k.rsp, k.price_band, k.age_mark, k.kids_vs_adult, {wk}
       CAST(SUM(k.sales_qty) AS BIGINT) AS units_sold,
       CAST(COUNT(DISTINCT CASE WHEN u.pieces >= 2 THEN k.parent_order_id END) AS DOUBLE)
         / NULLIF(CAST(COUNT(DISTINCT k.parent_order_id) AS DOUBLE), 0) AS multiple_units_per_order_penetration,
       CAST({net_member} AS DOUBLE) / NULLIF(CAST({net_all} AS DOUBLE), 0) AS member_sales_share,
       CAST(NULLIF({shoppers}, 0) AS BIGINT) AS member_shopper,
       CAST({pn} AS DOUBLE) AS pure_new_0_1_purchase_member_shopper,
       CAST({pn} AS DOUBLE) / NULLIF(CAST({shoppers} AS DOUBLE), 0) AS pure_new_0_1_purchase_member_shopper_share,
       CAST({ex} AS DOUBLE) AS existing_0_1_member_shopper,
       CAST({ex} AS DOUBLE) / NULLIF(CAST({shoppers} AS DOUBLE), 0) AS existing_0_1_member_shopper_share,
       CAST({rp} AS DOUBLE) AS lifetime_repurchase_member_shopper,
       CAST({rp} AS DOUBLE) / NULLIF(CAST({shoppers} AS DOUBLE), 0) AS lifetime_repurchase_member_shopper_share
FROM kpi_rows k
LEFT JOIN order_rank r ON r.slice = k.branch AND r.parent_order_id = k.parent_order_id
LEFT JOIN upt u ON u.parent_order_id = k.parent_order_id
JOIN focus_sku fs ON fs.sku_id = k.sku_id AND k.order_paid_date <= fs.tracking_end_date
WHERE k.order_paid_date >= k.launch_date
GROUP BY k.branch, k.sku_id, k.sku_name, k.product_line, k.launch_date, fs.tracking_end_date,
         k.rsp, k.price_band, k.age_mark, k.kids_vs_adult {(', ' + wk.rstrip(', ')) if week else ''}
"""


# Benchmark branches: label, period start column of the focus SKU, rows filter,
# launch column of the sold SKU compared with join_date
BENCH_BRANCHES = (
    ("OMNI", "bu_launch_date", "TRUE", "bu_launch_date"),
    ("LCS", "lcs_launch_date", "f.source_channel = 'LCS'", "bu_launch_date"),
    ("TMALL", "tm_launch_date", "f.source_channel = 'TMALL'", "tm_launch_date"),
    ("DOUYIN", "bu_launch_date", "f.source_channel = 'DOUYIN'", "dy_launch_date"),
)


def _bench_body(branches) -> str:
    periods = "\nUNION ALL\n".join(
        f"SELECT '{lab}' AS branch, p.{start} AS launch_date, fs.tracking_end_date "
        f"FROM dim_product p JOIN focus_sku fs ON p.sku_id = fs.sku_id"
        for lab, start, _, _ in branches)
    rows = "\nUNION ALL\n".join(
        f"SELECT '{lab}' AS branch, f.order_paid_date, f.member_id, f.join_date, f.{cmp_} AS launch_cmp, "
        f"f.is_member_order AND f.if_eff_order_tag AS elig, r.rk "
        f"FROM fact f LEFT JOIN order_rank r ON r.slice = '{lab}' AND r.parent_order_id = f.parent_order_id "
        f"WHERE {cond}"
        for lab, _, cond, cmp_ in branches)
    den = "NULLIF(CAST(COUNT(DISTINCT CASE WHEN b.elig THEN b.member_id END) AS DOUBLE), 0)"
    return f"""
SELECT p.branch AS source_channel, p.launch_date, p.tracking_end_date,
  CAST(COUNT(DISTINCT CASE WHEN b.elig AND b.rk = 1 AND b.launch_cmp <= b.join_date THEN b.member_id END) AS DOUBLE)
    / {den} AS benchmark_pure_new_0_1_purchase_member_shopper_share,
  CAST(COUNT(DISTINCT CASE WHEN b.elig AND b.rk = 1 AND b.launch_cmp > b.join_date THEN b.member_id END) AS DOUBLE)
    / {den} AS benchmark_existing_0_1_member_shopper_share,
  CAST(COUNT(DISTINCT CASE WHEN b.elig AND b.rk >= 2 THEN b.member_id END) AS DOUBLE)
    / {den} AS benchmark_lifetime_repurchase_member_shopper_share
FROM ({periods}) p
LEFT JOIN ({rows}) b
  ON b.branch = p.branch AND b.order_paid_date BETWEEN p.launch_date AND p.tracking_end_date
GROUP BY p.branch, p.launch_date, p.tracking_end_date
"""


INPUT_NAMES = ("order_line", "member", "shopper_binding", "product", "calendar", "store",
               "city_type", "focus_sku")

# When True, the eight inputs are taken as existing tables/views (hand-made
# test inputs) instead of being derived from the driver's tables.
INPUTS_AS_VIEWS = False


def _with(deps: tuple[str, ...], extra: list[tuple[str, str]], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or (INPUTS_AS_VIEWS and n in INPUT_NAMES):
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    parts = [f"{n} AS (\n{_CTES[n][1]}\n)" for n in order]
    parts += [f"{n} AS (\n{b.strip()}\n)" for n, b in extra]
    sql = body.strip() if not parts else "WITH " + ",\n".join(parts) + "\n" + body.strip()
    return sql.replace("__AS_OF__", AS_OF)


def select_from(cte: str, columns: str = "*", where: str = "") -> str:
    body = f"SELECT {columns} FROM {cte}" + (f" WHERE {where}" if where else "")
    return _with((cte,), [], body)


def kpi_sql(labels: tuple[str, ...] | None = None, week: bool = False) -> str:
    br = [b for b in KPI_BRANCHES if labels is None or b[0] in labels]
    return _with(("fact", "order_rank", "upt", "focus_sku"), [("kpi_rows", _kpi_rows(br))],
                 _kpi_body(br, week))


def benchmark_sql(labels: tuple[str, ...] | None = None) -> str:
    br = [b for b in BENCH_BRANCHES if labels is None or b[0] in labels]
    return _with(("fact", "order_rank", "dim_product", "focus_sku"), [], _bench_body(br))


def scorecard_8w_sql() -> str:
    kpi = _kpi_body(KPI_BRANCHES, week=False)
    bench = _bench_body(BENCH_BRANCHES)
    body = """
SELECT k.source_channel, k.launch_date, k.tracking_end_date, k.sku_id, k.sku_name, k.product_line,
       k.rsp, k.price_band, k.age_mark, k.kids_vs_adult, k.units_sold,
       k.multiple_units_per_order_penetration, k.member_sales_share, k.member_shopper,
       k.pure_new_0_1_purchase_member_shopper, k.pure_new_0_1_purchase_member_shopper_share,
       k.existing_0_1_member_shopper, k.existing_0_1_member_shopper_share,
       k.lifetime_repurchase_member_shopper, k.lifetime_repurchase_member_shopper_share,
       b.benchmark_pure_new_0_1_purchase_member_shopper_share,
       b.benchmark_existing_0_1_member_shopper_share,
       b.benchmark_lifetime_repurchase_member_shopper_share
FROM kpi k LEFT JOIN bench b
  ON b.source_channel = k.source_channel AND b.launch_date = k.launch_date
 AND b.tracking_end_date = k.tracking_end_date
"""
    return _with(("fact", "order_rank", "upt", "focus_sku", "dim_product"),
                 [("kpi_rows", _kpi_rows(KPI_BRANCHES)), ("kpi", kpi), ("bench", bench)], body)


def scorecard_week_sql() -> str:
    kpi = _kpi_body(KPI_BRANCHES, week=True)
    body = """
SELECT source_channel, launch_date, sku_id, sku_name, product_line, rsp, price_band, age_mark,
       kids_vs_adult, fiscal_year, fiscal_week, units_sold, multiple_units_per_order_penetration,
       member_sales_share, member_shopper,
       pure_new_0_1_purchase_member_shopper, pure_new_0_1_purchase_member_shopper_share,
       existing_0_1_member_shopper, existing_0_1_member_shopper_share,
       lifetime_repurchase_member_shopper, lifetime_repurchase_member_shopper_share
FROM kpi
"""
    return _with(("fact", "order_rank", "upt", "focus_sku"),
                 [("kpi_rows", _kpi_rows(KPI_BRANCHES)), ("kpi", kpi)], body)
