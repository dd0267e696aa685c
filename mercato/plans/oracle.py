"""Reference SQL (DuckDB dialect) for the driver's correctness check.

Each registered query has a twin here written as plain SQL over the test
tables. The shared CTEs restate the adapter (sources.sales), the star
(operators.star) and the marts; the band and lookup literals are generated
from the same parameters in :mod:`mercato.schemas`.
"""

from __future__ import annotations

from mercato import schemas as S


def _q(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def band_sql(expr: str, bands, top, cast: str | None = None) -> str:
    parts = []
    for bound, label in bands:
        b = f"CAST({_q(bound)} AS {cast})" if cast else _q(bound)
        parts.append(f"WHEN {expr} < {b} THEN {_q(label)}")
    return f"CASE {' '.join(parts)} ELSE {_q(top)} END"


def map_sql(expr: str, mapping: dict, default, cast: str | None = None) -> str:
    def val(v):
        return f"CAST({_q(v)} AS {cast})" if cast else _q(v)
    if not mapping:
        return val(default)
    whens = " ".join(f"WHEN {_q(k)} THEN {val(v)}" for k, v in mapping.items())
    return f"COALESCE(CASE {expr} {whens} END, {val(default)})"


def _date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def _sales_cte() -> str:
    margin = map_sql("p_type", S.FIXTURE_CATEGORY_MARGINS, str(S.DEFAULT_GP_MARGIN), "DECIMAL(4,2)")
    tier = band_sql("c_acctbal", S.FIXTURE_TIER_BOUNDS, S.FIXTURE_TOP_TIER, "DOUBLE")
    promo = band_sql("disc", S.FIXTURE_PROMO_BANDS, S.FIXTURE_PROMO_TOP, "DECIMAL(4,2)")
    gst = band_sql("tax", S.FIXTURE_GST_BANDS, S.FIXTURE_GST_TOP, "DECIMAL(4,2)")
    period = band_sql("year(d)", [(b + 1, lbl) for b, lbl in S.FIXTURE_PERIOD_BANDS], S.FIXTURE_PERIOD_TOP)
    return f"""
stores AS (
  SELECT s.s_suppkey, s.s_name AS store_name, r.r_name AS region
  FROM supplier s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
sales_base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity, l.l_extendedprice, l.l_discount,
         l.l_returnflag, l.l_linestatus, o.o_orderpriority, c.c_acctbal, c.c_mktsegment,
         p.p_name, p.p_type, st.store_name, st.region,
         CAST(l.l_shipdate AS DATE) AS d,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l.l_tax AS DECIMAL(4,2)) AS tax,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS sub
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN stores st ON l.l_suppkey = st.s_suppkey
),
sales AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' || strftime(d, '%Y%m%d') AS transaction_id,
    d AS date,
    CAST((l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 24 AS INTEGER) AS hour,
    region,
    store_name,
    p_type AS category,
    p_name AS product_name,
    c_mktsegment AS customer_segment,
    {tier} AS member_tier,
    CAST(l_quantity AS INTEGER) AS quantity,
    l_extendedprice / l_quantity AS unit_price_sgd,
    disc AS discount_pct,
    (l_extendedprice / l_quantity) * (1.0 - l_discount) AS unit_price_after_disc,
    sub AS subtotal_sgd,
    tax AS gst_rate,
    CAST(sub * tax AS DECIMAL(18,6)) AS gst_amount_sgd,
    CAST(sub + CAST(sub * tax AS DECIMAL(18,6)) AS DECIMAL(18,6)) AS total_sgd,
    CAST(sub * {margin} AS DECIMAL(18,6)) AS gross_profit_sgd,
    o_orderpriority AS payment_method,
    CAST(disc >= CAST({_q(S.FIXTURE_PROMO_MIN_DISCOUNT)} AS DECIMAL(4,2)) AS INTEGER) AS is_promotion,
    {promo} AS promo_type,
    CAST(l_returnflag = 'R' AS INTEGER) AS cdc_voucher_used,
    CAST(l_linestatus = 'O' AS INTEGER) AS is_tourist_purchase,
    CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
    CAST((month(d) = 1 AND day(d) = 1) OR (month(d) = 12 AND day(d) = 25) AS INTEGER) AS is_public_holiday,
    CAST(month(d) IN (11, 12) AS INTEGER) AS holiday_season_flag,
    CAST(month(d) = 12 AS INTEGER) AS bonus_period_flag,
    {period} AS period_label,
    {gst} AS gst_period,
    CAST(CAST(1 AS DECIMAL(6,4)) + CAST({_q(S.FIXTURE_INFLATION_STEP)} AS DECIMAL(6,4)) * (year(d) - {S.FIXTURE_BASE_YEAR}) AS DOUBLE) AS inflation_multiplier
  FROM sales_base
)"""


def _members(*columns: str) -> tuple[str, str]:
    """Distinct members, and their order; with loads (`loaded`: rows with their load number) the first load that had them leads."""
    names = ", ".join(columns)
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"(SELECT {names}, MIN(load) AS load FROM loaded GROUP BY {names})", f"load, {order}"


def _star_ctes(loads: bool = False) -> str:
    cfg = S.fixture_star_config()
    size = map_sql("store_name", cfg.store_sizes, cfg.default_store_size)
    tourist = map_sql("store_name", cfg.tourist_areas, cfg.default_tourist_area, "INTEGER")
    group = map_sql("category", cfg.category_groups, cfg.default_category_group)
    margin = map_sql("category", cfg.category_margins, cfg.default_gp_margin, "DOUBLE")
    rank = map_sql("member_tier", cfg.tier_ranks, cfg.default_tier_rank, "INTEGER")
    found = [("store_name", "region"), ("product_name", "category"), ("customer_segment", "member_tier")]
    (stores, store_order), (products, product_order), (customers, customer_order) = (
        _members(*c) if loads else (f"(SELECT DISTINCT {', '.join(c)} FROM sales)", ", ".join(f"{x} NULLS FIRST" for x in c)) for c in found)
    days = "loaded" if loads else "sales"
    return f""",
dim_date AS (
  SELECT {_date_key('d')} AS date_key,
         strftime(d, '%Y-%m-%d') AS full_date,
         CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year,
         CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(isodow(d) AS INTEGER) AS day_of_week_num,
         dayname(d) AS day_name,
         CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
         CAST(CASE WHEN month(d) >= {S.FISCAL_YEAR_START_MONTH} THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS fiscal_year
  FROM (SELECT DISTINCT date AS d FROM {days})
),
dim_store AS (
  SELECT CAST(row_number() OVER (ORDER BY {store_order}) AS BIGINT) AS store_key,
         store_name, region,
         upper(substring(region, 1, 3)) AS region_code,
         {size} AS store_size,
         {tourist} AS is_tourist_area
  FROM {stores}
),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY {product_order}) AS BIGINT) AS product_key,
         product_name, category,
         {group} AS category_group,
         {margin} AS base_gp_margin,
         CAST({group} = {_q(S.FRESH_GROUP)} AS INTEGER) AS is_fresh_item
  FROM {products}
),
dim_customer AS (
  SELECT customer_segment, member_tier,
         CAST(row_number() OVER (ORDER BY {customer_order}) AS BIGINT) AS customer_key,
         {rank} AS tier_rank,
         CAST(COALESCE(member_tier <> {_q(S.NON_MEMBER)}, TRUE) AS INTEGER) AS has_membership
  FROM {customers}
),
fact AS (
  SELECT s.transaction_id, {_date_key('s.date')} AS date_key,
         ds.store_key, dp.product_key, dc.customer_key,
         s.hour, s.quantity, s.unit_price_sgd, s.discount_pct, s.unit_price_after_disc,
         s.subtotal_sgd, s.gst_rate, s.gst_amount_sgd, s.total_sgd, s.gross_profit_sgd,
         s.payment_method, s.is_promotion, s.promo_type, s.cdc_voucher_used,
         s.is_tourist_purchase, s.is_weekend, s.is_public_holiday, s.holiday_season_flag,
         s.bonus_period_flag, s.period_label, s.gst_period, s.inflation_multiplier
  FROM sales s
  LEFT JOIN dim_store ds ON s.store_name IS NOT DISTINCT FROM ds.store_name AND s.region IS NOT DISTINCT FROM ds.region
  LEFT JOIN dim_product dp ON s.product_name IS NOT DISTINCT FROM dp.product_name AND s.category IS NOT DISTINCT FROM dp.category
  LEFT JOIN dim_customer dc ON s.customer_segment IS NOT DISTINCT FROM dc.customer_segment AND s.member_tier IS NOT DISTINCT FROM dc.member_tier
)"""


def money_sum(x: str) -> str:
    return f"CAST(ROUND(SUM({x}), 2) AS DOUBLE)"


def mean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(CAST(COUNT({x}) AS DOUBLE), 0))"


def rmean(x: str, n: int = 2, in_scale: int = 6, times: int = 1) -> str:
    """ROUND(AVG(x) * times, n), half up on the exact decimal mean (integer arithmetic)."""
    s = f"CAST(SUM({x}) * {10 ** in_scale} AS HUGEINT)"
    d = f"(CAST(COUNT({x}) AS HUGEINT) * {10 ** in_scale})"
    q = f"((abs({s}) * {2 * times * 10 ** n} + {d}) // (2 * {d}))"
    return (f"(CASE WHEN COUNT({x}) = 0 THEN NULL WHEN {s} < 0 THEN -CAST({q} AS DOUBLE) "
            f"ELSE CAST({q} AS DOUBLE) END / {float(10 ** n)})")


def margin(gp: str = "f.gross_profit_sgd", sub: str = "f.subtotal_sgd") -> str:
    return f"ROUND(CAST(SUM({gp}) AS DOUBLE) / NULLIF(CAST(SUM({sub}) AS DOUBLE), 0) * 100, 2)"


def rate(flag: str) -> str:
    return f"ROUND(CAST(SUM({flag}) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) * 100, 1)"


MART_SQL = {
    "monthly_sales": f"""
SELECT d.year, d.month, d.month_name, d.quarter,
       CAST(COUNT(f.transaction_id) AS BIGINT) AS transaction_count,
       CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
       {money_sum('f.total_sgd')} AS total_revenue,
       {rmean('f.total_sgd')} AS avg_basket_size,
       {money_sum('f.gross_profit_sgd')} AS gross_profit,
       {margin()} AS gp_margin_pct,
       CAST(SUM(f.is_promotion) AS BIGINT) AS promo_transactions,
       CAST(SUM(f.cdc_voucher_used) AS BIGINT) AS cdc_redemptions,
       CAST(SUM(f.holiday_season_flag) AS BIGINT) AS holiday_txns,
       {rmean('f.gst_rate', 1, 2, 100)} AS avg_gst_rate_pct
FROM fact f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name, d.quarter""",
    "regional_sales": f"""
SELECT s.region, s.store_name, s.store_size, s.is_tourist_area,
       CAST(COUNT(f.transaction_id) AS BIGINT) AS transactions,
       {money_sum('f.total_sgd')} AS total_revenue,
       {rmean('f.total_sgd')} AS avg_basket,
       {money_sum('f.gross_profit_sgd')} AS gross_profit,
       {margin()} AS gp_margin_pct,
       CAST(SUM(f.is_tourist_purchase) AS BIGINT) AS tourist_txns,
       {money_sum('CASE WHEN f.is_tourist_purchase = 1 THEN f.total_sgd ELSE 0 END')} AS tourist_revenue,
       CAST(SUM(f.cdc_voucher_used) AS BIGINT) AS cdc_redemptions,
       CAST(COUNT(*) FILTER (WHERE f.is_weekend = 1) AS BIGINT) AS weekend_txns
FROM fact f JOIN dim_store s ON f.store_key = s.store_key
GROUP BY s.region, s.store_name, s.store_size, s.is_tourist_area""",
    "category_profit": f"""
SELECT p.category, p.category_group, p.is_fresh_item,
       CAST(COUNT(f.transaction_id) AS BIGINT) AS transactions,
       CAST(SUM(f.quantity) AS BIGINT) AS total_units,
       {money_sum('f.total_sgd')} AS total_revenue,
       {rmean('f.total_sgd')} AS avg_transaction_value,
       {money_sum('f.gross_profit_sgd')} AS gross_profit,
       {margin()} AS gp_margin_pct,
       {rmean('f.discount_pct', 1, 2, 100)} AS avg_discount_pct,
       CAST(SUM(f.is_promotion) AS BIGINT) AS promo_transactions,
       {rate('f.is_promotion')} AS promo_rate_pct
FROM fact f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.category, p.category_group, p.is_fresh_item""",
    "customer_ltv": f"""
SELECT c.member_tier, c.customer_segment, c.has_membership, c.tier_rank,
       CAST(COUNT(f.transaction_id) AS BIGINT) AS total_transactions,
       {money_sum('f.total_sgd')} AS total_spend,
       {rmean('f.total_sgd')} AS avg_basket_size,
       CAST(ROUND(MAX(f.total_sgd), 2) AS DOUBLE) AS max_single_transaction,
       {money_sum('f.gross_profit_sgd')} AS total_gp_generated,
       CAST(SUM(f.cdc_voucher_used) AS BIGINT) AS voucher_uses,
       CAST(SUM(f.is_promotion) AS BIGINT) AS promo_purchases,
       {rate('f.is_promotion')} AS promo_sensitivity_pct
FROM fact f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY c.member_tier, c.customer_segment, c.has_membership, c.tier_rank""",
    "product_ranking": f"""
SELECT p.product_name, p.category, p.category_group,
       CAST(COUNT(f.transaction_id) AS BIGINT) AS times_purchased,
       CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
       {money_sum('f.total_sgd')} AS total_revenue,
       {rmean('f.total_sgd')} AS avg_revenue_per_txn,
       {money_sum('f.gross_profit_sgd')} AS gross_profit,
       {margin()} AS gp_margin_pct,
       {rmean('f.discount_pct', 1, 2, 100)} AS avg_discount_given
FROM fact f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.product_name, p.category, p.category_group""",
    "cdc_impact": f"""
SELECT f.period_label, f.cdc_voucher_used, f.gst_period,
       CAST(COUNT(*) AS BIGINT) AS transactions,
       {money_sum('f.total_sgd')} AS total_revenue,
       {rmean('f.total_sgd')} AS avg_basket,
       {money_sum('f.gross_profit_sgd')} AS gross_profit
FROM fact f
GROUP BY f.period_label, f.cdc_voucher_used, f.gst_period""",
    "gst_analysis": f"""
SELECT f.gst_period, CAST(f.gst_rate AS DOUBLE) AS gst_rate,
       CAST(COUNT(*) AS BIGINT) AS transactions,
       {rmean('f.total_sgd')} AS avg_basket,
       {rmean('f.gst_amount_sgd')} AS avg_gst_paid,
       {money_sum('f.gst_amount_sgd')} AS total_gst_collected,
       {money_sum('f.total_sgd')} AS total_revenue,
       {margin()} AS gp_margin_pct
FROM fact f
GROUP BY f.gst_period, f.gst_rate""",
}


def with_base(body: str, extra_ctes: str = "", loads: str = "") -> str:
    """Wrap a query over ``sales``/star/mart names in the shared CTEs.

    ``loads``: CTEs ``loaded`` (all rows of all loads over ``source``, with their load number) and ``sales`` (what is left)."""
    marts = ",\n".join(f"mart_{k} AS ({v})" for k, v in MART_SQL.items())
    if loads:
        ctes = f"WITH {_sales_cte().replace('sales AS (', 'source AS (')},\n{loads}{_star_ctes(True)},\n{marts}"
    else:
        ctes = f"WITH {_sales_cte()}{_star_ctes()},\n{marts}"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"{ctes}\n{body}"
