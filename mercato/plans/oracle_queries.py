"""DuckDB SQL twins of the analyses, dashboard queries, checks and loads."""

from __future__ import annotations

from mercato import schemas as S
from mercato.plans.oracle import MART_SQL, map_sql, mean, money_sum, rmean, with_base

# Filter used by the registered dashboard queries (years x regions).
FILTER_YEARS = (1997, 1998, 1999)
FILTER_REGIONS = ("AMERICA", "ASIA", "EUROPE")

MONEY_COLS = ["discount_pct", "subtotal_sgd", "gst_rate", "gst_amount_sgd", "total_sgd", "gross_profit_sgd"]


def emean(x: str, scale: int = 2) -> str:
    """Mean of values with `scale` decimals, summed exactly."""
    return f"(CAST(SUM(CAST({x} AS DECIMAL(30,{scale}))) AS DOUBLE) / NULLIF(CAST(COUNT({x}) AS DOUBLE), 0))"


def esum(x: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(30,{scale}))) AS DOUBLE)"


def _tier_pos(col: str) -> str:
    whens = " ".join(f"WHEN '{t}' THEN {i + 1}" for i, t in enumerate(S.TIER_ORDER))
    return f"CAST(CASE {col} {whens} END AS INTEGER)"


_HOURLY = """hourly AS (
  SELECT hour, is_weekend, CAST(COUNT(*) AS BIGINT) AS txns,
         """ + rmean("total_sgd", 2, 6) + """ AS avg_basket,
         CAST(ROUND(SUM(CAST(total_sgd AS DECIMAL(30,6))), 2) AS DOUBLE) AS revenue
  FROM fact GROUP BY hour, is_weekend
)"""

_years = ", ".join(str(y) for y in FILTER_YEARS)
_regions = ", ".join(f"'{r}'" for r in FILTER_REGIONS)
_FILTERED = f"""filtered AS (
  SELECT f.*, d.year, d.month, d.month_name, s.region
  FROM fact f
  JOIN dim_date d ON f.date_key = d.date_key
  JOIN dim_store s ON f.store_key = s.store_key
  WHERE d.year IN ({_years}) AND s.region IN ({_regions})
)"""

_STORE_PERF = f"""store_perf AS (
  SELECT region, store_name, store_size, is_tourist_area,
         {esum('total_revenue')} AS revenue,
         CAST(SUM(transactions) AS BIGINT) AS txns,
         {emean('avg_basket')} AS avg_basket,
         {emean('gp_margin_pct')} AS gp_margin,
         {esum('tourist_revenue')} AS tourist_rev,
         CAST(SUM(weekend_txns) AS BIGINT) AS wknd_txns
  FROM mart_regional_sales GROUP BY region, store_name, store_size, is_tourist_area
)"""

_voucher_whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in S.VOUCHER_LABELS.items())
_VOUCHER = f"""voucher_cmp AS (
  SELECT cdc_voucher_used,
         {emean('avg_basket')} AS avg_basket,
         {esum('total_revenue')} AS total_rev,
         CAST(SUM(transactions) AS BIGINT) AS transactions,
         CASE cdc_voucher_used {_voucher_whens} END AS label
  FROM mart_cdc_impact WHERE cdc_voucher_used IS NOT NULL GROUP BY cdc_voucher_used
)"""

_fact_cols = ", ".join(
    f"CAST(f.{c} AS DOUBLE) AS {c}" if c in MONEY_COLS else f"f.{c}" for c in S.FACT_COLUMNS)

SQL = {
    "kpi_row": with_base(f"""
SELECT CAST(SUM(total_sgd) AS DOUBLE) AS total_revenue,
       CAST(COUNT(*) AS BIGINT) AS total_transactions,
       {mean('total_sgd')} AS avg_basket,
       CAST(SUM(gross_profit_sgd) AS DOUBLE) AS total_gross_profit,
       CAST(SUM(gross_profit_sgd) AS DOUBLE) / NULLIF(CAST(SUM(subtotal_sgd) AS DOUBLE), 0) * 100 AS gp_margin_pct,
       {mean('is_promotion')} * 100 AS promo_rate_pct,
       {mean('cdc_voucher_used')} * 100 AS cdc_rate_pct,
       CAST(SUM(CASE WHEN is_weekend = 1 THEN total_sgd ELSE 0 END) AS DOUBLE)
         / NULLIF(CAST(SUM(total_sgd) AS DOUBLE), 0) * 100 AS weekend_revenue_share_pct,
       ROUND(stddev_pop(CAST(total_sgd AS DOUBLE)), 4) AS basket_std,
       ROUND(quantile_cont(CAST(total_sgd AS DOUBLE), 0.5), 2) AS basket_median,
       ROUND(quantile_cont(CAST(total_sgd AS DOUBLE), 0.95), 2) AS basket_p95
FROM fact"""),
    "monthly_trend": with_base("""
SELECT *, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period
FROM mart_monthly_sales"""),
    "yoy": with_base("""
SELECT year, CAST(rev AS DOUBLE) AS revenue,
       (CAST(rev AS DOUBLE) / NULLIF(CAST(LAG(rev) OVER (ORDER BY year) AS DOUBLE), 0) - 1) * 100 AS yoy_growth_pct
FROM (SELECT year, SUM(CAST(total_revenue AS DECIMAL(30,2))) AS rev FROM mart_monthly_sales GROUP BY year)"""),
    "peak_month": with_base("""
SELECT year, month, month_name, total_revenue FROM mart_monthly_sales
ORDER BY total_revenue DESC, year, month LIMIT 1"""),
    "region_share": with_base(f"""
SELECT region, CAST(rev AS DOUBLE) AS revenue, txns, avg_basket, gp_margin, tourist_rev,
       CAST(rev AS DOUBLE) / NULLIF(CAST(SUM(rev) OVER () AS DOUBLE), 0) * 100 AS revenue_share
FROM (SELECT region, SUM(CAST(total_revenue AS DECIMAL(30,2))) AS rev,
             CAST(SUM(transactions) AS BIGINT) AS txns,
             {emean('avg_basket')} AS avg_basket,
             {emean('gp_margin_pct')} AS gp_margin,
             {esum('tourist_revenue')} AS tourist_rev
      FROM mart_regional_sales GROUP BY region)"""),
    "category_top": with_base("""
SELECT category, total_revenue, gross_profit, gp_margin_pct, total_units, promo_rate_pct, avg_discount_pct
FROM mart_category_profit ORDER BY total_revenue DESC, category LIMIT 10"""),
    "discount_corr": with_base("""
SELECT ROUND(corr(avg_discount_pct, total_revenue), 6) AS discount_revenue_corr FROM mart_category_profit"""),
    "tier_multiplier": with_base(f"""
SELECT m.member_tier, m.customer_segment, m.avg_basket_size, m.total_spend, m.total_transactions,
       m.promo_sensitivity_pct, ROUND(m.avg_basket_size / NULLIF(b.base, 0), 4) AS spend_multiplier
FROM mart_customer_ltv m
CROSS JOIN (SELECT {emean(f"CASE WHEN member_tier = '{S.NON_MEMBER}' THEN avg_basket_size END")} AS base
            FROM mart_customer_ltv) b"""),
    "voucher_lift": with_base(f"""
SELECT no_voucher, with_voucher, (with_voucher - no_voucher) / NULLIF(no_voucher, 0) * 100 AS voucher_lift_pct
FROM (SELECT {emean('CASE WHEN cdc_voucher_used = 0 THEN avg_basket END')} AS no_voucher,
             {emean('CASE WHEN cdc_voucher_used = 1 THEN avg_basket END')} AS with_voucher
      FROM mart_cdc_impact)"""),
    "tax_growth": with_base(f"""
SELECT pre_basket, post_basket, (post_basket - pre_basket) / NULLIF(pre_basket, 0) * 100 AS basket_growth_pct
FROM (SELECT
  (SELECT avg_basket FROM mart_gst_analysis WHERE gst_period = '{S.TAX_PERIOD_BEFORE}' ORDER BY gst_rate LIMIT 1) AS pre_basket,
  (SELECT avg_basket FROM mart_gst_analysis WHERE gst_period = '{S.TAX_PERIOD_AFTER}' ORDER BY gst_rate LIMIT 1) AS post_basket)"""),
    "hourly": with_base("SELECT * FROM hourly", _HOURLY),
    "peak_hours": with_base(f"""
SELECT
  (SELECT hour FROM hourly WHERE is_weekend = 0 ORDER BY txns DESC, hour LIMIT 1) AS peak_hour_weekday,
  (SELECT hour FROM hourly WHERE is_weekend = 1 ORDER BY txns DESC, hour LIMIT 1) AS peak_hour_weekend,
  (SELECT {emean('CASE WHEN is_weekend = 1 THEN avg_basket END')} - {emean('CASE WHEN is_weekend = 0 THEN avg_basket END')}
   FROM hourly) AS weekend_basket_premium""", _HOURLY),
    "product_top": with_base("""
SELECT product_name, category, total_revenue, gp_margin_pct, total_units_sold,
       substring(product_name, 1, 38) AS product_label
FROM mart_product_ranking ORDER BY total_revenue DESC, product_name, category LIMIT 15"""),
    "margin_top": with_base("""
SELECT * FROM mart_category_profit ORDER BY gp_margin_pct DESC, total_revenue DESC, category LIMIT 8"""),
    "tier_basket": with_base(f"""
SELECT * FROM (
  SELECT member_tier, {emean('avg_basket_size')} AS avg_basket_size, {_tier_pos('member_tier')} AS tier_order
  FROM mart_customer_ltv GROUP BY member_tier) WHERE tier_order IS NOT NULL"""),
    "tier_ratio": with_base(f"""
SELECT {emean(f"CASE WHEN member_tier = '{S.TOP_TIER}' THEN avg_basket_size END")}
       / NULLIF({emean(f"CASE WHEN member_tier = '{S.NON_MEMBER}' THEN avg_basket_size END")}, 0) AS platinum_vs_non_member
FROM mart_customer_ltv"""),
    "weekday_sales": with_base(f"""
SELECT d.day_of_week_num, d.day_name, CAST(COUNT(*) AS BIGINT) AS transactions,
       {money_sum('f.total_sgd')} AS revenue, {rmean('f.total_sgd')} AS avg_basket
FROM fact f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.day_of_week_num, d.day_name"""),
    "payment_share": with_base("""
SELECT payment_method, transactions,
       CAST(transactions AS DOUBLE) / NULLIF(CAST(SUM(transactions) OVER () AS DOUBLE), 0) * 100 AS share_pct
FROM (SELECT payment_method, CAST(COUNT(*) AS BIGINT) AS transactions FROM fact GROUP BY payment_method)"""),
    # -- dashboard --------------------------------------------------------------
    "filtered_sales": with_base(f"""
SELECT {_fact_cols}, f.year, f.month, f.month_name, f.region FROM filtered f""", _FILTERED),
    "filtered_kpis": with_base(f"""
SELECT CAST(SUM(total_sgd) AS DOUBLE) AS total_revenue, CAST(COUNT(*) AS BIGINT) AS total_transactions,
       {mean('total_sgd')} AS avg_basket, CAST(SUM(gross_profit_sgd) AS DOUBLE) AS total_gross_profit,
       CAST(SUM(gross_profit_sgd) AS DOUBLE) / NULLIF(CAST(SUM(subtotal_sgd) AS DOUBLE), 0) * 100 AS gp_margin_pct
FROM filtered""", _FILTERED),
    "filtered_monthly": with_base(f"""
SELECT year, month, month_name, CAST(SUM(total_sgd) AS DOUBLE) AS revenue,
       CAST(COUNT(transaction_id) AS BIGINT) AS transactions, {mean('total_sgd')} AS avg_basket,
       CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period
FROM filtered WHERE year IS NOT NULL AND month IS NOT NULL AND month_name IS NOT NULL
GROUP BY year, month, month_name""", _FILTERED),
    "filtered_regions": with_base("""
SELECT region, CAST(SUM(total_sgd) AS DOUBLE) AS total_sgd FROM filtered WHERE region IS NOT NULL GROUP BY region""",
                                  _FILTERED),
    "filtered_years": with_base(f"""
SELECT year, CAST(SUM(total_sgd) AS DOUBLE) AS revenue, CAST(COUNT(transaction_id) AS BIGINT) AS transactions,
       {mean('total_sgd')} AS avg_basket, CAST(SUM(gross_profit_sgd) AS DOUBLE) AS gp
FROM filtered WHERE year IS NOT NULL GROUP BY year""", _FILTERED),
    "store_performance": with_base("SELECT * FROM store_perf", _STORE_PERF),
    "region_summary": with_base(f"""
SELECT region, {esum('revenue')} AS revenue, CAST(SUM(txns) AS BIGINT) AS txns,
       {emean('avg_basket', 6)} AS avg_basket, {emean('gp_margin', 6)} AS gp_margin, {esum('tourist_rev')} AS tourist_rev
FROM store_perf WHERE region IS NOT NULL GROUP BY region""", _STORE_PERF),
    "store_table": with_base(
        "SELECT region, store_name, store_size, "
        + ", ".join(f'{c} AS "{S.STORE_TABLE_NAMES[c]}"' for c in ("revenue", "txns", "avg_basket", "gp_margin", "tourist_rev"))
        + " FROM store_perf", _STORE_PERF),
    "category_list": with_base("SELECT * FROM mart_category_profit"),
    "product_table": with_base(
        "SELECT product_name, category, "
        + ", ".join(f'{c} AS "{S.PRODUCT_TABLE_NAMES[c]}"'
                    for c in ("total_revenue", "gp_margin_pct", "total_units_sold", "avg_discount_given"))
        + " FROM mart_product_ranking ORDER BY total_revenue DESC, product_name, category LIMIT 20"),
    "tier_summary": with_base(f"""
SELECT * FROM (
  SELECT member_tier, {emean('avg_basket_size')} AS avg_basket, {esum('total_spend')} AS total_spend,
         CAST(SUM(total_transactions) AS BIGINT) AS transactions, {_tier_pos('member_tier')} AS tier_order
  FROM mart_customer_ltv GROUP BY member_tier) WHERE tier_order IS NOT NULL"""),
    "segment_spend": with_base(f"""
SELECT customer_segment, {esum('total_spend')} AS total_spend FROM mart_customer_ltv
WHERE customer_segment IS NOT NULL GROUP BY customer_segment"""),
    "payment_methods": with_base(f"""
SELECT payment_method, CAST(COUNT(*) AS BIGINT) AS txns, {money_sum('total_sgd')} AS revenue
FROM fact GROUP BY payment_method"""),
    "voucher_compare": with_base("SELECT * FROM voucher_cmp", _VOUCHER),
    "voucher_compare_lift": with_base("""
SELECT no_voucher, with_voucher, (with_voucher - no_voucher) / NULLIF(no_voucher, 0) * 100 AS lift_pct
FROM (SELECT MAX(CASE WHEN cdc_voucher_used = 0 THEN avg_basket END) AS no_voucher,
             MAX(CASE WHEN cdc_voucher_used = 1 THEN avg_basket END) AS with_voucher FROM voucher_cmp)""", _VOUCHER),
    "tax_periods": with_base("SELECT * FROM mart_gst_analysis"),
}


# -- quality checks -------------------------------------------------------------
from mercato.operators import quality as Q  # noqa: E402

_cfg = S.CheckConfig()


def _pct(n: str, rows: str = "_rows") -> str:
    h = f"(({n} * 20000 + {rows}) // (2 * {rows}))"
    return (f"CASE WHEN {rows} > 0 THEN CAST({h} // 100 AS VARCHAR) || '.' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0') "
            f"ELSE '0.00' END")


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _detail_sql(cid: str, **slots) -> str:
    """The check's fixed detail format with its measured slots as SQL."""
    parts, rest = [], Q.check_detail(cid, _cfg)
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if pre:
            parts.append(_lit(pre))
        parts.append(slots[name])
    if rest:
        parts.append(_lit(rest))
    return " || ".join(parts)


def _check_row(cid, passed, detail, violations, src) -> str:
    return (f"SELECT '{cid}' AS check_id, {_lit(Q.check_name(cid, _cfg))} AS test_name, "
            f"CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status, {detail} AS detail, "
            f"'{Q.check_severity(cid)}' AS severity, CAST({violations} AS BIGINT) AS violations FROM {src}")


def _n(x: str = "n") -> str:
    return f"CAST({x} AS VARCHAR)"


_NOT_NULL = ["transaction_id", "date_key", "store_key", "product_key", "customer_key", "total_sgd", "quantity",
             "payment_method"]
_valid = ", ".join(f"CAST('{r}' AS DECIMAL(4,2))" for r in _cfg.valid_gst_rates)
# Violation predicates of the row-level checks, written for DuckDB.
_ROW_SQL = {
    "K12": "total_sgd <= 0",
    "K13": "quantity < 1",
    "K14": "discount_pct < 0 OR discount_pct > 1",
    "K15": f"NOT COALESCE(gst_rate IN ({_valid}), FALSE)",
    "K20": f"abs(total_sgd - round_even(subtotal_sgd + gst_amount_sgd, 2)) > CAST('{_cfg.total_tolerance}' AS DECIMAL(10,4))",
    "K21": f"is_promotion = 1 AND promo_type = {_lit(S.NO_PROMOTION)}",
    "K22": ("(CASE WHEN isnan(unit_price_after_disc) THEN NULL ELSE unit_price_after_disc END) > "
            f"(CASE WHEN isnan(unit_price_sgd) THEN NULL ELSE unit_price_sgd END) + {_cfg.price_tolerance}"),
    "K23": "gross_profit_sgd < 0",
}
_ORPHANS = [("K17", "dim_store", "store_key"), ("K18", "dim_product", "product_key"),
            ("K19", "dim_date", "date_key"), ("K19b", "dim_customer", "customer_key")]

_ROW_AGG = ("row_checks AS (SELECT COUNT(*) AS _rows, "
            + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS K{i}" for i, c in enumerate(_NOT_NULL, start=1))
            + ", " + ", ".join(f"COUNT(*) FILTER (WHERE {p}) AS {cid}" for cid, p in _ROW_SQL.items())
            + " FROM fact)")

_monthly_counts = ("monthly_counts AS (SELECT d.year, d.month, COUNT(*) AS cnt FROM fact f "
                   "JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.month)")

_year_ok = f"COALESCE(lo >= {_cfg.min_year} AND hi <= {_cfg.max_year}, FALSE)"
DQ_PARTS = {
    "nulls": [_check_row(f"K{i}", f"K{i} = 0", _detail_sql(f"K{i}", n=_n(f"K{i}"), pct=_pct(f"K{i}")),
                         f"K{i}", "row_checks") for i in range(1, 9)],
    "duplicates": [
        _check_row("K9", "n = 0", _detail_sql("K9", n=_n()), "n",
                   "(SELECT COUNT(*) - COUNT(DISTINCT struct_pack(transaction_id)) AS n FROM fact)"),
        _check_row("K10", "n = 0", _detail_sql("K10", n=_n()), "n",
                   "(SELECT COUNT(*) - COUNT(DISTINCT struct_pack(store_name, region)) AS n FROM dim_store)"),
        _check_row("K11", "n = 0", _detail_sql("K11", n=_n()), "n",
                   "(SELECT COUNT(*) - COUNT(DISTINCT struct_pack(product_name)) AS n FROM dim_product)"),
    ],
    "ranges": [_check_row(cid, f"{cid} = 0", _detail_sql(cid, n=_n(cid)), cid, "row_checks")
               for cid in ("K12", "K13", "K14", "K15")] + [
        _check_row("K16", _year_ok, _detail_sql("K16", lo=_n("lo"), hi=_n("hi")),
                   f"CASE WHEN {_year_ok} THEN 0 ELSE 1 END",
                   "(SELECT MIN(year) AS lo, MAX(year) AS hi FROM dim_date)"),
    ],
    "orphans": [
        _check_row(cid, "n = 0", _detail_sql(cid, n=_n()), "n",
                   f"(SELECT COUNT(*) AS n FROM fact f LEFT JOIN {dim} d ON f.{key} = d.{key} WHERE d.{key} IS NULL)")
        for cid, dim, key in _ORPHANS],
    "logic": [_check_row(cid, f"{cid} = 0", _detail_sql(cid, n=_n(cid)), cid, "row_checks")
              for cid in ("K20", "K21", "K22", "K23")],
    "distribution": [
        _check_row("K24", f"n = {_cfg.expected_regions}", _detail_sql("K24", n=_n(), values="vals"), "n",
                   "(SELECT COUNT(*) AS n, '[' || COALESCE(string_agg(chr(39) || region || chr(39), ', ' ORDER BY region), '') || ']' AS vals "
                   "FROM (SELECT DISTINCT region FROM dim_store WHERE region IS NOT NULL))"),
        _check_row("K25", f"n = {_cfg.expected_years}", _detail_sql("K25", values="vals"), "n",
                   "(SELECT COUNT(*) AS n, '[' || COALESCE(string_agg(CAST(year AS VARCHAR), ', ' ORDER BY year), '') || ']' AS vals "
                   "FROM (SELECT DISTINCT year FROM dim_date WHERE year IS NOT NULL))"),
        _check_row("K26", f"COALESCE(n >= {_cfg.min_monthly_transactions}, FALSE)", _detail_sql("K26", n=_n()), "n",
                   "(SELECT MIN(cnt) AS n FROM monthly_counts)"),
    ],
}
_DQ_CTES = _ROW_AGG + ",\n" + _monthly_counts

for _g, _parts in DQ_PARTS.items():
    SQL[f"dq_{_g}"] = with_base("\nUNION ALL\n".join(_parts), _DQ_CTES)

_ALL_CHECKS = "all_checks AS (" + "\nUNION ALL\n".join(p for parts in DQ_PARTS.values() for p in parts) + ")"
SQL["dq_results"] = with_base("SELECT * FROM all_checks", _DQ_CTES + ",\n" + _ALL_CHECKS)
_SCORE = f"""
SELECT total_tests, passed, failed, quality_score,
       CASE WHEN quality_score = 100 THEN {_lit(Q.GRADE_PERFECT)}
            WHEN quality_score >= 90 THEN {_lit(Q.GRADE_GOOD)}
            WHEN quality_score >= 75 THEN {_lit(Q.GRADE_ACCEPTABLE)}
            ELSE {_lit(Q.GRADE_POOR)} END AS grade
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS total_tests,
             CAST(COUNT(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS passed,
             CAST(COUNT(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failed,
             CAST(COUNT(*) FILTER (WHERE status = 'PASS') AS DOUBLE) * 100.0 / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS quality_score
      FROM all_checks)"""
SQL["dq_score"] = with_base(_SCORE, _DQ_CTES + ",\n" + _ALL_CHECKS)
SQL["quality_report"] = with_base(f"""
SELECT quality_score, total_tests, passed, failed, grade,
       (SELECT string_agg(concat_ws(' | ', test_name, status, detail, severity), chr(10) ORDER BY check_id) FROM all_checks) AS details
FROM ({_SCORE})""", _DQ_CTES + ",\n" + _ALL_CHECKS)

# -- ingest profile, pre-load checks, counts ---------------------------------------
SQL["source_profile"] = with_base("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(30 AS INTEGER) AS columns, MIN(date) AS min_date, MAX(date) AS max_date,
       (SELECT string_agg(region, ',' ORDER BY region) FROM (SELECT DISTINCT region FROM sales WHERE region IS NOT NULL)) AS regions,
       CAST(SUM(total_sgd) AS DOUBLE) AS total_revenue
FROM sales""")
SQL["preload_issues"] = with_base("""
SELECT 'missing_required_columns' AS issue, CAST(0 AS BIGINT) AS found, '' AS detail
UNION ALL
SELECT 'duplicate_transaction_ids', n, 'Found ' || CAST(n AS VARCHAR) || ' duplicate transaction_ids'
FROM (SELECT CAST(COUNT(*) - COUNT(DISTINCT struct_pack(transaction_id)) AS BIGINT) AS n FROM sales)
UNION ALL
SELECT 'negative_total_sgd', n, 'Found ' || CAST(n AS VARCHAR) || ' negative total_sgd values'
FROM (SELECT CAST(COUNT(*) FILTER (WHERE total_sgd < 0) AS BIGINT) AS n FROM sales)""")
_COUNTED = ["dim_date", "dim_store", "dim_product", "dim_customer", "fact"] + [
    f"mart_{m}" for m in ("monthly_sales", "regional_sales", "category_profit", "customer_ltv", "product_ranking",
                          "cdc_impact", "gst_analysis")]
SQL["table_counts"] = with_base("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}" for t in _COUNTED))

# -- incremental load ---------------------------------------------------------------
UPSERT_BASE_BEFORE = "2000-01-01"
UPSERT_BATCH_FROM = "1999-07-01"
_UPSERT_COLS = ["transaction_id", "date", "store_name", "product_name", "quantity", "total_sgd"]
_ucols = ", ".join(_UPSERT_COLS)
SQL["upsert"] = with_base(f"""
SELECT transaction_id, date, store_name, product_name, quantity, CAST(total_sgd AS DOUBLE) AS total_sgd FROM (
  SELECT {_ucols} FROM sales t
  WHERE t.date < DATE '{UPSERT_BASE_BEFORE}'
    AND NOT EXISTS (SELECT 1 FROM sales b WHERE b.date >= DATE '{UPSERT_BATCH_FROM}' AND b.transaction_id = t.transaction_id)
  UNION ALL
  SELECT {_ucols} FROM (
    SELECT {_ucols}, row_number() OVER (PARTITION BY transaction_id
             ORDER BY date DESC, store_name DESC, product_name DESC, quantity DESC, total_sgd DESC) AS rn
    FROM sales WHERE date >= DATE '{UPSERT_BATCH_FROM}') WHERE rn = 1)""")
_qchecks = [("K1", "transaction_id IS NULL"), ("K2", "date_key IS NULL"), ("K3", "store_key IS NULL"),
            ("K4", "product_key IS NULL"), ("K5", "customer_key IS NULL"), ("K6", "total_sgd IS NULL"), ("K7", "quantity IS NULL"),
            ("K8", "payment_method IS NULL")] + [(cid, _ROW_SQL[cid]) for cid in ("K12", "K13", "K14", "K15", "K20", "K22")]
_tags = "list_value(" + ", ".join(f"CASE WHEN COALESCE({p}, FALSE) THEN '{cid}' END" for cid, p in _qchecks) + ")"
SQL["quarantine"] = with_base(f"""
SELECT transaction_id, date_key, failed_checks, CAST(failed_checks <> '' AS INTEGER) AS quarantined
FROM (SELECT transaction_id, date_key,
             COALESCE(array_to_string(list_filter({_tags}, lambda x: x IS NOT NULL), ','), '') AS failed_checks
      FROM fact)""")

# -- written tables ---------------------------------------------------------------
_raw_cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY_COLS else c for c in S.RAW_COLUMNS)
SQL["csv_ingest"] = with_base(f"SELECT {_raw_cols}, '' AS bad_columns, '' AS rounded_columns, '' AS corrupt_record FROM sales")
# Two loads: all sales but those of hour 11; then corrections, rows that came late and new rows (registry.late_batch).
_LOADS = f"""
base AS (SELECT * FROM source WHERE hour <> 11),
fixes AS (
  SELECT * REPLACE (CASE WHEN hour % 2 = 0 THEN date + 31 ELSE date END AS date,
                    CASE WHEN quantity % 5 = 0 THEN 'New ' || store_name ELSE store_name END AS store_name,
                    CAST(subtotal_sgd + 1 AS DECIMAL(18,4)) AS subtotal_sgd, CAST(total_sgd + 1 AS DECIMAL(18,6)) AS total_sgd)
  FROM source WHERE date >= DATE '{UPSERT_BATCH_FROM}' AND hour % 3 = 0),
batch AS (
  SELECT * FROM fixes
  UNION ALL SELECT * REPLACE (date - 1 AS date) FROM fixes WHERE hour = 21
  UNION ALL SELECT * FROM source WHERE hour = 11
  UNION ALL SELECT * REPLACE (transaction_id || '-b' AS transaction_id, CASE WHEN quantity > 40 THEN product_name || ' v2' ELSE product_name END AS product_name)
            FROM source WHERE hour = 5),
loaded AS (SELECT *, 1 AS load FROM base UNION ALL SELECT *, 2 AS load FROM batch),
newest AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY date DESC) AS place FROM batch) WHERE place = 1),
sales AS (
  SELECT *, '2024-01-01 00:00:00' AS loaded_at FROM base WHERE transaction_id NOT IN (SELECT transaction_id FROM batch)
  UNION ALL SELECT *, '2024-02-01 00:00:00' AS loaded_at FROM newest)"""


def _after_loads(body: str) -> str:
    return with_base(body, loads=_LOADS)


SQL["upsert_table"] = _after_loads("""
SELECT transaction_id, date, store_name, product_name, quantity, CAST(total_sgd AS DOUBLE) AS total_sgd, loaded_at,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM sales""")
SQL["load_ledger"] = _after_loads("""
SELECT CAST(1 AS BIGINT) AS version, 'base' AS load_id, '2024-01-01 00:00:00' AS loaded_at,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM base) AS rows, (SELECT CAST(COUNT(*) AS BIGINT) FROM base) AS stored_rows
UNION ALL SELECT 2, 'late', '2024-02-01 00:00:00', (SELECT CAST(COUNT(*) AS BIGINT) FROM batch), (SELECT CAST(COUNT(*) AS BIGINT) FROM sales)""")
for _d in ("date", "store", "product", "customer"):
    SQL[f"load_dim_{_d}"] = _after_loads(f"SELECT * FROM dim_{_d}")
SQL["load_fact"] = _after_loads(
    "SELECT " + ", ".join(f"CAST(f.{c} AS DOUBLE) AS {c}" if c in ("discount_pct", "subtotal_sgd", "gst_rate", "gst_amount_sgd", "total_sgd", "gross_profit_sgd")
                          else f"f.{c}" for c in S.FACT_COLUMNS) + ", s.loaded_at FROM fact f JOIN sales s ON f.transaction_id = s.transaction_id")
for _m in MART_SQL:
    SQL[f"load_mart_{_m}"] = _after_loads(f"SELECT * FROM mart_{_m}")
SQL["append_load"] = with_base("""
SELECT store_name, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(total_sgd) AS DOUBLE) AS total FROM sales GROUP BY store_name""")
SQL["load_check"] = """
SELECT CAST(COUNT(*) AS BIGINT) AS expected, CAST(COUNT(*) AS BIGINT) AS stored, TRUE AS ok FROM lineitem"""
SQL["sample_rows"] = with_base("SELECT transaction_id, date, store_name FROM sales ORDER BY date, transaction_id LIMIT 3")
SQL["sketch_check"] = with_base("""
SELECT s.region, TRUE AS p50_ok, TRUE AS p95_ok, TRUE AS distinct_ok
FROM fact f JOIN dim_store s ON f.store_key = s.store_key JOIN dim_date d ON f.date_key = d.date_key
WHERE s.region IS NOT NULL GROUP BY s.region""")
SQL["source_guard"] = """
SELECT 'lineitem' AS name, 'ok' AS status, CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem
UNION ALL SELECT 'supplier', 'ok', CAST(COUNT(*) AS BIGINT) FROM supplier
UNION ALL SELECT 'no_such_table', 'PATH_NOT_FOUND', NULL"""
SQL["conformance"] = """
SELECT name, missing, other_types, n_rows
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem),
     (VALUES ('as_loaded', '', ''), ('no_region', 'region', ''), ('text_quantity', '', 'quantity')) v(name, missing, other_types)"""
SQL["filter_guard"] = with_base(f"""
SELECT choice, (SELECT COUNT(*) FROM fact f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_store s ON f.store_key = s.store_key
                WHERE (choice = 'all' OR (choice = 'default' AND d.year IN ({_years}) AND s.region IN ({_regions}))
                       OR (choice = 'no_such_year' AND d.year = 1901) OR (choice = 'no_such_region' AND s.region = 'MARS'))) > 0 AS has_rows
FROM (VALUES ('default'), ('all'), ('no_such_year'), ('no_such_region')) v(choice)""")


def _list(names) -> str:
    return "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + "]"


_fixed_stores, _fixed_categories = [*S.STORE_SIZES, "Unknown store", "Other store"], [*S.CATEGORY_MARGINS, "Unknown category"]
_FIXED = f"""
named AS (
  SELECT {_list(_fixed_stores)}[CAST(regexp_extract(store_name, '(\\d+)$', 1) AS INTEGER) % {len(_fixed_stores)} + 1] AS store_name, region, product_name,
         {_list(_fixed_categories)}[(length(product_name) + quantity) % {len(_fixed_categories)} + 1] AS category
  FROM sales)"""
SQL["dim_store_fixed"] = with_base(f"""
SELECT CAST(row_number() OVER (ORDER BY store_name NULLS FIRST, region NULLS FIRST) AS BIGINT) AS store_key, store_name, region,
       upper(substring(region, 1, 3)) AS region_code, {map_sql('store_name', S.STORE_SIZES, 'Medium')} AS store_size,
       {map_sql('store_name', S.TOURIST_AREAS, 0, 'INTEGER')} AS is_tourist_area
FROM (SELECT DISTINCT store_name, region FROM named)""", _FIXED)
SQL["dim_product_fixed"] = with_base(f"""
SELECT CAST(row_number() OVER (ORDER BY product_name NULLS FIRST, category NULLS FIRST) AS BIGINT) AS product_key, product_name, category,
       {map_sql('category', S.CATEGORY_GROUPS, 'Other')} AS category_group, {map_sql('category', S.CATEGORY_MARGINS, 0.30, 'DOUBLE')} AS base_gp_margin,
       CAST({map_sql('category', S.CATEGORY_GROUPS, 'Other')} = 'Perishables' AS INTEGER) AS is_fresh_item
FROM (SELECT DISTINCT product_name, category FROM named)""", _FIXED)
SQL["csv_folder"] = with_base("""
SELECT transaction_id, date, store_name, CASE WHEN hour < 12 THEN region END AS region,
       CASE WHEN quantity NOT IN (7, 9) THEN quantity END AS quantity, CAST(total_sgd AS DOUBLE) AS total_sgd,
       CASE WHEN quantity = 9 THEN 'quantity' ELSE '' END AS bad_columns FROM sales""")
SQL["batch_duplicates"] = _after_loads("""
SELECT 'late batch' AS step, CAST(COALESCE(SUM(CASE WHEN stored THEN n END), 0) AS BIGINT) AS already_stored,
       CAST(COALESCE(SUM(CASE WHEN NOT stored THEN n - 1 END), 0) AS BIGINT) AS repeated
FROM (SELECT transaction_id, COUNT(*) AS n, transaction_id IN (SELECT transaction_id FROM base) AS stored FROM batch GROUP BY transaction_id)
UNION ALL SELECT 'late rows alone', 0, 0""")
