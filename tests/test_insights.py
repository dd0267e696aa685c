from mercato.operators import marts
from mercato.plans import explore as X
from mercato.plans import insights as I


def test_share_adds_to_100(star):
    rows = I.region_share(marts.regional_sales(star)).collect()
    assert abs(sum(r.revenue_share for r in rows) - 100) < 1e-9
    rows = I.payment_share(star.fact).collect()
    assert abs(sum(r.share_pct for r in rows) - 100) < 1e-9


def test_peak_month_takes_first_on_ties(spark):
    df = spark.createDataFrame([(2023, 5, "May", 10.0), (2022, 7, "July", 10.0), (2024, 1, "January", 3.0)],
                               "year int, month int, month_name string, total_revenue double")
    r = I.peak_month(df).first()
    assert (r.year, r.month) == (2022, 7)


def test_yoy_with_a_missing_year(spark):
    df = spark.createDataFrame([(2022, 1, 100.0), (2022, 2, 100.0), (2024, 1, 300.0)],
                               "year int, month int, total_revenue double")
    rows = {r.year: r for r in I.yoy(df).collect()}
    assert rows[2022].yoy_growth_pct is None
    assert rows[2024].yoy_growth_pct == 50.0


def test_tax_growth_missing_period_is_null(spark):
    df = spark.createDataFrame([("GST9", 0.09, 12.0)], "gst_period string, gst_rate double, avg_basket double")
    r = I.tax_growth(df).first()
    assert r.pre_basket is None and r.basket_growth_pct is None
    df = spark.createDataFrame([("Pre-GST9", 0.08, 10.0), ("Pre-GST9", 0.07, 8.0), ("GST9", 0.09, 12.0)],
                               "gst_period string, gst_rate double, avg_basket double")
    r = I.tax_growth(df).first()
    assert (r.pre_basket, r.post_basket, r.basket_growth_pct) == (8.0, 12.0, 50.0)


def test_peak_hours_and_premium(spark):
    df = spark.createDataFrame([(9, 0, 5, 10.0), (10, 0, 5, 12.0), (14, 1, 7, 20.0), (15, 1, 2, 30.0)],
                               "hour int, is_weekend int, txns long, avg_basket double")
    r = I.peak_hours(df).first()
    assert (r.peak_hour_weekday, r.peak_hour_weekend) == (9, 14)
    assert abs(r.weekend_basket_premium - 14.0) < 1e-12


def test_tier_order_drops_unknown_and_keeps_order(spark):
    df = spark.createDataFrame([("Gold", 5.0), ("Plus", 2.0), ("Mystery", 1.0), ("Gold", 7.0)],
                               "member_tier string, avg_basket_size double")
    rows = I.tier_basket(df).collect()
    assert [(r.member_tier, r.avg_basket_size) for r in rows] == [("Plus", 2.0), ("Gold", 6.0)]


def test_filter_empty_choice_means_all(star):
    n = star.fact.count()
    assert X.filtered_sales(star, X.SalesFilter()).count() == n
    years = [r.year for r in star.dim_date.select("year").distinct().collect()]
    one = X.filtered_sales(star, X.SalesFilter(years=(years[0],))).count()
    assert 0 < one < n


def test_dashboard_rollups_drop_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), ("A", 2.0)], "region string, total_sgd double")
    assert [r.region for r in X.filtered_regions(df).collect()] == ["A"]


def test_kpi_row_median_matches_numpy(star):
    import numpy as np
    vals = np.array([float(r[0]) for r in star.fact.select("total_sgd").collect()])
    r = I.kpi_row(star.fact).first()
    assert r.basket_median == round(float(np.median(vals)), 2)
    assert r.basket_p95 == round(float(np.percentile(vals, 95)), 2)
    assert abs(r.basket_std - float(np.std(vals))) < 1e-3


def test_empty_guard_and_sql_views(spark, star):
    from mercato.plans import sql_views as SV
    assert X.has_rows(star.fact)
    assert not X.has_rows(X.filtered_sales(star, X.SalesFilter(years=(1800,))))
    SV.register_views(star)
    n = SV.run_sql(spark, "SELECT COUNT(*) AS n FROM FactSales f JOIN DimStore s ON f.store_key = s.store_key").first().n
    assert n == star.fact.count()
    m = SV.run_sql(spark, "SELECT SUM(transaction_count) AS n FROM mart_monthly_sales").first().n
    assert m == n


def test_correlation_with_zero_variance_is_nan_not_an_error(spark):
    import math
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], "avg_discount_pct double, total_revenue double")
    assert math.isnan(I.discount_corr(df).first()[0])
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9)], "avg_discount_pct double, total_revenue double")
    import numpy as np
    want = round(float(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]), 6)
    assert I.discount_corr(df).first()[0] == want
