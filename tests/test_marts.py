import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import raw_frame
from mercato.operators import marts
from mercato.operators.star import build_star


def test_every_mart_covers_all_transactions(star):
    n = star.fact.count()
    counts = {
        "monthly_sales": "transaction_count", "regional_sales": "transactions", "category_profit": "transactions",
        "customer_ltv": "total_transactions", "product_ranking": "times_purchased", "cdc_impact": "transactions",
        "gst_analysis": "transactions",
    }
    for name, col in counts.items():
        assert marts.BUILDERS[name](star).agg(F.sum(col)).first()[0] == n, name


def test_revenue_agrees_across_marts(star):
    exact = float(round(star.fact.agg(F.sum("total_sgd")).first()[0], 2))
    for name in marts.BUILDERS:
        col = "total_spend" if name == "customer_ltv" else "total_revenue"
        total = marts.BUILDERS[name](star).agg(F.sum(F.col(col).cast("decimal(30,2)"))).first()[0]
        assert abs(float(total) - exact) < 0.01 * 400, name  # each group rounds to cents


def test_zero_subtotal_gives_null_margin_not_error(spark):
    raw = raw_frame(spark, [dict(transaction_id="a", date=dt.date(2023, 1, 2), category="Beverages",
                                 product_name="p", subtotal_sgd=Decimal("0"), gross_profit_sgd=Decimal("0"),
                                 total_sgd=Decimal("0"))])
    row = marts.category_profit(build_star(raw)).first()
    assert row.gp_margin_pct is None and row.total_revenue == 0.0


def test_sorted_mart_orders_on_read(star):
    rows = marts.sorted_mart(marts.regional_sales(star), "regional_sales").collect()
    revs = [r.total_revenue for r in rows]
    assert revs == sorted(revs, reverse=True)


def test_rounded_mean_breaks_ties_on_the_exact_decimal(spark):
    from mercato.functions import money as M
    df = spark.createDataFrame([("78.94",), ("78.95",), ("-1.005",), ("-1.005",), ("2.5",)], "v string") \
        .selectExpr("cast(v as decimal(18,6)) as v", "cast(v as double) as d")
    one = df.filter("v > 70").agg(M.rounded_mean("v").alias("m")).first().m
    assert one == 78.95  # 78.945 exactly; its nearest double is below the tie
    neg = df.filter("v < 0").agg(M.rounded_mean("v").alias("m")).first().m
    assert neg == -1.01  # half away from zero
    pct = df.filter("v = 2.5").agg(M.rounded_mean("v", 1, in_scale=6, times=100).alias("m")).first().m
    assert pct == 250.0
    assert df.filter("v > 100").agg(M.rounded_mean("v").alias("m")).first().m is None


def test_all_marts_from_one_shared_scan_equal_the_single_marts(star):
    shared = marts.build_marts(star)
    assert list(shared) == list(marts.BUILDERS)
    for name, df in shared.items():
        single = marts.BUILDERS[name](star)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in single.schema], name
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, single.collect()), key=repr), name


def test_shared_partials_read_the_fact_once(star):
    pre = star.fact.groupingSets([list(m.grain) for m in marts.MARTS[:2]], "date_key", "store_key").agg(
        F.count(F.lit(1)).alias("_rows"))
    plan = pre._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Expand" in plan
    shared = marts.shared_partials(star.fact)
    gids = set(shared.gid.values())
    assert len(gids) == len({m.grain for m in marts.MARTS})
    assert {r._gid for r in shared.df.select("_gid").distinct().collect()} == gids


def test_all_marts_take_the_shared_scan(star):
    for name, df in marts.build_marts(star).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "/fact" not in plan and "Expand" not in plan, name  # reads the checkpointed partials
