"""Exploratory analyses over the fact and the marts.

Transaction-grain work (KPIs, hourly and weekday roll-ups) is one
aggregate each; everything else reads the already-aggregated marts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.functions import calendar as cal
from mercato.functions import money as M
from mercato.functions.lookup import lookup
from mercato.operators import compare as C
from mercato.operators.quantile import exact_quantiles
from mercato.operators.star import Star


# Q1 -------------------------------------------------------------------------
def kpi_row(fact: DataFrame) -> DataFrame:
    weekend_total = F.sum(F.when(F.col("is_weekend") == 1, F.col("total_sgd")).otherwise(F.lit(0)))
    row = fact.agg(
        F.sum("total_sgd").cast("double").alias("total_revenue"),
        F.count(F.lit(1)).cast("long").alias("total_transactions"),
        M.mean("total_sgd").alias("avg_basket"),
        F.sum("gross_profit_sgd").cast("double").alias("total_gross_profit"),
        (M.safe_ratio(F.sum("gross_profit_sgd"), F.sum("subtotal_sgd")) * 100).alias("gp_margin_pct"),
        (M.mean("is_promotion") * 100).alias("promo_rate_pct"),
        (M.mean("cdc_voucher_used") * 100).alias("cdc_rate_pct"),
        (M.safe_ratio(weekend_total, F.sum("total_sgd")) * 100).alias("weekend_revenue_share_pct"),
        F.round(F.stddev_pop(F.col("total_sgd").cast("double")), 4).alias("basket_std"),
    )
    q = exact_quantiles(fact, "total_sgd", [0.5, 0.95])
    return row.select(
        "*",
        F.round(F.lit(q[0.5]).cast("double"), 2).alias("basket_median"),
        F.round(F.lit(q[0.95]).cast("double"), 2).alias("basket_p95"),
    )


# Q2 -------------------------------------------------------------------------
def monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("period", cal.year_month_label("year", "month")).orderBy("year", "month")


# Q3 -------------------------------------------------------------------------
def yoy(monthly: DataFrame) -> DataFrame:
    """Yearly revenue (exact sum of the monthly figures) and growth vs the
    previous year present. The window runs over one row per year."""
    yearly = monthly.groupBy("year").agg(F.sum(F.col("total_revenue").cast("decimal(30,2)")).alias("rev"))
    w = Window.orderBy("year")
    prev = F.lag("rev").over(w)
    return yearly.select(
        "year",
        F.col("rev").cast("double").alias("revenue"),
        ((M.safe_ratio(F.col("rev"), prev) - 1) * 100).alias("yoy_growth_pct"),
    ).orderBy("year")


# Q4 -------------------------------------------------------------------------
def peak_month(monthly: DataFrame) -> DataFrame:
    return C.arg_max(monthly, "total_revenue", ["year", "month"],
                     ["year", "month", "month_name", "total_revenue"])


# Q5 -------------------------------------------------------------------------
def region_share(regional: DataFrame) -> DataFrame:
    agg = regional.groupBy("region").agg(
        F.sum(F.col("total_revenue").cast("decimal(30,2)")).alias("_rev"),
        F.sum("transactions").cast("long").alias("txns"),
        C.exact_mean("avg_basket").alias("avg_basket"),
        C.exact_mean("gp_margin_pct").alias("gp_margin"),
        C.exact_sum("tourist_revenue").alias("tourist_rev"),
    )
    return C.with_share(agg, "_rev", "revenue_share", cast=None).select(
        "region",
        F.col("_rev").cast("double").alias("revenue"),
        "txns", "avg_basket", "gp_margin", "tourist_rev", "revenue_share",
    ).orderBy(F.col("revenue").desc())


# Q6 -------------------------------------------------------------------------
def category_top(category: DataFrame, k: int = 10) -> DataFrame:
    return C.top_k(category, k, [F.col("total_revenue").desc(), F.col("category")]).select(
        "category", "total_revenue", "gross_profit", "gp_margin_pct", "total_units",
        "promo_rate_pct", "avg_discount_pct")


# Q7 -------------------------------------------------------------------------
def discount_corr(category: DataFrame) -> DataFrame:
    return category.agg(F.round(M.pearson("avg_discount_pct", "total_revenue"), 6).alias("discount_revenue_corr"))


# Q8 -------------------------------------------------------------------------
def tier_multiplier(customer: DataFrame, baseline_tier: str = S.NON_MEMBER) -> DataFrame:
    base = customer.select(C.conditional_mean("avg_basket_size", F.col("member_tier") == baseline_tier)).scalar()
    return (customer
            .select("member_tier", "customer_segment", "avg_basket_size", "total_spend",
                    "total_transactions", "promo_sensitivity_pct",
                    F.round(M.safe_ratio(F.col("avg_basket_size"), base), 4).alias("spend_multiplier"))
            .orderBy(F.col("avg_basket_size").desc()))


# Q9 -------------------------------------------------------------------------
def voucher_lift(cdc: DataFrame) -> DataFrame:
    r = cdc.agg(
        C.conditional_mean("avg_basket", F.col("cdc_voucher_used") == 0).alias("no_voucher"),
        C.conditional_mean("avg_basket", F.col("cdc_voucher_used") == 1).alias("with_voucher"),
    )
    return r.withColumn("voucher_lift_pct", M.lift_pct("no_voucher", "with_voucher"))


# Q10 ------------------------------------------------------------------------
def tax_growth(gst: DataFrame, before: str = S.TAX_PERIOD_BEFORE, after: str = S.TAX_PERIOD_AFTER) -> DataFrame:
    """Basket of the first (lowest-rate) row of each period; NULL when a
    period is missing."""
    r = gst.agg(
        F.min_by(F.when(F.col("gst_period") == before, F.col("avg_basket")),
                 F.when(F.col("gst_period") == before, F.col("gst_rate"))).alias("pre_basket"),
        F.min_by(F.when(F.col("gst_period") == after, F.col("avg_basket")),
                 F.when(F.col("gst_period") == after, F.col("gst_rate"))).alias("post_basket"),
    )
    return r.withColumn("basket_growth_pct", M.lift_pct("pre_basket", "post_basket"))


# Q11 ------------------------------------------------------------------------
def _scale(df: DataFrame, col: str) -> int:
    t = df.schema[col].dataType
    return getattr(t, "scale", 0)


def hourly(sales: DataFrame) -> DataFrame:
    """(hour, is_weekend, total_sgd) rows -> transactions, basket, revenue."""
    return sales.groupBy("hour", "is_weekend").agg(
        F.count(F.lit(1)).cast("long").alias("txns"),
        M.rounded_mean("total_sgd", 2, in_scale=_scale(sales, "total_sgd")).alias("avg_basket"),
        F.round(F.sum("total_sgd").cast("decimal(30,6)"), 2).cast("double").alias("revenue"),
    ).orderBy("hour", "is_weekend")


# Q12 ------------------------------------------------------------------------
def peak_hours(hourly_df: DataFrame) -> DataFrame:
    def peak(flag):
        s = F.max(F.when(F.col("is_weekend") == flag, F.struct(F.col("txns"), (-F.col("hour")).alias("nh"))))
        return (-s.getField("nh")).cast("int")
    return hourly_df.agg(
        peak(0).alias("peak_hour_weekday"),
        peak(1).alias("peak_hour_weekend"),
        (C.conditional_mean("avg_basket", F.col("is_weekend") == 1)
         - C.conditional_mean("avg_basket", F.col("is_weekend") == 0)).alias("weekend_basket_premium"),
    )


# Q13 ------------------------------------------------------------------------
def product_top(product: DataFrame, k: int = 15) -> DataFrame:
    return (C.top_k(product, k, [F.col("total_revenue").desc(), F.col("product_name"), F.col("category")])
            .select("product_name", "category", "total_revenue", "gp_margin_pct", "total_units_sold",
                    F.substring("product_name", 1, 38).alias("product_label")))


# Q14 ------------------------------------------------------------------------
def margin_top(category: DataFrame, k: int = 8) -> DataFrame:
    return C.top_k(category, k, [F.col("gp_margin_pct").desc(), F.col("total_revenue").desc(), F.col("category")])


# Q15 ------------------------------------------------------------------------
def tier_basket(customer: DataFrame, tier_order: list[str] = S.TIER_ORDER) -> DataFrame:
    pos = lookup("member_tier", {t: i + 1 for i, t in enumerate(tier_order)}, None, "int")
    return (customer.groupBy("member_tier").agg(C.exact_mean("avg_basket_size").alias("avg_basket_size"))
            .withColumn("tier_order", pos).filter(F.col("tier_order").isNotNull())
            .orderBy("tier_order"))


# Q16 ------------------------------------------------------------------------
def tier_ratio(customer: DataFrame, top: str = S.TOP_TIER, base: str = S.NON_MEMBER) -> DataFrame:
    return customer.agg(
        M.safe_ratio(C.conditional_mean("avg_basket_size", F.col("member_tier") == top),
                     C.conditional_mean("avg_basket_size", F.col("member_tier") == base)).alias("platinum_vs_non_member"))


# Q33 ------------------------------------------------------------------------
def weekday_sales(star: Star) -> DataFrame:
    j = star.fact.join(star.dim_date.select("date_key", "day_of_week_num", "day_name"), "date_key")
    return j.groupBy("day_of_week_num", "day_name").agg(
        F.count(F.lit(1)).cast("long").alias("transactions"),
        M.money_sum("total_sgd").alias("revenue"),
        M.rounded_mean("total_sgd").alias("avg_basket"),
    ).orderBy("day_of_week_num")


# Q34 ------------------------------------------------------------------------
def payment_share(fact: DataFrame) -> DataFrame:
    agg = fact.groupBy("payment_method").agg(F.count(F.lit(1)).cast("long").alias("transactions"))
    return C.with_share(agg, "transactions", "share_pct", cast=None).orderBy(F.col("transactions").desc())
