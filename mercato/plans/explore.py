"""Dashboard questions: filtered sales and drill-downs over the marts.

``SalesFilter`` replaces SQL text splicing: the year and region choices
become ``isin`` predicates on the dimension columns, an empty choice means
"all", and Catalyst pushes them into the dimension scans (and, through
dynamic partition pruning, into a year/month partitioned fact).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.functions import calendar as cal
from mercato.functions import money as M
from mercato.functions.lookup import lookup
from mercato.operators import compare as C
from mercato.operators.star import Star

VOUCHER_LABELS = S.VOUCHER_LABELS


@dataclass(frozen=True)
class SalesFilter:
    years: tuple = field(default_factory=tuple)
    regions: tuple = field(default_factory=tuple)

    def dates(self, dim_date: DataFrame) -> DataFrame:
        d = dim_date.select("date_key", "year", "month", "month_name")
        return d.filter(F.col("year").isin(list(self.years))) if self.years else d

    def stores(self, dim_store: DataFrame) -> DataFrame:
        s = dim_store.select("store_key", "region")
        return s.filter(F.col("region").isin(list(self.regions))) if self.regions else s


def money_view(df: DataFrame) -> DataFrame:
    dec = {"discount_pct", "subtotal_sgd", "gst_rate", "gst_amount_sgd", "total_sgd", "gross_profit_sgd"}
    return df.select(*[F.col(c).cast("double").alias(c) if c in dec else F.col(c) for c in df.columns])


# Q17 ------------------------------------------------------------------------
def filtered_sales(star: Star, flt: SalesFilter) -> DataFrame:
    """Fact rows plus year, month, month_name and region, inside the filter.

    When the fact is stored in year/month partitions the year choice is also
    applied to the partition column, so only the chosen years' files are
    listed and read (partition pruning), and the region choice to the stored
    region that the rows are clustered by (row groups are skipped); the joins
    keep the semantics identical either way."""
    fact = star.fact
    if star.fact_by_month is not None:
        fact = star.fact_by_month
        if flt.years:
            fact = fact.filter(F.col("year").isin(list(flt.years)))
        if flt.regions and "region" in fact.columns:
            fact = fact.filter(F.col("region").isin(list(flt.regions)))
        fact = fact.select(*star.fact.columns)
    return (fact.join(flt.dates(star.dim_date), "date_key")
            .join(flt.stores(star.dim_store), "store_key"))


def has_rows(df: DataFrame) -> bool:
    """Empty-result guard for a filter choice (reads at most one row)."""
    return not df.isEmpty()


# Q18 ------------------------------------------------------------------------
def filtered_kpis(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.sum("total_sgd").cast("double").alias("total_revenue"),
        F.count(F.lit(1)).cast("long").alias("total_transactions"),
        M.mean("total_sgd").alias("avg_basket"),
        F.sum("gross_profit_sgd").cast("double").alias("total_gross_profit"),
        (M.safe_ratio(F.sum("gross_profit_sgd"), F.sum("subtotal_sgd")) * 100).alias("gp_margin_pct"),
    )


def _drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """pandas groupby drops NULL keys; SQL keeps them. Dashboard roll-ups
    follow pandas."""
    return df.dropna(subset=keys)


# Q19 ------------------------------------------------------------------------
def filtered_monthly(sales: DataFrame) -> DataFrame:
    keys = ["year", "month", "month_name"]
    return (_drop_null_keys(sales, keys).groupBy(*keys).agg(
        F.sum("total_sgd").cast("double").alias("revenue"),
        F.count("transaction_id").cast("long").alias("transactions"),
        M.mean("total_sgd").alias("avg_basket"),
    ).withColumn("period", cal.year_month_label("year", "month")).orderBy("year", "month"))


# Q20 ------------------------------------------------------------------------
def filtered_regions(sales: DataFrame) -> DataFrame:
    return _drop_null_keys(sales, ["region"]).groupBy("region").agg(
        F.sum("total_sgd").cast("double").alias("total_sgd"))


# Q21 ------------------------------------------------------------------------
def filtered_years(sales: DataFrame) -> DataFrame:
    return _drop_null_keys(sales, ["year"]).groupBy("year").agg(
        F.sum("total_sgd").cast("double").alias("revenue"),
        F.count("transaction_id").cast("long").alias("transactions"),
        M.mean("total_sgd").alias("avg_basket"),
        F.sum("gross_profit_sgd").cast("double").alias("gp"),
    ).orderBy("year")


# Q22 ------------------------------------------------------------------------
def store_performance(regional: DataFrame) -> DataFrame:
    keys = ["region", "store_name", "store_size", "is_tourist_area"]
    return regional.groupBy(*keys).agg(
        C.exact_sum("total_revenue").alias("revenue"),
        F.sum("transactions").cast("long").alias("txns"),
        C.exact_mean("avg_basket").alias("avg_basket"),
        C.exact_mean("gp_margin_pct").alias("gp_margin"),
        C.exact_sum("tourist_revenue").alias("tourist_rev"),
        F.sum("weekend_txns").cast("long").alias("wknd_txns"),
    ).orderBy(F.col("revenue").desc())


# Q23 ------------------------------------------------------------------------
def region_summary(stores: DataFrame) -> DataFrame:
    return _drop_null_keys(stores, ["region"]).groupBy("region").agg(
        C.exact_sum("revenue").alias("revenue"),
        F.sum("txns").cast("long").alias("txns"),
        C.exact_mean("avg_basket", 6).alias("avg_basket"),
        C.exact_mean("gp_margin", 6).alias("gp_margin"),
        C.exact_sum("tourist_rev").alias("tourist_rev"),
    ).orderBy(F.col("revenue").desc())


# Q24 ------------------------------------------------------------------------
STORE_TABLE_NAMES = S.STORE_TABLE_NAMES


def store_table(stores: DataFrame) -> DataFrame:
    cols = ["region", "store_name", "store_size", "revenue", "txns", "avg_basket", "gp_margin", "tourist_rev"]
    return stores.select(*cols).withColumnsRenamed(STORE_TABLE_NAMES).orderBy(F.col("`Revenue (SGD)`").desc())


# Q25 ------------------------------------------------------------------------
def category_list(category: DataFrame) -> DataFrame:
    return category.orderBy(F.col("total_revenue").desc())


# Q26 ------------------------------------------------------------------------
PRODUCT_TABLE_NAMES = S.PRODUCT_TABLE_NAMES


def product_table(product: DataFrame, k: int = 20) -> DataFrame:
    top = C.top_k(product, k, [F.col("total_revenue").desc(), F.col("product_name"), F.col("category")])
    return top.select("product_name", "category", "total_revenue", "gp_margin_pct",
                      "total_units_sold", "avg_discount_given").withColumnsRenamed(PRODUCT_TABLE_NAMES)


# Q27 ------------------------------------------------------------------------
def tier_summary(customer: DataFrame, tier_order: list[str] = S.TIER_ORDER) -> DataFrame:
    pos = lookup("member_tier", {t: i + 1 for i, t in enumerate(tier_order)}, None, "int")
    return (customer.groupBy("member_tier").agg(
        C.exact_mean("avg_basket_size").alias("avg_basket"),
        C.exact_sum("total_spend").alias("total_spend"),
        F.sum("total_transactions").cast("long").alias("transactions"),
    ).withColumn("tier_order", pos).filter(F.col("tier_order").isNotNull()).orderBy("tier_order"))


# Q28 ------------------------------------------------------------------------
def segment_spend(customer: DataFrame) -> DataFrame:
    return _drop_null_keys(customer, ["customer_segment"]).groupBy("customer_segment").agg(
        C.exact_sum("total_spend").alias("total_spend"))


# Q29 ------------------------------------------------------------------------
def payment_methods(fact: DataFrame) -> DataFrame:
    return fact.groupBy("payment_method").agg(
        F.count(F.lit(1)).cast("long").alias("txns"),
        M.money_sum("total_sgd").alias("revenue"),
    ).orderBy(F.col("revenue").desc())


# Q30 ------------------------------------------------------------------------
def voucher_compare(cdc: DataFrame) -> DataFrame:
    return (_drop_null_keys(cdc, ["cdc_voucher_used"]).groupBy("cdc_voucher_used").agg(
        C.exact_mean("avg_basket").alias("avg_basket"),
        C.exact_sum("total_revenue").alias("total_rev"),
        F.sum("transactions").cast("long").alias("transactions"),
    ).withColumn("label", lookup("cdc_voucher_used", VOUCHER_LABELS, None)))


# Q31 ------------------------------------------------------------------------
def voucher_compare_lift(compare: DataFrame) -> DataFrame:
    r = compare.agg(
        F.max(F.when(F.col("cdc_voucher_used") == 0, F.col("avg_basket"))).alias("no_voucher"),
        F.max(F.when(F.col("cdc_voucher_used") == 1, F.col("avg_basket"))).alias("with_voucher"),
    )
    return r.withColumn("lift_pct", M.lift_pct("no_voucher", "with_voucher"))


# Q32 ------------------------------------------------------------------------
def tax_periods(gst: DataFrame) -> DataFrame:
    return gst.orderBy("gst_rate")
