"""Raw transactions derived from the TPC-H-like test tables.

The source pipeline reads a flat CSV that is not available; every query
here runs on a ``sales`` frame with the same 30 columns, built from the
test tables by expressions that DuckDB can state identically (the oracle
SQL in :mod:`mercato.plans.oracle` mirrors this file line by line).

Plan shape: orders join customer (custkey); lineitem joins these (orderkey), part
(partkey), supplier (suppkey), then nation and region (25 and 5 rows). No broadcast hint is given: Spark
broadcasts a side only when its size estimate is under
``autoBroadcastJoinThreshold`` (and AQE re-plans on runtime sizes), and
falls back to a shuffled sort-merge join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.functions import calendar as cal
from mercato.functions.lookup import band
from mercato.sources.tables import read_table


def member_tier(acctbal) -> F.Column:
    bal = F.col(acctbal) if isinstance(acctbal, str) else acctbal
    return band(bal, S.FIXTURE_TIER_BOUNDS, S.FIXTURE_TOP_TIER, "double")


def sales_from_tables(spark: SparkSession, sf_dir: str, splits: int | None = None) -> DataFrame:
    """The 30 raw columns (RAW_SCHEMA order) over lineitem's grain.

    ``splits``: deal the line items out over this many tasks first. The bench
    asks for it, since its file is one Parquet row group, which one task reads."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    if splits:
        li = li.repartition(splits)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("store_name"),
                                                            "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))

    # Each join's build side is a plain scan, so its size estimate is the
    # scan's (a pre-joined supplier/nation/region side would be estimated as
    # the product of its inputs and never broadcast).
    # Customers join the orders, a quarter of the line items, so line items are shuffled for the orders alone.
    orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
           .join(part, li.l_partkey == part.p_partkey, "left")
           .join(supplier, li.l_suppkey == supplier.s_suppkey, "left")
           .join(nation, F.col("s_nationkey") == nation.n_nationkey, "left")
           .join(region, F.col("n_regionkey") == region.r_regionkey, "left"))

    d = cal.as_date("l_shipdate")
    price = F.col("l_extendedprice").cast(S.MONEY)
    disc = F.col("l_discount").cast(S.TABLE_RATE)
    tax = F.col("l_tax").cast(S.TABLE_RATE)
    one = F.lit(1).cast(S.TABLE_RATE)
    subtotal = (price * (one - disc)).cast("decimal(18,4)")
    gst_amount = (subtotal * tax).cast("decimal(18,6)")
    margin = F.try_element_at(
        F.create_map(*[x for k, v in S.FIXTURE_CATEGORY_MARGINS.items()
                       for x in (F.lit(k), F.lit(str(v)).cast("decimal(4,2)"))]),
        F.col("p_type"))
    margin = F.coalesce(margin, F.lit(str(S.DEFAULT_GP_MARGIN)).cast("decimal(4,2)"))
    unit_price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))  # NULL for a zero quantity
    year = F.year(d)
    month = F.month(d)

    return j.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    F.date_format(d, "yyyyMMdd")).alias("transaction_id"),
        d.alias("date"),
        # the test tables have dates only: a fixed rule spreads the sales over the day
        F.pmod(F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("l_linenumber"), F.lit(24)).cast("int").alias("hour"),
        F.col("region"),
        F.col("store_name"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("product_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        member_tier("c_acctbal").alias("member_tier"),
        F.col("l_quantity").cast("int").alias("quantity"),
        unit_price.alias("unit_price_sgd"),
        disc.cast(S.RATE).alias("discount_pct"),
        (unit_price * (F.lit(1.0) - F.col("l_discount"))).alias("unit_price_after_disc"),
        subtotal.alias("subtotal_sgd"),
        tax.cast(S.RATE).alias("gst_rate"),
        gst_amount.alias("gst_amount_sgd"),
        (subtotal + gst_amount).cast("decimal(18,6)").alias("total_sgd"),
        (subtotal * margin).cast("decimal(18,6)").alias("gross_profit_sgd"),
        F.col("o_orderpriority").alias("payment_method"),
        (disc >= F.lit(S.FIXTURE_PROMO_MIN_DISCOUNT).cast(S.TABLE_RATE)).cast("int").alias("is_promotion"),
        band(disc, S.FIXTURE_PROMO_BANDS, S.FIXTURE_PROMO_TOP, "decimal(4,2)").alias("promo_type"),
        (F.col("l_returnflag") == "R").cast("int").alias("cdc_voucher_used"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_tourist_purchase"),
        cal.is_weekend(d).alias("is_weekend"),
        (((month == 1) & (F.dayofmonth(d) == 1)) | ((month == 12) & (F.dayofmonth(d) == 25))).cast("int").alias("is_public_holiday"),
        month.isin(11, 12).cast("int").alias("holiday_season_flag"),
        (month == 12).cast("int").alias("bonus_period_flag"),
        band(year, [(b + 1, lbl) for b, lbl in S.FIXTURE_PERIOD_BANDS], S.FIXTURE_PERIOD_TOP).alias("period_label"),
        band(tax, S.FIXTURE_GST_BANDS, S.FIXTURE_GST_TOP, "decimal(4,2)").alias("gst_period"),
        (F.lit(1).cast("decimal(6,4)") + F.lit(S.FIXTURE_INFLATION_STEP).cast("decimal(6,4)")
         * (year - S.FIXTURE_BASE_YEAR)).cast("double").alias("inflation_multiplier"),
    )
