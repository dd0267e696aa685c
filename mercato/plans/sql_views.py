"""SQL text as a source: the star and the marts as temporary views.

``register_views`` exposes the warehouse under the table names the source
pipeline's SQL uses (FactSales, DimDate, DimStore, DimProduct, DimCustomer,
mart_*), so a user's SQL runs unchanged through ``spark.sql`` and is planned
by Catalyst like the DataFrame code. User choices are bound as parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import marts as MT
from mercato.operators.star import Star

STAR_VIEWS = {"FactSales": "fact", "DimDate": "dim_date", "DimStore": "dim_store",
              "DimProduct": "dim_product", "DimCustomer": "dim_customer"}
MART_VIEWS = {
    "mart_monthly_sales": "monthly_sales", "mart_regional_sales": "regional_sales",
    "mart_category_profit": "category_profit", "mart_customer_ltv": "customer_ltv",
    "mart_product_ranking": "product_ranking", "mart_cdc_impact": "cdc_impact",
    "mart_gst_analysis": "gst_analysis",
}


def register_views(star: Star, marts: dict[str, DataFrame] | None = None) -> list[str]:
    names = []
    for view, table in STAR_VIEWS.items():
        star.table(table).createOrReplaceTempView(view)
        names.append(view)
    for view, mart in MART_VIEWS.items():
        df = marts[mart] if marts and mart in marts else MT.BUILDERS[mart](star)
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def run_sql(spark: SparkSession, text: str, **values) -> DataFrame:
    """SQL text with named parameters (``:name``); lists become arrays (an empty one needs a cast in the text). Values are never spliced into the text."""
    args = {k: F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else v for k, v in values.items()}
    return spark.sql(text, args=args or None)


#: The dashboard's filter as SQL text: an empty choice means all.
FILTERED_SALES = """
SELECT f.*, d.year, d.month, d.month_name, s.region
FROM FactSales f JOIN DimDate d ON f.date_key = d.date_key JOIN DimStore s ON f.store_key = s.store_key
WHERE (cardinality(:years) = 0 OR array_contains(CAST(:years AS ARRAY<INT>), d.year)) AND (cardinality(:regions) = 0 OR array_contains(CAST(:regions AS ARRAY<STRING>), s.region))"""


def filtered_sales(spark: SparkSession, years: tuple = (), regions: tuple = ()) -> DataFrame:
    """The text above over the registered views."""
    return run_sql(spark, FILTERED_SALES, years=years, regions=regions)
