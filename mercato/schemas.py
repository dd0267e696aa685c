"""Schemas, fixed reference values and run parameters.

Money is carried as exact decimals and turned into doubles only at the
output edge; calendar parts are ints; counts and keys are bigints.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
#: Rates of a source file keep six places; their sums stay on the 64-bit decimal path.
RATE = T.DecimalType(8, 6)
#: Rates of the test tables (two places) inside the adapter's arithmetic.
TABLE_RATE = T.DecimalType(4, 2)

# Raw transaction schema (flat source table). Fixed: no inference.
RAW_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("region", T.StringType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("member_tier", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price_sgd", T.DoubleType()),
    T.StructField("discount_pct", RATE),
    T.StructField("unit_price_after_disc", T.DoubleType()),
    T.StructField("subtotal_sgd", T.DecimalType(18, 4)),
    T.StructField("gst_rate", RATE),
    T.StructField("gst_amount_sgd", T.DecimalType(18, 6)),
    T.StructField("total_sgd", T.DecimalType(18, 6)),
    T.StructField("gross_profit_sgd", T.DecimalType(18, 6)),
    T.StructField("payment_method", T.StringType()),
    T.StructField("is_promotion", T.IntegerType()),
    T.StructField("promo_type", T.StringType()),
    T.StructField("cdc_voucher_used", T.IntegerType()),
    T.StructField("is_tourist_purchase", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("is_public_holiday", T.IntegerType()),
    T.StructField("holiday_season_flag", T.IntegerType()),
    T.StructField("bonus_period_flag", T.IntegerType()),
    T.StructField("period_label", T.StringType()),
    T.StructField("gst_period", T.StringType()),
    T.StructField("inflation_multiplier", T.DoubleType()),
])

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# ---------------------------------------------------------------------------
# These must equal the source pipeline's values for the same
# results. Stated as data, in their natural order.
# ---------------------------------------------------------------------------
# Fact columns in output order: id, 4 keys, measures, degenerate dims, flags.
FACT_COLUMNS = [
    "transaction_id", "date_key", "store_key", "product_key", "customer_key",
    "hour", "quantity", "unit_price_sgd", "discount_pct", "unit_price_after_disc",
    "subtotal_sgd", "gst_rate", "gst_amount_sgd", "total_sgd", "gross_profit_sgd",
    "payment_method", "is_promotion", "promo_type", "cdc_voucher_used",
    "is_tourist_purchase", "is_weekend", "is_public_holiday", "holiday_season_flag",
    "bonus_period_flag", "period_label", "gst_period", "inflation_multiplier",
]
REQUIRED_COLUMNS = [
    "transaction_id", "date", "region", "store_name", "category",
    "product_name", "quantity", "total_sgd", "payment_method",
]

STORE_SIZES = {
    "Jurong Point Central": "Large", "Bishan Junction": "Medium",
    "Plaza Singapura": "Large", "Causeway Point": "Large",
    "Sembawang Shopping": "Medium", "Northpoint City": "Large",
    "Compass One": "Medium", "Hougang Mall": "Medium",
    "NEX Serangoon": "Large", "Tampines Mall": "Large",
    "Changi City Point": "Medium", "Eastpoint Mall": "Medium",
    "JEM Jurong": "Large", "Westgate": "Large",
    "IMM Jurong": "Large",
}
TOURIST_AREAS = {
    "Jurong Point Central": 1, "Bishan Junction": 0, "Plaza Singapura": 1,
    "Causeway Point": 0, "Sembawang Shopping": 0, "Northpoint City": 0,
    "Compass One": 0, "Hougang Mall": 0, "NEX Serangoon": 0,
    "Tampines Mall": 0, "Changi City Point": 1, "Eastpoint Mall": 0,
    "JEM Jurong": 1, "Westgate": 1, "IMM Jurong": 1,
}
CATEGORY_MARGINS = {
    "Fresh Produce": 0.22, "Dairy & Eggs": 0.28, "Beverages": 0.32,
    "Snacks & Confectionery": 0.38, "Frozen Foods": 0.30,
    "Household Supplies": 0.35, "Personal Care": 0.42,
    "Bakery & Bread": 0.45, "Meat & Seafood": 0.25, "Rice & Grains": 0.18,
    "Condiments & Sauces": 0.33, "Baby Products": 0.40,
    "Health & Wellness": 0.48, "Ready Meals": 0.35, "Alcohol & Spirits": 0.45,
}
CATEGORY_GROUPS = {
    "Fresh Produce": "Perishables", "Dairy & Eggs": "Perishables",
    "Meat & Seafood": "Perishables", "Bakery & Bread": "Perishables",
    "Beverages": "Non-Perishables", "Snacks & Confectionery": "Non-Perishables",
    "Frozen Foods": "Non-Perishables", "Rice & Grains": "Non-Perishables",
    "Ready Meals": "Non-Perishables", "Condiments & Sauces": "Non-Perishables",
    "Alcohol & Spirits": "Non-Perishables",
    "Household Supplies": "Non-Food", "Personal Care": "Non-Food",
    "Baby Products": "Non-Food", "Health & Wellness": "Non-Food",
}
TIER_RANKS = {"Non-Member": 1, "Plus": 2, "Silver": 3, "Gold": 4, "Platinum": 5}
TIER_ORDER = ["Non-Member", "Plus", "Silver", "Gold", "Platinum"]
VALID_GST_RATES = (0.07, 0.08, 0.09)
DEFAULT_STORE_SIZE = "Medium"
DEFAULT_TOURIST_AREA = 0
DEFAULT_CATEGORY_GROUP = "Other"
DEFAULT_GP_MARGIN = 0.30
DEFAULT_TIER_RANK = 1
FRESH_GROUP = "Perishables"
NON_MEMBER = "Non-Member"
NO_PROMOTION = "No Promotion"
FISCAL_YEAR_START_MONTH = 4
TOP_TIER = "Platinum"
TAX_PERIOD_BEFORE = "Pre-GST9"
TAX_PERIOD_AFTER = "GST9"
VOUCHER_LABELS = {0: "No CDC Voucher", 1: "With CDC Voucher"}
STORE_TABLE_NAMES = {
    "revenue": "Revenue (SGD)", "txns": "Transactions", "avg_basket": "Avg Basket",
    "gp_margin": "GP Margin %", "tourist_rev": "Tourist Revenue",
}
PRODUCT_TABLE_NAMES = {
    "total_revenue": "Revenue (SGD)", "gp_margin_pct": "GP%",
    "total_units_sold": "Units Sold", "avg_discount_given": "Avg Discount %",
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class StarConfig:
    """Lookups used to enrich the dimensions (defaults: the fixed values)."""

    store_sizes: dict = field(default_factory=lambda: dict(STORE_SIZES))
    tourist_areas: dict = field(default_factory=lambda: dict(TOURIST_AREAS))
    category_margins: dict = field(default_factory=lambda: dict(CATEGORY_MARGINS))
    category_groups: dict = field(default_factory=lambda: dict(CATEGORY_GROUPS))
    tier_ranks: dict = field(default_factory=lambda: dict(TIER_RANKS))
    default_store_size: str = DEFAULT_STORE_SIZE
    default_tourist_area: int = DEFAULT_TOURIST_AREA
    default_category_group: str = DEFAULT_CATEGORY_GROUP
    default_gp_margin: float = DEFAULT_GP_MARGIN
    default_tier_rank: int = DEFAULT_TIER_RANK


@dataclass(frozen=True)
class CheckConfig:
    """Parameters of the quality checks (defaults: the fixed values)."""

    valid_gst_rates: tuple = VALID_GST_RATES
    min_year: int = 2022
    max_year: int = 2024
    expected_regions: int = 5
    expected_years: int = 3
    min_monthly_transactions: int = 500
    total_tolerance: float = 0.02
    price_tolerance: float = 0.01


# ---------------------------------------------------------------------------
# Parameters of the test-table adapter (sources.sales): our own choices for
# mapping the TPC-H-like tables onto the retail columns.
# ---------------------------------------------------------------------------
FIXTURE_CATEGORY_MARGINS = {
    "ECONOMY": 0.18, "SMALL": 0.25, "MEDIUM": 0.30,
    "PROMO": 0.22, "STANDARD": 0.35, "LARGE": 0.40,
}
# LARGE is left out on purpose so the "Other" default is exercised.
FIXTURE_CATEGORY_GROUPS = {
    "ECONOMY": "Non-Perishables", "SMALL": "Perishables", "MEDIUM": "Non-Food",
    "PROMO": "Perishables", "STANDARD": "Non-Food",
}
FIXTURE_STORE_SIZES = {
    "Supplier#000000001": "Large", "Supplier#000000002": "Small",
    "Supplier#000000003": "Large", "Supplier#000000005": "Large",
    "Supplier#000000008": "Small", "Supplier#000000013": "Large",
}
FIXTURE_TOURIST_AREAS = {
    "Supplier#000000001": 1, "Supplier#000000004": 1,
    "Supplier#000000007": 1, "Supplier#000000010": 1,
}
# c_acctbal upper bounds of the loyalty tiers (last tier is open-ended).
FIXTURE_TIER_BOUNDS = [(0.0, "Non-Member"), (2500.0, "Plus"), (5000.0, "Silver"), (7500.0, "Gold")]
FIXTURE_TOP_TIER = "Platinum"
# l_discount bands -> promo_type; the last band keeps "No Promotion" while the
# promotion flag is set, which seeds the promo consistency check.
FIXTURE_PROMO_BANDS = [("0.01", NO_PROMOTION), ("0.05", "Member Price"),
                       ("0.08", "Weekly Deal"), ("0.10", "Clearance")]
FIXTURE_PROMO_TOP = NO_PROMOTION
FIXTURE_PROMO_MIN_DISCOUNT = "0.05"
# l_tax bands -> gst_period
FIXTURE_GST_BANDS = [("0.03", "GST7"), ("0.06", "Pre-GST9")]
FIXTURE_GST_TOP = "GST9"
# ship year bands -> period_label
FIXTURE_PERIOD_BANDS = [(1996, "Pre-Voucher"), (1998, "Voucher Wave 1")]
FIXTURE_PERIOD_TOP = "Voucher Wave 2"
FIXTURE_BASE_YEAR = 1995
FIXTURE_INFLATION_STEP = "0.02"


def fixture_star_config() -> StarConfig:
    return StarConfig(
        store_sizes=dict(FIXTURE_STORE_SIZES),
        tourist_areas=dict(FIXTURE_TOURIST_AREAS),
        category_margins=dict(FIXTURE_CATEGORY_MARGINS),
        category_groups=dict(FIXTURE_CATEGORY_GROUPS),
    )
