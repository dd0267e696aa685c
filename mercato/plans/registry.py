"""Registered queries (name -> builder) and their oracle SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import marts
from mercato.operators import star as ST
from mercato.operators.star import orphan_counts
from mercato.plans import oracle as O
from mercato.plans import warehouse as W
from mercato.session import shuffles_dropped
from mercato.sources.sales import sales_from_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# -- star ------------------------------------------------------------------
DECIMAL_FACT_COLS = ["discount_pct", "subtotal_sgd", "gst_rate", "gst_amount_sgd", "total_sgd", "gross_profit_sgd"]


register("dim_date", O.with_base("SELECT * FROM dim_date"))(lambda s, d: W.star(s, d).dim_date)
register("dim_store", O.with_base("SELECT * FROM dim_store"))(lambda s, d: W.star(s, d).dim_store)
register("dim_product", O.with_base("SELECT * FROM dim_product"))(lambda s, d: W.star(s, d).dim_product)
register("dim_customer", O.with_base("SELECT * FROM dim_customer"))(lambda s, d: W.star(s, d).dim_customer)
register("fact_sales", O.with_base(
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in DECIMAL_FACT_COLS else c
                          for c in __import__("mercato.schemas", fromlist=["FACT_COLUMNS"]).FACT_COLUMNS)
    + " FROM fact"))(lambda s, d: X.money_view(W.star(s, d).fact))
register("fact_orphans", O.with_base(
    "SELECT " + ", ".join(f"CAST(COUNT(*) FILTER (WHERE {k} IS NULL) AS BIGINT) AS {k}_orphans"
                          for k in ("date_key", "store_key", "product_key", "customer_key")) + " FROM fact"))(
    lambda s, d: orphan_counts(W.star(s, d).fact))

# -- marts -----------------------------------------------------------------
MART_QUERY_NAMES = {
    "mart_monthly": "monthly_sales",
    "mart_regional": "regional_sales",
    "mart_category": "category_profit",
    "mart_customer": "customer_ltv",
    "mart_product": "product_ranking",
    "mart_voucher": "cdc_impact",
    "mart_tax": "gst_analysis",
}


def _mart_query(mart: str):
    return lambda s, d: marts.BUILDERS[mart](W.star(s, d))


for _q, _m in MART_QUERY_NAMES.items():
    register(_q, O.with_base(f"SELECT * FROM mart_{_m}"))(_mart_query(_m))


# -- analyses (Q1-Q16, Q33, Q34) -----------------------------------------------
from mercato.plans import insights as I  # noqa: E402
from mercato.plans import explore as X  # noqa: E402
from mercato.plans import oracle_queries as OQ  # noqa: E402


def _mart(s, d, name):
    """The stored mart; analyses never go back to the fact for it."""
    return W.marts(s, d)[name]


register("kpi_row", OQ.SQL["kpi_row"])(lambda s, d: I.kpi_row(W.star(s, d).fact))
register("monthly_trend", OQ.SQL["monthly_trend"])(lambda s, d: I.monthly_trend(_mart(s, d, "monthly_sales")))
register("yoy", OQ.SQL["yoy"])(lambda s, d: I.yoy(_mart(s, d, "monthly_sales")))
register("peak_month", OQ.SQL["peak_month"])(lambda s, d: I.peak_month(_mart(s, d, "monthly_sales")))
register("region_share", OQ.SQL["region_share"])(lambda s, d: I.region_share(_mart(s, d, "regional_sales")))
register("category_top", OQ.SQL["category_top"])(lambda s, d: I.category_top(_mart(s, d, "category_profit")))
register("discount_corr", OQ.SQL["discount_corr"])(lambda s, d: I.discount_corr(_mart(s, d, "category_profit")))
register("tier_multiplier", OQ.SQL["tier_multiplier"])(lambda s, d: I.tier_multiplier(_mart(s, d, "customer_ltv")))
register("voucher_lift", OQ.SQL["voucher_lift"])(lambda s, d: I.voucher_lift(_mart(s, d, "cdc_impact")))
register("tax_growth", OQ.SQL["tax_growth"])(lambda s, d: I.tax_growth(_mart(s, d, "gst_analysis")))
register("hourly", OQ.SQL["hourly"])(lambda s, d: I.hourly(W.star(s, d).fact))
register("peak_hours", OQ.SQL["peak_hours"])(
    lambda s, d: I.peak_hours(I.hourly(W.star(s, d).fact)))
register("product_top", OQ.SQL["product_top"])(lambda s, d: I.product_top(_mart(s, d, "product_ranking")))
register("margin_top", OQ.SQL["margin_top"])(lambda s, d: I.margin_top(_mart(s, d, "category_profit")))
register("tier_basket", OQ.SQL["tier_basket"])(lambda s, d: I.tier_basket(_mart(s, d, "customer_ltv")))
register("tier_ratio", OQ.SQL["tier_ratio"])(lambda s, d: I.tier_ratio(_mart(s, d, "customer_ltv")))
register("weekday_sales", OQ.SQL["weekday_sales"])(lambda s, d: I.weekday_sales(W.star(s, d)))
register("payment_share", OQ.SQL["payment_share"])(lambda s, d: I.payment_share(W.star(s, d).fact))

# -- dashboard (Q17-Q32) --------------------------------------------------------
DEFAULT_FILTER = X.SalesFilter(years=OQ.FILTER_YEARS, regions=OQ.FILTER_REGIONS)


def _filtered(s, d):
    return X.filtered_sales(W.star(s, d), DEFAULT_FILTER)


register("filtered_sales", OQ.SQL["filtered_sales"])(lambda s, d: X.money_view(_filtered(s, d)))
register("filtered_kpis", OQ.SQL["filtered_kpis"])(lambda s, d: X.filtered_kpis(_filtered(s, d)))
register("filtered_monthly", OQ.SQL["filtered_monthly"])(lambda s, d: X.filtered_monthly(_filtered(s, d)))
register("filtered_regions", OQ.SQL["filtered_regions"])(lambda s, d: X.filtered_regions(_filtered(s, d)))
register("filtered_years", OQ.SQL["filtered_years"])(lambda s, d: X.filtered_years(_filtered(s, d)))
register("store_performance", OQ.SQL["store_performance"])(
    lambda s, d: X.store_performance(_mart(s, d, "regional_sales")))
register("region_summary", OQ.SQL["region_summary"])(
    lambda s, d: X.region_summary(X.store_performance(_mart(s, d, "regional_sales"))))
register("store_table", OQ.SQL["store_table"])(
    lambda s, d: X.store_table(X.store_performance(_mart(s, d, "regional_sales"))))
register("category_list", OQ.SQL["category_list"])(lambda s, d: X.category_list(_mart(s, d, "category_profit")))
register("product_table", OQ.SQL["product_table"])(lambda s, d: X.product_table(_mart(s, d, "product_ranking")))
register("tier_summary", OQ.SQL["tier_summary"])(lambda s, d: X.tier_summary(_mart(s, d, "customer_ltv")))
register("segment_spend", OQ.SQL["segment_spend"])(lambda s, d: X.segment_spend(_mart(s, d, "customer_ltv")))
register("payment_methods", OQ.SQL["payment_methods"])(lambda s, d: X.payment_methods(W.star(s, d).fact))
register("voucher_compare", OQ.SQL["voucher_compare"])(lambda s, d: X.voucher_compare(_mart(s, d, "cdc_impact")))
register("voucher_compare_lift", OQ.SQL["voucher_compare_lift"])(
    lambda s, d: X.voucher_compare_lift(X.voucher_compare(_mart(s, d, "cdc_impact"))))
register("tax_periods", OQ.SQL["tax_periods"])(lambda s, d: X.tax_periods(_mart(s, d, "gst_analysis")))

# -- quality checks (K1-K27) ------------------------------------------------------
from mercato.operators import quality as Q  # noqa: E402
from mercato.sources import profile as P  # noqa: E402
from mercato.streaming import incremental as INC  # noqa: E402


def _dq(group: str):
    return lambda s, d: Q.run_checks(W.star(s, d), groups=(group,))


for _g in ("nulls", "duplicates", "ranges", "orphans", "logic", "distribution"):
    register(f"dq_{_g}", OQ.SQL[f"dq_{_g}"])(_dq(_g))
register("dq_results", OQ.SQL["dq_results"])(lambda s, d: Q.run_checks(W.star(s, d)))
register("dq_score", OQ.SQL["dq_score"])(lambda s, d: Q.score(Q.run_checks(W.star(s, d))))

# -- ingest profile, pre-load checks, table counts ---------------------------------
register("source_profile", OQ.SQL["source_profile"])(lambda s, d: P.source_profile(W.sales(s, d)))
register("preload_issues", OQ.SQL["preload_issues"])(lambda s, d: P.preload_issues(W.sales(s, d)))


def _table_counts(s, d):
    st = W.star(s, d)
    tables = {n: st.table(n) for n in st.TABLES}
    tables.update({f"mart_{m}": df for m, df in W.marts(s, d).items()})
    return P.table_counts(tables)


register("table_counts", OQ.SQL["table_counts"])(_table_counts)


# -- incremental load (upsert by key, quarantine) ------------------------------------
def _upsert(s, d):
    cols = ["transaction_id", "date", "store_name", "product_name", "quantity", "total_sgd"]
    sales = W.sales(s, d).select(*cols)
    base = sales.filter(F.col("date") < F.lit(OQ.UPSERT_BASE_BEFORE).cast("date"))
    batch = sales.filter(F.col("date") >= F.lit(OQ.UPSERT_BATCH_FROM).cast("date"))
    merged = INC.upsert(base, batch, "transaction_id", ["date", "store_name", "product_name", "quantity", "total_sgd"])
    return merged.withColumn("total_sgd", F.col("total_sgd").cast("double"))


register("upsert", OQ.SQL["upsert"])(_upsert)
register("quarantine", OQ.SQL["quarantine"])(
    lambda s, d: INC.quarantine(W.star(s, d).fact).select("transaction_id", "date_key", "failed_checks", "quarantined"))


# -- written tables: CSV round trip, append, load check, sample, report -----------------------
from pyspark.sql import types as T  # noqa: E402

from mercato import schemas as S  # noqa: E402
from mercato.sources import csv_ingest as CI  # noqa: E402
from mercato.sources import sinks  # noqa: E402
from mercato.sources.loads import LoadedTable  # noqa: E402


def _csv_ingest(s, d):
    """The raw table written as CSV files (gzip: a quarter of the text's size) and read back through the fixed schema; flags must stay empty."""
    path = W.scratch(s, d, "csv")
    W.sales(s, d).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
    got = CI.read_transactions_csv(s, path)
    money = [f.name for f in S.RAW_SCHEMA.fields if isinstance(f.dataType, T.DecimalType)]
    return got.select(*[F.col(c).cast("double").alias(c) if c in money else F.col(c) for c in S.RAW_COLUMNS],
                      *[F.coalesce(F.col(c), F.lit("")).alias(c.lstrip("_")) for c in CI.FLAGS])


def _append_load(s, d):
    """Two loads into one table, the second appended and then repeated; rows and money per store of the stored table."""
    table = LoadedTable(s, W.scratch(s, d, "append"))
    sales = W.sales(s, d).select("transaction_id", "date", "store_name", "total_sgd")
    first = F.coalesce(F.col("date") < F.lit(OQ.UPSERT_BATCH_FROM).cast("date"), F.lit(False))
    table.append(sales.filter(first), "first")
    for _ in range(2):
        table.append(sales.filter(~first), "second")
    return (table.read().groupBy("store_name")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_sgd").cast("double").alias("total")))


def _load_check(s, d):
    """Rows of the source against the rows of the stored raw table."""
    source = sales_from_tables(s, d).agg(F.count(F.lit(1))).scalar()
    stored = W.sales(s, d).agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(source.alias("expected"), "stored").withColumn("ok", F.col("expected") == F.col("stored"))


def _quality_report(s, d):
    """The stored JSON report, read back."""
    path = W.scratch(s, d, "report.json")
    results = Q.run_checks(W.star(s, d))
    sinks.write_quality_report(results, Q.score(results), path)
    line = F.transform("test_details", lambda t: F.concat_ws(" | ", t["test_name"], t["status"], t["detail"], t["severity"]))
    return s.read.schema(sinks.REPORT_SCHEMA).json(path).select(
        "quality_score", "total_tests", "passed", "failed", "grade", F.array_join(line, "\n").alias("details"))


register("csv_ingest", OQ.SQL["csv_ingest"])(_csv_ingest)
register("append_load", OQ.SQL["append_load"])(_append_load)
register("load_check", OQ.SQL["load_check"])(_load_check)
register("sample_rows", OQ.SQL["sample_rows"])(lambda s, d: sinks.sample_rows(
    W.sales(s, d), ["transaction_id", "date", "store_name"], 3, ["date", "transaction_id"]))
register("quality_report", OQ.SQL["quality_report"])(_quality_report)


# -- SQL text over the warehouse views (A4) ---------------------------------------------
from mercato.plans import sql_views as SV  # noqa: E402

PAYMENT_SQL = """
SELECT payment_method, CAST(COUNT(*) AS BIGINT) AS txns, CAST(ROUND(SUM(total_sgd), 2) AS DOUBLE) AS revenue
FROM FactSales GROUP BY payment_method"""


def _sql_payment(s, d):
    SV.register_views(W.star(s, d))
    return SV.run_sql(s, PAYMENT_SQL)


register("sql_payment_methods", OQ.SQL["payment_methods"])(_sql_payment)


# -- incremental loads: stored upsert, keys and marts after it (X1, E1, M1-M7) ------------------
from datetime import datetime  # noqa: E402

from mercato.plans import loading as L  # noqa: E402

FIRST_LOAD, LATE_LOAD = datetime(2024, 1, 1), datetime(2024, 2, 1)


def base_rows(sales: DataFrame) -> DataFrame:
    return sales.filter("hour <> 11")


def late_batch(sales: DataFrame) -> DataFrame:
    """Corrections (another day, a new store, other money; some with an outdated twin), rows that came late, and new rows.

    One scan: a row is given out once for each of these that it serves."""
    hour = F.col("hour")
    fix = F.coalesce((F.col("date") >= F.lit(OQ.UPSERT_BATCH_FROM).cast("date")) & (hour % 3 == 0), F.lit(False))
    uses = {"fix": fix, "twin": fix & (hour == 21), "late": hour == 11, "new": hour == 5}
    given = (sales.filter(fix | (hour == 11) | (hour == 5))
             .withColumn("_use", F.explode(F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in uses.items()])))))
    fixed, new = F.col("_use").isin("fix", "twin"), F.col("_use") == "new"
    day = F.when(hour % 2 == 0, F.date_add("date", 31)).otherwise(F.col("date"))
    changed = {
        "transaction_id": F.when(new, F.concat("transaction_id", F.lit("-b"))),
        "date": F.when(F.col("_use") == "twin", F.date_sub(day, 1)).when(fixed, day),
        "store_name": F.when(fixed & (F.col("quantity") % 5 == 0), F.concat(F.lit("New "), "store_name")),
        "product_name": F.when(new & (F.col("quantity") > 40), F.concat("product_name", F.lit(" v2"))),
        "subtotal_sgd": F.when(fixed, (F.col("subtotal_sgd") + 1).cast("decimal(18,4)")),
        "total_sgd": F.when(fixed, (F.col("total_sgd") + 1).cast("decimal(18,6)")),
    }
    return given.select(*[changed[c].otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in sales.columns])


_LOADED: dict = {}


def loaded(s, d) -> L.LoadedWarehouse:
    """The warehouse after both loads, the second one repeated."""
    key = W._key(s, d)
    if key not in _LOADED:
        w = L.LoadedWarehouse(s, W.scratch(s, d, "loaded"), S.fixture_star_config())
        sales = W.sales(s, d)
        with shuffles_dropped(s):
            w.load(base_rows(sales), "base", FIRST_LOAD)
            for _ in range(2):
                w.load(late_batch(sales), "late", LATE_LOAD)
        _LOADED[key] = w
    return _LOADED[key]


def _moment(c: str = "loaded_at"):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("loaded_at")


def _upsert_table(s, d):
    """Rows of a stored table after two loads, the second upserted and then repeated."""
    cols = ["transaction_id", "date", "store_name", "product_name", "quantity", "total_sgd"]
    table = LoadedTable(s, W.scratch(s, d, "upsert"), ("year", "month"))
    sales = W.sales(s, d)
    for rows, name, moment in ((base_rows(sales), "base", FIRST_LOAD), (late_batch(sales), "late", LATE_LOAD), (late_batch(sales), "late", LATE_LOAD)):
        table.upsert(sinks.with_year_month(rows.select(*cols)), "transaction_id", ["date"], name, moment)
    return table.read().select(*[c for c in cols if c != "total_sgd"], F.col("total_sgd").cast("double").alias("total_sgd"), _moment(), "year", "month")


register("upsert_table", OQ.SQL["upsert_table"])(_upsert_table)
register("load_ledger", OQ.SQL["load_ledger"])(
    lambda s, d: loaded(s, d).fact.ledger().select("version", "load_id", _moment(), "rows", "stored_rows"))
for _d in ("date", "store", "product", "customer"):
    register(f"load_dim_{_d}", OQ.SQL[f"load_dim_{_d}"])(lambda s, d, n=f"dim_{_d}": loaded(s, d).dim(n))


def _load_fact(s, d):
    rows = loaded(s, d).fact.read()
    return rows.select(*[F.col(c).cast("double").alias(c) if c in DECIMAL_FACT_COLS else F.col(c) for c in S.FACT_COLUMNS], _moment())


register("load_fact", OQ.SQL["load_fact"])(_load_fact)
for _m in marts.MART_SPECS:
    register(f"load_mart_{_m}", OQ.SQL[f"load_mart_{_m}"])(lambda s, d, n=_m: loaded(s, d).mart(n))


# -- sketches per year and region, held against the exact answers (D13, D15) -----------------------
from mercato.operators import sketch as K  # noqa: E402


def _sketch_check(s, d):
    """Per region and in all: do the merged sketches answer within their stated error? The exact rank of an estimate is counted."""
    rows = X.filtered_sales(W.star(s, d), X.SalesFilter()).select("region", "year", "total_sgd", "transaction_id")
    path = W.scratch(s, d, "sketches")
    K.sketch_states(rows, ["region", "year"], "total_sgd", "transaction_id").write.mode("overwrite").parquet(path)
    states = s.read.parquet(path)
    by_region = K.estimates(K.merged(states, ["region"]), {"p50": 0.5, "p95": 0.95})
    value = F.col("total_sgd").cast("double")
    held = rows.join(by_region.select("region", "p50", "p95"), "region").groupBy("region").agg(
        F.count_distinct("transaction_id").alias("ids"), F.count("total_sgd").alias("n"), F.count_if(value <= F.col("p50")).alias("r50"),
        F.count_if(value <= F.col("p95")).alias("r95"))

    def near(rank: str, q: float):
        return F.abs(F.col(rank) / F.col("n") - q) <= K.RANK_ERROR
    return held.join(by_region.select("region", "n_distinct"), "region").select(
        "region", near("r50", 0.5).alias("p50_ok"), near("r95", 0.95).alias("p95_ok"),
        (F.abs(F.col("n_distinct") / F.col("ids") - 1) <= K.COUNT_ERROR).alias("distinct_ok"))


register("sketch_check", OQ.SQL["sketch_check"])(_sketch_check)


# -- SQL text with parameters (A4, B6), guards (A2, B16, B18), fixed lookups (S2, S3), CSV folder (A1) ---------
def _sql_filtered(s, d):
    SV.register_views(W.star(s, d), W.marts(s, d))
    return SV.filtered_sales(s, OQ.FILTER_YEARS, OQ.FILTER_REGIONS)


register("sql_filtered_kpis", OQ.SQL["filtered_kpis"])(lambda s, d: X.filtered_kpis(_sql_filtered(s, d)))
register("sql_filtered_monthly", OQ.SQL["filtered_monthly"])(lambda s, d: X.filtered_monthly(_sql_filtered(s, d)))


def _source_guard(s, d):
    """Tables that are there with their rows, and what reading a missing one says."""
    from pyspark.errors import AnalysisException

    from mercato.sources.tables import read_table
    out = None
    for name in ("lineitem", "supplier", "no_such_table"):
        try:
            part = read_table(s, d, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), F.lit("ok").alias("status"), "n_rows")
        except AnalysisException as e:
            part = s.range(1).select(F.lit(name).alias("name"), F.lit(e.getCondition()).alias("status"), F.lit(None).cast("long").alias("n_rows"))
        out = part if out is None else out.union(part)
    return out


def _conformance(s, d):
    """Required columns and fixed types of the sales, of the sales without a region, and with the quantity as text."""
    sales, out = W.sales(s, d), None
    for name, df in (("as_loaded", sales), ("no_region", sales.drop("region")), ("text_quantity", sales.withColumn("quantity", F.col("quantity").cast("string")))):
        found = CI.conformance(df)
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), F.lit(",".join(found["missing_required"])).alias("missing"), F.lit(",".join(found["type_mismatch"])).alias("other_types"), "n_rows")
        out = part if out is None else out.union(part)
    return out


def _filter_guard(s, d):
    """Does a filter choice leave any row?"""
    star = W.star(s, d)
    choices = {"default": DEFAULT_FILTER, "all": X.SalesFilter(), "no_such_year": X.SalesFilter(years=(1901,)), "no_such_region": X.SalesFilter(regions=("MARS",))}
    return s.createDataFrame([(name, X.has_rows(X.filtered_sales(star, flt))) for name, flt in choices.items()], "choice string, has_rows boolean")


register("source_guard", OQ.SQL["source_guard"])(_source_guard)
register("conformance", OQ.SQL["conformance"])(_conformance)
register("filter_guard", OQ.SQL["filter_guard"])(_filter_guard)


def fixed_names(sales: DataFrame) -> DataFrame:
    """Sales under the names of the fixed lookup tables (and two names that they lack), by supplier number and by part type."""
    stores, categories = [*S.STORE_SIZES, "Unknown store", "Other store"], [*S.CATEGORY_MARGINS, "Unknown category"]

    def pick(names: list[str], n):
        return F.element_at(F.array(*[F.lit(x) for x in names]), (n % len(names) + 1).cast("int"))
    number = F.regexp_extract("store_name", r"(\d+)$", 1).cast("int")
    return sales.withColumn("store_name", pick(stores, number)).withColumn("category", pick(categories, F.length("product_name") + F.col("quantity")))


register("dim_store_fixed", OQ.SQL["dim_store_fixed"])(
    lambda s, d: ST.build_dim_store(fixed_names(W.sales(s, d)), S.StarConfig())[0])
register("dim_product_fixed", OQ.SQL["dim_product_fixed"])(
    lambda s, d: ST.build_dim_product(fixed_names(W.sales(s, d)), S.StarConfig())[0])


def _csv_folder(s, d):
    """Two CSV folders' files in one: columns in another order, one column missing, null words and bad values; read by name."""
    path = W.scratch(s, d, "csv_folder")
    sales = W.sales(s, d).select("transaction_id", "date", "store_name", "region", "quantity", "total_sgd")
    quantity = F.when(F.col("quantity") == 7, "N/A").when(F.col("quantity") == 9, "nine").otherwise(F.col("quantity").cast("string"))
    early = F.col("hour") < 12
    text = W.sales(s, d).select(early.alias("early"), "transaction_id", "date", "store_name", "region", quantity.alias("quantity"), "total_sgd")
    (text.filter("early").select("transaction_id", "date", "store_name", "region", "quantity", "total_sgd")
     .write.mode("overwrite").option("header", True).option("compression", "gzip").csv(f"{path}/a"))
    (text.filter("NOT early").select("total_sgd", "quantity", "store_name", "transaction_id", "date")
     .write.mode("overwrite").option("header", True).option("compression", "gzip").csv(f"{path}/b"))
    got = CI.read_transactions_folder(s, f"{path}/*")
    return got.select(*[c for c in sales.columns if c != "total_sgd"], F.col("total_sgd").cast("double").alias("total_sgd"), F.col("_bad_columns").alias("bad_columns"))


register("csv_folder", OQ.SQL["csv_folder"])(_csv_folder)


# -- ids of earlier loads: a batch checked bucket by bucket (D21) ------------------------------------------------
from mercato.sources.id_index import IdIndex  # noqa: E402


def _batch_duplicates(s, d):
    """The late batch held against the ids of the base load; then, added, against itself."""
    index = IdIndex(s, W.scratch(s, d, "ids"), buckets=16, bucket_bits=1 << 16)
    sales = W.sales(s, d).select("transaction_id", "date", "hour", "store_name", "product_name", "quantity", "subtotal_sgd", "total_sgd")
    index.add(base_rows(sales), "base", loaded_at=FIRST_LOAD)
    late = late_batch(sales)
    found = index.check(late).withColumn("step", F.lit("late batch"))
    return found.union(index.check(sales.filter("hour = 11")).withColumn("step", F.lit("late rows alone")))


register("batch_duplicates", OQ.SQL["batch_duplicates"])(_batch_duplicates)
