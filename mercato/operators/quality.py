"""Declarative data-quality checks, evaluated on Spark.

A check is data: an id, a name, a kind, the table it reads, and for the
row-level kinds a predicate that marks a violating row. Evaluation:

* every row-level check of the fact (NOT NULL, ranges, business logic)
  compiles into ONE aggregate of ``count_if`` -- a single scan;
* the monthly minimum and the references to DimDate come from the same scan,
  whose counts are first summed per day and then per month;
* a second scan counts the fact's rows per id and per dimension key (GROUPING
  SETS): repeats of ids, and orphans after an anti-join of the few keys (a
  NULL key is an orphan);
* uniqueness of a dimension is ``count(*) - count(distinct struct(keys))``
  (NULLs count as a value, like pandas ``duplicated``);
* the other distribution checks aggregate the dimensions.

The results are a small DataFrame (one row per check, stacked from the wide
aggregate rows) that is scored on Spark as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mercato import schemas as S
from mercato.operators.star import Star

RESULT_SCHEMA = "check_id string, test_name string, status string, detail string, severity string, violations long"

# Fixed report strings (grade messages by score band).
GRADE_PERFECT = "PERFECT SCORE — Data is clean and ready for analysis!"
GRADE_GOOD = "GOOD — Minor issues. Review warnings before production."
GRADE_ACCEPTABLE = "ACCEPTABLE — Some issues found. Review before proceeding."
GRADE_POOR = "POOR — Significant data quality issues. Investigate before use."

# The columns that must not be NULL, in the source pipeline's order.
NOT_NULL_COLUMNS = ["transaction_id", "date_key", "store_key", "product_key",
                    "customer_key", "total_sgd", "quantity", "payment_method"]


#: A detail lists at most so many values, the smallest; the count is of all.
MAX_LISTED = 1000


@dataclass(frozen=True)
class Check:
    check_id: str
    name: str
    kind: str              # not_null | predicate | unique | orphan | year_range | distinct_count | min_group
    table: str
    columns: tuple = ()
    violation: object = None   # callable(cfg) -> Column, for row-level kinds
    detail: str = "Found {n} violations"
    severity: str = "HIGH"
    group: str = ""


def _no_nan(c: str) -> Column:
    """NaN never satisfies a comparison (as in pandas): NaN -> NULL."""
    return F.nanvl(F.col(c), F.lit(None).cast("double"))


# ---------------------------------------------------------------------------
# Check names, result detail formats and severities as the
# source pipeline reports them, in its order. Placeholders: {rates},
# {min_year}, {max_year}, {regions}, {years}, {min_monthly}, {tolerance} come
# from CheckConfig; {n}, {pct}, {lo}, {hi}, {values} are the measured values.
# ---------------------------------------------------------------------------
CHECK_TEXT = {
    "K1": ("NULL check: FactSales.transaction_id", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K2": ("NULL check: FactSales.date_key", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K3": ("NULL check: FactSales.store_key", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K4": ("NULL check: FactSales.product_key", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K5": ("NULL check: FactSales.customer_key", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K6": ("NULL check: FactSales.total_sgd", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K7": ("NULL check: FactSales.quantity", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K8": ("NULL check: FactSales.payment_method", "Found {n} NULL values ({pct}%)", "HIGH"),
    "K9": ("Duplicate transaction_ids", "Found {n} duplicate transaction IDs", "HIGH"),
    "K10": ("Duplicate DimStore rows", "Found {n} duplicate store records", "HIGH"),
    "K11": ("Duplicate DimProduct rows", "Found {n} duplicate product records", "HIGH"),
    "K12": ("Positive total_sgd values", "Found {n} non-positive transaction values", "HIGH"),
    "K13": ("Quantity >= 1", "Found {n} zero or negative quantity values", "HIGH"),
    "K14": ("Discount in range [0, 1]", "Found {n} out-of-range discount values", "HIGH"),
    "K15": ("GST rate in {rates}", "Found {n} invalid GST rate values", "HIGH"),
    "K16": ("Date range {min_year}–{max_year}", "Date range: {lo} to {hi}", "HIGH"),
    "K17": ("FactSales → DimStore referential integrity", "Found {n} orphaned store_key references", "HIGH"),
    "K18": ("FactSales → DimProduct referential integrity", "Found {n} orphaned product_key references", "HIGH"),
    "K19": ("FactSales → DimDate referential integrity", "Found {n} orphaned date_key references", "HIGH"),
    "K19b": ("FactSales → DimCustomer referential integrity", "Found {n} orphaned customer_key references", "HIGH"),
    "K20": ("total_sgd = subtotal + gst_amount",
            "Found {n} rows where totals don't reconcile (tolerance: {tolerance})", "HIGH"),
    "K21": ("Promo flag matches promo_type", "Found {n} promo transactions with 'No Promotion' type", "LOW"),
    "K22": ("Discounted price <= original price", "Found {n} rows where discounted price > original", "HIGH"),
    "K23": ("No negative gross profit", "Found {n} negative gross profit rows", "LOW"),
    "K24": ("All {regions} Singapore regions present", "Found {n} regions: {values}", "HIGH"),
    "K25": ("All {years} years ({min_year}–{max_year}) present", "Found years: {values}", "HIGH"),
    "K26": ("Minimum {min_monthly} transactions per month", "Minimum monthly transactions: {n}", "LOW"),
}
# ---------------------------------------------------------------------------


def _params(cfg: S.CheckConfig) -> dict:
    return {
        "rates": "{" + ", ".join(f"{r:g}" for r in cfg.valid_gst_rates) + "}",
        "min_year": str(cfg.min_year), "max_year": str(cfg.max_year),
        "regions": str(cfg.expected_regions), "years": str(cfg.expected_years),
        "min_monthly": str(cfg.min_monthly_transactions), "tolerance": f"{cfg.total_tolerance:g}",
    }


def _fill(template: str, values: dict) -> str:
    for k, v in values.items():
        template = template.replace("{" + k + "}", v)
    return template


def check_name(check_id: str, cfg: S.CheckConfig | None = None) -> str:
    return _fill(CHECK_TEXT[check_id][0], _params(cfg or S.CheckConfig()))


def check_detail(check_id: str, cfg: S.CheckConfig | None = None) -> str:
    """Detail format with the configuration placeholders filled in; the
    measured-value placeholders remain."""
    return _fill(CHECK_TEXT[check_id][1], _params(cfg or S.CheckConfig()))


def check_severity(check_id: str) -> str:
    return CHECK_TEXT[check_id][2]


_VALID = lambda k: [F.lit(str(r)).cast(S.RATE) for r in k.valid_gst_rates]

# Check logic: id -> (kind, table, columns, violation, group)
CHECK_LOGIC = {
    "K9": ("unique", "fact", ("transaction_id",), None, "duplicates"),
    "K10": ("unique", "dim_store", ("store_name", "region"), None, "duplicates"),
    "K11": ("unique", "dim_product", ("product_name",), None, "duplicates"),
    "K12": ("predicate", "fact", (), lambda k: F.col("total_sgd") <= 0, "ranges"),
    "K13": ("predicate", "fact", (), lambda k: F.col("quantity") < 1, "ranges"),
    "K14": ("predicate", "fact", (), lambda k: (F.col("discount_pct") < 0) | (F.col("discount_pct") > 1), "ranges"),
    "K15": ("predicate", "fact", (),
            lambda k: ~F.coalesce(F.col("gst_rate").isin(_VALID(k)), F.lit(False)), "ranges"),
    "K16": ("year_range", "dim_date", ("year",), None, "ranges"),
    "K17": ("orphan", "dim_store", ("store_key",), None, "orphans"),
    "K18": ("orphan", "dim_product", ("product_key",), None, "orphans"),
    "K19": ("orphan", "dim_date", ("date_key",), None, "orphans"),
    "K19b": ("orphan", "dim_customer", ("customer_key",), None, "orphans"),
    "K20": ("predicate", "fact", (),
            lambda k: F.abs(F.col("total_sgd") - F.bround(F.col("subtotal_sgd") + F.col("gst_amount_sgd"), 2))
            > F.lit(str(k.total_tolerance)).cast("decimal(10,4)"), "logic"),
    "K21": ("predicate", "fact", (),
            lambda k: (F.col("is_promotion") == 1) & (F.col("promo_type") == S.NO_PROMOTION), "logic"),
    "K22": ("predicate", "fact", (),
            lambda k: _no_nan("unit_price_after_disc") > _no_nan("unit_price_sgd") + k.price_tolerance, "logic"),
    "K23": ("predicate", "fact", (), lambda k: F.col("gross_profit_sgd") < 0, "logic"),
    "K24": ("distinct_count", "dim_store", ("region",), None, "distribution"),
    "K25": ("distinct_count", "dim_date", ("year",), None, "distribution"),
    "K26": ("min_group", "fact", ("year", "month"), None, "distribution"),
}


def default_checks(cfg: S.CheckConfig | None = None) -> list[Check]:
    cfg = cfg or S.CheckConfig()
    checks = []
    for i, col in enumerate(NOT_NULL_COLUMNS, start=1):
        cid = f"K{i}"
        checks.append(Check(cid, check_name(cid, cfg), "not_null", "fact", (col,),
                            detail=check_detail(cid, cfg), severity=check_severity(cid), group="nulls"))
    for cid, (kind, table, cols, violation, group) in CHECK_LOGIC.items():
        checks.append(Check(cid, check_name(cid, cfg), kind, table, cols, violation,
                            detail=check_detail(cid, cfg), severity=check_severity(cid), group=group))
    return checks


def _row(check: Check, passed: Column, detail: Column, violations: Column) -> Column:
    return F.struct(
        F.lit(check.check_id).alias("check_id"),
        F.lit(check.name).alias("test_name"),
        F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        detail.alias("detail"),
        F.lit(check.severity).alias("severity"),
        violations.cast("long").alias("violations"),
    )


def _found(template: str, n: Column, **extra) -> Column:
    """Fill ``{n}`` and named slots of a detail template with columns."""
    parts, rest = [], template
    slots = {"n": n.cast("string"), **extra}
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [F.lit(pre), slots[name]]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def _py_list(arr: Column, quote: bool) -> Column:
    """Python list text: ['a', 'b'] or [1, 2]."""
    items = F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))) if quote else \
        F.transform(arr, lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def percent_text(n: str, total: str) -> Column:
    """n / total * 100 as text with 2 decimals, rounded half up in integer
    arithmetic (exact for any count); '0.00' for an empty table."""
    h = f"((`{n}` * 20000 + `{total}`) div (2 * `{total}`))"
    txt = F.expr(f"concat(cast({h} div 100 as string), '.', lpad(cast({h} % 100 as string), 2, '0'))")
    return F.when(F.col(total) > 0, txt).otherwise(F.lit("0.00"))


def _stack(rows: list[Column], source: DataFrame) -> DataFrame:
    return source.select(F.inline(F.array(*rows)))


def fact_row_checks(star: Star, checks: list[Check], cfg: S.CheckConfig) -> DataFrame | None:
    """All row-level fact checks, the monthly minimum and the date references in one scan of the fact: counts per day, then
    per month, then in all. A day that DimDate lacks (a NULL one included) makes its rows orphans. No fact row is joined."""
    row_checks = [c for c in checks if c.table == "fact" and c.kind in ("not_null", "predicate")]
    orphan_checks = [c for c in checks if c.kind == "orphan" and c.columns == ("date_key",)]
    month_checks = [c for c in checks if c.kind == "min_group"]
    if not row_checks and not orphan_checks and not month_checks:
        return None
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in row_checks:
        cond = F.col(c.columns[0]).isNull() if c.kind == "not_null" else c.violation(cfg)
        aggs.append(F.count_if(cond).alias(c.check_id))
    names = ["_rows"] + [c.check_id for c in row_checks]
    days = star.dim_date.select("date_key", "year", "month", F.lit(True).alias("_day")).distinct()
    by_month = (star.fact.groupBy("date_key").agg(*aggs).join(days, "date_key", "left")
                .groupBy("_day", "year", "month").agg(*[F.sum(n).alias(n) for n in names]))
    wide = by_month.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names],
                        F.coalesce(F.sum(F.when(F.col("_day").isNull(), F.col("_rows"))), F.lit(0)).alias("_dayless"),
                        F.min(F.when(F.col("_day"), F.col("_rows"))).alias("_least"))
    rows = []
    for c in month_checks:
        n = F.col("_least")
        rows.append(_row(c, F.coalesce(n >= cfg.min_monthly_transactions, F.lit(False)), _found(c.detail, n), n))
    for c in row_checks:
        n = F.col(c.check_id)
        pct = percent_text(c.check_id, "_rows")
        rows.append(_row(c, n == 0, _found(c.detail, n, pct=pct), n))
    for c in orphan_checks:
        n = F.col("_dayless")
        rows.append(_row(c, n == 0, _found(c.detail, n), n))
    return _stack(rows, wide)


def fact_key_checks(star: Star, checks: list[Check]) -> DataFrame | None:
    """Uniqueness of the fact's id and its references to dimensions, in one scan of the fact.

    A GROUPING SETS aggregate counts the rows of every id and of every dimension key (partial counts per task, so a hot key
    ships one row a task). The ids' repeats are summed at once; only the few dimension keys that occur are then joined to
    their dimensions, and a key without a match (a NULL one included) makes all its rows orphans."""
    unique = [c for c in checks if c.kind == "unique" and c.table == "fact"]
    orphan = [c for c in checks if c.kind == "orphan" and c.columns != ("date_key",)]
    if not unique and not orphan:
        return None
    sets = [list(c.columns) for c in unique + orphan]
    columns = list(dict.fromkeys(x for s in sets for x in s))
    gid = F.grouping_id()
    of = {c.check_id: sum(1 << (len(columns) - 1 - i) for i, x in enumerate(columns) if x not in c.columns) for c in unique + orphan}
    which = F.coalesce(*[F.when(F.col("_gid") == g, F.lit(cid)) for cid, g in of.items()])
    key = F.coalesce(*[F.when(which == c.check_id, F.col(c.columns[0])) for c in orphan], F.lit(None).cast("long"))
    counts = (star.fact.groupingSets(sets, *columns).agg(F.count(F.lit(1)).alias("_n"), gid.alias("_gid"))
              .select(which.alias("_check"), key.alias("_key"), "_n")
              .groupBy("_check", "_key").agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_repeats")))
    known = None
    for c in orphan:
        keys = star.table(c.table).select(F.lit(c.check_id).alias("_check"), F.col(c.columns[0]).cast("long").alias("_key"), F.lit(True).alias("_known")).distinct()
        known = keys if known is None else known.unionByName(keys)
    counts = counts.withColumn("_known", F.lit(None)) if known is None else counts.join(known, ["_check", "_key"], "left")
    bad = {c.check_id: F.when(F.col("_check") == c.check_id, F.col("_repeats")) for c in unique}
    bad |= {c.check_id: F.when((F.col("_check") == c.check_id) & F.col("_known").isNull(), F.col("_n")) for c in orphan}
    wide = counts.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(cid) for cid, x in bad.items()])
    rows = [_row(c, F.col(c.check_id) == 0, _found(c.detail, F.col(c.check_id)), F.col(c.check_id)) for c in unique + orphan]
    return _stack(rows, wide)


def unique_check(df: DataFrame, c: Check) -> DataFrame:
    keys = F.struct(*[F.col(k) for k in c.columns])
    wide = df.agg((F.count(F.lit(1)) - F.count_distinct(keys)).alias("n"))
    n = F.col("n")
    return _stack([_row(c, n == 0, _found(c.detail, n), n)], wide)


def orphan_check(fact: DataFrame, dim: DataFrame, c: Check) -> DataFrame:
    key = c.columns[0]
    orphans = fact.select(key).join(dim.select(key), key, "left_anti")
    wide = orphans.agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return _stack([_row(c, n == 0, _found(c.detail, n), n)], wide)


def year_range_check(dim_date: DataFrame, c: Check, cfg: S.CheckConfig) -> DataFrame:
    wide = dim_date.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    passed = F.coalesce((lo >= cfg.min_year) & (hi <= cfg.max_year), F.lit(False))
    out_of_range = F.lit(0)
    return _stack([_row(c, passed, _found(c.detail, out_of_range, lo=lo.cast("string"), hi=hi.cast("string")),
                        F.when(passed, 0).otherwise(1))], wide)


def distinct_count_check(dim: DataFrame, c: Check, expected: int) -> DataFrame:
    col = c.columns[0]
    values = dim.select(col).distinct()
    listed = values.filter(F.col(col).isNotNull()).orderBy(col).limit(MAX_LISTED).agg(F.sort_array(F.collect_list(F.col(col)))).scalar()
    wide = values.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(col)).alias("known")).select("n", "known", listed.alias("vals"))
    n = F.col("n")
    text = _py_list(F.col("vals"), quote=isinstance(dim.schema[col].dataType, StringType))
    text = F.when(F.col("known") > MAX_LISTED, F.concat(F.rtrim(text, F.lit("]")), F.lit(", ...]"))).otherwise(text)
    return _stack([_row(c, n == expected, _found(c.detail, n, values=text), n)], wide)


def run_checks(star: Star, cfg: S.CheckConfig | None = None, checks: list[Check] | None = None,
               groups: tuple | None = None) -> DataFrame:
    cfg = cfg or S.CheckConfig()
    checks = checks or default_checks(cfg)
    if groups:
        checks = [c for c in checks if c.group in groups]
    parts = []
    fr = fact_row_checks(star, checks, cfg)
    if fr is not None:
        parts.append(fr)
    keyed = fact_key_checks(star, checks)
    if keyed is not None:
        parts.append(keyed)
    for c in checks:
        if c.kind == "unique" and c.table != "fact":
            parts.append(unique_check(star.table(c.table), c))
        elif c.kind == "year_range":
            parts.append(year_range_check(star.table(c.table), c, cfg))
        elif c.kind == "distinct_count":
            expected = cfg.expected_regions if c.columns[0] == "region" else cfg.expected_years
            parts.append(distinct_count_check(star.table(c.table), c, expected))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def score(results: DataFrame) -> DataFrame:
    """Totals, score and grade message from the check results."""
    agg = results.agg(
        F.count(F.lit(1)).cast("long").alias("total_tests"),
        F.count_if(F.col("status") == "PASS").cast("long").alias("passed"),
        F.count_if(F.col("status") == "FAIL").cast("long").alias("failed"),
    )
    s = F.try_divide(F.col("passed") * 100.0, F.col("total_tests"))
    return agg.withColumn("quality_score", s).withColumn(
        "grade",
        F.when(s == 100, F.lit(GRADE_PERFECT)).when(s >= 90, F.lit(GRADE_GOOD))
         .when(s >= 75, F.lit(GRADE_ACCEPTABLE)).otherwise(F.lit(GRADE_POOR)))
