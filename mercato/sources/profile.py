"""Source profile, pre-load checks and table counts (one aggregate each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import schemas as S


MAX_REGIONS = 1000


def source_profile(raw: DataFrame) -> DataFrame:
    """Rows, columns, date range, sorted distinct regions, revenue.

    The list holds the first MAX_REGIONS distinct regions; where there are more, it ends with "...".
    """
    first = raw.select("region").filter("region IS NOT NULL").distinct().orderBy("region").limit(MAX_REGIONS + 1)
    names = F.sort_array(F.collect_list("region"))
    more = F.when(F.size(names) > MAX_REGIONS, F.concat(F.array_join(F.slice(names, 1, MAX_REGIONS), ","), F.lit(",...")))
    regions = first.agg(F.coalesce(more, F.array_join(names, ","))).scalar()
    return raw.agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.lit(len(raw.columns)).cast("int").alias("columns"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        regions.alias("regions"),
        F.sum("total_sgd").cast("double").alias("total_revenue"),
    )


def missing_columns(df: DataFrame, required: list[str] = S.REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def preload_issues(raw: DataFrame, required: list[str] = S.REQUIRED_COLUMNS, missing: list[str] | None = None) -> DataFrame:
    """Warn-only checks before loading: missing required columns, duplicate
    ids (repeats beyond the first, NULL counted as a value), negative totals.
    ``missing``: the columns a file lacks, where the frame was filled up to the schema."""
    missing = missing_columns(raw, required) if missing is None else missing
    agg = raw.agg(
        (F.count(F.lit(1)) - F.count_distinct(F.struct("transaction_id"))).cast("long").alias("dup"),
        F.count_if(F.col("total_sgd") < 0).cast("long").alias("neg"),
    )
    rows = F.array(
        F.struct(F.lit("missing_required_columns").alias("issue"), F.lit(len(missing)).cast("long").alias("found"),
                 F.lit(",".join(missing)).alias("detail")),
        F.struct(F.lit("duplicate_transaction_ids").alias("issue"), F.col("dup").alias("found"),
                 F.concat(F.lit("Found "), F.col("dup").cast("string"), F.lit(" duplicate transaction_ids")).alias("detail")),
        F.struct(F.lit("negative_total_sgd").alias("issue"), F.col("neg").alias("found"),
                 F.concat(F.lit("Found "), F.col("neg").cast("string"), F.lit(" negative total_sgd values")).alias("detail")),
    )
    return agg.select(F.inline(rows))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for a list of tables, one union of aggregates."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
