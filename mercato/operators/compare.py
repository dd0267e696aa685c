"""Small analytical building blocks over aggregated rows.

They all run on already-aggregated frames (a mart, a per-year or per-hour
roll-up). Totals for shares are scalar subqueries over a global
aggregate, never windows without a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import money as M


def exact_mean(c, scale: int = 2) -> Column:
    """Mean of values that carry ``scale`` decimals (e.g. a mart's rounded
    averages), summed exactly as decimals: order-independent."""
    col = F.col(c) if isinstance(c, str) else c
    return M.safe_ratio(F.sum(col.cast(f"decimal(30,{scale})")), F.count(col))


def exact_sum(c, scale: int = 2) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(f"decimal(30,{scale})")).cast("double")


def with_share(df: DataFrame, value_col: str, out_col: str, cast: str | None = "decimal(30,2)") -> DataFrame:
    """value / total * 100. The total is a scalar subquery over a global
    aggregate (partial sums per task): no window without a partition, so no
    single task holds all rows however many groups exist, and no join."""
    v = F.col(value_col) if cast is None else F.col(value_col).cast(cast)
    total = df.select(F.sum(v)).scalar()
    return df.withColumn(out_col, M.safe_ratio(v, total) * 100)


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """orderBy + limit -> TakeOrderedAndProject (k rows kept per task)."""
    return df.orderBy(*order).limit(k)


def arg_max(df: DataFrame, value_col: str, tie_cols: list[str], keep: list[str]) -> DataFrame:
    """Row with the largest value; ties go to the smallest tie columns."""
    return top_k(df, 1, [F.col(value_col).desc()] + [F.col(c).asc() for c in tie_cols]).select(*keep)


def conditional_mean(value_col: str, cond: Column, scale: int = 2) -> Column:
    return exact_mean(F.when(cond, F.col(value_col)), scale)
