"""Exact quantiles with linear interpolation, without one task holding all values.

``percentile(col, p)`` is exact, but its final aggregation merges the
value->count map of every task into a single task. Here:

1. one aggregate counts each distinct value (combined map-side: a value that
   holds a third of all rows is one partial row per task);
2. the (value, count) rows are range-partitioned and sorted by value and
   checkpointed, so their partitions are fixed;
3. the partitions' totals (one row per task on the driver) say which partition
   holds each wanted order statistic, and how many rows lie before it;
4. a running count inside just those partitions picks the values.

No task holds more than one range of distinct values, at any size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import cut_lineage


def exact_order_statistics(df: DataFrame, col: str, rank_fn):
    """``rank_fn(n) -> 0-based ranks``; returns (n, {rank: value}). NULLs are skipped."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("k"))
    ordered = cut_lineage(counts.orderBy("v").withColumn("part", F.spark_partition_id()))
    totals = ordered.groupBy("part").agg(F.sum("k").alias("k")).orderBy("part").collect()  # one row per task
    n = sum(int(r["k"]) for r in totals)
    ranks = sorted(set(rank_fn(n))) if n else []
    picks, before = [], 0
    for r in totals:
        picks += [(int(r["part"]), rank, rank - before) for rank in ranks if before <= rank < before + int(r["k"])]
        before += int(r["k"])
    if not picks:
        return n, {}
    w = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ordered.filter(F.col("part").isin(sorted({p for p, _, _ in picks}))).withColumn("cum", F.sum("k").over(w))
    row = running.agg(*[F.min(F.when((F.col("part") == p) & (F.col("cum") > pos), F.col("v"))).alias(f"r{i}")
                        for i, (p, _, pos) in enumerate(picks)]).first()
    return n, {rank: row[f"r{i}"] for i, (_, rank, _) in enumerate(picks)}


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> dict[float, float | None]:
    """Quantiles as numpy's default (linear) method: position p * (n - 1)."""
    def positions(n):
        return [k for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]
    n, values = exact_order_statistics(df, col, positions)
    if not n:
        return {p: None for p in probs}
    out = {}
    for p in probs:
        pos = p * (n - 1)
        a, b = math.floor(pos), math.ceil(pos)
        lo, hi = float(values[a]), float(values[b])
        out[p] = lo + (hi - lo) * (pos - a)
    return out
