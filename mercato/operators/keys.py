"""Surrogate keys: 1-based position in natural-key order, assigned in parallel.

``row_number().over(Window.orderBy(...))`` without a partition moves every
row into a single task. Instead:

1. ``orderBy`` range-partitions and sorts the distinct rows across tasks;
2. ``monotonically_increasing_id`` tags each row with (task, position);
3. the tagged rows are checkpointed so the tags are fixed on disk;
4. per-task row counts (one row per task, a bounded result) give each
   task's offset; key = offset + position + 1.

The same numbering gives the dimension's exact row count for free.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row in partition


@dataclass
class Keyed:
    df: DataFrame
    rows: int


def dense_keys(df: DataFrame, order_cols: list[str], key_col: str) -> Keyed:
    """``df`` holds distinct natural keys; adds ``key_col`` = 1-based rank."""
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ordered = df.orderBy(*order)
    tagged = cut_lineage(ordered.withColumn("_rid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_rid"), _LOCAL_BITS)
    local = F.col("_rid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = (tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
              .orderBy("_part").collect())  # one row per task
    offsets, running = [], 0
    for r in counts:
        offsets.append((int(r["_part"]), running))
        running += int(r["_n"])
    if offsets:
        off_map = F.create_map(*[x for p, o in offsets for x in (F.lit(p), F.lit(o).cast("long"))])
        offset = F.try_element_at(off_map, part)
    else:
        offset = F.lit(0).cast("long")
    keyed = tagged.withColumn(key_col, (offset + local + 1).cast("long")).drop("_rid")
    return Keyed(keyed, running)


def extend_keys(members: DataFrame, stored: DataFrame | None, natural: list[str], key_col: str) -> DataFrame:
    """The members that `stored` lacks (NULL equals NULL), numbered on from its largest key in natural-key order."""
    if stored is None:
        return dense_keys(members, natural, key_col).df
    side = stored.select(*[F.col(c).alias(f"_nk_{c}") for c in natural])
    cond = None
    for c in natural:
        eq = members[c].eqNullSafe(side[f"_nk_{c}"])
        cond = eq if cond is None else cond & eq
    new = dense_keys(members.join(side, cond, "left_anti"), natural, key_col).df
    top = int(stored.agg(F.coalesce(F.max(key_col), F.lit(0))).first()[0])
    return new.withColumn(key_col, (F.col(key_col) + top).cast("long"))
