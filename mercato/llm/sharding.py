"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is divided into ``1 << RING_BITS`` arcs; a row's arc comes from the
hash of its id and text, an arc's owner is the next virtual node clockwise.
Rows are counted per arc (a fixed number of counts, whatever the input). Every
shard has a capacity; it takes its own arcs' rows clockwise until it is full,
and what is left of an arc goes on clockwise to the next virtual nodes whose
shards have room. With the default slack of 0 the capacities are the row count
divided evenly, so shard sizes differ by one row at most (law ``rows``); a
larger slack moves fewer rows when shards are added.

A row's place is its rank in its arc. Equal rows share an arc, so ranks are
made in two steps: rows are counted per hash and input partition, running sums
of those counts over the arc give each such group its first rank, and rows are
numbered inside their group. A row that is repeated without end is thus spread
over as many groups as it has input partitions. A segment table
(arc, rank range, shard, first slot), at most about two rows an arc, turns that
into shard and slot.
"""

from __future__ import annotations

import bisect
import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.tables import column, cut_lineage

RING_BITS = 14
VIRTUAL_NODES = 64


def ring(n_shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Sorted (position, shard) of the virtual nodes; a shard's do not depend on the other shards."""
    def place(shard: int, i: int) -> int:
        return int.from_bytes(hashlib.sha256(f"{shard}:{i}".encode()).digest()[:8], "big") >> (64 - RING_BITS)
    return sorted((place(s, i), s) for s in range(n_shards) for i in range(virtual_nodes))


def capacities(total: int, n_shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [math.ceil((1 + slack) * total / n_shards)] * n_shards
    return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]


def segments(counts: dict[int, int], n_shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int, int, int, int]]:
    """(arc, lo, hi, shard, first slot): the rows of rank lo <= rank < hi of an arc go to the shard."""
    nodes = ring(n_shards, virtual_nodes)
    positions = [p for p, _ in nodes]
    room = capacities(sum(counts.values()), n_shards, slack)
    placed, over = [], []
    for arc in sorted(counts):
        at = bisect.bisect_left(positions, arc) % len(nodes)
        shard = nodes[at][1]
        take = min(room[shard], counts[arc])
        if take:
            placed.append((arc, 0, take, shard))
            room[shard] -= take
        if take < counts[arc]:
            over.append((arc, take, at))
    for arc, lo, at in over:                      # clockwise to the next shards with room
        while lo < counts[arc]:
            at = (at + 1) % len(nodes)
            shard = nodes[at][1]
            take = min(room[shard], counts[arc] - lo)
            if take:
                placed.append((arc, lo, lo + take, shard))
                room[shard] -= take
                lo += take
    slot = [0] * n_shards
    out = []
    for arc, lo, hi, shard in sorted(placed):
        out.append((arc, lo, hi, shard, slot[shard]))
        slot[shard] += hi - lo
    return out


def shard_rows(docs: DataFrame, n_shards: int = 16, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of docs.

    size is the text's UTF-8 bytes plus 1 (a null text has none). Rows that
    repeat an id and a text take neighbouring ranks; which of two equal rows
    gets which slot does not show. A null id is a key like any other. Other
    columns are ignored. An empty table gives no rows."""
    spark = docs.sparkSession
    text = F.coalesce(column(docs, text_col), F.lit(""))
    rows = cut_lineage(docs.select(column(docs, id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                                   F.crc32(text.cast("binary")).alias("text_crc32"))
                       .withColumn("h", F.xxhash64("doc_id", "text_crc32", "size"))
                       .withColumn("arc", F.shiftrightunsigned("h", 64 - RING_BITS).cast("int"))
                       .withColumn("part", F.spark_partition_id()))
    counts = {r["arc"]: r["count"] for r in rows.groupBy("arc").count().collect()}      # at most 1 << RING_BITS rows
    table = spark.createDataFrame(segments(counts, n_shards, slack) or [(0, 0, 0, 0, 0)],
                                  "arc int, lo long, hi long, shard int, first long")
    before = F.sum("n").over(Window.partitionBy("arc").orderBy("h", "part").rowsBetween(Window.unboundedPreceding, -1))
    groups = (rows.groupBy("arc", "h", "part").agg(F.count(F.lit(1)).alias("n"))
              .select("h", "part", F.coalesce(before, F.lit(0)).alias("start")))
    within = F.row_number().over(Window.partitionBy("h", "part").orderBy("doc_id", "text_crc32", "size")) - 1
    ranked = rows.withColumn("within", within).join(groups, ["h", "part"]).withColumn("rank", F.col("start") + F.col("within"))
    # the segment table has a fixed bound (about 2 << RING_BITS narrow rows)
    return (ranked.join(F.broadcast(table), "arc").filter("rank >= lo AND rank < hi")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - F.col("lo")).alias("slot")))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes docs as Parquet, one folder a shard (``shard=<n>``), for ids that are unique."""
    placed = shard_rows(docs, n_shards, slack, id_col, text_col).select(F.col("doc_id").alias("_id"), "shard", "slot")
    key = column(docs, id_col).cast("long")
    (docs.join(placed, key.eqNullSafe(placed["_id"])).drop("_id")
     .hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path))
