"""Ids seen so far, in buckets: a batch is checked for repeated ids without reading stored rows.

Each load adds its ids to a table in hash buckets, and their bits to a Bloom
table: (bucket, word, 64 bits), which is a small share of the ids' size. A
batch's ids are first held against the bits. An id that misses one is new for
certain; only buckets with an id that hits all its bits are read, and compared
exactly. NULL counts as an id of its own.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.key_filter import split_by_keys
from mercato.session import cut_lineage
from mercato.sources.loads import LoadedTable

HASHES = 4


class IdIndex:
    """`buckets` and `bucket_bits` are fixed when the index is made: about ten bits an id keep false hits near one in a hundred;
    fuller buckets only mean that more of them are read."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, bucket_bits: int = 1 << 24):
        self.buckets, self.bits = buckets, bucket_bits
        self.ids = LoadedTable(spark, os.path.join(path, "ids"), ("bucket",))
        self.bloom = LoadedTable(spark, os.path.join(path, "bloom"), ("bucket",))

    def _keyed(self, rows: DataFrame, id_col: str) -> DataFrame:
        """(key, bucket, n): distinct ids with their rows, counted per task first."""
        key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("null"))
        return (rows.select(key.alias("key")).groupBy("key").agg(F.count("*").alias("n"))
                .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")))

    def _probes(self, keys: DataFrame) -> DataFrame:
        """One row per id and hash: its word and the word's bit."""
        def place(i: int) -> Column:
            return F.pmod(F.xxhash64(F.lit(i), "key"), F.lit(self.bits))
        return (keys.withColumn("place", F.explode(F.array(*[place(i + 1) for i in range(HASHES)])))
                .withColumn("word", F.shiftright("place", 6)).withColumn("bit", F.expr("shiftleft(1L, cast(place & 63 AS int))")))

    def add(self, rows: DataFrame, load_id: str, id_col: str = "transaction_id", loaded_at: datetime | None = None) -> None:
        """Adds the ids of rows, once per load id; a load that stopped between both tables is completed by its repetition."""
        keys = cut_lineage(self._keyed(rows, id_col).select("key", "bucket"))
        words = self._probes(keys).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
        self.bloom.append(words, load_id, loaded_at)              # bits first: an id without bits would be taken for new
        self.ids.append(keys, load_id, loaded_at)

    def repeats(self, rows: DataFrame, id_col: str = "transaction_id") -> DataFrame:
        """(key, n, stored) of the batch's ids that repeat: n rows of the batch, stored whether an earlier load had the id."""
        keys = cut_lineage(self._keyed(rows, id_col))
        if not self.ids.version():
            return keys.filter("n > 1").select("key", "n", F.lit(False).alias("stored"))
        bits = self.bloom.read().groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        hits = (self._probes(keys.select("key", "bucket")).join(bits, ["bucket", "word"])
                .filter(F.col("bits").bitwiseAND(F.col("bit")) != 0).groupBy("key", "bucket").agg(F.count("*").alias("hits"))
                .filter(F.col("hits") == HASHES).select("key", "bucket"))
        maybe = cut_lineage(hits)
        stored = split_by_keys(self.ids.read(only=maybe).select("key"), "key", maybe)[1]         # the others are not shuffled
        known = stored.join(maybe.select("key"), "key", "left_semi").distinct().withColumn("stored", F.lit(True))
        return (keys.join(known, "key", "left").select("key", "n", F.coalesce("stored", F.lit(False)).alias("stored"))
                .filter("stored OR n > 1"))

    def check(self, rows: DataFrame, id_col: str = "transaction_id") -> DataFrame:
        """One row: rows of the batch whose id an earlier load had, and rows that repeat an id inside the batch."""
        found = self.repeats(rows, id_col)
        return found.agg(F.coalesce(F.sum(F.when(F.col("stored"), F.col("n"))), F.lit(0)).cast("long").alias("already_stored"),
                         F.coalesce(F.sum(F.when(~F.col("stored"), F.col("n") - 1)), F.lit(0)).cast("long").alias("repeated"))
