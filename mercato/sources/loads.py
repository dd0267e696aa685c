"""Tables that are filled by loads: exactly-once append, upsert and partition replacement.

A load writes new files only, under ``data/load=<version>/<partitions>``, and
then a manifest (one row per partition and load that is current) under
``manifest/version=<version>``. It counts once its one-file row in ``commits``
is there: readers take the last committed manifest, so they see a load whole or
not at all, and a load that failed half way is written over by its repetition.

The commits are the ledger: load id, time, rows and an order-independent
fingerprint of what was loaded. A repeated load id is not loaded again; a
repeated id with other content is refused. One writer at a time is assumed.

Manifests and touched partitions are tables: readers join them to the data on
the partition columns, and Spark prunes partitions by that join (dynamic
partition pruning) whatever their number. Partition values must not be null.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators import layout
from mercato.session import cut_lineage

LEDGER = "version long, load_id string, kind string, loaded_at timestamp, rows long, fingerprint decimal(38,0), stored_rows long, schema string"


class LoadConflict(RuntimeError):
    """A load id was used before for other rows."""


class LoadNotStored(RuntimeError):
    """What was read back differs from what was to be written; the load is not committed."""


_HASH = "_row_hash"


def row_hash(columns: list[str]) -> Column:
    """The rows' 64-bit hash. In a projection of its own before an aggregate: inside one, Spark makes a method of two parameters a column of
    it, which the JVM's optimizing compiler refuses for wide rows."""
    return F.xxhash64(*[F.col(c) for c in sorted(columns)]).alias(_HASH)


def fingerprint_columns(columns: list[str] | None = None) -> list:
    """Aggregates `rows` and `fingerprint`: the sum of the rows' 64-bit hashes (of `columns`, or given as `row_hash`) does not depend on their
    order, and counts repeated rows."""
    h = F.col(_HASH) if columns is None else F.xxhash64(*[F.col(c) for c in sorted(columns)])

    def limb(x):                    # sums of 22 bits are longs up to 2**41 rows
        return F.coalesce(F.sum(x), F.lit(0)).cast("decimal(38,0)")
    low = F.lit((1 << 21) - 1)
    total = (limb(F.shiftright(h, 42)) * F.lit(1 << 21).cast("decimal(8,0)") + limb(F.shiftright(h, 21).bitwiseAND(low))).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"),
            (total * F.lit(1 << 21).cast("decimal(8,0)") + limb(h.bitwiseAND(low))).cast("decimal(38,0)").alias("fingerprint")]


def fingerprint(df: DataFrame) -> tuple[int, int]:
    r = df.select(row_hash(df.columns)).agg(*fingerprint_columns()).first()
    return int(r["rows"]), int(r["fingerprint"])


def _observed(seen: Observation) -> tuple[int, int]:
    """What was observed; a plan without rows may be optimized away with its observation."""
    try:
        return int(seen.get["rows"]), int(seen.get["fingerprint"])
    except Py4JJavaError:
        return 0, 0


@dataclass(frozen=True)
class Load:
    version: int
    replayed: bool          # the ledger had it already
    rows: int
    partitions: int         # partitions written, or emptied, by this load


class LoadedTable:
    """A stored table at `path`, partitioned by `partition_by` (columns of the rows; none: one partition)."""

    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), tuple(partition_by)

    # -- reading ---------------------------------------------------------------------
    def ledger(self) -> DataFrame:
        """One row per committed load."""
        try:
            return self.spark.read.schema(LEDGER).json(f"{self.path}/commits").drop("commit")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], LEDGER)

    def _state(self, load_id: str | None = None):
        """version and schema of the last commit (null before the first), and the commit of a load id, in one job."""
        return self.ledger().agg(F.max("version").alias("version"), F.max_by("schema", "version").alias("schema"),
                                 F.max(F.when(F.col("load_id") == F.lit(load_id), F.struct("version", "rows", "fingerprint"))).alias("known")).first()

    def version(self) -> int:
        """Of the last commit; 0 before the first."""
        return int(self._state()["version"] or 0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(partition columns, load, rows, fingerprint) of the files that are current."""
        version = self.version() if version is None else version
        if version == 0:
            raise ValueError(f"{self.path} has no load")
        # the predicate is always true; it lets the optimizer prune the data by this side of a join
        return self.spark.read.parquet(f"{self.path}/manifest/version={version}").filter("rows > 0")

    def read(self, version: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The rows of a version (the last by default); `only`: a table of partition values to read."""
        row = self._state() if version is None else self.ledger().filter(F.col("version") == version).first()
        if row is None or row["version"] is None:
            raise ValueError(f"{self.path} has no load" + ("" if version is None else f" of version {version}"))
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        current = self.manifest(int(row["version"]))
        if only is not None and self.parts:
            # fixed first: the optimizer prunes by a plain table with a predicate, not by a join
            current = cut_lineage(current.join(only.select(*self.parts).distinct(), list(self.parts), "left_semi")).filter("load > 0")
        return self._files(current, schema)

    def _files(self, current: DataFrame, schema: T.StructType) -> DataFrame:
        loads = [r["load"] for r in current.select("load").distinct().collect()]          # one row per load
        if not loads:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*(f for f in schema.fields if f.name not in self.parts), *(schema[c] for c in self.parts), T.StructField("load", T.LongType())])
        data = (self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/load={n}" for n in sorted(loads)]))
        keys = [*self.parts, "load"]
        return data.join(current.select(*keys), keys, "left_semi").select(*[f.name for f in schema.fields])

    def has(self, load_id: str) -> bool:
        return self._state(load_id)["known"] is not None

    # -- loading ---------------------------------------------------------------------
    def append(self, rows: DataFrame, load_id: str | None = None, loaded_at: datetime | None = None) -> Load:
        """Adds rows once per load id (by default their fingerprint, so equal rows are loaded once)."""
        return self._load("append", rows, load_id, loaded_at, lambda kept, given, spread: (given, None))

    def replace(self, rows: DataFrame, load_id: str | None = None, loaded_at: datetime | None = None, touched: DataFrame | None = None) -> Load:
        """Puts rows in the place of all rows of their partitions, and of the partitions in `touched` (without it and without partitions: of the table)."""
        def plan(current: DataFrame | None, given: DataFrame, spread: bool):
            parts = given.select(*self.parts).distinct() if self.parts else None
            return given, parts if touched is None or parts is None else parts.union(touched.select(*self.parts)).distinct()
        return self._load("replace", rows, load_id, loaded_at, plan)

    def upsert(self, batch: DataFrame, key: str, order: list[str], load_id: str | None = None, loaded_at: datetime | None = None) -> Load:
        """Newest row of each key of the batch, in the place of stored rows with that key; rows without a key are inserted.

        Only partitions that hold a row of the batch, or a row that it replaces, are rewritten. The newest rows are written
        first, so the batch is worked out once; their keys and partitions are read from what was written, and replaced rows
        are found by reading the stored keys and partition columns, no other column. Rows of the batch are shuffled once, for
        the write, where it would give small files in fewer tasks too (``operators.layout``); stored rows that stay are written from where they lie, partition by partition, without a shuffle; only rows
        whose key repeats in the batch, or may be replaced by it, are shuffled by key (``operators.key_filter``), and then brought
        together by partition, as each task of that shuffle would else write a few rows to every partition."""
        from mercato.operators.key_filter import split_by_keys, without_keys_apart
        from mercato.streaming.incremental import newest_apart

        def together(rows: DataFrame) -> DataFrame:
            return rows.hint("rebalance", *[F.col(c) for c in self.parts]) if self.parts else rows

        def plan(current: DataFrame | None, given: DataFrame, spread: bool):
            single, best = newest_apart(given, key, order)
            newest = (best if spread else together(best)).unionByName(single)
            if current is None:
                return newest, None
            if not self.parts:
                ids = newest.select(key).distinct()
                return current.join(ids, key, "left_anti").select(*newest.columns).unionByName(newest), None

            def stay(written: DataFrame):
                keys = cut_lineage(written.select(key).filter(F.col(key).isNotNull()).distinct())
                hit = split_by_keys(current.select(key, *self.parts), key, keys)[1]
                old = cut_lineage(hit.join(keys, key, "left_semi"))
                touched = cut_lineage(written.select(*self.parts).union(old.select(*self.parts)).distinct())
                miss, rest = without_keys_apart(self.read(only=touched).select(*newest.columns), key, old.select(key).distinct())
                return miss.unionByName(together(rest)), touched
            return newest, stay
        return self._load("upsert", batch, load_id, loaded_at, plan)

    def _write(self, rows: DataFrame, schema: T.StructType, folder: str, mode: str, spread: bool) -> tuple[int, int]:
        """Rows and fingerprint of what was written; `spread`: rows of a partition are brought together first."""
        seen = Observation()
        typed = rows.select(*[F.col(f.name) if rows.schema[f.name].dataType == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
                              for f in schema.fields])
        out = typed.observe(seen, *fingerprint_columns(schema.fieldNames()))
        if self.parts and spread:
            out = out.hint("rebalance", *[F.col(c) for c in self.parts])
        writer = out.write.mode(mode).option("compression", "zstd")
        (writer.partitionBy(*self.parts) if self.parts else writer).parquet(folder)
        return _observed(seen)

    def _measure(self, rows: DataFrame) -> tuple[int, int, bool, int]:
        """Rows, fingerprint, and whether rows of a partition have to be brought together for the write: by a shuffle, or in
        so many tasks (0: by none); from one scan."""
        if not self.parts:
            return *fingerprint(rows), False, 0
        hashed = layout.with_file(rows.select(*self.parts, row_hash(rows.columns)), list(self.parts))
        r = hashed.agg(*fingerprint_columns(), layout.files(), layout.values(list(self.parts))).first()
        n, small = int(r["rows"]), layout.small_files(int(r["rows"]), int(r["files"]))
        tasks = layout.fewer_tasks(n, int(r["values"])) if small else 0
        return n, int(r["fingerprint"]), small and not tasks, tasks

    def _load(self, kind: str, rows: DataFrame, load_id: str | None, loaded_at: datetime | None, plan) -> Load:
        n, mark, spread, tasks = self._measure(rows)
        load_id = load_id if load_id is not None else f"{n}-{mark}"
        state = self._state(load_id)
        known = state["known"]
        if known is not None:
            if (known["rows"], int(known["fingerprint"])) != (n, mark):
                raise LoadConflict(f"{self.path}: load {load_id} was {known['rows']} other rows")
            return Load(int(known["version"]), True, n, 0)
        version = int(state["version"] or 0) + 1
        names = T.StructType.fromJson(json.loads(state["schema"])).fieldNames() if version > 1 else None
        moment = loaded_at or datetime.now()
        given = (rows.coalesce(tasks) if tasks else rows).withColumn("loaded_at", F.lit(moment).cast("timestamp"))
        given = given.select(*names) if names else given
        current = self.read() if version > 1 else None
        merged, touched = plan(current, given, spread)
        folder = f"{self.path}/data/load={version}"
        schema = current.select(*merged.columns).unionByName(merged).schema if callable(touched) else merged.schema
        stored = T.StructType([*(f for f in schema.fields if f.name not in self.parts), *(schema[c] for c in self.parts)])
        sent = self._write(merged, schema, folder, "overwrite", spread)
        if callable(touched):            # rows that stay, known once the load's own rows are written
            kept, touched = touched(self.spark.read.schema(stored).parquet(folder))
            sent = tuple(a + b for a, b in zip(sent, self._write(kept, schema, folder, "append", spread=False)))
        entries = cut_lineage(self.spark.read.schema(stored).parquet(folder).select(*self.parts, row_hash(schema.fieldNames())).groupBy(*self.parts)
                              .agg(*fingerprint_columns()).filter("rows > 0").withColumn("load", F.lit(version).cast("long")))
        none = F.col(self.parts[0]).isNull() if self.parts else F.lit(False)
        for c in self.parts[1:]:
            none |= F.col(c).isNull()
        back = entries.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("fingerprint"), F.lit(0)).alias("fingerprint"),
                           F.count_if(none).alias("none"), F.count("*").alias("n")).first()
        if back["none"]:
            raise ValueError(f"{self.path}: a partition value is null")
        if (int(back["rows"]), int(back["fingerprint"])) != sent:
            raise LoadNotStored(f"{folder}: {back['rows']} of {sent[0]} rows are stored, or their content differs")
        columns = [*self.parts, "load", "rows", "fingerprint"]
        manifest = entries.select(*columns)
        if version > 1 and (kind == "append" or self.parts):
            old = self.manifest(version - 1)
            manifest = (old if touched is None else old.join(touched, list(self.parts), "left_anti")).select(*columns).union(manifest)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")   # one row per partition and load
        total = self.spark.read.parquet(f"{self.path}/manifest/version={version}").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        row = [(version, load_id, kind, moment, n, str(mark), int(total), schema.json())]
        commit = self.spark.createDataFrame(row, T.StructType.fromDDL(LEDGER.replace("decimal(38,0)", "string")))
        commit.withColumn("fingerprint", F.col("fingerprint").cast("decimal(38,0)")).coalesce(1).write.mode("errorifexists").json(f"{self.path}/commits/commit={version}")
        return Load(version, False, n, touched.count() if touched is not None else int(back["n"]))
