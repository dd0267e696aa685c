"""Incremental loads of the warehouse: stable keys, an upserted fact and marts from stored partials.

One batch of raw rows goes through four steps, each once per load id:

1. its dimension members that are not stored yet are numbered on from the
   stored maximum and appended: keys once given never change;
2. the batch becomes fact rows with those keys and is upserted by transaction
   id into the fact's year/month partitions (``sources.loads``);
3. the marts' partial measures are computed anew for the touched months alone,
   and replace those months in the stored partials;
4. a mart is the roll-up of all stored partials, which are no larger than
   months times dimension members: no month of the fact is read for it.

A load that stopped between the steps is completed by its repetition.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato import schemas as S
from mercato.functions import money as M
from mercato.operators import marts as MT
from mercato.operators import star as ST
from mercato.operators.keys import extend_keys
from mercato.sources import sinks
from mercato.sources.loads import Load, LoadedTable

MONTH = ("year", "month")


def _with_month(fact: DataFrame) -> DataFrame:
    """Partition columns of a fact row; a row without a date lies in year 0."""
    key = F.coalesce(F.col("date_key"), F.lit(0))
    return fact.withColumn("year", F.floor(key / 10000).cast("int")).withColumn("month", (F.floor(key / 100) % 100).cast("int"))


class LoadedWarehouse:
    """The star and the marts' partials under `root`, filled batch by batch."""

    def __init__(self, spark: SparkSession, root: str, cfg: S.StarConfig | None = None):
        self.spark, self.root, self.cfg = spark, root, cfg or S.StarConfig()
        self.dims = {d: LoadedTable(spark, os.path.join(root, d)) for d in ST.MEMBER_KEYS}
        self.fact = LoadedTable(spark, os.path.join(root, "fact"), MONTH)
        self.partials = LoadedTable(spark, os.path.join(root, "partials"), MONTH)

    def load(self, raw: DataFrame, load_id: str, loaded_at: datetime) -> Load:
        """Loads a batch of raw rows (the raw schema's columns); of rows that repeat an id the latest date counts."""
        self._load_members(raw, load_id, loaded_at)
        dims = {d: t.read() for d, t in self.dims.items()}
        bounds = self._key_bytes(dims)
        fact = _with_month(ST.build_fact(raw, dims, {d: b <= ST.BROADCAST_MAX_BYTES for d, b in bounds.items()}))
        out = self.fact.upsert(fact, "transaction_id", ["date_key"], load_id, loaded_at)
        if not self.partials.has(load_id):
            touched = self._touched(load_id)
            # fixed once: they are no larger than months times members, and the load reads them several times
            self.partials.replace(self._staged(month_partials(self.fact.read(only=touched))), load_id, loaded_at, touched)
        return out

    def _staged(self, rows: DataFrame) -> DataFrame:
        """Rows of the load at hand, packed, in the place of those of the load before: checkpoints hold them unpacked and pile up."""
        path = os.path.join(self.root, "staged")
        sinks.write_table(rows, path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _load_members(self, raw: DataFrame, load_id: str, loaded_at: datetime) -> None:
        if all(t.has(load_id) for t in self.dims.values()):
            return
        members = ST.dimension_members(raw)
        for dim, table in self.dims.items():
            if table.has(load_id):
                continue
            stored = table.read() if table.version() else None
            if dim == "dim_date":
                new = ST.build_dim_date(raw, members)
                new = new if stored is None else new.join(stored.select("date_key"), new["date_key"].eqNullSafe(stored["date_key"]), "left_anti")
            else:
                key = ST.KEY_OF[dim]
                new = ST.ENRICH[dim](extend_keys(members.of(dim), stored, ST.MEMBER_KEYS[dim], key), self.cfg)
            table.append(new, load_id, loaded_at)

    def _key_bytes(self, dims: dict[str, DataFrame]) -> dict[str, int]:
        """Bytes of each dimension's lookup side."""
        def width(d):
            return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in ST.MEMBER_KEYS[d]), F.lit(32))
        return {d: int(df.agg(F.coalesce(F.sum(width(d)), F.lit(0))).first()[0]) for d, df in dims.items() if d != "dim_date"}

    def _touched(self, load_id: str) -> DataFrame:
        """Months whose rows the fact's load wrote or took away."""
        version = int(self.fact.ledger().filter(F.col("load_id") == load_id).first()["version"])
        now = self.fact.manifest(version)
        wrote = now.filter(F.col("load") == version).select(*MONTH)
        if version == 1:
            return wrote
        return wrote.union(self.fact.manifest(version - 1).select(*MONTH).join(now.select(*MONTH), list(MONTH), "left_anti")).distinct()

    def dim(self, name: str) -> DataFrame:
        return self.dims[name].read().drop("loaded_at")

    def star(self) -> ST.Star:
        fact = self.fact.read()
        return ST.Star(self.dim("dim_date"), self.dim("dim_store"), self.dim("dim_product"), self.dim("dim_customer"), fact.select(*S.FACT_COLUMNS), {}, fact)

    def mart(self, name: str) -> DataFrame:
        """A mart rolled up from the stored partials."""
        m = MT.MART_SPECS[name]
        part = self.partials.read().filter(F.col("grain") == grain_name(m)).groupBy(*m.grain).agg(*[MT.PARTIALS[p][1](p).alias(p) for p in m.partials])
        return MT.roll_up(self.dim, m, part)


def grain_name(m: MT.Mart) -> str:
    return ",".join(m.grain)


def month_partials(fact: DataFrame) -> DataFrame:
    """Partial measures of every mart's grain inside each month, from one scan: (year, month, grain, grain columns, measures).

    A row is aggregated once for each grain, and decimal sums beyond 18 digits cost the most of it: money is summed as longs, exactly."""
    grains = list(dict.fromkeys(m.grain for m in MT.MARTS))
    columns = list(dict.fromkeys(c for g in grains for c in g))
    names = list(dict.fromkeys(p for m in MT.MARTS for p in m.partials))
    valued = fact.select("*", *[MT.SUMMED[p]().alias(f"_v{p}") for p in names if p in MT.SUMMED])
    money = {p: t for p in names if p in MT.SUMMED and isinstance(t := valued.schema[f"_v{p}"].dataType, T.DecimalType) and t.precision <= 18 and t.scale <= 6}
    valued = valued.select(*fact.columns, *[M.unscaled(f"_v{p}", t.scale).alias(f"_u{p}") for p, t in money.items()])
    sums = [s for p in names for s in (M.limb_sums(f"_u{p}") if p in money else [MT.PARTIALS[p][0]().alias(p)])]
    pre = valued.groupingSets([[*MONTH, *g] for g in grains], *MONTH, *columns).agg(*sums, F.grouping_id().alias("_gid"))
    gid = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in g): ",".join(g) for g in grains}
    grain = F.coalesce(*[F.when(F.col("_gid") == k, F.lit(v)) for k, v in gid.items()])
    measures = [M.from_limbs(f"_u{p}", money[p].precision + 10, money[p].scale).alias(p) if p in money else F.col(p) for p in names]
    return pre.select(*MONTH, grain.alias("grain"), *columns, *measures)
