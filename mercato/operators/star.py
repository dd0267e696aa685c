"""Star schema: four dimensions around a transaction-grain sales fact.

* DimDate: one row per calendar day (timestamps are cut to dates first,
  so two times on one day never give two rows and never fan out the fact).
* DimStore / DimProduct / DimCustomer: distinct natural keys, a dense
  1-based surrogate key in natural-key order (:mod:`mercato.operators.keys`),
  enriched from literal lookups with defaults.
* FactSales: the raw rows plus four keys. The date key is computed; the
  other three come from left joins on the natural keys with NULL-safe
  equality (a NULL store/region still finds its dimension row).

All four dimensions' members (distinct natural keys) come from ONE scan of
the sales table: a ``GROUPING SETS`` aggregate, which Spark runs as an
Expand plus a partial hash aggregate per task, so each task ships at most
one row per member and a hot store or day costs nothing extra. The small
member table is cut from its lineage with a reliable checkpoint and counted
per dimension (one row per dimension reaches the driver). Numbering, the
dimension writes and the fact's lookup sides all read that checkpoint; the
sales table is not scanned again until the fact itself is built.

A dimension is broadcast into the fact lookup only when its members' measured
size is at most ``broadcast_max_bytes``; above it the lookup is a shuffled
sort-merge join, where AQE splits skewed fact partitions.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.functions import calendar as cal
from mercato.functions.lookup import lookup
from mercato.operators.keys import dense_keys
from mercato.operators import layout
from mercato.session import cut_lineage

#: A dimension's lookup side is broadcast up to this many bytes of keys; beyond
#: it the lookup is a shuffled join.
BROADCAST_MAX_BYTES = 64 << 20


@dataclass
class Star:
    dim_date: DataFrame
    dim_store: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    fact: DataFrame
    rows: dict
    fact_by_month: DataFrame | None = None  # fact with year/month partition columns, when stored so
    fact_with_region: DataFrame | None = None  # fact rows with their store's region, to cluster by
    days: DataFrame | None = None  # date keys of the fact's rows, lying as these do, where no lookup shuffles them

    TABLES = ("dim_date", "dim_store", "dim_product", "dim_customer", "fact")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def write(self, root: str, mode: str = "overwrite", partition_fact: bool = False, parallel: int = 5) -> None:
        """The five tables are independent jobs (the dimensions and the fact's
        lookup sides all read the checkpointed members), so they are submitted
        from a few driver threads at once and the small dimension jobs run
        beside the fact write instead of before it."""
        from concurrent.futures import ThreadPoolExecutor

        def write_one(name):
            if name == "fact":
                self._write_fact(os.path.join(root, "fact"), mode, partition_fact)
            else:
                self.table(name).write.mode(mode).parquet(os.path.join(root, name))

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            list(pool.map(write_one, ["fact"] + [n for n in self.TABLES if n != "fact"]))

    def _write_fact(self, path: str, mode: str, partition_fact: bool) -> None:
        fact = self.fact
        if partition_fact:
            # year/month partition directories: filters on them prune files.
            # REBALANCE clusters rows by partition value before the write (few
            # files per month instead of one per task and month); AQE splits a
            # month that is much larger than the others into several tasks. It
            # shuffles whole rows, so it is left out where the files are large
            # enough without it, or in fewer tasks (operators.layout).
            # Inside a month rows lie by region, store and product: the region,
            # written beside the fact's columns, lets a region choice skip row
            # groups and pages by their statistics.
            cluster = ["store_key", "product_key"]
            if self.fact_with_region is not None:
                fact, cluster = self.fact_with_region, ["region", *cluster]
            fact = _with_month(fact)
            if self.days is None:
                fact = fact.hint("rebalance", "year", "month")
            else:
                fact = layout.gathering(_with_month(self.days), ["year", "month"])(fact)
            fact = fact.sortWithinPartitions("year", "month", *cluster)
            fact.write.mode(mode).option("compression", "zstd").partitionBy("year", "month").parquet(path)
        else:
            fact.write.mode(mode).parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> "Star":
        t = {n: spark.read.parquet(os.path.join(root, n)) for n in cls.TABLES}
        fact = by_month = t["fact"]
        if "year" in fact.columns:
            fact = fact.select(*S.FACT_COLUMNS)
        else:
            by_month = None
        return cls(t["dim_date"], t["dim_store"], t["dim_product"], t["dim_customer"], fact, {}, by_month)


def _with_month(fact: DataFrame) -> DataFrame:
    """Partition columns of a fact row."""
    return (fact.withColumn("year", F.floor(F.col("date_key") / 10000).cast("int"))
                .withColumn("month", (F.floor(F.col("date_key") / 100) % 100).cast("int")))


# Natural keys of each dimension, in the order of its surrogate key.
MEMBER_KEYS = {
    "dim_store": ["store_name", "region"],
    "dim_product": ["product_name", "category"],
    "dim_customer": ["customer_segment", "member_tier"],
    "dim_date": ["_day"],
}


@dataclass
class Members:
    """Distinct natural keys of every dimension (one checkpointed table)."""
    df: DataFrame
    gid: dict
    rows: dict
    bytes: dict

    def of(self, dim: str) -> DataFrame:
        return self.df.filter(F.col("_gid") == self.gid[dim]).select(*MEMBER_KEYS[dim])


def member_sets(sales: DataFrame) -> tuple[DataFrame, dict]:
    """The lazy GROUPING SETS aggregate behind :func:`dimension_members` and
    the ``grouping_id`` of each dimension's rows."""
    cols = [c for keys in MEMBER_KEYS.values() for c in keys]
    base = sales.select(*[c for c in cols if c != "_day"], cal.as_date("date").alias("_day"))
    plan = base.groupingSets([MEMBER_KEYS[d] for d in MEMBER_KEYS], *cols).agg(F.grouping_id().alias("_gid"))
    # grouping_id: bit (n-1-i) is set when column i is not in the row's set
    gid = {d: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys)
           for d, keys in MEMBER_KEYS.items()}
    return plan, gid


def dimension_members(sales: DataFrame) -> Members:
    """One pass over ``sales`` for the members of all four dimensions.
    Timestamps are cut to days first (two times on one day are one member).
    NULL is a member like any other value; ``grouping_id`` tells the sets
    apart, so a NULL key is never confused with "not in this set"."""
    plan, gid = member_sets(sales)
    members = cut_lineage(plan)
    # text bytes of a member's keys, and 32 for its row and its surrogate key
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for keys in MEMBER_KEYS.values() for c in keys), F.lit(32))
    sizes = {r["_gid"]: (int(r["n"]), int(r["b"])) for r in
             members.groupBy("_gid").agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).collect()}
    return Members(members, gid, *({d: sizes.get(g, (0, 0))[i] for d, g in gid.items()} for i in (0, 1)))


def build_dim_date(sales: DataFrame, members: Members | None = None) -> DataFrame:
    if members is None:
        days = sales.select(cal.as_date("date").alias("d")).distinct()
    else:
        days = members.of("dim_date").withColumnRenamed("_day", "d")
    d = F.col("d")
    return days.select(
        cal.date_key(d).alias("date_key"),
        cal.full_date(d).alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        cal.month_name(d).alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        cal.weekday_num(d).alias("day_of_week_num"),
        cal.day_name(d).alias("day_name"),
        cal.is_weekend(d).alias("is_weekend"),
        cal.fiscal_year(F.year(d), F.month(d)).alias("fiscal_year"),
    )


def enrich_store(keyed: DataFrame, cfg: S.StarConfig) -> DataFrame:
    return keyed.select(
        "store_key", "store_name", "region",
        F.upper(F.substring("region", 1, 3)).alias("region_code"),
        lookup("store_name", cfg.store_sizes, cfg.default_store_size).alias("store_size"),
        lookup("store_name", cfg.tourist_areas, cfg.default_tourist_area, "int").alias("is_tourist_area"),
    )


def enrich_product(keyed: DataFrame, cfg: S.StarConfig) -> DataFrame:
    group = lookup("category", cfg.category_groups, cfg.default_category_group)
    return keyed.select(
        "product_key", "product_name", "category",
        group.alias("category_group"),
        lookup("category", cfg.category_margins, cfg.default_gp_margin, "double").alias("base_gp_margin"),
        (group == S.FRESH_GROUP).cast("int").alias("is_fresh_item"),
    )


def enrich_customer(keyed: DataFrame, cfg: S.StarConfig) -> DataFrame:
    return keyed.select(
        "customer_segment", "member_tier", "customer_key",
        lookup("member_tier", cfg.tier_ranks, cfg.default_tier_rank, "int").alias("tier_rank"),
        # a NULL tier is "not Non-Member", hence a member
        F.coalesce(F.col("member_tier") != F.lit(S.NON_MEMBER), F.lit(True)).cast("int").alias("has_membership"),
    )


KEY_OF = {"dim_store": "store_key", "dim_product": "product_key", "dim_customer": "customer_key"}
ENRICH = {"dim_store": enrich_store, "dim_product": enrich_product, "dim_customer": enrich_customer}


def _build_dim(dim: str, sales: DataFrame, cfg: S.StarConfig, members: Members | None):
    keyed = _number(sales, members, dim, KEY_OF[dim])
    return ENRICH[dim](keyed.df, cfg), keyed.rows


def build_dim_store(sales: DataFrame, cfg: S.StarConfig, members: Members | None = None):
    return _build_dim("dim_store", sales, cfg, members)


def build_dim_product(sales: DataFrame, cfg: S.StarConfig, members: Members | None = None):
    return _build_dim("dim_product", sales, cfg, members)


def build_dim_customer(sales: DataFrame, cfg: S.StarConfig, members: Members | None = None):
    return _build_dim("dim_customer", sales, cfg, members)


def _number(sales: DataFrame, members: Members | None, dim: str, key: str):
    keys = MEMBER_KEYS[dim]
    if members is None:
        return dense_keys(sales.select(*keys).distinct(), keys, key)
    return dense_keys(members.of(dim), keys, key)


def key_lookup(fact: DataFrame, dim: DataFrame, natural: list[str], key: str, small: bool) -> DataFrame:
    """Left join on natural keys (NULL matches NULL), adding ``key``.
    ``small``: the dimension's measured size allows a broadcast."""
    side = dim.select(key, *[F.col(c).alias(f"_nk_{c}") for c in natural])
    side = F.broadcast(side) if small else side
    cond = None
    for c in natural:
        eq = fact[c].eqNullSafe(side[f"_nk_{c}"])
        cond = eq if cond is None else cond & eq
    return fact.join(side, cond, "left").drop(*[f"_nk_{c}" for c in natural])


def build_fact(sales: DataFrame, dims: dict[str, DataFrame], small: dict[str, bool], extra: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows with their keys; `extra` columns of the sales are kept behind them."""
    f = sales.withColumn("date_key", cal.date_key("date"))
    for dim, key in (("dim_store", "store_key"), ("dim_product", "product_key"), ("dim_customer", "customer_key")):
        f = key_lookup(f, dims[dim], MEMBER_KEYS[dim], key, small[dim])
    return f.select(*S.FACT_COLUMNS, *extra)


def build_star(sales: DataFrame, cfg: S.StarConfig | None = None,
               broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> Star:
    cfg = cfg or S.StarConfig()
    members = dimension_members(sales)
    dim_date = build_dim_date(sales, members)
    dim_store, n_store = build_dim_store(sales, cfg, members)
    dim_product, n_product = build_dim_product(sales, cfg, members)
    dim_customer, n_customer = build_dim_customer(sales, cfg, members)
    small = {d: b <= broadcast_max_bytes for d, b in members.bytes.items()}
    fact = build_fact(sales, {"dim_store": dim_store, "dim_product": dim_product, "dim_customer": dim_customer}, small, ("region",))
    lie = all(small[d] for d in KEY_OF)          # broadcast lookups leave rows where they are
    return Star(dim_date, dim_store, dim_product, dim_customer, fact.select(*S.FACT_COLUMNS),
                {"dim_store": n_store, "dim_product": n_product, "dim_customer": n_customer}, fact_with_region=fact,
                days=sales.select(cal.date_key("date").alias("date_key")) if lie else None)


def orphan_counts(fact: DataFrame) -> DataFrame:
    """Fact rows whose key lookup failed, all four keys in one scan."""
    return fact.agg(*[F.count_if(F.col(k).isNull()).cast("long").alias(f"{k}_orphans")
                      for k in ("date_key", "store_key", "product_key", "customer_key")])
