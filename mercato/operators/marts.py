"""The seven aggregate marts over the star.

A mart is defined once, as *partial measures* (sums, counts, maxima -- each
re-aggregable without loss, money as exact decimals) and *final* columns
computed from them (rounded sums, exact half-up means, ratios). In all
cases the fact is first reduced to the partials per surrogate key (or, for the
two dimension-free marts, per output key), and only that small table joins its
dimension and is aggregated again:

* one mart (:data:`BUILDERS`): one ``groupBy().agg()`` of its own partials;
* all seven (:func:`build_marts`): ONE scan of the fact. A ``GROUPING SETS``
  aggregate (Expand + partial hash aggregate) computes the partials per day,
  store, product and customer key and per key set of the two dimension-free
  marts. That table is bounded by the dimension sizes and is cut from its
  lineage with a reliable checkpoint.

Either way a hot key (a store or day holding a third of the rows) ships one
partial row per task, and no fact row takes part in a join. A stored mart has no order: sort on read
(``sorted_mart``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.functions import money as M
from mercato.operators.star import Star
from mercato.session import cut_lineage

# Output order of each mart, as stored by the source pipeline: (column, descending).
MART_ORDER = {
    "monthly_sales": [("year", False), ("month", False)],
    "regional_sales": [("total_revenue", True)],
    "category_profit": [("total_revenue", True)],
    "customer_ltv": [("avg_basket_size", True)],
    "product_ranking": [("total_revenue", True)],
    "cdc_impact": [("total_revenue", True)],
    "gst_analysis": [("gst_rate", False)],
}

# Money summed by partial measures: a fact row's value.
SUMMED: dict[str, Callable[[], Column]] = {
    "_total": lambda: F.col("total_sgd"),
    "_gp": lambda: F.col("gross_profit_sgd"),
    "_sub": lambda: F.col("subtotal_sgd"),
    "_tourist_rev": lambda: F.when(F.col("is_tourist_purchase") == 1, F.col("total_sgd")).otherwise(F.lit(0)),
    "_gst_amt": lambda: F.col("gst_amount_sgd"),
}

# Partial measures: name -> (aggregate over fact rows, re-aggregation of partials).
PARTIALS: dict[str, tuple[Callable[[], Column], Callable[[str], Column]]] = {
    "_rows": (lambda: F.count(F.lit(1)), F.sum),
    "_ids": (lambda: F.count("transaction_id"), F.sum),
    "_qty": (lambda: F.sum("quantity"), F.sum),
    "_total_n": (lambda: F.count("total_sgd"), F.sum),
    "_total_max": (lambda: F.max("total_sgd"), F.max),
    "_promo": (lambda: F.sum("is_promotion"), F.sum),
    "_cdc": (lambda: F.sum("cdc_voucher_used"), F.sum),
    "_holiday": (lambda: F.sum("holiday_season_flag"), F.sum),
    "_tourist": (lambda: F.sum("is_tourist_purchase"), F.sum),
    "_weekend": (lambda: F.count_if(F.col("is_weekend") == 1), F.sum),
    "_gst_rate": (lambda: F.sum("gst_rate"), F.sum),
    "_gst_rate_n": (lambda: F.count("gst_rate"), F.sum),
    "_disc": (lambda: F.sum("discount_pct"), F.sum),
    "_disc_n": (lambda: F.count("discount_pct"), F.sum),
    **{name: (lambda value=value: F.sum(value()), F.sum) for name, value in SUMMED.items()},
    "_gst_amt_n": (lambda: F.count("gst_amount_sgd"), F.sum),
}


def _long(p: str) -> Column:
    return F.col(p).cast("long")


def _money(p: str) -> Column:
    """ROUND(SUM(x), 2) (or of MAX) on the exact decimal, as double."""
    return F.round(F.col(p), 2).cast("double")


def _mean(total: str, n: str, scale: int = 2, in_scale: int = 6, times: int = 1) -> Column:
    return M.rounded_ratio(F.col(total), F.col(n), scale, in_scale, times)


def _basket() -> Column:
    return _mean("_total", "_total_n")


def _margin() -> Column:
    return M.pct_of(F.col("_gp"), F.col("_sub"))


def _rate(flag: str) -> Column:
    return M.pct_of(F.col(flag), F.col("_rows"), 1)


@dataclass(frozen=True)
class Mart:
    name: str
    dim: str | None                       # star table joined on grain[0]; None: fact only
    grain: tuple[str, ...]                # fact columns of the shared partial aggregate
    keys: tuple[str, ...]                 # output group keys
    finals: tuple[tuple[str, Callable[[], Column]], ...]
    key_types: tuple[tuple[str, str], ...] = ()   # output casts of keys

    @property
    def partials(self) -> list[str]:
        need = []
        for _, fn in self.finals:
            for ref in _refs(fn()):
                if ref in PARTIALS and ref not in need:
                    need.append(ref)
        return need

    def output(self, agg: DataFrame) -> DataFrame:
        casts = dict(self.key_types)
        keys = [F.col(k).cast(casts[k]).alias(k) if k in casts else F.col(k) for k in self.keys]
        return agg.select(*keys, *[fn().alias(n) for n, fn in self.finals])


def _refs(col: Column) -> list[str]:
    """Partial names a final expression reads (whole identifiers only)."""
    return [t for t in re.findall(r"\w+", str(col)) if t in PARTIALS]


#: Both marts without a dimension roll up from one grain.
PERIOD_GRAIN = ("period_label", "cdc_voucher_used", "gst_period", "gst_rate")

MARTS = (
    Mart("monthly_sales", "dim_date", ("date_key",), ("year", "month", "month_name", "quarter"), (
        ("transaction_count", lambda: _long("_ids")),
        ("total_units_sold", lambda: _long("_qty")),
        ("total_revenue", lambda: _money("_total")),
        ("avg_basket_size", _basket),
        ("gross_profit", lambda: _money("_gp")),
        ("gp_margin_pct", _margin),
        ("promo_transactions", lambda: _long("_promo")),
        ("cdc_redemptions", lambda: _long("_cdc")),
        ("holiday_txns", lambda: _long("_holiday")),
        ("avg_gst_rate_pct", lambda: _mean("_gst_rate", "_gst_rate_n", 1, in_scale=S.RATE.scale, times=100)),
    )),
    Mart("regional_sales", "dim_store", ("store_key",), ("region", "store_name", "store_size", "is_tourist_area"), (
        ("transactions", lambda: _long("_ids")),
        ("total_revenue", lambda: _money("_total")),
        ("avg_basket", _basket),
        ("gross_profit", lambda: _money("_gp")),
        ("gp_margin_pct", _margin),
        ("tourist_txns", lambda: _long("_tourist")),
        ("tourist_revenue", lambda: _money("_tourist_rev")),
        ("cdc_redemptions", lambda: _long("_cdc")),
        ("weekend_txns", lambda: _long("_weekend")),
    )),
    Mart("category_profit", "dim_product", ("product_key",), ("category", "category_group", "is_fresh_item"), (
        ("transactions", lambda: _long("_ids")),
        ("total_units", lambda: _long("_qty")),
        ("total_revenue", lambda: _money("_total")),
        ("avg_transaction_value", _basket),
        ("gross_profit", lambda: _money("_gp")),
        ("gp_margin_pct", _margin),
        ("avg_discount_pct", lambda: _mean("_disc", "_disc_n", 1, in_scale=S.RATE.scale, times=100)),
        ("promo_transactions", lambda: _long("_promo")),
        ("promo_rate_pct", lambda: _rate("_promo")),
    )),
    Mart("customer_ltv", "dim_customer", ("customer_key",),
         ("member_tier", "customer_segment", "has_membership", "tier_rank"), (
        ("total_transactions", lambda: _long("_ids")),
        ("total_spend", lambda: _money("_total")),
        ("avg_basket_size", _basket),
        ("max_single_transaction", lambda: _money("_total_max")),
        ("total_gp_generated", lambda: _money("_gp")),
        ("voucher_uses", lambda: _long("_cdc")),
        ("promo_purchases", lambda: _long("_promo")),
        ("promo_sensitivity_pct", lambda: _rate("_promo")),
    )),
    Mart("product_ranking", "dim_product", ("product_key",), ("product_name", "category", "category_group"), (
        ("times_purchased", lambda: _long("_ids")),
        ("total_units_sold", lambda: _long("_qty")),
        ("total_revenue", lambda: _money("_total")),
        ("avg_revenue_per_txn", _basket),
        ("gross_profit", lambda: _money("_gp")),
        ("gp_margin_pct", _margin),
        ("avg_discount_given", lambda: _mean("_disc", "_disc_n", 1, in_scale=S.RATE.scale, times=100)),
    )),
    Mart("cdc_impact", None, PERIOD_GRAIN, ("period_label", "cdc_voucher_used", "gst_period"), (
        ("transactions", lambda: _long("_rows")),
        ("total_revenue", lambda: _money("_total")),
        ("avg_basket", _basket),
        ("gross_profit", lambda: _money("_gp")),
    )),
    Mart("gst_analysis", None, PERIOD_GRAIN, ("gst_period", "gst_rate"), (
        ("transactions", lambda: _long("_rows")),
        ("avg_basket", _basket),
        ("avg_gst_paid", lambda: _mean("_gst_amt", "_gst_amt_n")),
        ("total_gst_collected", lambda: _money("_gst_amt")),
        ("total_revenue", lambda: _money("_total")),
        ("gp_margin_pct", _margin),
    ), key_types=(("gst_rate", "double"),)),
)
MART_SPECS = {m.name: m for m in MARTS}


def build_mart(star: Star, mart: Mart | str) -> DataFrame:
    """One mart straight from the fact: its partials at its grain, rolled up."""
    m = MART_SPECS[mart] if isinstance(mart, str) else mart
    return roll_up(star.table, m, star.fact.groupBy(*m.grain).agg(*[PARTIALS[p][0]().alias(p) for p in m.partials]))


def roll_up(table: Callable[[str], DataFrame], m: Mart, part: DataFrame) -> DataFrame:
    """A mart from its partials; `table` gives a dimension by name."""
    src = part if m.dim is None else part.join(table(m.dim), m.grain[0], "inner")
    return m.output(src.groupBy(*m.keys).agg(*[PARTIALS[p][1](p).alias(p) for p in m.partials]))


def _builder(name: str) -> Callable[[Star], DataFrame]:
    return lambda star: build_mart(star, name)


BUILDERS = {m.name: _builder(m.name) for m in MARTS}
(monthly_sales, regional_sales, category_profit, customer_ltv, product_ranking, cdc_impact,
 gst_analysis) = BUILDERS.values()


@dataclass
class SharedPartials:
    df: DataFrame          # checkpointed: grouping columns, partials, _gid
    gid: dict              # grain -> grouping_id of its rows

    def at(self, grain: tuple[str, ...], partials: list[str]) -> DataFrame:
        return self.df.filter(F.col("_gid") == self.gid[grain]).select(*grain, *partials)


def partial_sets(fact: DataFrame, marts: tuple[Mart, ...] = MARTS) -> tuple[DataFrame, dict]:
    """The lazy GROUPING SETS aggregate of every partial at every grain, and
    the ``grouping_id`` of each grain's rows."""
    grains = list(dict.fromkeys(m.grain for m in marts))
    cols = list(dict.fromkeys(c for g in grains for c in g))
    names = list(dict.fromkeys(p for m in marts for p in m.partials))
    pre = fact.groupingSets([list(g) for g in grains], *cols).agg(
        *[PARTIALS[p][0]().alias(p) for p in names], F.grouping_id().alias("_gid"))
    # grouping_id: bit (n-1-i) is set when column i is not in the row's set
    gid = {g: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in g) for g in grains}
    return pre, gid


def shared_partials(fact: DataFrame, marts: tuple[Mart, ...] = MARTS) -> SharedPartials:
    """Every partial of every mart at each mart's grain, from ONE fact scan,
    checkpointed (reliable) for the seven roll-ups that read it."""
    pre, gid = partial_sets(fact, marts)
    return SharedPartials(cut_lineage(pre), gid)


def mart_from_partials(star: Star, shared: SharedPartials, mart: Mart | str) -> DataFrame:
    m = MART_SPECS[mart] if isinstance(mart, str) else mart
    return roll_up(star.table, m, shared.at(m.grain, m.partials))


def build_marts(star: Star) -> dict[str, DataFrame]:
    """All seven marts from one scan of the fact."""
    parts = shared_partials(star.fact)
    return {m.name: mart_from_partials(star, parts, m) for m in MARTS}


def sorted_mart(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() if desc else F.col(c).asc() for c, desc in MART_ORDER[name]])
