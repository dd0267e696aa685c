"""Incremental loads of the warehouse: stable keys, marts equal to a rebuild, touched months only, interrupted loads."""
import datetime as dt

from decimal import Decimal

import pytest

from conftest import raw_frame

from mercato.operators import marts as MT
from mercato.operators.keys import extend_keys
from mercato.operators.star import build_star
from mercato.plans.loading import LoadedWarehouse, month_partials
from test_loads import files_read

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)

def sale(i, date, store="S1", region="East", product="P1", qty=1):
    return dict(transaction_id=i, date=date, hour=3, region=region, store_name=store, category="Beverages", product_name=product, customer_segment="A",
                member_tier="Gold", quantity=qty, unit_price_sgd=10.0, discount_pct=Decimal("0.1"), unit_price_after_disc=9.0, subtotal_sgd=Decimal(qty * 10),
                gst_rate=Decimal("0.08"), gst_amount_sgd=Decimal("0.8") * qty, total_sgd=Decimal("10.8") * qty, gross_profit_sgd=Decimal(3), payment_method="NETS",
                is_promotion=0, promo_type="x", cdc_voucher_used=qty % 2, is_tourist_purchase=0, is_weekend=0, is_public_holiday=0, holiday_season_flag=0,
                bonus_period_flag=0, period_label="p", gst_period="GST8", inflation_multiplier=1.0)

FIRST = [sale(f"t{m}-{i}", dt.date(2024, m, i + 1), f"M{i}", qty=i + 1, product=f"P{m}") for m in range(1, 9) for i in range(4)] + [sale(None, None, None, None)]
# t3-0 moves to September, t4-1 changes, two new stores that sort before all others, an id twice
LATE = [sale("t3-0", dt.date(2024, 9, 9), "A1"), sale("t4-1", dt.date(2024, 4, 20), "M1", qty=7), sale("n1", dt.date(2024, 4, 2), "A0", "West"),
        sale("n1", dt.date(2024, 4, 1), "A0", "West", qty=9), sale(None, dt.date(2024, 4, 3), None, None)]
LEFT = [r for r in FIRST if r["transaction_id"] not in ("t3-0", "t4-1")] + [LATE[0], LATE[1], LATE[2], LATE[4]]

@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    w = LoadedWarehouse(spark, str(tmp_path_factory.mktemp("loaded")))
    w.load(raw_frame(spark, FIRST), "first", T1)
    return w

def stores(w):
    return {(r.store_name, r.region): r.store_key for r in w.dim("dim_store").collect()}

def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)

def test_a_late_batch(spark, warehouse):
    w = warehouse
    before, months = stores(w), {(r.year, r.month): r.load for r in w.partials.manifest().collect()}
    assert w.load(raw_frame(spark, LATE), "late", T2).partitions == 3                  # March, April, September
    after = stores(w)
    assert {k: after[k] for k in before} == before
    assert (after["A0", "West"], after["A1", "East"]) == (len(before) + 1, len(before) + 2) and len(after) == len(before) + 2
    now = {(r.year, r.month): r.load for r in w.partials.manifest().collect()}
    assert {k for k in now if now[k] != months.get(k)} == {(2024, 3), (2024, 4), (2024, 9)}
    # the same marts and fact rows as a star built from what is left
    star = build_star(raw_frame(spark, LEFT))
    for m in MT.MART_SPECS:
        assert rows(w.mart(m)) == rows(MT.build_mart(star, m)), m
    names = ["transaction_id", "date_key", "quantity", "total_sgd"]
    assert rows(w.star().fact.select(*names)) == rows(star.fact.select(*names))
    # repeated: nothing changes
    assert w.load(raw_frame(spark, LATE), "late", T2).replayed and stores(w) == after and w.fact.version() == 2

def test_partials_are_read_from_touched_months_only(spark, warehouse):
    w = warehouse
    only = spark.createDataFrame([(2024, 5), (2024, 6)], "year int, month int")
    assert files_read(month_partials(w.fact.read(only=only)))["numPartitions"] == 2
    assert not any("/fact/" in f for f in w.mart("monthly_sales").inputFiles())

def test_an_interrupted_load_is_completed(spark, tmp_dir, monkeypatch):
    w = LoadedWarehouse(spark, tmp_dir)
    w.load(raw_frame(spark, FIRST), "first", T1)
    with monkeypatch.context() as m:
        m.setattr(LoadedWarehouse, "_touched", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            w.load(raw_frame(spark, LATE), "late", T2)
    assert w.fact.version() == 2 and w.partials.version() == 1
    w.load(raw_frame(spark, LATE), "late", T2)
    assert w.partials.version() == 2 and stores(w)["A0", "West"] == 6
    assert rows(w.mart("regional_sales")) == rows(MT.build_mart(build_star(raw_frame(spark, LEFT)), "regional_sales"))

def test_extended_keys_start_after_the_largest(spark):
    members = spark.createDataFrame([(None, "x"), ("a", None), ("b", "x"), ("c", "y")], "n string, r string")
    stored = spark.createDataFrame([("b", "x", 7), (None, "x", 3)], "n string, r string, k long")
    assert {(r.n, r.r): r.k for r in extend_keys(members, stored, ["n", "r"], "k").collect()} == {("a", None): 8, ("c", "y"): 9}
