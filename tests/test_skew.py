"""A hot key holding a third of all rows: results stay exact and whole."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import raw_frame
from mercato.operators import marts
from mercato.operators import quality as Q
from mercato.operators.star import build_star
from mercato.streaming.incremental import latest_per_key


def _rows(n=3000):
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(dict(transaction_id="dup" if i % 10 == 0 else f"t{i}",
                         date=dt.date(2023, 1 + i % 12, 1 + i % 28),
                         store_name="Hot Store" if hot else f"S{i % 50}", region="Central" if hot else "East",
                         product_name=f"p{i % 40}", category="Beverages", customer_segment="Families",
                         member_tier="Gold", quantity=1 + i % 5, total_sgd=Decimal(i % 97) + Decimal("0.25"),
                         subtotal_sgd=Decimal(i % 97), gross_profit_sgd=Decimal(i % 7),
                         is_tourist_purchase=i % 2))
    return rows


def test_marts_and_checks_are_exact_with_a_hot_store(spark):
    rows = _rows()
    raw = raw_frame(spark, rows).repartition(8)
    st = build_star(raw)
    reg = {r.store_name: r for r in marts.regional_sales(st).collect()}
    hot = [r for r in rows if r["store_name"] == "Hot Store"]
    assert reg["Hot Store"].transactions == len(hot) == 1000
    assert reg["Hot Store"].total_revenue == float(sum(r["total_sgd"] for r in hot))
    assert sum(r.transactions for r in reg.values()) == len(rows)
    res = {r.check_id: r.violations for r in Q.run_checks(st, groups=("duplicates",)).collect()}
    assert res["K9"] == 300 - 1  # "dup" appears 300 times


def test_latest_per_key_with_a_third_of_rows_on_one_id(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i}", i, i * 2) for i in range(6000)]
    df = spark.createDataFrame(rows, "id string, ts int, v int").repartition(8)
    got = latest_per_key(df, "id", ["ts"])
    assert got.count() == 4001
    assert got.filter(F.col("id") == "hot").first().ts == 5997
