import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import raw_frame
from mercato import schemas as S
from mercato.operators.keys import dense_keys
from mercato.operators.star import build_star, orphan_counts


def test_fact_has_one_row_per_raw_row(spark, star):
    from mercato.plans import warehouse
    raw = warehouse.sales(spark, "/root/testdata/sf0.001")
    assert star.fact.count() == raw.count()
    assert orphan_counts(star.fact).first().asDict() == {
        "date_key_orphans": 0, "store_key_orphans": 0, "product_key_orphans": 0, "customer_key_orphans": 0}


def test_dimension_keys_are_dense_and_ordered(star):
    for dim, key, natural in [(star.dim_store, "store_key", ["store_name", "region"]),
                              (star.dim_product, "product_key", ["product_name", "category"]),
                              (star.dim_customer, "customer_key", ["customer_segment", "member_tier"])]:
        rows = dim.orderBy(key).collect()
        assert [r[key] for r in rows] == list(range(1, len(rows) + 1))
        nat = [tuple(r[c] for c in natural) for r in rows]
        assert nat == sorted(nat)
        assert len(set(nat)) == len(nat)


import pytest


def test_dense_keys_match_row_number_across_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5000).cast("string").alias("k"), (F.col("id") % 3).alias("j"))
    got = dense_keys(df, ["k", "j"], "key")
    want = df.withColumn("key", F.row_number().over(Window.orderBy("k", "j")).cast("long"))
    assert got.rows == 5000
    assert sorted(map(tuple, got.df.select("k", "j", "key").collect())) == \
        sorted(map(tuple, want.select("k", "j", "key").collect()))


def test_timestamps_on_one_day_give_one_date_row_and_no_fan_out(spark):
    base = dict(store_name="A", region="Central", product_name="P", category="Beverages",
                customer_segment="Families", member_tier="Gold", total_sgd=Decimal("10.000000"))
    raw = raw_frame(spark, [dict(base, transaction_id="t1", date=dt.date(2024, 1, 5)),
                            dict(base, transaction_id="t2", date=dt.date(2024, 1, 5))])
    raw = raw.withColumn("date", F.to_timestamp(F.concat(F.col("date").cast("string"),
                                                         F.when(F.col("transaction_id") == "t1", " 08:00:00")
                                                         .otherwise(" 17:30:00"))))
    st = build_star(raw)
    assert st.dim_date.count() == 1
    assert st.fact.count() == 2
    row = st.dim_date.first()
    assert (row.date_key, row.day_name, row.day_of_week_num, row.month_name, row.fiscal_year) == \
        (20240105, "Friday", 5, "January", 2023)


def test_null_natural_keys_find_their_dimension_row(spark):
    raw = raw_frame(spark, [
        dict(transaction_id="a", date=dt.date(2023, 5, 1), store_name=None, region="East"),
        dict(transaction_id="b", date=dt.date(2023, 5, 1), store_name="S", region="East"),
    ])
    st = build_star(raw)
    keys = {r.transaction_id: r.store_key for r in st.fact.collect()}
    assert keys["a"] is not None and keys["b"] is not None and keys["a"] != keys["b"]
    cust = st.dim_customer.first()
    assert cust.has_membership == 1 and cust.tier_rank == S.DEFAULT_TIER_RANK  # NULL tier


def test_lookup_defaults_and_region_code(spark):
    raw = raw_frame(spark, [
        dict(transaction_id="a", date=dt.date(2022, 3, 31), store_name="Westgate", region="West",
             product_name="x", category="Health & Wellness", member_tier="Non-Member"),
        dict(transaction_id="b", date=dt.date(2022, 4, 1), store_name="Unknown", region="North-East",
             product_name="y", category="Mystery", member_tier="Platinum"),
    ])
    st = build_star(raw)
    stores = {r.store_name: r for r in st.dim_store.collect()}
    assert stores["Westgate"].store_size == "Large" and stores["Westgate"].is_tourist_area == 1
    assert stores["Unknown"].store_size == "Medium" and stores["Unknown"].is_tourist_area == 0
    assert stores["Unknown"].region_code == "NOR"
    prods = {r.product_name: r for r in st.dim_product.collect()}
    assert prods["x"].category_group == "Non-Food" and prods["x"].base_gp_margin == 0.48
    assert prods["y"].category_group == "Other" and prods["y"].base_gp_margin == 0.30
    tiers = {r.member_tier: r for r in st.dim_customer.collect()}
    assert tiers["Non-Member"].has_membership == 0 and tiers["Platinum"].tier_rank == 5
    fy = {r.date_key: r.fiscal_year for r in st.dim_date.collect()}
    assert fy == {20220331: 2021, 20220401: 2022}


def test_iso_week_at_year_end(spark):
    raw = raw_frame(spark, [dict(transaction_id="a", date=dt.date(2024, 12, 30))])
    assert build_star(raw).dim_date.first().week_of_year == 1


def test_members_of_all_dimensions_in_one_scan_match_separate_distincts(spark):
    from mercato.operators.star import MEMBER_KEYS, dimension_members
    raw = raw_frame(spark, [
        dict(transaction_id="a", date=dt.date(2023, 5, 1), store_name=None, region="East",
             product_name="p", category=None, customer_segment="Families", member_tier=None),
        dict(transaction_id="b", date=dt.date(2023, 5, 1), store_name="S", region="East",
             product_name="p", category="Beverages", customer_segment="Families", member_tier="Gold"),
        dict(transaction_id="c", date=None, store_name="S", region="East",
             product_name=None, category=None, customer_segment=None, member_tier=None),
    ])
    m = dimension_members(raw)
    base = raw.withColumn("_day", F.to_date("date"))
    for dim, keys in MEMBER_KEYS.items():
        want = sorted(map(tuple, base.select(*keys).distinct().collect()), key=repr)
        got = sorted(map(tuple, m.of(dim).collect()), key=repr)
        assert got == want, dim
        assert m.rows[dim] == len(want)
