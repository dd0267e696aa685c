"""Loads at size: few files, one reading of batches without repeats, hashes and money sums that cost little; results as before."""
import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame

from mercato.functions import money as M
from mercato.operators import key_filter, layout
from mercato.operators import marts as MT
from mercato.operators.star import build_star
from mercato.plans.loading import MONTH, _with_month, month_partials
from mercato.session import small_maps_hashed
from mercato.sources import loads
from mercato.sources.loads import LoadedTable

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
COLS = "id string, ts int, year int, month int"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def money(places, text):
    return None if text is None else Decimal(text).quantize(Decimal(1).scaleb(-places))


VALUES = ["0.000001", "-0.000001", "999999999999.999999", "-999999999999.999999", "123456.654321", "-7.5", "0.999999", "-0.999999", None, "0"]


@pytest.mark.parametrize("places", [6, 4, 2, 0])
def test_longs_sum_to_the_same_decimal(spark, places):
    values = [None if v is None else money(places, v[:len(v) - 6 + places].rstrip(".")) if "." in v and len(v.split(".")[1]) == 6 else money(places, v) for v in VALUES]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values * 50)], f"k int, x decimal(18,{places})")
    units = df.select("k", M.unscaled("x", places).alias("u"))
    assert [r.u for r in units.limit(len(values)).collect()] == [None if v is None else int(v.scaleb(places)) for v in values]
    got = units.groupBy("k").agg(*M.limb_sums("u")).select("k", M.from_limbs("u", 28, places).alias("s"))
    want = df.groupBy("k").agg(F.sum("x").alias("s"))
    assert got.schema["s"].dataType == want.schema["s"].dataType
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    none = units.filter("u IS NULL").agg(*M.limb_sums("u")).select(M.from_limbs("u", 28, places))
    assert none.first()[0] is None


def test_partials_sum_money_as_longs(spark):
    rows = [dict(transaction_id=f"t{i}", date=dt.date(2024, 1 + i % 3, 1 + i % 20), store_name=f"s{i % 4}", region="R", product_name=f"p{i % 5}", category="c",
                 customer_segment="A", member_tier="Gold", quantity=i, subtotal_sgd=None if i == 7 else Decimal(i) - 30, total_sgd=Decimal("1.000001") * (i - 30),
                 gst_amount_sgd=Decimal("0.08"), gross_profit_sgd=Decimal("-0.3") * i, is_tourist_purchase=i % 2, period_label="p", gst_period="g", gst_rate=Decimal("0.07"))
            for i in range(60)]
    fact = _with_month(build_star(raw_frame(spark, rows)).fact)
    got = month_partials(fact)
    assert "decimal" not in ",".join(line for line in optimized(got).splitlines() if "Expand" in line).lower()
    for m in MT.MARTS:
        want = fact.groupBy(*MONTH, *m.grain).agg(*[MT.PARTIALS[p][0]().alias(p) for p in m.partials])
        rolled = got.filter(F.col("grain") == ",".join(m.grain)).select(*want.columns)
        assert [f.dataType for f in rolled.schema] == [f.dataType for f in want.schema], m.name
        assert sorted(map(tuple, rolled.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), m.name
    sums = [line for line in optimized(got).splitlines() if "Aggregate" in line]
    assert sums and "sum(total_sgd" not in "".join(sums) and "_u_total" in "".join(sums)


def test_a_batch_without_repeats_is_not_read_for_them(spark):
    rows = spark.range(100).select(F.when(F.col("id") > 3, F.concat(F.lit("k"), "id")).alias("k"), "id")
    single, some = key_filter.split_repeated(rows, "k")
    assert single.count() == 100 and "Range" not in optimized(some) and some.count() == 0
    single, some = key_filter.split_repeated(rows.union(rows.filter("id = 50")), "k")
    assert some.filter("k = 'k50'").count() == 2 and single.count() + some.count() == 101


def test_a_key_has_two_bits(spark):
    """50,000 keys in 2,097,152 bits: one bit each let through 2.4 % of other rows."""
    bits, key_filter.BITS = key_filter.BITS, 1 << 21
    try:
        keys = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("k"))
        miss, hit = key_filter.split_by_keys(spark.range(150_000).select(F.concat(F.lit("k"), "id").alias("k")), "k", keys)
        n = hit.count()
    finally:
        key_filter.BITS = bits
    assert hit.join(keys, "k").count() == 50_000 and 50_000 <= n < 51_400 and miss.count() == 150_000 - n


def test_rows_shuffled_by_key_are_written_by_partition(spark, tmp_dir, monkeypatch):
    """All rows go through the exact join or aggregate here: each of its tasks would write a file to each of the 12 months."""
    monkeypatch.setattr(key_filter, "BITS", 64)
    monkeypatch.setattr(layout, "FILE_ROWS", 1)                                # rows lie well: no shuffle for the write
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
        base = spark.range(0, 2400, numPartitions=2).select(F.concat(F.lit("t"), "id").alias("id"), F.lit(1).alias("ts"), F.lit(2024).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"))
        t.upsert(base.union(base.filter("id < 't3'")).select("id", "ts", "year", "month"), "id", ["ts"], "a", T1)
        t.upsert(base.filter("id < 't15'").withColumn("ts", F.lit(2)), "id", ["ts"], "b", T2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    ids = [f"t{i}" for i in range(2400)]
    assert sorted((r.id, r.ts) for r in t.read().collect()) == sorted((i, 2 if i < "t15" else 1) for i in ids)
    made = [len(glob.glob(f"{t.path}/data/load={n}/*/*/*.parquet")) for n in (1, 2)]
    assert made[0] <= 12 and made[1] <= 36                                     # 48 and 57 before


def test_hashes_are_worked_out_before_their_aggregate(spark, tmp_dir, monkeypatch):
    plans = []
    real = loads.fingerprint_columns
    monkeypatch.setattr(loads, "fingerprint_columns", lambda *a: plans.append(a) or real(*a))
    t = LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
    t.append(spark.createDataFrame([("a", 1, 2024, 1)], COLS), "a", T1)
    assert [len(a) for a in plans].count(1) == 1                              # of what is written, which is no aggregate
    df = spark.createDataFrame([("a", 1, 2024, 1)], COLS)
    assert "xxhash64" not in "".join(x for x in optimized(df.select(loads.row_hash(df.columns)).agg(*real())).splitlines() if "Aggregate" in x)


def test_small_build_sides_are_hashed(spark, monkeypatch):
    left = spark.range(20_000).repartition(3).withColumn("x", F.col("id") * 2)
    right = spark.range(20_000).repartition(3).withColumnRenamed("id", "k")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def kinds():
            df = left.join(right, left.id == right.k, "left")
            n = len(df.collect())
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
            return n, "SortMergeJoin" in plan, "ShuffledHashJoin" in plan
        assert kinds() == (20_000, True, False)
        with small_maps_hashed(spark):
            assert kinds() == (20_000, False, True)
        assert kinds() == (20_000, True, False)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
