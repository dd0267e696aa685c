"""Loads shuffle keys, not whole rows; stages of the warehouse are written when they are read."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame
from mercato.operators import key_filter
from mercato.sources import loads
from mercato.streaming import incremental as INC

COLS = "id string, ts int, v string, year int, month int"


def test_an_upsert_fixes_keys_but_no_whole_rows(spark, tmp_dir, monkeypatch):
    fixed = []
    real = loads.cut_lineage
    for m in (loads, INC, key_filter):
        monkeypatch.setattr(m, "cut_lineage", lambda df: fixed.append(df.columns) or real(df))
    t = loads.LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
    base = [(f"k{i}", 1, f"v{i}", 2024, i % 3) for i in range(30)] + [(None, 1, "none", 2024, 0)] * 2
    late = [("k1", 2, "new", 2024, 2), ("k1", 3, "newer", 2024, 0), ("k40", 1, "x", 2024, 1), (None, 1, "none", 2024, 1)]
    t.upsert(spark.createDataFrame(base, COLS), "id", ["ts"], "base", dt.datetime(2024, 1, 1))
    t.upsert(spark.createDataFrame(late, COLS), "id", ["ts"], "late", dt.datetime(2024, 2, 1))
    assert not [c for c in fixed if "v" in c]
    got = sorted(((r.id, r.v, r.month) for r in t.read().collect()), key=repr)
    want = [(f"k{i}", f"v{i}", i % 3) for i in range(30) if i != 1] + [("k1", "newer", 0), ("k40", "x", 1)] + [(None, "none", 0)] * 2 + [(None, "none", 1)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("bits", [64, 1 << 27])
def test_rows_are_split_exactly_whatever_the_bits(spark, monkeypatch, bits):
    """With 64 bits nearly every row is let through to the exact join or aggregate; the rows are the same."""
    monkeypatch.setattr(key_filter, "BITS", bits)
    rows = spark.range(500).select(F.when(F.col("id") > 9, F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))).alias("k"), F.col("id").alias("ts"), F.lit("v").alias("v"))
    keys = spark.range(0, 400, 7).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    gone = {f"k{i}" for i in range(0, 400, 7)}
    left = key_filter.without_keys(rows, "k", keys).collect()
    all_rows = [(None if i <= 9 else f"k{i % 400}", i) for i in range(500)]
    assert sorted((r.ts for r in left)) == [i for k, i in all_rows if k not in gone]
    newest = {k: i for k, i in all_rows if k is not None}
    got = [(r.k, r.ts) for r in INC.latest_per_key(rows, "k", ["ts"]).collect()]
    assert sorted(got, key=repr) == sorted([*newest.items(), *((None, i) for i in range(10))], key=repr)


def test_fingerprints_are_sums_of_signed_hashes(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("a"))
    want = df.agg(F.sum(F.xxhash64("a").cast("decimal(20,0)"))).first()[0]
    assert loads.fingerprint(df) == (1000, int(want))
    assert loads.fingerprint(df.limit(0)) == (0, 0)


def test_stages_are_written_when_they_are_read(spark, tmp_dir, monkeypatch):
    from mercato.plans import warehouse as W
    raw = raw_frame(spark, [dict(transaction_id=f"t{i}", date=dt.date(2024, 1, 1 + i), store_name="s", region="East") for i in range(3)])
    monkeypatch.setattr(W, "sales_from_tables", lambda s, d: raw)
    folder = os.path.join(tmp_dir, "sf")
    n = W.sales(spark, folder).count()
    root = W._root(spark, folder)
    assert n and not os.path.exists(os.path.join(root, "star"))
    assert W.star(spark, folder).fact.count() == n and not os.path.exists(os.path.join(root, "marts"))
    assert len(W.marts(spark, folder)) == 7
