"""Stored marts, unique sale ids, upsert with missing ids, lossless ingest."""
import os

import pytest
from pyspark.sql import functions as F

from mercato.plans import insights as I
from mercato.plans import pipeline as PL
from mercato.plans import registry as R
from mercato.plans import warehouse as W
from mercato.sources.csv_ingest import read_transactions_csv
from mercato.streaming.incremental import upsert

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["yoy", "region_share", "category_top", "tier_multiplier", "voucher_lift", "product_top", "table_counts"])
def test_analyses_read_the_stored_marts(spark, name):
    files = R.QUERIES[name](spark, SF).inputFiles()
    assert any("/marts/" in f for f in files)
    assert name == "table_counts" or not any("/star/fact" in f for f in files)


def test_every_sale_has_its_own_id_and_hour(spark):
    sales, fact = W.sales(spark, SF), W.star(spark, SF).fact
    n = sales.count()
    assert sales.select("transaction_id").distinct().count() == n
    assert I.hourly(fact).agg(F.sum("txns")).first()[0] == n
    assert fact.select("hour").distinct().count() == 24


def test_upsert_keeps_rows_without_an_id(spark):
    cols = "id string, ts int, v string"
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), (None, 1, "x")], cols)
    batch = spark.createDataFrame([("a", 2, "mid"), ("a", 3, "new"), (None, 2, "y"), (None, 2, "y")], cols)
    got = sorted(map(tuple, upsert(target, batch, "id", ["ts"]).collect()), key=repr)
    want = [("a", 3, "new"), ("b", 1, "old"), (None, 1, "x"), (None, 2, "y"), (None, 2, "y")]
    assert got == sorted(want, key=repr)


def test_ingest_keeps_extra_columns_and_verifies_the_load(spark, tmp_dir):
    raw = W.sales(spark, SF).withColumn("note", F.lit("n"))
    info = PL.ingest(spark, raw, tmp_dir)
    assert info["rows"] == info["added"] == raw.count()
    assert "note" in spark.read.parquet(info["path"]).columns


def test_files_with_other_headers_stop_the_read(spark, tmp_dir):
    for name, text in (("a.csv", "date,region\n2024-01-01,East\n"), ("b.csv", "region,date\nWest,2024-01-02\n")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_transactions_csv(spark, tmp_dir).select("date", "region").collect()
