import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException

from mercato import schemas as S
from mercato.plans import pipeline as PL
from mercato.sources import csv_ingest as CI
from mercato.sources import profile as P
from mercato.sources import sinks


CSV = """transaction_id,date,region,store_name,category,product_name,quantity,total_sgd,payment_method,is_promotion,gst_rate
t1,2024-01-05,Central,Westgate,Beverages,Cola,2,10.50,NETS,True,0.09
t2,not-a-date,East,Westgate,Beverages,Cola,NA,N/A,GrabPay,0,0.09
t3,2024-02-01,,Westgate,Beverages,Cola,1,-3.00,NETS,0,0.08
t3,2024-02-01,West,Westgate,Beverages,Cola,1,3.00,NETS,0,0.08
"""


@pytest.fixture()
def csv_path(tmp_dir):
    p = os.path.join(tmp_dir, "tx.csv")
    with open(p, "w") as fh:
        fh.write(CSV)
    return p


def test_csv_ingest_fixed_schema_null_words_and_bad_values(spark, csv_path):
    df = CI.read_transactions_csv(spark, csv_path)
    rows = {r.transaction_id + str(i): r for i, r in enumerate(df.orderBy("transaction_id", "region").collect())}
    assert df.schema["date"].dataType == S.RAW_SCHEMA["date"].dataType
    r1 = rows["t10"]
    assert r1.date == dt.date(2024, 1, 5) and r1.quantity == 2 and r1.is_promotion == 1
    r2 = rows["t21"]
    assert r2.date is None and r2.quantity is None and r2.total_sgd is None and r2._bad_columns == "date"
    assert rows["t32"].region is None  # empty string is NULL
    assert "hour" in df.columns  # absent optional column arrives as NULL
    conf = CI.conformance(df.drop("payment_method"))
    assert conf["missing_required"] == ["payment_method"]


def test_missing_file_raises(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        CI.read_transactions_csv(spark, os.path.join(tmp_dir, "nope.csv"))


def test_preload_issues_warn_only(spark, csv_path):
    df = CI.read_transactions_csv(spark, csv_path)
    got = {r.issue: r.found for r in P.preload_issues(df).collect()}
    assert got == {"missing_required_columns": 0, "duplicate_transaction_ids": 1, "negative_total_sgd": 1}
    got = {r.issue: r.detail for r in P.preload_issues(df.drop("category")).collect()}
    assert got["missing_required_columns"] == "category"


def test_write_modes_verify_and_sample(spark, tmp_dir):
    df = spark.range(10).withColumnRenamed("id", "x")
    path = os.path.join(tmp_dir, "t")
    sinks.write_table(df, path)
    sinks.write_table(df, path, mode="append")
    assert sinks.verify_load(spark, path, 20)["ok"]
    sinks.write_table(df, path)  # replace
    assert sinks.verify_load(spark, path, 10)["ok"]
    assert [r.x for r in sinks.sample_rows(spark.read.parquet(path), ["x"], 3).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        sinks.write_table(df, path, mode="upsert")


def test_dynamic_partition_overwrite_replaces_only_touched_months(spark, tmp_dir):
    from pyspark.sql import functions as F
    path = os.path.join(tmp_dir, "p")
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 2)], "date date, v int")
    sinks.write_table(sinks.with_year_month(a), path, partition_by=["year", "month"])
    b = spark.createDataFrame([(dt.date(2024, 2, 3), 3)], "date date, v int")
    sinks.write_table(sinks.with_year_month(b), path, partition_by=["year", "month"], dynamic=True)
    got = sorted((r.month, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 3)]
    assert spark.read.parquet(path).filter(F.col("month") == 1).count() == 1


def test_pipeline_end_to_end(spark, tmp_dir):
    from mercato.plans import warehouse
    raw = warehouse.sales(spark, "/root/testdata/sf0.001")
    out = PL.run_pipeline(spark, raw, tmp_dir, S.fixture_star_config())
    assert out["raw_rows"] == raw.count()
    assert len(out["marts"]) == 7
    report = spark.read.json(os.path.join(tmp_dir, "quality", "quality_report.json")).first().asDict(recursive=True)
    assert report["total_tests"] == 27 and len(report["test_details"]) == 27
    assert report["quality_score"] == out["quality_score"]
    assert set(report["test_details"][0]) == {"test_name", "status", "detail", "severity"}
    fact_dirs = os.listdir(os.path.join(tmp_dir, "star", "fact"))
    assert any(d.startswith("year=") for d in fact_dirs)


def test_table_counts_and_profile(spark, star):
    got = {r.table_name: r.rows for r in P.table_counts({"a": star.dim_store, "b": star.fact}).collect()}
    assert got == {"a": star.dim_store.count(), "b": star.fact.count()}
