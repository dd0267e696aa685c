"""Flags of the CSV ingest, the quality gate, upsert of a stored table, fixed tables, scans of the checks."""
import datetime as dt
import os
from decimal import Decimal

import pytest

from conftest import raw_frame
from mercato import schemas as S
from mercato.operators import quality as Q
from mercato.plans import pipeline as PL
from mercato.plans import warehouse as W
from mercato.sources import csv_ingest as CI
from mercato.streaming import incremental as INC

SF = "/root/testdata/sf0.001"


def test_csv_keeps_rates_and_flags_rounding_and_field_counts(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("transaction_id,discount_pct,total_sgd,note\n"
                "t1,0.125,1.5,n1\n"
                "t2,0.1234567,2.25,n2\n"
                "t3,0.1,3,n3,EXTRA\n"
                "t4,0.1\n"
                "t5,many,4,n5\n")
    got = {r.transaction_id: r for r in CI.read_transactions_csv(spark, tmp_dir).collect()}
    assert got["t1"].discount_pct == Decimal("0.125") and got["t1"]._rounded_columns == "" and got["t1"].note == "n1"
    assert got["t2"]._rounded_columns == "discount_pct"
    assert got["t3"]._corrupt_record == "t3,0.1,3,n3,EXTRA" and got["t3"].total_sgd == 3
    assert got["t4"]._corrupt_record == "t4,0.1" and got["t4"].total_sgd is None
    assert got["t5"]._bad_columns == "discount_pct" and got["t5"]._corrupt_record is None
    assert "quantity" in CI.missing_in_header(spark, tmp_dir)
    tags = {r.transaction_id: r.failed_checks for r in INC.quarantine(CI.read_transactions_csv(spark, tmp_dir)).collect()}
    assert "BAD_RECORD" in tags["t3"] and "BAD_VALUE" in tags["t5"] and "BAD" not in tags["t1"]


def test_gate_stops_before_the_marts(spark, tmp_dir):
    raw = W.sales(spark, SF)
    with pytest.raises(PL.QualityGateError):
        PL.run_pipeline(spark, raw, tmp_dir, S.fixture_star_config(), min_score=101)
    assert os.path.isdir(os.path.join(tmp_dir, "quality")) and not os.path.exists(os.path.join(tmp_dir, "marts"))


def test_quarantined_rows_stay_out_of_the_star(spark, tmp_dir):
    good = dict(transaction_id="g", date=dt.date(2024, 1, 5), total_sgd=Decimal("10.8"), subtotal_sgd=Decimal("10"),
                gst_amount_sgd=Decimal("0.8"), gst_rate=Decimal("0.08"), quantity=1, payment_method="NETS",
                discount_pct=Decimal("0.1"), unit_price_sgd=10.0, unit_price_after_disc=9.0)
    out = PL.run_pipeline(spark, raw_frame(spark, [good, dict(good, transaction_id="b", quantity=0)]), tmp_dir,
                          quarantine_rows=True, min_score=0)
    assert out["quarantined"] == 1 and out["raw_rows"] == 2 and len(out["marts"]) == 7
    assert [r.transaction_id for r in spark.read.parquet(os.path.join(tmp_dir, "star", "fact")).collect()] == ["g"]


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_dir):
    cols = "id string, ts int, v string, year int, month int"
    path = os.path.join(tmp_dir, "t")
    (spark.createDataFrame([("a", 1, "a1", 2024, 1), ("b", 1, "b1", 2024, 2), ("c", 1, "c1", 2024, 3), ("d", 1, "d1", 2024, 4),
                            (None, 1, "n1", 2024, 2), ("e", 1, "e1", None, None)], cols)
     .write.partitionBy("year", "month").parquet(path))
    march = lambda: {f for f in spark.read.parquet(path).inputFiles() if "/month=3/" in f}
    before = march()
    batch = spark.createDataFrame([("b", 2, "b2", 2024, 2), ("b", 3, "b3", 2024, 2), ("d", 2, "d2", 2024, 5),
                                   (None, 2, "n2", 2024, 2), ("e", 2, "e2", None, None)], cols)
    want = {("a", "a1", 1), ("b", "b3", 2), ("c", "c1", 3), ("d", "d2", 5), (None, "n1", 2), (None, "n2", 2), ("e", "e2", None)}
    for _ in range(2):                                   # rows without an id are inserts: a replay would add them again
        out = INC.upsert_table(spark, path, batch, "id", ["ts"], ["year", "month"])
        got = spark.read.parquet(path)
        assert {(r.id, r.v, r.month) for r in got.collect()} == want
        batch = batch.filter("id is not null")
    assert out["emptied"] == 0 and got.count() == len(want)
    assert march() == before
    assert INC.upsert_table(spark, path, batch.limit(0), "id", ["ts"], ["year", "month"]) == {"touched": 0, "emptied": 0}


def test_checks_scan_the_fact_twice(spark, star):
    plan = Q.run_checks(star)._jdf.queryExecution().optimizedPlan().toString()
    files = [line for line in plan.splitlines() if "Relation" in line and "transaction_id" in line]
    assert len(files) == 2


def test_fixed_tables_hold_the_expected_values():
    assert S.TIER_RANKS == {"Non-Member": 1, "Plus": 2, "Silver": 3, "Gold": 4, "Platinum": 5}
    assert S.VALID_GST_RATES == (0.07, 0.08, 0.09) and S.FISCAL_YEAR_START_MONTH == 4
    assert len(S.STORE_SIZES) == len(S.TOURIST_AREAS) == len(S.CATEGORY_MARGINS) == len(S.CATEGORY_GROUPS) == 15
    assert S.STORE_SIZES["Westgate"] == "Large" and S.STORE_SIZES["Hougang Mall"] == "Medium"
    assert {k for k, v in S.TOURIST_AREAS.items() if v} == {"Jurong Point Central", "Plaza Singapura", "Changi City Point",
                                                            "JEM Jurong", "Westgate", "IMM Jurong"}
    assert S.CATEGORY_MARGINS["Rice & Grains"] == 0.18 and S.CATEGORY_MARGINS["Health & Wellness"] == 0.48
    assert sorted(S.CATEGORY_MARGINS.values()) == [0.18, 0.22, 0.25, 0.28, 0.30, 0.32, 0.33, 0.35, 0.35, 0.38, 0.40, 0.42, 0.45, 0.45, 0.48]
    assert sum(v == "Perishables" for v in S.CATEGORY_GROUPS.values()) == 4
    assert sum(v == "Non-Food" for v in S.CATEGORY_GROUPS.values()) == 4
    assert (S.DEFAULT_STORE_SIZE, S.DEFAULT_TOURIST_AREA, S.DEFAULT_CATEGORY_GROUP, S.DEFAULT_GP_MARGIN, S.DEFAULT_TIER_RANK) == (
        "Medium", 0, "Other", 0.30, 1)
