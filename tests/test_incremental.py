import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import raw_frame
from mercato.streaming import incremental as INC


def test_latest_per_key_with_a_hot_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(3000)] + [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")]
    df = spark.createDataFrame(rows, "id string, loaded_at int, val string").repartition(6)
    got = {r.id: (r.loaded_at, r.val) for r in INC.latest_per_key(df, "id", ["loaded_at"]).collect()}
    assert got == {"hot": (2999, "v2999"), "a": (2, "y"), "b": (5, "z")}


def test_upsert_replaces_touched_ids_and_inserts_new(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), ("c", 1, 30)], "id string, ts int, v int")
    batch = spark.createDataFrame([("b", 2, 21), ("b", 3, 22), ("d", 2, 40)], "id string, ts int, v int")
    got = sorted(map(tuple, INC.upsert(target, batch, "id", ["ts"]).collect()))
    assert got == [("a", 1, 10), ("b", 3, 22), ("c", 1, 30), ("d", 2, 40)]


def test_quarantine_tags_failed_checks(spark):
    good = dict(transaction_id="g", date=dt.date(2024, 1, 5), total_sgd=Decimal("10.8"), subtotal_sgd=Decimal("10"),
                gst_amount_sgd=Decimal("0.8"), gst_rate=Decimal("0.08"), quantity=1, payment_method="NETS",
                discount_pct=Decimal("0.1"), unit_price_sgd=10.0, unit_price_after_disc=9.0)
    bad = dict(good, transaction_id="b", quantity=0, gst_rate=Decimal("0.05"))
    df = raw_frame(spark, [good, bad, dict(good, transaction_id="d", date=None), dict(good, transaction_id=None)])
    valid, quarantined = INC.split_valid(df)
    assert [r.transaction_id for r in valid.collect()] == ["g"]
    assert {r.transaction_id: r.failed_checks for r in quarantined.collect()} == {"b": "K13,K15", "d": "K2", None: "K1"}


def test_stream_ingest_appends_partitions_and_quarantines(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    header = "transaction_id,date,quantity,total_sgd,subtotal_sgd,gst_amount_sgd,gst_rate,payment_method,discount_pct\n"
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write(header + "t1,2024-01-05,1,10.80,10.00,0.80,0.08,NETS,0.10\n"
                          "t2,2024-02-07,0,10.80,10.00,0.80,0.08,NETS,0.10\n")
    fact, quar, ckpt = (os.path.join(tmp_dir, x) for x in ("fact", "quar", "ckpt"))
    q = INC.stream_ingest(spark, src, fact, quar, ckpt)
    q.awaitTermination(120)
    assert [r.transaction_id for r in spark.read.parquet(fact).collect()] == ["t1"]
    assert spark.read.parquet(quar).first().failed_checks == "K13"
    # a second file is picked up by the next run from the same checkpoint
    with open(os.path.join(src, "b.csv"), "w") as fh:
        fh.write(header + "t3,2024-01-09,2,21.60,20.00,1.60,0.08,NETS,0.10\n")
    INC.stream_ingest(spark, src, fact, quar, ckpt).awaitTermination(120)
    got = spark.read.parquet(fact)
    assert sorted(r.transaction_id for r in got.collect()) == ["t1", "t3"]
    assert got.filter(F.col("month") == 1).count() == 2


def test_replayed_micro_batch_replaces_its_rows(spark, tmp_dir):
    rows = [dict(transaction_id="t1", date=dt.date(2024, 1, 5), quantity=1, total_sgd=Decimal("10.800000"),
                 subtotal_sgd=Decimal("10.0000"), gst_amount_sgd=Decimal("0.800000"), gst_rate=Decimal("0.08"),
                 payment_method="NETS", discount_pct=Decimal("0.10")),
            dict(transaction_id="t2", date=dt.date(2024, 2, 7), quantity=0, total_sgd=Decimal("10.800000"),
                 subtotal_sgd=Decimal("10.0000"), gst_amount_sgd=Decimal("0.800000"), gst_rate=Decimal("0.08"),
                 payment_method="NETS", discount_pct=Decimal("0.10"))]
    batch = raw_frame(spark, rows)
    fact, quar = os.path.join(tmp_dir, "fact"), os.path.join(tmp_dir, "quar")
    write = INC.batch_writer(fact, quar)
    write(batch, 0)
    write(batch.filter(F.col("transaction_id") == "t1").withColumn("transaction_id", F.lit("t9")), 1)
    write(batch, 0)  # replay of batch 0 after a failure before its commit
    got = spark.read.parquet(fact)
    assert sorted((r.transaction_id, r.load_batch) for r in got.collect()) == [("t1", 0), ("t9", 1)]
    assert [r.transaction_id for r in spark.read.parquet(quar).collect()] == ["t2"]
