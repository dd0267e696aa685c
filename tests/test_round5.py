"""An upsert works its batch out once for the write; the late batch is one scan."""
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import raw_frame
from mercato.plans import oracle_queries as OQ
from mercato.plans import registry as R
from mercato.sources import loads

COLS = "id string, ts int, v string, year int, month int"


def test_an_upsert_works_its_batch_out_four_times_at_most(spark, tmp_dir):
    """Fingerprint, hashes, rows whose id is single, rows whose id may repeat."""
    t = loads.LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
    base = [(f"k{i}", 1, f"v{i}", 2024, i % 3) for i in range(30)] + [(None, 1, "none", 2024, 0)] * 2
    t.upsert(spark.createDataFrame(base, COLS), "id", ["ts"], "base", dt.datetime(2024, 1, 1))
    late = [("k1", 2, "new", 2024, 2), ("k1", 3, "newer", 2024, 0), ("k40", 1, "x", 2024, 1), (None, 1, "none", 2024, 1)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    batch = spark.createDataFrame(late, COLS).mapInArrow(count, COLS)
    out = t.upsert(batch, "id", ["ts"], "late", dt.datetime(2024, 2, 1))
    assert len(late) <= seen.value <= 4 * len(late)
    assert (out.rows, out.partitions) == (4, 2)                       # k1 left month 1, for which k40 came; month 0 got k1
    got = sorted(((r.id, r.v, r.month) for r in t.read().collect()), key=repr)
    want = [(f"k{i}", f"v{i}", i % 3) for i in range(30) if i != 1] + [("k1", "newer", 0), ("k40", "x", 1)] + [(None, "none", 0)] * 2 + [(None, "none", 1)]
    assert got == sorted(want, key=repr)


def test_stored_rows_that_stay_are_not_shuffled(spark, tmp_dir, monkeypatch):
    t = loads.LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
    t.upsert(spark.createDataFrame([(f"k{i}", 1, f"v{i}", 2024, i % 3) for i in range(30)], COLS), "id", ["ts"], "base")
    dealt = []
    real = loads.LoadedTable._write
    monkeypatch.setattr(loads.LoadedTable, "_write", lambda self, rows, schema, folder, mode, spread: (
        dealt.append((rows.count(), spread)), real(self, rows, schema, folder, mode, spread))[1])
    t.upsert(spark.createDataFrame([("k1", 2, "new", 2024, 2)], COLS), "id", ["ts"], "late")
    assert dealt == [(1, True), (19, False)]                          # months 1 and 2, without k1
    assert t.read().count() == 30


def test_a_stored_type_that_widens_is_written_wide(spark, tmp_dir):
    t = loads.LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year",))
    t.upsert(spark.createDataFrame([("a", 1, 2024), ("b", 1, 2024)], "id string, n int, year int"), "id", ["n"], "one")
    t.upsert(spark.createDataFrame([("b", 1 << 40, 2024)], "id string, n long, year int"), "id", ["n"], "two")
    assert sorted((r.id, r.n) for r in t.read().select("id", "n").collect()) == [("a", 1), ("b", 1 << 40)]


def plain_late_batch(sales):
    hour = F.col("hour")
    fixes = (sales.filter((F.col("date") >= F.lit(OQ.UPSERT_BATCH_FROM).cast("date")) & (hour % 3 == 0))
             .withColumn("date", F.when(hour % 2 == 0, F.date_add("date", 31)).otherwise(F.col("date")))
             .withColumn("store_name", F.when(F.col("quantity") % 5 == 0, F.concat(F.lit("New "), "store_name")).otherwise(F.col("store_name")))
             .withColumn("subtotal_sgd", (F.col("subtotal_sgd") + 1).cast("decimal(18,4)"))
             .withColumn("total_sgd", (F.col("total_sgd") + 1).cast("decimal(18,6)")))
    new = (sales.filter(hour == 5).withColumn("transaction_id", F.concat("transaction_id", F.lit("-b")))
           .withColumn("product_name", F.when(F.col("quantity") > 40, F.concat("product_name", F.lit(" v2"))).otherwise(F.col("product_name"))))
    return (fixes.unionByName(fixes.filter(hour == 21).withColumn("date", F.date_sub("date", 1)))
            .unionByName(sales.filter(hour == 11)).unionByName(new))


def test_the_late_batch_reads_the_sales_once(spark, tmp_dir):
    last = dt.date.fromisoformat(OQ.UPSERT_BATCH_FROM)
    days = [None, last, last - dt.timedelta(1), last + dt.timedelta(3)]
    sales = raw_frame(spark, [dict(transaction_id=None if h == 3 else f"t{h}-{q}", date=d, hour=h, quantity=q, store_name=None if q == 45 else "s", region="East")
                              for d in days for h in [*range(24), None] for q in (None, 1, 5, 45)])
    path = os.path.join(tmp_dir, "sales")
    sales.write.parquet(path)
    sales = spark.read.parquet(path)
    got, want = R.late_batch(sales), plain_late_batch(sales)
    assert got.dtypes == want.dtypes
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == want.count()
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_only_stored_ids_that_may_repeat_are_joined(spark, tmp_dir, monkeypatch):
    from mercato.sources import id_index as I
    joined = []
    real = I.split_by_keys
    monkeypatch.setattr(I, "split_by_keys", lambda rows, key, keys: (lambda both: (joined.append(both[1].count()), both)[1])(real(rows, key, keys)))
    index = I.IdIndex(spark, os.path.join(tmp_dir, "ids"), buckets=2, bucket_bits=1 << 16)
    index.add(spark.range(5000).select(F.concat(F.lit("k"), "id").alias("transaction_id")), "one")
    batch = spark.createDataFrame([("k1",), ("k1",), ("new",), ("new",), (None,)], "transaction_id string")
    assert tuple(index.check(batch).first()) == (2, 1)
    assert joined == [1]


def test_the_csv_round_trip_writes_packed_files(spark, tmp_dir, monkeypatch):
    raw = raw_frame(spark, [dict(transaction_id=f"t{i}", date=dt.date(2024, 1, 1), store_name="a,\"b\"" if i else None, region="East") for i in range(3)])
    monkeypatch.setattr(R.W, "sales", lambda s, d: raw)
    monkeypatch.setattr(R.W, "scratch", lambda s, d, name: os.path.join(tmp_dir, name))
    got = R._csv_ingest(spark, tmp_dir)
    assert sorted((r.transaction_id, r.store_name) for r in got.collect()) == [("t0", None), ("t1", 'a,"b"'), ("t2", 'a,"b"')]
    files = [f for f in os.listdir(os.path.join(tmp_dir, "csv")) if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
