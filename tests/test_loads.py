"""Loads: exactly once, whole or not at all, with partitions touched as a table."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from mercato.sources.loads import LoadConflict, LoadedTable, fingerprint

COLS = "id string, ts int, v string, year int, month int"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def rows(df):
    return sorted(((r.id, r.v, r.month) for r in df.collect()), key=repr)


def files_read(df):
    """Files and partitions that the scans of an executed plan read."""
    df.collect()
    total = {"numFiles": 0, "numPartitions": 0}

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        if node.getClass().getSimpleName() == "FileSourceScanExec" and "/data" in node.toString():
            for k in total:
                m = node.metrics().get(k)
                total[k] += m.get().value() if m.isDefined() else 0
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return total


@pytest.fixture()
def table(spark, tmp_dir):
    t = LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
    t.append(spark.createDataFrame([("a", 1, "a1", 2024, 1), ("b", 1, "b1", 2024, 2), ("c", 1, "c1", 2024, 3), ("d", 1, "d1", 2024, 4), (None, 1, "n1", 2024, 2)], COLS), "first", T1)
    return t


def batch(spark):
    return spark.createDataFrame([("b", 2, "b2", 2024, 2), ("b", 3, "b3", 2024, 2), ("d", 2, "d2", 2024, 5), (None, 2, "n2", 2024, 2)], COLS)


def test_upsert_moves_rows_empties_partitions_and_is_replayed(spark, table):
    want = [("a", "a1", 1), ("b", "b3", 2), ("c", "c1", 3), ("d", "d2", 5), (None, "n1", 2), (None, "n2", 2)]
    first = table.upsert(batch(spark), "id", ["ts"], "second", T2)
    assert (first.version, first.replayed, first.partitions) == (2, False, 3)
    assert rows(table.read()) == sorted(want, key=repr)
    assert {r.v: r.loaded_at for r in table.read().collect()} == {"a1": T1, "b3": T2, "c1": T1, "d2": T2, "n1": T1, "n2": T2}
    again = table.upsert(batch(spark), "id", ["ts"], "second", T2)
    assert again.replayed and table.version() == 2 and rows(table.read()) == sorted(want, key=repr)
    assert rows(table.read(1)) == rows(table.read(1).filter("ts = 1"))                   # the older version is still whole
    assert {(r.year, r.month, r.load) for r in table.manifest().collect()} == {(2024, 1, 1), (2024, 2, 2), (2024, 3, 1), (2024, 5, 2)}
    assert table.upsert(batch(spark).limit(0), "id", ["ts"], "nothing").partitions == 0 and rows(table.read()) == sorted(want, key=repr)


def test_a_repeated_append_adds_nothing(spark, tmp_dir):
    t = LoadedTable(spark, os.path.join(tmp_dir, "plain"))
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    assert not t.append(df).replayed and t.append(df.repartition(5)).replayed
    assert t.read().count() == 1000
    t.append(df.limit(10), "named")
    with pytest.raises(LoadConflict):
        t.append(df.limit(11), "named")
    assert t.read().count() == 1010
    assert {(r.load_id == "named", r.rows, r.stored_rows) for r in t.ledger().collect()} == {(False, 1000, 1000), (True, 10, 1010)}


def test_fingerprint_ignores_order_and_sees_content(spark):
    df = spark.range(100).withColumn("s", F.col("id").cast("string"))
    assert fingerprint(df) == fingerprint(df.orderBy(F.desc("id")).repartition(7)) == fingerprint(df.select("s", "id"))
    assert fingerprint(df) != fingerprint(df.withColumn("s", F.when(F.col("id") == 5, "x").otherwise(F.col("s"))))
    assert fingerprint(df) != fingerprint(df.union(df.limit(1))) and fingerprint(df.limit(0)) == (0, 0)


def test_a_load_that_fails_is_never_seen_and_can_be_repeated(spark, table, monkeypatch):
    before = rows(table.read())
    boom = F.udf(lambda v: 1 / 0, "string")
    with pytest.raises(Exception):
        table.upsert(batch(spark).withColumn("v", boom("v")), "id", ["ts"], "second")
    # files and manifest written, commit missing
    commits = os.path.join(table.path, "commits", "commit=2")
    table.upsert(batch(spark), "id", ["ts"], "second")
    os.rename(commits, os.path.join(table.path, "lost"))
    assert table.version() == 1 and rows(table.read()) == before
    table.upsert(batch(spark), "id", ["ts"], "second")
    assert table.version() == 2 and len(table.read().collect()) == 6


def test_replace_and_null_partitions(spark, table):
    table.replace(spark.createDataFrame([("x", 9, "x9", 2024, 2)], COLS), "r", touched=spark.createDataFrame([(2024, 4)], "year int, month int"))
    assert rows(table.read()) == [("a", "a1", 1), ("c", "c1", 3), ("x", "x9", 2)]
    with pytest.raises(ValueError, match="null"):
        table.append(spark.createDataFrame([("x", 9, "x9", 2024, None)], COLS), "bad")
    assert table.version() == 2


def test_many_partitions(spark, tmp_dir):
    """A batch that touches all partitions, and one that reads three: by default of 600 (a predicate of literals fails at 500),
    with MERCATO_TEST_PARTITIONS=5000 of as many (eight minutes here)."""
    n = int(os.environ.get("MERCATO_TEST_PARTITIONS", "600"))
    t = LoadedTable(spark, os.path.join(tmp_dir, "many"), ("day",))
    base = spark.range(0, n, numPartitions=4).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("ts"), F.col("id").cast("int").alias("day"))
    t.append(base, "base")
    out = t.upsert(base.filter("day < 3").withColumn("ts", F.lit(2)), "id", ["ts"], "few")
    assert out.partitions == 3 and t.read().agg(F.sum("ts")).first()[0] == n + 3
    few = spark.createDataFrame([(1,), (2,), (n - 1,)], "day int")
    assert files_read(t.read(only=few)) == {"numFiles": 5, "numPartitions": 5}      # a replaced version of days 1 and 2 is listed too
    out = t.upsert(base.withColumn("ts", F.lit(3)), "id", ["ts"], "all")
    assert out.partitions == n and t.read().agg(F.sum("ts"), F.count("*")).first()[:] == (3 * n, n)


def test_a_batch_is_checked_against_bits_and_few_buckets(spark, tmp_dir):
    from mercato.sources.id_index import IdIndex
    index = IdIndex(spark, tmp_dir, buckets=8, bucket_bits=1 << 14)
    first = spark.range(2000).select(F.concat(F.lit("t"), "id").alias("transaction_id")).union(spark.createDataFrame([(None,)], "transaction_id string"))
    assert index.check(first.union(first.limit(5))).first()[:] == (0, 5)              # nothing stored yet
    index.add(first, "first")
    index.add(first, "first")                                                          # repeated: nothing is added
    batch = spark.createDataFrame([("t5",), ("t5",), ("new",), ("new",), ("other",), (None,)], "transaction_id string")
    assert index.check(batch).first()[:] == (3, 1)
    assert {(r.key, r.n, r.stored) for r in index.repeats(batch).collect()} == {("=t5", 2, True), ("=new", 2, False), ("null", 1, True)}
    assert index.check(batch.limit(0)).first()[:] == (0, 0) and index.ids.read().count() == 2001
    only = spark.createDataFrame([(3,)], "bucket int")
    assert files_read(index.ids.read(only=only))["numPartitions"] == 1
