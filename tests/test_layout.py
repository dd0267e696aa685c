"""Rows are brought together by partition only where the write would give small files; shuffle files go with their query."""
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.operators import layout
from mercato.operators.star import Star, build_star
from mercato.session import shuffles_dropped
from mercato.sources.loads import LoadedTable

from tests.conftest import raw_frame


def months(spark, n=400, tasks=4):
    """n rows in each of `tasks` tasks, half of them in either of two months."""
    return spark.range(n * tasks, numPartitions=tasks).select(
        F.concat(F.lit("t"), "id").alias("id"), F.lit(1).alias("ts"), F.lit(2024).alias("year"), (F.col("id") % 2 + 1).cast("int").alias("month"))


def test_scattered_counts_rows_per_file(spark, monkeypatch):
    assert layout.scattered(months(spark), ["year", "month"])
    monkeypatch.setattr(layout, "FILE_ROWS", 100)
    assert not layout.scattered(months(spark), ["year", "month"])
    assert not layout.scattered(months(spark).filter("month > 2"), ["year", "month"])


@pytest.mark.parametrize("file_rows, files", [(10_000, 2), (100, 8)])
def test_upsert_writes_large_files_from_where_rows_lie(spark, tmp_dir, monkeypatch, file_rows, files):
    monkeypatch.setattr(layout, "FILE_ROWS", file_rows)
    table = LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
    assert table.upsert(months(spark), "id", ["ts"], "a").partitions == 2
    assert len(glob.glob(f"{tmp_dir}/t/data/load=1/*/*/*.parquet")) == files
    table.upsert(months(spark, 10).withColumn("ts", F.lit(2)), "id", ["ts"], "b")
    got = {(r.month, r.ts): r.n for r in table.read().groupBy("month", "ts").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, 1): 780, (2, 1): 780, (1, 2): 20, (2, 2): 20}


@pytest.mark.parametrize("file_rows, files", [(10_000, 2), (10, 6)])
def test_fact_is_written_from_where_rows_lie(spark, tmp_dir, monkeypatch, file_rows, files):
    import datetime as dt
    monkeypatch.setattr(layout, "FILE_ROWS", file_rows)
    rows = [{"transaction_id": f"t{i}", "date": dt.date(2024, 1 + i % 2, 1 + i % 20), "store_name": f"s{i % 3}", "region": "R", "quantity": i} for i in range(120)]
    raw = raw_frame(spark, rows).coalesce(1).repartition(3)
    build_star(raw, S.StarConfig()).write(tmp_dir, partition_fact=True)
    assert len(glob.glob(f"{tmp_dir}/fact/*/*/*.parquet")) == files
    got = Star.read(spark, tmp_dir).fact.select("transaction_id", "date_key", "quantity").collect()
    assert sorted(map(tuple, got)) == sorted((r["transaction_id"], int(r["date"].strftime("%Y%m%d")), r["quantity"]) for r in rows)


def test_shuffle_files_go_with_their_query(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    given = spark.conf.get(name)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f.getName() for f in (disk.getAllFiles().apply(i) for i in range(disk.getAllFiles().size())) if f.getName().startswith("shuffle_")}
    before = shuffles()
    with shuffles_dropped(spark):
        sums = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
        first = sorted(sums.collect())
    assert spark.conf.get(name) == given
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    assert sorted(sums.collect()) == first             # collected again, after its shuffle files went


def far_months(spark, tasks=40):
    """Few rows of each of two months in every one of `tasks` tasks."""
    return months(spark, 20, tasks)


def shuffles_of_rows(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("RebalancePartitions") + df._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions")


@pytest.mark.parametrize("least, shuffled, tasks", [(20, False, 20), (21, True, None)])
def test_small_splits_are_read_in_fewer_tasks_not_shuffled(spark, monkeypatch, least, shuffled, tasks):
    monkeypatch.setattr(layout, "FILE_ROWS", 20)
    monkeypatch.setattr(layout, "MIN_TASKS", least)
    rows = far_months(spark)
    got = layout.gathering(rows, ["year", "month"])(rows)
    assert bool(shuffles_of_rows(got)) == shuffled
    assert tasks is None or got.rdd.getNumPartitions() == tasks
    assert got.count() == rows.count()


def test_tasks_are_not_made_larger_than_their_limit(spark, monkeypatch):
    monkeypatch.setattr(layout, "FILE_ROWS", 20)
    monkeypatch.setattr(layout, "MIN_TASKS", 2)
    monkeypatch.setattr(layout, "TASK_ROWS", 39)
    rows = far_months(spark)
    assert shuffles_of_rows(layout.gathering(rows, ["year", "month"])(rows))


def test_upsert_of_small_splits_writes_from_fewer_tasks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(layout, "FILE_ROWS", 20)
    monkeypatch.setattr(layout, "MIN_TASKS", 20)
    table = LoadedTable(spark, os.path.join(tmp_dir, "t"), ("year", "month"))
    assert table.upsert(far_months(spark), "id", ["ts"], "a").rows == 800
    assert len(glob.glob(f"{tmp_dir}/t/data/load=1/*/*/*.parquet")) == 40       # 20 tasks, two months; shuffled: 2
    assert sorted(r.id for r in table.read().collect()) == sorted(f"t{i}" for i in range(800))


def test_fact_of_small_splits_is_written_from_fewer_tasks(spark, tmp_dir, monkeypatch):
    import datetime as dt
    monkeypatch.setattr(layout, "FILE_ROWS", 10)
    monkeypatch.setattr(layout, "MIN_TASKS", 6)
    rows = [{"transaction_id": f"t{i}", "date": dt.date(2024, 1 + i % 2, 1 + i % 20), "store_name": f"s{i % 3}", "region": "R", "quantity": i} for i in range(120)]
    raw = raw_frame(spark, rows).coalesce(1).repartition(12)
    build_star(raw, S.StarConfig()).write(tmp_dir, partition_fact=True)
    assert 2 < len(glob.glob(f"{tmp_dir}/fact/*/*/*.parquet")) <= 12
    got = Star.read(spark, tmp_dir).fact.select("transaction_id", "date_key", "quantity").collect()
    assert sorted(map(tuple, got)) == sorted((r["transaction_id"], int(r["date"].strftime("%Y%m%d")), r["quantity"]) for r in rows)
