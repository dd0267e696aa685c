"""Table sinks: overwrite / append, year-month partitioning, load
verification, samples and the JSON quality report.

Writes run in the tasks that produce the data (no driver collection, no
chunking to choose); ``partitionOverwriteMode=dynamic`` replaces only the
partitions an incremental batch touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                dynamic: bool = False) -> None:
    """Overwrite (replace) or append a Parquet table."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, got {mode}")
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def with_year_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))


def verify_load(spark: SparkSession, written_path: str, expected_rows: int) -> dict:
    """Stored count = input count (read back from storage)."""
    stored = spark.read.parquet(written_path).count()
    return {"expected": int(expected_rows), "stored": int(stored), "ok": int(stored) == int(expected_rows)}


def sample_rows(df: DataFrame, columns: list[str], n: int = 3, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows of a few columns, in a deterministic order."""
    return df.select(*columns).orderBy(*(order_by or columns[:1])).limit(n)


REPORT_SCHEMA = ("run_timestamp string, quality_score double, total_tests long, passed long, failed long, grade string, "
                 "test_details array<struct<test_name: string, status: string, detail: string, severity: string>>")


def quality_report(results: DataFrame, score_row: DataFrame) -> DataFrame:
    """One-row report: run time, score, counts, grade and the per-check
    details (an array with one element per check -- bounded by the check
    list, not by the data)."""
    details = results.agg(F.sort_array(F.collect_list(F.struct(
        "check_id", "test_name", "status", "detail", "severity")))).scalar()
    return score_row.withColumn("test_details", details).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("run_timestamp"),
        "quality_score", "total_tests", "passed", "failed", "grade",
        F.transform("test_details", lambda d: F.struct(
            d["test_name"].alias("test_name"), d["status"].alias("status"),
            d["detail"].alias("detail"), d["severity"].alias("severity"))).alias("test_details"))


def write_quality_report(results: DataFrame, score_row: DataFrame, path: str) -> dict:
    """JSON report written through Spark (lands in shared storage, not on the
    driver's disk); returns the report as a dict."""
    report = quality_report(results, score_row)
    report.coalesce(1).write.mode("overwrite").json(path)
    return report.sparkSession.read.schema(REPORT_SCHEMA).json(path).first().asDict(recursive=True)


def write_results_json(results: DataFrame, path: str) -> None:
    """Distributed JSON-lines sink for check results (any size)."""
    results.write.mode("overwrite").json(path)
