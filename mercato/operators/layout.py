"""Do rows have to be brought together before they are written by partition?

A task writes one file for each partition value among its rows. Where the files
that tasks write hold ``FILE_ROWS`` rows or more on average, rows are written from
where they lie. Fewer rows per file are brought together: in fewer tasks, which
read more input each and shuffle nothing, as long as ``MIN_TASKS`` of these are
left and none holds much more than ``TASK_ROWS`` rows; else by a shuffle of whole
rows (``rebalance``), the widest of a load. So only tables below a fixed size are
shuffled, whatever the size of the input's splits.
The files are estimated by a sketch over the partition columns alone, so a wrong
estimate changes the number of files, never a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_ROWS = 10_000
MIN_TASKS = 32
TASK_ROWS = 2_000_000
_FILE = "_file_of_row"


def with_file(rows: DataFrame, parts: list[str]) -> DataFrame:
    """Names the file that a row would be written to from where it lies."""
    return rows.withColumn(_FILE, F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in parts]))


def files() -> Column:
    """Number of files, over the rows of ``with_file``."""
    return F.approx_count_distinct(_FILE).alias("files")


def small_files(rows: int, n_files: int) -> bool:
    return rows < n_files * FILE_ROWS


def values(parts: list[str]) -> Column:
    """Number of partition values."""
    return F.approx_count_distinct(F.xxhash64(*[F.col(c) for c in parts])).alias("values")


def fewer_tasks(rows: int, n_values: int) -> int:
    """Tasks that write large enough files of as many partition values each; 0: too few, or too large ones."""
    in_task = n_values * FILE_ROWS
    tasks = rows // max(1, in_task)
    return tasks if tasks >= MIN_TASKS and in_task <= TASK_ROWS else 0


def scattered(rows: DataFrame, parts: list[str]) -> bool:
    """Would the files be small? One scan of the partition columns."""
    n, n_files, _ = _counted(rows, parts)
    return small_files(n, n_files)


def _counted(rows: DataFrame, parts: list[str]) -> tuple[int, int, int]:
    r = with_file(rows.select(*parts), parts).agg(F.count(F.lit(1)).alias("rows"), files(), values(parts)).first()
    return int(r["rows"]), int(r["files"]), int(r["values"])


def gathering(rows: DataFrame, parts: list[str]) -> Callable[[DataFrame], DataFrame]:
    """How to bring rows together that lie as these do, from one scan of the partition columns."""
    n, n_files, n_values = _counted(rows, parts)
    if not small_files(n, n_files):
        return lambda df: df
    tasks = fewer_tasks(n, n_values)
    return lambda df: df.coalesce(tasks) if tasks else df.hint("rebalance", *parts)
