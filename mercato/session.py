"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "mercato", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.

    On a cluster the session comes from the launcher; only the SQL
    settings below matter there (AQE, skew join, UTC).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files (members, mart partials, key tags) are removed once
        # their RDD is garbage collected, so the shared folder does not grow per run
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset
    (local tests) fall back to a fresh scratch folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint dir
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    require_local(spark)
    local = tempfile.mkdtemp(prefix="mercato-ckpt-", dir=os.environ.get("MERCATO_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def require_local(spark: SparkSession) -> None:
    """A scratch folder of our own is only valid when driver and executors
    share one machine; on a cluster the shared folder must be configured."""
    master = spark.conf.get("spark.master", "") or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                           "(checkpoints and the per-session warehouse are written there)")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss, unlike localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the steps inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_maps_hashed(spark: SparkSession):
    """Shuffled joins whose build side has at most 64 MB in each partition, as measured when it was shuffled, hash that side instead of sorting
    both: wide rows are not sorted for every join."""
    return setting(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when their query ends, not when the driver's garbage collector finds them
    unused. For steps that write tables: a DataFrame collected a second time would have to shuffle again."""
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield
