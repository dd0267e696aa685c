"""Warehouse access for registered queries.

For each (session, data folder) the test tables are turned into the raw
transactions table and the star exactly as the batch pipeline does it
(ingest -> written raw table -> star -> written star -> written marts), once. The tables are
written under the session's checkpoint folder (``spark.checkpoint.dir``, a
shared folder on a cluster), each when the first query reads it, and every registered query then starts from
Parquet scans: column pruning, pushed filters, real size statistics for
join planning, and a year/month partitioned fact.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

from mercato import schemas as S
from mercato.operators.star import Star
from mercato.plans import pipeline as PL
from mercato.session import ensure_checkpoint_dir, require_local, shuffles_dropped, small_maps_hashed
from mercato.sources.sales import sales_from_tables

_CACHE: dict = {}


def _key(spark: SparkSession, sf_dir: str):
    try:
        app = spark.sparkContext.applicationId
    except Exception:
        app = str(id(spark))
    return app, os.path.abspath(sf_dir)


def _root(spark: SparkSession, sf_dir: str) -> str:
    base = ensure_checkpoint_dir(spark) or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        # A remote (Connect) session without a configured checkpoint folder: only
        # usable when client and server share a file system, as in local runs.
        require_local(spark)
        base = tempfile.mkdtemp(prefix="mercato-warehouse-", dir=os.environ.get("MERCATO_SCRATCH", "/tmp"))
    app, path = _key(spark, sf_dir)
    tag = hashlib.sha1(f"{app}|{path}".encode()).hexdigest()[:12]
    return os.path.join(base.replace("file:", ""), f"mercato-warehouse-{tag}")


def _stage(spark: SparkSession, sf_dir: str, name: str, build):
    """What a stage wrote for this data folder; it runs when the first query reads it."""
    k = (*_key(spark, sf_dir), name)
    if k not in _CACHE:
        with shuffles_dropped(spark):
            _CACHE[k] = build()
    return _CACHE[k]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transactions table (30 columns) for this data folder."""
    def build():
        root = _root(spark, sf_dir)
        with small_maps_hashed(spark):
            PL.ingest(spark, sales_from_tables(spark, sf_dir), root)
        return spark.read.parquet(os.path.join(root, "raw_transactions"))
    return _stage(spark, sf_dir, "raw", build)


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star, written once from the stored raw table."""
    def build():
        sales(spark, sf_dir)
        return PL.build_warehouse(spark, _root(spark, sf_dir), S.fixture_star_config(), partition_fact=True)
    return _stage(spark, sf_dir, "star", build)


def marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven marts, written once for this data folder."""
    return _stage(spark, sf_dir, "marts", lambda: PL.build_all_marts(spark, star(spark, sf_dir), _root(spark, sf_dir)))


def scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder for a table that a registered query writes itself."""
    return os.path.join(_root(spark, sf_dir), "written", name)


def clear() -> None:
    _CACHE.clear()
