"""End-to-end batch run: raw -> written raw table -> star -> checks -> marts.

Each stage writes its output and the next stage reads it back, which cuts
lineage (no stage recomputes its inputs) and leaves restartable tables in
the warehouse folder, which must be shared storage on a cluster.
"""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.operators import marts as MT
from mercato.operators import quality as Q
from mercato.operators.star import Star, build_star
from mercato.sources import sinks
from mercato.sources.csv_ingest import conformance
from mercato.streaming import incremental as INC


def ingest(spark: SparkSession, raw: DataFrame, root: str, mode: str = "overwrite") -> dict:
    path = os.path.join(root, "raw_transactions")
    # extra source columns are stored too; the input rows are counted while they are written
    seen = Observation("ingest")
    sinks.write_table(raw.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode=mode)
    added = int(seen.get["rows"])
    if mode != "overwrite":
        return {"path": path, "rows": spark.read.parquet(path).count(), "added": added}
    check = sinks.verify_load(spark, path, added)
    if not check["ok"]:
        raise RuntimeError(f"{path}: {check['stored']} of {check['expected']} rows are stored")
    return {"path": path, "rows": check["stored"], "added": added}


class ConformanceError(RuntimeError):
    """The input lacks required columns or has other types; nothing was written."""


class QualityGateError(RuntimeError):
    """The quality score is below the gate; no mart was built."""


def split_raw(spark: SparkSession, root: str, cfg: S.CheckConfig | None = None) -> int:
    """Writes the raw rows that fail a HIGH row check to quarantine/, the others to valid_transactions/."""
    good, bad = INC.split_valid(spark.read.parquet(os.path.join(root, "raw_transactions")), cfg)
    sinks.write_table(good, os.path.join(root, "valid_transactions"))
    sinks.write_table(bad, os.path.join(root, "quarantine"))
    return spark.read.parquet(os.path.join(root, "quarantine")).count()


def build_warehouse(spark: SparkSession, root: str, cfg: S.StarConfig | None = None,
                    partition_fact: bool = True, source: str = "raw_transactions") -> Star:
    raw = spark.read.parquet(os.path.join(root, source))
    star = build_star(raw, cfg)
    star.write(os.path.join(root, "star"), partition_fact=partition_fact)
    return Star.read(spark, os.path.join(root, "star"))


def build_all_marts(spark: SparkSession, star: Star, root: str, parallel: int = 4) -> dict[str, DataFrame]:
    """Write the seven marts. Each is a small job (one scan, one shuffle of
    partial aggregates); submitting them from ``parallel`` driver threads lets
    the scheduler run them side by side instead of leaving cores idle."""
    def write(item):
        name, df = item
        path = os.path.join(root, "marts", name)
        sinks.write_table(df, path)
        return name, path

    items = list(MT.build_marts(star).items())
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        paths = dict(pool.map(write, items))
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def run_quality(star: Star, root: str, cfg: S.CheckConfig | None = None) -> dict:
    results = Q.run_checks(star, cfg)
    path = os.path.join(root, "quality", "results")
    sinks.write_results_json(results, path)
    stored = star.fact.sparkSession.read.schema(Q.RESULT_SCHEMA).json(path)
    return sinks.write_quality_report(stored, Q.score(stored), os.path.join(root, "quality", "quality_report.json"))


def run_pipeline(spark: SparkSession, raw: DataFrame, root: str, star_cfg: S.StarConfig | None = None,
                 check_cfg: S.CheckConfig | None = None, min_score: float | None = None,
                 quarantine_rows: bool = False, strict: bool = False) -> dict:
    """All stages. The checks run before any mart is built: below ``min_score`` the run stops there
    (``QualityGateError``; the report is written). ``quarantine_rows`` keeps rows that fail a HIGH row
    check out of the star and writes them to quarantine/. By default all rows are loaded and reported on. ``strict`` stops
    before anything is written where required columns are missing or types differ (``ConformanceError``)."""
    timings, t = {}, time.time()
    shape = conformance(raw)
    if strict and (shape["missing_required"] or shape["type_mismatch"]):
        raise ConformanceError(f"missing: {shape['missing_required']}, other types: {shape['type_mismatch']}")
    info = ingest(spark, raw, root)
    timings["ingest"] = time.time() - t
    t = time.time()
    quarantined = split_raw(spark, root, check_cfg) if quarantine_rows else 0
    star = build_warehouse(spark, root, star_cfg, source="valid_transactions" if quarantine_rows else "raw_transactions")
    timings["star"] = time.time() - t
    t = time.time()
    report = run_quality(star, root, check_cfg)
    timings["quality"] = time.time() - t
    if min_score is not None and not (report["quality_score"] or 0.0) >= min_score:
        raise QualityGateError(f"quality score {report['quality_score']} is below {min_score}")
    t = time.time()
    mart_tables = build_all_marts(spark, star, root)
    timings["marts"] = time.time() - t
    return {"raw_rows": info["rows"], "quarantined": quarantined, "marts": sorted(mart_tables), "quality_score": report["quality_score"],
            "conformance": shape, "report": report, "timings": timings}
