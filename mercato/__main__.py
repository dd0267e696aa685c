"""Command line: the batch stages in order, like the source's five scripts.

    python -m mercato ingest  --warehouse DIR (--csv PATH | --tables SF_DIR)
    python -m mercato star    --warehouse DIR [--fixture]
    python -m mercato marts   --warehouse DIR
    python -m mercato quality --warehouse DIR
    python -m mercato analyze --warehouse DIR
    python -m mercato all     --warehouse DIR (--csv PATH | --tables SF_DIR) [--min-score N] [--quarantine] [--strict]

``all`` runs ingest, star, checks and marts in this order, so a score below
``--min-score`` stops before any mart is built; CSV files of a folder may have
different headers.

The warehouse folder holds raw_transactions/, star/, marts/ and quality/;
on a cluster it must be shared storage. ``analyze`` prints the small result
frames (KPIs, trends, shares, lifts, top lists), never transaction rows.
"""

from __future__ import annotations

import argparse
import json
import os

from mercato import schemas as S


def _spark(args):
    from mercato.session import build_session
    if args.master_local:
        return build_session(args.cpus, args.shuffle_partitions, "mercato")
    from pyspark.sql import SparkSession
    from mercato.session import ensure_checkpoint_dir
    spark = SparkSession.builder.appName("mercato").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _raw(spark, args):
    if args.csv:
        from mercato.sources.csv_ingest import read_transactions_folder
        return read_transactions_folder(spark, args.csv)
    if args.tables:
        from mercato.sources.sales import sales_from_tables
        return sales_from_tables(spark, args.tables)
    raise SystemExit("ingest needs --csv PATH or --tables SF_DIR")


def _star_cfg(args) -> S.StarConfig:
    return S.fixture_star_config() if (args.fixture or args.tables) else S.StarConfig()


def cmd_ingest(spark, args) -> dict:
    from mercato.plans import pipeline as PL
    from mercato.sources import csv_ingest as CI
    from mercato.sources import profile as P
    raw = _raw(spark, args)
    missing = CI.missing_in_header(spark, args.csv) if args.csv else None
    issues = [r.asDict() for r in P.preload_issues(raw, missing=missing).collect()]
    info = PL.ingest(spark, raw, args.warehouse)
    stored = spark.read.parquet(info["path"])
    prof = P.source_profile(stored).first().asDict()
    return {"stored_rows": info["rows"], "preload_issues": issues, "conformance": CI.conformance(raw),
            "profile": {k: str(v) for k, v in prof.items()}}


def cmd_star(spark, args) -> dict:
    from mercato.plans import pipeline as PL
    from mercato.sources import profile as P
    star = PL.build_warehouse(spark, args.warehouse, _star_cfg(args))
    counts = {r.table_name: r.rows for r in P.table_counts({n: star.table(n) for n in star.TABLES}).collect()}
    orphans = star.fact.selectExpr("count_if(store_key IS NULL) AS n").first().n
    return {"table_rows": counts, "store_key_orphans": orphans}


def _star(spark, args):
    from mercato.operators.star import Star
    return Star.read(spark, os.path.join(args.warehouse, "star"))


def cmd_marts(spark, args) -> dict:
    from mercato.plans import pipeline as PL
    marts = PL.build_all_marts(spark, _star(spark, args), args.warehouse)
    return {name: df.count() for name, df in marts.items()}


def cmd_quality(spark, args) -> dict:
    from mercato.plans import pipeline as PL
    report = PL.run_quality(_star(spark, args), args.warehouse)
    return {k: report[k] for k in ("quality_score", "total_tests", "passed", "failed", "grade")}


def cmd_analyze(spark, args) -> dict:
    from mercato.operators import marts as MT
    from mercato.plans import insights as I
    star = _star(spark, args)
    mart = {n: spark.read.parquet(os.path.join(args.warehouse, "marts", n)) for n in MT.BUILDERS}
    frames = {
        "kpis": I.kpi_row(star.fact),
        "yoy": I.yoy(mart["monthly_sales"]),
        "peak_month": I.peak_month(mart["monthly_sales"]),
        "regions": I.region_share(mart["regional_sales"]),
        "categories": I.category_top(mart["category_profit"]),
        "discount_corr": I.discount_corr(mart["category_profit"]),
        "tiers": I.tier_basket(mart["customer_ltv"]),
        "voucher_lift": I.voucher_lift(mart["cdc_impact"]),
        "tax_growth": I.tax_growth(mart["gst_analysis"]),
        "hours": I.peak_hours(I.hourly(star.fact.select("hour", "is_weekend", "total_sgd"))),
        "products": I.product_top(mart["product_ranking"]),
        "weekdays": I.weekday_sales(star),
        "payments": I.payment_share(star.fact),
    }
    for name, df in frames.items():
        print(f"== {name}")
        df.show(truncate=False)
    return {"printed": list(frames)}


def cmd_all(spark, args) -> dict:
    """The whole run: the checks come before the marts, so ``--min-score`` stops it there."""
    from mercato.plans import pipeline as PL
    out = PL.run_pipeline(spark, _raw(spark, args), args.warehouse, _star_cfg(args), min_score=args.min_score, quarantine_rows=args.quarantine,
                          strict=args.strict)
    cmd_analyze(spark, args)
    return {k: out[k] for k in ("raw_rows", "quarantined", "marts", "quality_score", "conformance", "timings")}


COMMANDS = {"ingest": cmd_ingest, "star": cmd_star, "marts": cmd_marts, "quality": cmd_quality,
            "analyze": cmd_analyze}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m mercato")
    ap.add_argument("command", choices=[*COMMANDS, "all"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--csv")
    ap.add_argument("--tables", help="folder with the TPC-H-like test tables")
    ap.add_argument("--fixture", action="store_true", help="use the test-table lookups for the star")
    ap.add_argument("--min-score", type=float, help="all: stop before the marts below this quality score")
    ap.add_argument("--quarantine", action="store_true", help="all: keep rows that fail a HIGH check out of the star")
    ap.add_argument("--strict", action="store_true", help="all: stop where required columns are missing or types differ")
    ap.add_argument("--master-local", action="store_true", help="start a local session")
    ap.add_argument("--cpus", default="*")
    ap.add_argument("--shuffle-partitions", type=int, default=8)
    args = ap.parse_args(argv)
    spark = _spark(args)
    out = cmd_all(spark, args) if args.command == "all" else COMMANDS[args.command](spark, args)
    print(json.dumps({args.command: out}, default=str))


if __name__ == "__main__":
    main()
