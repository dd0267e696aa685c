"""Bench: the whole batch pipeline plus the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. The pipeline stages (ingest, star, marts, quality)
are timed after one warm-up run of the whole pipeline, best of
$BENCH_STAGE_RUNS (2) runs per stage; the headline queries then run over the
written warehouse, each after one warm-up, best of $BENCH_QUERY_RUNS (3).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato import schemas as S  # noqa: E402
from mercato.operators import marts as MT  # noqa: E402
from mercato.operators import quality as Q  # noqa: E402
from mercato.plans import explore as X  # noqa: E402
from mercato.plans import insights as I  # noqa: E402
from mercato.plans import pipeline as PL  # noqa: E402
from mercato.plans.oracle_queries import FILTER_REGIONS, FILTER_YEARS  # noqa: E402
from mercato.session import build_session  # noqa: E402
from mercato.sources.sales import sales_from_tables  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


STAGE_RUNS = int(os.environ.get("BENCH_STAGE_RUNS", "2"))
QUERY_RUNS = int(os.environ.get("BENCH_QUERY_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="mercato-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    os.environ.setdefault("MERCATO_SCRATCH", scratch)
    # Partition sizing for a single machine: AQE's advisory size decides how
    # many tasks a rebalanced write or a coalesced shuffle gets (64 MB suits a
    # cluster; at this data size it would leave most cores idle).
    spark = build_session(cpus, max(8, cpus * 2), "mercato-bench",
                          {"spark.sql.adaptive.advisoryPartitionSizeInBytes": os.environ.get("BENCH_ADVISORY", "16m")})

    def stages(root: str) -> tuple[dict, object, dict, dict]:
        tim: dict[str, float] = {}
        t = time.time()
        info = PL.ingest(spark, sales_from_tables(spark, sf_dir, splits=cpus), root)
        tim["ingest"] = time.time() - t
        t = time.time()
        st = PL.build_warehouse(spark, root, S.fixture_star_config())
        tim["star"] = time.time() - t
        t = time.time()
        marts = PL.build_all_marts(spark, st, root)
        tim["marts_build"] = time.time() - t
        t = time.time()
        PL.run_quality(st, root)
        tim["quality_build"] = time.time() - t
        return tim, st, marts, info

    stages(os.path.join(scratch, "warmup"))  # one warm-up run of the whole pipeline
    # Best of STAGE_RUNS timed pipeline runs per stage: timings on one machine
    # swing by up to half between identical runs, the minimum is the stable figure.
    timings, star, mart_tables, info = stages(os.path.join(scratch, "run0"))
    for i in range(1, STAGE_RUNS):
        again = stages(os.path.join(scratch, f"run{i}"))[0]
        timings = {k: min(v, again[k]) for k, v in timings.items()}

    flt = X.SalesFilter(years=FILTER_YEARS, regions=FILTER_REGIONS)
    queries = {f"m_{name}": (lambda fn=fn: fn(star)) for name, fn in MT.BUILDERS.items()}
    queries.update({
        "q1_kpi_row": lambda: I.kpi_row(star.fact),
        "q5_region_share": lambda: I.region_share(mart_tables["regional_sales"]),
        "q17_filtered_sales": lambda: X.filtered_sales(star, flt),
        "q18_filtered_kpis": lambda: X.filtered_kpis(X.filtered_sales(star, flt)),
        "q33_weekday_sales": lambda: I.weekday_sales(star),
        "checks": lambda: Q.run_checks(star),
    })
    per_query = {}
    for name, build in queries.items():
        _run(build())  # warm-up
        best = None
        for _ in range(QUERY_RUNS):
            t = time.time()
            _run(build())
            best = min(best or 1e9, time.time() - t)
        per_query[name] = round(best, 3)

    out = {
        "metric": "pipeline_stages_plus_headline_queries",
        "value": round(sum(timings.values()) + sum(per_query.values()), 3),
        "unit": "sec",
        "queries": {**{k: round(v, 3) for k, v in timings.items()}, **per_query},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": info["rows"],
        "cpus": cpus,
        "timing": f"after one warm-up: best of {STAGE_RUNS} runs per stage, best of {QUERY_RUNS} per query",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
