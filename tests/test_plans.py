"""Plan shape: broadcasts where sizes allow, one scan for the row checks,
top-k without a full sort, filters at the scans."""

import os

from mercato import schemas as S
from mercato.operators import marts
from mercato.operators import quality as Q
from mercato.operators.star import Star
from mercato.plans import explore as X
from mercato.plans import insights as I
from mercato.plans import pipeline as PL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _warehouse(spark, tmp_dir):
    from mercato.plans import warehouse
    PL.ingest(spark, warehouse.sales(spark, "/root/testdata/sf0.001"), tmp_dir)
    return PL.build_warehouse(spark, tmp_dir, S.fixture_star_config())


def test_mart_plan_broadcasts_dimension_and_aggregates_partially(spark, tmp_dir):
    star = _warehouse(spark, tmp_dir)
    plan = marts.regional_sales(star)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert plan.count("HashAggregate") >= 2  # partial + final


def test_topk_is_take_ordered(spark, star):
    plan = _plan(I.product_top(marts.product_ranking(star)))
    assert "TakeOrderedAndProject" in plan


def test_row_checks_scan_the_fact_once(spark, tmp_dir):
    star = _warehouse(spark, tmp_dir)
    part = Q.fact_row_checks(star, Q.default_checks(), S.CheckConfig())
    plan = part._jdf.queryExecution().sparkPlan().toString()
    fact_scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and os.sep + "fact" in ln]
    assert len(fact_scans) == 1


def test_filters_reach_the_scans(spark, tmp_dir):
    star = Star.read(spark, os.path.join(tmp_dir, "star")) if os.path.exists(os.path.join(tmp_dir, "star")) \
        else _warehouse(spark, tmp_dir)
    df = X.filtered_kpis(X.filtered_sales(star, X.SalesFilter(years=(1997,), regions=("ASIA",))))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "year#" in plan
    assert "EqualTo(region,ASIA)" in plan


def test_shares_and_baselines_use_no_cross_join(spark, star):
    from mercato.sources import profile as P
    from mercato.plans import warehouse
    plans = [I.region_share(marts.regional_sales(star)), I.payment_share(star.fact),
             I.tier_multiplier(marts.customer_ltv(star)), P.source_profile(warehouse.sales(spark, "/root/testdata/sf0.001"))]
    for df in plans:
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
        assert "Subquery" in plan


def test_own_scratch_folder_only_on_a_local_master():
    import pytest
    from mercato.session import require_local

    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    require_local(Session("local[8]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        require_local(Session("yarn"))


def test_a_region_choice_skips_row_groups(spark, tmp_dir):
    """Rows of a month lie by region: with several row groups a file, the scan of two regions reads fewer rows than the fact has."""
    from mercato import schemas as S
    from mercato.operators.star import Star, build_star
    from mercato.plans import explore as X
    from mercato.plans import warehouse as W
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = {k: conf.get(k) for k in ("parquet.block.size", "parquet.page.row.count.limit", "parquet.block.row.count.limit")}
    conf.set("parquet.block.row.count.limit", "20")
    conf.set("parquet.page.row.count.limit", "20")
    try:
        sales = W.sales(spark, "/root/testdata/sf0.001")
        build_star(sales, S.fixture_star_config()).write(tmp_dir, partition_fact=True)
    finally:
        for k, v in old.items():
            conf.unset(k) if v is None else conf.set(k, v)
    star = Star.read(spark, tmp_dir)

    def scanned(df):
        df.collect()
        found = []

        def walk(node):
            name = node.getClass().getSimpleName()
            if name == "AdaptiveSparkPlanExec":
                return walk(node.executedPlan())
            if name.endswith("QueryStageExec"):
                return walk(node.plan())
            if name == "FileSourceScanExec" and "/fact" in node.toString():
                found.append(node.metrics().get("numOutputRows").get().value())
            for i in range(node.children().size()):
                walk(node.children().apply(i))
        walk(df._jdf.queryExecution().executedPlan())
        return sum(found)
    total = star.fact.count()
    flt = X.SalesFilter(regions=("ASIA", "EUROPE"))
    got = X.filtered_sales(star, flt)
    assert total > scanned(X.filtered_sales(star, X.SalesFilter())) - 1 and scanned(got) < 0.8 * total
    plain = Star(star.dim_date, star.dim_store, star.dim_product, star.dim_customer, star.fact, {})
    assert got.count() == X.filtered_sales(plain, flt).count()
