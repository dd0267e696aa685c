"""Several headers, gates in the command line and the stream, SQL parameters, key counts, sketches, bounded lists."""
import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, raw_frame
from mercato import schemas as S
from mercato.__main__ import main
from mercato.operators import quality as Q
from mercato.operators import sketch as K
from mercato.operators.star import Star
from mercato.plans import explore as X
from mercato.plans import pipeline as PL
from mercato.plans import sql_views as SV
from mercato.plans import warehouse as W
from mercato.sources import csv_ingest as CI
from mercato.sources import profile as P
from mercato.streaming import incremental as INC


def write(folder, **files):
    for name, text in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(text)


def test_headers_in_another_order_are_read_by_name(spark, tmp_dir):
    write(tmp_dir, a="date,region\n2024-01-01,East\n", b='"region",date,note\nWest,2024-01-02,x\n"No, rth",bad,y\n', c="", d="region,date\nSouth,2024-01-04\n")
    got = CI.read_transactions_folder(spark, tmp_dir).select("date", "region", "note", "_bad_columns").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(dt.date(2024, 1, 1), "East", None, ""), (dt.date(2024, 1, 2), "West", "x", ""),
                                                        (None, "No, rth", "y", "date"), (dt.date(2024, 1, 4), "South", None, "")], key=repr)
    assert CI.headers(spark, tmp_dir).keys() == {("date", "region"), ("region", "date", "note"), ("region", "date")}
    assert "quantity" in CI.missing_in_header(spark, tmp_dir) and "date" not in CI.missing_in_header(spark, tmp_dir)


def test_the_command_line_stops_before_the_marts(spark, tmp_dir, monkeypatch, capsys):
    from mercato import __main__ as M
    monkeypatch.setattr(M, "_spark", lambda args: spark)
    with pytest.raises(PL.QualityGateError):
        main(["all", "--warehouse", tmp_dir, "--tables", SF_SMALL, "--min-score", "101"])
    assert os.path.isdir(os.path.join(tmp_dir, "quality")) and not os.path.exists(os.path.join(tmp_dir, "marts"))
    main(["ingest", "--warehouse", tmp_dir, "--tables", SF_SMALL])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["ingest"]["conformance"]["missing_required"] == []


def test_strict_runs_refuse_other_columns(spark, tmp_dir):
    raw = W.sales(spark, SF_SMALL)
    for odd in (raw.drop("region"), raw.withColumn("quantity", F.col("quantity").cast("string"))):
        with pytest.raises(PL.ConformanceError):
            PL.run_pipeline(spark, odd, tmp_dir, strict=True)
    assert os.listdir(tmp_dir) == []


def sale(i, store="S1", qty=1):
    return dict(transaction_id=i, date=dt.date(2024, 1, 5), store_name=store, region="East", quantity=qty, total_sgd=Decimal("10.8"), subtotal_sgd=Decimal("10"),
                gst_amount_sgd=Decimal("0.8"), gst_rate=Decimal("0.08"), payment_method="NETS", discount_pct=Decimal("0.1"))


def test_ids_and_references_hold_across_micro_batches(spark, tmp_dir):
    fact, quar = os.path.join(tmp_dir, "fact"), os.path.join(tmp_dir, "quar")
    stores = spark.createDataFrame([("S1", "East")], "store_name string, region string")
    put = INC.batch_writer(fact, quar, members={"K17": (stores, ["store_name", "region"])})
    first = raw_frame(spark, [sale("a"), sale("b"), sale("b"), sale("c", "S9"), sale(None)])
    second = raw_frame(spark, [sale("a", qty=5), sale("d"), sale("e", qty=0), sale("e")])
    for rows, epoch in ((first, 0), (second, 1), (second, 1), (first, 0)):            # both replayed, the first one late
        put(rows, epoch)
    assert sorted((r.transaction_id, r.quantity) for r in spark.read.parquet(fact).collect()) == [("a", 1), ("b", 1), ("d", 1), ("e", 1)]
    bad = sorted(((r.transaction_id, r.failed_checks, r.load_batch) for r in spark.read.parquet(quar).collect()), key=repr)
    assert bad == sorted([("b", "K9", 0), ("c", "K17", 0), (None, "K1", 0), ("a", "K9", 1), ("e", "K13", 1)], key=repr)


def test_sql_text_with_parameters_equals_the_filter(spark, star):
    SV.register_views(star)
    for years, regions in (((1997, 1998), ("ASIA",)), ((), ("ASIA", "O'Brien")), ((1997,), ()), ((), ())):
        a = X.filtered_kpis(SV.filtered_sales(spark, years, regions)).first()
        assert a == X.filtered_kpis(X.filtered_sales(star, X.SalesFilter(years, regions))).first()
    assert SV.run_sql(spark, "SELECT :a + 1 AS x", a=2).first().x == 3


def test_key_counts_join_no_fact_row(spark):
    def table(rows, cols):
        return spark.createDataFrame(rows, cols)
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.RAW_SCHEMA.fields if f.name in S.FACT_COLUMNS)
    keys = "date_key int, store_key long, product_key long, customer_key long"
    rows = [dict(transaction_id=i, date_key=d, store_key=s, product_key=p, customer_key=c) for i, d, s, p, c in
            [("a", 20240101, 1, 1, 1), ("a", 20240101, 2, 1, None), ("a", None, 1, 7, 1), (None, 20240102, None, 7, 1), (None, 20240101, 9, 1, 1)]]
    fact = table([{c: r.get(c) for c in [x.split()[0] for x in f"{names}, {keys}".split(", ")]} for r in rows], f"{names}, {keys}")
    star = Star(table([(20240101, 2024, 1)], "date_key int, year int, month int"), table([(1, "A", "E"), (2, "B", "E")], "store_key long, store_name string, region string"),
                table([(1, "P")], "product_key long, product_name string"), table([(1,)], "customer_key long"), fact, {})
    got = {r.check_id: r.violations for r in Q.run_checks(star, checks=[c for c in Q.default_checks() if c.kind == "orphan" or c.check_id == "K9"]).collect()}
    assert got == {"K9": 3, "K17": 2, "K18": 2, "K19": 2, "K19b": 1}
    plan = Q.fact_key_checks(star, Q.default_checks())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Expand")             # the join lies above the counts


def test_lists_in_results_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(Q, "MAX_LISTED", 3)
    monkeypatch.setattr(P, "MAX_REGIONS", 2)
    dim = spark.createDataFrame([("d",), ("b",), (None,), ("a",), ("c",), ("a",)], "region string")
    check = next(c for c in Q.default_checks() if c.check_id == "K24")
    r = Q.distinct_count_check(dim, check, 5).first()
    assert r.status == "PASS" and r.detail == "Found 5 regions: ['a', 'b', 'c', ...]"
    assert P.source_profile(raw_frame(spark, [dict(region=x) for x in ("c", "a", "b", None)])).first().regions == "a,b,..."


def test_merged_sketches_answer_like_one(spark):
    rows = spark.range(20000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 20000).cast("double").alias("v"), (F.col("id") % 5000).cast("string").alias("c"))
    states = K.sketch_states(rows.union(rows.limit(3).select("k", F.lit(None).cast("double"), F.lit(None).cast("string"))), ["k"], "v", "c")
    r = K.estimates(K.merged(states.withColumn("all", F.lit(1)), ["all"]), {"p50": 0.5, "p95": 0.95}).first()
    assert r.n == 20000 and abs(r.p50 / 20000 - 0.5) < K.RANK_ERROR and abs(r.p95 / 20000 - 0.95) < K.RANK_ERROR
    assert abs(r.n_distinct / 5000 - 1) < K.COUNT_ERROR
    nothing = K.estimates(K.sketch_states(rows.filter("k = 1").withColumn("v", F.lit(None).cast("double")), ["k"], "v", "c"), {"p50": 0.5}).first()
    assert nothing.n == 0 and nothing.p50 is None
