import datetime as dt
from decimal import Decimal

from conftest import raw_frame
from mercato import schemas as S
from mercato.operators import quality as Q
from mercato.operators.star import build_star


def _base(i, **kw):
    row = dict(transaction_id=f"t{i}", date=dt.date(2023, 1 + i % 12, 1 + i % 27), store_name="Westgate",
               region="West", product_name="p", category="Beverages", customer_segment="Families",
               member_tier="Gold", quantity=1, unit_price_sgd=10.0, unit_price_after_disc=9.0,
               discount_pct=Decimal("0.10"), subtotal_sgd=Decimal("9.0000"), gst_rate=Decimal("0.08"),
               gst_amount_sgd=Decimal("0.720000"), total_sgd=Decimal("9.720000"),
               gross_profit_sgd=Decimal("2.000000"), payment_method="NETS", is_promotion=1,
               promo_type="Weekly Deal")
    row.update(kw)
    return row


def _results(spark, rows, cfg=None):
    st = build_star(raw_frame(spark, rows))
    return {r.check_id: r for r in Q.run_checks(st, cfg).collect()}


def test_clean_rows_pass_row_level_checks(spark):
    res = _results(spark, [_base(i) for i in range(24)])
    for cid in ["K1", "K2", "K3", "K4", "K5", "K6", "K7", "K8", "K9", "K10", "K12", "K13", "K14", "K15",
                "K17", "K18", "K19", "K19b", "K20", "K21", "K22", "K23"]:
        assert res[cid].status == "PASS", (cid, res[cid].detail)
    assert res["K1"].detail == "Found 0 NULL values (0.00%)"


def test_seeded_defects_are_counted(spark):
    rows = [_base(i) for i in range(8)]
    rows[0]["total_sgd"] = None                      # K6 NULL, K12 not counted (NULL)
    rows[1]["quantity"] = 0                          # K13
    rows[2]["discount_pct"] = Decimal("1.50")        # K14
    rows[3]["gst_rate"] = None                       # K15: NULL counts as invalid
    rows[4]["total_sgd"] = Decimal("12.000000")      # K20: off by more than 0.02
    rows[5]["promo_type"] = "No Promotion"           # K21 (LOW)
    rows[6]["unit_price_after_disc"] = float("nan")  # K22: NaN is not a violation
    rows[7]["gross_profit_sgd"] = Decimal("-1")      # K23 (LOW)
    rows.append(dict(_base(8), transaction_id="t0"))  # K9 duplicate id
    res = _results(spark, rows)
    assert res["K6"].violations == 1 and res["K6"].detail == "Found 1 NULL values (11.11%)"
    assert res["K12"].violations == 0
    assert res["K13"].violations == 1
    assert res["K14"].violations == 1
    assert res["K15"].violations == 1
    assert res["K20"].violations == 1
    assert res["K21"].violations == 1 and res["K21"].severity == "LOW" and res["K21"].status == "FAIL"
    assert res["K22"].violations == 0
    assert res["K23"].violations == 1
    assert res["K9"].violations == 1 and res["K9"].detail == "Found 1 duplicate transaction IDs"


def test_duplicate_count_treats_nulls_as_a_value(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "transaction_id int")
    c = [x for x in Q.default_checks() if x.check_id == "K9"][0]
    assert Q.unique_check(df, c).first().violations == 1


def test_orphans_include_null_keys(spark, star):
    from pyspark.sql import functions as F
    fact = star.fact.withColumn("store_key", F.when(F.col("store_key") % 10 == 0, None).otherwise(F.col("store_key")))
    dim = star.dim_store.filter(F.col("store_key") % 7 != 0)
    c = [x for x in Q.default_checks() if x.check_id == "K17"][0]
    expected = fact.filter(F.col("store_key").isNull() | (F.col("store_key") % 7 == 0)).count()
    assert Q.orphan_check(fact, dim, c).first().violations == expected
    st = type(star)(star.dim_date, dim, star.dim_product, star.dim_customer, fact, {})
    res = {r.check_id: r for r in Q.run_checks(st, groups=("orphans",)).collect()}
    assert res["K17"].violations == expected and res["K18"].violations == 0


def test_distribution_checks_and_score(spark):
    rows = [_base(i) for i in range(24)]
    res = _results(spark, rows)
    assert res["K24"].detail == "Found 1 regions: ['West']" and res["K24"].status == "FAIL"
    assert res["K25"].detail == "Found years: [2023]"
    assert res["K16"].detail == "Date range: 2023 to 2023" and res["K16"].status == "PASS"
    assert res["K26"].status == "FAIL" and res["K26"].severity == "LOW"
    st = build_star(raw_frame(spark, rows))
    sc = Q.score(Q.run_checks(st)).first()
    assert sc.total_tests == 27 and sc.passed + sc.failed == 27
    assert abs(sc.quality_score - sc.passed * 100.0 / 27) < 1e-9


def test_grade_bands(spark):
    def grade(passed, total):
        rows = [("PASS",)] * passed + [("FAIL",)] * (total - passed)
        return Q.score(spark.createDataFrame(rows, "status string")).first().grade
    assert grade(4, 4) == Q.GRADE_PERFECT
    assert grade(9, 10) == Q.GRADE_GOOD
    assert grade(3, 4) == Q.GRADE_ACCEPTABLE
    assert grade(1, 4) == Q.GRADE_POOR


def test_percent_text_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 800), (0, 0), (2, 3)], "n long, t long")
    got = [r[0] for r in df.select(Q.percent_text("n", "t")).collect()]
    assert got == ["0.13", "0.00", "66.67"]


def test_custom_parameters_change_names_and_outcomes(spark):
    cfg = S.CheckConfig(valid_gst_rates=(0.08,), min_year=2023, max_year=2023, expected_regions=1, expected_years=1,
                        min_monthly_transactions=1)
    res = _results(spark, [_base(i) for i in range(24)], cfg)
    assert res["K15"].test_name == "GST rate in {0.08}" and res["K15"].status == "PASS"
    assert res["K24"].status == "PASS" and res["K25"].status == "PASS" and res["K26"].status == "PASS"
