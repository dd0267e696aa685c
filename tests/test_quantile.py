import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators.quantile import exact_quantiles


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_matches_numpy_linear_interpolation(spark, parts):
    rng = np.random.default_rng(7)
    vals = np.round(rng.lognormal(3, 1, 3001), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(parts)
    got = exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.95, 1.0])
    for p, v in got.items():
        assert v == pytest.approx(np.percentile(vals, p * 100), abs=1e-9)


def test_hot_value_holding_a_third_of_rows(spark):
    vals = [5.0] * 1000 + [float(i) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [0.2, 0.5, 0.9])
    for p, v in got.items():
        assert v == pytest.approx(np.percentile(vals, p * 100))


def test_nulls_are_skipped_and_empty_gives_none(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert exact_quantiles(df, "x", [0.5])[0.5] == 2.0
    assert exact_quantiles(df.filter(F.col("x") > 10), "x", [0.5])[0.5] is None


def test_no_task_holds_more_than_a_range_beside_a_hot_value(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 50 > 0, 7.0).otherwise(F.col("id") / 3).alias("x"))
    vals = [r.x for r in df.collect()]
    got = exact_quantiles(df, "x", [0.01, 0.5, 0.995, 0.999])
    for p, v in got.items():
        assert v == pytest.approx(np.percentile(vals, p * 100))
