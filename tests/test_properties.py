"""Property tests: the custom operators against brute force on small inputs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mercato.operators.keys import dense_keys
from mercato.operators.quantile import exact_quantiles
from mercato.streaming.incremental import latest_per_key

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
       st.sampled_from([0.0, 0.1, 0.5, 0.77, 0.95, 1.0]))
def test_quantile_equals_numpy(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)
    got = exact_quantiles(df, "x", [p])[p]
    assert abs(got - float(np.percentile(values, p * 100))) < 1e-9


@settings(**SETTINGS)
@given(st.sets(st.tuples(st.text(alphabet="abcXYZ", max_size=3), st.integers(0, 3)), min_size=1, max_size=60))
def test_distributed_keys_are_sorted_positions(spark, keys):
    df = spark.createDataFrame(sorted(keys, key=lambda t: (t[1], t[0])), "k string, j int").repartition(4)
    got = dense_keys(df, ["k", "j"], "key")
    want = {t: i + 1 for i, t in enumerate(sorted(keys))}
    assert got.rows == len(keys)
    assert {(r.k, r.j): r.key for r in got.df.collect()} == want


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 20), st.integers(0, 5)), min_size=1, max_size=80))
def test_latest_per_key_is_the_max_row(spark, rows):
    df = spark.createDataFrame(rows, "id string, ts int, v int").repartition(3)
    got = {r.id: (r.ts, r.v) for r in latest_per_key(df, "id", ["ts"]).collect()}
    want = {}
    for i, ts, v in rows:
        want[i] = max(want.get(i, (ts, v)), (ts, v))
    assert got == want


def test_shared_mart_scan_equals_single_marts_with_nulls_and_a_hot_store(spark):
    """Seeded rows with NULL measures, NULL keys and one store holding a
    third of the rows: the grouping-sets path re-aggregates to exactly the
    single-mart results (NULL sums, NULL group keys, maxima, means)."""
    import datetime as dt
    import random
    from decimal import Decimal

    from conftest import raw_frame
    from mercato.operators import marts
    from mercato.operators.star import build_star

    rnd = random.Random(7)

    def maybe(v, p=0.1):
        return None if rnd.random() < p else v

    rows = []
    for i in range(600):
        store = "Hot" if i % 3 == 0 else maybe(rnd.choice(["A", "B", "C", "D"]))
        total = maybe(Decimal(rnd.randint(-500, 50_000)) / Decimal(100))
        rows.append(dict(
            transaction_id=maybe(f"t{i % 450}"), date=maybe(dt.date(2022, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))),
            region=maybe(rnd.choice(["East", "West"])), store_name=store,
            category=maybe(rnd.choice(["Beverages", "Bakery", "Frozen"])), product_name=maybe(rnd.choice("pqrs")),
            customer_segment=maybe(rnd.choice(["Families", "Seniors"])), member_tier=maybe(rnd.choice(["Gold", "Non-Member"])),
            quantity=maybe(rnd.randint(0, 9)), discount_pct=maybe(Decimal(rnd.randint(0, 30)) / Decimal(100)),
            subtotal_sgd=maybe(Decimal(rnd.randint(0, 40_000)) / Decimal(100)),
            gst_rate=maybe(Decimal(rnd.choice([7, 8, 9])) / Decimal(100)),
            gst_amount_sgd=maybe(Decimal(rnd.randint(0, 3_000)) / Decimal(100)), total_sgd=total,
            gross_profit_sgd=maybe(Decimal(rnd.randint(-1_000, 9_000)) / Decimal(100)),
            is_promotion=maybe(rnd.randint(0, 1)), cdc_voucher_used=maybe(rnd.randint(0, 1)),
            is_tourist_purchase=maybe(rnd.randint(0, 1)), is_weekend=maybe(rnd.randint(0, 1)),
            holiday_season_flag=maybe(rnd.randint(0, 1)), period_label=maybe(rnd.choice(["P1", "P2"])),
            gst_period=maybe(rnd.choice(["G7", "G8", "G9"]))))
    star = build_star(raw_frame(spark, rows))
    shared = marts.build_marts(star)
    for name, df in shared.items():
        single = marts.BUILDERS[name](star)
        got = sorted(map(tuple, df.collect()), key=repr)
        want = sorted(map(tuple, single.collect()), key=repr)
        assert got == want, name
        assert len(want) > 1, name
