import os

import duckdb
import pytest

import __spark_entry__ as E
from mercato.sources.tables import TEST_TABLES, table_path

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = table_path(SF, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(repr(v) if isinstance(v, float) else (v.isoformat() if hasattr(v, "isoformat") else
                                                               (None if v is None else str(v))) for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["mart_monthly", "mart_customer", "dq_results", "filtered_monthly",
                                  "region_share", "upsert", "kpi_row"])
def test_oracle_agrees_on_small_data(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = _norm([tuple(r[c] for c in cols) for r in sdf.collect()])
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    want = _norm([tuple(r[dcols.index(c)] for c in cols) for r in res.fetchall()])
    assert got == want
