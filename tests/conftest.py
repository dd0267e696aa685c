import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mercato.session import build_session
    s = build_session(4, 4, "mercato-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star(spark):
    from mercato.plans import warehouse
    return warehouse.star(spark, SF_SMALL)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="mercato-test-", dir="/tmp")


def raw_frame(spark, rows):
    """Raw transactions from dicts; unspecified columns are NULL."""
    from mercato import schemas as S
    full = [{c: r.get(c) for c in S.RAW_COLUMNS} for r in rows]
    return spark.createDataFrame(full, S.RAW_SCHEMA)
