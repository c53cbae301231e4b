"""Every registered query against its DuckDB oracle (or rows-only) at sf0.001."""

import pytest

from corpuslink.plans.harness import compare, duck
from corpuslink.plans.registry import load_all
from tests.conftest import SF_SMALL

NAMES = sorted(load_all())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_points(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
