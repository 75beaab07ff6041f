"""Every registered query against its DuckDB oracle (sf0.001), and the
driver contract of ``__spark_entry__``."""

import pytest

from tierline.plans.registry import all_queries
from tools.oracle_check import check

from conftest import SF_SMALL

NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def report(spark):
    return check(spark, SF_SMALL, names=set(NAMES), verbose=False)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(report, name):
    r = report[name]
    assert "error" not in r, r.get("error")
    if all_queries()[name].oracle:
        assert r["oracle_rows"] == r["spark_rows"], r
        assert r["cols_match"], r
        assert r["hash_match"], r


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "year", "month", "orders", "revenue", "units_sold",
                          "average_unit_price"]
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 45
