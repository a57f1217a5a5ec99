"""Registered queries vs their DuckDB oracle on the smallest data set."""

import pytest

from tests.conftest import SF0001

KEYS = ["live_rows", "scd2_current", "order_lines", "order_revenue", "value_segment", "promo_effectiveness",
        "b2b_health", "target_attainment", "consolidated_revenue", "metric_derived", "semantic_select",
        "dq_unique", "source_freshness", "q_favourite_category", "q_top10_ltv"]


@pytest.fixture(scope="module")
def duck():
    from tools.check_oracle import duck as make
    return make(SF0001)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E
    from tools.check_oracle import compare
    r = compare(spark, duck, key, E.queries()[key], E.oracle_sql()[key], SF0001)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["cols_ok"] and r["strict_ok"], r


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from ledgerloom.plans.registry import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns[:3] == ["region", "state", "order_month"]
    assert df.count() >= 0
