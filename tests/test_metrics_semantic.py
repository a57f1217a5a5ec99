import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.metrics import gap_filled, metric_query
from ledgerloom.plans.project import RetailProject
from ledgerloom.plans.semantic import GOVERNED, semantic_select
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def project(spark):
    return RetailProject(spark, SF0001)


def test_year_and_week_grains_match_direct_groupby(project):
    fso = project["fct_sales_orders"]
    for grain in ("year", "week"):
        got = {r[0]: (r[1], r[2]) for r in metric_query(project, ["total_b2c_revenue", "total_b2c_orders"],
                                                         [f"metric_time__{grain}"]).collect()}
        exp = {r[0]: (r[1], r[2]) for r in fso.groupBy(F.date_trunc(grain, "order_date").cast("date"))
               .agg(F.sum("total_revenue").cast("decimal(38,2)"), F.count("order_id")).collect()}
        assert got == exp


def test_where_filter_and_ratio(project):
    got = metric_query(project, ["avg_b2c_order_value", "total_b2c_orders"], ["has_promo"],
                       where="order_date >= date'1998-01-01'").collect()
    fso = project["fct_sales_orders"].filter("order_date >= date'1998-01-01'")
    exp = {r.has_promo: (float(r.s) / r.n, r.n) for r in fso.groupBy("has_promo").agg(
        F.sum("total_revenue").alias("s"), F.count("order_id").alias("n")).collect()}
    assert {r.has_promo: (r.avg_b2c_order_value, r.total_b2c_orders) for r in got} == exp


def test_ratio_with_zero_denominator_is_null(project):
    got = metric_query(project, ["b2b_cancellation_rate"], ["status"]).collect()
    # every status group has revenue > 0 here; a group whose revenue sums to 0 would give null
    assert all(r.b2b_cancellation_rate is None or 0 <= r.b2b_cancellation_rate <= 1 for r in got)
    assert {r.status for r in got} >= {"completed"}


def test_gap_filled_has_every_day(project):
    g = gap_filled(project, "total_b2c_orders", "day", fill=0)
    n = g.count()
    lo, hi = project["fct_sales_orders"].agg(F.min("order_date"), F.max("order_date")).first()
    assert n == (hi - lo).days + 1
    assert g.filter(F.col("total_b2c_orders").isNull()).count() == 0


def test_semantic_select_synonyms_and_missing_path(project):
    rows = semantic_select(project, GOVERNED, ["revenue", "tier"])
    assert rows.columns == ["b2c_revenue", "loyalty_tier"]
    assert rows.count() == project["fct_sales_orders"].count()   # many-to-one: no fan-out
    with pytest.raises(ValueError):
        semantic_select(project, GOVERNED, ["b2c_revenue", "company_name"]).count()


def test_gap_filling_over_the_declared_spine_with_keys(spark, project):
    import datetime as dt

    from ledgerloom.plans.metrics import time_spine
    spine = time_spine(spark, dt.date(1997, 12, 30), dt.date(1998, 1, 3))
    assert [r.date_day.day for r in spine.orderBy("date_day").collect()] == [30, 31, 1, 2]
    full = time_spine(spark)
    assert full.count() == 2922 and full.agg(F.max("date_day")).first()[0] == dt.date(2029, 12, 31)
    g = gap_filled(project, "avg_b2c_order_value", "day", fill=None, group_by=["has_promo"], spine=spine)
    assert g.columns == ["metric_time__day", "has_promo", "avg_b2c_order_value"] and g.count() == 8
    direct = {(r.metric_time__day, r.has_promo): r.avg_b2c_order_value for r in metric_query(
        project, ["avg_b2c_order_value"], ["metric_time__day", "has_promo"]).collect()}
    assert all(r.avg_b2c_order_value == direct.get((r.metric_time__day, r.has_promo)) for r in g.collect())


def test_two_step_aggregates_equal_row_level_ones(project):
    keys = ["customer__region", "customer__loyalty_tier", "has_promo", "metric_time__year"]
    names = ["total_b2c_revenue", "total_b2c_orders", "total_line_items"]
    fast = {tuple(r) for r in metric_query(project, names, keys).collect()}
    slow = {tuple(r) for r in metric_query(project, names, keys, where="true").collect()}
    assert fast == slow and len(fast) > 10


def test_fan_out_is_an_error(project):
    from ledgerloom.plans.semantic import semantic_aggregate
    with pytest.raises(ValueError, match="units_purchased"):
        semantic_aggregate(project, GOVERNED, ["has_promo"], {"u": ("sum", "units_purchased")})
    total = semantic_aggregate(project, GOVERNED, ["region"], {"u": ("sum", "total units")}).agg(F.sum("u")).first()[0]
    assert total == project["dim_customers"].agg(F.sum("units_purchased")).first()[0]


def test_all_synonyms_resolve(project):
    words = [w for ws in GOVERNED.synonyms.values() for w in ws]
    assert len(words) == len(set(words)) == 40
    assert all(GOVERNED.name_of(w) in {**GOVERNED.facts, **GOVERNED.dimensions} for w in words)


def test_raw_view_multiplies_orders_by_versions(project):
    from ledgerloom.plans.semantic import RAW
    n = semantic_select(project, RAW, ["order_datetime", "region"])
    versions = project.raw.customers.groupBy("customer_id").count()
    expected = (project.raw.sales_orders.select("customer_id").join(versions, "customer_id", "left")
                .agg(F.sum(F.coalesce("count", F.lit(1)))).first()[0])
    assert n.count() == expected > project.raw.sales_orders.count()
