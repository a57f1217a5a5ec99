"""Filters in metric and semantic queries, measures that do not add up, rank left out, and traces of metric cells."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.lineage import audit_trace, simple_metrics
from ledgerloom.plans.metrics import SIMPLE_METRICS, metric_query
from ledgerloom.plans.predicates import conjuncts
from ledgerloom.plans.project import RetailProject
from ledgerloom.plans.registry import QUERIES
from ledgerloom.plans.semantic import GOVERNED, RAW, semantic_aggregate, semantic_select
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def project(spark):
    return RetailProject(spark, SF0001)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The value segment's rank is computed for those who ask for it ----------------------------------------------------

@pytest.mark.parametrize("name", ["regional_performance", "target_attainment", "metric_aov", "metric_derived", "metric_totals",
                                  "q_top10_ltv", "q_ltv_segment", "q_top_region", "q_customers_by_tier", "semantic_select",
                                  "audit_trace", "dq_orphan_orders", "dq_unique", "dq_relationships"])
def test_no_rank_for_readers_of_other_columns(spark, name):
    assert "pct_rank" not in _plan(QUERIES[name](spark, SF0001))


@pytest.mark.parametrize("name", ["value_segment", "campaign_targets", "dq_accepted_values"])
def test_rank_for_readers_of_the_segment(spark, name):
    assert "pct_rank" in _plan(QUERIES[name](spark, SF0001))


def test_segment_as_group_key_and_filter(project):
    by = {r.customer_value_segment: r.total_customers for r in metric_query(
        project, ["total_customers"], ["customer__value_segment"]).collect()}
    assert set(by) == {"high_value", "mid_value", "low_value"}
    one = metric_query(project, ["total_customers"], where="customer__value_segment = 'mid_value'").first()
    assert one.total_customers == by["mid_value"]


def test_columns_of_a_model_are_the_models_columns(project):
    part = project.model("dim_customers", ["region", "customer_id", "region"])
    assert part.columns == ["region", "customer_id"]
    whole = project["dim_customers"].select("region", "customer_id")
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))


# Filters --------------------------------------------------------------------------------------------------------

TYPES = {"a": T.LongType(), "b": T.StringType(), "two words": T.DateType()}


@pytest.mark.parametrize(("text", "expected"), [
    ("a > 1 and b = 'x' and `two words` is null", [(("a",), False), (("b",), False), (("two words",), True)]),
    ("(a > 1 or b = 'x and y') and not (a = 3)", [(("a", "b"), False), (("a",), False)]),
    ("coalesce(a, 0) = 0", [(("a",), True)]), ("a <=> null", [(("a",), True)]), ("a <=> 3", [(("a",), False)]),
    ("b in ('x', 'y') or a is null", [(("a", "b"), True)]), ("true", [((), True)]), ("A between 1 and 2", [(("a",), False)])])
def test_conjuncts(spark, text, expected):
    assert [(c.names, c.holds_on_nulls) for c in conjuncts(spark, text, TYPES.__getitem__, TYPES)] == expected


def test_unknown_names_raise(spark, project):
    with pytest.raises(AnalysisException):
        conjuncts(spark, "nonsense = 1", TYPES.__getitem__, TYPES)
    with pytest.raises(AnalysisException):
        metric_query(project, ["total_b2c_orders"], where="b2b_customer__region = 'ASIA'")
    # a name has to be known to every model that takes part
    with pytest.raises(AnalysisException):
        metric_query(project, ["total_b2c_orders", "total_customers"], where="has_promo")
    with pytest.raises(AnalysisException):
        semantic_select(project, GOVERNED, ["revenue"], where="turnover > 3")


def test_entity_filter_is_a_semi_join_below_the_aggregate(project):
    got = metric_query(project, ["total_b2c_revenue", "total_b2c_orders"], ["has_promo"],
                       where="customer__region = 'ASIA' and metric_time >= date'1995-01-01'")
    plan = _plan(got)
    assert "LeftSemi" in plan and plan.index("HashAggregate") < plan.index("LeftSemi")
    asia = project["dim_customers"].filter("region = 'ASIA'").select("customer_id")
    rows = project["fct_sales_orders"].filter("order_date >= date'1995-01-01'").join(asia, "customer_id", "left_semi")
    expected = {(r.has_promo, r.s, r.n) for r in rows.groupBy("has_promo").agg(
        F.sum("total_revenue").cast("decimal(38,2)").alias("s"), F.count("*").alias("n")).collect()}
    assert {tuple(r) for r in got.collect()} == expected and len(expected) == 2


def test_filter_that_holds_without_a_match_keeps_such_rows(project):
    unknown = metric_query(project, ["total_b2c_orders"], where="customer__region is null").first().total_b2c_orders
    known = metric_query(project, ["total_b2c_orders"], where="customer__region is not null").first().total_b2c_orders
    total = metric_query(project, ["total_b2c_orders"]).first().total_b2c_orders
    assert unknown > 0 and unknown + known == total


def test_time_grain_in_a_filter(project):
    got = metric_query(project, ["total_b2b_orders"], where="metric_time__month = date'1996-03-01'").first().total_b2b_orders
    assert got == project["fct_b2b_orders"].filter("order_date >= '1996-03-01' and order_date < '1996-04-01'").count() > 0


def test_semantic_filter_reaches_the_scan(spark, project):
    rows = semantic_select(project, RAW, ["city"], where="region = 'ASIA' and number_of_line_items > 2 and order_datetime > 0")
    plan = _plan(rows)
    assert "PushedFilters" in plan and "Inner" in plan and "r_name" in plan
    # the filter on the orders sits below the join to the customers
    assert plan.index("Join") < plan.index("o_orderdate")
    orders = project.raw.sales_orders.filter("number_of_line_items > 2 and order_datetime > 0").select("customer_id")
    assert rows.count() == orders.join(project.raw.customers.filter("region = 'ASIA'"), "customer_id").count()


def test_semantic_filter_equals_filtering_the_rows(project):
    names = ["region", "promoted", "b2c_revenue", "line_items", "order_date"]
    rows = semantic_select(project, GOVERNED, names)
    for where in ("region is null or has_promo", "`loyalty segment` = 'Gold'", "revenue > 1000 and (area = 'ASIA' or promoted)",
                  "`products ordered` >= 2 and date >= date'1996-01-01'"):
        got = semantic_select(project, GOVERNED, names, where=where)
        if "loyalty" in where:
            slow = semantic_select(project, GOVERNED, [*names, "tier"]).filter("loyalty_tier = 'Gold'").drop("loyalty_tier")
        else:
            direct = (where.replace("promoted", "has_promo").replace("area", "region").replace("`products ordered`", "line_items")
                      .replace("revenue", "b2c_revenue").replace("date >=", "order_date >="))
            slow = rows.filter(direct)
        assert sorted(map(str, got.collect())) == sorted(map(str, slow.collect())), where
        grouped = semantic_aggregate(project, GOVERNED, ["region"], {"r": ("sum", "b2c_revenue"), "n": ("count", "b2c_revenue")}, where)
        assert {(r.region, r.r, r.n) for r in grouped.collect()} == {(r.region, r.r, r.n) for r in slow.groupBy("region").agg(
            F.sum("b2c_revenue").cast("decimal(38,2)").alias("r"), F.count("b2c_revenue").alias("n")).collect()}, where


# Measures that do not add up --------------------------------------------------------------------------------------

class Tables:
    """A project of given tables."""

    def __init__(self, spark, **tables):
        self.spark, self.tables = spark, tables

    def __getitem__(self, name):
        return self.tables[name]

    def model(self, name, columns=None):
        return self.tables[name].select(*dict.fromkeys(columns)) if columns is not None else self.tables[name]


def test_distinct_and_average_over_a_hot_key(spark):
    orders = spark.range(9000).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") % 50).cast("long").alias("customer_id"),
        F.lit(dt.date(2020, 1, 1)).alias("order_date"), (F.col("id") % 7).alias("number_of_line_items"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("total_revenue"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("P"), (F.col("id") % 11).cast("string"))).alias("promo_code"),
        (F.col("id") % 5 > 0).alias("has_promo"))
    customers = spark.range(1, 40).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("R"), (F.col("id") % 3).cast("string")).alias("region"),
        F.lit("s").alias("state"), F.lit("c").alias("city"), F.lit("t").alias("loyalty_segment_description"),
        F.lit("v").alias("customer_value_segment"), F.lit(dt.date(2020, 1, 1)).alias("customer_since_date"), F.lit(1).alias("units_purchased"))
    p = Tables(spark, fct_sales_orders=orders, dim_customers=customers)
    names = ["distinct_promo_codes", "distinct_buyers", "avg_items_per_order", "largest_order", "total_b2c_orders"]
    got = metric_query(p, names, ["customer__region"])
    joined = orders.join(customers.select("customer_id", "region"), "customer_id", "left")
    slow = joined.groupBy("region").agg(
        F.count_distinct("promo_code"), F.count_distinct("customer_id"), F.avg("number_of_line_items"),
        F.max("total_revenue").cast("decimal(38,2)"), F.count("order_id"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in slow.collect()}
    # Every join is fed by an aggregate of the orders, so the hot key arrives as a few rows.
    distinct = _plan(metric_query(p, ["distinct_promo_codes"], ["customer__region"]))
    below = distinct[distinct.index("Join"):]
    assert "HashAggregate" in below and below.index("HashAggregate") < below.index("Range")


# Traces -----------------------------------------------------------------------------------------------------------

CELLS = [("total_b2c_revenue", {"customer__region": "AMERICA", "metric_time__month": "1996-03-01"}),
         ("total_b2c_revenue", {"customer__region": None, "has_promo": True}),
         ("b2b_cancellation_rate", {"metric_time__quarter": "1997-04-01"}), ("avg_b2b_order_value", {"status": "completed"}),
         ("total_line_revenue", {"product_category": "PROMO"}), ("total_line_units", {"customer__loyalty_tier": "Gold", "product_category": None}),
         ("revenue_per_customer", {"customer__region": "EUROPE"}), ("total_units_purchased", {"customer__value_segment": "mid_value"})]


@pytest.mark.parametrize(("metric", "keys"), CELLS)
def test_traced_rows_add_up(project, metric, keys):
    rows = audit_trace(project, metric, keys)
    assert rows.columns == ["metric", "source_table", "source_id", "position", "synced_at", "contribution"]
    sums = {r.metric: r.s for r in rows.groupBy("metric").agg(F.sum("contribution").alias("s")).collect()}
    names = [m.name for m in simple_metrics(metric)]
    groups = list(keys)
    columns = [k if k.startswith("metric_time") else k.replace("__", "_") for k in groups]
    found = [r for r in metric_query(project, names, groups).collect()
             if all(r[c] is None if v is None else str(r[c]) == str(v) for c, v in zip(columns, keys.values(), strict=True))]
    assert len(found) == 1 and sums == {n: Decimal(found[0][n]) for n in names}
    if "line" in metric:
        assert rows.filter("position is null").count() == 0
        assert rows.count() == rows.select("source_id", "position").distinct().count()


def test_traced_ids_are_raw_ids(project):
    rows = audit_trace(project, "total_customers", {"customer__region": "ASIA"})
    raw = project.raw.customers.select(F.col("id").cast("string").alias("source_id"), "region", "_fivetran_deleted")
    found = rows.join(raw, "source_id").collect()
    assert len(found) == rows.count() > 0 and all(r.region == "ASIA" and not r._fivetran_deleted for r in found)


def test_every_metric_can_be_traced(project):
    for name in SIMPLE_METRICS:
        assert audit_trace(project, name, {}).columns[0] == "metric"
