"""Named queries: one per operator group of the model project.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and runs over the whole
input tables (no sampling, no id subsets).  Results that end in a top-k keep
a full tie-breaking order so the k rows are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import config as C
from ledgerloom.plans.project import RetailProject

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# sf_dir -> materialization root, set by ``use_materialized`` (bench / scheduled builds).
_ROOTS: dict[str, str] = {}


def use_materialized(sf_dir: str, root: str | None) -> None:
    """Make queries over ``sf_dir`` read landed raw tables / published marts under ``root``."""
    if root:
        _ROOTS[sf_dir] = root
    else:
        _ROOTS.pop(sf_dir, None)


def project(spark: SparkSession, sf_dir: str, **kw) -> RetailProject:
    kw.setdefault("root", _ROOTS.get(sf_dir))
    return RetailProject(spark, sf_dir, **kw)


# ---------------------------------------------------------------- staging
@register("live_rows")
def q_live_rows(spark, sf_dir):
    """Soft-delete filter on every raw table: total, kept, deleted and null-flag rows."""
    p = project(spark, sf_dir)
    parts = []
    for name in ["customers", "loyalty_segments", "sales_orders", "ret_customers", "ret_orders", "ret_tickets"]:
        d = F.col("_fivetran_deleted")
        parts.append(p.raw.table(name).agg(
            F.lit(name).alias("source"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(d.isNull() | ~d).alias("live_rows"),
            F.count_if(d).alias("deleted_rows"),
            F.count_if(d.isNull()).alias("null_flag_rows")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@register("staged_customers")
def q_staged_customers(spark, sf_dir):
    return project(spark, sf_dir)["stg_customers"].select(
        "surrogate_id", "customer_id", "customer_name", "city", "state", "region", "loyalty_segment_id",
        "units_purchased", "valid_from_date", "valid_to_date", "is_current")


@register("staged_orders")
def q_staged_orders(spark, sf_dir):
    s = project(spark, sf_dir)["stg_sales_orders"]
    return s.select("order_id", "order_number", "customer_id", "order_timestamp", "order_date",
                    "number_of_line_items", "promo_code",
                    F.col("ordered_products_json").isNotNull().alias("products_parsed"))


@register("staged_b2b_customers")
def q_staged_b2b_customers(spark, sf_dir):
    return project(spark, sf_dir)["stg_ret_customers"].select(
        "b2b_customer_id", "customer_name", "email", "region", "company_name", "customer_start_date")


@register("staged_b2b_orders")
def q_staged_b2b_orders(spark, sf_dir):
    return project(spark, sf_dir)["stg_ret_orders"].select(
        "order_id", "b2b_customer_id", "amount", "status", "cancel_return_reason", "created_at", "order_date")


@register("staged_tickets")
def q_staged_tickets(spark, sf_dir):
    return project(spark, sf_dir)["stg_ret_tickets"].select(
        "ticket_id", "b2b_customer_id", "issue_type", "status", "created_at", "ticket_date")


@register("active_products")
def q_active_products(spark, sf_dir):
    return project(spark, sf_dir)["stg_product_catalog"]


@register("regional_targets")
def q_regional_targets(spark, sf_dir):
    return project(spark, sf_dir)["dim_regional_sales_targets"]


# ---------------------------------------------------------------- intermediate / marts
@register("scd2_current")
def q_scd2_current(spark, sf_dir):
    return project(spark, sf_dir)["int_current_customers"]


@register("loyalty_lookup")
def q_loyalty_lookup(spark, sf_dir):
    return project(spark, sf_dir)["int_current_customers"].select(
        "customer_id", "loyalty_segment_id", "loyalty_segment_description", "loyalty_unit_threshold")


@register("order_lines")
def q_order_lines(spark, sf_dir):
    return project(spark, sf_dir)["int_sales_order_lines"]


@register("order_lines_rounded")
def q_order_lines_rounded(spark, sf_dir):
    """Same flatten with an unscaled numeric price cast (whole currency units)."""
    return project(spark, sf_dir, price_scale=0)["int_sales_order_lines"]


@register("order_revenue")
def q_order_revenue(spark, sf_dir):
    return project(spark, sf_dir)["fct_sales_orders"]


@register("line_margin")
def q_line_margin(spark, sf_dir):
    return project(spark, sf_dir)["fct_order_lines"]


@register("value_segment")
def q_value_segment(spark, sf_dir):
    return project(spark, sf_dir)["dim_customers"]


@register("promo_effectiveness")
def q_promo_effectiveness(spark, sf_dir):
    return project(spark, sf_dir)["rpt_promo_effectiveness"]


def promo_misuse_rows(p: RetailProject) -> DataFrame:
    """Orders carrying a code outside that campaign's window (campaigns with counted orders)."""
    r = p["rpt_promo_effectiveness"].filter(F.col("total_orders") > 0).select(
        F.col("promo_code").alias("_code"), "campaign_start", "campaign_end")
    o = p["fct_sales_orders"].filter(F.col("has_promo")).select("order_id", "order_date", "promo_code")
    j = o.join(r, o.promo_code == r._code)
    return j.filter(~F.col("order_date").between(F.col("campaign_start"), F.col("campaign_end"))).select(
        "promo_code", "order_id", "order_date", "campaign_start", "campaign_end")


@register("promo_misuse")
def q_promo_misuse(spark, sf_dir):
    return promo_misuse_rows(project(spark, sf_dir))


@register("b2b_orders")
def q_b2b_orders(spark, sf_dir):
    return project(spark, sf_dir)["fct_b2b_orders"]


@register("b2b_health")
def q_b2b_health(spark, sf_dir):
    return project(spark, sf_dir)["dim_b2b_customers"]


@register("account_risk")
def q_account_risk(spark, sf_dir):
    return project(spark, sf_dir)["b2b_account_health_report"]


@register("recent_b2b_orders")
def q_recent_b2b_orders(spark, sf_dir):
    from ledgerloom.plans.finance import recent_window_start
    return project(spark, sf_dir).window("fct_b2b_orders", "order_date", recent_window_start(C.DEFAULT_AS_OF))


# ---------------------------------------------------------------- consumers
@register("campaign_targets")
def q_campaign_targets(spark, sf_dir):
    return project(spark, sf_dir)["loyalty_campaign_targets"]


@register("regional_performance")
def q_regional_performance(spark, sf_dir):
    return project(spark, sf_dir)["regional_performance"]


@register("target_attainment")
def q_target_attainment(spark, sf_dir):
    return project(spark, sf_dir)["regional_target_attainment"]


@register("consolidated_revenue")
def q_consolidated_revenue(spark, sf_dir):
    return project(spark, sf_dir)["consolidated_revenue"]


@register("time_spine")
def q_time_spine(spark, sf_dir):
    """Daily spine over the order fact's date range."""
    from ledgerloom.plans.metrics import data_time_spine
    return data_time_spine(project(spark, sf_dir)["fct_sales_orders"], "order_date")


# ---------------------------------------------------------------- metric layer
def _metrics(spark, sf_dir, metrics, group_by, where=None):
    from ledgerloom.plans.metrics import metric_query
    return metric_query(project(spark, sf_dir), metrics, group_by, where)


@register("metric_revenue_by_month")
def q_metric_revenue_by_month(spark, sf_dir):
    return _metrics(spark, sf_dir, ["total_b2c_revenue", "total_b2c_orders", "total_line_items"],
                    ["metric_time__month"])


@register("metric_gap_filled")
def q_metric_gap_filled(spark, sf_dir):
    from ledgerloom.plans.metrics import gap_filled
    return gap_filled(project(spark, sf_dir), "total_b2c_revenue", "day", fill=0)


@register("metric_gap_filled_ratio")
def q_metric_gap_filled_ratio(spark, sf_dir):
    """A ratio metric per month and promo flag; months without orders of a kind stay empty."""
    from ledgerloom.plans.metrics import gap_filled
    return gap_filled(project(spark, sf_dir), "avg_b2c_order_value", "month", fill=None, group_by=["has_promo"])


@register("metric_aov")
def q_metric_aov(spark, sf_dir):
    return _metrics(spark, sf_dir, ["avg_b2c_order_value", "total_b2c_orders"], ["customer__region", "has_promo"])


@register("metric_cancellation_rate")
def q_metric_cancellation_rate(spark, sf_dir):
    return _metrics(spark, sf_dir, ["b2b_cancellation_rate", "avg_b2b_order_value", "total_b2b_orders"],
                    ["metric_time__quarter"])


@register("metric_units_per_customer")
def q_metric_units_per_customer(spark, sf_dir):
    return _metrics(spark, sf_dir, ["avg_units_per_customer", "total_customers", "total_units_purchased"],
                    ["customer__loyalty_tier"])


@register("metric_derived")
def q_metric_derived(spark, sf_dir):
    """Metrics of two semantic models joined on the group key (region)."""
    return _metrics(spark, sf_dir, ["revenue_per_customer", "total_b2c_revenue", "total_customers"],
                    ["customer__region"])


@register("metric_totals")
def q_metric_totals(spark, sf_dir):
    """Global (no dimension) metrics across three semantic models."""
    return _metrics(spark, sf_dir, ["total_customers", "total_b2c_orders", "total_b2b_orders",
                                    "avg_b2b_order_value", "b2b_cancellation_rate"], [])


@register("metric_filtered")
def q_metric_filtered(spark, sf_dir):
    """One filter over two semantic models: a dimension of the customers for both of them."""
    return _metrics(spark, sf_dir, ["total_b2c_revenue", "total_b2c_orders", "total_customers"], ["customer__state"],
                    where="customer__region = 'ASIA' and customer__loyalty_tier in ('Gold', 'Silver')")


@register("metric_filtered_mixed")
def q_metric_filtered_mixed(spark, sf_dir):
    """Own names, a time grain, and conjuncts that also hold for orders of unknown customers."""
    return _metrics(spark, sf_dir, ["avg_b2c_order_value", "total_b2c_orders", "distinct_promo_codes"],
                    ["customer__region", "metric_time__year"],
                    where="metric_time__month >= date'1995-06-01' and total_revenue > 0 and "
                          "(customer__region is null or customer__region <> 'ASIA' or has_promo)")


@register("metric_distinct_by_region")
def q_metric_distinct_by_region(spark, sf_dir):
    """Measures that do not add up, over an entity's dimension."""
    return _metrics(spark, sf_dir, ["distinct_buyers", "distinct_promo_codes", "avg_items_per_order", "largest_order",
                                    "total_b2c_orders"], ["customer__region", "has_promo"])


@register("metric_line_products")
def q_metric_line_products(spark, sf_dir):
    """Lines: revenue, units and different products by the buyers' loyalty tier."""
    return _metrics(spark, sf_dir, ["total_line_revenue", "total_line_units", "distinct_line_products"],
                    ["customer__loyalty_tier"], where="product_category = 'PROMO'")


# ---------------------------------------------------------------- semantic views
@register("semantic_select")
def q_semantic_select(spark, sf_dir):
    """Governed view: B2C revenue and orders by region and loyalty tier (synonyms resolve)."""
    from ledgerloom.plans.semantic import GOVERNED, semantic_aggregate
    return semantic_aggregate(project(spark, sf_dir), GOVERNED, ["region", "tier"],
                              {"b2c_revenue": ("sum", "revenue"), "orders": ("count", "b2c_revenue")})


@register("semantic_filtered")
def q_semantic_filtered(spark, sf_dir):
    """Governed view with a filter by synonyms: two on the customers, two on the orders."""
    from ledgerloom.plans.semantic import GOVERNED, semantic_aggregate
    return semantic_aggregate(project(spark, sf_dir), GOVERNED, ["state", "promoted"],
                              {"b2c_revenue": ("sum", "online revenue"), "orders": ("count", "b2c_revenue")},
                              where="area in ('ASIA', 'EUROPE') and `loyalty segment` <> 'Bronze' and "
                                    "`purchase date` >= date'1995-01-01' and revenue > 1000")


@register("semantic_filtered_rows")
def q_semantic_filtered_rows(spark, sf_dir):
    """Governed view, row by row: a filter on a table of which no column is asked for, and one across tables."""
    from ledgerloom.plans.semantic import GOVERNED, semantic_select
    return semantic_select(project(spark, sf_dir), GOVERNED, ["b2b_order_date", "b2b_revenue", "company"],
                           where="risk = 'at_risk' and (returned or b2b_region = 'ASIA') and `wholesale revenue` > 50000")


@register("raw_filtered")
def q_raw_filtered(spark, sf_dir):
    """Raw view with a filter; orders of unknown customers stay where the filter holds for them."""
    from ledgerloom.plans.semantic import RAW, semantic_aggregate
    return semantic_aggregate(project(spark, sf_dir), RAW, ["city"],
                              {"order_rows": ("count", "order_datetime"), "line_items": ("sum", "number_of_line_items")},
                              where="(region is null or region = 'AFRICA') and number_of_line_items >= 3 and promo_info = 'FLASH30'")


@register("semantic_b2b")
def q_semantic_b2b(spark, sf_dir):
    """Governed view: B2B revenue by account health status and order status."""
    from ledgerloom.plans.semantic import GOVERNED, semantic_aggregate
    return semantic_aggregate(project(spark, sf_dir), GOVERNED, ["account_health_status", "b2b_order_status"],
                              {"b2b_revenue": ("sum", "b2b_revenue"), "orders": ("count", "b2b_revenue")})


@register("raw_vs_governed")
def q_raw_vs_governed(spark, sf_dir):
    """What the raw view over-counts: customer rows vs resolved customers, units, orders."""
    from ledgerloom.plans.semantic import GOVERNED, RAW, semantic_select
    p = project(spark, sf_dir)
    raw_c = semantic_select(p, RAW, ["customer_name", "units_purchased"]).agg(
        F.count(F.lit(1)).alias("raw_customer_rows"), F.sum("units_purchased").alias("raw_units"))
    gov_c = semantic_select(p, GOVERNED, ["customer_name", "units_purchased"]).agg(
        F.count(F.lit(1)).alias("governed_customers"), F.sum("units_purchased").alias("governed_units"))
    raw_o = semantic_select(p, RAW, ["number_of_line_items", "promo_info"]).agg(
        F.count(F.lit(1)).alias("raw_orders"))
    gov_o = semantic_select(p, GOVERNED, ["b2c_revenue", "has_promo"]).agg(
        F.count(F.lit(1)).alias("governed_orders"))
    from ledgerloom.operators.combine import combine_on_keys
    return combine_on_keys([raw_c, gov_c, raw_o, gov_o])


@register("raw_orders_by_region")
def q_raw_orders_by_region(spark, sf_dir):
    """Raw view across orders and customers: every customer version repeats its orders."""
    from ledgerloom.plans.semantic import RAW, semantic_aggregate
    return semantic_aggregate(project(spark, sf_dir), RAW, ["region"],
                              {"order_rows": ("count", "order_datetime"), "line_items": ("sum", "number_of_line_items")})


# ---------------------------------------------------------------- data quality
def _dq(kind):
    def run(spark, sf_dir):
        from ledgerloom.operators.quality import run_tests
        return run_tests(project(spark, sf_dir), kind)
    return run


for _kind in ("row_rules", "not_null", "unique", "accepted_values", "between", "relationships"):
    register(f"dq_{_kind}")(_dq(_kind))


@register("dq_failing_values")
def q_dq_failing_values(spark, sf_dir):
    """What fails the value rules and references: each failing value with its number of rows."""
    from ledgerloom.operators.quality import TESTS, failing_values
    return failing_values(project(spark, sf_dir),
                          [t for t in TESTS if t.test in ("accepted_values", "between", "relationships")])


@register("dq_revenue_reconciliation")
def q_dq_revenue_reconciliation(spark, sf_dir):
    from ledgerloom.operators.quality import revenue_reconciliation
    return revenue_reconciliation(project(spark, sf_dir))


@register("dq_singular")
def q_dq_singular(spark, sf_dir):
    from ledgerloom.operators.quality import singular_tests
    return singular_tests(project(spark, sf_dir))


@register("dq_orphan_orders")
def q_dq_orphan_orders(spark, sf_dir):
    from ledgerloom.operators.quality import orders_without_customers
    return orders_without_customers(project(spark, sf_dir))


@register("dq_contract")
def q_dq_contract(spark, sf_dir):
    from ledgerloom.operators.quality import contract_check
    return contract_check(project(spark, sf_dir))


@register("source_freshness")
def q_source_freshness(spark, sf_dir):
    from ledgerloom.operators.quality import source_freshness
    return source_freshness(project(spark, sf_dir))


@register("audit_trace")
def q_audit_trace(spark, sf_dir):
    """Trace one regional-performance cell back to its raw order rows and sync times."""
    from ledgerloom.plans.lineage import regional_trace
    return regional_trace(project(spark, sf_dir), region="AMERICA", month="1996-03-01")


def _trace(metric: str, keys: dict):
    def run(spark, sf_dir):
        from ledgerloom.plans.lineage import audit_trace
        return audit_trace(project(spark, sf_dir), metric, keys)
    return run


# A ratio over two measures of a feed with repeated ids; lines with their place in the order's array; and a derived
# metric over two models, one of them the customer versions in force.
register("trace_cancellation_rate")(_trace("b2b_cancellation_rate", {"metric_time__quarter": "1997-04-01", "status": "returned"}))
register("trace_line_revenue")(_trace("total_line_revenue", {"product_category": "PROMO", "metric_time__month": "1996-05-01"}))
register("trace_revenue_per_customer")(_trace("revenue_per_customer", {"customer__region": "EUROPE"}))


# ---------------------------------------------------------------- business questions
def _question(fn_name, *args):
    def run(spark, sf_dir):
        from ledgerloom.plans import questions
        return getattr(questions, fn_name)(project(spark, sf_dir), *args)
    return run


for _key, _fn, _args in [
    ("q_revenue_last_month", "revenue_last_month", (C.DEFAULT_AS_OF,)),
    ("q_customers_by_tier", "customers_by_tier", ()),
    ("q_top_region", "top_region", (C.DEFAULT_AS_OF,)),
    ("q_monthly_revenue", "monthly_revenue", (C.DEFAULT_AS_OF,)),
    ("q_at_risk_accounts", "at_risk_accounts", ()),
    ("q_top10_ltv", "top10_ltv", ()),
    ("q_revenue_by_category", "revenue_by_category", ()),
    ("q_latest_orders", "latest_orders", ()),
    ("q_latest_synced", "latest_synced", ()),
    ("q_spot_checks", "spot_checks", ()),
    ("q_scd2_versions", "scd2_versions", ()),
    ("q_valid_to_histogram", "valid_to_histogram", ()),
    ("q_ltv_segment", "ltv_segments", ()),
    ("q_price_tier", "price_tiers", ()),
    ("q_favourite_category", "favourite_category", ()),
    ("q_order_measures", "order_measures", ()),
    ("q_product_measures", "product_measures", ()),
    ("q_cancellation_kpis", "cancellation_kpis", ()),
]:
    register(_key)(_question(_fn, *_args))


# The chat app's "question -> SQL -> rows" step: SQL text over the governed models.
SQL_TEXT_EXAMPLE = ("SELECT region, loyalty_segment_description AS loyalty_tier, count(*) AS customers, "
                    "CAST(sum(units_purchased) AS BIGINT) AS units FROM dim_customers "
                    "GROUP BY region, loyalty_segment_description")


@register("sql_text")
def q_sql_text(spark, sf_dir):
    from ledgerloom.plans.questions import execute_sql
    return execute_sql(project(spark, sf_dir), SQL_TEXT_EXAMPLE)
