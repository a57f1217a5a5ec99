"""Intermediate and mart models (SCD2 resolution, facts, B2B health, promo report)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import config as C
from ledgerloom.functions.expr import MONEY, average, div0, pct, round_ratio
from ledgerloom.operators.lines import totals_from_items
from ledgerloom.operators.rank import with_percent_rank
from ledgerloom.operators.staging import VERSION_ORDER
from ledgerloom.operators.topn import top1_per_key

CUSTOMER_COLS = ["customer_id", "customer_name", "city", "state", "region", "district", "postcode", "street",
                 "ship_to_address", "lat", "lon", "loyalty_segment_id", "units_purchased", "customer_number",
                 "valid_from_date"]


def int_current_customers(stg_customers: DataFrame, stg_loyalty: DataFrame) -> DataFrame:
    """Current versions -> one row per customer (latest start date, nulls last; the
    surrogate id breaks ties) -> loyalty tier lookup."""
    current = stg_customers.filter(F.col("is_current"))
    deduped = top1_per_key(current, ["customer_id"],
                           VERSION_ORDER,
                           payload=[c for c in CUSTOMER_COLS if c != "customer_id"] + ["surrogate_id"])
    loyalty = stg_loyalty.select(F.col("loyalty_segment_id").alias("_lsid"), "loyalty_segment_description",
                                 F.col("unit_threshold").alias("loyalty_unit_threshold"))
    j = deduped.join(loyalty, deduped.loyalty_segment_id == loyalty._lsid, "left")
    return j.select(
        "customer_id", "customer_name", "city", "state", "region", "district", "postcode", "street",
        "ship_to_address", "lat", "lon", "loyalty_segment_id", "loyalty_segment_description",
        "loyalty_unit_threshold", "units_purchased", "customer_number",
        F.col("valid_from_date").alias("customer_since_date"))


CUSTOMER_ATTRIBUTES = ["customer_id", "customer_name", "region", "state", "city", "district", "postcode", "ship_to_address",
                       "lat", "lon", "loyalty_segment_id", "loyalty_segment_description", "loyalty_unit_threshold",
                       "units_purchased", "customer_since_date", "customer_number"]


def customer_attributes(current: DataFrame) -> DataFrame:
    """The customer dimension without the value segment, so without the global rank behind it."""
    return current.select(*CUSTOMER_ATTRIBUTES)


def dim_customers(current: DataFrame) -> DataFrame:
    """Value segment from the global percent rank of units purchased (desc, nulls first)."""
    ranked = with_percent_rank(current, "units_purchased", descending=True, nulls_first=True)
    seg = (F.when(F.col("pct_rank") <= C.HIGH_VALUE_MAX_PCT_RANK, F.lit("high_value"))
            .when(F.col("pct_rank") <= C.MID_VALUE_MAX_PCT_RANK, F.lit("mid_value"))
            .otherwise(F.lit("low_value")))
    return ranked.select(*CUSTOMER_ATTRIBUTES, seg.alias("customer_value_segment"))


def fct_sales_orders(order_items: DataFrame) -> DataFrame:
    """Orders with revenue summed over their parsed lines (0 when none); orders
    without a date are dropped.

    The line rule is folded over each order's own typed items (higher-order
    functions), which equals grouping the exploded lines by order and joining
    back, without the explode, the shuffle or the join.
    """
    rev, n = totals_from_items(F.col("items"))
    o = order_items.filter(F.col("order_date").isNotNull())
    return o.select(
        "order_id", "order_number", "customer_id", "order_date", "order_timestamp", "number_of_line_items",
        F.coalesce(rev, F.lit(0)).try_cast(MONEY).alias("total_revenue"),
        n.alias("parsed_line_items"), "promo_code",
        F.col("promo_code").isNotNull().alias("has_promo"),
        "has_unparsed_products")


def fct_order_lines(lines: DataFrame, catalog: DataFrame) -> DataFrame:
    """Lines enriched with the active catalog; margin only where the cost is known."""
    p = catalog.select(F.col("product_id").alias("_pid"), F.col("product_name").alias("_pname"),
                       "category", "subcategory", "unit_cost")
    j = lines.join(p, lines.product_id == p._pid, "left")
    margin = F.when(F.col("unit_cost").isNotNull(),
                    F.col("line_revenue") - F.col("quantity") * F.col("unit_cost"))
    return j.select(
        "order_id", "order_date", "customer_id", "line_number", "product_id",
        F.coalesce(F.col("_pname"), F.col("product_name")).alias("product_name"),
        F.col("category").alias("product_category"),
        F.col("subcategory").alias("product_subcategory"),
        "quantity", "unit_price", "line_revenue",
        F.col("unit_cost").cast("double").alias("unit_cost"),
        margin.cast("double").alias("line_margin"),
        F.col("_pid").isNotNull().alias("has_catalog_match"))


def fct_b2b_orders(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.select(
        "order_id", "b2b_customer_id", "order_date", "amount", "status",
        F.col("status").isin(*C.CANCEL_STATUSES).alias("is_cancelled_or_returned"),
        "cancel_return_reason")


def int_b2b_customer_health(accounts: DataFrame, orders: DataFrame, tickets: DataFrame) -> DataFrame:
    """Accounts left-joined to two independent per-account pre-aggregates (no
    order x ticket fan-out), then the score and status rules."""
    cancelled = F.col("status").isin(*C.CANCEL_STATUSES)
    o = orders.groupBy("b2b_customer_id").agg(
        F.count(F.lit(1)).alias("o_total_orders"),
        F.sum("amount").alias("o_total_revenue"),
        F.sum(F.when(cancelled, F.col("amount")).otherwise(F.lit(0))).alias("o_cancelled_revenue"),
        F.sum(F.when(cancelled, 1).otherwise(0)).alias("o_cancelled_orders"),
        F.max("order_date").alias("o_last_order_date"))
    t = tickets.groupBy("b2b_customer_id").agg(
        F.count(F.lit(1)).alias("t_total"),
        F.sum(F.when(F.col("status") == C.OPEN_TICKET_STATUS, 1).otherwise(0)).alias("t_open"),
        F.sum(F.when(F.col("issue_type") == C.BILLING_ISSUE, 1).otherwise(0)).alias("t_billing"),
        F.sum(F.when(F.col("issue_type") == C.DELIVERY_ISSUE, 1).otherwise(0)).alias("t_delivery"))
    a = accounts.select("b2b_customer_id", "customer_name", "company_name", "region", "customer_start_date")
    j = a.join(o, "b2b_customer_id", "left").join(t, "b2b_customer_id", "left")
    rate = div0("o_cancelled_orders", "o_total_orders")
    open_t = F.coalesce(F.col("t_open"), F.lit(0))
    score = F.greatest(F.lit(0), F.lit(C.HEALTH_BASE) - open_t * C.HEALTH_PER_OPEN_TICKET
                       - F.when(rate > C.HEALTH_RATE_PENALTY_ABOVE, C.HEALTH_RATE_PENALTY).otherwise(0))
    status = (F.when(open_t >= C.AT_RISK_OPEN_TICKETS, F.lit("at_risk"))
               .when(rate > C.AT_RISK_RETURN_RATE, F.lit("at_risk"))
               .when(open_t >= 1, F.lit("needs_attention"))
               .otherwise(F.lit("healthy")))
    return j.select(
        "b2b_customer_id", "customer_name", "company_name", "region", "customer_start_date",
        F.coalesce(F.col("o_total_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.col("o_total_revenue"), F.lit(0)).cast(MONEY).alias("total_revenue"),
        F.coalesce(F.col("o_cancelled_revenue"), F.lit(0)).cast(MONEY).alias("cancelled_revenue"),
        F.coalesce(F.col("o_cancelled_orders"), F.lit(0)).cast("long").alias("cancelled_orders"),
        F.col("o_last_order_date").alias("last_order_date"),
        F.coalesce(F.col("t_total"), F.lit(0)).cast("long").alias("total_tickets"),
        open_t.cast("long").alias("open_tickets"),
        F.coalesce(F.col("t_billing"), F.lit(0)).cast("long").alias("billing_tickets"),
        F.coalesce(F.col("t_delivery"), F.lit(0)).cast("long").alias("delivery_tickets"),
        rate.alias("return_rate"),
        score.cast("int").alias("health_score"),
        status.alias("account_health_status"))


def dim_b2b_customers(health: DataFrame) -> DataFrame:
    return health.select(
        "b2b_customer_id", "customer_name", "company_name", "region", "customer_start_date", "total_orders",
        "total_revenue", "cancelled_revenue", "cancelled_orders", "last_order_date", "total_tickets",
        "open_tickets", "billing_tickets", "delivery_tickets", "return_rate", "health_score",
        "account_health_status")


def dim_regional_sales_targets(stg_targets: DataFrame) -> DataFrame:
    return stg_targets.select("region", "target_month", "revenue_target", "order_target", "notes")


PROMO_ATTRS = ["promo_code", "campaign_name", "campaign_type", "discount_pct", "target_channel",
               "campaign_start", "campaign_end", "campaign_budget"]


def rpt_promo_effectiveness(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign report: every campaign kept; orders count only inside the window.

    The campaigns are the preserved side of the left join, so they cannot be its
    broadcast side.  Instead promo orders are inner-joined to the campaigns on the code,
    with the date range as residual condition (a broadcast join where the planner or
    AQE measures the campaigns as small), and aggregated per code; the campaign rows are
    then left-joined to that per-code result.  ``order_id`` is unique in the order fact, so
    orders are counted, and only the customers need a distinct count.
    """
    c = campaigns.select(
        "promo_code", "campaign_name", "campaign_type", "discount_pct", "target_channel",
        F.col("start_date").alias("campaign_start"), F.col("end_date").alias("campaign_end"),
        F.col("budget_usd").alias("campaign_budget"))
    po = orders.filter(F.col("has_promo")).select("order_id", "order_date", "customer_id", "promo_code",
                                                 "total_revenue", "number_of_line_items")
    span = c.select(F.col("promo_code").alias("_code"), F.col("campaign_start").alias("_cs"),
                    F.col("campaign_end").alias("_ce"))
    in_window = po.join(span, (po.promo_code == span._code) & po.order_date.between(span._cs, span._ce))
    agg = in_window.groupBy("_code", "_cs", "_ce").agg(
        F.count("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("total_revenue").alias("_gross"),
        F.sum("number_of_line_items").alias("_items"),
        F.count("total_revenue").alias("_n_rev"))
    j = c.join(agg, (c.promo_code == agg._code) & c.campaign_start.eqNullSafe(agg._cs)
               & c.campaign_end.eqNullSafe(agg._ce), "left")
    gross = F.coalesce(F.col("_gross"), F.lit(0)).cast("decimal(38,2)")
    budget = F.col("campaign_budget")
    return j.select(
        "promo_code", "campaign_name", "campaign_type", "discount_pct", "target_channel",
        "campaign_start", "campaign_end", "campaign_budget",
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.col("unique_customers"), F.lit(0)).cast("long").alias("unique_customers"),
        gross.alias("gross_revenue"),
        F.coalesce(F.col("_items"), F.lit(0)).cast("long").alias("total_items_sold"),
        F.coalesce(average("_gross", "_n_rev"), F.lit(0.0)).alias("avg_order_value"),
        pct(gross - budget, budget, 1, 2, 2).alias("campaign_roi_pct"),
        round_ratio(gross, budget, 1, 2, 2, 2).alias("revenue_per_dollar_spent"))
