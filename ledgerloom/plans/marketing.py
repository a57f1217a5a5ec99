"""Marketing consumer models (read published marts only)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import config as C
from ledgerloom.functions.expr import MONEY, average, pct


def loyalty_campaign_targets(customers: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Customer -> campaign segment from value segment, loyalty tier and recency."""
    act = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_revenue").cast("decimal(38,2)").alias("lifetime_revenue"),
        F.max("order_date").alias("last_order_date"))
    j = customers.join(act, "customer_id", "left")
    days = F.date_diff(F.lit(as_of), F.col("last_order_date"))
    seg, tier = F.col("customer_value_segment"), F.col("loyalty_segment_description")
    campaign = (F.when((seg == "high_value") & tier.isin(*C.VIP_TIERS), F.lit("vip_retention"))
                 .when((seg == "high_value") & tier.isin(*C.UPGRADE_TIERS), F.lit("upgrade_candidate"))
                 .when(days > C.WIN_BACK_AFTER_DAYS, F.lit("win_back"))
                 .otherwise(F.lit("standard_nurture")))
    return j.select(
        "customer_id", "customer_name", "region", "city",
        tier.alias("loyalty_tier"), seg.alias("value_segment"), "units_purchased",
        "total_orders", "lifetime_revenue", "last_order_date",
        days.alias("days_since_last_order"), campaign.alias("campaign_segment"))


def regional_performance(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Region x state x month: orders, active customers, revenue, AOV, promo adoption.

    Orders are aggregated by customer and month before the join, so a hot customer is
    reduced before the shuffle; order ids are unique, and after that step a customer has one
    row in a month, so neither count needs a distinct.
    """
    per = orders.groupBy("customer_id", F.trunc("order_date", "month").alias("order_month")).agg(
        F.count("order_id").alias("_orders"), F.sum("total_revenue").cast("decimal(38,2)").alias("_rev"),
        F.count("total_revenue").alias("_n_rev"), F.count_if("has_promo").alias("_promo"),
        F.count(F.lit(1)).alias("_n"))
    j = per.join(customers.select("customer_id", "region", "state"), "customer_id")
    g = j.groupBy("region", "state", "order_month").agg(
        F.sum("_orders").alias("total_orders"), F.count("customer_id").alias("active_customers"),
        F.sum("_rev").cast("decimal(38,2)").alias("monthly_revenue"), F.sum("_n_rev").alias("_n_rev"),
        F.sum("_promo").alias("promo_orders"), F.sum("_n").alias("_n"))
    return g.select(
        "region", "state", "order_month", "total_orders", "active_customers", "monthly_revenue",
        average("monthly_revenue", "_n_rev").alias("avg_order_value"),
        F.col("promo_orders").cast("long").alias("promo_orders"),
        pct("promo_orders", "_n", 1).alias("promo_adoption_pct"))


def regional_target_attainment(performance: DataFrame, targets: DataFrame) -> DataFrame:
    """Region-month actuals (rolled up from state) full-outer-joined to targets."""
    a = (performance.filter(F.col("region").isNotNull())
         .groupBy("region", "order_month")
         .agg(F.sum("total_orders").alias("total_orders"),
              F.sum("monthly_revenue").cast("decimal(38,2)").alias("monthly_revenue")))
    t = targets.select(F.col("region").alias("t_region"), "target_month", "revenue_target", "order_target")
    j = a.join(t, (a.region == t.t_region) & (a.order_month == t.target_month), "full")
    rev, trev = F.col("monthly_revenue"), F.col("revenue_target")
    status = (F.when(trev.isNull(), F.lit("no_target"))
               .when(rev >= trev, F.lit("on_track"))
               .when(rev >= trev * F.lit(C.AT_RISK_ATTAINMENT).cast("decimal(3,2)"), F.lit("at_risk"))
               .otherwise(F.lit("behind")))
    return j.select(
        F.coalesce(F.col("region"), F.col("t_region")).alias("region"),
        F.coalesce(F.col("order_month"), F.col("target_month")).alias("month"),
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("long").alias("actual_orders"),
        F.coalesce(F.col("order_target"), F.lit(0)).cast("long").alias("target_orders"),
        F.coalesce(rev, F.lit(0)).cast("decimal(38,2)").alias("actual_revenue"),
        F.coalesce(trev, F.lit(0)).cast(MONEY).alias("target_revenue"),
        pct(rev, trev, 1, 2, 2).alias("revenue_attainment_pct"),
        pct(F.col("total_orders"), F.col("order_target"), 1).alias("order_attainment_pct"),
        (F.coalesce(rev, F.lit(0)) - F.coalesce(trev, F.lit(0))).cast("decimal(38,2)").alias("revenue_gap"),
        status.alias("performance_status"))
