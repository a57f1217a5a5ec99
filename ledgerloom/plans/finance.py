"""Finance consumer models (read published marts only)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import config as C


def recent_window_start(as_of: dt.date, months: int = C.RECENT_MONTHS):
    """``dateadd('month', -months, as_of)`` (clamped to month end)."""
    return F.add_months(F.lit(as_of), -months)


def recent_b2b_orders(b2b_orders: DataFrame, as_of: dt.date, months: int = C.RECENT_MONTHS) -> DataFrame:
    return b2b_orders.filter(F.col("order_date") >= recent_window_start(as_of, months))


def b2b_account_health_report(accounts: DataFrame, b2b_orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Lifetime account health plus trailing-6-month activity and a finance risk tier."""
    recent = recent_b2b_orders(b2b_orders, as_of).groupBy("b2b_customer_id").agg(
        F.count(F.lit(1)).alias("n_window"),
        F.sum("amount").alias("sum_window"),
        F.sum(F.when(F.col("is_cancelled_or_returned"), F.col("amount")).otherwise(F.lit(0))).alias("lost_window"))
    j = accounts.join(recent, "b2b_customer_id", "left")
    st = F.col("account_health_status")
    tier = (F.when((st == "at_risk") & (F.col("open_tickets") >= C.AT_RISK_OPEN_TICKETS), F.lit("high_risk"))
             .when(st == "at_risk", F.lit("elevated_risk"))
             .when(st == "needs_attention", F.lit("monitor"))
             .otherwise(F.lit("standard")))
    return j.select(
        "b2b_customer_id", "company_name", "region", "customer_start_date",
        F.col("total_revenue").alias("lifetime_revenue"),
        F.col("total_orders").alias("lifetime_orders"),
        "health_score", "account_health_status", "open_tickets", "return_rate",
        F.coalesce(F.col("n_window"), F.lit(0)).cast("long").alias("orders_last_6m"),
        F.coalesce(F.col("sum_window"), F.lit(0)).cast("decimal(38,2)").alias("revenue_last_6m"),
        F.coalesce(F.col("lost_window"), F.lit(0)).cast("decimal(38,2)").alias("cancelled_last_6m"),
        tier.alias("finance_risk_tier"))


def consolidated_revenue(b2c_orders: DataFrame, b2b_orders: DataFrame) -> DataFrame:
    """UNION ALL of both channels on one 7-column shape; month, quarter and net
    revenue are derived once, after the union.  ``(channel, order_id)`` is the key."""
    b2c = b2c_orders.select(
        "order_date", "order_id", F.col("customer_id").cast("string").alias("account_id"),
        F.col("total_revenue").alias("revenue"), "has_promo", F.lit("B2C").alias("channel"),
        F.lit(False).alias("is_cancelled_or_returned"))
    b2b = b2b_orders.select(
        "order_date", "order_id", F.col("b2b_customer_id").alias("account_id"),
        F.col("amount").alias("revenue"), F.lit(False).alias("has_promo"), F.lit("B2B").alias("channel"),
        "is_cancelled_or_returned")
    u = b2c.unionByName(b2b)
    return u.select(
        "order_date",
        F.trunc("order_date", "month").alias("fiscal_month"),
        F.trunc("order_date", "quarter").alias("fiscal_quarter"),
        "order_id", "account_id", "channel", "revenue", "has_promo", "is_cancelled_or_returned",
        F.when(F.col("is_cancelled_or_returned"), F.lit(0)).otherwise(F.col("revenue")).cast("decimal(18,2)")
        .alias("net_revenue"))
