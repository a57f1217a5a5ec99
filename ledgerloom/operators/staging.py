"""Staging models: rename, soft-delete filter, epoch/JSON/text clean-up (one pass each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import blank_to_null, epoch_date, epoch_ts, live_rows, strict_json
from ledgerloom.operators.topn import top1_per_key

#: Which of a customer's current versions is in force: the latest start, then the largest surrogate id.
VERSION_ORDER = [("valid_from_date", True), ("surrogate_id", True)]


def stg_customers(raw: DataFrame) -> DataFrame:
    """All SCD2 versions of live rows; validity epochs to dates (0/null -> null)."""
    vt = F.col("valid_to")
    return raw.filter(live_rows()).select(
        F.col("id").alias("surrogate_id"),
        "customer_id", "customer_name", "city", "state", "region", "district", "postcode", "street",
        "ship_to_address", "lat", "lon",
        F.col("loyalty_segment").alias("loyalty_segment_id"),
        "units_purchased", "unit",
        F.col("number").alias("customer_number"),
        "tax_id", "tax_code",
        epoch_date("valid_from").alias("valid_from_date"),
        epoch_date("valid_to").alias("valid_to_date"),
        (vt.isNull() | (vt == 0)).alias("is_current"),
        "_fivetran_synced",
    )


def current_versions(raw: DataFrame) -> DataFrame:
    """The raw rows of the customer versions in force, one per customer."""
    current = stg_customers(raw).filter("is_current").select("customer_id", "surrogate_id", "valid_from_date")
    found = top1_per_key(current, ["customer_id"], VERSION_ORDER, payload=["surrogate_id"])
    return raw.join(found.select(F.col("surrogate_id").alias("_id")), F.col("id") == F.col("_id"), "left_semi")


def stg_loyalty_segments(raw: DataFrame) -> DataFrame:
    return raw.filter(live_rows()).select(
        "loyalty_segment_id", "loyalty_segment_description", "unit_threshold", "valid_from", "valid_to")


def stg_sales_orders(raw: DataFrame) -> DataFrame:
    """Epoch -> timestamp/date (0 -> null), JSON text -> VARIANT (null when malformed)."""
    ts = epoch_ts("order_datetime")
    return raw.filter(live_rows()).select(
        F.col("id").alias("order_id"),
        "order_number", "customer_id", "customer_name",
        ts.alias("order_timestamp"),
        ts.cast("date").alias("order_date"),
        strict_json("ordered_products").alias("ordered_products_json"),
        F.col("ordered_products").alias("ordered_products_raw"),
        "number_of_line_items",
        blank_to_null("promo_info").alias("promo_code"),
        strict_json("clicked_items").alias("clicked_items_json"),
        "_fivetran_synced",
    )


def stg_ret_customers(raw: DataFrame) -> DataFrame:
    return raw.filter(live_rows()).select(
        F.col("id").alias("b2b_customer_id"),
        F.col("name").alias("customer_name"),
        "email", "region", "company_name", "customer_start_date", "_fivetran_synced")


def stg_ret_orders(raw: DataFrame) -> DataFrame:
    return raw.filter(live_rows()).select(
        F.col("id").alias("order_id"),
        F.col("order_user_id").alias("b2b_customer_id"),
        "amount", "status",
        blank_to_null("cancel_return_reason").alias("cancel_return_reason"),
        "created_at",
        F.col("created_at").cast("date").alias("order_date"),
        "_fivetran_synced")


def stg_ret_tickets(raw: DataFrame) -> DataFrame:
    return raw.filter(live_rows()).select(
        F.col("id").alias("ticket_id"),
        F.col("ticket_user_id").alias("b2b_customer_id"),
        "issue_type", "status", "created_at",
        F.col("created_at").cast("date").alias("ticket_date"),
        "_fivetran_synced")


def stg_product_catalog(seed: DataFrame) -> DataFrame:
    return seed.filter(F.col("is_active")).select(
        "product_id", "product_name", "category", "subcategory",
        F.col("unit_cost").cast("decimal(12,2)").alias("unit_cost"), "launch_date", "is_active")


def stg_promo_campaigns(seed: DataFrame) -> DataFrame:
    return seed.select("promo_code", "campaign_name", "discount_pct", "campaign_type",
                       "start_date", "end_date", "target_channel", "budget_usd")


def stg_regional_sales_targets(seed: DataFrame) -> DataFrame:
    return seed.select("region", F.expr("try_cast(target_month as date)").alias("target_month"),
                       "revenue_target", "order_target", "notes")
