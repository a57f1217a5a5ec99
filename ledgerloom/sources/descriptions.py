"""Descriptions of the published tables and their columns, kept in the written Parquet schema."""

TABLE_TEXT = {
    "dim_customers": "One row per retail customer, resolved to the version in force.",
    "dim_b2b_customers": "One row per business account, with order and ticket figures and its health.",
    "fct_sales_orders": "One row per dated retail order; revenue is the sum of its readable lines.",
    "fct_order_lines": "One row per product line of a retail order, with catalog cost and margin.",
    "dim_regional_sales_targets": "One row per region and month with its sales target.",
    "fct_b2b_orders": "One row per business order.",
    "rpt_promo_effectiveness": "One row per promo campaign with the orders placed inside its window.",
    "loyalty_campaign_targets": "One row per customer with the campaign group it belongs to.",
    "regional_performance": "One row per region, state and month of retail orders.",
    "regional_target_attainment": "One row per region and month: actuals against target.",
    "b2b_account_health_report": "One row per business account with its recent activity and risk tier.",
    "consolidated_revenue": "One row per order of either channel.",
}

COLUMN_TEXT = {
    "account_health_status": "healthy, needs_attention or at_risk",
    "account_id": "Customer or account that placed the order, as text",
    "active_customers": "Customers with an order in the month",
    "actual_orders": "Orders of the month",
    "actual_revenue": "Revenue of the month",
    "amount": "Order amount",
    "avg_order_value": "Mean revenue per order, not rounded",
    "b2b_customer_id": "Business account key",
    "billing_tickets": "Tickets about billing",
    "campaign_budget": "Money set aside for the campaign",
    "campaign_end": "Last day of the campaign",
    "campaign_name": "Name of the campaign",
    "campaign_roi_pct": "Revenue over budget, less the budget, in percent; empty without a budget",
    "campaign_segment": "Campaign group of the customer",
    "campaign_start": "First day of the campaign",
    "campaign_type": "Kind of campaign",
    "cancel_return_reason": "Reason given; empty text is null",
    "cancelled_last_6m": "Amount cancelled or returned in the trailing six months",
    "cancelled_orders": "Orders cancelled or returned",
    "cancelled_revenue": "Amount cancelled or returned",
    "channel": "B2C or B2B",
    "city": "City",
    "company_name": "Company of the account",
    "customer_id": "Customer key",
    "customer_name": "Name",
    "customer_number": "Number printed on the customer's papers",
    "customer_since_date": "Start of the version in force",
    "customer_start_date": "First day of the account",
    "customer_value_segment": "high_value, mid_value or low_value by rank of units purchased",
    "days_since_last_order": "Days from the last order to the report date",
    "delivery_tickets": "Tickets about delivery",
    "discount_pct": "Discount in percent",
    "district": "District",
    "finance_risk_tier": "high_risk, elevated_risk, monitor or standard",
    "fiscal_month": "First day of the order's month",
    "fiscal_quarter": "First day of the order's quarter",
    "gross_revenue": "Revenue of the campaign's orders",
    "has_catalog_match": "Whether the product is in the active catalog",
    "has_promo": "Whether the order carries a promo code",
    "has_unparsed_products": "Whether the order's product text could not be read",
    "health_score": "0 to 100; falls with open tickets and a high return rate",
    "is_cancelled_or_returned": "Whether the order was cancelled or returned",
    "last_order_date": "Day of the latest order",
    "lat": "Latitude",
    "lifetime_orders": "All orders of the account",
    "lifetime_revenue": "Revenue of all orders",
    "line_margin": "Line revenue less quantity times unit cost, where the cost is known",
    "line_number": "Place of the line in the order's document, from 0",
    "line_revenue": "Quantity times unit price",
    "lon": "Longitude",
    "loyalty_segment_description": "Loyalty tier",
    "loyalty_segment_id": "Loyalty tier key",
    "loyalty_tier": "Loyalty tier",
    "loyalty_unit_threshold": "Units needed for the tier",
    "month": "First day of the month",
    "monthly_revenue": "Revenue of the month",
    "net_revenue": "Revenue, 0 when cancelled or returned",
    "notes": "Remarks",
    "number_of_line_items": "Lines the source counted",
    "open_tickets": "Tickets not yet resolved",
    "order_attainment_pct": "Orders against target in percent",
    "order_date": "Day of the order",
    "order_id": "Order key",
    "order_month": "First day of the order's month",
    "order_number": "Order number",
    "order_target": "Orders aimed at",
    "order_timestamp": "Time of the order",
    "orders_last_6m": "Orders in the trailing six months",
    "parsed_line_items": "Lines that could be read",
    "performance_status": "on_track, at_risk, behind or no_target",
    "postcode": "Postcode",
    "product_category": "Category in the catalog",
    "product_id": "Product key",
    "product_name": "Product name, from the catalog where it is known",
    "product_subcategory": "Subcategory in the catalog",
    "promo_adoption_pct": "Share of orders with a promo code in percent",
    "promo_code": "Promo code",
    "promo_orders": "Orders with a promo code",
    "quantity": "Units of the line",
    "region": "Region",
    "return_rate": "Share of orders cancelled or returned; empty without orders",
    "revenue": "Order revenue",
    "revenue_attainment_pct": "Revenue against target in percent",
    "revenue_gap": "Revenue less target",
    "revenue_last_6m": "Amount ordered in the trailing six months",
    "revenue_per_dollar_spent": "Revenue per unit of budget",
    "revenue_target": "Revenue aimed at",
    "ship_to_address": "Delivery address",
    "state": "State",
    "status": "Order status",
    "target_channel": "Channel the campaign aims at",
    "target_month": "First day of the target's month",
    "target_orders": "Orders aimed at",
    "target_revenue": "Revenue aimed at",
    "total_items_sold": "Lines of the campaign's orders",
    "total_orders": "Number of orders",
    "total_revenue": "Sum of revenue",
    "total_tickets": "Number of tickets",
    "unique_customers": "Customers with an order in the campaign",
    "unit_cost": "Cost per unit in the catalog",
    "unit_price": "Price per unit",
    "units_purchased": "Units bought so far",
    "value_segment": "high_value, mid_value or low_value",
}
