"""Business questions asked of the governed marts (the chat app's presets and
the verified queries), each as one DataFrame over whole tables.

Top-k answers sort on a full key (value, then id/name) so the k rows are
deterministic; Spark plans ``orderBy().limit(k)`` as TakeOrderedAndProject
(a per-task top-k, then a merge of k rows per task), never a global sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import config as C
from ledgerloom.functions.expr import average


def _window(p, name: str, as_of: dt.date, months: int, col: str = "order_date") -> DataFrame:
    """Trailing window [as_of - months, as_of) of a fact (prunes month folders when published)."""
    return p.window(name, col, F.add_months(F.lit(as_of), -months), F.lit(as_of))


def revenue_last_month(p, as_of: dt.date) -> DataFrame:
    """Total B2C revenue of the previous calendar month (half-open interval)."""
    start = F.trunc(F.add_months(F.lit(as_of), -1), "month")
    end = F.trunc(F.lit(as_of), "month")
    o = p.window("fct_sales_orders", "order_date", start, end)
    return o.agg(F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("decimal(38,2)").alias("total_revenue"),
                 F.count(F.lit(1)).alias("orders")).select(start.alias("month_start"), "total_revenue", "orders")


def customers_by_tier(p) -> DataFrame:
    return p.model("dim_customers", ["loyalty_segment_description"]).groupBy(F.col("loyalty_segment_description").alias("loyalty_tier")).agg(
        F.count(F.lit(1)).alias("customers"))


def top_region(p, as_of: dt.date, months: int = C.RECENT_MONTHS) -> DataFrame:
    """Region with the most B2C orders in the trailing window (ties: region name)."""
    o = _window(p, "fct_sales_orders", as_of, months).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    c = p.model("dim_customers", ["customer_id", "region"])
    g = o.join(c, "customer_id").groupBy("region").agg(F.sum("n").alias("orders"))
    return g.orderBy(F.desc("orders"), F.asc_nulls_last("region")).limit(1)


def monthly_revenue(p, as_of: dt.date, months: int = 12) -> DataFrame:
    """Time-ordered monthly series (at most ``months`` rows, so the final sort is tiny)."""
    o = _window(p, "fct_sales_orders", as_of, months)
    return o.groupBy(F.trunc("order_date", "month").alias("order_month")).agg(
        F.sum("total_revenue").cast("decimal(38,2)").alias("monthly_revenue"),
        F.count(F.lit(1)).alias("orders")).orderBy("order_month")


def at_risk_accounts(p) -> DataFrame:
    return p["dim_b2b_customers"].filter(F.col("account_health_status") == "at_risk").select(
        "b2b_customer_id", "company_name", "region", "open_tickets", "return_rate", "health_score")


def customer_ltv(p) -> DataFrame:
    """Customers with their orders and lifetime revenue (null without orders)."""
    act = p["fct_sales_orders"].groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("total_revenue").cast("decimal(38,2)").alias("lifetime_revenue"))
    return (p.model("dim_customers", ["customer_id", "customer_name", "region"]).join(act, "customer_id", "left")
            .select("customer_id", "customer_name", "region", "lifetime_revenue", "total_orders"))


def top10_ltv(p, k: int = 10) -> DataFrame:
    return customer_ltv(p).orderBy(F.desc_nulls_last("lifetime_revenue"), F.asc("customer_id")).limit(k)


def revenue_by_category(p) -> DataFrame:
    return p["fct_order_lines"].groupBy("product_category").agg(
        F.sum("line_revenue").cast("decimal(38,2)").alias("revenue"), F.sum("quantity").alias("units"))


def latest_orders(p, k: int = 10) -> DataFrame:
    return (p["fct_sales_orders"].select("order_id", "customer_id", "order_timestamp", "total_revenue")
            .orderBy(F.desc_nulls_last("order_timestamp"), F.desc("order_id")).limit(k))


def latest_synced(p, k: int = 10) -> DataFrame:
    return (p.raw.sales_orders.select("id", "customer_id", "order_datetime", "_fivetran_synced")
            .orderBy(F.desc_nulls_last("_fivetran_synced"), F.desc("id")).limit(k))


def spot_checks(p) -> DataFrame:
    return p["fct_sales_orders"].agg(
        F.count_distinct("customer_id").alias("distinct_customers"), F.count(F.lit(1)).alias("orders"),
        F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"))


def scd2_versions(p) -> DataFrame:
    """Raw customer ids with more than one version (the duplicate inflation)."""
    return (p.raw.customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("versions"))
            .filter(F.col("versions") > 1))


def valid_to_histogram(p) -> DataFrame:
    return p.raw.customers.groupBy("valid_to").agg(F.count(F.lit(1)).alias("versions"))


def _band(c, hi, mid, names):
    return F.when(c >= hi, F.lit(names[0])).when(c >= mid, F.lit(names[1])).otherwise(F.lit(names[2]))


def ltv_segments(p) -> DataFrame:
    ltv = F.coalesce(F.col("lifetime_revenue"), F.lit(0))
    band = _band(ltv, C.LTV_HIGH_MIN, C.LTV_MID_MIN, ("high_value", "mid_value", "low_value"))
    return customer_ltv(p).groupBy(band.alias("ltv_segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum(ltv).cast("decimal(38,2)").alias("lifetime_revenue"))


def price_tiers(p) -> DataFrame:
    """Active products by list price."""
    from ledgerloom.sources.seeds import product_catalog
    tier = _band(F.col("list_price"), C.PRICE_PREMIUM_MIN, C.PRICE_MID_MIN, ("premium", "mid_range", "budget"))
    return (product_catalog(p.spark, p.sf_dir).filter("is_active").groupBy(tier.alias("price_tier"))
            .agg(F.count(F.lit(1)).alias("products")))


def favourite_category(p) -> DataFrame:
    """Per customer the category with the most line revenue (ties: category name ascending).

    Per-(customer, category) sums are pre-aggregated, then the top one per customer
    is a ``min(struct(-revenue, category))`` aggregate — no per-customer sort."""
    lines = p["fct_order_lines"].filter(F.col("product_category").isNotNull())
    per = lines.groupBy("customer_id", "product_category").agg(F.sum("line_revenue").alias("rev"))
    best = per.groupBy("customer_id").agg(F.min(F.struct((-F.col("rev")).alias("neg"), "product_category")).alias("b"))
    return best.select("customer_id", F.col("b.product_category").alias("favourite_category"),
                       (-F.col("b.neg")).cast("decimal(38,2)").alias("category_revenue"))


def order_measures(p) -> DataFrame:
    """Per channel: total, recognised (net) and cancelled/returned revenue, orders, AOV."""
    u = p["consolidated_revenue"]
    g = u.groupBy("channel").agg(
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("net_revenue").cast("decimal(38,2)").alias("recognised_revenue"),
        F.sum(F.col("revenue") - F.col("net_revenue")).cast("decimal(38,2)").alias("returned_revenue"),
        F.count(F.lit(1)).alias("orders"), F.count("revenue").alias("_n"))
    return g.select("channel", "total_revenue", "recognised_revenue", "returned_revenue", "orders",
                    average("total_revenue", "_n").alias("avg_order_value"))


def product_measures(p) -> DataFrame:
    return p["fct_order_lines"].groupBy("product_category").agg(
        F.sum("line_revenue").cast("decimal(38,2)").alias("net_revenue"),
        F.sum("quantity").alias("net_units"),
        F.count_distinct("customer_id").alias("distinct_buyers"))


def cancellation_kpis(p) -> DataFrame:
    """Per B2B region: cancelled orders, cancellation rate, revenue per account.  Orders are aggregated by
    account before the join; an account then is one row, so accounts are counted without a distinct."""
    o = p["fct_b2b_orders"].groupBy("b2b_customer_id").agg(
        F.count_if("is_cancelled_or_returned").alias("_cancelled"), F.count(F.lit(1)).alias("_orders"),
        F.sum("amount").cast("decimal(38,2)").alias("_amount"))
    a = p["dim_b2b_customers"].select("b2b_customer_id", "region")
    g = o.join(a, "b2b_customer_id", "left").groupBy("region").agg(
        F.sum("_cancelled").alias("cancelled_orders"), F.sum("_orders").alias("orders"),
        F.sum("_amount").alias("_rev"), F.count("b2b_customer_id").alias("accounts"))
    return g.select(
        "region", "cancelled_orders", "orders",
        (F.col("cancelled_orders").cast("double") / F.col("orders").cast("double")).alias("cancellation_rate"),
        F.when(F.col("accounts") > 0, F.col("_rev").cast("double") / F.col("accounts").cast("double"))
        .alias("revenue_per_account"))


#: Functions that leave SQL: they call any static Java method.
ESCAPES = {"reflect", "java_method", "try_reflect"}


#: Parts of a parsed text whose statement or table is known only when it runs.
INDIRECT = ("ExecuteImmediate", "PlanWithUnresolvedIdentifier", "ExpressionWithUnresolvedIdentifier")


class ReadOnlyQuery(ValueError):
    """The text is not a query over the models."""


def _children(node):
    """Plans and expressions right below a parsed plan or expression, subqueries and CTEs included."""
    for group in (node.children(), node.innerChildren()):
        for k in range(group.size()):
            yield group.apply(k)


def _parsed(spark, sql_text: str) -> tuple[set[str], set[str]]:
    """Tables that a text reads, and the names of its CTEs, from Spark's own parser; raises unless all of it only reads."""
    from py4j.java_gateway import is_instance_of
    gateway, logical = spark.sparkContext._gateway, "org.apache.spark.sql.catalyst.plans.logical"
    refused = [f"{logical}.Command", f"{logical}.ParsedStatement", f"{logical}.ScriptTransformation",
               f"{logical}.InsertIntoDir", f"{logical}.CompoundBody"]
    tables, ctes, seen = set(), set(), set()
    todo = [spark._jsparkSession.sessionState().sqlParser().parsePlan(sql_text)]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if any(is_instance_of(gateway, node, c) for c in refused) or any(k in kind for k in INDIRECT):
            raise ReadOnlyQuery(f"{kind}: only queries are run")
        if kind == "UnresolvedRelation":
            parts = node.multipartIdentifier()
            if parts.size() != 1:
                raise ReadOnlyQuery(f"{node.tableName()}: only models can be read")
            tables.add(parts.apply(0))
        if kind == "UnresolvedFunction" and node.nameParts().last().lower() in ESCAPES:
            raise ReadOnlyQuery(f"{node.nameParts().last()} may not be called")
        if kind == "UnresolvedWith":
            for k in range(node.cteRelations().size()):
                ctes.add(node.cteRelations().apply(k)._1())
        if is_instance_of(gateway, node, f"{logical}.LogicalPlan"):
            todo += [node.expressions().apply(k) for k in range(node.expressions().size())]
        elif is_instance_of(gateway, node, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            todo.append(node.plan())
        todo += list(_children(node))
    return tables, ctes


def execute_sql(p, sql_text: str, max_rows: int | None = None) -> DataFrame:
    """Run SQL text over the project's models (``SELECT ... FROM fct_sales_orders ...``).

    The text runs in a child session of its own, where the models that it reads are temporary views (lazily: a
    view is a plan, nothing runs), so neither the caller's session nor another project sees them.  Anything but a query over
    models and its own CTEs raises ``ReadOnlyQuery``.  The result is bounded by ``max_rows`` when a caller needs
    rows on the driver (``execute_sql(...).toPandas()``).
    """
    from ledgerloom.plans.project import RetailProject
    from ledgerloom.session import apply_sql_conf
    tables, ctes = _parsed(p.spark, sql_text)
    unknown = {t for t in tables if not hasattr(RetailProject, "_build_" + t.lower())} - ctes
    if unknown:
        raise ReadOnlyQuery(f"{sorted(unknown)}: no such model")
    child = p.in_session(apply_sql_conf(p.spark.newSession()))
    for name in sorted(tables - ctes):
        child[name.lower()].createOrReplaceTempView(name)
    df = child.spark.sql(sql_text)
    return df.limit(max_rows) if max_rows else df
