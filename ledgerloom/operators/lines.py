"""Order line items from the parsed JSON document (M11) and per-order totals.

Each document is read once into typed items (``order_items``), and one element rule
(``fields_of``) feeds both shapes: ``lines_from_items`` (one row per element) and
``totals_from_items``, which folds the rule over the items of each order with
higher-order functions, so order revenue needs no explode, shuffle or join back.

Element semantics follow a lateral flatten: an array yields its elements, an
object yields its member values, scalars and null yield nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def element_type(price_scale: int = 2) -> str:
    p = "decimal(38,0)" if price_scale == 0 else f"decimal(18,{price_scale})"
    return (f"struct<product_id:decimal(38,0),name:string,qty:decimal(38,0),quantity:decimal(38,0),"
            f"price:{p},unit_price:{p}>")


def product_of(e: Column) -> Column:
    """The element's product id; null when absent or beyond BIGINT (the line is then dropped everywhere)."""
    return e["product_id"].try_cast("long")


def fields_of(e: Column) -> dict[str, Column]:
    """Typed fields of one line element: quantity = qty, else quantity, else 1; unit_price = price, else
    unit_price, else 0.  A number that its type cannot hold is null, so one bad line never stops the job."""
    qty = F.coalesce(e["qty"], e["quantity"], F.lit(1)).try_cast("long")
    price = F.coalesce(e["price"], e["unit_price"], F.lit(0)).try_cast("decimal(18,2)")
    return {
        "product_id": product_of(e),
        "product_name": e["name"],
        "quantity": qty,
        "unit_price": price,
        "line_revenue": (qty * price).try_cast("decimal(18,2)"),
    }


def order_items(doc: Column, price_scale: int = 2) -> Column:
    """The document's line elements, each read once into a typed struct (null when the
    element is not an object); positions are those of a lateral flatten."""
    element = element_type(price_scale)
    return F.coalesce(F.try_variant_get(doc, "$", f"array<{element}>"),
                      F.map_values(F.try_variant_get(doc, "$", f"map<string,{element}>")))


def int_order_items(stg_orders: DataFrame, price_scale: int = 2) -> DataFrame:
    """One row per order with its typed line items (parsed and cast exactly once).

    Both the line fact (explode) and the order fact (fold) derive from this, so a
    build that materializes it reads every JSON document once.
    """
    return stg_orders.select(
        "order_id", "order_number", "customer_id", "order_date", "order_timestamp", "number_of_line_items",
        "promo_code",
        (F.col("ordered_products_json").isNull() & F.col("ordered_products_raw").isNotNull())
        .alias("has_unparsed_products"),
        order_items(F.col("ordered_products_json"), price_scale).alias("items"))


def lines_from_items(items: DataFrame) -> DataFrame:
    """posexplode of the typed items; elements without a product id are dropped.

    Spark adds a filter on the size of a column that is exploded and computes the column for it once more, so no column
    is exploded but an expression over it, and each document is parsed once."""
    e = items.select("order_id", "order_date", "customer_id",
                     F.posexplode(F.coalesce("items", F.array())).alias("line_number", "it"))
    f = fields_of(F.col("it"))
    return e.filter(product_of(F.col("it")).isNotNull()).select(
        "order_id", "order_date", "customer_id", "line_number",
        f["product_id"].alias("product_id"), f["product_name"].alias("product_name"),
        f["quantity"].alias("quantity"), f["unit_price"].alias("unit_price"), f["line_revenue"].alias("line_revenue"))


def totals_from_items(items: Column) -> tuple[Column, Column]:
    """(sum of line revenue, number of lines) over typed items; null when no line has
    a product id (as a left join to no lines)."""
    kept = F.filter(items, lambda x: product_of(x).isNotNull())
    revenue = lambda x: F.coalesce(fields_of(x)["line_revenue"], F.lit(0))  # noqa: E731  as a sum skips nulls
    total = F.aggregate(kept, F.lit(0).cast("decimal(38,2)"), lambda acc, x: (acc + revenue(x)).cast("decimal(38,2)"))
    n = F.size(kept)
    has = kept.isNotNull() & (n > 0)
    return F.when(has, total), F.when(has, n.cast("long"))
