"""Seed (reference) tables.

* ``promo_campaigns`` — a small CSV shipped with the package (the seed file);
* ``product_catalog`` — derived from ``part``, with a few categories unlisted;
* ``regional_sales_targets`` — derived from 1996 actuals of the star tables.
"""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.retail import geography
from ledgerloom.sources.star import read_star

SEED_DIR = os.path.join(os.path.dirname(__file__), "seed_data")

PROMO_SCHEMA = ("promo_code string, campaign_name string, discount_pct int, campaign_type string, "
                "start_date date, end_date date, target_channel string, budget_usd decimal(18,2)")
CATALOG_SCHEMA = ("product_id long, product_name string, category string, subcategory string, "
                  "unit_cost decimal(12,2), launch_date date, is_active boolean")
TARGET_SCHEMA = "region string, target_month string, revenue_target decimal(18,2), order_target long, notes string"

# ---------------------------------------------------------------- fixed values
TARGET_YEAR = 1996
# Extra targets: a month with no sales at all, and a zero target.
EXTRA_TARGETS = [("pre_launch", dt.date(1994, 12, 1), Decimal("1000.00"), 10, "pre-launch month, no sales"),
                 ("zero", dt.date(1997, 1, 1), Decimal("0.00"), 0, "zero target")]


def promo_campaigns(spark, path: str | None = None) -> DataFrame:
    """Campaign seed.  With a shared ``path`` Spark reads the CSV.  Without, the CSV text that ships with the
    package (a handful of lines, which executors cannot open) is handed to Spark's CSV reader."""
    reader = spark.read.schema(PROMO_SCHEMA).option("header", True).option("mode", "FAILFAST")
    if path:
        return reader.csv(path)
    with open(os.path.join(SEED_DIR, "promo_campaigns.csv"), encoding="utf-8") as fh:
        lines = [(line,) for line in fh.read().splitlines()[1:] if line]
    text = spark.createDataFrame(lines, "line string")
    return text.select(F.from_csv("line", PROMO_SCHEMA, {"mode": "FAILFAST"}).alias("c")).select("c.*")


def product_catalog(spark, sf_dir: str) -> DataFrame:
    """Catalog from ``part``: cost = 60 % of list price; every 11th part inactive."""
    p = read_star(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    k = F.col("p_partkey")
    return p.select(
        k.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(k % 97 == 5, F.lit("UNLISTED")).otherwise(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("subcategory"),
        # List prices are a tenth to one and a half of the retail price, so all price tiers occur.
        (F.col("p_retailprice").cast("decimal(12,2)") * F.when(k % 4 == 0, F.lit(Decimal("0.1")))
         .when(k % 4 == 1, F.lit(Decimal("0.5"))).when(k % 4 == 2, F.lit(Decimal("1.5"))).otherwise(F.lit(Decimal("1.0")))).cast("decimal(14,3)").alias("list_price"),
        (F.col("p_retailprice").cast("decimal(12,2)") * F.lit(Decimal("0.6"))).cast("decimal(12,2)").alias("unit_cost"),
        F.date_add(F.lit("1990-01-01").cast("date"), (k % 1000).cast("int")).alias("launch_date"),
        (k % 11 != 0).alias("is_active"),
    )


def regional_sales_targets(spark, sf_dir: str) -> DataFrame:
    """Monthly targets per region for ``TARGET_YEAR``, from that year's actuals.

    Base = the region's yearly line revenue (qty x price) and order count; month m of
    region r gets base x f / 120 with f = 8 + (r + m) % 5 (80 %..120 % of a mean month),
    in integer cents, floored.  Month text is ISO (the seed stores text).
    """
    o = (read_star(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
         .filter((F.col("o_orderdate") >= F.lit(f"{TARGET_YEAR}-01-01").cast("timestamp_ntz"))
                 & (F.col("o_orderdate") < F.lit(f"{TARGET_YEAR + 1}-01-01").cast("timestamp_ntz"))))
    li = read_star(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    # Only the year's orders count, so their lines are picked before they are summed.
    li = li.join(o.select("o_orderkey"), li.l_orderkey == o.o_orderkey, "left_semi")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("long") * F.col("l_extendedprice").cast("decimal(18,2)")).alias("rev"))
    cust = read_star(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = geography(spark, sf_dir)
    region_keys = read_star(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    base = (o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
             .join(cust, o.o_custkey == cust.c_custkey)
             .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
             .groupBy("region")
             .agg((F.coalesce(F.sum("rev"), F.lit(0)) * 100).cast("long").alias("cents"),
                  F.count(F.lit(1)).alias("orders")))
    months = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m")
    grid = region_keys.select("region", "r_regionkey", months)
    f = "(8 + (r_regionkey + m) % 5)"
    t = grid.join(base, "region", "left").select(
        "region",
        F.format_string(f"{TARGET_YEAR}-%02d-01", F.col("m")).alias("target_month"),
        (F.expr(f"(coalesce(cents, 0) * {f}) div 120").cast("decimal(20,0)") * F.lit(Decimal("0.01")))
        .cast("decimal(18,2)").alias("revenue_target"),
        F.expr(f"(coalesce(orders, 0) * {f}) div 120").cast("long").alias("order_target"),
        F.lit(f"derived from {TARGET_YEAR} actuals").alias("notes"),
    )
    first_region = region_keys.filter(F.col("r_regionkey") == 0).select("region")
    extras = [first_region.select("region", F.lit(d.isoformat()).alias("target_month"),
                                  F.lit(rt).cast("decimal(18,2)").alias("revenue_target"),
                                  F.lit(ot).cast("long").alias("order_target"), F.lit(note).alias("notes"))
              for _, d, rt, ot, note in EXTRA_TARGETS]
    for e in extras:
        t = t.unionByName(e)
    return t
