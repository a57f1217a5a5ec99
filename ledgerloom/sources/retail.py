"""Raw, change-synced retail tables, shaped from the star tables.

The models consume six raw tables as a replication connector lands them
(soft-delete flag, sync time, epoch numbers, JSON text, SCD2 versions).  The
test data is a star schema, so this module is the source adapter: each
``raw_*`` function derives one raw table from the star tables with a fixed,
deterministic rule (stated in FIXTURES.md §4 and in README), seeding the
edge cases the models must handle.  In production these functions are
replaced by plain reads of the landed tables; the models do not change.

Everything is a lazy DataFrame; the only shuffle is the per-order grouping
that builds the JSON line-item document of ``sales_orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import config
from ledgerloom.sources.star import read_star

DAY = 86_400
# ---------------------------------------------------------------- fixed values
# Epoch seconds of 1994-01-01T00:00:00Z: first SCD2 validity day of the adapter.
SCD2_BASE_EPOCH = 757_382_400
SCD2_STEP_DAYS = 120
# Promo text landed per order priority (blank text means "no promo").
PROMO_BY_PRIORITY = {
    "1-URGENT": "SPRING10",
    "2-HIGH": " SUMMER20 ",
    "3-MEDIUM": "FLASH30",
    "5-LOW": "  ",
}
BUNDLE_CODE = "BUNDLE"  # priority 4-NOT SPECIFIED, every fourth order key
LOYALTY_TIERS = [(1, "Bronze", 0), (2, "Silver", 100), (3, "Gold", 500), (4, "Platinum", 1000)]


def _sync_epoch() -> int:
    import calendar
    return calendar.timegm(config.SYNC_TS.timetuple())


def synced(lag_minutes: int, key: Column, spread: int) -> Column:
    """``_fivetran_synced``: sync time minus a per-source lag and a per-row spread."""
    return F.timestamp_seconds(F.lit(_sync_epoch() - lag_minutes * 60) - (key % spread) * 60).cast("timestamp_ntz")


def _ret_account_id(key: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(key.cast("string"), 5, "0"))


def geography(spark, sf_dir: str) -> DataFrame:
    """nation -> (nation key, state name, region name)."""
    nation = read_star(spark, sf_dir, "nation")
    region = read_star(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("region")))


# ---------------------------------------------------------------- B2C

def raw_customers(spark, sf_dir: str) -> DataFrame:
    """SCD2 customer versions: 1 + key % 3 versions per customer; key % 10 = 0 gets an
    extra open version (same start date as the latest when key % 20 = 0)."""
    geo = geography(spark, sf_dir)
    c = read_star(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    k = F.col("c_custkey")
    df = (c.withColumn("n", (F.lit(1) + k % 3).cast("int"))
           .withColumn("v", F.explode(F.sequence(F.lit(0), F.col("n") - 1 + F.when(k % 10 == 0, 1).otherwise(0)))))
    v, n = F.col("v"), F.col("n")
    extra = v == n
    latest = v == n - 1
    step = SCD2_STEP_DAYS * DAY
    base = F.lit(SCD2_BASE_EPOCH).cast("long") + (k % 200) * DAY
    valid_from = (F.when(extra, F.when(k % 20 == 0, base + (n - 1) * step).otherwise(base + (n - 1) * step - 30 * DAY))
                  .when(latest & (k % 13 == 0), F.lit(0))
                  .when(latest & (k % 17 == 0), F.lit(None))
                  .otherwise(base + v * step)).cast("long")
    valid_to = (F.when(extra, F.lit(0))
                .when(latest, F.when(k % 7 == 0, F.lit(None)).otherwise(F.lit(0)))
                .otherwise(base + (v + 1) * step)).cast("long")
    deleted = (F.when((v == 0) & (n > 1) & (k % 37 == 0), F.lit(True))
               .when(latest & (k % 97 == 0), F.lit(True))
               .when((k + v) % 2 == 0, F.lit(None))
               .otherwise(F.lit(False))).cast("boolean")
    city = F.concat(F.lit("City "), ((k + F.when(extra, 1).otherwise(0)) % 23).cast("string"))
    street = F.concat(k.cast("string"), F.lit(" Main St"))
    df = df.join(geo, df.c_nationkey == geo.n_nationkey, "left")
    return df.select(
        (k * 4 + v).alias("id"),
        k.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        city.alias("city"),
        F.col("state"),
        F.col("region"),
        F.concat(F.lit("District "), (k % 7).cast("string")).alias("district"),
        F.lpad((k % 99991).cast("string"), 5, "0").alias("postcode"),
        street.alias("street"),
        F.concat(street, F.lit(", "), city).alias("ship_to_address"),
        ((k % 180) - 90 + 0.5).cast("double").alias("lat"),
        ((k % 360) - 180 + 0.25).cast("double").alias("lon"),
        (k % 5).alias("loyalty_segment"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(F.floor(F.col("c_acctbal") / 100).cast("long") + v)
         .cast("long").alias("units_purchased"),
        F.lit(None).cast("string").alias("unit"),
        F.concat(F.lit("CN"), k.cast("string")).alias("number"),
        F.lit(None).cast("string").alias("tax_id"),
        F.lit(None).cast("string").alias("tax_code"),
        valid_from.alias("valid_from"),
        valid_to.alias("valid_to"),
        deleted.alias("_fivetran_deleted"),
        synced(0, k * 4 + v, 500).alias("_fivetran_synced"),
    )


def raw_loyalty_segments(spark) -> DataFrame:
    """Four-row tier lookup (the connector lands it from the operational database)."""
    import datetime as dt
    synced_at = config.SYNC_TS - dt.timedelta(minutes=30)
    rows = [(i, d, t, dt.date(1990, 1, 1), None, False, synced_at) for i, d, t in LOYALTY_TIERS]
    return spark.createDataFrame(
        rows, "loyalty_segment_id long, loyalty_segment_description string, unit_threshold long, "
              "valid_from date, valid_to date, _fivetran_deleted boolean, _fivetran_synced timestamp_ntz")


def _json_pair(key: str, value: Column) -> Column:
    """``"key":value`` text, or null when ``value`` is null (the key is then left out)."""
    return F.concat(F.lit(f'"{key}":'), value)


def _line_element() -> Column:
    """One JSON line object per lineitem row, with the key variants of the source.

    The object text is assembled with string functions (codegen'd, per row);
    leading struct fields give each order's array a total order.
    """
    ok = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    q = F.col("l_quantity").cast("long")
    # A feed fault: the prices of some orders come with a minus sign.
    p = (F.col("l_extendedprice") * F.when(ok % 211 == 7, -1).otherwise(1)).cast("decimal(18,2)")
    has_pid = (ok + ln) % 41 != 0
    has_qty = ~((ok % 7 == 3) & (ln == 1))
    has_price = ~((ok % 11 == 5) & (ln == 2))
    odd = ok % 2 == 1
    alt_price = ok % 5 == 0
    pk = F.col("l_partkey").cast("string")
    text = F.concat(F.lit("{"), F.concat_ws(
        ",",
        F.when(has_pid, _json_pair("product_id", pk)),
        _json_pair("name", F.concat(F.lit('"Item '), pk, F.lit('"'))),
        F.when(has_qty & ~odd, _json_pair("qty", q.cast("string"))),
        F.when(has_qty & odd, _json_pair("quantity", q.cast("string"))),
        F.when(has_price & ~alt_price, _json_pair("price", p.cast("string"))),
        F.when(has_price & alt_price, _json_pair("unit_price", p.cast("string"))),
    ), F.lit("}"))
    return F.struct(ln.alias("s_ln"), F.col("l_partkey").alias("s_pk"), q.alias("s_q"), p.alias("s_p"),
                    text.alias("doc"))


def _feed_faults(k: Column, docs: Column) -> Column:
    """The product text of an order: broken, repeated or followed by other text for some orders (none of these is one
    JSON value), a scalar or JSON's null for others, and white space around it for some."""
    rest = k % 97
    return (F.when(rest == 0, F.lit("{bad"))
            .when(rest == 1, F.concat(docs, F.lit(" "), docs))
            .when(rest == 2, F.concat(docs, docs))
            .when(rest == 3, F.lit('{"a":1} x {"b":2}'))
            .when(rest == 4, F.concat(docs, F.lit("],["), docs))
            .when(rest == 5, F.lit("7"))
            .when(rest == 6, F.lit("null"))
            .when(rest == 7, F.concat(F.lit("\n\t"), docs, F.lit(" ")))
            .otherwise(docs))


def raw_sales_orders(spark, sf_dir: str) -> DataFrame:
    """One row per order with its line items as JSON text (``ordered_products``)."""
    li = read_star(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    lines = (li.groupBy("l_orderkey")
               .agg(F.sort_array(F.collect_list(_line_element())).alias("elems"),
                    F.count(F.lit(1)).alias("n_lines")))
    o = read_star(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # Lines are grouped texts, of which Spark knows only the size of their columns in the file, several times too small;
    # broadcast by that estimate they would fill the driver, and few tasks would build all documents.
    df = o.join(lines.hint("merge"), o.o_orderkey == lines.l_orderkey, "left")
    k = F.col("o_orderkey")
    docs = F.concat(F.lit("["), F.array_join(F.transform(F.col("elems"), lambda e: e["doc"]), ","), F.lit("]"))
    products = _feed_faults(k, F.coalesce(docs, F.lit("[]")))
    clicked = F.coalesce(F.concat(F.lit("["), F.array_join(F.transform(F.col("elems"), lambda e: e["s_pk"]), ","),
                                  F.lit("]")), F.lit("[]"))
    prio = F.col("o_orderpriority")
    promo = (F.when(prio == "1-URGENT", F.lit(PROMO_BY_PRIORITY["1-URGENT"]))
             .when(prio == "2-HIGH", F.lit(PROMO_BY_PRIORITY["2-HIGH"]))
             .when(prio == "3-MEDIUM", F.lit(PROMO_BY_PRIORITY["3-MEDIUM"]))
             .when((prio == "4-NOT SPECIFIED") & (k % 4 == 0), F.lit(BUNDLE_CODE))
             .when(prio == "5-LOW", F.lit(PROMO_BY_PRIORITY["5-LOW"])))
    epoch = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return df.select(
        k.alias("id"),
        (k + 1_000_000).alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("customer_name"),
        F.when(k % 89 == 0, F.lit(0).cast("long")).otherwise(epoch).alias("order_datetime"),
        products.alias("ordered_products"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("number_of_line_items"),
        clicked.alias("clicked_items"),
        promo.alias("promo_info"),
        F.when(k % 53 == 0, F.lit(True)).when(k % 3 == 0, F.lit(None)).otherwise(F.lit(False))
         .cast("boolean").alias("_fivetran_deleted"),
        synced(0, k, 720).alias("_fivetran_synced"),
    )


# ---------------------------------------------------------------- B2B

def raw_ret_customers(spark, sf_dir: str) -> DataFrame:
    geo = geography(spark, sf_dir)
    s = read_star(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    df = s.join(geo, s.s_nationkey == geo.n_nationkey, "left")
    return df.select(
        _ret_account_id(k).alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("acct"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("region"),
        F.concat(F.lit("Company "), k.cast("string")).alias("company_name"),
        F.date_add(F.lit("1994-01-01").cast("date"), (k % 365).cast("int")).alias("customer_start_date"),
        F.when(k % 41 == 40, F.lit(True)).when(k % 2 == 0, F.lit(None)).otherwise(F.lit(False))
         .cast("boolean").alias("_fivetran_deleted"),
        synced(60, k, 120).alias("_fivetran_synced"),
    )


def raw_ret_orders(spark, sf_dir: str) -> DataFrame:
    """B2B orders: one per lineitem row, booked to the supplier's account — except that
    suppliers with key % 25 = 7 book to the next account, so those accounts have no
    orders.  The id is ``l_orderkey * 16 + l_linenumber``; the star data repeats such
    pairs, so the uniqueness rule on it reports duplicates, as a real feed with a
    broken key would."""
    li = read_star(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
    ln, sk = F.col("l_linenumber"), F.col("l_suppkey")
    account = F.when(sk % 25 == 7, sk + 1).otherwise(sk)
    status = (F.when((F.col("l_returnflag") == "R") & (ln <= sk % 8), F.lit("returned"))
              .when((F.col("l_returnflag") == "A") & (ln <= sk % 4), F.lit("cancelled"))
              .otherwise(F.lit("completed")))
    pk = F.col("l_partkey")
    reason = F.when(status.isin("cancelled", "returned"),
                    F.when(pk % 3 == 0, F.lit(" damaged ")).when(pk % 3 == 1, F.lit("")).otherwise(F.lit("late delivery")))
    rid = F.col("l_orderkey") + ln
    return li.select(
        (F.col("l_orderkey") * 16 + ln).alias("id"),
        _ret_account_id(account).alias("order_user_id"),
        (F.col("l_extendedprice") * F.when(rid % 223 == 5, -1).otherwise(1)).cast("decimal(18,2)").alias("amount"),
        status.alias("status"),
        reason.alias("cancel_return_reason"),
        F.col("l_shipdate").alias("created_at"),
        F.when(rid % 59 == 0, F.lit(True)).when(F.col("l_orderkey") % 4 == 0, F.lit(None)).otherwise(F.lit(False))
         .cast("boolean").alias("_fivetran_deleted"),
        synced(8 * 60, rid, 600).alias("_fivetran_synced"),
    )


def raw_ret_tickets(spark, sf_dir: str) -> DataFrame:
    ev = read_star(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("id"),
        _ret_account_id(F.col("user_id")).alias("ticket_user_id"),
        F.when(et == "error", F.lit("billing")).when(et == "view", F.lit("delivery")).otherwise(F.lit("general"))
         .alias("issue_type"),
        F.when(k < F.col("user_id") % 5, F.lit("open")).otherwise(F.lit("resolved")).alias("status"),
        F.col("ts").alias("created_at"),
        (F.col("event_id") % 71 == 0).alias("_fivetran_deleted"),
        synced(14 * 60, F.col("event_id"), 300).alias("_fivetran_synced"),
    )


class RawSources:
    """The six raw tables of one data directory, built lazily."""

    def __init__(self, spark, sf_dir: str, landed=None):
        self.spark, self.sf_dir = spark, sf_dir
        self._landed = landed  # None, or the reader of landed tables by name
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = self._landed(name) if self._landed else fn()
        return self._cache[name]

    @property
    def customers(self):
        return self._get("customers", lambda: raw_customers(self.spark, self.sf_dir))

    @property
    def loyalty_segments(self):
        return self._get("loyalty_segments", lambda: raw_loyalty_segments(self.spark))

    @property
    def sales_orders(self):
        return self._get("sales_orders", lambda: raw_sales_orders(self.spark, self.sf_dir))

    @property
    def ret_customers(self):
        return self._get("ret_customers", lambda: raw_ret_customers(self.spark, self.sf_dir))

    @property
    def ret_orders(self):
        return self._get("ret_orders", lambda: raw_ret_orders(self.spark, self.sf_dir))

    @property
    def ret_tickets(self):
        return self._get("ret_tickets", lambda: raw_ret_tickets(self.spark, self.sf_dir))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
