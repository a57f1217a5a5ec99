"""Data-quality operators: declared column tests, singular tests, contracts, freshness.

Column tests (not_null / accepted_values / between) of one model are folded
into a single aggregate pass with one ``count_if`` per rule.  ``unique``, ``relationships``, the contracts' primary keys and
failing values share one histogram per key column (``key_counts``), in the key's own type.  Checks of a published run take
what its writes have counted (``evidence``) instead of scanning those tables again.  Every check returns a DataFrame of
results, and ``failing_rows`` the rows behind any test; nothing is collected.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import config as C
from ledgerloom.operators.combine import combine_on_keys

RESULT_SCHEMA = "model string, column_name string, test_name string, failures long"


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    test: str                  # not_null | unique | accepted_values | between | relationships
    values: tuple = ()         # accepted values
    lo: float | None = None    # between (inclusive), either side optional
    hi: float | None = None
    parent: tuple = ()         # (model, column) for relationships


def _nn(model, *cols):
    return [ColumnTest(model, c, "not_null") for c in cols]


def _u(model, *cols):
    return [ColumnTest(model, c, "unique") for c in cols]


# ---------------------------------------------------------------- fixed values
TESTS: list[ColumnTest] = [
    *_nn("stg_customers", "surrogate_id", "customer_id", "customer_name"),
    *_nn("stg_loyalty_segments", "loyalty_segment_id", "loyalty_segment_description"),
    *_u("stg_loyalty_segments", "loyalty_segment_id"),
    *_nn("stg_sales_orders", "order_id", "customer_id"), *_u("stg_sales_orders", "order_id"),
    *_nn("stg_ret_customers", "b2b_customer_id", "customer_name", "email", "region"),
    *_u("stg_ret_customers", "b2b_customer_id"),
    *_nn("stg_ret_orders", "order_id", "b2b_customer_id", "amount", "status"), *_u("stg_ret_orders", "order_id"),
    ColumnTest("stg_ret_orders", "b2b_customer_id", "relationships", parent=("stg_ret_customers", "b2b_customer_id")),
    ColumnTest("stg_ret_orders", "amount", "between", lo=0),
    *_nn("stg_product_catalog", "product_id", "product_name", "category", "unit_cost"),
    *_u("stg_product_catalog", "product_id"),
    ColumnTest("stg_product_catalog", "category", "accepted_values",
               values=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")),
    ColumnTest("stg_product_catalog", "unit_cost", "between", lo=0),
    *_nn("stg_regional_sales_targets", "region", "target_month", "revenue_target", "order_target"),
    ColumnTest("stg_regional_sales_targets", "revenue_target", "between", lo=0),
    ColumnTest("stg_regional_sales_targets", "order_target", "between", lo=0),
    *_nn("stg_promo_campaigns", "promo_code", "campaign_name", "discount_pct"), *_u("stg_promo_campaigns", "promo_code"),
    ColumnTest("stg_promo_campaigns", "discount_pct", "between", lo=0, hi=100),
    ColumnTest("stg_promo_campaigns", "campaign_type", "accepted_values",
               values=("seasonal", "clearance", "flash_sale", "bundle", "loyalty")),
    *_nn("int_current_customers", "customer_id", "customer_name", "loyalty_segment_description"),
    *_u("int_current_customers", "customer_id"),
    *_nn("int_sales_order_lines", "order_id", "product_id", "quantity", "unit_price"),
    ColumnTest("int_sales_order_lines", "quantity", "between", lo=1),
    ColumnTest("int_sales_order_lines", "unit_price", "between", lo=0),
    ColumnTest("int_sales_order_lines", "line_revenue", "between", lo=0),
    *_nn("int_b2b_customer_health", "b2b_customer_id"), *_u("int_b2b_customer_health", "b2b_customer_id"),
    ColumnTest("int_b2b_customer_health", "health_score", "between", lo=0, hi=100),
    ColumnTest("int_b2b_customer_health", "account_health_status", "accepted_values",
               values=("healthy", "needs_attention", "at_risk")),
    *_nn("dim_customers", "customer_id", "customer_name"), *_u("dim_customers", "customer_id"),
    ColumnTest("dim_customers", "customer_value_segment", "accepted_values",
               values=("high_value", "mid_value", "low_value")),
    *_nn("dim_b2b_customers", "b2b_customer_id", "customer_name", "company_name", "region"),
    *_u("dim_b2b_customers", "b2b_customer_id"),
    ColumnTest("dim_b2b_customers", "total_revenue", "between", lo=0),
    ColumnTest("dim_b2b_customers", "return_rate", "between", lo=0, hi=1),
    ColumnTest("dim_b2b_customers", "health_score", "between", lo=0, hi=100),
    ColumnTest("dim_b2b_customers", "account_health_status", "accepted_values",
               values=("healthy", "needs_attention", "at_risk")),
    *_nn("fct_sales_orders", "order_id", "customer_id", "order_date"), *_u("fct_sales_orders", "order_id"),
    ColumnTest("fct_sales_orders", "customer_id", "relationships", parent=("dim_customers", "customer_id")),
    ColumnTest("fct_sales_orders", "total_revenue", "between", lo=0),
    *_nn("fct_order_lines", "order_id", "order_date", "customer_id"),
    ColumnTest("fct_order_lines", "quantity", "between", lo=1),
    ColumnTest("fct_order_lines", "unit_price", "between", lo=0),
    ColumnTest("fct_order_lines", "line_revenue", "between", lo=0),
    *_nn("dim_regional_sales_targets", "region", "target_month", "revenue_target", "order_target"),
    ColumnTest("dim_regional_sales_targets", "revenue_target", "between", lo=0),
    ColumnTest("dim_regional_sales_targets", "order_target", "between", lo=0),
    *_nn("rpt_promo_effectiveness", "promo_code", "campaign_name", "campaign_type"),
    *_u("rpt_promo_effectiveness", "promo_code"),
    ColumnTest("rpt_promo_effectiveness", "campaign_budget", "between", lo=0),
    ColumnTest("rpt_promo_effectiveness", "total_orders", "between", lo=0),
    ColumnTest("rpt_promo_effectiveness", "gross_revenue", "between", lo=0),
    *_nn("fct_b2b_orders", "order_id", "b2b_customer_id", "order_date"), *_u("fct_b2b_orders", "order_id"),
    ColumnTest("fct_b2b_orders", "b2b_customer_id", "relationships", parent=("dim_b2b_customers", "b2b_customer_id")),
    ColumnTest("fct_b2b_orders", "amount", "between", lo=0),
    *_nn("loyalty_campaign_targets", "customer_id"), *_u("loyalty_campaign_targets", "customer_id"),
    ColumnTest("loyalty_campaign_targets", "campaign_segment", "accepted_values",
               values=("vip_retention", "upgrade_candidate", "win_back", "standard_nurture")),
    *_nn("regional_target_attainment", "region", "month"),
    ColumnTest("regional_target_attainment", "performance_status", "accepted_values",
               values=("on_track", "at_risk", "behind", "no_target")),
    *_nn("consolidated_revenue", "order_id"),
    *_nn("b2b_account_health_report", "b2b_customer_id"), *_u("b2b_account_health_report", "b2b_customer_id"),
    ColumnTest("b2b_account_health_report", "finance_risk_tier", "accepted_values",
               values=("high_risk", "elevated_risk", "monitor", "standard")),
]


def _failing_predicate(t: ColumnTest):
    c = F.col(t.column)
    if t.test == "not_null":
        return c.isNull()
    if t.test == "accepted_values":
        return c.isNotNull() & ~c.isin(*t.values)
    if t.test == "between":
        bad = F.lit(False)
        if t.lo is not None:
            bad = bad | (c < F.lit(t.lo))
        if t.hi is not None:
            bad = bad | (c > F.lit(t.hi))
        return c.isNotNull() & bad
    raise ValueError(t.test)


#: Names of measures that a write counts.
ROWS, ANY_NULL, PRIMARY_KEY = "rows", "any_null", "repeated_keys"


def null_measure(column: str) -> str:
    return f"not_null:{column}"


def _measure(t: ColumnTest) -> str:
    return f"{t.test}:{t.column}"


def row_measures(model: str) -> dict[str, Column]:
    """What a write of the model counts: its rows, the failures of its row rules, and the nulls that its contract forbids."""
    required = [c for c, _, req in CONTRACTS[model][1] if req] if model in CONTRACTS else []
    out = {ROWS: F.count(F.lit(1))}
    out |= {_measure(t): F.count_if(_failing_predicate(t)) for t in TESTS if t.model == model and t.test in ROW_RULES}
    out |= {null_measure(c): F.count_if(F.col(c).isNull()) for c in required}
    if required:
        out[ANY_NULL] = F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required]))
    return out


def _evidence(project, model: str) -> dict[str, int]:
    return getattr(project, "evidence", lambda _: None)(model) or {}


def single_pass_tests(project, tests: list[ColumnTest]) -> DataFrame:
    """not_null / accepted_values / between, any mix of them: one aggregate per model, one count_if per rule."""
    spark = project.spark
    by_model: dict[str, list[ColumnTest]] = {}
    known = []
    for t in tests:
        if _measure(t) in (seen := _evidence(project, t.model)):
            known.append((t.model, t.column, t.test, seen[_measure(t)]))
        else:
            by_model.setdefault(t.model, []).append(t)
    parts = [spark.createDataFrame(known, RESULT_SCHEMA)] if known or not by_model else []
    for model, ts in by_model.items():
        row = project.model(model, [t.column for t in ts]).agg(
            *[F.count_if(_failing_predicate(t)).alias(f"f{i}") for i, t in enumerate(ts)])
        stack = ", ".join(f"'{t.column}', '{t.test}', f{i}" for i, t in enumerate(ts))
        parts.append(row.select(F.lit(model).alias("model"),
                                F.expr(f"stack({len(ts)}, {stack}) as (column_name, test_name, failures)")))
    return reduce(DataFrame.unionByName, parts)


def key_counts(project, model: str, column: str) -> DataFrame:
    """The key column's values (in their own type) with their rows: (_key, _rows).  The same DataFrame for all who ask in a
    project, so Spark shuffles it once in a plan."""
    cache = project.__dict__.setdefault("_key_counts", {})
    if (model, column) not in cache:
        key = F.col(column)
        cache[model, column] = (project.model(model, [column]).filter(key.isNotNull()).groupBy(key.alias("_key"))
                                .agg(F.count(F.lit(1)).alias("_rows")))
    return cache[model, column]


def _repeated(project, t: ColumnTest) -> DataFrame:
    """Key values that occur more than once, with their rows."""
    return key_counts(project, t.model, t.column).filter(F.col("_rows") > 1)


def _orphans(project, t: ColumnTest) -> DataFrame:
    """Child keys without a parent row: (_key, _rows).  Both sides are histograms, so a hot key is one row."""
    child, parent = key_counts(project, t.model, t.column), key_counts(project, *t.parent).select(F.col("_key").alias("_pk"))
    return child.join(parent, child["_key"] == parent["_pk"], "left_anti")


def _summed(project, tests: list[ColumnTest], failures: dict[int, DataFrame], known: dict[int, int]) -> DataFrame:
    """One result row per test.  ``failures``: test number -> its parts (column ``_n``), added up in one shuffle for all."""
    names = project.spark.createDataFrame([(i, t.model, t.column, t.test, known.get(i, 0)) for i, t in enumerate(tests)],
                                          "_t int, model string, column_name string, test_name string, _n long")
    parts = [df.select(F.lit(i).alias("_t"), *[F.lit(None).cast("string").alias(c) for c in ("model", "column_name", "test_name")],
                       F.col("_n").cast("long").alias("_n")) for i, df in failures.items()]
    return (reduce(DataFrame.unionByName, parts, names).groupBy("_t").agg(
        *[F.max(c).alias(c) for c in ("model", "column_name", "test_name")], F.sum("_n").alias("failures")).drop("_t"))


def unique_tests(project, tests: list[ColumnTest]) -> DataFrame:
    """Number of non-null key values that occur more than once, per test."""
    known = {i: seen[PRIMARY_KEY] for i, t in enumerate(tests)
             if PRIMARY_KEY in (seen := _evidence(project, t.model)) and CONTRACTS[t.model][0] == t.column}
    return _summed(project, tests, {i: _repeated(project, t).select(F.lit(1).alias("_n"))
                                    for i, t in enumerate(tests) if i not in known}, known)


def relationship_tests(project, tests: list[ColumnTest]) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    return _summed(project, tests, {i: _orphans(project, t).select(F.col("_rows").alias("_n")) for i, t in enumerate(tests)}, {})


ROW_RULES = ("not_null", "accepted_values", "between")


def run_tests(project, kind: str) -> DataFrame:
    """``kind``: one kind of test, or ``row_rules`` for the three row rules in one pass per model."""
    ts = [t for t in TESTS if t.test == kind or (kind == "row_rules" and t.test in ROW_RULES)]
    if kind in (*ROW_RULES, "row_rules"):
        return single_pass_tests(project, ts)
    return unique_tests(project, ts) if kind == "unique" else relationship_tests(project, ts)


def failing_rows(project, t: ColumnTest) -> DataFrame:
    """The rows that fail a declared test, as the model has them; for ``unique`` all rows of a repeated key."""
    df = project[t.model]
    if t.test in ROW_RULES:
        return df.filter(_failing_predicate(t))
    keys = (_repeated if t.test == "unique" else _orphans)(project, t).select("_key")
    return df.join(keys, df[t.column] == keys["_key"], "left_semi")


def _failing_in_one_pass(project, model: str, tests: list[ColumnTest]) -> DataFrame:
    """Failing values of a model's row rules: a row is listed under each rule that it fails, so the model is derived once
    for all its rules.  Values are grouped in their own type, one column per rule."""
    fails = [F.when(_failing_predicate(t), F.lit(i)) for i, t in enumerate(tests)]
    df = project.model(model, [t.column for t in tests])
    listed = df.select(F.explode(F.array(*fails)).alias("_t"), "*").filter(F.col("_t").isNotNull())
    keys = [F.when(F.col("_t") == i, F.col(t.column)).alias(f"_v{i}") for i, t in enumerate(tests)]
    found = listed.select("_t", *keys).groupBy("_t", *[f"_v{i}" for i in range(len(tests))]).agg(
        F.count(F.lit(1)).alias("rows"))
    rule = F.array(*[F.struct(F.lit(t.column).alias("c"), F.lit(t.test).alias("t")) for t in tests])[F.col("_t")]
    return found.select(
        F.lit(model).alias("model"), rule["c"].alias("column_name"), rule["t"].alias("test_name"),
        F.coalesce(*[F.col(f"_v{i}").cast("string") for i in range(len(tests))]).alias("failing_value"), "rows")


def failing_values(project, tests: list[ColumnTest]) -> DataFrame:
    """What fails, over all ``tests``: model, column, test, the value as text and the rows that have it."""
    by_model: dict[str, list[ColumnTest]] = {}
    for t in tests:
        if t.test in ROW_RULES:
            by_model.setdefault(t.model, []).append(t)
    parts = [_failing_in_one_pass(project, model, ts) for model, ts in by_model.items()]
    parts += [(_repeated if t.test == "unique" else _orphans)(project, t).select(
        F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"), F.lit(t.test).alias("test_name"),
        F.col("_key").cast("string").alias("failing_value"), F.col("_rows").alias("rows"))
        for t in tests if t.test not in ROW_RULES]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- singular tests

def _order_totals(project) -> DataFrame:
    """Orders with their revenue, for a filter on it."""
    o = project["fct_sales_orders"].select("order_id", "total_revenue")
    return getattr(project, "for_filter", lambda _, df, __: df)("fct_sales_orders", o, o.columns)


def revenue_reconciliation(project, tolerance: float = 0.01) -> DataFrame:
    """Orders with revenue > 0 whose line total differs by more than ``tolerance``."""
    lines = project["fct_order_lines"].groupBy("order_id").agg(
        F.sum("line_revenue").cast("decimal(38,2)").alias("line_total"))
    o = _order_totals(project).filter(F.col("total_revenue") > 0)
    j = o.join(lines, "order_id")
    diff = F.abs(F.col("total_revenue") - F.col("line_total")).cast("decimal(38,2)")
    return j.filter(diff > F.lit(tolerance)).select("order_id", "total_revenue", "line_total", diff.alias("diff"))


def duplicate_current_customers(project) -> DataFrame:
    return (project.model("dim_customers", ["customer_id"]).groupBy("customer_id").agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def orders_without_customers(project) -> DataFrame:
    o = project["fct_sales_orders"].select("order_id", "customer_id")
    c = project.model("dim_customers", ["customer_id"])
    return o.join(c, "customer_id", "left_anti").select("order_id", "customer_id")


def negative_revenue(project) -> DataFrame:
    return _order_totals(project).filter(F.col("total_revenue") < 0)


def singular_tests(project) -> DataFrame:
    """Failure counts of the five singular tests."""
    from ledgerloom.plans.registry import promo_misuse_rows
    parts = [("assert_line_revenue_matches_order_revenue", revenue_reconciliation(project)),
             ("assert_no_duplicate_current_customers", duplicate_current_customers(project)),
             ("assert_orders_have_customers", orders_without_customers(project)),
             ("assert_positive_revenue", negative_revenue(project)),
             ("assert_promo_orders_within_campaign_dates", promo_misuse_rows(project))]
    out = None
    for name, df in parts:
        p = df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test_name"), "failures")
        out = p if out is None else out.unionByName(p)
    return out


# ---------------------------------------------------------------- contracts

_L, _D, _S, _B, _DT = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType()
_M = T.DecimalType(18, 2)

# Model -> (primary key, [(column, type, not_null)])
CONTRACTS: dict[str, tuple[str | None, list[tuple[str, T.DataType, bool]]]] = {
    "dim_customers": ("customer_id", [
        ("customer_id", _L, True), ("customer_name", _S, True), ("region", _S, False), ("state", _S, False),
        ("city", _S, False), ("district", _S, False), ("postcode", _S, False), ("ship_to_address", _S, False),
        ("lat", _D, False), ("lon", _D, False), ("loyalty_segment_id", _L, False),
        ("loyalty_segment_description", _S, False), ("loyalty_unit_threshold", _L, False),
        ("units_purchased", _L, False), ("customer_value_segment", _S, False), ("customer_since_date", _DT, False),
        ("customer_number", _S, False)]),
    "dim_b2b_customers": ("b2b_customer_id", [
        ("b2b_customer_id", _S, True), ("customer_name", _S, True), ("company_name", _S, True), ("region", _S, True),
        ("customer_start_date", _DT, False), ("total_orders", _L, False), ("total_revenue", _M, False),
        ("cancelled_revenue", _M, False), ("cancelled_orders", _L, False), ("last_order_date", _DT, False),
        ("total_tickets", _L, False), ("open_tickets", _L, False), ("billing_tickets", _L, False),
        ("delivery_tickets", _L, False), ("return_rate", _D, False), ("health_score", T.IntegerType(), False),
        ("account_health_status", _S, False)]),
    "fct_sales_orders": ("order_id", [
        ("order_id", _L, True), ("order_number", _L, False), ("customer_id", _L, True), ("order_date", _DT, True),
        ("order_timestamp", T.TimestampNTZType(), False), ("number_of_line_items", _L, False),
        ("total_revenue", _M, False), ("parsed_line_items", _L, False), ("promo_code", _S, False),
        ("has_promo", _B, False), ("has_unparsed_products", _B, False)]),
    "fct_order_lines": (None, [
        ("order_id", _L, True), ("order_date", _DT, True), ("customer_id", _L, True),
        ("line_number", T.IntegerType(), False), ("product_id", _L, False), ("product_name", _S, False),
        ("product_category", _S, False), ("product_subcategory", _S, False), ("quantity", _L, False),
        ("unit_price", _M, False), ("line_revenue", _M, False), ("unit_cost", _D, False),
        ("line_margin", _D, False), ("has_catalog_match", _B, False)]),
    "dim_regional_sales_targets": (None, [
        ("region", _S, True), ("target_month", _DT, True), ("revenue_target", _M, True),
        ("order_target", _L, True), ("notes", _S, False)]),
    "fct_b2b_orders": ("order_id", [
        ("order_id", _L, True), ("b2b_customer_id", _S, True), ("order_date", _DT, True), ("amount", _M, False),
        ("status", _S, False), ("is_cancelled_or_returned", _B, False), ("cancel_return_reason", _S, False)]),
}


def contract_check(project, models=None) -> DataFrame:
    """Per public model: missing/mismatched/extra columns, not-null violations, PK duplicates."""
    spark = project.spark
    out = None
    for model in (models or list(CONTRACTS)):
        pk, cols = CONTRACTS[model]
        df = project[model]
        actual = {f.name: f.dataType for f in df.schema.fields}
        declared = {c for c, _, _ in cols}
        missing = sum(1 for c in declared if c not in actual)
        mismatched = sum(1 for c, t, _ in cols if c in actual and actual[c] != t)
        extra = sum(1 for c in actual if c not in declared)
        nn = [c for c, _, req in cols if req and c in actual]
        seen = _evidence(project, model)
        if ANY_NULL in seen and (not pk or PRIMARY_KEY in seen):
            stats = spark.createDataFrame([(seen[ANY_NULL], seen.get(PRIMARY_KEY, 0))],
                                          "not_null_violations long, pk_duplicates long")
        else:
            null_rule = F.lit(False)
            for c in nn:
                null_rule = null_rule | F.col(c).isNull()
            stats = project.model(model, nn).agg(F.count_if(null_rule).alias("not_null_violations"))
            if pk:
                dup = key_counts(project, model, pk).filter(F.col("_rows") > 1).agg(F.count(F.lit(1)).alias("pk_duplicates"))
                stats = combine_on_keys([stats, dup])
            else:
                stats = stats.withColumn("pk_duplicates", F.lit(0).cast("long"))
        row = stats.select(
            F.lit(model).alias("model"), F.lit(missing).cast("long").alias("missing_columns"),
            F.lit(mismatched).cast("long").alias("type_mismatches"), F.lit(extra).cast("long").alias("extra_columns"),
            "not_null_violations", F.col("pk_duplicates").cast("long").alias("pk_duplicates"))
        out = row if out is None else out.unionByName(row)
    return out


def enforce_contract(df: DataFrame, model: str) -> DataFrame:
    """Cast to the declared schema (column order of the contract); raise on missing columns."""
    _, cols = CONTRACTS[model]
    missing = [c for c, _, _ in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{model}: contract columns missing: {missing}")
    return df.select(*[F.col(c).cast(t).alias(c) for c, t, _ in cols])


# ---------------------------------------------------------------- freshness

def source_freshness(project, as_of: dt.datetime = C.FRESHNESS_AS_OF,
                     warn_hours: int = C.FRESHNESS_WARN_HOURS, error_hours: int = C.FRESHNESS_ERROR_HOURS,
                     sources=("customers", "loyalty_segments", "sales_orders", "ret_customers", "ret_orders",
                              "ret_tickets")) -> DataFrame:
    """Per source: last sync time, minutes since, PASS / WARN / ERROR."""
    out = None
    for s in sources:
        seen = project.evidence(s, "landed")
        if seen and seen["synced"] is not None:
            p = project.spark.range(1).select(F.lit(s).alias("source"), F.timestamp_micros(F.lit(seen["synced"]))
                                              .cast("timestamp_ntz").alias("max_synced"))
        else:
            p = project.raw.table(s).agg(F.max("_fivetran_synced").alias("max_synced")).select(
                F.lit(s).alias("source"), "max_synced")
        out = p if out is None else out.unionByName(p)
    lag = F.floor((F.unix_seconds(F.lit(as_of).cast("timestamp")) -
                   F.unix_seconds(F.col("max_synced").cast("timestamp"))) / 60).cast("long")
    status = (F.when(lag > error_hours * 60, F.lit("ERROR")).when(lag > warn_hours * 60, F.lit("WARN"))
               .otherwise(F.lit("PASS")))
    return out.select("source", F.col("max_synced").cast("timestamp_ntz").alias("max_synced"),
                      lag.alias("minutes_since_sync"), status.alias("freshness_status"))
