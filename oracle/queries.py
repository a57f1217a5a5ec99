"""Oracle SQL per registered query key (DuckDB, over the star tables as views)."""

from __future__ import annotations

from oracle.sql import AS_OF, SYNCED, average, query

ORACLE: dict[str, str] = {}


def _live(source: str, table: str, flag: str = "deleted") -> str:
    return (f"SELECT '{source}' AS source, count(*) AS total_rows, "
            f"CAST(count_if({flag} IS NULL OR NOT {flag}) AS BIGINT) AS live_rows, "
            f"CAST(count_if({flag}) AS BIGINT) AS deleted_rows, CAST(count_if({flag} IS NULL) AS BIGINT) AS null_flag_rows "
            f"FROM {table}")


ORACLE["live_rows"] = query(" UNION ALL ".join([
    _live("customers", "raw_customers"),
    "SELECT 'loyalty_segments', count(*), count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM loyalty",
    _live("sales_orders", "(SELECT CASE WHEN o_orderkey % 53 = 0 THEN true WHEN o_orderkey % 3 = 0 THEN NULL "
                          "ELSE false END AS deleted FROM orders)"),
    _live("ret_customers", "ret_customers"),
    _live("ret_orders", "ret_orders"),
    _live("ret_tickets", "ret_tickets"),
]))

ORACLE["staged_customers"] = query(
    "SELECT surrogate_id, customer_id, customer_name, city, state, region, loyalty_segment_id, units_purchased, "
    "valid_from_date, valid_to_date, is_current FROM stg_customers")

ORACLE["staged_orders"] = query(
    "SELECT order_id, order_number, customer_id, order_timestamp, order_date, number_of_line_items, promo_code, "
    "NOT has_unparsed_products AS products_parsed FROM so_live")

ORACLE["staged_b2b_customers"] = query("SELECT * FROM stg_ret_customers")
ORACLE["staged_b2b_orders"] = query("SELECT * FROM stg_ret_orders")
ORACLE["staged_tickets"] = query("SELECT * FROM stg_ret_tickets")
ORACLE["active_products"] = query("SELECT * FROM catalog")
ORACLE["regional_targets"] = query("SELECT * FROM targets")
ORACLE["scd2_current"] = query("SELECT * FROM int_current_customers")
ORACLE["loyalty_lookup"] = query(
    "SELECT customer_id, loyalty_segment_id, loyalty_segment_description, loyalty_unit_threshold "
    "FROM int_current_customers")
ORACLE["order_lines"] = query("SELECT * FROM order_lines")
ORACLE["order_lines_rounded"] = query("SELECT * FROM order_lines_rounded")
ORACLE["order_revenue"] = query("SELECT * FROM fct_sales_orders")
ORACLE["line_margin"] = query("SELECT * FROM fct_order_lines")
ORACLE["value_segment"] = query("SELECT * FROM dim_customers")
ORACLE["promo_effectiveness"] = query("SELECT * FROM rpt_promo_effectiveness")
ORACLE["promo_misuse"] = query(
    "SELECT o.promo_code, o.order_id, o.order_date, r.campaign_start, r.campaign_end "
    "FROM fct_sales_orders o JOIN rpt_promo_effectiveness r ON o.promo_code = r.promo_code "
    "WHERE o.has_promo AND o.order_date NOT BETWEEN r.campaign_start AND r.campaign_end AND r.total_orders > 0")
ORACLE["b2b_orders"] = query("SELECT * FROM fct_b2b_orders")
ORACLE["b2b_health"] = query("SELECT * FROM dim_b2b_customers")
ORACLE["account_risk"] = query("SELECT * FROM b2b_account_health_report")
ORACLE["recent_b2b_orders"] = query(
    f"SELECT * FROM fct_b2b_orders WHERE order_date >= CAST({AS_OF} - INTERVAL 6 MONTH AS DATE)")
ORACLE["campaign_targets"] = query("SELECT * FROM loyalty_campaign_targets")
ORACLE["regional_performance"] = query("SELECT * FROM regional_performance")
ORACLE["target_attainment"] = query("SELECT * FROM regional_target_attainment")
ORACLE["consolidated_revenue"] = query("SELECT * FROM consolidated_revenue")

# ---------------------------------------------------------------- time spine and metrics
ORACLE["time_spine"] = query(
    "SELECT CAST(d AS DATE) AS date_day FROM (SELECT unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), "
    "CAST(max(order_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM fct_sales_orders)")

ORACLE["metric_revenue_by_month"] = query(
    "SELECT CAST(date_trunc('month', order_date) AS DATE) AS metric_time__month, "
    "sum(total_revenue) AS total_b2c_revenue, count(order_id) AS total_b2c_orders, "
    "CAST(sum(number_of_line_items) AS BIGINT) AS total_line_items FROM fct_sales_orders GROUP BY 1")

ORACLE["metric_gap_filled"] = query(
    "SELECT s.date_day AS metric_time__day, coalesce(m.rev, 0) AS total_b2c_revenue "
    "FROM (SELECT CAST(d AS DATE) AS date_day FROM (SELECT unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), "
    "CAST(max(order_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM fct_sales_orders)) s "
    "LEFT JOIN (SELECT order_date, sum(total_revenue) AS rev FROM fct_sales_orders GROUP BY 1) m "
    "ON m.order_date = s.date_day")


def _div(num, den):
    return f"CASE WHEN CAST({den} AS DOUBLE) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


ORACLE["metric_aov"] = query(
    f"SELECT c.region AS customer_region, o.has_promo, {_div('sum(o.total_revenue)', 'count(o.order_id)')} "
    "AS avg_b2c_order_value, count(o.order_id) AS total_b2c_orders "
    "FROM fct_sales_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id GROUP BY 1, 2")

ORACLE["metric_cancellation_rate"] = query(
    "SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS metric_time__quarter, "
    f"{_div('sum(CASE WHEN is_cancelled_or_returned THEN amount ELSE 0 END)', 'sum(amount)')} AS b2b_cancellation_rate, "
    f"{_div('sum(amount)', 'count(order_id)')} AS avg_b2b_order_value, count(order_id) AS total_b2b_orders "
    "FROM fct_b2b_orders GROUP BY 1")

ORACLE["metric_units_per_customer"] = query(
    "SELECT loyalty_segment_description AS customer_loyalty_tier, "
    f"{_div('sum(units_purchased)', 'count(customer_id)')} AS avg_units_per_customer, "
    "count(customer_id) AS total_customers, CAST(sum(units_purchased) AS BIGINT) AS total_units_purchased "
    "FROM dim_customers GROUP BY 1")

ORACLE["metric_derived"] = query(
    "SELECT coalesce(a.customer_region, b.customer_region) AS customer_region, "
    f"{_div('a.total_b2c_revenue', 'b.total_customers')} AS revenue_per_customer, a.total_b2c_revenue, b.total_customers "
    "FROM (SELECT c.region AS customer_region, sum(o.total_revenue) AS total_b2c_revenue FROM fct_sales_orders o "
    "      LEFT JOIN dim_customers c ON c.customer_id = o.customer_id GROUP BY 1) a "
    "FULL OUTER JOIN (SELECT region AS customer_region, count(customer_id) AS total_customers FROM dim_customers "
    "      GROUP BY 1) b ON a.customer_region IS NOT DISTINCT FROM b.customer_region")

ORACLE["metric_gap_filled_ratio"] = query(
    "SELECT s.m AS metric_time__month, g.has_promo, v.avg_b2c_order_value FROM (SELECT DISTINCT CAST(date_trunc('month', d) "
    "AS DATE) AS m FROM (SELECT unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), CAST(max(order_date) AS TIMESTAMP), "
    "INTERVAL 1 DAY)) AS d FROM fct_sales_orders)) s CROSS JOIN (SELECT DISTINCT has_promo FROM fct_sales_orders) g "
    "LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS m, has_promo, "
    f"{_div('sum(total_revenue)', 'count(order_id)')} AS avg_b2c_order_value FROM fct_sales_orders GROUP BY 1, 2) v "
    "ON v.m = s.m AND v.has_promo IS NOT DISTINCT FROM g.has_promo")

ORACLE["metric_totals"] = query(
    "SELECT (SELECT count(customer_id) FROM dim_customers) AS total_customers, "
    "(SELECT count(order_id) FROM fct_sales_orders) AS total_b2c_orders, "
    "(SELECT count(order_id) FROM fct_b2b_orders) AS total_b2b_orders, "
    f"(SELECT {_div('sum(amount)', 'count(order_id)')} FROM fct_b2b_orders) AS avg_b2b_order_value, "
    f"(SELECT {_div('sum(CASE WHEN is_cancelled_or_returned THEN amount ELSE 0 END)', 'sum(amount)')} "
    "FROM fct_b2b_orders) AS b2b_cancellation_rate")

ORACLE["metric_filtered"] = query(
    "SELECT b.state AS customer_state, a.rev AS total_b2c_revenue, a.n AS total_b2c_orders, b.n AS total_customers FROM "
    "(SELECT state, count(customer_id) AS n FROM dim_customers WHERE region = 'ASIA' AND loyalty_segment_description IN "
    "('Gold', 'Silver') GROUP BY 1) b LEFT JOIN (SELECT c.state, sum(o.total_revenue) AS rev, count(o.order_id) AS n "
    "FROM fct_sales_orders o JOIN dim_customers c ON c.customer_id = o.customer_id WHERE c.region = 'ASIA' AND "
    "c.loyalty_segment_description IN ('Gold', 'Silver') GROUP BY 1) a ON a.state IS NOT DISTINCT FROM b.state")

ORACLE["metric_filtered_mixed"] = query(
    "SELECT c.region AS customer_region, CAST(date_trunc('year', o.order_date) AS DATE) AS metric_time__year, "
    f"{_div('sum(o.total_revenue)', 'count(o.order_id)')} AS avg_b2c_order_value, count(o.order_id) AS total_b2c_orders, "
    "count(DISTINCT o.promo_code) AS distinct_promo_codes FROM fct_sales_orders o LEFT JOIN dim_customers c "
    "ON c.customer_id = o.customer_id WHERE o.order_date >= DATE '1995-06-01' AND o.total_revenue > 0 AND "
    "(c.region IS NULL OR c.region <> 'ASIA' OR o.has_promo) GROUP BY 1, 2")

ORACLE["metric_distinct_by_region"] = query(
    "SELECT c.region AS customer_region, o.has_promo, count(DISTINCT o.customer_id) AS distinct_buyers, "
    "count(DISTINCT o.promo_code) AS distinct_promo_codes, "
    f"{average('sum(o.number_of_line_items)', 'count(o.number_of_line_items)')} AS avg_items_per_order, "
    "CAST(max(o.total_revenue) AS DECIMAL(38,2)) AS largest_order, count(o.order_id) AS total_b2c_orders "
    "FROM fct_sales_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id GROUP BY 1, 2")

ORACLE["metric_line_products"] = query(
    "SELECT c.loyalty_segment_description AS customer_loyalty_tier, sum(l.line_revenue) AS total_line_revenue, "
    "CAST(sum(l.quantity) AS BIGINT) AS total_line_units, count(DISTINCT l.product_id) AS distinct_line_products "
    "FROM fct_order_lines l LEFT JOIN dim_customers c ON c.customer_id = l.customer_id WHERE l.product_category = 'PROMO' GROUP BY 1")

# ---------------------------------------------------------------- semantic views
ORACLE["semantic_select"] = query(
    "SELECT c.region, c.loyalty_segment_description AS loyalty_tier, sum(o.total_revenue) AS b2c_revenue, "
    "count(o.total_revenue) AS orders FROM fct_sales_orders o LEFT JOIN dim_customers c "
    "ON c.customer_id = o.customer_id GROUP BY 1, 2")

ORACLE["semantic_b2b"] = query(
    "SELECT c.account_health_status, o.status AS b2b_order_status, sum(o.amount) AS b2b_revenue, "
    "count(o.amount) AS orders FROM fct_b2b_orders o LEFT JOIN dim_b2b_customers c "
    "ON c.b2b_customer_id = o.b2b_customer_id GROUP BY 1, 2")

ORACLE["semantic_filtered"] = query(
    "SELECT c.state, o.has_promo, sum(o.total_revenue) AS b2c_revenue, count(o.total_revenue) AS orders "
    "FROM fct_sales_orders o JOIN dim_customers c ON c.customer_id = o.customer_id WHERE c.region IN ('ASIA', 'EUROPE') "
    "AND c.loyalty_segment_description <> 'Bronze' AND o.order_date >= DATE '1995-01-01' AND o.total_revenue > 1000 GROUP BY 1, 2")

ORACLE["semantic_filtered_rows"] = query(
    "SELECT o.order_date AS b2b_order_date, o.amount AS b2b_revenue, c.company_name FROM fct_b2b_orders o "
    "JOIN dim_b2b_customers c ON c.b2b_customer_id = o.b2b_customer_id WHERE c.account_health_status = 'at_risk' "
    "AND (o.is_cancelled_or_returned OR c.region = 'ASIA') AND o.amount > 50000")

ORACLE["raw_filtered"] = query(
    "SELECT c.city, count(*) AS order_rows, CAST(sum(o.n) AS BIGINT) AS line_items FROM (SELECT o_custkey, "
    "(SELECT count(*) FROM lineitem l WHERE l.l_orderkey = orders.o_orderkey) AS n FROM orders "
    "WHERE o_orderpriority = '3-MEDIUM') o LEFT JOIN raw_customers c ON c.customer_id = o.o_custkey "
    "WHERE (c.region IS NULL OR c.region = 'AFRICA') AND o.n >= 3 GROUP BY 1")

ORACLE["raw_vs_governed"] = query(
    "SELECT (SELECT count(*) FROM raw_customers) AS raw_customer_rows, "
    "(SELECT CAST(sum(units_purchased) AS BIGINT) FROM raw_customers) AS raw_units, "
    "(SELECT count(*) FROM dim_customers) AS governed_customers, "
    "(SELECT CAST(sum(units_purchased) AS BIGINT) FROM dim_customers) AS governed_units, "
    "(SELECT count(*) FROM orders) AS raw_orders, (SELECT count(*) FROM fct_sales_orders) AS governed_orders")

ORACLE["raw_orders_by_region"] = query(
    "SELECT c.region, count(o.order_datetime) AS order_rows, CAST(sum(o.n) AS BIGINT) AS line_items FROM "
    "(SELECT o_custkey, CASE WHEN o_orderkey % 89 = 0 THEN 0 ELSE date_diff('second', TIMESTAMP '1970-01-01', o_orderdate) END "
    "AS order_datetime, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = orders.o_orderkey) AS n FROM orders) o "
    "LEFT JOIN raw_customers c ON c.customer_id = o.o_custkey GROUP BY 1")

# ---------------------------------------------------------------- data quality
from ledgerloom.operators.quality import CONTRACTS, TESTS  # noqa: E402

# Spark model name -> oracle CTE holding the same rows.
ORACLE_MODEL = {"stg_loyalty_segments": "loyalty", "stg_sales_orders": "so_live", "stg_product_catalog": "catalog",
                "stg_regional_sales_targets": "targets", "dim_regional_sales_targets": "targets",
                "stg_promo_campaigns": "campaigns", "int_sales_order_lines": "order_lines",
                "int_b2b_customer_health": "dim_b2b_customers"}


def _m(model):
    return ORACLE_MODEL.get(model, model)


def _lit(v):
    return f"'{v}'" if isinstance(v, str) else repr(v)


def _rule_sql(t):
    c = t.column
    if t.test == "not_null":
        return f"{c} IS NULL"
    if t.test == "accepted_values":
        return f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_lit(v) for v in t.values)})"
    bad = []
    if t.lo is not None:
        bad.append(f"{c} < {t.lo}")
    if t.hi is not None:
        bad.append(f"{c} > {t.hi}")
    return f"{c} IS NOT NULL AND ({' OR '.join(bad)})"


def _dq_sql(kind):
    parts = []
    for t in TESTS:
        if t.test != kind:
            continue
        head = f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.test}' AS test_name, "
        if kind in ("not_null", "accepted_values", "between"):
            parts.append(head + f"CAST(count_if({_rule_sql(t)}) AS BIGINT) AS failures FROM {_m(t.model)}")
        elif kind == "unique":
            parts.append(head + f"(SELECT count(*) FROM (SELECT {t.column} FROM {_m(t.model)} WHERE {t.column} "
                                f"IS NOT NULL GROUP BY {t.column} HAVING count(*) > 1)) AS failures")
        else:
            pm, pc = t.parent
            parts.append(head + f"(SELECT count(*) FROM {_m(t.model)} ch WHERE ch.{t.column} IS NOT NULL AND NOT EXISTS "
                                f"(SELECT 1 FROM {_m(pm)} pa WHERE pa.{pc} = ch.{t.column})) AS failures")
    return query("\nUNION ALL\n".join(parts))


_ROW_RULES = ("not_null", "accepted_values", "between")
ORACLE["dq_row_rules"] = query("\nUNION ALL\n".join(
    f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.test}' AS test_name, "
    f"CAST(count_if({_rule_sql(t)}) AS BIGINT) AS failures FROM {_m(t.model)}" for t in TESTS if t.test in _ROW_RULES))


def _failing_sql(t):
    bad = _rule_sql(t) if t.test in _ROW_RULES else (
        f"ch.{t.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_m(t.parent[0])} pa WHERE pa.{t.parent[1]} = ch.{t.column})")
    return (f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.test}' AS test_name, "
            f"CAST(ch.{t.column} AS VARCHAR) AS failing_value, count(*) AS rows FROM {_m(t.model)} ch WHERE {bad} GROUP BY ALL")


ORACLE["dq_failing_values"] = query("\nUNION ALL\n".join(
    _failing_sql(t) for t in TESTS if t.test in ("accepted_values", "between", "relationships")))

for _kind in ("not_null", "unique", "accepted_values", "between", "relationships"):
    ORACLE[f"dq_{_kind}"] = _dq_sql(_kind)

_RECON = ("SELECT o.order_id, o.total_revenue, lt.line_total, abs(o.total_revenue - lt.line_total) AS diff "
          "FROM fct_sales_orders o JOIN (SELECT order_id, sum(line_revenue) AS line_total FROM fct_order_lines "
          "GROUP BY order_id) lt ON lt.order_id = o.order_id "
          "WHERE o.total_revenue > 0 AND abs(o.total_revenue - lt.line_total) > 0.01")
ORACLE["dq_revenue_reconciliation"] = query(_RECON)

_ORPHANS = ("SELECT o.order_id, o.customer_id FROM fct_sales_orders o "
            "WHERE NOT EXISTS (SELECT 1 FROM dim_customers c WHERE c.customer_id = o.customer_id)")
ORACLE["dq_orphan_orders"] = query(_ORPHANS)

ORACLE["dq_singular"] = query(
    f"SELECT 'assert_line_revenue_matches_order_revenue' AS test_name, (SELECT count(*) FROM ({_RECON})) AS failures "
    "UNION ALL SELECT 'assert_no_duplicate_current_customers', (SELECT count(*) FROM (SELECT customer_id "
    "FROM dim_customers GROUP BY 1 HAVING count(*) > 1)) "
    f"UNION ALL SELECT 'assert_orders_have_customers', (SELECT count(*) FROM ({_ORPHANS})) "
    "UNION ALL SELECT 'assert_positive_revenue', (SELECT count(*) FROM fct_sales_orders WHERE total_revenue < 0) "
    "UNION ALL SELECT 'assert_promo_orders_within_campaign_dates', (SELECT count(*) FROM fct_sales_orders o "
    "JOIN rpt_promo_effectiveness r ON o.promo_code = r.promo_code WHERE o.has_promo AND o.order_date "
    "NOT BETWEEN r.campaign_start AND r.campaign_end AND r.total_orders > 0)")


def _contract_sql():
    parts = []
    for model, (pk, cols) in CONTRACTS.items():
        nn = [c for c, _, req in cols if req]
        rule = " OR ".join(f"{c} IS NULL" for c in nn) or "false"
        dup = (f"(SELECT count(*) FROM (SELECT {pk} FROM {_m(model)} WHERE {pk} IS NOT NULL GROUP BY 1 "
               f"HAVING count(*) > 1))" if pk else "0")
        parts.append(f"SELECT '{model}' AS model, CAST(0 AS BIGINT) AS missing_columns, CAST(0 AS BIGINT) AS "
                     f"type_mismatches, CAST(0 AS BIGINT) AS extra_columns, "
                     f"(SELECT CAST(count_if({rule}) AS BIGINT) FROM {_m(model)}) AS not_null_violations, "
                     f"CAST({dup} AS BIGINT) AS pk_duplicates")
    return query("\nUNION ALL\n".join(parts))


ORACLE["dq_contract"] = _contract_sql()

_FRESH_AS_OF = "TIMESTAMP '2001-12-01 00:25:00'"
ORACLE["source_freshness"] = query(
    f"SELECT source, max_synced, CAST(floor(date_diff('second', max_synced, {_FRESH_AS_OF}) / 60) AS BIGINT) "
    f"AS minutes_since_sync, CASE WHEN floor(date_diff('second', max_synced, {_FRESH_AS_OF}) / 60) > "
    f"780 THEN 'ERROR' WHEN floor(date_diff('second', max_synced, {_FRESH_AS_OF}) / 60) > "
    f"420 THEN 'WARN' ELSE 'PASS' END AS freshness_status FROM ("
    "SELECT 'customers' AS source, max(synced) AS max_synced FROM raw_customers "
    "UNION ALL SELECT 'loyalty_segments', max(synced) FROM loyalty "
    f"UNION ALL SELECT 'sales_orders', max({SYNCED} - (o_orderkey % 720) "
    "* INTERVAL 1 MINUTE) FROM orders "
    "UNION ALL SELECT 'ret_customers', max(synced) FROM ret_customers "
    "UNION ALL SELECT 'ret_orders', max(synced) FROM ret_orders "
    "UNION ALL SELECT 'ret_tickets', max(synced) FROM ret_tickets)")

ORACLE["audit_trace"] = query(
    "SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, "
    "CASE WHEN o.o_orderkey % 89 = 0 THEN 0 ELSE date_diff('second', TIMESTAMP '1970-01-01', o.o_orderdate) END "
    "AS order_datetime, "
    "CASE o.o_orderpriority WHEN '1-URGENT' THEN 'SPRING10' WHEN '2-HIGH' THEN ' SUMMER20 ' WHEN '3-MEDIUM' THEN "
    "'FLASH30' WHEN '4-NOT SPECIFIED' THEN CASE WHEN o.o_orderkey % 4 = 0 THEN 'BUNDLE' END WHEN '5-LOW' THEN '  ' "
    "END AS promo_info, "
    "CASE WHEN o.o_orderkey % 53 = 0 THEN true WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE false END "
    "AS _fivetran_deleted, "
    f"{SYNCED} - (o.o_orderkey % 720) * INTERVAL 1 MINUTE AS synced_at, "
    "f.total_revenue FROM orders o JOIN fct_sales_orders f ON f.order_id = o.o_orderkey "
    "WHERE f.order_date >= DATE '1996-03-01' AND f.order_date < DATE '1996-04-01' "
    "AND f.customer_id IN (SELECT customer_id FROM dim_customers WHERE region = 'AMERICA')")

ORACLE["trace_cancellation_rate"] = query(
    "SELECT metric, 'ret_orders' AS source_table, CAST(order_id AS VARCHAR) AS source_id, CAST(NULL AS INTEGER) AS position, "
    "synced AS synced_at, CAST(amount AS DECIMAL(38,2)) AS contribution FROM ret_orders, "
    "(VALUES ('b2b_cancelled_amount'), ('total_b2b_revenue')) m(metric) WHERE (deleted IS NULL OR NOT deleted) "
    "AND status = 'returned' AND created_at >= TIMESTAMP '1997-04-01' AND created_at < TIMESTAMP '1997-07-01'")

ORACLE["trace_line_revenue"] = query(
    "SELECT 'total_line_revenue' AS metric, 'sales_orders' AS source_table, CAST(order_id AS VARCHAR) AS source_id, "
    f"line_number AS position, {SYNCED} - (order_id % 720) * INTERVAL 1 MINUTE AS synced_at, "
    "CAST(line_revenue AS DECIMAL(38,2)) AS contribution FROM fct_order_lines WHERE product_category = 'PROMO' "
    "AND order_date >= DATE '1996-05-01' AND order_date < DATE '1996-06-01'")

ORACLE["trace_revenue_per_customer"] = query(
    "SELECT 'total_b2c_revenue' AS metric, 'sales_orders' AS source_table, CAST(o.order_id AS VARCHAR) AS source_id, "
    f"CAST(NULL AS INTEGER) AS position, {SYNCED} - (o.order_id % 720) * INTERVAL 1 MINUTE AS synced_at, "
    "CAST(o.total_revenue AS DECIMAL(38,2)) AS contribution FROM fct_sales_orders o JOIN dim_customers c "
    "ON c.customer_id = o.customer_id WHERE c.region = 'EUROPE' UNION ALL "
    "SELECT 'total_customers', 'customers', CAST(v.surrogate_id AS VARCHAR), NULL, r.synced, CAST(1 AS DECIMAL(38,2)) FROM "
    "(SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from_date DESC NULLS LAST, surrogate_id DESC) AS rn "
    "FROM stg_customers WHERE is_current) v JOIN raw_customers r ON r.surrogate_id = v.surrogate_id "
    "WHERE v.rn = 1 AND v.region = 'EUROPE'")

# ---------------------------------------------------------------- business questions
_W6 = f"order_date >= CAST({AS_OF} - INTERVAL 6 MONTH AS DATE) AND order_date < {AS_OF}"
_W12 = f"order_date >= CAST({AS_OF} - INTERVAL 12 MONTH AS DATE) AND order_date < {AS_OF}"
_LM_START = f"CAST(date_trunc('month', {AS_OF} - INTERVAL 1 MONTH) AS DATE)"
_LM_END = f"CAST(date_trunc('month', {AS_OF}) AS DATE)"

ORACLE["q_revenue_last_month"] = query(
    f"SELECT {_LM_START} AS month_start, CAST(coalesce(sum(total_revenue), 0) AS DECIMAL(38,2)) AS total_revenue, "
    f"count(*) AS orders FROM fct_sales_orders WHERE order_date >= {_LM_START} AND order_date < {_LM_END}")
ORACLE["q_customers_by_tier"] = query(
    "SELECT loyalty_segment_description AS loyalty_tier, count(*) AS customers FROM dim_customers GROUP BY 1")
ORACLE["q_top_region"] = query(
    "SELECT c.region, count(*) AS orders FROM (SELECT customer_id FROM fct_sales_orders WHERE "
    f"{_W6}) o JOIN dim_customers c ON c.customer_id = o.customer_id GROUP BY 1 "
    "ORDER BY orders DESC, region ASC NULLS LAST LIMIT 1")
ORACLE["q_monthly_revenue"] = query(
    "SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, "
    "CAST(sum(total_revenue) AS DECIMAL(38,2)) AS monthly_revenue, count(*) AS orders "
    f"FROM fct_sales_orders WHERE {_W12} GROUP BY 1")
ORACLE["q_at_risk_accounts"] = query(
    "SELECT b2b_customer_id, company_name, region, open_tickets, return_rate, health_score FROM dim_b2b_customers "
    "WHERE account_health_status = 'at_risk'")
ORACLE["q_top10_ltv"] = query(
    "SELECT customer_id, customer_name, region, lifetime_revenue, total_orders FROM loyalty_campaign_targets "
    "ORDER BY lifetime_revenue DESC NULLS LAST, customer_id ASC LIMIT 10")
ORACLE["q_revenue_by_category"] = query(
    "SELECT product_category, CAST(sum(line_revenue) AS DECIMAL(38,2)) AS revenue, CAST(sum(quantity) AS BIGINT) AS units "
    "FROM fct_order_lines GROUP BY 1")
ORACLE["q_latest_orders"] = query(
    "SELECT order_id, customer_id, order_timestamp, total_revenue FROM fct_sales_orders "
    "ORDER BY order_timestamp DESC NULLS LAST, order_id DESC LIMIT 10")
ORACLE["q_latest_synced"] = query(
    "SELECT o_orderkey AS id, o_custkey AS customer_id, "
    "CASE WHEN o_orderkey % 89 = 0 THEN 0 ELSE date_diff('second', TIMESTAMP '1970-01-01', o_orderdate) END "
    f"AS order_datetime, {SYNCED} - (o_orderkey % 720) * INTERVAL 1 MINUTE "
    "AS _fivetran_synced FROM orders ORDER BY _fivetran_synced DESC, id DESC LIMIT 10")
ORACLE["q_spot_checks"] = query(
    "SELECT count(DISTINCT customer_id) AS distinct_customers, count(*) AS orders, "
    "CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_revenue FROM fct_sales_orders")
ORACLE["q_scd2_versions"] = query(
    "SELECT customer_id, count(*) AS versions FROM raw_customers GROUP BY 1 HAVING count(*) > 1")
ORACLE["q_valid_to_histogram"] = query(
    "SELECT valid_to, count(*) AS versions FROM raw_customers GROUP BY 1")
ORACLE["q_ltv_segment"] = query(
    f"SELECT CASE WHEN ltv >= 500 THEN 'high_value' WHEN ltv >= 100 THEN 'mid_value' ELSE 'low_value' END "
    "AS ltv_segment, count(*) AS customers, CAST(sum(ltv) AS DECIMAL(38,2)) AS lifetime_revenue "
    "FROM (SELECT coalesce(lifetime_revenue, 0) AS ltv FROM loyalty_campaign_targets) GROUP BY 1")
ORACLE["q_price_tier"] = (
    "SELECT CASE WHEN price >= 1000 THEN 'premium' WHEN price >= 200 THEN 'mid_range' ELSE 'budget' END AS price_tier, "
    "count(*) AS products FROM (SELECT CAST(p_retailprice AS DECIMAL(12,2)) * CASE p_partkey % 4 WHEN 0 THEN 0.1 "
    "WHEN 1 THEN 0.5 WHEN 2 THEN 1.5 ELSE 1.0 END AS price FROM part WHERE p_partkey % 11 <> 0) GROUP BY 1")
ORACLE["q_favourite_category"] = query(
    "SELECT customer_id, product_category AS favourite_category, CAST(rev AS DECIMAL(38,2)) AS category_revenue "
    "FROM (SELECT customer_id, product_category, rev, row_number() OVER (PARTITION BY customer_id "
    "ORDER BY rev DESC, product_category ASC) AS rn FROM (SELECT customer_id, product_category, "
    "sum(line_revenue) AS rev FROM fct_order_lines WHERE product_category IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1")
ORACLE["q_order_measures"] = query(
    "SELECT channel, total_revenue, recognised_revenue, returned_revenue, orders, "
    f"{average('total_revenue', 'n')} AS avg_order_value FROM (SELECT channel, "
    "CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(sum(net_revenue) AS DECIMAL(38,2)) AS "
    "recognised_revenue, CAST(sum(revenue - net_revenue) AS DECIMAL(38,2)) AS returned_revenue, count(*) AS orders, "
    "count(revenue) AS n FROM consolidated_revenue GROUP BY 1)")
ORACLE["q_product_measures"] = query(
    "SELECT product_category, CAST(sum(line_revenue) AS DECIMAL(38,2)) AS net_revenue, CAST(sum(quantity) AS BIGINT) AS net_units, "
    "count(DISTINCT customer_id) AS distinct_buyers FROM fct_order_lines GROUP BY 1")
ORACLE["q_cancellation_kpis"] = query(
    "SELECT region, cancelled_orders, orders, CAST(cancelled_orders AS DOUBLE) / CAST(orders AS DOUBLE) "
    "AS cancellation_rate, CASE WHEN accounts > 0 THEN CAST(rev AS DOUBLE) / CAST(accounts AS DOUBLE) END "
    "AS revenue_per_account FROM (SELECT a.region, CAST(count_if(o.is_cancelled_or_returned) AS BIGINT) AS cancelled_orders, "
    "count(*) AS orders, sum(o.amount) AS rev, count(DISTINCT o.b2b_customer_id) AS accounts FROM fct_b2b_orders o "
    "LEFT JOIN dim_b2b_customers a ON a.b2b_customer_id = o.b2b_customer_id GROUP BY 1)")

from ledgerloom.plans.registry import SQL_TEXT_EXAMPLE  # noqa: E402

ORACLE["sql_text"] = query(SQL_TEXT_EXAMPLE)
