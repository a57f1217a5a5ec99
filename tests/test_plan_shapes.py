"""Plan properties the design relies on at scale."""

from pyspark.sql import functions as F

from ledgerloom.operators.lines import int_order_items
from ledgerloom.operators.marts import fct_sales_orders
from ledgerloom.operators.staging import stg_sales_orders
from ledgerloom.operators.topn import top1_per_key
from tests.test_lines import _raw


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_revenue_is_map_only(spark):
    plan = _plan(fct_sales_orders(int_order_items(stg_sales_orders(_raw(spark)))))
    assert "Exchange" not in plan and "Generate" not in plan and "Join" not in plan


def test_top1_aggregates_partially_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = _plan(top1_per_key(df, ["k"], [("v", True)]))
    assert "partial_max" in plan
    assert plan.index("partial_max") > plan.index("Exchange")  # partial step sits below the exchange


def test_soft_delete_filter_reaches_the_scan(spark, tmp_path):
    from ledgerloom.operators.staging import stg_ret_tickets
    rows = [(1, "C1", "billing", "open", None, True, None), (2, "C2", "general", "open", None, None, None)]
    raw = spark.createDataFrame(rows, "id long, ticket_user_id string, issue_type string, status string, "
                                      "created_at timestamp_ntz, _fivetran_deleted boolean, "
                                      "_fivetran_synced timestamp_ntz")
    raw.write.parquet(str(tmp_path / "t"))
    plan = _plan(stg_ret_tickets(spark.read.parquet(str(tmp_path / "t"))))
    assert "PushedFilters: [Or(IsNull(_fivetran_deleted)" in plan


def test_window_on_published_fact_prunes_month_folders(spark, tmp_path):
    import datetime as dt

    from ledgerloom.plans.project import RetailProject
    from ledgerloom.sources.sinks import new_run, publish_run, write_table
    root = f"file://{tmp_path}"
    rows = [(i, dt.date(2020, 1 + i % 12, 1 + i % 28)) for i in range(240)]
    df = spark.createDataFrame(rows, "order_id long, order_date date")
    run = new_run(root)
    write_table(df, run.path("published", "fct_b2b_orders"), month_of="order_date")
    run.tables["published"].append("fct_b2b_orders")
    publish_run(spark, run)
    p = RetailProject(spark, "/nonexistent", root=root)
    w = p.window("fct_b2b_orders", "order_date", F.lit(dt.date(2020, 3, 15)), F.lit(dt.date(2020, 5, 1)))
    assert w.columns == ["order_id", "order_date"]
    got = sorted(r.order_id for r in w.collect())
    assert got == sorted(i for i, d in rows if dt.date(2020, 3, 15) <= d < dt.date(2020, 5, 1))
    plan = _plan(w)
    assert "PartitionFilters: [isnotnull(p_month" in plan and "p_month" in plan.split("PartitionFilters:")[1][:200]


def test_aggregates_come_before_joins(spark):
    """Only aggregated facts reach the joins, and the two reports need no Expand."""
    from ledgerloom.plans import registry
    from tests.conftest import SF0001
    for key in ("promo_effectiveness", "regional_performance", "q_cancellation_kpis", "metric_aov", "semantic_select",
                "semantic_b2b", "q_top_region"):
        plan = _plan(registry.QUERIES[key](spark, SF0001))
        assert "Expand" not in plan, key
    joined = registry.QUERIES["metric_aov"](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    first_join = joined[joined.index("Join"):]
    assert joined.index("Aggregate") < joined.index("Join") and "Aggregate" in first_join


def test_building_a_query_runs_no_job(spark):
    from ledgerloom.plans import registry
    from tests.conftest import SF0001
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans-only", "no job may run")
    try:
        for key, fn in registry.QUERIES.items():
            fn(spark, SF0001)
        assert not tracker.getJobIdsForGroup("plans-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_each_document_is_parsed_once_per_branch(spark):
    """Four parses are written in ``strict_json``, of which one row takes one or two; filters on what is read from the
    documents add none."""
    from ledgerloom.plans import registry
    from tests.conftest import SF0001
    branches = {"order_lines": 1, "line_margin": 1, "q_favourite_category": 1, "q_revenue_by_category": 1, "q_product_measures": 1,
                "semantic_filtered": 1, "metric_filtered_mixed": 2, "metric_line_products": 2, "dq_revenue_reconciliation": 2,
                "dq_singular": 3, "dq_between": 4, "dq_failing_values": 5}
    for key, n in branches.items():
        plan = registry.QUERIES[key](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parse_json") <= 4 * n, (key, plan.count("parse_json"))


def test_grouped_lines_are_not_broadcast_by_their_size_in_the_file(spark):
    from ledgerloom.sources.retail import raw_sales_orders
    from tests.conftest import SF0001
    plan = _plan(raw_sales_orders(spark, SF0001))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_splits_and_partitions_fit_a_tasks_memory(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64MB"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32MB"
