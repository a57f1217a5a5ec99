"""What a build's writes count stands in for scans; SQL text only reads, in a session of its own."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.plans.build import STAR_TOLERATED, build
from ledgerloom.plans.project import RetailProject
from ledgerloom.plans.questions import ReadOnlyQuery, execute_sql
from ledgerloom.sources import sinks
from tests.conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('evidence')}/w"
    build(spark, SF0001, root, STAR_TOLERATED)
    return RetailProject(spark, SF0001, root=root)


@pytest.fixture(scope="module")
def scratch(spark):
    return RetailProject(spark, SF0001)


@pytest.mark.parametrize("kind", ["row_rules", "not_null", "unique", "relationships"])
def test_evidence_gives_the_results_of_scans(built, scratch, kind):
    assert _rows(quality.run_tests(built, kind)) == _rows(quality.run_tests(scratch, kind))


def test_contracts_and_freshness_from_evidence(built, scratch):
    for check in (quality.contract_check, quality.source_freshness):
        found = check(built)
        assert "FileScan" not in _plan(found), check.__name__
        assert _rows(found) == _rows(check(scratch)), check.__name__


def test_written_models_are_not_scanned_for_row_rules(built):
    for t in quality.TESTS:
        if t.test in quality.ROW_RULES and built.evidence(t.model):
            assert "FileScan" not in _plan(quality.single_pass_tests(built, [t])), t
    assert sum(bool(built.evidence(t.model)) for t in quality.TESTS) > 40


def test_lost_or_doubted_evidence_is_a_scan(spark, tmp_path, monkeypatch):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    measures = {quality.ROWS: F.count(F.lit(1)), "nulls": F.count_if(F.col("v").isNull())}
    assert sinks.write_table(df, f"{tmp_path}/a", measures=measures) == {quality.ROWS: 100, "nulls": 10}
    # as after a repeated task: more rows were observed than written
    twice = {**measures, quality.ROWS: F.count(F.lit(1)) + 1}
    assert sinks.write_table(df, f"{tmp_path}/b", measures=twice) is None
    assert sinks.write_table(df, f"{tmp_path}/c") is None
    monkeypatch.setattr(sinks, "write_table", lambda *a, **k: sinks.read_table(spark, a[1]) and None)
    orders = spark.createDataFrame([(1, None, dt.date(2020, 1, 1), None, "s", False, None)], "order_id long, b2b_customer_id string, "
                                   "order_date date, amount decimal(18,2), status string, is_cancelled_or_returned boolean, "
                                   "cancel_return_reason string")
    orders.write.parquet(f"{tmp_path}/d")
    with pytest.raises(sinks.ContractViolation, match="b2b_customer_id"):
        sinks.write_contracted(orders, "fct_b2b_orders", f"{tmp_path}/d")


def test_one_histogram_serves_several_checks(spark):
    """``unique`` of a parent key and the reference to it read that key once."""
    class Tables:
        def __init__(self):
            self.spark = spark

        def model(self, name, columns=None):
            rows = spark.range(50) if name == "parent" else spark.range(80)
            return rows.select((F.col("id") % 40).alias("k"))

    p = Tables()
    assert quality.key_counts(p, "parent", "k") is quality.key_counts(p, "parent", "k")
    unique, ref = quality.ColumnTest("parent", "k", "unique"), quality.ColumnTest("child", "k", "relationships", parent=("parent", "k"))
    assert quality.unique_tests(p, [unique]).first().failures == 10
    assert quality.relationship_tests(p, [ref]).first().failures == 0
    both = quality.failing_values(p, [unique, ref])
    both.collect()
    assert both.count() == 10


def test_unique_tests_end_in_one_shuffle(scratch):
    tests = [t for t in quality.TESTS if t.test == "unique"]
    plan = _plan(quality.unique_tests(scratch, tests))
    assert plan.count("SinglePartition") == 0


# SQL text ---------------------------------------------------------------------------------------------------------

def test_two_projects_do_not_see_each_others_views(spark, built, scratch):
    text = "select count(*) as n, sum(total_revenue) as r from fct_sales_orders"
    a, b = execute_sql(built, text), execute_sql(scratch, text)
    assert a.collect() == b.collect()
    assert any("/runs/" in f for f in a.inputFiles()) or "published" in _plan(execute_sql(built, "select * from fct_sales_orders"))
    assert not spark.catalog.listTables()
    spark.range(1).createOrReplaceTempView("dim_customers")
    try:
        assert execute_sql(scratch, "select count(*) as n from dim_customers").first().n > 1
        assert spark.table("dim_customers").count() == 1
    finally:
        spark.catalog.dropTempView("dim_customers")


@pytest.mark.parametrize("text", [
    "drop table x", "create view v as select 1", "insert into t select 1", "with a as (select 1) insert into t select * from a",
    "from dim_customers insert into t select *", "set spark.sql.ansi.enabled=false", "show tables", "explain select 1",
    "select * from parquet.`/tmp/x`", "select reflect('java.lang.System', 'nanoTime')", "select * from nowhere",
    "select transform(region) using 'cat' from dim_customers", "cache table z as select 1", "execute immediate 'drop table x'",
    "insert overwrite directory '/tmp/x' using parquet select 1", "select (select java_method('java.lang.System', 'nanoTime'))",
    "select * from dim_customers where customer_id in (select x from elsewhere)", "begin select 1; end", "delete from dim_customers",
    "select * from identifier('dim_customers')", "with a as (select * from csv.`/tmp/x`) select * from a", "truncate table t"])
def test_only_queries_over_models_run(scratch, text):
    with pytest.raises(ReadOnlyQuery):
        execute_sql(scratch, text)


def test_queries_of_all_shapes_run(scratch):
    with pytest.raises(ParseException):
        execute_sql(scratch, "select 1; drop table t")
    found = execute_sql(scratch, """with per as (select region, count(*) as n from Dim_Customers group by region)
        select p.region, p.n, (select max(n) from per) as most from per p where exists (select 1 from fct_b2b_orders)
        and p.n in (select n from per) union all select 'x', 1, 1 order by n desc""")
    assert found.columns == ["region", "n", "most"] and found.count() > 3
    assert execute_sql(scratch, "select order_id from fct_sales_orders", max_rows=3).count() == 3
    assert execute_sql(scratch, "select 1 as one").first().one == 1
