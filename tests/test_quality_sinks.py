import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quality import ColumnTest, enforce_contract, relationship_tests, single_pass_tests, unique_tests
from ledgerloom.sources.sinks import ContractViolation, read_table, write_contracted


class FakeProject:
    def __init__(self, spark, models):
        self.spark, self.models = spark, models

    def __getitem__(self, name):
        return self.models[name]

    def model(self, name, columns):
        return self.models[name].select(*dict.fromkeys(columns))


def test_single_pass_rules_one_bad_row_each(spark):
    m = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "zz", 5), (4, "a", -1), (5, None, None)],
                              "id long, cat string, qty long")
    p = FakeProject(spark, {"m": m})
    tests = [ColumnTest("m", "cat", "not_null"), ColumnTest("m", "cat", "accepted_values", values=("a",)),
             ColumnTest("m", "qty", "between", lo=0, hi=10)]
    got = {(r.column_name, r.test_name): r.failures for r in single_pass_tests(p, tests).collect()}
    # nulls pass accepted_values and between
    assert got == {("cat", "not_null"): 2, ("cat", "accepted_values"): 1, ("qty", "between"): 1}


def test_unique_and_relationships(spark):
    child = spark.createDataFrame([(1, "x"), (1, "y"), (2, "q"), (3, None)], "id long, parent string")
    parent = spark.createDataFrame([("x",), ("y",)], "pid string")
    p = FakeProject(spark, {"c": child, "p": parent})
    u = unique_tests(p, [ColumnTest("c", "id", "unique")]).first()
    r = relationship_tests(p, [ColumnTest("c", "parent", "relationships", parent=("p", "pid"))]).first()
    assert (u.failures, r.failures) == (1, 1)


def test_contract_enforced_write(spark, tmp_path):
    rows = [("R", dt.date(2020, 1, 1), Decimal("1.00"), 1, "n")]
    df = spark.createDataFrame(rows, "region string, target_month date, revenue_target decimal(38,6), "
                                     "order_target int, notes string")
    rep = write_contracted(df, "dim_regional_sales_targets", str(tmp_path / "t"))
    back = read_table(spark, str(tmp_path / "t"))
    assert rep["violations"] == {}
    assert all(f.metadata.get("comment") for f in back.schema.fields) and back.schema[0].metadata["table_comment"]
    assert [f.dataType.simpleString() for f in back.schema.fields] == [
        "string", "date", "decimal(18,2)", "bigint", "string"]
    with pytest.raises(ValueError):
        enforce_contract(df.drop("notes"), "dim_regional_sales_targets")
    bad = spark.createDataFrame([(None, dt.date(2020, 1, 1), Decimal("1.00"), 1, "n")], df.schema)
    with pytest.raises(ContractViolation):
        write_contracted(bad, "dim_regional_sales_targets", str(tmp_path / "bad"))
    told = frozenset({"dim_regional_sales_targets.region"})
    assert write_contracted(bad, "dim_regional_sales_targets", str(tmp_path / "told"), told)["violations"] == {"region": 1}


def test_primary_key_gate(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", dt.date(2020, 1, 1), Decimal(1), "s", False, None)] * 2,
                               "order_id long, b2b_customer_id string, order_date date, amount decimal(18,2), status string, "
                               "is_cancelled_or_returned boolean, cancel_return_reason string")
    with pytest.raises(ContractViolation, match="order_id"):
        write_contracted(df, "fct_b2b_orders", str(tmp_path / "t"))


def test_every_published_column_is_described(spark):
    from ledgerloom.plans.project import PUBLIC_MARTS, TABLE_MODELS, RetailProject
    from ledgerloom.sources.descriptions import COLUMN_TEXT, TABLE_TEXT
    from tests.conftest import SF0001
    p = RetailProject(spark, SF0001)
    for name in [*PUBLIC_MARTS, *(t for step in TABLE_MODELS for t in step)]:
        assert name in TABLE_TEXT and not [c for c in p[name].columns if c not in COLUMN_TEXT], name


def test_failing_rows_and_values(spark):
    from ledgerloom.operators.quality import failing_rows, failing_values
    child = spark.createDataFrame([(1, "x"), (1, "y"), (2, "q"), (3, None), (None, "q")], "id long, parent string")
    p = FakeProject(spark, {"c": child, "p": spark.createDataFrame([("x",), ("y",), ("y",)], "pid string")})
    tests = [ColumnTest("c", "id", "unique"), ColumnTest("c", "parent", "relationships", parent=("p", "pid")),
             ColumnTest("c", "parent", "not_null"), ColumnTest("c", "id", "between", hi=2)]
    rows = [sorted((tuple(r) for r in failing_rows(p, t).collect()), key=str) for t in tests]
    assert rows == [[(1, "x"), (1, "y")], [(2, "q"), (None, "q")], [(3, None)], [(3, None)]]
    got = {tuple(r)[1:] for r in failing_values(p, tests).collect()}
    assert got == {("id", "unique", "1", 2), ("parent", "relationships", "q", 2), ("parent", "not_null", None, 1),
                   ("id", "between", "3", 1)}


def test_reconciliation_finds_a_seeded_mismatch(spark):
    from ledgerloom.operators.quality import revenue_reconciliation
    lines = spark.createDataFrame([(1, Decimal("5.00")), (1, Decimal("5.00")), (2, Decimal("1.00")), (3, Decimal("1.00"))],
                                  "order_id long, line_revenue decimal(18,2)")
    orders = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("1.02")), (3, Decimal("1.01")), (4, Decimal("0.00"))],
                                   "order_id long, total_revenue decimal(18,2)")
    p = FakeProject(spark, {"fct_order_lines": lines, "fct_sales_orders": orders})
    assert [(r.order_id, r.diff) for r in revenue_reconciliation(p).collect()] == [(2, Decimal("0.02"))]


def test_fact_written_by_month(spark, tmp_path):
    rows = [(1, dt.date(2020, 1, 5)), (2, dt.date(2020, 2, 7)), (3, None)]
    df = spark.createDataFrame(rows, "order_id long, order_date date")
    from ledgerloom.sources.sinks import write_table
    write_table(df, str(tmp_path / "f"), month_of="order_date")
    parts = sorted(p for p in os.listdir(tmp_path / "f") if p.startswith("p_month="))
    assert parts == ["p_month=2020-01-01", "p_month=2020-02-01", "p_month=__HIVE_DEFAULT_PARTITION__"]
    assert sorted(r.order_id for r in read_table(spark, str(tmp_path / "f")).collect()) == [1, 2, 3]


def test_combine_on_keys_null_keys_and_single_rows(spark):
    from ledgerloom.operators.combine import combine_on_keys
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a long")
    b = spark.createDataFrame([("x", 10.0), (None, 20.0), ("y", 30.0)], "k string, b double")
    got = {r.k: (r.a, r.b) for r in combine_on_keys([a, b], ["k"]).collect()}
    assert got == {"x": (1, 10.0), None: (2, 20.0), "y": (None, 30.0)}
    one = combine_on_keys([a.agg(F.count("*").alias("n")), b.agg(F.sum("b").alias("s"))])
    assert tuple(one.first()) == (2, 60.0)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_failing_values_derive_a_model_once_for_all_its_rules(spark):
    from ledgerloom.operators.quality import ColumnTest, failing_values

    class Counted(FakeProject):
        asked = []

        def model(self, name, columns=None):
            self.asked.append(name)
            return super().model(name, columns)

    rows = [(-1.5, "x", -2), (-1.5, "y", 7), (None, "x", None), (3.0, None, -2), (float("nan"), "ok", 200)]
    df = spark.createDataFrame(rows, "a double, b string, c long")
    tests = [ColumnTest("m", "a", "between", lo=0, hi=100), ColumnTest("m", "b", "accepted_values", values=("ok", "y")),
             ColumnTest("m", "c", "between", lo=0), ColumnTest("m", "c", "between", hi=100), ColumnTest("m", "a", "not_null")]
    p = Counted(spark, {"m": df})
    got = sorted((tuple(r) for r in failing_values(p, tests).collect()), key=str)
    assert got == sorted([("m", "a", "between", "-1.5", 2), ("m", "a", "between", "NaN", 1), ("m", "b", "accepted_values", "x", 2),
                          ("m", "c", "between", "-2", 2), ("m", "c", "between", "200", 1), ("m", "a", "not_null", None, 1)], key=str)
    assert p.asked == ["m"]
