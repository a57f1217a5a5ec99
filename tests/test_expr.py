import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions.expr import average, blank_to_null, div0, epoch_date, epoch_ts, live_rows, pct, round_ratio


def test_live_rows_keeps_false_and_null(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, _fivetran_deleted boolean")
    assert sorted(r.id for r in df.filter(live_rows()).collect()) == [2, 3]


def test_live_rows_is_pushed_to_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, _fivetran_deleted boolean")
    df.write.parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).filter(live_rows())._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(_fivetran_deleted),Not(EqualTo(_fivetran_deleted,true)))]" in plan


def test_epoch_sentinels(spark):
    df = spark.createDataFrame([(1700000000,), (0,), (None,)], "e long")
    rows = df.select(epoch_ts("e").alias("t"), epoch_date("e").alias("d")).collect()
    assert rows[0].t == dt.datetime(2023, 11, 14, 22, 13, 20) and rows[0].d == dt.date(2023, 11, 14)
    assert rows[1].t is None and rows[1].d is None
    assert rows[2].t is None and rows[2].d is None


def test_blank_to_null(spark):
    df = spark.createDataFrame([(" A ",), ("   ",), ("",), (None,)], "s string")
    assert [r.x for r in df.select(blank_to_null("s").alias("x")).collect()] == ["A", None, None, None]


def test_div0(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0), (None, None), (3, None)], "a long, b long")
    assert [r.x for r in df.select(div0("a", "b").alias("x")).collect()] == [0.5, 0.0, 0.0, None, None]


def test_round_ratio_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 16), (-1, 16), (1, 3), (2, 3), (5, 0), (None, 4)], "n long, d long")
    got = [r.x for r in df.select(pct("n", "d", 1).alias("x")).collect()]
    assert got == [6.3, -6.3, 33.3, 66.7, None, None]


def test_round_ratio_money_scales(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("8.00"))], "n decimal(18,2), d decimal(18,2)")
    r = df.select(round_ratio("n", "d", 1, 2, 2, 2).alias("x"), pct("n", "d", 1, 2, 2).alias("p")).first()
    assert r.x == 1.25 and r.p == 125.0


def test_average_is_not_rounded(spark):
    df = spark.createDataFrame([(Decimal("0.05"), 2), (Decimal("10.00"), 3), (Decimal("1.00"), 0)],
                               "s decimal(38,2), n long")
    assert [r.x for r in df.select(average("s", "n").alias("x")).collect()] == [0.025, 10 / 3, None]


def test_round_ratio_matches_decimal_half_up_property(spark):
    from decimal import ROUND_HALF_UP, Decimal as Dm
    from hypothesis import given, settings, strategies as st

    pairs = []

    @settings(max_examples=300, deadline=None)
    @given(st.integers(-10**12, 10**12), st.integers(1, 10**9), st.integers(0, 3))
    def collect(n, d, digits):
        pairs.append((n, d, digits))

    collect()
    rows = spark.createDataFrame(pairs, "n long, d long, k int")
    for digits in range(4):
        sub = rows.filter(F.col("k") == digits)
        got = sub.select("n", "d", pct("n", "d", digits).alias("x")).collect()
        for r in got:
            exp = (Dm(r.n) * 100 / Dm(r.d)).quantize(Dm(1).scaleb(-digits), rounding=ROUND_HALF_UP)
            assert r.x == float(exp), (r.n, r.d, digits, r.x, exp)
