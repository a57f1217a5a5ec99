import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.marts import int_current_customers
from ledgerloom.operators.rank import with_percent_rank
from ledgerloom.operators.topn import top1_per_key

D = dt.date


def _stg(spark, rows):
    # (surrogate_id, customer_id, valid_from_date, is_current, segment)
    full = [(sid, cid, f"n{sid}", None, None, None, None, None, None, None, None, None, seg, 10, None, None,
             None, None, vf, None, cur, None) for sid, cid, vf, cur, seg in rows]
    return spark.createDataFrame(full, (
        "surrogate_id long, customer_id long, customer_name string, city string, state string, region string, "
        "district string, postcode string, street string, ship_to_address string, lat double, lon double, "
        "loyalty_segment_id long, units_purchased long, unit string, customer_number string, tax_id string, "
        "tax_code string, valid_from_date date, valid_to_date date, is_current boolean, _fivetran_synced timestamp"))


def _loyalty(spark):
    return spark.createDataFrame([(1, "Bronze", 0, None, None), (3, "Gold", 500, None, None)],
                                 "loyalty_segment_id long, loyalty_segment_description string, unit_threshold long, "
                                 "valid_from date, valid_to date")


def test_scd2_resolution_cases(spark):
    rows = [
        (10, 1, D(2020, 1, 1), True, 1),                                  # one current
        (20, 2, D(2020, 1, 1), True, 1), (21, 2, D(2021, 1, 1), True, 3),  # two current, later wins
        (30, 3, D(2020, 1, 1), True, 1), (31, 3, D(2020, 1, 1), True, 3),  # tie on date: higher surrogate
        (40, 4, None, True, 1), (41, 4, D(2019, 1, 1), True, 3),          # null date loses (nulls last)
        (50, 5, None, True, 1), (51, 5, None, True, 3),                   # two null dates: surrogate
        (60, 6, D(2020, 1, 1), False, 1),                                 # only expired: no row
        (70, 7, D(2020, 1, 1), True, 9),                                  # tier without match
    ]
    out = {r.customer_id: (r.customer_name, r.loyalty_segment_description)
           for r in int_current_customers(_stg(spark, rows), _loyalty(spark)).collect()}
    assert out == {1: ("n10", "Bronze"), 2: ("n21", "Gold"), 3: ("n31", "Gold"), 4: ("n41", "Gold"),
                   5: ("n51", "Gold"), 7: ("n70", None)}


def test_top1_per_key_matches_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(50), rnd.choice([None, rnd.randrange(20)]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, v long, id long")
    got = {(r.k, r.id) for r in top1_per_key(df, ["k"], [("v", True), ("id", True)]).collect()}
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), F.col("id").desc())
    exp = {(r.k, r.id) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").collect()}
    assert got == exp


def test_percent_rank_matches_window(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.choice([None] + list(range(40)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, u long")
    got = {r.id: r.pct_rank for r in with_percent_rank(df, "u").collect()}
    w = Window.orderBy(F.col("u").desc_nulls_first())
    exp = {r.id: r.p for r in df.select("id", F.percent_rank().over(w).alias("p")).collect()}
    assert got == exp


def test_percent_rank_single_row_and_ascending(spark):
    one = spark.createDataFrame([(1, 5)], "id long, u long")
    assert with_percent_rank(one, "u").first().pct_rank == 0.0
    df = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 2)], "id long, u long")
    got = {r.id: r.pct_rank for r in with_percent_rank(df, "u", descending=False, nulls_first=False).collect()}
    assert got == {2: 0.0, 3: 1 / 3, 4: 1 / 3, 1: 1.0}


def test_percent_rank_windows_are_bounded(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 37).alias("u"))
    plan = with_percent_rank(df, "u")._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window" in x]
    # Every window is over counts of 16-bit digits (at most 65,537 in a group), never over the rows.
    assert windows and all("sum(_c#" in x for x in windows)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_percent_rank_of_a_million_values(spark, reuse):
    """The same ranks whether exchanges are reused or made again; values of both signs, ties and nulls."""
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        n = 1_000_000
        v = (F.col("id") * 7919 % n - n // 2) * 4_000_000_007
        df = spark.range(n + 500).select(F.when(F.col("id") >= n + 100, None).when(F.col("id") >= n, 0).otherwise(v).alias("u"))
        got = with_percent_rank(df, "u", descending=False, nulls_first=True)
        place = F.col("u") / 4_000_000_007 + n // 2   # 0 .. n-1; the value 0 occurs 101 times
        before = F.when(F.col("u").isNull(), 0).otherwise(400 + place + F.when(place > n // 2, 100).otherwise(0))
        wrong = got.filter(~(F.abs(F.col("pct_rank") - before / (n + 499)) < 1e-12)).count()
        assert wrong == 0 and got.count() == n + 500
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_percent_rank_extremes(spark):
    rows = [(v,) for v in (-2**63, -1, 0, 1, 65535, 65536, 2**63 - 1, None, 2**32, -2**32)]
    df = spark.createDataFrame(rows, "u long")
    for down, first in ((True, True), (False, False), (True, False)):
        got = {r.u: r.pct_rank for r in with_percent_rank(df, "u", down, first).collect()}
        order = sorted((v for v, in rows if v is not None), reverse=down)
        order = [None, *order] if first else [*order, None]
        assert got == {v: k / 9 for k, v in enumerate(order)}
    with pytest.raises(TypeError):
        with_percent_rank(df.select(F.col("u").cast("string").alias("u")), "u")


def test_scd2_resolution_property(spark):
    """int_current_customers vs a direct Python resolution on random version sets."""
    rnd = random.Random(3)
    rows, sid = [], 0
    for cid in range(300):
        for _ in range(rnd.randint(1, 4)):
            sid += 1
            vf = rnd.choice([None, D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(5))])
            rows.append((sid, cid, vf, rnd.random() < 0.7, rnd.choice([1, 3, 9])))
    out = {r.customer_id: r.customer_name for r in int_current_customers(_stg(spark, rows), _loyalty(spark)).collect()}
    exp = {}
    for cid in {r[1] for r in rows}:
        cur = [r for r in rows if r[1] == cid and r[3]]
        if cur:
            best = max(cur, key=lambda r: (r[2] is not None, r[2] or D(1, 1, 1), r[0]))
            exp[cid] = f"n{best[0]}"
    assert out == exp
