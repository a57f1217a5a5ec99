from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions.expr import strict_json
from ledgerloom.operators.lines import int_order_items, lines_from_items, totals_from_items
from ledgerloom.operators.staging import stg_sales_orders

EDGE_DOCS = [
    (1, '[{"product_id":101,"name":"Widget A","qty":2,"price":29.99}]'),
    (2, ''), (3, None), (4, '{bad'), (5, '[]'), (6, '5'), (7, 'null'),
    (8, '{"a":{"product_id":7,"qty":1,"price":3}}'),
    (9, '[1] x'),
    (10, '[{"product_id":1,"product_id":2}]'),
    (11, '[{"product_id":11,"price":5}]'),
    (12, '[{"product_id":12,"quantity":4,"price":2.5}]'),
    (13, '[{"product_id":13,"qty":3}]'),
    (14, '[{"product_id":14,"qty":1,"unit_price":"abc"}]'),
    (15, '[{"name":"no id","qty":1,"price":9}, {"product_id":15,"qty":2,"price":1.5}]'),
    (16, '[{"product_id":"16","qty":"2","price":"2.25"}]'),
    # JSON white space around the document
    (17, '\t[{"product_id":17,"qty":1,"price":1}]\r\n'), (18, ' \n {"a":{"product_id":18}}\n\t '),
    # numbers that their types cannot hold
    (19, '[{"product_id":19,"qty":1000000000000,"price":9999999999.99},{"product_id":19,"qty":1,"price":2}]'),
    (20, '[{"product_id":99999999999999999999,"qty":1,"price":1},{"product_id":20,"qty":2,"price":1}]'),
    (21, '[{"product_id":21,"qty":99999999999999999999,"price":1}]'),
    # more than one JSON value, or something after it: no value at all, so no line and no revenue
    (22, '[{"product_id":1,"qty":2,"price":3}] [{"product_id":9,"qty":1,"price":1}]'), (23, '[1][2]'), (24, '[1]],[[2]'),
    (25, '[1]} {"b":[2]'), (26, '{"a":1} x {"b":2}'), (27, '[{"product_id":1}],[{"product_id":2}]'), (28, '1,"v":2'),
    (29, '[1]]'), (30, '{"a":1}}'), (31, '1]'), (32, '1}'), (33, '"a" "b"'), (34, '   '), (35, '"x"'), (36, 'true'),
    (37, '{"product_id":37}'),
]


def int_sales_order_lines(stg, price_scale=2):
    return lines_from_items(int_order_items(stg, price_scale))


def _raw(spark, docs=EDGE_DOCS):
    rows = [(i, i, 1, "c", 1700000000, t, 1, None, None, None, None) for i, t in docs]
    return spark.createDataFrame(
        rows, "id long, order_number long, customer_id long, customer_name string, order_datetime long, "
              "ordered_products string, number_of_line_items long, clicked_items string, promo_info string, "
              "_fivetran_deleted boolean, _fivetran_synced timestamp_ntz")


def test_lines_edge_documents(spark):
    lines = int_sales_order_lines(stg_sales_orders(_raw(spark)))
    got = {(r.order_id, r.line_number): (r.product_id, r.quantity, r.unit_price, r.line_revenue)
           for r in lines.collect()}
    assert got == {
        (1, 0): (101, 2, Decimal("29.99"), Decimal("59.98")),
        (8, 0): (7, 1, Decimal("3.00"), Decimal("3.00")),         # object: member values are flattened
        (11, 0): (11, 1, Decimal("5.00"), Decimal("5.00")),       # missing qty -> 1
        (12, 0): (12, 4, Decimal("2.50"), Decimal("10.00")),      # "quantity" key
        (13, 0): (13, 3, Decimal("0.00"), Decimal("0.00")),       # missing price -> 0
        (14, 0): (14, 1, Decimal("0.00"), Decimal("0.00")),       # non-numeric price text -> 0
        (15, 1): (15, 2, Decimal("1.50"), Decimal("3.00")),       # element without product id dropped
        (16, 0): (16, 2, Decimal("2.25"), Decimal("4.50")),       # numeric text is read as a number
        (17, 0): (17, 1, Decimal("1.00"), Decimal("1.00")), (18, 0): (18, 1, Decimal("0.00"), Decimal("0.00")),
        (19, 0): (19, 10**12, Decimal("9999999999.99"), None),    # revenue beyond its type: null, the job goes on
        (19, 1): (19, 1, Decimal("2.00"), Decimal("2.00")),
        (20, 1): (20, 2, Decimal("1.00"), Decimal("2.00")),       # product id beyond BIGINT: dropped, also in the totals
        (21, 0): (21, None, Decimal("1.00"), None),
    }


def test_strict_json_guard(spark):
    s = stg_sales_orders(_raw(spark)).select("order_id", F.col("ordered_products_json").isNotNull().alias("ok"))
    ok = {r.order_id: r.ok for r in s.collect()}
    assert not ok[2] and not ok[3] and not ok[4]
    assert ok[6] and ok[7] and ok[35] and ok[36] and ok[37]  # scalars and JSON's null are values (without lines)
    assert not any(ok[k] for k in range(22, 35))
    assert not ok[9]          # trailing text after the JSON value is rejected
    assert not ok[10]         # duplicate keys
    assert ok[1] and ok[5] and ok[8]


def test_fold_equals_explode_then_group(spark):
    stg = stg_sales_orders(_raw(spark))
    rev, n = totals_from_items(F.col("items"))
    fold = {r.order_id: (r.rev, r.n) for r in
            int_order_items(stg).select("order_id", rev.alias("rev"), n.alias("n")).collect()}
    grouped = {r.order_id: (r.rev, r.n) for r in int_sales_order_lines(stg).groupBy("order_id").agg(
        F.coalesce(F.sum("line_revenue"), F.lit(0)).alias("rev"), F.count("*").alias("n")).collect()}
    for oid, (r, k) in fold.items():
        assert grouped.get(oid, (None, None)) == (r, k), oid


def test_unscaled_price_rounds_half_up(spark):
    raw = _raw(spark)
    lines = int_sales_order_lines(stg_sales_orders(raw), price_scale=0)
    got = {r.order_id: r.unit_price for r in lines.collect()}
    assert got[1] == Decimal("30.00") and got[12] == Decimal("3.00")


def test_items_path_equals_lateral_flatten(spark):
    """Positions and product ids against a lateral variant_explode of the documents."""
    stg = stg_sales_orders(_raw(spark))
    orders = stg.filter(F.col("ordered_products_json").isNotNull()).select("order_id", "ordered_products_json")
    flat = orders.lateralJoin(spark.tvf.variant_explode(F.col("ordered_products_json").outer())).select(
        "order_id", "pos", F.try_variant_get("value", "$.product_id", "long").alias("pid")).filter("pid is not null")
    a = sorted(tuple(r) for r in flat.collect())
    b = sorted(tuple(r) for r in int_sales_order_lines(stg).select("order_id", "line_number", "product_id").collect())
    assert a == b and len(a) == 14


def test_flat_arrays_are_the_values_that_two_parses_find(spark):
    """A text that is read by one parse is the same value, or none, as by the two that reject what follows it."""
    texts = ['[]', '[1]', '[1,]', '["a]', '["a","b"]', '[1]\n', ' [1]', '[{"a":"]"}]', '[{"a":"["}]', '[[1],[2]]', '[1 2]',
             '[{"a":1}', '{"a":[1]}', '[1]]', '[null]', '[{"a":1,"a":2}]', '[1],[2]', '["x\\u005d"]', '', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    alone = F.try_parse_json(F.concat(F.lit("["), "t", F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"v":'), "t", F.lit("}")))
    two = F.when(member.isNotNull() & F.try_variant_get(alone, "$[1]", "variant").isNull(),
                 F.try_variant_get(alone, "$[0]", "variant"))
    got = df.select("t", F.to_json(strict_json("t")).alias("one"), F.to_json(two).alias("two")).collect()
    assert [r.t for r in got if r.one != r.two] == []
    assert {r.t for r in got if r.one is not None} == {
        '[]', '[1]', '["a","b"]', '[1]\n', ' [1]', '[{"a":"]"}]', '[{"a":"["}]', '[[1],[2]]', '{"a":[1]}', '[null]', '["x\\u005d"]'}


def test_elements_of_other_kinds_are_lines_without_a_product(spark):
    docs = [(1, '[1, "x", null, [2], {"product_id":3}, {"product_id":"a","qty":{}}]'), (2, '{"b":{"product_id":4},"a":5}')]
    items = int_order_items(stg_sales_orders(_raw(spark, docs))).select("order_id", F.transform(
        "items", lambda e: F.coalesce(e["product_id"].cast("int"), F.lit(-1))).alias("ids"))
    assert {r.order_id: r.ids for r in items.collect()} == {1: [-1, -1, -1, -1, 3, -1], 2: [-1, 4]}
