"""Decode, validate, split, id lists, request outcomes."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from orderflow.functions.codec import log_fields
from orderflow.operators.aggregates import audit_by_shard
from orderflow.operators.validate import classify_requests, decode_orders, parse_ids, split_malformed, validate_orders
from orderflow.operators.windows import failure_streaks, latest_ack, trailing_states


def body(**changes):
    order = {"order_id": "r-17", "customer_id": "north-3", "amount": 48.25, "items": ["rope", "lamp", "lamp"]}
    order.update(changes)
    return json.dumps({k: v for k, v in order.items() if v is not ...})


def frame(spark, datas):
    return spark.createDataFrame([(i, d) for i, d in enumerate(datas)], "i int, data string")


def errors(spark, *datas):
    return [r.errors for r in validate_orders(frame(spark, datas)).orderBy("i").collect()]


def test_each_field_is_checked_for_presence_and_type(spark):
    assert errors(spark, body(order_id=...), body(customer_id=None), body(items="rope"), body(items=[1]),
                  body(amount=True), body(order_id=17)) == [
        ["missing:order_id"], ["missing:customer_id"], ["type:items"], ["type:items"], ["type:amount"], ["type:order_id"]]
    assert errors(spark, "[]", "17", "", None, '{"order_id": "r"') == [
        ["not_object"], ["not_object"], ["invalid_json"], ["invalid_json"], ["invalid_json"]]


def test_amounts_that_money_cannot_hold(spark):
    assert errors(spark, body(amount=9_999_999_999.99), body(amount=-9_999_999_999.99), body(amount=10_000_000_000),
                  body(amount=1e300)) == [[], [], ["overflow:amount"], ["overflow:amount"]]


def test_free_orders_without_items_are_valid(spark):
    r = decode_orders(frame(spark, [body(amount=0, items=[])])).first()
    assert (r.errors, r.amount, r.items) == ([], 0.0, [])


def test_split_keeps_every_row_once(spark):
    good, bad = split_malformed(frame(spark, [body(), "<order/>", body(amount="48"), body(order_id="r-18")]))
    assert [r.order_id for r in good.orderBy("i").collect()] == ["r-17", "r-18"]
    assert {(r.i, r.reason) for r in bad.collect()} == {(1, "invalid_json"), (2, "type:amount")}


def test_id_lists_drop_white_space_of_any_kind(spark):
    df = spark.createDataFrame([("a,\tb\n, \t,c",), (" \r\n , \x0b",), ("p,q,p,q",), (None,)], "ids string")
    rows = parse_ids(df, "ids", max_ids=3).collect()
    assert rows[0].id_list == ["a", "b", "c"] and rows[0].status == 200
    assert (rows[1].status, rows[1].n_ids) == (400, 0)
    assert (rows[2].status, rows[2].n_ids) == (400, 4)


def test_request_outcomes(spark):
    df = spark.createDataFrame([(body(), None), ("{}", None), (None, "x,y"), (None, " , "), (None, None), (None, "1,2,3")],
                               "data string, ids string")
    assert [r.status_code for r in classify_requests(df, max_ids=2).collect()] == [200, 422, 200, 400, 400, 400]


def test_log_fields_keep_the_last_of_a_repeated_key(spark):
    df = spark.createDataFrame([("retry n=1 k=v n=2",), ("no pairs",), (None,)], "msg string")
    assert [r.f for r in df.select(log_fields("msg").alias("f")).collect()] == [{"n": "2", "k": "v"}, {}, None]


def test_latest_ack_orders_by_time_then_any_id(spark):
    big = 2 ** 63 - 1
    df = spark.createDataFrame([("o", 1_000_001, 1), ("o", 1_000_000, big), ("p", 5, -big), ("p", 5, big), ("p", 5, 0)],
                               "order_id string, us long, id long").withColumn("ack_ts", F.timestamp_micros("us"))
    assert {r.order_id: r.id for r in latest_ack(df, tiebreak="id").collect()} == {"o": 1, "p": big}


def test_average_is_rounded_once(spark):
    # 0.0049999975 on average: a first rounding to fewer digits would give a whole cent
    df = spark.range(4_000_000).select(F.lit(0).alias("shard"),
                                       F.when(F.col("id") < 1_999_999, F.lit("0.01")).otherwise("0.00").cast("decimal(12,2)").alias("amount"))
    assert audit_by_shard(df).first().avg_amount == Decimal("0.00")
    half = spark.createDataFrame([(1, Decimal("0.01")), (1, Decimal("0.00")), (2, Decimal("-0.01")), (2, Decimal("0.00")), (3, None)],
                                 "shard int, amount decimal(12,2)")
    assert [r.avg_amount for r in audit_by_shard(half).collect()] == [Decimal("0.01"), Decimal("-0.01"), None]


def test_rejected_calls_are_neither_failures_nor_successes(spark):
    rows = [(1, "db", False, "retries_exhausted"), (2, "db", False, "circuit_open"), (3, "db", False, "retries_exhausted"),
            (4, "db", True, None), (5, "db", False, "circuit_open"), (6, "cache", False, "retries_exhausted"),
            (7, "cache", False, "retries_exhausted"), (8, "cache", False, "retries_exhausted")]
    df = spark.createDataFrame(rows, "event_id int, name string, ok boolean, reason string") \
        .withColumn("ts", F.timestamp_seconds("event_id"))
    assert sorted((r.name, r.failures) for r in failure_streaks(df).collect()) == [("cache", 3), ("db", 2)]
    for at, state in ((20, "open"), (38, "half_open")):
        as_of = spark.range(1).select(F.timestamp_seconds(F.lit(at)).alias("as_of"))
        assert {r.name: r.state for r in trailing_states(df, as_of).collect()} == {"db": "closed", "cache": state}
