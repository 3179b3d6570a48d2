"""Ack status under a changed shard count (J-01) and at each request's own time (T-08)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderflow.functions.routing import add_shard_at, check_history, sha1_shard
from orderflow.operators.aggregates import consumer_totals
from orderflow.operators.joins import ack_status, ack_status_as_of, ack_status_resharded
from orderflow.operators.validate import parse_ids
from orderflow.operators.windows import live_ack_rows
from orderflow.sources.ledger import retain_latest, retention_loss

T0 = dt.datetime(2024, 1, 1)
HISTORY = [(None, 4), (T0, 8), (T0 + dt.timedelta(days=1), 7)]


def test_history_is_checked():
    for bad in ([], [(T0, 4)], [(None, 4), (None, 8)], [(None, 4), (T0, 8), (T0, 9)], [(None, 4), (T0, 8), (dt.datetime(2020, 1, 1), 9)]):
        with pytest.raises(ValueError):
            check_history(bad)


def test_orders_are_found_where_they_were_written(spark):
    rows = [(f"o{k}", T0 + dt.timedelta(hours=12 * (k % 5 - 1)) if k % 7 else None) for k in range(60)]
    orders = spark.createDataFrame(rows, "order_id string, ts timestamp_ntz")
    placed = add_shard_at(orders, "order_id", "ts", HISTORY)
    for r in placed.select("*", sha1_shard("order_id", 4).alias("s4"), sha1_shard("order_id", 8).alias("s8"),
                           sha1_shard("order_id", 7).alias("s7")).collect():
        n = "s7" if r.ts is None or r.ts >= HISTORY[2][0] else "s8" if r.ts >= T0 else "s4"
        assert r.shard == r[n]
    acked = placed.filter(F.substring("order_id", 2, 9).cast("int") % 2 == 0).select("shard", "order_id", F.lit(T0).alias("ack_ts"))
    req = orders.select(F.lit("r").alias("request_id"), "order_id", "ts")
    want = {o: "acked" if int(o[1:]) % 2 == 0 else "pending" for o, _ in rows}
    where = {r.order_id: r.shard for r in placed.collect()}
    newest = {r.order_id: r.s for r in orders.select("order_id", sha1_shard("order_id", 7).alias("s")).collect()}
    anywhere = ack_status_resharded(req, acked.unionByName(acked), HISTORY).collect()   # a mark twice is one mark
    assert {r.order_id: r.status for r in anywhere} == want and len(anywhere) == len(rows)
    assert all(r.shard == (where if r.status == "acked" else newest)[r.order_id] for r in anywhere)
    timed = ack_status_resharded(req, acked, HISTORY, at="ts").collect()
    assert {r.order_id: (r.status, r.shard) for r in timed} == {o: (want[o], where[o]) for o, _ in rows}
    same = ack_status_resharded(req, acked, [(None, 4)]).select("order_id", "status").collect()
    assert sorted(map(str, same)) == sorted(map(str, ack_status(req, acked, 4).select("order_id", "status").collect()))


def test_status_at_each_requests_time_equals_one_scalar_time(spark):
    r = random.Random(4)
    acks = spark.createDataFrame([(r.randrange(2), f"o{r.randrange(6)}", T0 + dt.timedelta(seconds=r.randrange(4000))) for _ in range(60)],
                                 "x int, order_id string, ack_ts timestamp_ntz").withColumn("shard", sha1_shard("order_id", 2))
    acks = acks.select("shard", "order_id", "ack_ts")
    times = [T0 + dt.timedelta(seconds=s) for s in (-5, 0, 700, 1500, 3999, 4050, 9000)] + [acks.agg(F.min("ack_ts")).first()[0]]
    asked = [(f"r{k}", f"o{o}", t) for k, t in enumerate(times) for o in range(7)] + [("none", "o1", None)]
    req = spark.createDataFrame(asked, "request_id string, order_id string, as_of timestamp_ntz")
    got = {(x.request_id, x.order_id): x.status for x in ack_status_as_of(req, acks, 2, 90).collect()}
    assert len(got) == len(asked) and got[("none", "o1")] == "pending"
    for k, t in enumerate(times):
        live = live_ack_rows(acks, F.lit(t), 90)
        one = ack_status(req.filter(F.col("request_id") == f"r{k}"), live, 2)
        assert {(x.request_id, x.order_id): x.status for x in one.collect()} == {q: s for q, s in got.items() if q[0] == f"r{k}"}
    assert ack_status_as_of(req.limit(0), acks, 2, 90).count() == 0
    assert {x.status for x in ack_status_as_of(req, acks.limit(0), 2, 90).collect()} == {"pending"}


def test_retention_counts_rows_that_repeat_an_id(spark):
    rows = [(0, "a", 1, 0), (0, "a", 1, 0), (0, "b", 2, 0), (1, "c", 5, 0), (2, "d", None, 0), (2, "e", 7, 0)]
    df = spark.createDataFrame(rows, "shard int, order_id string, msg_ms long, msg_seq long")
    none = spark.createDataFrame([], "shard int, order_id string, ack_ts timestamp")
    lost = {r.shard: (r.removed, r.removed_unacked) for r in retention_loss(df, none, 2).collect()}
    assert lost == {0: (1, 1)}
    lost = {r.shard: r.removed for r in retention_loss(df, none, 1).collect()}
    assert lost == {0: 2, 2: 1}
    for n in (1, 2, 3):
        kept = {r.shard: r["count"] for r in retain_latest(df, n).groupBy("shard").count().collect()}
        assert kept == {0: min(n, 3), 1: 1, 2: min(n, 2)}
    assert [r.order_id for r in retain_latest(df, 1).filter("shard = 2").collect()] == ["e"]


def test_blanks_around_ids(spark):
    blanks = [" ", "　", "\x1c", "\x1f", "\x85", " ", " ", "\t", "\x0b"]
    text = ",".join(f"{b}id{k}{b}{b}" for k, b in enumerate(blanks)) + ",　,\x1c,"
    got = parse_ids(spark.createDataFrame([(text,)], "ids string")).first()
    assert got.id_list == [x.strip() for x in text.split(",") if x.strip()] == [f"id{k}" for k in range(len(blanks))]


def test_consumer_totals_of_all_inputs(spark):
    outcomes = spark.createDataFrame([(0, True, None), (0, False, "circuit_open"), (1, False, "retries_exhausted")],
                                     "shard int, ok boolean, reason string")
    acks = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c")], "shard int, order_id string")
    xacks = spark.createDataFrame([(0, False), (1, True)], "shard int, ok boolean")
    got = {r.shard: tuple(r)[1:] for r in consumer_totals(outcomes, F.lit(5), acks, xacks).collect()}
    assert got == {0: (5, 1, 1, 0, 2, 1), 1: (0, 0, 0, 1, 0, 0), 2: (0, 0, 0, 0, 1, 0)}
    assert {r.shard: r.xack_failed for r in consumer_totals(outcomes).collect()} == {0: 0, 1: 0}
