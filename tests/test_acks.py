"""Ack status, rollup and summary (cases 17, 19, 24)."""

from pyspark.sql import functions as F

from orderflow.functions.routing import sha1_shard
from orderflow.operators.aggregates import ack_rollup, ack_summary, ack_total
from orderflow.operators.joins import ack_status, pending


def acks(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "order_id string")
    return df.select(sha1_shard("order_id", 4).alias("shard"), "order_id",
                     F.current_timestamp().alias("ack_ts"))


def test_rollup_acked_pending_pct(spark):
    req = spark.createDataFrame([("r", "A"), ("r", "B"), ("r", "C")], "request_id string, order_id string")
    st = ack_status(req, acks(spark, ["A", "C"]), 4)
    r = ack_rollup(st).first()
    assert (r.total, r.acked, r.pending, r.pct_complete) == (3, 2, 1, 66.67)


def test_rollup_empty_is_zero(spark):
    req = spark.createDataFrame([], "request_id string, order_id string")
    r = ack_rollup(ack_status(req, acks(spark, ["A"]), 4)).first()
    assert r.total == 0 and r.pct_complete == 0.0


def test_summary_total_is_sum_of_shards(spark):
    a = acks(spark, [f"ORD-{i}" for i in range(100)])
    s = ack_summary(a, 4).collect()
    assert len(s) == 4 and sum(r.acked for r in s) == 100
    t = {r.shard: r.acked for r in ack_total(a).collect()}
    assert t[None] == 100


def test_summary_shows_empty_shards(spark):
    s = ack_summary(acks(spark, ["ORD-1"]), 8).collect()
    assert len(s) == 8 and sum(r.acked for r in s) == 1


def test_posted_order_not_pending_once_acked(spark):
    orders = spark.createDataFrame([("ORD-IT-1",)], "order_id string").withColumn("shard", sha1_shard("order_id", 4))
    assert pending(orders, acks(spark, ["ORD-IT-1"])).count() == 0
    assert pending(orders, acks(spark, [])).count() == 1


def test_views_for_sql_users(spark):
    from orderflow.sources.tables import register_views
    register_views(spark, "/root/testdata/sf0.001", ["ord", "ack"])
    r = spark.sql("""SELECT count(*) AS n FROM ord o
                     LEFT ANTI JOIN ack a ON o.shard = a.shard AND o.order_id = a.order_id""").first()
    assert r.n > 0
