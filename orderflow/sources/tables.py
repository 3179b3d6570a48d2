"""Driver tables -> the pipeline's record shapes (ORDER, MESSAGE, ACK, OUTCOME, LOG).

The driver's Parquet tables stand in for the pipeline's inputs; every view
here is a projection / aggregation of them, so the work grows with the data.
All timestamps stay ``timestamp_ntz`` (as stored) so results do not depend on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.codec import encode_order_json
from orderflow.functions.routing import add_sha1_shard
from orderflow.schemas import EVENT_TYPE, NUM_SHARDS

def _epoch_ntz() -> F.Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Column pruning and filters reach the Parquet scan; how many
    tasks read it is up to ``spark.sql.files.maxPartitionBytes`` and its row groups."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz_millis(col) -> F.Column:
    """Epoch millis of a timestamp_ntz, independent of the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), c)


def ntz_micros(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), c)


def ntz_from_millis(col) -> F.Column:
    """timestamp_ntz from epoch millis, independent of the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", c, _epoch_ntz())


def ntz_from_micros(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MICROSECOND", c, _epoch_ntz())


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part ids per order, sorted: ``(l_orderkey, items)``.

    Rows are dealt by order first, as two numbers: an order has few lines, so combining arrays before the
    shuffle shrinks nothing and costs a sort in every task. An order's set is one row in any case.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").repartition("l_orderkey")
    names = F.transform(F.collect_set("l_partkey"), lambda p: F.concat(F.lit("PART-"), p.cast("string")))
    return li.groupBy("l_orderkey").agg(F.sort_array(names).alias("items"))


def orders_view(spark: SparkSession, sf_dir: str, n_shards: int = NUM_SHARDS,
                with_items: bool = True) -> DataFrame:
    """ORDER records with event time and shard (``ord``).

    ``with_items=False`` leaves out the item arrays (and so the line-item
    aggregation and join) for consumers that never read them.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    order_id = F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))
    if with_items:
        items = order_items(spark, sf_dir)
        o = o.join(items, o.o_orderkey == items.l_orderkey, "left")
    else:
        o = o.withColumn("items", F.lit(None).cast("array<string>"))
    return (o
            .select(order_id.alias("order_id"),
                    F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
                    F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
                    F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items"),
                    F.col("o_orderdate").alias("ts"),
                    F.col("o_orderkey"))
            .transform(lambda d: add_sha1_shard(d, "order_id", n_shards)))


def messages_view(spark: SparkSession, sf_dir: str, n_shards: int = NUM_SHARDS, with_items: bool = True) -> DataFrame:
    """MESSAGE envelopes (``msg``): ids ``<millis>-<seq>`` numbered inside (shard, millis).

    Ids are given to rows without their items, which join afterwards: the scan that numbers the rows
    neither sorts nor stores the arrays. ``with_items=False`` leaves them out, for consumers of ids and
    times only.
    """
    from orderflow.operators.windows import assign_msg_ids
    m = assign_msg_ids(orders_view(spark, sf_dir, n_shards, with_items=False), ts="ts", tiebreak="o_orderkey")
    if with_items:
        items = order_items(spark, sf_dir)
        m = m.withColumnRenamed("items", "none").join(items, m.o_orderkey == items.l_orderkey, "left") \
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return m.select(
        "order_id", "customer_id", "amount", "items", "ts", "o_orderkey", "shard",
        "msg_seq", "msg_id",
        F.lit(EVENT_TYPE).alias("type"),
        encode_order_json("order_id", "customer_id", "amount", "items").alias("data"),
        F.concat(F.floor(ntz_millis("ts") / 1000).cast("string"), F.lit("."),
                 F.lpad(F.pmod(ntz_millis("ts"), F.lit(1000)).cast("string"), 3, "0")).alias("timestamp"))


def outcomes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OUTCOME rows of dependency calls, one per event."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ok = F.col("event_type") != "error"
    return e.select(
        F.concat(F.lit("shard-"), (F.col("user_id") % 4).cast("string")).alias("name"),
        (F.col("user_id") % 4).cast("int").alias("shard"),
        F.col("ts"), F.col("event_id"), ok.alias("ok"),
        F.when(ok, F.lit(None).cast("string"))
         .when(F.col("event_id") % 2 == 0, F.lit("circuit_open"))
         .otherwise(F.lit("retries_exhausted")).alias("reason"),
        (F.col("value") / 100).alias("latency_s"))


def attempts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry attempts: three consecutive events form one operation."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    ok = F.col("event_type") != "error"
    return e.select(
        (F.col("event_id") / 3).cast("long").alias("op_id"),
        (F.col("event_id") % 3 + 1).cast("int").alias("attempt"),
        F.col("ts"), ok.alias("ok"),
        F.when(~ok, F.lit("TimeoutError")).alias("error"))


def acks_view(spark: SparkSession, sf_dir: str, n_shards: int = NUM_SHARDS) -> DataFrame:
    """ACK marks ``(shard, order_id, ack_ts)``: one per successful event."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    oid = F.concat(F.lit("ORD-"), F.col("event_id").cast("string"))
    return add_sha1_shard(e.filter(F.col("event_type") != "error")
                          .select(oid.alias("order_id"), F.col("ts").alias("ack_ts")),
                          "order_id", n_shards).select("shard", "order_id", "ack_ts")


def ack_log_view(spark: SparkSession, sf_dir: str, n_shards: int = NUM_SHARDS) -> DataFrame:
    """Repeated ack writes (one per user event): the same order is acked many times."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    oid = F.concat(F.lit("ORD-"), (F.col("user_id") + 1).cast("string"))
    return add_sha1_shard(e.filter(F.col("event_type") != "error")
                          .select(oid.alias("order_id"), F.col("ts").alias("ack_ts"), F.col("event_id")),
                          "order_id", n_shards).select("shard", "order_id", "ack_ts", "event_id")


def malformed_messages_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages where some payloads are damaged, chosen by ``o_orderkey % 10``:
    0 cut JSON, 1 no ``items``, 2 text ``amount``, 3 no ``order_id``."""
    m = messages_view(spark, sf_dir)
    k = F.col("o_orderkey") % 10
    amt = F.col("amount").cast("double")
    data = (F.when(k == 0, F.substring("data", 1, 20))
            .when(k == 1, F.to_json(F.struct("order_id", "customer_id", amt.alias("amount"))))
            .when(k == 2, F.to_json(F.struct("order_id", "customer_id",
                                             F.col("amount").cast("string").alias("amount"), "items")))
            .when(k == 3, F.to_json(F.struct("customer_id", amt.alias("amount"), "items")))
            .otherwise(F.col("data")))
    return m.select("shard", "msg_id", "msg_seq", "ts", "o_orderkey", "type",
                    data.alias("data"), "timestamp")


def log_records_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOG records written by the consumer for each outcome."""
    o = outcomes_view(spark, sf_dir)
    rows = F.floor(F.col("latency_s") * 100).cast("long").cast("string")
    msg = F.when(F.col("ok"), F.concat(F.lit("inserted shard="), F.col("shard").cast("string"),
                                       F.lit(" rows="), rows)) \
           .otherwise(F.concat(F.lit("db insert failed shard="), F.col("shard").cast("string"),
                               F.lit(" msgs="), rows, F.lit(" err="), F.col("reason")))
    return o.select(F.col("ts"), F.col("event_id"),
                    F.when(F.col("ok"), F.lit("INFO")).otherwise(F.lit("ERROR")).alias("level"),
                    F.lit("consumer").alias("logger"), msg.alias("msg"))


VIEWS = {
    "ord": lambda s, d: orders_view(s, d),
    "msg": lambda s, d: messages_view(s, d),
    "bad_msg": lambda s, d: malformed_messages_view(s, d),
    "outcome": lambda s, d: outcomes_view(s, d),
    "attempt": lambda s, d: attempts_view(s, d),
    "ack": lambda s, d: acks_view(s, d),
    "ack_log": lambda s, d: ack_log_view(s, d),
    "logrec": lambda s, d: log_records_view(s, d),
}


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> list[str]:
    """Expose the pipeline records as temp views for ``spark.sql`` users."""
    done = []
    for name in names or list(VIEWS):
        VIEWS[name](spark, sf_dir).createOrReplaceTempView(name)
        done.append(name)
    return done
