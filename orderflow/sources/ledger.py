"""The ledger table: create, append, idempotent append, retention, reads
(S-04 .. S-08, S-12, S-13, F-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.scan import ordered_scan
from orderflow.schemas import LEDGER, LEDGER_COLUMNS, RETENTION
from orderflow.session import key_bloom, path_exists, scratch_path

LEDGER_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER.fields)


def ensure_ledger(spark: SparkSession, name: str, path: str) -> None:
    """S-06: create the ledger table if absent (idempotent), partitioned by shard."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LEDGER_DDL}) USING parquet "
              f"PARTITIONED BY (shard) LOCATION '{path}'")


def sink_ledger(df: DataFrame, path: str, partition_by: str | None = "shard") -> None:
    """S-04 / S-07: append one micro-batch in one write; ``shard`` folders allow pruning."""
    w = key_bloom(df.select(*LEDGER_COLUMNS).write.mode("append"))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def bulk_load(df: DataFrame, path: str, partition_by: str = "shard") -> None:
    """S-08: one batch write of a whole ledger (replaces what is there)."""
    key_bloom(df.select(*LEDGER_COLUMNS).write.mode("overwrite")).partitionBy(partition_by).parquet(path)


def sink_ledger_idempotent(df: DataFrame, batch_id: int, path: str, key: str = "order_id",
                           first_wins: bool = False, writer: str = "main") -> None:
    """S-05: replaying a micro-batch leaves the ledger as after its first run.

    Rows are stored under ``shard=/writer=/batch_id=`` folders and written with
    dynamic partition overwrite, so a replay replaces only its own batch. With
    ``first_wins`` an order is stored once: the earliest message of the batch,
    unless another batch stored the order already, as the key index beside the
    ledger (``<path>-keys``) tells.
    """
    from orderflow.functions.codec import msg_id_millis, msg_id_seq
    from orderflow.sources.compaction import closed_upto
    from orderflow.sources.key_index import KeyIndex
    if batch_id <= closed_upto(df.sparkSession, path, writer):
        return  # stored for good: a closed batch is never written again
    out = df.select(*LEDGER_COLUMNS)
    if first_wins:
        ordered = out.withColumn("msg_ms", msg_id_millis("msg_id")).withColumn("msg_seq", msg_id_seq("msg_id"))
        index, staged = KeyIndex(df.sparkSession, f"{path}-keys", key), scratch_path(df.sparkSession, "first-wins")
        index.unseen(ordered, writer, batch_id).select(*LEDGER_COLUMNS).write.parquet(staged)
        out = df.sparkSession.read.parquet(staged)
        index.claim(out, writer, batch_id)
    out = out.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(batch_id).cast("long"))
    key_bloom(out.write, key).mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("shard", "writer", "batch_id").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger, compacted (:mod:`orderflow.sources.compaction`) or not."""
    from orderflow.sources.compaction import read_compacted
    return read_compacted(spark, path) if path_exists(spark, f"{path}-compact/commits") else spark.read.parquet(path)


def jdbc_ledger_options(url: str, table: str = "orders", num_partitions: int = 4,
                        lower: int = 0, upper: int = 4, fetch_size: int = 10000,
                        batch_size: int = 500) -> dict[str, str]:
    """S-13: options to read the ledger back over JDBC in parallel by ``shard``
    (and to write it in ``batchsize`` round trips)."""
    return {"url": url, "dbtable": table, "partitionColumn": "shard",
            "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions), "fetchsize": str(fetch_size),
            "batchsize": str(batch_size)}


def read_ledger_jdbc(spark: SparkSession, url: str, **kw) -> DataFrame:
    """S-13: parallel JDBC read (one range of shards per task)."""
    return spark.read.format("jdbc").options(**jdbc_ledger_options(url, **kw)).load()


def _split_retained(df: DataFrame, n: int, shard: str, order: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """The newest ``n`` rows of each shard, and the others, as two filters over one written table.

    Only counts per (shard, millisecond) are ordered: they tell in which
    millisecond the n-th newest message lies and how many of that millisecond
    stay. Other rows are told by their millisecond; only the rows of the border
    millisecond are ranked. Rows that repeat an id are rows like any other.
    """
    ms, seq = order
    path = scratch_path(df.sparkSession, "retention")
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    counts = rows.groupBy(shard, ms).agg(F.count(F.lit(1)).alias("__n"))
    newer = ordered_scan(counts, [shard], [F.col(ms).desc()], sums={"__upto": F.col("__n")})
    border = newer.filter((F.col("__upto") >= n) & (F.col("__upto") - F.col("__n") < n)) \
        .select(F.col(shard).alias("__shard"), F.col(ms).alias("__ms"), (n - F.col("__upto") + F.col("__n")).alias("__left"))
    at = rows.join(border, F.col(shard).eqNullSafe(F.col("__shard")), "left")  # one border row per shard
    edge = ordered_scan(at.filter(F.col(ms).eqNullSafe(F.col("__ms")) & F.col("__left").isNotNull()), [shard], [F.col(seq).desc()],
                        sums={"__age": F.lit(1)})
    newer_than = F.col("__left").isNull() | (F.col("__ms").isNull() & F.col(ms).isNotNull()) | (F.col(ms) > F.col("__ms"))  # no border: the shard has fewer than n
    kept = at.filter(newer_than).select(*df.columns).unionByName(edge.filter(F.col("__age") <= F.col("__left")).select(*df.columns))
    gone = at.filter(F.col("__left").isNotNull() & (F.col(ms).isNull() | (F.col(ms) < F.col("__ms"))) & ~F.col(ms).eqNullSafe(F.col("__ms"))) \
        .select(*df.columns).unionByName(edge.filter(F.col("__age") > F.col("__left")).select(*df.columns))
    return kept, gone


def retain_latest(df: DataFrame, n: int = RETENTION, shard: str = "shard",
                  order: tuple[str, str] = ("msg_ms", "msg_seq")) -> DataFrame:
    """S-12: keep the newest ``n`` messages of each shard (exact, unlike ``MAXLEN ~``).

    A null millisecond is the oldest. On a written log :func:`orderflow.sources.message_log.trim_log`
    drops the files themselves.
    """
    return _split_retained(df, n, shard, order)[0]


def retention_loss(df: DataFrame, acks: DataFrame, n: int = RETENTION, shard: str = "shard",
                   order: tuple[str, str] = ("msg_ms", "msg_seq")) -> DataFrame:
    """S-12: per shard, the messages that retention removes and how many of them were never acked."""
    gone = _split_retained(df, n, shard, order)[1]
    marks = acks.select("shard", "order_id").distinct().withColumn("__acked", F.lit(True))
    return gone.join(marks, ["shard", "order_id"], "left").groupBy(shard).agg(
        F.count(F.lit(1)).alias("removed"), F.count_if(F.col("__acked").isNull()).alias("removed_unacked"))


def items_exploded(ledger: DataFrame) -> DataFrame:
    """F-11: one row per (order, item); orders without items keep one NULL item."""
    return ledger.select("order_id", "shard", F.explode_outer("items").alias("item"))


def sink_acks(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """S-09: append ack marks ``(shard, order_id, ack_ts)``, stored by shard.

    Writes never update in place; "last write wins" is applied on read by
    :func:`orderflow.operators.windows.latest_ack`. With ``batch_id`` a
    replayed batch replaces its own folder instead of appending twice.
    """
    out = df.select("shard", "order_id", "ack_ts")
    if batch_id is None:
        out.write.mode("append").partitionBy("shard").parquet(path)
    else:
        (out.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", "shard").parquet(path))


def read_acks(spark: SparkSession, path: str) -> DataFrame:
    """Current ack marks: the latest write per order."""
    from orderflow.operators.windows import latest_ack
    return latest_ack(spark.read.parquet(path).select("shard", "order_id", "ack_ts"))
