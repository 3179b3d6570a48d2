"""Sharded message logs (S-01, S-02, S-03, U-01).

A shard log is a folder per shard (``partitionBy('shard')``) of Parquet or
JSON files; a Kafka topic keyed by ``order_id`` is the streaming equivalent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions.codec import msg_id_millis, parse_msg_id
from orderflow.operators.sets import union_shards

# Stored message layout: the envelope plus the routing columns.
MESSAGE_FILE = T.StructType([
    T.StructField("msg_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("shard", T.IntegerType()),
])


# A log file takes about this many bytes of shuffled rows; its row groups are what tasks share when they read it.
FILE_BYTES = 128 << 20
ROW_GROUP_BYTES = 4 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def write_messages(df: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """S-03: append envelopes to their shard's folder.

    The number of files follows the bytes, not the tasks that made the rows:
    a stream that polls some files at a time would run a micro-batch for each
    few of them. Files have small row groups, so many tasks read even one file.
    ``files`` sets the files a shard gets instead (fewer if it has few rows).
    """
    spark, out = df.sparkSession, df.select(*[f.name for f in MESSAGE_FILE.fields])
    if files:  # a task for each file (16 shards, then tasks are shared): hashed keys could meet and make one file of two
        file_no = F.pmod(F.xxhash64("msg_id", "data"), F.lit(files))
        out = out.repartitionById(16 * files, F.pmod(F.coalesce("shard", F.lit(0)) * files + file_no, F.lit(16 * files)).cast("int"))
    else:
        out = out.hint("rebalance", "shard")
    before = spark.conf.get(_ADVISORY)
    spark.conf.set(_ADVISORY, str(FILE_BYTES))
    try:
        (out.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", ROW_GROUP_BYTES >> 4)
            .partitionBy("shard").parquet(path))
    finally:
        spark.conf.set(_ADVISORY, before)


def write_messages_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """S-03 as a stream: exactly-once file sink with a checkpoint."""
    w = (df.select(*[f.name for f in MESSAGE_FILE.fields]).writeStream
         .format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy("shard").outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_messages(spark: SparkSession, path: str, streaming: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """S-01: all shard logs as one relation; ``maxFilesPerTrigger`` bounds each poll."""
    if streaming:
        r = spark.readStream.schema(MESSAGE_FILE)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path)
    return spark.read.schema(MESSAGE_FILE).parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """One shard's log; the ``shard = k`` filter prunes to a single folder."""
    return read_messages(spark, path).filter(F.col("shard") == shard)


def union_shard_logs(spark: SparkSession, path: str, shards: list[int]) -> DataFrame:
    """U-01: read each shard's log and union them by name."""
    return union_shards([read_shard(spark, path, s) for s in shards])


def from_position(df: DataFrame, start: str, msg_id: str = "msg_id") -> DataFrame:
    """S-02: messages after a start position: ``'0-0'`` everything, ``'$'`` nothing
    already stored, else strictly after the given id (compared as (millis, seq))."""
    if start == "$":
        return df.filter(F.lit(False))
    ms, seq = (int(x) for x in start.split("-"))
    m = msg_id_millis(msg_id)
    _, s = parse_msg_id(msg_id)
    return df.filter((m > ms) | ((m == ms) & (s > seq)))


def read_messages_kafka(spark: SparkSession, servers: str, topic: str,
                        starting: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S-01 / S-02 on Kafka: one topic keyed by ``order_id``, one Kafka partition
    per shard. ``starting`` is ``latest`` (``$``), ``earliest`` (``0-0``) or a
    JSON offsets spec. Needs the spark-sql-kafka package on the classpath (not
    part of this environment, so only the batch/file forms are tested here)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    env = T.StructType([T.StructField("type", T.StringType()), T.StructField("data", T.StringType()),
                        T.StructField("timestamp", T.StringType())])
    k = r.load()
    return k.select(
        F.col("partition").alias("shard"),
        F.concat(F.unix_millis(F.col("timestamp")).cast("string"), F.lit("-"),
                 F.col("offset").cast("string")).alias("msg_id"),
        F.from_json(F.col("value").cast("string"), env).alias("e"),
        F.col("timestamp").cast("timestamp_ntz").alias("ts")).select("shard", "msg_id", "e.*", "ts")


def write_messages_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """S-03 on Kafka: key = order_id, partition = shard, value = the envelope JSON."""
    out = df.select(F.col("order_id").alias("key"), F.col("shard").alias("partition"),
                    F.to_json(F.struct("type", "data", "timestamp")).alias("value"))
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())
