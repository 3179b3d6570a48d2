"""The message log as a growing table: ids given at append, seeks, trimming (S-02, S-03, S-12, W-01, W-02).

Layout under ``path``: ``log`` holds the messages in ``shard=/batch_id=``
folders, files sorted by position, with the id's two numbers as columns of
their own, so a start position skips row groups by their minima and maxima;
``carry`` holds one row per shard and batch: last millisecond, messages in it,
messages in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.appends import CarryTable
from orderflow.operators.scan import ordered_scan
from orderflow.operators.windows import ts_millis
from orderflow.session import path_exists, scratch_path


def _carry(spark: SparkSession, path: str) -> CarryTable:
    return CarryTable(spark, f"{path}/carry", ["shard"])


def append_messages(df: DataFrame, path: str, batch_id: int, ts: str = "ts", tiebreak: str = "o_orderkey") -> None:
    """S-03 / W-02: append one batch of messages to the shard logs, giving each its id and position.

    Inside a shard messages stand in the order ``(ts, tiebreak)`` of their
    batch, behind all earlier batches. ``msg_id`` is ``<millis>-<seq>``: a
    message older than the log's last one takes that one's millisecond, so ids
    always ascend, and ``seq`` goes on where the last batch left off in that
    millisecond. ``pos`` counts the shard's messages from 1 for ever (trimming
    doesn't change it). A replay of a batch writes the same rows again; an empty
    batch writes nothing. Other columns are stored as they are.
    """
    spark = df.sparkSession
    carry = _carry(spark, path)
    before = carry.before(batch_id)
    work = df.withColumn("__ms", ts_millis(df, ts)).drop("msg_ms", "msg_seq", "msg_id", "pos", "batch_id")
    if before is not None:
        # one row per shard: a configuration-sized table
        work = work.join(F.broadcast(before.select("shard", *[F.col(c).alias(f"__{c}") for c in ("last_ms", "in_last", "rows")])), "shard", "left")
    else:
        work = work.select("*", *[F.lit(None).cast("long").alias(f"__{c}") for c in ("last_ms", "in_last", "rows")])
    work = work.withColumn("msg_ms", F.greatest("__ms", "__last_ms"))  # greatest skips nulls
    placed = ordered_scan(work, ["shard"], ["__ms", tiebreak], sums={"__pos": F.lit(1)})
    staged = scratch_path(spark, "append")
    placed.write.parquet(staged)
    placed = spark.read.schema(placed.schema).parquet(staged)
    if placed.isEmpty():
        return
    first = placed.groupBy("shard", "msg_ms").agg(F.min("__pos").alias("__first"))
    seq = F.col("__pos") - F.col("__first") + F.when(F.col("msg_ms") == F.col("__last_ms"), F.col("__in_last")).otherwise(0)
    payload = [c for c in work.columns if not c.startswith("__") and c not in ("shard", "msg_ms")]
    rows = placed.join(first, ["shard", "msg_ms"]).withColumn("msg_seq", seq).select(
        "shard", (F.coalesce("__rows", F.lit(0)) + F.col("__pos")).alias("pos"), "msg_ms", "msg_seq",
        F.concat(F.col("msg_ms").cast("string"), F.lit("-"), F.col("msg_seq").cast("string")).alias("msg_id"), *payload)
    rows.withColumn("batch_id", F.lit(batch_id).cast("long")) \
        .repartitionByRange("shard", "pos").sortWithinPartitions("shard", "pos") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard", "batch_id").parquet(f"{path}/log")
    mine = spark.read.parquet(f"{path}/log").filter(F.col("batch_id") == batch_id).groupBy("shard").agg(
        F.max(F.struct("msg_ms", "msg_seq")).alias("last"), F.max("pos").alias("rows"))
    carry.replace(batch_id, mine.select("shard", F.col("last.msg_ms").alias("last_ms"),
                                        (F.col("last.msg_seq") + 1).alias("in_last"), "rows"), before)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/log")


def _after(start: str) -> Column:
    ms, seq = (int(x) for x in start.split("-"))
    ms_, seq_ = F.col("msg_ms"), F.col("msg_seq")
    return (ms_ >= ms) & ((ms_ > ms) | (seq_ > seq))


def log_from(spark: SparkSession, path: str, start: str | dict[int, str]) -> DataFrame:
    """S-02: messages strictly after a start position, for all shards or for each shard its own.

    ``'0-0'`` is everything, ``'$'`` nothing already stored. The conditions are
    plain comparisons of stored columns, so they reach the Parquet scan, where
    row groups and folders of other shards are skipped. Shards that a mapping
    doesn't name are not read.
    """
    log = read_log(spark, path)
    if start == "$":
        return log.filter(F.lit(False))
    if isinstance(start, str):
        return log if start == "0-0" else log.filter(_after(start))
    wanted = F.lit(False)
    for shard, at in start.items():
        if at != "$":
            wanted = wanted | ((F.col("shard") == shard) & (F.lit(True) if at == "0-0" else _after(at)))
    return log.filter(F.col("shard").isin([s for s, at in start.items() if at != "$"])).filter(wanted)


def polls(log: DataFrame, size: int = 500) -> DataFrame:
    """W-01 over the written log: ``poll_seq`` and ``batch_no`` are the stored positions; nothing is sorted or shuffled."""
    return log.withColumn("poll_seq", F.col("pos")).withColumn("batch_no", F.floor((F.col("pos") - 1) / size).cast("long"))


def _remove(spark: SparkSession, folder: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def trim_log(spark: SparkSession, path: str, keep: int) -> dict[str, int]:
    """S-12: leave the newest ``keep`` messages of each shard in the stored log.

    The carry tells how many messages each folder's shard had after its batch,
    so whole folders below the border are deleted unread and only the folder
    that the border cuts is rewritten. What passes the driver is one row per
    folder to delete or cut. Trimming twice changes nothing; readers that
    started before may miss the deleted files. Returns ``dropped`` and ``cut``
    folders.
    """
    history = _carry(spark, path).history()
    if history is None:
        return {"dropped": 0, "cut": 0}
    from pyspark.sql import Window
    changed = history.select("shard", "batch_id", "rows").distinct()
    in_shard = Window.partitionBy("shard").orderBy("batch_id")  # one row per batch
    span = changed.withColumn("begin", F.coalesce(F.lag("rows").over(in_shard), F.lit(0))) \
        .withColumn("border", F.max("rows").over(Window.partitionBy("shard")) - keep) \
        .filter((F.col("rows") > F.col("begin")) & (F.col("begin") < F.col("border")))
    dropped = cut = 0
    for r in span.toLocalIterator():
        folder = f"{path}/log/shard={r['shard']}/batch_id={r['batch_id']}"
        if not path_exists(spark, folder):
            continue
        if r["rows"] <= r["border"]:
            _remove(spark, folder)
            dropped += 1
            continue
        rest, staged = spark.read.parquet(folder).filter(F.col("pos") > r["border"]), scratch_path(spark, "trim")
        rest.write.parquet(staged)
        spark.read.parquet(staged).repartitionByRange("pos").sortWithinPartitions("pos") \
            .withColumn("shard", F.lit(r["shard"])).withColumn("batch_id", F.lit(r["batch_id"])) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard", "batch_id").parquet(f"{path}/log")
        cut += 1
    return {"dropped": dropped, "cut": cut}
