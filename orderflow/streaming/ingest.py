"""The consume path as one Structured Streaming job (T-01 .. T-03, T-06, T-11, T-12).

source (shard logs) -> decode -> split good / malformed -> ledger write
-> ack write -> offset commit. The offset commit after ``foreachBatch``
returns is the acknowledgement to the log: a batch whose ledger write fails raises,
so nothing of it is acked or committed and the whole batch is replayed on
restart (at-least-once). Replays overwrite their own ``writer``/``batch_id``
folders, so the ledger and ack tables end up as if each batch ran once.
"""

from __future__ import annotations

import hashlib
import logging
import time
from collections import deque
from datetime import datetime, timezone
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderflow.functions.codec import msg_id_millis, msg_id_seq
from orderflow.operators.validate import decode_orders, to_ledger
from orderflow.schemas import LEDGER_COLUMNS
from orderflow.session import drop_path, key_bloom, scratch_path, write_scratch
from orderflow.sources.compaction import closed_upto
from orderflow.sources.key_index import BUCKETS, KeyIndex
from orderflow.sources.messages import read_messages

log = logging.getLogger("orderflow.ingest")

COUNTERS = ("received", "inserted", "duplicates", "skipped")


@dataclass
class IngestPaths:
    """Folders of one ingest query. ``writer`` names the query in the tables it
    shares with others; without it, it is derived from the checkpoint folder,
    which no two queries share."""
    source: str
    ledger: str
    acks: str
    quarantine: str
    checkpoint: str
    writer: str | None = None
    keys: str | None = None  # index of stored order ids (``first_wins``); ``<ledger>-keys`` if not given
    key_buckets: int = BUCKETS  # buckets of that index
    counters: str | None = None  # one row of counts per micro-batch (:func:`live_totals`), if given

    def writer_id(self) -> str:
        return self.writer or hashlib.md5(self.checkpoint.rstrip("/").encode()).hexdigest()[:12]


def _replace_batch(df: DataFrame, path: str, writer: str, batch_id: int, by_shard: bool) -> None:
    """Write one micro-batch so that a replay replaces exactly its own files.

    Files lie under ``[shard=]/writer=/batch_id=``; ``shard`` is on top, so a
    reader of one shard lists that shard's folders only, and batches of two
    queries that share a table never meet.
    """
    keys = (["shard"] if by_shard else []) + ["writer", "batch_id"]
    out = df.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(batch_id).cast("long"))
    w = key_bloom(out.write) if by_shard else out.write
    (w.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def sink_counts(spark: SparkSession, counts: dict, path: str, writer: str) -> None:
    """T-11: store the counts of one micro-batch; a replay replaces the row of that batch and writer."""
    row = spark.createDataFrame([(int(counts["batch_id"]), writer, *[int(counts[c]) for c in COUNTERS])],
                                "batch_id bigint, writer string, " + ", ".join(f"{c} bigint" for c in COUNTERS))
    row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("writer", "batch_id").parquet(path)


def live_totals(spark: SparkSession, path: str) -> DataFrame:
    """T-11 / A-05 .. A-07: running counts per writer, from one row per micro-batch, whatever was replayed or restarted."""
    schema = ", ".join(f"{c} bigint" for c in COUNTERS) + ", writer string, batch_id bigint"
    return spark.read.schema(schema).parquet(path).groupBy("writer").agg(
        F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in COUNTERS])


def process_batch(batch: DataFrame, batch_id: int, paths: IngestPaths, first_wins: bool = False) -> dict:
    """One micro-batch: ledger first, then acks for exactly the rows it stored.

    Every received message ends up in the ledger, in quarantine with a reason
    (malformed, or an amount that money can't hold), or - with ``first_wins``,
    the documented ``ON CONFLICT DO NOTHING`` - is a duplicate: a later message
    of an order in this batch, or of one that another batch stored. Returns
    ``received = inserted + duplicates + skipped``, counted by the writes
    themselves. Acks are written only after the ledger write returned, from
    the same rows, decoded once. An empty batch writes nothing, and neither does a
    batch that compaction closed: it is stored already (all its counts are 0).
    """
    spark = batch.sparkSession
    writer = paths.writer_id()
    if batch_id <= closed_upto(spark, paths.ledger, writer):
        return {"batch_id": batch_id, "received": 0, "inserted": 0, "duplicates": 0, "skipped": 0}
    # Decode once per batch; ledger, acks and quarantine all read it.
    # One stamp per micro-batch, fixed on the driver: a recomputed partition
    # (lost executor, evicted cache) gets the same created_at / ack_ts.
    stamp = F.lit(datetime.now(timezone.utc))
    decoded = decode_orders(batch.withColumn("__created_at", stamp))
    # Keep only what the writes need; the raw payload only for rejected rows.
    decoded = decoded.select(
        "shard", "msg_id", "order_id", "customer_id", "amount", "items", "errors", "__created_at",
        F.when(F.size("errors") > 0, F.col("data")).alias("data"))
    decoded.persist(StorageLevel.MEMORY_AND_DISK)
    staged = None
    try:
        res = {"batch_id": batch_id, "received": 0, "inserted": 0, "duplicates": 0, "skipped": 0}
        if not decoded.count():  # one job that decodes all splits at once; a look at the first row would decode the first split alone
            return res
        valid = F.size("errors") == 0
        good, seen = decoded.filter(valid), Observation()
        good = good.observe(seen, F.count(F.lit(1)).alias("valid"))
        if first_wins:
            good = good.withColumn("msg_ms", msg_id_millis("msg_id")).withColumn("msg_seq", msg_id_seq("msg_id"))
            index = KeyIndex(spark, paths.keys or f"{paths.ledger}-keys", buckets=paths.key_buckets)
            good = index.unseen(good, writer, batch_id)
        ledger = to_ledger(good, F.col("__created_at")).select(*LEDGER_COLUMNS)
        if first_wins:
            # Written once, not cached: Spark drops a cached plan that reads the index as soon as the
            # claims are written there, and would look up all stored keys a second time.
            staged = scratch_path(spark, "first-wins")
            ledger = write_scratch(ledger, staged)
            # claimed before they are stored: a failed batch is replayed and finds its own claims
            index.claim(ledger, writer, batch_id)
        stored, rejected = Observation(), Observation()
        # Durable write first; an exception here leaves the batch un-acked.
        _replace_batch(ledger.observe(stored, F.count(F.lit(1)).alias("n")), paths.ledger, writer, batch_id, True)
        acks = ledger.select("shard", "order_id", F.col("created_at").alias("ack_ts"))
        _replace_batch(acks, paths.acks, writer, batch_id, True)
        quarantine = decoded.filter(~valid).select("shard", "msg_id", "data", F.array_join("errors", ";").alias("reason")) \
            .observe(rejected, F.count(F.lit(1)).alias("n"))
        _replace_batch(quarantine, paths.quarantine, writer, batch_id, False)
        res["inserted"], res["skipped"] = stored.get["n"], rejected.get["n"]
        res["duplicates"] = seen.get["valid"] - res["inserted"]
        res["received"] = seen.get["valid"] + res["skipped"]
        if paths.counters:
            sink_counts(spark, res, paths.counters, writer)
        log.info("inserted batch=%d rows=%d duplicates=%d skipped=%d", batch_id, res["inserted"], res["duplicates"], res["skipped"])
        return res
    finally:
        if staged is not None:
            drop_path(spark, staged)
        decoded.unpersist()


def start_ingest(spark: SparkSession, paths: IngestPaths, shards: list[int] | None = None,
                 trigger: dict | None = None, max_files_per_trigger: int | None = None,
                 first_wins: bool = False, name: str | None = None, on_batch=None) -> StreamingQuery:
    """T-01: start the ingest stream. ``shards`` restricts it to some shards (T-12:
    one query and checkpoint per shard group, so one failing group leaves the
    others running; the groups may share all tables). ``trigger`` defaults to
    ``availableNow``; use ``{"processingTime": "2 seconds"}`` for a poll
    cadence. ``first_wins`` stores each order once however late or often it is
    sent: unlike a deduplication bounded by a watermark it loses no late order.
    ``on_batch`` gets the counts of every batch."""
    src = read_messages(spark, paths.source, streaming=True, max_files_per_trigger=max_files_per_trigger)
    if shards is not None:
        src = src.filter(F.col("shard").isin(list(shards)))
    observed = src.observe("ingest", F.count(F.lit(1)).alias("received"),
                           F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))

    def each(df, batch_id):
        counts = process_batch(df, batch_id, paths, first_wins)
        if on_batch:
            on_batch(counts)

    w = (observed.writeStream.foreachBatch(each)
         .option("checkpointLocation", paths.checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    return w.start()


def run_with_restart(start_fn, max_restarts: int = 3, pause_s: float = 1.0) -> StreamingQuery:
    """T-06: run a query to completion, restarting it from its checkpoint after a
    failure (log, pause, resume where the committed offsets stood). The last
    error is re-raised once ``max_restarts`` is used up."""
    attempt = 0
    while True:
        try:
            q = start_fn()
            q.awaitTermination()
            return q
        except Exception as e:  # noqa: BLE001 - StreamingQueryException and friends
            attempt += 1
            log.warning("stream failed (attempt %d/%d): %s", attempt, max_restarts, e)
            if attempt > max_restarts:
                raise
            time.sleep(pause_s)


def progress_metrics(query: StreamingQuery) -> dict:
    """T-11: live numbers of the last micro-batch (rows, rates, observed counts,
    rows dropped by the watermark)."""
    p = query.lastProgress
    if not p:
        return {}
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
    return {"batch_id": p.get("batchId"), "input_rows": p.get("numInputRows"),
            "input_rows_per_s": p.get("inputRowsPerSecond"),
            "processed_rows_per_s": p.get("processedRowsPerSecond"),
            "observed": p.get("observedMetrics", {}), "dropped_by_watermark": dropped}


@dataclass
class ProgressCollector(StreamingQueryListener):
    """T-11: keeps the last ``limit`` progress events of the queries in this session."""
    limit: int = 1000
    events: deque = field(default_factory=deque)

    def onQueryStarted(self, event):  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.events.append(event.progress)
        while len(self.events) > self.limit:
            self.events.popleft()

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
