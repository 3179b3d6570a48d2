"""Stream operators that also run on tables (T-04, T-05, T-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def throughput(df: DataFrame, size: str, slide: str | None = None, by: list[str] | None = None,
               ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """T-05: calls and successful calls per (tumbling or sliding) window.

    On a stream give ``watermark`` so finished windows are emitted in
    append mode and their state dropped.
    """
    by = ["shard"] if by is None else by
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    src = df
    if watermark:
        # Watermarks need TIMESTAMP; the window bounds are turned back afterwards.
        if ntz:
            src = src.withColumn(ts, F.col(ts).cast("timestamp"))
        src = src.withWatermark(ts, watermark)
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    start, end = F.col("w.start"), F.col("w.end")
    if watermark and ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return (src.groupBy(*by, win.alias("w"))
            .agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("ok")).alias("ok_calls"))
            .select(*by, start.alias("window_start"), end.alias("window_end"), "calls", "ok_calls"))


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    # Watermarks need TIMESTAMP; NTZ event times are read as session-zone wall clock.
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def dedup_stream(df: DataFrame, key: list[str], ts: str, delay: str) -> DataFrame:
    """T-04: drop repeated keys, keeping state only for ``delay`` past the watermark."""
    return _event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def await_acks(produced: DataFrame, acks: DataFrame, key: str, within_s: int,
               p_ts: str = "ts", a_ts: str = "ack_ts", watermark: str | None = None) -> DataFrame:
    """T-10: each produced row with the first ack that came within ``within_s`` after it
    (unmatched rows kept with NULL), as :func:`orderflow.operators.joins.next_match`
    gives it on tables. Streams need ``watermark``; rows that are equal in every
    column are one.
    """
    p = _event_time(produced, p_ts).withWatermark(p_ts, watermark) if watermark else produced
    a = _event_time(acks, a_ts).withWatermark(a_ts, watermark) if watermark else acks
    a = a.withColumnRenamed(key, "__ack_key")
    cond = ((F.col(key) == F.col("__ack_key")) & (F.col(a_ts) >= F.col(p_ts)) &
            (F.col(a_ts) <= F.col(p_ts) + F.expr(f"INTERVAL {int(within_s)} SECONDS")))
    joined = p.join(a.select("__ack_key", a_ts), cond, "left_outer")
    # the event-time column is among the grouping columns, so the state ends with the watermark
    return joined.groupBy(*[F.col(c) for c in produced.columns]).agg(F.min(a_ts).alias(a_ts))


def ack_sessions_stream(acks: DataFrame, ttl_s: int, watermark: str, shard: str = "shard",
                        ts: str = "ack_ts") -> DataFrame:
    """T-08 on a stream: one row per ack-hash lifetime of a shard, emitted once the
    watermark passes its expiry (``session_window`` with a gap of the TTL)."""
    src = _event_time(acks, ts).withWatermark(ts, watermark)
    ntz = isinstance(acks.schema[ts].dataType, T.TimestampNTZType)
    s = (src.groupBy(shard, F.session_window(ts, f"{int(ttl_s)} seconds").alias("s"))
         .agg(F.count(F.lit(1)).alias("acks"), F.max(ts).alias("last_write")))
    cols = [F.col("s.start"), F.col("last_write"), F.col("s.end")]
    if ntz:
        cols = [c.cast("timestamp_ntz") for c in cols]
    return s.select(shard, cols[0].alias("started"), cols[1].alias("last_write"),
                    cols[2].alias("expires_at"), "acks")
