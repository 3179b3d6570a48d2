"""Ordered per-shard logic (W-01 .. W-07, T-08 batch form).

Partitions here are shards or dependency names: a handful of keys, each
possibly holding a large share of all rows. Ordered work over them goes
through :func:`orderflow.operators.scan.ordered_scan`, never a plain
``Window.partitionBy(shard)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators.scan import ordered_scan
from orderflow.operators.util import ts_micros, with_scalars
from orderflow.sources.tables import ntz_millis


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_millis(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return ntz_millis(col)
    return F.unix_millis(F.col(col))


def assign_msg_ids(df: DataFrame, ts: str = "ts", tiebreak: str = "o_orderkey",
                   shard: str = "shard") -> DataFrame:
    """W-02: ``msg_id = '<millis>-<seq>'``, seq counting from 0 inside (shard, millis)."""
    work = df.withColumn("__ms", ts_millis(df, ts))
    out = ordered_scan(work, [shard, "__ms"], [tiebreak], sums={"__rn": F.lit(1)})
    seq = (F.col("__rn") - 1).cast("long")
    return (out.withColumn("msg_seq", seq)
            .withColumn("msg_id", F.concat(F.col("__ms").cast("string"), F.lit("-"), seq.cast("string")))
            .drop("__ms", "__rn"))


def poll_batches(df: DataFrame, size: int = 500, shard: str = "shard",
                 order: tuple = ("__msg_ms", "msg_seq"), msg_id: str = "msg_id") -> DataFrame:
    """W-01: number reads of at most ``size`` messages per shard, in stream order.

    Adds ``poll_seq`` (1-based position in the shard) and ``batch_no``.
    Order is by ``(millis, seq)`` parsed from the id, never the id text.
    """
    work = df
    if "__msg_ms" in order and "__msg_ms" not in df.columns:
        work = df.withColumn("__msg_ms", F.regexp_extract(msg_id, r"^(\d+)-", 1).cast("long"))
    out = ordered_scan(work, [shard], list(order), sums={"poll_seq": F.lit(1)})
    out = out.withColumn("batch_no", F.floor((F.col("poll_seq") - 1) / size).cast("long"))
    return out.drop("__msg_ms") if "__msg_ms" not in df.columns else out


def latest_ack(acks: DataFrame, key: str = "order_id", ts: str = "ack_ts",
               tiebreak: str | None = None) -> DataFrame:
    """W-03 / S-09 read side: last write wins per order, aggregated map-side.

    The "latest" order is one fixed-width number (epoch micros scaled by 2^64,
    plus an integer tiebreak of any size), so each column is a ``max_by`` on
    primitive buffers and Spark can use hash aggregation instead of sorting.
    """
    from orderflow.operators.util import ts_micros
    others = [c for c in acks.columns if c != key]
    numeric_tb = tiebreak is None or isinstance(acks.schema[tiebreak].dataType, T.IntegralType)
    if numeric_tb:
        us = ts_micros(acks, ts).cast("decimal(38,0)")
        ordv = us if tiebreak is None else (us.cast("decimal(18,0)") * F.lit(str(2 ** 64)).cast("decimal(20,0)")).cast("decimal(38,0)") \
            + F.col(tiebreak).cast("decimal(20,0)")
        ordv = ordv.cast("decimal(38,0)")
        work = acks.withColumn("__ord", ordv)
        return (work.groupBy(key)
                .agg(*[F.max_by(c, "__ord").alias(c) for c in others],
                     F.count(F.lit(1)).alias("n_writes"))
                .select(key, *others, "n_writes"))
    order_val = F.struct(F.col(ts), F.col(tiebreak))
    return (acks.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in others]), order_val).alias("__last"),
                 F.count(F.lit(1)).alias("n_writes"))
            .select(key, "__last.*", "n_writes"))


def ack_progress(acks: DataFrame, submitted: DataFrame, interval_s: int,
                 key: str = "order_id", ts: str = "ack_ts") -> DataFrame:
    """W-04: completion curve in rounds of ``interval_s`` from the first ack.

    One row per round (gaps filled): ``round, new_acked, acked_total,
    pct_complete`` against the number of submitted orders. Rounds are few
    (span / interval), so the running sum over them is cheap.
    """
    sub_ids = submitted.select(key).distinct()
    n_sub = sub_ids.agg(F.count(F.lit(1)).alias("n_submitted"))
    first = (acks.join(sub_ids, key, "left_semi")
             .groupBy(key).agg(F.min(ts).alias("first_ack")))
    us = ts_micros(first, "first_ack")
    first = first.withColumn("__us", us)
    t0 = first.agg(F.min("__us").alias("t0"))
    rounds_hit = (with_scalars(first, t0)
                  .withColumn("round", F.floor((F.col("__us") - F.col("t0")) / (interval_s * 1_000_000)).cast("long"))
                  .groupBy("round").agg(F.count(F.lit(1)).alias("new_acked")))
    all_rounds = (rounds_hit.agg(F.max("round").alias("mx"))
                  .select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("mx"))).alias("round")))
    # One row per round: few unless the span is huge, and then the ordered
    # scan spreads the running total over many tasks.
    curve = ordered_scan(
        all_rounds.join(rounds_hit, "round", "left")
        .select(F.lit(0).alias("__all"), "round",
                F.coalesce("new_acked", F.lit(0)).cast("long").alias("new_acked")),
        ["__all"], ["round"], sums={"acked_total": F.col("new_acked")}).drop("__all")
    from orderflow.functions.codec import pct
    return (with_scalars(curve, n_sub)
            .select("round", "new_acked", "acked_total",
                    (F.col("n_submitted") - F.col("acked_total")).alias("pending"),
                    pct("acked_total", "n_submitted").alias("pct_complete")))


def counter_increase(samples: DataFrame, series: str, ts: str, value: str,
                     tiebreak: str) -> DataFrame:
    """W-05: per-sample counter increase with reset handling.

    ``increase = v - prev`` normally, ``v`` after a reset (``v < prev``),
    NULL on a series' first sample.
    """
    out = ordered_scan(samples, [series], [ts, tiebreak], lags={"__prev": F.col(value).cast("double")})
    v = F.col(value).cast("double")
    inc = (F.when(F.col("__prev").isNull(), F.lit(None).cast("double"))
           .when(v < F.col("__prev"), v).otherwise(v - F.col("__prev")))
    return out.withColumn("increase", inc).withColumnRenamed("__prev", "prev_value")


def counter_rate(samples: DataFrame, series: str, ts: str, value: str, tiebreak: str,
                 window: str = "1 hour", slide: str | None = None, window_s: int = 3600) -> DataFrame:
    """W-05: increase and per-second rate of a counter in (sliding) windows.

    No extrapolation to the window edges: the rate is the summed increase
    of the samples inside the window divided by the window length.
    """
    inc = counter_increase(samples, series, ts, value, tiebreak)
    win = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    return (inc.groupBy(series, win.alias("w"))
            .agg(F.sum(F.coalesce("increase", F.lit(0.0))).alias("increase"),
                 F.count(F.lit(1)).alias("samples"))
            .select(series, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"),
                    "samples", F.round("increase", 6).alias("increase"),
                    F.round(F.col("increase") / window_s, 6).alias("rate_per_s")))


def failure_streaks(outcomes: DataFrame, key: str = "name", ts: str = "ts",
                    tiebreak: str = "event_id", ok: str = "ok", threshold: int = 3,
                    reason: str = "reason") -> DataFrame:
    """W-06: runs of consecutive failures per key (gaps and islands).

    Calls that an open circuit rejected (reason ``circuit_open``) never reached
    the dependency: they are neither failures nor successes and are left out.
    A success resets the count (the breaker's rule); the island id is the
    running number of successes, computed skew-safe. One row per run:
    ``key, streak_id, failures, started, ended, reaches_threshold``.
    """
    reached = outcomes.filter(~F.col(reason).eqNullSafe("circuit_open"))
    scanned = ordered_scan(reached, [key], [ts, tiebreak],
                           sums={"streak_id": F.col(ok).cast("int")})
    return (scanned.filter(~F.col(ok))
            .groupBy(key, "streak_id")
            .agg(F.count(F.lit(1)).alias("failures"), F.min(ts).alias("started"),
                 F.max(ts).alias("ended"))
            .withColumn("reaches_threshold", F.col("failures") >= threshold))


def trailing_states(outcomes: DataFrame, as_of: DataFrame, threshold: int = 3, recovery_s: int = 30,
                    key: str = "name", ts: str = "ts", tiebreak: str = "event_id", ok: str = "ok",
                    reason: str = "reason") -> DataFrame:
    """A-13: state of each dependency from its recorded outcomes: ``key, failures, failed_at, state``.

    ``failures`` counts the failures since the last success, calls rejected by
    an open circuit left out. Below ``threshold`` the state is ``closed``; from
    there on ``open``, or ``half_open`` once ``recovery_s`` have passed between
    the last failure and ``as_of`` (a one-row table). Two map-side combined
    aggregates; the second joins one row per dependency.
    """
    at = F.struct(F.col(ts), F.col(tiebreak))
    reached = outcomes.filter(~F.col(reason).eqNullSafe("circuit_open"))
    good = reached.filter(F.col(ok)).groupBy(F.col(key).alias("__key")).agg(F.max(at).alias("__good"))
    later = ~F.col(ok) & (F.col("__good").isNull() | (at > F.col("__good")))
    tail = reached.join(good, F.col(key).eqNullSafe(F.col("__key")), "left").groupBy(key).agg(
        F.count_if(later).alias("failures"), F.max(F.when(~F.col(ok), F.col(ts))).alias("failed_at"))
    recovered = F.col("failed_at") + F.make_dt_interval(secs=F.lit(recovery_s)) <= F.col("as_of")
    state = F.when(F.col("failures") < threshold, F.lit("closed")).when(recovered, F.lit("half_open")).otherwise(F.lit("open"))
    return with_scalars(tail, as_of).withColumn("state", state).drop("as_of")


def order_violations(df: DataFrame, keys: list[str], arrival: list[str],
                     msg_ms: str = "msg_ms", msg_seq: str = "msg_seq") -> DataFrame:
    """W-07: rows whose message id is not above the previous one of the same key.

    ``arrival`` is the order rows were produced in; ids are compared as
    ``(millis, seq)``.
    """
    out = ordered_scan(df, keys, arrival, lags={"prev_ms": F.col(msg_ms).cast("long"),
                                                "prev_seq": F.col(msg_seq).cast("long")})
    bad = F.col("prev_ms").isNotNull() & (
        (F.col(msg_ms) < F.col("prev_ms")) |
        ((F.col(msg_ms) == F.col("prev_ms")) & (F.col(msg_seq) <= F.col("prev_seq"))))
    return out.withColumn("violation", bad)


def ack_sessions(acks: DataFrame, ttl_s: int, shard: str = "shard", ts: str = "ack_ts",
                 tiebreak: str = "order_id") -> DataFrame:
    """T-08 batch form: the ack hash of a shard lives until ``ttl_s`` pass
    without a flush (TTL re-armed on every write). One row per lifetime:
    ``shard, session_no, started, last_write, expires_at, acks``.
    """
    us = ts_micros(acks, ts)
    work = acks.withColumn("__us", us)
    lagged = ordered_scan(work, [shard], ["__us", tiebreak], lags={"__prev": F.col("__us")})
    fresh = (F.col("__prev").isNull() | (F.col("__us") - F.col("__prev") >= ttl_s * 1_000_000)).cast("int")
    numbered = ordered_scan(lagged.withColumn("__new", fresh), [shard], ["__us", tiebreak],
                            sums={"session_no": F.col("__new")})
    return (numbered.groupBy(shard, "session_no")
            .agg(F.min(ts).alias("started"), F.max(ts).alias("last_write"),
                 F.count(F.lit(1)).alias("acks"))
            .withColumn("expires_at", F.col("last_write") + F.make_dt_interval(secs=F.lit(ttl_s))))


def live_acks(acks: DataFrame, as_of, ttl_s: int, shard: str = "shard", ts: str = "ack_ts",
              tiebreak: str = "order_id") -> DataFrame:
    """T-08: sessions of :func:`ack_sessions` still alive at ``as_of``."""
    s = ack_sessions(acks, ttl_s, shard, ts, tiebreak)
    return s.withColumn("live", (F.col("started") <= as_of) & (F.col("expires_at") > as_of))


def live_ack_rows(acks: DataFrame, as_of, ttl_s: int, shard: str = "shard", ts: str = "ack_ts",
                  tiebreak: str = "order_id") -> DataFrame:
    """T-08: the ack rows a reader sees at ``as_of``, for J-01 .. A-03.

    A shard's acks expire together once ``ttl_s`` pass without a flush, so what
    lives are the acks since the last such gap, if the last flush is not itself
    too old. One ordered scan for the gaps, then one row per shard.
    """
    base = acks.filter(F.col(ts) <= as_of)
    us = ts_micros(base, ts)
    lagged = ordered_scan(base.withColumn("__us", us), [shard], ["__us", tiebreak], lags={"__prev": F.col("__us")})
    fresh = F.col("__prev").isNull() | (F.col("__us") - F.col("__prev") >= ttl_s * 1_000_000)
    last = lagged.groupBy(shard).agg(F.max(F.when(fresh, F.col("__us"))).alias("__began"), F.max(ts).alias("__last")) \
        .filter(F.col("__last") + F.make_dt_interval(secs=F.lit(ttl_s)) > as_of)
    return lagged.join(last, shard).filter(F.col("__us") >= F.col("__began")).select(*acks.columns)
