"""Aggregations: ack rollups, audits, counters, histograms, quantiles (A-01 .. A-17).

Every aggregate is a ``groupBy`` with partial (map-side) aggregation, so a
hot group is combined per task before the shuffle. Nothing collects a group.
"""

from __future__ import annotations



from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.codec import pct
from orderflow.operators.scan import ordered_scan
from orderflow.operators.util import with_scalars, ts_micros
from orderflow.schemas import (PRODUCER_BUCKETS, RETRY_BACKOFF, RETRY_DELAY_S, RETRY_MAX,
                               LAG_ALERT)


def ack_rollup(status: DataFrame, by: list[str] | None = None, distinct: bool = False) -> DataFrame:
    """A-01: ``total, acked, pending, pct_complete`` over distinct order ids.

    :func:`orderflow.operators.joins.ack_status` already yields one row per
    (request, order); pass ``distinct=True`` for inputs that may repeat.
    """
    by = by or []
    d = status.select(*by, "order_id", "status")
    if distinct:
        d = d.distinct()
    acked = F.count_if(F.col("status") == "acked")
    g = d.groupBy(*by) if by else d.groupBy()
    return (g.agg(F.count(F.lit(1)).alias("total"), acked.alias("acked"))
            .withColumn("pending", F.col("total") - F.col("acked"))
            .withColumn("pct_complete", pct("acked", "total")))


def shard_frame(spark, n_shards: int) -> DataFrame:
    """``shard`` 0..n-1: n is configuration (the shard count), not data."""
    return spark.range(n_shards).select(F.col("id").cast("int").alias("shard"))


def ack_summary(acks: DataFrame, n_shards: int) -> DataFrame:
    """A-02: acked orders per shard, shards without acks shown as 0."""
    counts = acks.select("shard", "order_id").distinct().groupBy("shard").agg(F.count(F.lit(1)).alias("acked"))
    return (shard_frame(acks.sparkSession, n_shards).join(counts, "shard", "left")
            .select("shard", F.coalesce("acked", F.lit(0)).cast("long").alias("acked")))


def ack_total(acks: DataFrame) -> DataFrame:
    """A-03: per-shard counts and the total (``shard`` NULL) in one ``rollup`` pass."""
    d = acks.select("shard", "order_id").distinct()
    return (d.rollup("shard").agg(F.count(F.lit(1)).alias("acked"),
                                  F.grouping("shard").alias("is_total")))


def audit_by_shard(ledger: DataFrame) -> DataFrame:
    """A-04 / O-01: rows and average amount per shard (NUMERIC(10,2)), ordered by shard.

    The average is rounded half-up once, from the exact sum of cents and the
    count: a division with fewer digits first would round twice.
    """
    cents = (F.sum(F.col("amount").cast("decimal(12,2)")) * 100).cast("decimal(38,0)")
    n = F.count("amount").cast("decimal(20,0)")
    sums = ledger.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), cents.alias("cents"), n.alias("n"))
    half_up = F.expr("CAST(sign(cents) * ((2 * abs(cents) + n) div (2 * n)) AS DECIMAL(20,0))")
    return sums.select("shard", "rows", F.when(F.col("n") > 0, half_up / 100).cast("decimal(10,2)").alias("avg_amount")) \
        .orderBy("shard")


def published_total(outcomes: DataFrame) -> DataFrame:
    """A-05: ``orders_published_total`` per shard."""
    return outcomes.filter(F.col("ok")).groupBy("shard").agg(F.count(F.lit(1)).alias("published"))


def failed_total(outcomes: DataFrame) -> DataFrame:
    """A-06: ``orders_failed_total`` per (shard, reason)."""
    return (outcomes.filter(~F.col("ok")).groupBy("shard", "reason")
            .agg(F.count(F.lit(1)).alias("failed")))


def consumer_totals(outcomes: DataFrame, rows: Column | None = None, acks: DataFrame | None = None,
                    xacks: DataFrame | None = None) -> DataFrame:
    """A-07: per shard the consumer's counters, all inputs summed up in one aggregate.

    ``outcomes`` has one row per batch write (``shard, ok, reason``), ``rows``
    its inserted rows; ``acks`` one row per id written to the ack table
    (``acks_flushed``); ``xacks`` one row per acknowledgement call to the log
    (``shard, ok``), those that failed after all retries are ``xack_failed``
    (their messages may come again). A shard that any input names has a row.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    r = rows if rows is not None else one

    def flag(cond: Column) -> Column:
        return F.when(cond, one).otherwise(none)

    parts = outcomes.select("shard", F.when(F.col("ok"), r).otherwise(0).cast("long").alias("rows_inserted"),
                            flag(F.col("ok")).alias("batches_ok"),
                            flag(F.col("reason") == "circuit_open").alias("failed_circuit_open"),
                            flag(F.col("reason") == "retries_exhausted").alias("failed_retries_exhausted"),
                            none.alias("acks_flushed"), none.alias("xack_failed"))
    if acks is not None:
        parts = parts.unionByName(acks.select("shard", one.alias("acks_flushed")), allowMissingColumns=True)
    if xacks is not None:
        parts = parts.unionByName(xacks.select("shard", flag(~F.col("ok")).alias("xack_failed")), allowMissingColumns=True)
    counters = [c for c in parts.columns if c != "shard"]
    return parts.groupBy("shard").agg(*[F.sum(F.coalesce(c, none)).alias(c) for c in counters])


def histogram(df: DataFrame, value: str, buckets: list[float] = PRODUCER_BUCKETS,
              by: list[str] | None = None) -> DataFrame:
    """A-08: cumulative ``le`` buckets (+Inf last), with ``hist_sum`` and ``hist_count``.

    One aggregation pass with one conditional count per bound (no row
    explosion); the few bucket rows are produced afterwards with ``stack``.
    """
    by = by or []
    bounds = list(buckets)
    aggs = [F.count_if(F.col(value) <= b).alias(f"__c{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(F.col(value)).alias("hist_count"), F.sum(value).alias("hist_sum")]
    g = df.groupBy(*by) if by else df.groupBy()
    wide = g.agg(*aggs)
    n = len(bounds) + 1
    pairs = ", ".join([f"{i}, CAST({b!r} AS DOUBLE), __c{i}" for i, b in enumerate(bounds)] +
                      [f"{len(bounds)}, CAST('Infinity' AS DOUBLE), hist_count"])
    stacked = wide.selectExpr(*by, "hist_count", "hist_sum",
                              f"stack({n}, {pairs}) AS (bucket, le, bucket_count)")
    return stacked.select(*by, F.col("bucket").cast("int"), "le",
                          F.col("bucket_count").cast("long"), "hist_count", "hist_sum")


def histogram_quantile(hist: DataFrame, qs, by: list[str] | None = None) -> DataFrame:
    """A-09: quantiles (one ``q`` or a list) from cumulative buckets, linear inside the bucket.

    Picks the one bucket with ``count >= q*n`` and previous ``count < q*n``;
    a rank in the +Inf bucket returns the highest finite bound; an empty
    histogram gives NULL. One pass over the bucket rows (a few per group) for
    all quantiles: one row per group and ``q``.
    """
    by = by or []
    group = Window.partitionBy(*by) if by else Window.partitionBy()
    w = group.orderBy("bucket")
    inf = F.col("le") == float("inf")
    h = (hist.withColumn("prev_le", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
         .withColumn("prev_c", F.coalesce(F.lag("bucket_count").over(w), F.lit(0)))
         .withColumn("max_finite", F.max(F.when(~F.isnan("le") & ~inf, F.col("le"))).over(group))
         .withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in (qs if isinstance(qs, (list, tuple)) else [qs])])))
         .withColumn("rank", F.col("hist_count") * F.col("q")))
    pick = (F.col("hist_count") > 0) & (F.col("bucket_count") >= F.col("rank")) & (F.col("prev_c") < F.col("rank"))
    val = F.when(inf, F.col("max_finite")).otherwise(
        F.col("prev_le") + (F.col("le") - F.col("prev_le")) *
        (F.col("rank") - F.col("prev_c")) / (F.col("bucket_count") - F.col("prev_c")))
    return h.groupBy(*by, "q").agg(F.max(F.when(pick, val)).alias("value")).select(*by, "value", "q")


def exact_quantiles(df: DataFrame, value: str, by: list[str], qs, tiebreak: str) -> DataFrame:
    """A-10: exact quantiles (linear interpolation, as ``percentile``), skew-safe.

    ``percentile`` buffers every value of a group in one task; here values
    are ranked with a distributed ordered scan, the group sizes counted, and
    only the (at most two per quantile) rows at the wanted ranks kept.
    """
    base = df.filter(F.col(value).isNotNull()).select(*by, value, tiebreak)
    ranked = ordered_scan(base, by, [value, tiebreak], sums={"__rn": F.lit(1)})
    sizes = ranked.groupBy(*by).agg(F.max("__rn").alias("__n"))  # from the written scan: the input is not read again
    cols = []
    for i, q in enumerate(qs):
        pos = (F.col("__n") - 1) * F.lit(float(q))
        cols += [(F.floor(pos) + 1).cast("long").alias(f"__lo{i}"),
                 (F.ceil(pos) + 1).cast("long").alias(f"__hi{i}"),
                 (pos - F.floor(pos)).alias(f"__fr{i}")]
    targets = sizes.select(*by, "__n", *cols)
    j = ranked.join(targets, by)
    hit = F.lit(False)
    for i in range(len(qs)):
        hit = hit | (F.col("__rn") == F.col(f"__lo{i}")) | (F.col("__rn") == F.col(f"__hi{i}"))
    picked = j.filter(hit)
    aggs = []
    for i in range(len(qs)):
        aggs += [F.max(F.when(F.col("__rn") == F.col(f"__lo{i}"), F.col(value))).alias(f"__vlo{i}"),
                 F.max(F.when(F.col("__rn") == F.col(f"__hi{i}"), F.col(value))).alias(f"__vhi{i}"),
                 F.max(f"__fr{i}").alias(f"__f{i}")]
    agg = picked.groupBy(*by).agg(F.max("__n").alias("n"), *aggs)
    outs = []
    for i, q in enumerate(qs):
        name = "p" + format(q * 100, "g").replace(".", "_")
        lo, hi, fr = F.col(f"__vlo{i}"), F.col(f"__vhi{i}"), F.col(f"__f{i}")
        outs.append((lo + (hi - lo) * fr).alias(name))
    return agg.select(*by, "n", *outs)


def approx_quantiles(df: DataFrame, value: str, by: list[str], qs, accuracy: int = 10000) -> DataFrame:
    """A-10 at scale: ``percentile_approx`` (bounded sketch per group)."""
    return (df.groupBy(*by).agg(F.percentile_approx(value, list(qs), accuracy).alias("q"))
            .select(*by, *[F.col("q")[i].alias("p" + format(q * 100, "g").replace(".", "_"))
                           for i, q in enumerate(qs)]))


def shard_balance(df: DataFrame, n_shards: int, tolerance: float = 0.4) -> DataFrame:
    """A-11: count and share per shard, within ``±tolerance`` of ideal, all shards used."""
    counts = df.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    full = (shard_frame(df.sparkSession, n_shards).join(counts, "shard", "left")
            .select("shard", F.coalesce("rows", F.lit(0)).cast("long").alias("rows")))
    tot = full.agg(F.sum("rows").alias("total"), F.min("rows").alias("__min"))
    j = with_scalars(full, tot)
    ideal = F.col("total") / F.lit(n_shards)
    return j.select(
        "shard", "rows", "total",
        F.round(F.col("rows") / F.col("total"), 6).alias("share"),
        ((F.col("rows") >= ideal * (1 - tolerance)) & (F.col("rows") <= ideal * (1 + tolerance))).alias("within_tolerance"),
        (F.col("__min") > 0).alias("all_shards_used"))


def shards_per_key(df: DataFrame, key: str, shard: str = "shard", approx: bool = False) -> DataFrame:
    """A-12: distinct shards per key (two-phase distinct aggregation); with
    ``approx`` a HyperLogLog sketch per key instead."""
    n = F.approx_count_distinct(shard) if approx else F.count_distinct(shard)
    return df.groupBy(key).agg(n.alias("n_shards"))


def health(states: DataFrame, name: str = "name", state: str = "state") -> DataFrame:
    """A-13: ``ok`` unless some breaker is open; plus the name -> state map.

    The map holds one entry per dependency (configuration-sized).
    """
    return states.agg(
        F.when(F.every(F.col(state) != "open"), F.lit("ok")).otherwise(F.lit("degraded")).alias("status"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(name), F.col(state))))).alias("circuit_breakers"))


def batch_stats(df: DataFrame, valid: Column, msg_id: str = "msg_id", order: str = "poll_seq") -> DataFrame:
    """A-14: received / inserted / skipped and the first and last message id per poll batch."""
    return (df.groupBy("shard", "batch_no")
            .agg(F.count(F.lit(1)).alias("received"),
                 F.count_if(valid).alias("inserted"),
                 F.count_if(~valid).alias("skipped"),
                 F.min_by(msg_id, order).alias("first_msg_id"), F.max_by(msg_id, order).alias("last_msg_id")))


def ingest_report(outcomes: DataFrame, ts: str = "ts") -> DataFrame:
    """A-15: sent, ok, errors, duration and rates (per second, per minute)."""
    us = ts_micros(outcomes, ts)
    r = outcomes.agg(F.count(F.lit(1)).alias("sent"), F.count_if(F.col("ok")).alias("ok"),
                     F.count_if(~F.col("ok")).alias("errors"),
                     ((F.max(us) - F.min(us)) / 1e6).alias("duration_s"))
    rate = F.when(F.col("duration_s") > 0, F.col("sent") / F.col("duration_s"))
    return r.select("*", F.round(rate, 6).alias("rate_per_s"), F.round(rate * 60, 6).alias("rate_per_min"))


def lag_per_shard(pending_rows: DataFrame, n_shards: int, threshold: int = LAG_ALERT) -> DataFrame:
    """A-16: pending (delivered, not acked) per shard and the alert flag.

    The documented ``XLEN - (XLEN - pending)`` is just the pending count.
    """
    counts = pending_rows.groupBy("shard").agg(F.count(F.lit(1)).alias("lag"))
    return (shard_frame(pending_rows.sparkSession, n_shards).join(counts, "shard", "left")
            .select("shard", F.coalesce("lag", F.lit(0)).cast("long").alias("lag"))
            .withColumn("alert", F.col("lag") > threshold))


def retry_rollup(attempts: DataFrame, max_retries: int = RETRY_MAX, delay: float = RETRY_DELAY_S,
                 backoff: float = RETRY_BACKOFF) -> DataFrame:
    """A-17: per operation: attempts made, recovered / exhausted, backoff waited.

    Attempts stop at the first success; the wait before attempt ``k+1`` is
    ``delay * backoff^(k-1)``, so ``g`` gaps wait ``delay*(backoff^g-1)/(backoff-1)``.
    """
    g = attempts.groupBy("op_id").agg(
        F.count(F.lit(1)).alias("attempts_seen"),
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("first_ok"),
        F.max("attempt").alias("last_attempt"))
    used = F.coalesce(F.col("first_ok"), F.col("last_attempt"))
    gaps = (used - 1).cast("double")
    if backoff == 1:
        waited = F.lit(delay) * gaps
    else:
        waited = F.lit(delay) * (F.pow(F.lit(backoff), gaps) - 1) / F.lit(backoff - 1)
    return g.select(
        "op_id", used.cast("int").alias("attempts"),
        F.col("first_ok").isNotNull().alias("recovered"),
        (F.col("first_ok").isNull() & (F.col("last_attempt") >= max_retries)).alias("exhausted"),
        F.round(waited, 6).alias("waited_s"))


