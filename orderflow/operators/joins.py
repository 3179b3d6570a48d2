"""Join-shaped operators over orders, ledger rows and acks (J-01 .. J-05, W-08).

Acks are keyed by ``(shard, order_id)``; every join carries ``shard`` so a
table stored ``partitionBy('shard')`` gets dynamic partition pruning, and
AQE may turn a join into a broadcast only from measured runtime sizes.
Hot keys are split by AQE's skew-join handling of sort-merge joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.routing import add_all_shards, add_sha1_shard, add_shard_at
from orderflow.operators.aggregates import exact_quantiles
from orderflow.operators.scan import ordered_scan
from orderflow.operators.util import ts_micros

KEY = ["shard", "order_id"]


def _acked_keys(acks: DataFrame) -> DataFrame:
    # An order acked several times is one mark (partial aggregation first).
    return acks.select(*KEY).distinct()


def ack_status(requests: DataFrame, acks: DataFrame, n_shards: int) -> DataFrame:
    """J-01: each requested ``(request_id, order_id)`` -> ``acked`` / ``pending``."""
    req = add_sha1_shard(requests.select("request_id", "order_id").distinct(), "order_id", n_shards)
    marks = _acked_keys(acks).withColumn("__hit", F.lit(True))
    return (req.join(marks, KEY, "left")
            .select("request_id", "order_id", "shard",
                    F.when(F.col("__hit"), F.lit("acked")).otherwise(F.lit("pending")).alias("status")))


def ack_status_resharded(requests: DataFrame, acks: DataFrame, history: list[tuple], at: str | None = None) -> DataFrame:
    """J-01 after the number of shards changed: an order is looked up where it was written.

    ``history`` lists ``(valid_from, shards)``. With ``at`` (the request's column
    that tells when the order was produced) its shard of that time is looked
    up. Without it all shards that the id was ever routed to are (one per
    history entry at most), and ``shard`` is the one that has the mark, the
    newest routing's if none has. Marks written before a change stay where
    they are; nothing is moved.
    """
    marks = _acked_keys(acks).withColumn("__hit", F.lit(True))
    status = F.when(F.col("__hit"), F.lit("acked")).otherwise(F.lit("pending")).alias("status")
    if at is not None:
        req = add_shard_at(requests.select("request_id", "order_id", at).distinct(), "order_id", at, history)
        return req.join(marks, KEY, "left").select("request_id", "order_id", at, "shard", status)
    req = add_all_shards(requests.select("request_id", "order_id").distinct(), "order_id", history)
    tried = req.select("request_id", "order_id", F.posexplode("shards").alias("__nth", "shard"))
    found = tried.join(marks, KEY, "left")
    # of the few shards of one id: one with a mark, else the newest
    best = F.struct(F.col("__hit").isNull().alias("none"), F.col("__nth").alias("nth"), F.col("shard").alias("shard"))
    return found.groupBy("request_id", "order_id").agg(F.min(best).alias("b"), F.max("__hit").alias("__hit")) \
        .select("request_id", "order_id", F.col("b.shard").alias("shard"), status)


def ack_status_as_of(requests: DataFrame, acks: DataFrame, n_shards: int, ttl_s: int, as_of: str = "as_of",
                     ack_ts: str = "ack_ts", tiebreak: str = "order_id") -> DataFrame:
    """T-08 with J-01: the status that each request saw at its own time ``as_of``.

    A shard's acks expire together once ``ttl_s`` pass without a flush. The
    lifetimes are intervals that don't overlap, so the one that holds a
    request's time is the last that began before it: one ordered scan over the
    beginnings and all requests, merged by time, finds it for every request. An
    order is acked if its first ack in that lifetime is not after ``as_of``.
    A request without a time, or before every ack, is pending.
    """
    us = ts_micros(acks, ack_ts)
    rows = acks.select(*KEY, us.alias("__us")).filter(F.col("__us").isNotNull())
    lagged = ordered_scan(rows, ["shard"], ["__us", tiebreak], lags={"__prev": F.col("__us")})
    began = F.col("__prev").isNull() | (F.col("__us") - F.col("__prev") >= ttl_s * 1_000_000)
    lived = ordered_scan(lagged, ["shard"], ["__us", tiebreak], maxes={"__began": F.when(began, F.col("__us"))})
    firsts = lived.groupBy(*KEY, "__began").agg(F.min("__us").alias("__acked"))
    lives = lived.groupBy("shard", "__began").agg((F.max("__us") + ttl_s * 1_000_000).alias("__ends"))
    req = add_sha1_shard(requests.select("request_id", "order_id", as_of).distinct(), "order_id", n_shards)
    req = req.withColumn("__at", ts_micros(req, as_of))
    none = F.lit(None)
    starts = lives.select("shard", none.cast("string").alias("request_id"), none.cast("string").alias("order_id"),
                          none.cast(req.schema[as_of].dataType).alias(as_of), F.col("__began").alias("__at"),
                          F.struct(F.col("__began").alias("began"), F.col("__ends").alias("ends")).alias("__life"))
    asked = req.select("shard", F.col("request_id").cast("string"), "order_id", as_of, "__at",
                       none.cast(starts.schema["__life"].dataType).alias("__life"))
    merged = ordered_scan(starts.unionByName(asked), ["shard"],
                          [F.col("__at").asc_nulls_first(), F.col("__life").isNull(), "request_id", "order_id"],
                          maxes={"__in": F.col("__life")}).filter(F.col("__life").isNull())
    live = F.when(F.col("__at") < F.col("__in.ends"), F.col("__in.began"))
    j = merged.withColumn("__live", live).join(
        firsts.select(F.col("shard").alias("__s"), F.col("order_id").alias("__o"), "__began", "__acked"),
        (F.col("shard") == F.col("__s")) & (F.col("order_id") == F.col("__o")) & (F.col("__live") == F.col("__began")), "left")
    hit = F.coalesce(F.col("__acked") <= F.col("__at"), F.lit(False))
    return j.select(F.col("request_id").cast(requests.schema["request_id"].dataType), "order_id", as_of, "shard",
                    F.when(hit, F.lit("acked")).otherwise(F.lit("pending")).alias("status"))


def acked(orders: DataFrame, acks: DataFrame) -> DataFrame:
    """J-02: orders with an ack mark (left semi join)."""
    return orders.join(_acked_keys(acks), KEY, "left_semi")


def pending(delivered: DataFrame, acks: DataFrame) -> DataFrame:
    """J-03: delivered but not acked (left anti join)."""
    return delivered.join(_acked_keys(acks), KEY, "left_anti")


def first_wins(batch: DataFrame, key: str = "order_id", order: list[str] = ("msg_ms", "msg_seq")) -> DataFrame:
    """In-batch dedup keeping the earliest message per key.

    ``min_by`` aggregates map-side, so a key repeated in a third of the batch
    is reduced before the shuffle (a window would sort it in one task).
    """
    others = [c for c in batch.columns if c != key]
    return (batch.groupBy(key)
            .agg(F.min_by(F.struct(*[F.col(c) for c in others]),
                          F.struct(*[F.col(c) for c in order])).alias("__first"))
            .select(key, "__first.*")
            .select(*batch.columns))


def insert_new(batch: DataFrame, ledger: DataFrame, key: str = "order_id",
               order: list[str] = ("msg_ms", "msg_seq")) -> DataFrame:
    """J-04: ``INSERT … ON CONFLICT DO NOTHING``: first-wins inside the batch,
    then drop keys already stored (anti join on ``(shard, key)``)."""
    first = first_wins(batch, key, order)
    stored = ledger.select("shard", key).distinct()
    return first.join(stored, ["shard", key], "left_anti").select(*batch.columns)


def reconcile(submitted: DataFrame, ledger: DataFrame, key: str = "order_id") -> DataFrame:
    """J-05: submitted vs persisted, both directions.

    One row per key: ``submitted, stored`` counts and ``state`` in
    ``ok`` / ``missing`` / ``duplicate`` / ``extra``.
    """
    s = submitted.groupBy(key).agg(F.count(F.lit(1)).alias("submitted"))
    l = ledger.groupBy(key).agg(F.count(F.lit(1)).alias("stored"))
    j = s.join(l, key, "full_outer").select(
        key, F.coalesce("submitted", F.lit(0)).alias("submitted"),
        F.coalesce("stored", F.lit(0)).alias("stored"))
    state = (F.when(F.col("submitted") == 0, F.lit("extra"))
             .when(F.col("stored") == 0, F.lit("missing"))
             .when(F.col("stored") > 1, F.lit("duplicate"))
             .otherwise(F.lit("ok")))
    return j.withColumn("state", state)


def digests(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Per bucket of the key's hash: row count and two sums of independent 64-bit hashes, whatever the rows' order."""
    text = F.col(key).cast("string")
    wide = [F.sum(F.xxhash64(*cols).cast("decimal(38,0)")) for cols in ((text,), (F.lit(1), text))]
    return df.groupBy(F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int").alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("n"), wide[0].alias("sum_a"), wide[1].alias("sum_b"))


def reconcile_digests(submitted: DataFrame, ledger: DataFrame, key: str = "order_id", buckets: int = 1024) -> DataFrame:
    """J-05 with the rows of :func:`reconcile`, joining only what differs.

    Both sides are summed up to one digest per bucket, map-side. Buckets with
    equal digests hold the same keys equally often (but for a chance of about
    2^-128), so their rows come from ``submitted`` alone; the others, of which
    at most ``buckets`` numbers pass the driver, are joined. Two equal sides
    join no row.
    """
    a, b = digests(submitted, key, buckets), digests(ledger, key, buckets)
    both = a.join(b.select("bucket", *[F.col(c).alias(f"__{c}") for c in ("n", "sum_a", "sum_b")]), "bucket", "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("n", "sum_a", "sum_b")])
    differ = sorted(r[0] for r in both.filter(~same).select("bucket").toLocalIterator())
    here = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int").isin(differ)
    equal = submitted.filter(~here).groupBy(key).agg(F.count(F.lit(1)).alias("submitted")) \
        .withColumn("stored", F.col("submitted")) \
        .withColumn("state", F.when(F.col("stored") > 1, F.lit("duplicate")).otherwise(F.lit("ok")))
    return equal.unionByName(reconcile(submitted.filter(here), ledger.filter(here), key)) if differ else equal


def ack_latency(messages: DataFrame, acks: DataFrame, msg_ts: str = "ts",
                ack_ts: str = "ack_ts") -> DataFrame:
    """W-08: produce -> first ack time per order, in seconds."""
    first = acks.groupBy(*KEY).agg(F.min(ack_ts).alias("ack_ts"))
    j = messages.select(*KEY, F.col(msg_ts).alias("msg_ts")).join(first, KEY)
    lat = (ts_micros(j, "ack_ts") - ts_micros(j, "msg_ts")) / 1e6
    return j.withColumn("latency_s", lat)


def ack_latency_quantiles(messages: DataFrame, acks: DataFrame, qs=(0.5, 0.9, 0.99)) -> DataFrame:
    """W-08 summary: exact latency quantiles per shard."""
    lat = ack_latency(messages, acks)
    return exact_quantiles(lat, "latency_s", ["shard"], qs, tiebreak="order_id")


def next_match(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
               l_id: str, r_id: str, within_s: float | None = None) -> DataFrame:
    """As-of join: for each left row, the first right row of the same key at or after it.

    T-10's batch twin ("poll until acked or timeout"). Both sides are merged
    per key in descending time; the running minimum of the right rows' (time,
    id) is the nearest following one, so nothing is joined, no pairs are made
    within a key, and a hot key is spread by the ordered scan. Adds
    ``match_ts``, ``match_id``, ``latency_s`` and ``matched`` (within
    ``within_s`` when given); a row with a NULL key matches nothing.
    """
    from orderflow.sources.tables import ntz_from_micros
    row = F.struct(*[F.col(c) for c in left.columns])
    lefts = left.select(F.col(key).alias("__k"), ts_micros(left, l_ts).alias("__us"), F.lit(1).alias("__kind"),
                        F.col(l_id).cast("string").alias("__id"), row.alias("__row"))
    rights = right.select(F.col(key).alias("__k"), ts_micros(right, r_ts).alias("__us"), F.lit(0).alias("__kind"),
                          F.col(r_id).cast("string").alias("__id"), F.lit(None).cast(lefts.schema["__row"].dataType).alias("__row"))
    found = F.when((F.col("__kind") == 0) & F.col("__k").isNotNull(), F.struct("__us", "__id"))
    scanned = ordered_scan(lefts.unionByName(rights), ["__k"],
                           [F.col("__us").desc(), F.col("__kind").asc(), F.col("__id").desc()], mins={"__next": found})
    res = scanned.filter(F.col("__kind") == 1)
    lat = (F.col("__next.__us") - F.col("__us")) / 1e6
    matched = F.col("__next").isNotNull()
    if within_s is not None:
        matched = matched & (lat <= within_s)
    return res.select("__row.*", F.coalesce(matched, F.lit(False)).alias("matched"),
                      F.when(matched, ntz_from_micros("__next.__us")).alias("match_ts"),
                      F.when(matched, F.col("__next.__id")).alias("match_id"),
                      F.when(matched, lat).alias("latency_s"))
