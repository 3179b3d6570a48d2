"""Registered queries: one per operator of the inventory, each with its DuckDB twin.

Every query reads the driver tables (or views Spark derives from them) in
full; none filters rows to make the check cheaper. Parameters (shard count
4, thresholds, windows) are fixed here once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions import codec, routing
from orderflow.operators import aggregates as agg
from orderflow.operators import joins, ordering, validate, windows
from orderflow.plans.oracle import duck_java_hash, duck_java_shard, duck_sha1_shard, with_views
from orderflow.schemas import CONSUMER_BUCKETS, PRODUCER_BUCKETS
from orderflow.sources import tables as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

N = 4


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _items_text(col="items"):
    return F.array_join(F.col(col), "|")


# ---------------------------------------------------------------- A-04 / O-01
@register("audit_by_shard", with_views(["ord"], """
SELECT shard, rows, CAST(CAST(sign(cents) * ((2 * abs(cents) + n) // (2 * n)) AS DECIMAL(20,0)) / 100 AS DECIMAL(10,2)) AS avg_amount
FROM (SELECT shard, count(*) AS rows, count(amount)::HUGEINT AS n, (sum(CAST(amount AS DECIMAL(12,2))) * 100)::HUGEINT AS cents
      FROM ord GROUP BY shard)
ORDER BY shard"""))
def q_audit_by_shard(spark, sf):
    return agg.audit_by_shard(tb.orders_view(spark, sf, with_items=False))


# ---------------------------------------------------------------- F-01
@register("shard_routing", with_views(["ord"], f"""
SELECT order_id, shard AS shard_4, {duck_sha1_shard('order_id', 7)} AS shard_7,
       {duck_sha1_shard('order_id', 1000)} AS shard_1000
FROM ord"""))
def q_shard_routing(spark, sf):
    o = tb.orders_view(spark, sf, with_items=False)
    return o.select("order_id", F.col("shard").alias("shard_4"),
                    routing.sha1_shard("order_id", 7).alias("shard_7"),
                    routing.sha1_shard("order_id", 1000).alias("shard_1000"))


# ---------------------------------------------------------------- F-02
@register("java_routing", with_views(["ord"], f"""
SELECT order_id, CAST({duck_java_hash('order_id')} AS BIGINT) AS java_hash,
       {duck_java_shard('order_id', 4)} AS java_shard_4,
       {duck_java_shard('order_id', 7)} AS java_shard_7
FROM ord"""))
def q_java_routing(spark, sf):
    o = tb.orders_view(spark, sf, with_items=False)
    return o.select("order_id", routing.java_string_hash("order_id").alias("java_hash"),
                    routing.java_shard("order_id", 4).alias("java_shard_4"),
                    routing.java_shard("order_id", 7).alias("java_shard_7"))


# ---------------------------------------------------------------- F-08
@register("stream_keys", with_views(["ord"], """
SELECT order_id, 'orders:stream:' || shard AS stream_key, 'orders:acks:' || shard AS ack_key,
       CAST(regexp_extract('orders:stream:' || shard, ':(\\d+)$', 1) AS INTEGER) AS parsed_shard
FROM ord"""))
def q_stream_keys(spark, sf):
    o = tb.orders_view(spark, sf, with_items=False)
    sk = routing.stream_key("shard")
    return o.select("order_id", sk.alias("stream_key"),
                    routing.stream_key("shard", routing.ACK_BASE).alias("ack_key"),
                    routing.shard_of_key(sk).alias("parsed_shard"))


# ---------------------------------------------------------------- W-02 / F-03
@register("msg_ids", with_views(["msg"], """
SELECT order_id, shard, msg_id,
       CAST(split_part(msg_id, '-', 1) AS BIGINT) AS msg_ms,
       CAST(split_part(msg_id, '-', 2) AS BIGINT) AS msg_seq,
       make_timestamp(CAST(split_part(msg_id, '-', 1) AS BIGINT) * 1000) AS msg_ts
FROM msg"""))
def q_msg_ids(spark, sf):
    m = tb.messages_view(spark, sf, with_items=False)
    ts, seq = codec.parse_msg_id("msg_id")
    return m.select("order_id", "shard", "msg_id", codec.msg_id_millis("msg_id").alias("msg_ms"),
                    seq.alias("msg_seq"),
                    tb.ntz_from_millis(codec.msg_id_millis("msg_id")).alias("msg_ts"))


# ---------------------------------------------------------------- S-02
START_ID = "883612800000-0"


@register("from_position", with_views(["msg"], """
SELECT order_id, shard, msg_id FROM msg
WHERE msg_ms > 883612800000 OR (msg_ms = 883612800000 AND msg_seq > 0)"""))
def q_from_position(spark, sf):
    from orderflow.sources.messages import from_position
    m = tb.messages_view(spark, sf)
    return from_position(m, START_ID).select("order_id", "shard", "msg_id")


# ---------------------------------------------------------------- W-01 / W-02 / S-02 / S-12 over a written log
def _appended_log(spark, sf, replay=False):
    """A message log written by three appends; the cuts lie inside a millisecond that both sides share."""
    from orderflow.session import scratch_path
    from orderflow.sources.message_log import append_messages
    o = tb.orders_view(spark, sf, with_items=False).select("order_id", "shard", "ts", "o_orderkey")
    us = tb.ntz_micros("ts")
    cuts = o.agg(F.percentile_approx(us, [0.3, 0.7], 100000), F.percentile_approx("o_orderkey", 0.5)).first()
    key = cuts[1]

    def behind(at):
        return (us > at) | ((us == at) & (F.col("o_orderkey") > key))

    part = F.when(behind(cuts[0][1]), 2).when(behind(cuts[0][0]), 1).otherwise(0)
    path = scratch_path(spark, "message-log")
    for batch in (0, 1, 1, 2) if replay else (0, 1, 2):
        append_messages(o.filter(part == batch), path, batch)
    return path


@register("msg_ids_appended", with_views(["msg"], """
SELECT order_id, shard, msg_id, msg_ms, msg_seq,
       row_number() OVER (PARTITION BY shard ORDER BY msg_ms, msg_seq) AS pos
FROM msg"""))
def q_msg_ids_appended(spark, sf):
    """W-02: ids given at append, over three appends that share milliseconds, one of them replayed."""
    from orderflow.sources.message_log import read_log
    return read_log(spark, _appended_log(spark, sf, replay=True)).select("order_id", "shard", "msg_id", "msg_ms", "msg_seq", "pos")


@register("poll_batches_appended", with_views(["msg"], """
SELECT shard, batch_no, count(*) AS received, min(order_id) AS least_order,
       arg_min(msg_id, poll_seq) AS first_msg_id, arg_max(msg_id, poll_seq) AS last_msg_id
FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY msg_ms, msg_seq) AS poll_seq,
             (row_number() OVER (PARTITION BY shard ORDER BY msg_ms, msg_seq) - 1) // 500 AS batch_no
      FROM msg)
GROUP BY shard, batch_no"""))
def q_poll_batches_appended(spark, sf):
    """W-01 over the growing log: read batches by stored position, whatever append wrote them."""
    from orderflow.sources.message_log import polls, read_log
    return polls(read_log(spark, _appended_log(spark, sf)), 500).groupBy("shard", "batch_no").agg(
        F.count(F.lit(1)).alias("received"), F.min("order_id").alias("least_order"),
        F.min_by("msg_id", "poll_seq").alias("first_msg_id"), F.max_by("msg_id", "poll_seq").alias("last_msg_id"))


@register("from_position_log", with_views(["msg"], """
SELECT order_id, shard, msg_id FROM msg
WHERE (shard = 0 AND (msg_ms > 883612800000 OR (msg_ms = 883612800000 AND msg_seq > 0))) OR shard = 1
   OR (shard = 2 AND msg_ms > 800000000000)"""))
def q_from_position_log(spark, sf):
    """S-02 on a written log, each shard from its own position; shard 3 waits for new messages only."""
    from orderflow.sources.message_log import log_from
    start = {0: START_ID, 1: "0-0", 2: "800000000000-9", 3: "$"}
    return log_from(spark, _appended_log(spark, sf), start).select("order_id", "shard", "msg_id")


@register("retention_trim", with_views(["msg"], """
SELECT order_id, shard, msg_id FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY msg_ms DESC, msg_seq DESC) AS rn FROM msg)
WHERE rn <= 100"""))
def q_retention_trim(spark, sf):
    """S-12 on a written log: files below the border are deleted, the one it cuts is rewritten; trimmed twice."""
    from orderflow.sources.message_log import read_log, trim_log
    path = _appended_log(spark, sf)
    trim_log(spark, path, 150)
    trim_log(spark, path, 100)
    return read_log(spark, path).select("order_id", "shard", "msg_id")


# ---------------------------------------------------------------- P-01 / P-02 / F-05
@register("decoded_orders", with_views(["decoded"], """
SELECT msg_id, shard,
       CASE WHEN len(errors) = 0 THEN json_extract_string(j, '$.order_id') END AS order_id,
       CASE WHEN len(errors) = 0 THEN json_extract_string(j, '$.customer_id') END AS customer_id,
       CASE WHEN len(errors) = 0 THEN CAST(json_extract(j, '$.amount') AS DOUBLE) END AS amount,
       CASE WHEN len(errors) = 0 THEN CAST(len(CAST(json_extract(j, '$.items') AS VARCHAR[])) AS INTEGER) END AS n_items,
       CASE WHEN len(errors) = 0 THEN array_to_string(CAST(json_extract(j, '$.items') AS VARCHAR[]), '|') END AS items_text,
       array_to_string(errors, ';') AS errors
FROM decoded"""))
def q_decoded_orders(spark, sf):
    d = validate.decode_orders(tb.malformed_messages_view(spark, sf))
    return d.select("msg_id", "shard", "order_id", "customer_id", "amount",
                    F.when(F.col("items").isNotNull(), F.size("items")).alias("n_items"),
                    _items_text().alias("items_text"), F.array_join("errors", ";").alias("errors"))


# ---------------------------------------------------------------- P-03
@register("malformed_split", with_views(["decoded"], """
SELECT msg_id, shard, array_to_string(errors, ';') AS reason FROM decoded WHERE len(errors) > 0"""))
def q_malformed_split(spark, sf):
    _, bad = validate.split_malformed(tb.malformed_messages_view(spark, sf))
    return bad.select("msg_id", "shard", "reason")


# ---------------------------------------------------------------- P-04
@register("order_validation", with_views(["decoded"], """
SELECT len(errors) = 0 AS valid, array_to_string(errors, ';') AS errors, count(*) AS messages
FROM decoded GROUP BY ALL"""))
def q_order_validation(spark, sf):
    v = validate.validate_orders(tb.malformed_messages_view(spark, sf))
    return (v.groupBy("valid", F.array_join("errors", ";").alias("errors"))
            .agg(F.count(F.lit(1)).alias("messages")))


# ---------------------------------------------------------------- P-05
@register("created_messages", with_views(["msg"], """
SELECT shard, count(*) AS messages FROM msg WHERE o_orderkey % 7 <> 0 GROUP BY shard"""))
def q_created_messages(spark, sf):
    m = tb.messages_view(spark, sf)
    m = m.withColumn("type", F.when(F.col("o_orderkey") % 7 == 0, F.lit("order_changed")).otherwise(F.col("type")))
    m = validate.of_type(m)
    return m.groupBy("shard").agg(F.count(F.lit(1)).alias("messages"))


# ---------------------------------------------------------------- P-06
@register("ledger_rows", with_views(["decoded"], """
SELECT order_id, customer_id, TRY_CAST(amount AS DECIMAL(12,2)) AS amount,
       array_to_string(items, '|') AS items_text, msg_id, shard
FROM good"""))
def q_ledger_rows(spark, sf):
    good, _ = validate.split_malformed(tb.malformed_messages_view(spark, sf))
    led = validate.to_ledger(good)
    return led.select("order_id", "customer_id", "amount", _items_text().alias("items_text"),
                      "msg_id", "shard")


# ---------------------------------------------------------------- P-07
@register("find_order", with_views(["ord"], """
SELECT order_id, customer_id, amount, shard FROM ord WHERE order_id = 'ORD-7'"""))
def q_find_order(spark, sf):
    o = tb.orders_view(spark, sf, with_items=False)
    return validate.find_order(o, "ORD-7", N).select("order_id", "customer_id", "amount", "shard")


# ---------------------------------------------------------------- P-08
@register("count_prefix", with_views(["ord"], """
SELECT count(*) AS n FROM ord WHERE order_id LIKE 'ORD-1%'"""))
def q_count_prefix(spark, sf):
    return validate.count_prefix(tb.orders_view(spark, sf, with_items=False), "ORD-1")


# ---------------------------------------------------------------- P-09
@register("contains_items", with_views(["ord"], """
SELECT order_id, shard FROM ord WHERE list_contains(items, 'PART-1')"""))
def q_contains_items(spark, sf):
    return validate.contains_items(tb.orders_view(spark, sf), ["PART-1"]).select("order_id", "shard")


# ---------------------------------------------------------------- P-10
def _requests(spark, sf):
    o = tb.orders_view(spark, sf)
    ids = F.concat(F.array_join(F.transform("items", lambda i: F.replace(i, F.lit("PART-"), F.lit("ORD-"))),
                                " ,\t"), F.lit("\n\u00a0 , \t\u3000,\x1c"), F.col("order_id"), F.lit("\u2003,\x85"))
    return o.select(F.col("order_id").alias("request_id"), ids.alias("ids"))


def _parsed(spark, sf):
    return validate.parse_ids(_requests(spark, sf), "ids", max_ids=5)


@register("parsed_ids", with_views(["requests"], """
SELECT request_id, n_ids, CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status, error,
       array_to_string(id_list, ',') AS ids
FROM parsed"""))
def q_parsed_ids(spark, sf):
    p = _parsed(spark, sf)
    return p.select("request_id", "n_ids", "status", "error", F.array_join("id_list", ",").alias("ids"))


# ---------------------------------------------------------------- J-01 / U-02
def _parsed_all(spark, sf):
    return validate.parse_ids(_requests(spark, sf), "ids")


def _status(spark, sf):
    req = validate.requested_ids(_parsed_all(spark, sf))
    return joins.ack_status(req, tb.acks_view(spark, sf), N)


@register("ack_status", with_views(["requests"], """
SELECT request_id, order_id, shard, status FROM status"""))
def q_ack_status(spark, sf):
    return _status(spark, sf)


# ---------------------------------------------------------------- A-01
@register("ack_rollup_by_request", with_views(["requests"], """
SELECT request_id, count(*) AS total, count(*) FILTER (WHERE status = 'acked') AS acked,
       count(*) - count(*) FILTER (WHERE status = 'acked') AS pending,
       CASE WHEN count(*) = 0 THEN 0.0
            ELSE round(count(*) FILTER (WHERE status = 'acked') * 100.0 / count(*), 2) END AS pct_complete
FROM status GROUP BY request_id"""))
def q_ack_rollup_by_request(spark, sf):
    return agg.ack_rollup(_status(spark, sf), ["request_id"])


def _all_status(spark, sf):
    o = tb.orders_view(spark, sf, with_items=False).select(F.lit("all").alias("request_id"), "order_id")
    return joins.ack_status(o, tb.acks_view(spark, sf), N)


@register("ack_rollup", with_views(["ord", "ack"], """
SELECT count(*) AS total, count(*) FILTER (WHERE a.order_id IS NOT NULL) AS acked,
       count(*) - count(*) FILTER (WHERE a.order_id IS NOT NULL) AS pending,
       CASE WHEN count(*) = 0 THEN 0.0
            ELSE round(count(*) FILTER (WHERE a.order_id IS NOT NULL) * 100.0 / count(*), 2) END AS pct_complete
FROM (SELECT DISTINCT order_id, shard FROM ord) o
LEFT JOIN (SELECT DISTINCT shard, order_id FROM ack) a ON o.shard = a.shard AND o.order_id = a.order_id"""))
def q_ack_rollup(spark, sf):
    return agg.ack_rollup(_all_status(spark, sf))


# ---------------------------------------------------------------- J-02 / J-03
@register("acked_orders", with_views(["ord", "ack"], """
SELECT order_id, shard FROM ord o
WHERE EXISTS (SELECT 1 FROM ack a WHERE a.shard = o.shard AND a.order_id = o.order_id)"""))
def q_acked_orders(spark, sf):
    return joins.acked(tb.orders_view(spark, sf, with_items=False), tb.acks_view(spark, sf)).select("order_id", "shard")


@register("pending_orders", with_views(["ord", "ack"], """
SELECT order_id, shard FROM ord o
WHERE NOT EXISTS (SELECT 1 FROM ack a WHERE a.shard = o.shard AND a.order_id = o.order_id)"""))
def q_pending_orders(spark, sf):
    return joins.pending(tb.orders_view(spark, sf, with_items=False), tb.acks_view(spark, sf)).select("order_id", "shard")


# ---------------------------------------------------------------- J-04
def _replayed_batch(spark, sf):
    """Every message twice: the original and a re-send one second later."""
    m = tb.messages_view(spark, sf)
    m = m.withColumn("msg_ms", windows.ts_millis(m, "ts"))
    m = m.select("order_id", "shard", "msg_id", "msg_ms", "msg_seq")
    resend = m.select("order_id", "shard",
                      F.concat((F.col("msg_ms") + 1000).cast("string"), F.lit("-"), F.col("msg_seq").cast("string")).alias("msg_id"),
                      (F.col("msg_ms") + 1000).alias("msg_ms"), "msg_seq")
    return m.unionByName(resend)


@register("insert_new", with_views(["msg"], """
SELECT order_id, shard, msg_id FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY msg_ms, msg_seq) AS rn FROM (
    SELECT order_id, shard, msg_id, msg_ms, msg_seq FROM msg
    UNION ALL
    SELECT order_id, shard, (msg_ms + 1000) || '-' || msg_seq, msg_ms + 1000, msg_seq FROM msg)) b
WHERE rn = 1
  AND NOT EXISTS (SELECT 1 FROM msg l WHERE l.ts < TIMESTAMP '1998-01-01'
                  AND l.shard = b.shard AND l.order_id = b.order_id)"""))
def q_insert_new(spark, sf):
    batch = _replayed_batch(spark, sf)
    ledger = tb.orders_view(spark, sf, with_items=False).filter(F.col("ts") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return joins.insert_new(batch, ledger).select("order_id", "shard", "msg_id")


# ---------------------------------------------------------------- J-05
_RECONCILE_SQL = with_views(["decoded", "ack"], """
SELECT state, count(*) AS keys, CAST(sum(submitted) AS BIGINT) AS submitted_rows,
       CAST(sum(stored) AS BIGINT) AS stored_rows FROM (
  SELECT coalesce(s.order_id, l.order_id) AS order_id, coalesce(s.n, 0) AS submitted, coalesce(l.n, 0) AS stored,
         CASE WHEN coalesce(s.n, 0) = 0 THEN 'extra' WHEN coalesce(l.n, 0) = 0 THEN 'missing'
              WHEN l.n > 1 THEN 'duplicate' ELSE 'ok' END AS state
  FROM (SELECT order_id, count(*) AS n FROM ord GROUP BY order_id) s
  FULL OUTER JOIN (
    SELECT order_id, count(*) AS n FROM (
      SELECT order_id FROM good
      UNION ALL SELECT order_id FROM good WHERE year(ts) = 1996
      UNION ALL SELECT order_id FROM ack) GROUP BY order_id) l
  ON s.order_id = l.order_id)
GROUP BY state""")


def _reconciled(spark, sf, how):
    good, _ = validate.split_malformed(tb.malformed_messages_view(spark, sf))
    # orders of 1996 are stored twice: by an array, so that the payloads are decoded once
    twice = F.when(F.year("ts") == 1996, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    ledger = (good.select("order_id", F.explode(twice)).select("order_id")
              .unionByName(tb.acks_view(spark, sf).select("order_id")))
    r = how(tb.orders_view(spark, sf, with_items=False).select("order_id"), ledger)
    return r.groupBy("state").agg(F.count(F.lit(1)).alias("keys"),
                                  F.sum("submitted").alias("submitted_rows"),
                                  F.sum("stored").alias("stored_rows"))


@register("reconcile", _RECONCILE_SQL)
def q_reconcile(spark, sf):
    return _reconciled(spark, sf, joins.reconcile)


@register("reconcile_digests", _RECONCILE_SQL)
def q_reconcile_digests(spark, sf):
    """J-05: digests per key bucket first; the ledger, decoded once, is a written table here."""
    from orderflow.session import scratch_path

    def how(submitted, ledger):
        path = scratch_path(spark, "reconcile")
        ledger.write.parquet(path)
        return joins.reconcile_digests(submitted, spark.read.parquet(path), buckets=4096)

    return _reconciled(spark, sf, how)


# ---------------------------------------------------------------- A-02 / A-03
@register("ack_summary", with_views(["ack"], """
SELECT s.shard, coalesce(c.acked, 0) AS acked
FROM (SELECT CAST(range AS INTEGER) AS shard FROM range(4)) s
LEFT JOIN (SELECT shard, count(DISTINCT order_id) AS acked FROM ack GROUP BY shard) c ON s.shard = c.shard"""))
def q_ack_summary(spark, sf):
    return agg.ack_summary(tb.acks_view(spark, sf), N)


@register("ack_total", with_views(["ack"], """
SELECT shard, count(*) AS acked, CAST(grouping(shard) AS TINYINT) AS is_total
FROM (SELECT DISTINCT shard, order_id FROM ack) GROUP BY ROLLUP (shard)"""))
def q_ack_total(spark, sf):
    return agg.ack_total(tb.acks_view(spark, sf))


# ---------------------------------------------------------------- A-05 / A-06 / A-07
@register("published_total", with_views(["outcome"], """
SELECT shard, count(*) AS published FROM outcome WHERE ok GROUP BY shard"""))
def q_published_total(spark, sf):
    return agg.published_total(tb.outcomes_view(spark, sf))


@register("failed_total", with_views(["outcome"], """
SELECT shard, reason, count(*) AS failed FROM outcome WHERE NOT ok GROUP BY shard, reason"""))
def q_failed_total(spark, sf):
    return agg.failed_total(tb.outcomes_view(spark, sf))


@register("consumer_totals", with_views(["outcome", "attempt", "ack_log"], """
SELECT shard, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, CAST(sum(batches_ok) AS BIGINT) AS batches_ok,
       CAST(sum(failed_circuit_open) AS BIGINT) AS failed_circuit_open,
       CAST(sum(failed_retries_exhausted) AS BIGINT) AS failed_retries_exhausted,
       CAST(sum(acks_flushed) AS BIGINT) AS acks_flushed, CAST(sum(xack_failed) AS BIGINT) AS xack_failed
FROM (SELECT shard, CASE WHEN ok THEN CAST(floor(latency_s * 100) AS BIGINT) ELSE 0 END AS rows_inserted, ok::INT AS batches_ok,
             coalesce(reason = 'circuit_open', FALSE)::INT AS failed_circuit_open,
             coalesce(reason = 'retries_exhausted', FALSE)::INT AS failed_retries_exhausted, 0 AS acks_flushed, 0 AS xack_failed
      FROM outcome
      UNION ALL SELECT shard, 0, 0, 0, 0, 1, 0 FROM ack_log
      UNION ALL SELECT CAST(op_id % 4 AS INTEGER), 0, 0, 0, 0, 0, 1 FROM attempt GROUP BY op_id HAVING NOT bool_or(ok))
GROUP BY shard"""))
def q_consumer_totals(spark, sf):
    """Batch writes, ids flushed to the ack table, and acknowledgement calls all of whose attempts failed."""
    calls = tb.attempts_view(spark, sf).groupBy("op_id").agg(F.bool_or("ok").alias("ok"))
    return agg.consumer_totals(tb.outcomes_view(spark, sf), F.floor(F.col("latency_s") * 100).cast("long"),
                               tb.ack_log_view(spark, sf), calls.select((F.col("op_id") % 4).cast("int").alias("shard"), "ok"))


# ---------------------------------------------------------------- A-08 / A-09 / A-10
_B = PRODUCER_BUCKETS
_HIST_SQL = """hist AS (
  SELECT shard, bucket, le, bucket_count, hist_count, hist_sum FROM (
    SELECT o.shard, b.bucket, b.le,
           count(o.latency_s) FILTER (WHERE o.latency_s <= b.le) AS bucket_count
    FROM outcome o, (SELECT bucket, le FROM (VALUES """ + ", ".join(
    f"({i}, {b}::DOUBLE)" for i, b in enumerate(_B)) + f""", ({len(_B)}, 'inf'::DOUBLE)) t(bucket, le)) b
    GROUP BY o.shard, b.bucket, b.le) x
  JOIN (SELECT shard, count(latency_s) AS hist_count, sum(latency_s) AS hist_sum FROM outcome GROUP BY shard) t
  USING (shard))"""


@register("latency_histogram", with_views(["outcome"], "," + _HIST_SQL + """
SELECT shard, CAST(bucket AS INTEGER) AS bucket, le, bucket_count, hist_count, round(hist_sum, 6) AS hist_sum
FROM hist""").replace("\n,hist AS", ",\nhist AS"))
def q_latency_histogram(spark, sf):
    h = agg.histogram(tb.outcomes_view(spark, sf), "latency_s", _B, ["shard"])
    return h.withColumn("hist_sum", F.round("hist_sum", 6))


_QS = [0.5, 0.9, 0.99]


@register("latency_hist_quantile", with_views(["outcome"], "," + _HIST_SQL + """,
h2 AS (
  SELECT *, coalesce(lag(le) OVER (PARTITION BY shard ORDER BY bucket), 0.0) AS prev_le,
         coalesce(lag(bucket_count) OVER (PARTITION BY shard ORDER BY bucket), 0) AS prev_c,
         max(CASE WHEN le <> 'inf'::DOUBLE THEN le END) OVER (PARTITION BY shard) AS max_finite
  FROM hist),
qs AS (SELECT unnest([0.5, 0.9, 0.99]::DOUBLE[]) AS q)
SELECT shard, q, round(CASE WHEN le = 'inf'::DOUBLE THEN max_finite
                  ELSE prev_le + (le - prev_le) * (hist_count * q - prev_c) / (bucket_count - prev_c) END, 9) AS value
FROM h2, qs
WHERE hist_count > 0 AND bucket_count >= hist_count * q AND prev_c < hist_count * q"""))
def q_latency_hist_quantile(spark, sf):
    h = agg.histogram(tb.outcomes_view(spark, sf), "latency_s", _B, ["shard"])
    out = agg.histogram_quantile(h, _QS, ["shard"])
    return out.select("shard", "q", F.round("value", 9).alias("value"))


@register("latency_p99_1m", with_views(["outcome"], """,
o AS (SELECT date_trunc('minute', ts) AS minute, shard, latency_s,
             CASE WHEN ok THEN 200 WHEN reason = 'circuit_open' THEN 503 ELSE 502 END AS status_code FROM outcome),
h AS (SELECT minute, shard, status_code, bucket, le, count(*) FILTER (WHERE latency_s <= le) AS c, count(latency_s) AS n
      FROM o, (SELECT bucket, le FROM (VALUES """ + ", ".join(f"({i}, {b}::DOUBLE)" for i, b in enumerate(CONSUMER_BUCKETS)) +
          f""", ({len(CONSUMER_BUCKETS)}, 'inf'::DOUBLE)) t(bucket, le)) b GROUP BY ALL),""" + """
g AS (SELECT *, coalesce(lag(le) OVER w, 0.0) AS prev_le, coalesce(lag(c) OVER w, 0) AS prev_c,
             max(CASE WHEN le <> 'inf'::DOUBLE THEN le END) OVER (PARTITION BY minute, shard, status_code) AS top
      FROM h WINDOW w AS (PARTITION BY minute, shard, status_code ORDER BY bucket))
SELECT minute, shard, status_code,
       round(max(CASE WHEN n > 0 AND c >= n * 0.99 AND prev_c < n * 0.99 THEN
         CASE WHEN le = 'inf'::DOUBLE THEN top ELSE prev_le + (le - prev_le) * (n * 0.99::DOUBLE - prev_c) / (c - prev_c) END END), 9) AS p99
FROM g GROUP BY minute, shard, status_code"""))
def q_latency_p99_1m(spark, sf):
    """A-08 / A-09 over one-minute windows, by shard and status code, with the consumer's bounds."""
    o = validate.classify_outcome(tb.outcomes_view(spark, sf)).withColumn("minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    by = ["minute", "shard", "status_code"]
    out = agg.histogram_quantile(agg.histogram(o, "latency_s", CONSUMER_BUCKETS, by), 0.99, by)
    return out.select(*by, F.round("value", 9).alias("p99"))


@register("latency_quantiles", with_views(["outcome"], """
SELECT shard, count(latency_s) AS n,
       round(quantile_cont(latency_s, 0.5), 9) AS p50,
       round(quantile_cont(latency_s, 0.9), 9) AS p90,
       round(quantile_cont(latency_s, 0.99), 9) AS p99
FROM outcome GROUP BY shard"""))
def q_latency_quantiles(spark, sf):
    o = tb.outcomes_view(spark, sf)
    q = agg.exact_quantiles(o, "latency_s", ["shard"], _QS, tiebreak="event_id")
    return q.select("shard", "n", *[F.round(c, 9).alias(c) for c in ("p50", "p90", "p99")])


@register("latency_sketch_range", with_views(["outcome"], """
SELECT shard, date_trunc('week', ts)::TIMESTAMP AS week, count(*) AS n, count(latency_s) AS n_values,
       true AS p50_within, true AS p90_within, true AS p99_within, true AS users_within
FROM outcome GROUP BY ALL"""))
def q_latency_sketch_range(spark, sf):
    """A-10 / A-12: sketches stored per minute in two batches, merged per week without reading the events;
    the exact ranks and counts beside them tell whether the sketches kept their stated errors."""
    from orderflow.operators import sketches as sk
    from orderflow.session import scratch_path
    path = scratch_path(spark, "sketches")
    o = tb.read_table(spark, sf, "events").select((F.col("user_id") % N).cast("int").alias("shard"), "ts", "event_id", "user_id",
                                                  (F.col("value") / 100).alias("latency_s"))
    for batch_id in (0, 1, 1):  # minutes are cut in two by id; the second batch is replayed
        part = o.filter(F.pmod("event_id", F.lit(2)) == batch_id)
        sk.sink_sketches(sk.minute_sketches(part, "latency_s", "user_id", ["shard"]), path, batch_id)
    week = F.date_trunc("week", "minute").cast("timestamp_ntz").alias("week")
    merged = sk.merge_sketches(sk.read_sketches(spark, path).withColumn("week", week), ["shard", "week"], _QS)
    names = ["p50", "p90", "p99"]
    at = o.select("shard", F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week"), "latency_s", "user_id").join(
        merged.select("shard", "week", *names), ["shard", "week"])
    ranks = [a for p in names for a in (F.count_if(F.col("latency_s") < F.col(p)).alias(f"{p}_below"),
                                        F.count_if(F.col("latency_s") <= F.col(p)).alias(f"{p}_upto"))]
    exact = at.groupBy("shard", "week").agg(*ranks, F.count_distinct("user_id").alias("users"))
    slack, share = F.col("n_values") * sk.kll_rank_error(), sk.hll_relative_error()
    within = [((F.col(f"{p}_below") <= F.col("n_values") * q + slack) & (F.col(f"{p}_upto") >= F.col("n_values") * q - slack)).alias(f"{p}_within")
              for p, q in zip(names, _QS)]
    return merged.join(exact, ["shard", "week"]).select("shard", "week", "n", "n_values", *within,
                                                        (F.abs(F.col("keys") - F.col("users")) <= F.col("users") * share).alias("users_within"))


# ---------------------------------------------------------------- A-11 / A-12
@register("shard_balance", with_views(["ord"], """
SELECT shard, rows, total, round(rows / total, 6) AS share,
       rows >= total / 4.0 * 0.6 AND rows <= total / 4.0 * 1.4 AS within_tolerance,
       min(rows) OVER () > 0 AS all_shards_used
FROM (SELECT s.shard, coalesce(c.rows, 0) AS rows, CAST(sum(coalesce(c.rows, 0)) OVER () AS BIGINT) AS total
      FROM (SELECT CAST(range AS INTEGER) AS shard FROM range(4)) s
      LEFT JOIN (SELECT shard, count(*) AS rows FROM ord GROUP BY shard) c ON s.shard = c.shard)"""))
def q_shard_balance(spark, sf):
    return agg.shard_balance(tb.orders_view(spark, sf, with_items=False), N)


@register("shards_per_customer", with_views(["ord"], """
SELECT n_shards, count(*) AS customers FROM (
  SELECT customer_id, count(DISTINCT shard) AS n_shards FROM ord GROUP BY customer_id)
GROUP BY n_shards"""))
def q_shards_per_customer(spark, sf):
    s = agg.shards_per_key(tb.orders_view(spark, sf, with_items=False), "customer_id")
    return s.groupBy("n_shards").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- W-01 / A-14
@register("poll_batch_stats", with_views(["decoded"], """
SELECT shard, batch_no, count(*) AS received, count(*) FILTER (WHERE len(errors) = 0) AS inserted,
       count(*) FILTER (WHERE len(errors) > 0) AS skipped,
       arg_min(msg_id, poll_seq) AS first_msg_id, arg_max(msg_id, poll_seq) AS last_msg_id
FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY msg_ms, msg_seq) AS poll_seq,
             (row_number() OVER (PARTITION BY shard ORDER BY msg_ms, msg_seq) - 1) // 500 AS batch_no
      FROM decoded)
GROUP BY shard, batch_no"""))
def q_poll_batch_stats(spark, sf):
    m = tb.malformed_messages_view(spark, sf)
    # only what the batches need goes through the ordered scan
    b = windows.poll_batches(validate.validate_orders(m).select("shard", "msg_id", "msg_seq", "valid"), 500)
    return agg.batch_stats(b, F.col("valid"))


# ---------------------------------------------------------------- A-15
@register("ingest_report", with_views(["outcome"], """
SELECT sent, ok, errors, duration_s,
       round(CASE WHEN duration_s > 0 THEN sent / duration_s END, 6) AS rate_per_s,
       round(CASE WHEN duration_s > 0 THEN sent / duration_s * 60 END, 6) AS rate_per_min
FROM (SELECT count(*) AS sent, count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS errors,
             (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_s FROM outcome)"""))
def q_ingest_report(spark, sf):
    return agg.ingest_report(tb.outcomes_view(spark, sf))


# ---------------------------------------------------------------- A-16
@register("shard_lag", with_views(["ord", "ack"], """
SELECT s.shard, coalesce(c.lag, 0) AS lag, coalesce(c.lag, 0) > 1000 AS alert
FROM (SELECT CAST(range AS INTEGER) AS shard FROM range(4)) s
LEFT JOIN (SELECT shard, count(*) AS lag FROM ord o
           WHERE NOT EXISTS (SELECT 1 FROM ack a WHERE a.shard = o.shard AND a.order_id = o.order_id)
           GROUP BY shard) c ON s.shard = c.shard"""))
def q_shard_lag(spark, sf):
    p = joins.pending(tb.orders_view(spark, sf, with_items=False), tb.acks_view(spark, sf))
    return agg.lag_per_shard(p, N, threshold=1000)


# ---------------------------------------------------------------- A-17
@register("retry_rollup", with_views(["attempt"], """
SELECT op_id, CAST(coalesce(first_ok, last_attempt) AS INTEGER) AS attempts, first_ok IS NOT NULL AS recovered,
       first_ok IS NULL AND last_attempt >= 3 AS exhausted,
       round(1.0 * (pow(2.0, coalesce(first_ok, last_attempt) - 1) - 1) / (2.0 - 1), 6) AS waited_s
FROM (SELECT op_id, min(CASE WHEN ok THEN attempt END) AS first_ok, max(attempt) AS last_attempt
      FROM attempt GROUP BY op_id)"""))
def q_retry_rollup(spark, sf):
    return agg.retry_rollup(tb.attempts_view(spark, sf))


# ---------------------------------------------------------------- W-03 / S-09
@register("latest_ack", with_views(["ack_log"], """
SELECT order_id, arg_max(shard, (ack_ts, event_id)) AS shard, max(ack_ts) AS ack_ts,
       arg_max(event_id, (ack_ts, event_id)) AS event_id, count(*) AS n_writes
FROM ack_log GROUP BY order_id"""))
def q_latest_ack(spark, sf):
    return windows.latest_ack(tb.ack_log_view(spark, sf), tiebreak="event_id")


# ---------------------------------------------------------------- W-04
@register("ack_progress", with_views(["ord", "ack"], """
, firsts AS (SELECT a.order_id, min(a.ack_ts) AS first_ack FROM ack a
             WHERE a.order_id IN (SELECT order_id FROM ord) GROUP BY a.order_id),
rounds AS (SELECT (epoch_us(first_ack) - min(epoch_us(first_ack)) OVER ()) // 86400000000 AS round FROM firsts),
hits AS (SELECT round, count(*) AS new_acked FROM rounds GROUP BY round),
allr AS (SELECT unnest(range(0, (SELECT max(round) FROM hits) + 1)) AS round)
SELECT round, new_acked, acked_total, n_sub - acked_total AS pending,
       CASE WHEN n_sub = 0 THEN 0.0 ELSE round(acked_total * 100.0 / n_sub, 2) END AS pct_complete
FROM (SELECT r.round, coalesce(h.new_acked, 0) AS new_acked,
             CAST(sum(coalesce(h.new_acked, 0)) OVER (ORDER BY r.round) AS BIGINT) AS acked_total,
             (SELECT count(DISTINCT order_id) FROM ord) AS n_sub
      FROM allr r LEFT JOIN hits h ON r.round = h.round)""".replace("\n, firsts", ",\nfirsts")))
def q_ack_progress(spark, sf):
    return windows.ack_progress(tb.acks_view(spark, sf), tb.orders_view(spark, sf, with_items=False), 86400)


# ---------------------------------------------------------------- W-05
def _samples(spark, sf):
    e = tb.read_table(spark, sf, "events")
    return e.select(F.concat(F.lit("shard-"), (F.col("user_id") % 4).cast("string")).alias("series"),
                    "ts", "event_id",
                    F.get_json_object("props", "$.k").cast("double").alias("value"))


@register("counter_rate", """
WITH s AS (SELECT 'shard-' || (user_id % 4) AS series, ts, event_id,
                  CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events),
inc AS (SELECT *, CASE WHEN prev IS NULL THEN NULL WHEN value < prev THEN value ELSE value - prev END AS increase
        FROM (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY ts, event_id) AS prev FROM s)),
w AS (SELECT series, increase, ts,
             (epoch_us(ts) // 1800000000 - k) * 1800000000 AS ws
      FROM inc, (SELECT unnest([0, 1]) AS k) kk)
SELECT series, make_timestamp(ws) AS window_start, make_timestamp(ws + 3600000000) AS window_end,
       count(*) AS samples, round(sum(coalesce(increase, 0.0)), 6) AS increase,
       round(sum(coalesce(increase, 0.0)) / 3600, 6) AS rate_per_s
FROM w WHERE epoch_us(ts) >= ws AND epoch_us(ts) < ws + 3600000000
GROUP BY series, ws""")
def q_counter_rate(spark, sf):
    return windows.counter_rate(_samples(spark, sf), "series", "ts", "value", "event_id",
                                window="1 hour", slide="30 minutes", window_s=3600)


# ---------------------------------------------------------------- W-06
@register("failure_streaks", with_views(["outcome"], """
SELECT name, streak_id, count(*) AS failures, min(ts) AS started, max(ts) AS ended,
       count(*) >= 3 AS reaches_threshold
FROM (SELECT *, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY name ORDER BY ts, event_id) AS BIGINT) AS streak_id
      FROM outcome WHERE reason IS DISTINCT FROM 'circuit_open')
WHERE NOT ok GROUP BY name, streak_id"""))
def q_failure_streaks(spark, sf):
    return windows.failure_streaks(tb.outcomes_view(spark, sf))


# ---------------------------------------------------------------- W-07
@register("order_violations", with_views(["msg"], """
SELECT order_id, customer_id, shard, msg_id FROM (
  SELECT *, lag(msg_ms) OVER w AS prev_ms, lag(msg_seq) OVER w AS prev_seq FROM msg
  WINDOW w AS (PARTITION BY shard, customer_id ORDER BY o_orderkey))
WHERE prev_ms IS NOT NULL AND (msg_ms < prev_ms OR (msg_ms = prev_ms AND msg_seq <= prev_seq))"""))
def q_order_violations(spark, sf):
    m = tb.messages_view(spark, sf)
    m = m.withColumn("msg_ms", codec.msg_id_millis("msg_id"))
    v = windows.order_violations(m, ["shard", "customer_id"], ["o_orderkey"])
    return v.filter("violation").select("order_id", "customer_id", "shard", "msg_id")


# ---------------------------------------------------------------- W-08
@register("ack_latency", with_views(["ord", "ack"], """
SELECT shard, count(*) AS n,
       round(quantile_cont(latency_s, 0.5), 3) AS p50,
       round(quantile_cont(latency_s, 0.9), 3) AS p90,
       round(quantile_cont(latency_s, 0.99), 3) AS p99
FROM (SELECT o.shard, (epoch_us(a.ack_ts) - epoch_us(o.ts)) / 1e6 AS latency_s
      FROM ord o JOIN (SELECT shard, order_id, min(ack_ts) AS ack_ts FROM ack GROUP BY shard, order_id) a
      ON o.shard = a.shard AND o.order_id = a.order_id)
GROUP BY shard"""))
def q_ack_latency(spark, sf):
    q = joins.ack_latency_quantiles(tb.orders_view(spark, sf, with_items=False), tb.acks_view(spark, sf))
    return q.select("shard", "n", *[F.round(c, 3).alias(c) for c in ("p50", "p90", "p99")])


# ---------------------------------------------------------------- O-02 / O-03
@register("first_errors", with_views(["outcome"], """
SELECT name, ts, event_id, reason FROM outcome WHERE NOT ok ORDER BY ts, event_id LIMIT 10"""))
def q_first_errors(spark, sf):
    return ordering.first_errors(tb.outcomes_view(spark, sf), 10).select("name", "ts", "event_id", "reason")


@register("oldest_pending", with_views(["ord", "ack"], """
SELECT shard, rank, order_id, ts FROM (
  SELECT shard, order_id, ts, CAST(row_number() OVER (PARTITION BY shard ORDER BY ts, o_orderkey) AS INTEGER) AS rank
  FROM ord o WHERE NOT EXISTS (SELECT 1 FROM ack a WHERE a.shard = o.shard AND a.order_id = o.order_id))
WHERE rank <= 10"""))
def q_oldest_pending(spark, sf):
    p = joins.pending(tb.orders_view(spark, sf, with_items=False), tb.acks_view(spark, sf))
    return ordering.oldest_per_group(p, 10, ["shard"], ["ts", "o_orderkey"]).select("shard", "rank", "order_id", "ts")


# ---------------------------------------------------------------- F-04
@register("epoch_normalise", """
SELECT event_id, epoch_text,
       make_timestamp(CASE WHEN CAST(epoch_text AS DECIMAL(24,6)) >= 100000000000
                           THEN CAST(CAST(epoch_text AS DECIMAL(24,6)) * 1000 AS BIGINT)
                           ELSE CAST(CAST(epoch_text AS DECIMAL(24,6)) * 1000000 AS BIGINT) END) AS parsed_ts
FROM (SELECT event_id,
             CASE WHEN event_id % 2 = 0
                  THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.' || lpad(CAST((epoch_us(ts) % 1000000) // 1000 AS VARCHAR), 3, '0')
                  ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS epoch_text
      FROM events)""")
def q_epoch_normalise(spark, sf):
    e = tb.read_table(spark, sf, "events").select("event_id", "ts")
    us = tb.ntz_micros("ts")
    text = F.when(F.col("event_id") % 2 == 0,
                  F.concat(F.floor(us / 1000000).cast("string"), F.lit("."),
                           F.lpad(F.floor(F.pmod(us, F.lit(1000000)) / 1000).cast("string"), 3, "0"))
                  ).otherwise(tb.ntz_millis("ts").cast("string"))
    e = e.select("event_id", text.alias("epoch_text"))
    return e.select("event_id", "epoch_text", codec.epoch_to_ts_ntz("epoch_text").alias("parsed_ts"))


# ---------------------------------------------------------------- F-06
@register("money_cast", """
SELECT 'ORD-' || o_orderkey AS order_id, raw_amount, TRY_CAST(raw_amount AS DECIMAL(12,2)) AS amount,
       TRY_CAST(raw_amount AS DECIMAL(12,2)) IS NULL AS overflow
FROM (SELECT o_orderkey, round(o_totalprice * pow(10, o_orderkey % 8), 2) AS raw_amount FROM orders)""")
def q_money_cast(spark, sf):
    o = tb.read_table(spark, sf, "orders")
    raw = F.round(F.col("o_totalprice") * F.pow(F.lit(10.0), (F.col("o_orderkey") % 8).cast("double")), 2)
    m = codec.to_money(F.col("raw_amount"))
    return (o.select(F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("order_id"),
                     raw.alias("raw_amount"))
            .select("order_id", "raw_amount", m.alias("amount"), m.isNull().alias("overflow")))


# ---------------------------------------------------------------- S-10 / S-11 / F-09
@register("log_lines", with_views(["logrec"], """
SELECT event_id, strptime(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S') AS ts, level, logger, msg,
       CAST(regexp_extract(msg, 'shard=(\\S+)', 1) AS INTEGER) AS f_shard,
       CAST(coalesce(nullif(regexp_extract(msg, 'rows=(\\S+)', 1), ''), nullif(regexp_extract(msg, 'msgs=(\\S+)', 1), '')) AS BIGINT) AS f_rows,
       nullif(regexp_extract(msg, 'err=(\\S+)', 1), '') AS f_err
FROM logrec"""))
def q_log_lines(spark, sf):
    from orderflow.sources.logs import from_log_lines, to_log_lines
    recs = tb.log_records_view(spark, sf)
    lines = to_log_lines(recs, extra=["event_id"])
    back = from_log_lines(lines, extra={"event_id": "long"})
    f = codec.log_fields("msg")
    return back.select("event_id", "ts", "level", "logger", "msg",
                       f["shard"].cast("int").alias("f_shard"),
                       F.coalesce(f["rows"], f["msgs"]).cast("long").alias("f_rows"),
                       f["err"].alias("f_err"))


# ---------------------------------------------------------------- F-11
@register("items_exploded", with_views(["ord"], """
SELECT item, count(*) AS orders FROM (
  SELECT CASE WHEN len(items) = 0 THEN NULL ELSE unnest(CASE WHEN len(items) = 0 THEN [NULL] ELSE items END) END AS item
  FROM ord) GROUP BY item"""))
def q_items_exploded(spark, sf):
    from orderflow.sources.ledger import items_exploded
    e = items_exploded(tb.orders_view(spark, sf))
    return e.groupBy("item").agg(F.count(F.lit(1)).alias("orders"))


# ---------------------------------------------------------------- S-12
@register("retained_latest", with_views(["msg"], """
SELECT order_id, shard, msg_id FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY msg_ms DESC, msg_seq DESC) AS rn FROM msg)
WHERE rn <= 1000"""))
def q_retained_latest(spark, sf):
    from orderflow.sources.ledger import retain_latest
    m = tb.messages_view(spark, sf, with_items=False) \
        .select("order_id", "shard", "msg_id", codec.msg_id_millis("msg_id").alias("msg_ms"), "msg_seq")
    return retain_latest(m, 1000).select("order_id", "shard", "msg_id")


# ---------------------------------------------------------------- T-05
@register("throughput", with_views(["outcome"], """
SELECT shard, make_timestamp(ws) AS window_start, make_timestamp(ws + 3600000000) AS window_end,
       count(*) AS calls, count(*) FILTER (WHERE ok) AS ok_calls
FROM (SELECT shard, ok, ts, (epoch_us(ts) // 600000000 - k) * 600000000 AS ws
      FROM outcome, (SELECT unnest(range(0, 6)) AS k) kk)
WHERE epoch_us(ts) >= ws AND epoch_us(ts) < ws + 3600000000
GROUP BY shard, ws"""))
def q_throughput(spark, sf):
    from orderflow.streaming.stream_ops import throughput
    return throughput(tb.outcomes_view(spark, sf), "1 hour", "10 minutes")


# ---------------------------------------------------------------- T-08
@register("ack_ttl_sessions", with_views(["ack"], """
SELECT shard, session_no, min(ack_ts) AS started, max(ack_ts) AS last_write, count(*) AS acks,
       max(ack_ts) + INTERVAL 1800 SECOND AS expires_at,
       min(ack_ts) <= TIMESTAMP '2024-01-15 00:00:00' AND max(ack_ts) + INTERVAL 1800 SECOND > TIMESTAMP '2024-01-15 00:00:00' AS live
FROM (SELECT *, CAST(sum(fresh) OVER (PARTITION BY shard ORDER BY epoch_us(ack_ts), order_id) AS BIGINT) AS session_no
      FROM (SELECT *, CASE WHEN prev IS NULL OR epoch_us(ack_ts) - prev >= 1800000000 THEN 1 ELSE 0 END AS fresh
            FROM (SELECT *, lag(epoch_us(ack_ts)) OVER (PARTITION BY shard ORDER BY epoch_us(ack_ts), order_id) AS prev
                  FROM ack)))
GROUP BY shard, session_no"""))
def q_ack_ttl_sessions(spark, sf):
    s = windows.live_acks(tb.acks_view(spark, sf), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), 1800)
    return s.select("shard", "session_no", "started", "last_write", "acks", "expires_at", "live")


@register("ack_status_ttl", with_views(["ord", "ack"], """,
n AS (SELECT *, lag(ack_ts) OVER (PARTITION BY shard ORDER BY ack_ts, order_id) AS prev FROM ack WHERE ack_ts <= TIMESTAMP '2024-01-20 12:00:00'),
s AS (SELECT shard, max(ack_ts) FILTER (WHERE prev IS NULL OR epoch_us(ack_ts) - epoch_us(prev) >= 1200000000) AS began, max(ack_ts) AS last
      FROM n GROUP BY shard),
live AS (SELECT DISTINCT n.shard, n.order_id FROM n JOIN s ON n.shard = s.shard AND n.ack_ts >= s.began
         WHERE epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(s.last) < 1200000000)
SELECT o.shard, count(*) AS total, count(l.order_id) AS acked, count(*) - count(l.order_id) AS pending
FROM ord o LEFT JOIN live l ON o.shard = l.shard AND o.order_id = l.order_id GROUP BY o.shard"""))
def q_ack_status_ttl(spark, sf):
    """T-08 into J-01 / A-01: acks whose shard went without a flush for 20 minutes no longer count."""
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    live = windows.live_ack_rows(tb.acks_view(spark, sf), as_of, 1200)
    o = tb.orders_view(spark, sf, with_items=False).select(F.lit("all").alias("request_id"), "order_id")
    st = joins.ack_status(o, live, N)
    return st.groupBy("shard").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "acked").alias("acked"),
                                   F.count_if(F.col("status") == "pending").alias("pending"))


# ---------------------------------------------------------------- J-01 with a changed shard count, T-08 at many times
_RESHARD = "1995-06-17 00:00:00"


def _routed(shard4, shard8):
    return f"CASE WHEN ts < TIMESTAMP '{_RESHARD}' THEN {shard4} ELSE {shard8} END"


@register("ack_status_resharded", with_views(["ord", "requests"], f"""
, ids AS (SELECT DISTINCT order_id FROM req_ids),
s AS (SELECT order_id, {duck_sha1_shard('order_id', 4)} AS s4, {duck_sha1_shard('order_id', 8)} AS s8 FROM ids),
mark AS (SELECT DISTINCT o.order_id, {_routed(duck_sha1_shard('o.order_id', 4), duck_sha1_shard('o.order_id', 8))} AS shard
         FROM ord o JOIN ack USING (order_id))
SELECT r.request_id, r.order_id, coalesce(m.shard, s.s8) AS shard, CASE WHEN m.shard IS NULL THEN 'pending' ELSE 'acked' END AS status
FROM req_ids r JOIN s USING (order_id) LEFT JOIN mark m USING (order_id)"""))
def q_ack_status_resharded(spark, sf):
    """Four shards, then eight: requests don't know when their orders were written, marks lie where they were."""
    import datetime as dt
    history = [(None, 4), (dt.datetime.fromisoformat(_RESHARD), 8)]
    written = tb.orders_view(spark, sf, with_items=False).select("order_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    marks = tb.acks_view(spark, sf).select("order_id", "ack_ts").join(written, "order_id")
    marks = routing.add_shard_at(marks, "order_id", "ts", history).select("shard", "order_id", "ack_ts")
    return joins.ack_status_resharded(validate.requested_ids(_parsed_all(spark, sf)), marks, history)


@register("ack_status_as_of", with_views(["requests"], """,
seq AS (SELECT *, epoch_us(ack_ts) AS us, lag(epoch_us(ack_ts)) OVER (PARTITION BY shard ORDER BY ack_ts, order_id) AS prev FROM ack),
num AS (SELECT *, sum(CASE WHEN prev IS NULL OR us - prev >= 1200000000 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY shard ORDER BY ack_ts, order_id ROWS UNBOUNDED PRECEDING) AS life FROM seq),
lives AS (SELECT shard, life, min(us) AS began, max(us) + 1200000000 AS ends FROM num GROUP BY ALL),
firsts AS (SELECT shard, order_id, life, min(us) AS acked FROM num GROUP BY ALL),
asked AS (SELECT r.*, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(o.o_orderkey * 7 % 44640) AS as_of, s.shard
          FROM req_ids r JOIN ord o ON o.order_id = r.request_id JOIN status s ON s.request_id = r.request_id AND s.order_id = r.order_id)
SELECT a.request_id, a.order_id, a.as_of, a.shard,
       CASE WHEN f.acked <= epoch_us(a.as_of) THEN 'acked' ELSE 'pending' END AS status
FROM asked a LEFT JOIN lives l ON l.shard = a.shard AND l.began <= epoch_us(a.as_of) AND epoch_us(a.as_of) < l.ends
LEFT JOIN firsts f ON f.shard = a.shard AND f.order_id = a.order_id AND f.life = l.life"""))
def q_ack_status_as_of(spark, sf):
    """Every request asks at a time of its own; acks whose shard went without a flush for 20 minutes are gone by then."""
    minutes = F.make_dt_interval(mins=F.col("o_orderkey") * 7 % 44640)
    asked = tb.orders_view(spark, sf, with_items=False).select(
        F.col("order_id").alias("request_id"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes).alias("as_of"))
    req = validate.requested_ids(_parsed_all(spark, sf)).join(asked, "request_id")
    return joins.ack_status_as_of(req, tb.acks_view(spark, sf), N, 1200)


# ---------------------------------------------------------------- A-13 / F-10
@register("breaker_health", with_views(["outcome"], """
, reached AS (SELECT *, (epoch_us(ts), event_id) AS pos FROM outcome WHERE reason IS DISTINCT FROM 'circuit_open'),
good AS (SELECT name, max(pos) AS pos FROM reached WHERE ok GROUP BY name),
tail AS (SELECT r.name, count(*) FILTER (WHERE NOT r.ok AND (g.pos IS NULL OR r.pos > g.pos)) AS failures, max(r.ts) FILTER (WHERE NOT r.ok) AS failed_at
         FROM reached r LEFT JOIN good g ON r.name = g.name GROUP BY r.name),
eff AS (SELECT name, CASE WHEN failures < 3 THEN 'closed'
                          WHEN epoch_us(failed_at) + 30000000 <= (SELECT max(epoch_us(ts)) FROM outcome) THEN 'half_open'
                          ELSE 'open' END AS state FROM tail)
SELECT CASE WHEN bool_and(state <> 'open') THEN 'ok' ELSE 'degraded' END AS status,
       string_agg(name || '=' || state || ':' || CASE state WHEN 'closed' THEN 0 WHEN 'half_open' THEN 1 ELSE 2 END, ',' ORDER BY name) AS breakers,
       CAST(count(*) FILTER (WHERE state = 'open') AS INTEGER) AS n_open
FROM eff""").replace("\n, reached AS", ",\nreached AS"))
def q_breaker_health(spark, sf):
    o = tb.outcomes_view(spark, sf)
    states = windows.trailing_states(o, o.agg(F.max("ts").alias("as_of")), threshold=3, recovery_s=30)
    coded = states.withColumn("state", F.concat("state", F.lit(":"), codec.state_code("state").cast("string")))
    h = agg.health(states).select("status").crossJoin(agg.health(coded).select("circuit_breakers"))  # one row each
    pairs = F.array_sort(F.transform(F.map_entries("circuit_breakers"),
                                     lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return h.select("status", F.array_join(pairs, ",").alias("breakers"),
                    F.size(F.filter(F.map_values("circuit_breakers"), lambda v: v.startswith("open"))).alias("n_open"))


# ---------------------------------------------------------------- T-10 (batch twin)
@register("await_acks", with_views(["msg", "ack"], """,
nxt AS (
  SELECT m.msg_id, m.order_id, min(a.ack_ts) AS first_ts
  FROM msg m JOIN ack a ON a.shard = m.shard AND a.order_id = m.order_id AND a.ack_ts >= m.ts GROUP BY 1, 2)
SELECT m.msg_id, m.order_id, m.ts,
       CASE WHEN epoch_us(n.first_ts) - epoch_us(m.ts) <= 864000000000000 THEN n.first_ts END AS match_ts,
       CASE WHEN epoch_us(n.first_ts) - epoch_us(m.ts) <= 864000000000000
            THEN round((epoch_us(n.first_ts) - epoch_us(m.ts)) / 1e6, 6) END AS latency_s,
       coalesce(epoch_us(n.first_ts) - epoch_us(m.ts) <= 864000000000000, FALSE) AS matched
FROM msg m LEFT JOIN nxt n ON m.msg_id = n.msg_id AND m.order_id = n.order_id"""))
def q_await_acks(spark, sf):
    m = tb.messages_view(spark, sf, with_items=False).select("order_id", "msg_id", "ts")
    a = tb.acks_view(spark, sf).select(F.col("order_id"), "ack_ts", "shard")
    j = joins.next_match(m, a, "order_id", "ts", "ack_ts", "msg_id", "shard", within_s=864_000_000)
    return j.select("msg_id", "order_id", "ts", "match_ts", F.round("latency_s", 6).alias("latency_s"), "matched")


# ---------------------------------------------------------------- S-01 / S-03 / U-01
@register("union_shards", with_views(["msg"], """
SELECT shard, count(*) AS messages, min(msg_ms) AS first_ms, max(msg_ms) AS last_ms FROM msg GROUP BY shard"""))
def q_union_shards(spark, sf):
    from orderflow.session import scratch_path
    from orderflow.sources.messages import union_shard_logs, write_messages
    path = scratch_path(spark, "shard-logs")
    write_messages(tb.messages_view(spark, sf), path)
    u = union_shard_logs(spark, path, list(range(N)))
    ms = codec.msg_id_millis("msg_id")
    return u.groupBy("shard").agg(F.count(F.lit(1)).alias("messages"), F.min(ms).alias("first_ms"),
                                  F.max(ms).alias("last_ms"))


# ---------------------------------------------------------------- S-04 / S-07
@register("ledger_shard_slice", with_views(["decoded"], """
SELECT order_id, customer_id, TRY_CAST(amount AS DECIMAL(12,2)) AS amount, msg_id FROM good WHERE shard = 2"""))
def q_ledger_shard_slice(spark, sf):
    from orderflow.session import scratch_path
    from orderflow.sources.ledger import read_ledger, sink_ledger
    good, _ = validate.split_malformed(tb.malformed_messages_view(spark, sf))
    path = scratch_path(spark, "ledger")
    sink_ledger(validate.to_ledger(good), path)
    return read_ledger(spark, path).filter(F.col("shard") == 2).select("order_id", "customer_id", "amount", "msg_id")


# ---------------------------------------------------------------- T-01 / T-02 / T-03
@register("streaming_ingest", with_views(["decoded"], """
SELECT order_id, customer_id, TRY_CAST(amount AS DECIMAL(12,2)) AS amount,
       array_to_string(items, '|') AS items_text, msg_id, shard
FROM good"""))
def q_streaming_ingest(spark, sf):
    from orderflow.session import scratch_path
    from orderflow.sources.messages import write_messages
    from orderflow.streaming.ingest import IngestPaths, start_ingest
    root = scratch_path(spark, "ingest")
    write_messages(tb.malformed_messages_view(spark, sf), f"{root}/source")
    paths = IngestPaths(f"{root}/source", f"{root}/ledger", f"{root}/acks", f"{root}/quarantine",
                        f"{root}/checkpoint")
    start_ingest(spark, paths).awaitTermination()
    led = spark.read.parquet(paths.ledger)
    return led.select("order_id", "customer_id", "amount", _items_text().alias("items_text"), "msg_id", "shard")


def _ingest_paths(spark, name):
    from orderflow.session import scratch_path
    from orderflow.streaming.ingest import IngestPaths
    root = scratch_path(spark, name)
    return IngestPaths(f"{root}/source", f"{root}/ledger", f"{root}/acks", f"{root}/quarantine", f"{root}/checkpoint")


@register("ingest_overflow", with_views(["msg"], """
SELECT place, reason, count(*) AS rows FROM (
  SELECT CASE WHEN o_orderkey % 10 <= 4 THEN 'quarantine' ELSE 'ledger' END AS place,
         CASE o_orderkey % 10 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'missing:items' WHEN 2 THEN 'type:amount'
              WHEN 3 THEN 'missing:order_id' WHEN 4 THEN 'overflow:amount' ELSE '' END AS reason
  FROM msg) GROUP BY place, reason"""))
def q_ingest_overflow(spark, sf):
    """T-01 / F-06: amounts that money can't hold go to quarantine, not to the ledger as NULL."""
    from orderflow.sources.messages import write_messages
    from orderflow.streaming.ingest import start_ingest
    paths = _ingest_paths(spark, "overflow")
    huge = F.to_json(F.struct("order_id", "customer_id", F.lit(99999999999.0).alias("amount"), "items"))
    m = tb.messages_view(spark, sf).select("o_orderkey", huge.alias("huge"))
    m = tb.malformed_messages_view(spark, sf).join(m, "o_orderkey") \
        .withColumn("data", F.when(F.col("o_orderkey") % 10 == 4, F.col("huge")).otherwise(F.col("data"))).drop("huge")
    write_messages(m, paths.source)
    start_ingest(spark, paths).awaitTermination()
    led = spark.read.parquet(paths.ledger).filter("amount IS NOT NULL").select(F.lit("ledger").alias("place"), F.lit("").alias("reason"))
    out = led.unionByName(spark.read.parquet(paths.quarantine).select(F.lit("quarantine").alias("place"), "reason"))
    return out.groupBy("place", "reason").agg(F.count(F.lit(1)).alias("rows"))


@register("ingest_replay", with_views(["decoded"], """
SELECT 'received' AS what, 2 * (SELECT count(*) FROM msg) AS rows
UNION ALL SELECT 'ledger', count(*) FROM good
UNION ALL SELECT 'duplicates', count(*) FROM good
UNION ALL SELECT 'quarantine', 2 * ((SELECT count(*) FROM msg) - (SELECT count(*) FROM good))
UNION ALL SELECT 'distinct orders', count(DISTINCT order_id) FROM good"""))
def q_ingest_replay(spark, sf):
    """T-03 / T-04 / S-05: every message sent twice over twenty micro-batches or more, the re-sends of an
    early shard last; each order is stored once and nothing is lost."""
    from dataclasses import replace

    from orderflow.sources.messages import read_messages, write_messages
    from orderflow.streaming.ingest import start_ingest
    paths, counts = replace(_ingest_paths(spark, "replay"), key_buckets=4), []
    write_messages(tb.malformed_messages_view(spark, sf), paths.source, files=5)  # 5 files a shard
    sent = read_messages(spark, paths.source)  # the files of the first sending
    for part in (sent.filter(F.col("shard") != 0), sent.filter(F.col("shard") == 0)):
        write_messages(part, paths.source, files=5)
    start_ingest(spark, paths, max_files_per_trigger=2, first_wins=True, on_batch=counts.append).awaitTermination()
    if len(counts) < 20:
        raise RuntimeError("the stream should have run at least twenty micro-batches")
    total = {k: sum(c[k] for c in counts) for k in ("received", "duplicates")}  # one row per micro-batch
    led, bad = spark.read.parquet(paths.ledger), spark.read.parquet(paths.quarantine)

    def line(df, what, n=F.count(F.lit(1))):
        return df.agg(n.cast("long").alias("rows")).select(F.lit(what).alias("what"), "rows")

    out = spark.createDataFrame(list(total.items()), "what string, rows long")
    for part in (line(led, "ledger"), line(bad, "quarantine"), line(led, "distinct orders", F.count_distinct("order_id"))):
        out = out.unionByName(part)
    return out


@register("ledger_compacted", with_views(["decoded"], """
SELECT shard, count(*) AS rows, count(DISTINCT order_id) AS orders, true AS files_bounded FROM good GROUP BY shard"""))
def q_ledger_compacted(spark, sf):
    """S-04 / S-07: six micro-batches or more compacted in two runs, an old batch replayed afterwards."""
    from orderflow.sources import compaction
    from orderflow.sources.messages import read_messages, write_messages
    from orderflow.streaming.ingest import process_batch, start_ingest
    paths = _ingest_paths(spark, "compact")
    write_messages(tb.malformed_messages_view(spark, sf), paths.source, files=3)  # 3 files a shard
    start_ingest(spark, paths, max_files_per_trigger=2).awaitTermination()
    last, target = compaction.committed_upto(spark, paths.checkpoint), 4 << 20
    for upto in (last // 2, last):
        compaction.compact_ledger(spark, paths.ledger, {paths.writer_id(): upto}, target)
    process_batch(read_messages(spark, paths.source), 1, paths)
    led = compaction.read_compacted(spark, paths.ledger, files=True).withColumn("day", F.to_date("created_at"))
    files = led.groupBy("shard", "file_path").agg(F.max("file_size").alias("bytes"), F.max("day").alias("day")) \
        .groupBy("shard").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.count_distinct("day").alias("days"))
    got = led.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("orders"))
    return got.join(files, "shard").select("shard", "rows", "orders", (F.col("files") <= 2 * (F.col("days") + F.col("bytes") / target)).alias("files_bounded"))


@register("live_totals", with_views(["decoded"], """
SELECT (SELECT count(*) FROM msg) AS received, (SELECT count(*) FROM good) AS inserted, 0::BIGINT AS duplicates,
       (SELECT count(*) FROM msg) - (SELECT count(*) FROM good) AS skipped"""))
def q_live_totals(spark, sf):
    """T-11: counts stored beside the ledger; the stream fails once after a written micro-batch, which is then replayed."""
    from dataclasses import replace

    from orderflow.sources.messages import write_messages
    from orderflow.streaming.ingest import live_totals, run_with_restart, start_ingest
    paths, seen = _ingest_paths(spark, "totals"), []
    paths = replace(paths, counters=f"{paths.ledger}-counters")
    write_messages(tb.malformed_messages_view(spark, sf), paths.source)

    def fail_once(counts):
        seen.append(counts["batch_id"])
        if len(seen) == 2:
            raise RuntimeError("lost after the writes, before the commit")

    run_with_restart(lambda: start_ingest(spark, paths, max_files_per_trigger=1, on_batch=fail_once), pause_s=0.1)
    if len(set(seen)) == len(seen):
        raise RuntimeError("no micro-batch was replayed")
    return live_totals(spark, paths.counters).select("received", "inserted", "duplicates", "skipped")


@register("ingest_shard_groups", with_views(["decoded"], """
SELECT shard, count(*) AS ledger_rows, count(*) AS acks FROM good GROUP BY shard"""))
def q_ingest_shard_groups(spark, sf):
    """T-12: two shard groups with own checkpoints write one ledger and one ack table."""
    from dataclasses import replace

    from orderflow.sources.messages import write_messages
    from orderflow.streaming.ingest import start_ingest
    paths = _ingest_paths(spark, "groups")
    write_messages(tb.malformed_messages_view(spark, sf), paths.source)
    running = [start_ingest(spark, replace(paths, checkpoint=f"{paths.checkpoint}-{i}"), shards=group)
               for i, group in enumerate(([0, 1], [2, 3]))]
    for q in running:
        q.awaitTermination()
    led = spark.read.parquet(paths.ledger).groupBy("shard").agg(F.count(F.lit(1)).alias("ledger_rows"))
    acks = spark.read.parquet(paths.acks).groupBy("shard").agg(F.count(F.lit(1)).alias("acks"))
    return led.join(acks, "shard")


@register("ingest_resume", with_views(["decoded"], """
SELECT shard, count(*) AS ledger_rows, count(DISTINCT order_id) AS orders FROM good GROUP BY shard"""))
def q_ingest_resume(spark, sf):
    """T-06: the stream fails after its second micro-batch was written but not committed; the restart
    resumes at the committed offsets and replays that batch."""
    from orderflow.sources.messages import write_messages
    from orderflow.streaming.ingest import run_with_restart, start_ingest
    paths, failed = _ingest_paths(spark, "resume"), []
    write_messages(tb.malformed_messages_view(spark, sf), paths.source)

    def fail_once(counts):
        if counts["batch_id"] == 1 and not failed:
            failed.append(counts)
            raise RuntimeError("lost before the offsets were committed")

    run_with_restart(lambda: start_ingest(spark, paths, max_files_per_trigger=2, on_batch=fail_once), max_restarts=1, pause_s=0)
    led = spark.read.parquet(paths.ledger)
    return led.groupBy("shard").agg(F.count(F.lit(1)).alias("ledger_rows"), F.count_distinct("order_id").alias("orders"))


# ---------------------------------------------------------------- P-02
@register("encode_roundtrip", with_views(["ord"], """
SELECT order_id, customer_id, CAST(amount AS DECIMAL(12,2)) AS amount, array_to_string(items, '|') AS items_text,
       shard, 'order_created' AS type FROM ord"""))
def q_encode_roundtrip(spark, sf):
    sent = validate.encode_messages(tb.orders_view(spark, sf), N).select("shard", "type", "data")
    back = validate.decode_orders(sent)
    return back.select("order_id", "customer_id", codec.to_money("amount").alias("amount"),
                       _items_text().alias("items_text"), "shard", "type")


# ---------------------------------------------------------------- S-06 / S-08
@register("ledger_bulk", with_views(["decoded"], """
SELECT shard, count(*) AS rows, CAST(sum(CAST(amount AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS amount FROM good GROUP BY shard"""))
def q_ledger_bulk(spark, sf):
    """The table is created twice, loaded twice (a load replaces) and read through its name."""
    import uuid

    from orderflow.session import scratch_path
    from orderflow.sources.ledger import bulk_load, ensure_ledger
    path, name = scratch_path(spark, "bulk"), f"ledger_{uuid.uuid4().hex}"
    good, _ = validate.split_malformed(tb.malformed_messages_view(spark, sf))
    for _ in range(2):
        ensure_ledger(spark, name, path)
        bulk_load(validate.to_ledger(good), path)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))


# ---------------------------------------------------------------- S-09
@register("acks_written", with_views(["ack_log"], """
SELECT order_id, any_value(shard) AS shard, max(ack_ts) AS ack_ts FROM ack_log GROUP BY order_id"""))
def q_acks_written(spark, sf):
    """Two batches of acks, the second one replayed; read back, the last write of an order wins."""
    from orderflow.session import scratch_path
    from orderflow.sources.ledger import read_acks, sink_acks
    path, acks = scratch_path(spark, "acks"), tb.ack_log_view(spark, sf)
    odd = F.col("event_id") % 2 == 1
    for batch, part in ((0, acks.filter(odd)), (1, acks.filter(~odd)), (1, acks.filter(~odd))):
        sink_acks(part, path, batch)
    return read_acks(spark, path).select("order_id", "shard", "ack_ts")


# ---------------------------------------------------------------- S-12
@register("retention_loss", with_views(["msg", "ack"], """
SELECT shard, count(*) AS removed, count(*) FILTER (WHERE NOT acked) AS removed_unacked FROM (
  SELECT m.shard, row_number() OVER (PARTITION BY m.shard ORDER BY m.msg_ms DESC, m.msg_seq DESC) AS age,
         EXISTS (SELECT 1 FROM ack a WHERE a.shard = m.shard AND a.order_id = m.order_id) AS acked
  FROM (SELECT * FROM msg UNION ALL SELECT * FROM msg) m) WHERE age > 200 GROUP BY shard"""))
def q_retention_loss(spark, sf):
    """Every message is in the log twice, as after a re-send under the same id."""
    from orderflow.sources.ledger import retention_loss
    m = tb.messages_view(spark, sf, with_items=False).select("shard", "order_id", codec.msg_id_millis("msg_id").alias("msg_ms"), "msg_seq")
    return retention_loss(m.unionByName(m), tb.acks_view(spark, sf), 200)


# ---------------------------------------------------------------- T-04
@register("dedup_stream", with_views(["ord"], """
SELECT DISTINCT order_id, shard, customer_id FROM ord"""))
def q_dedup_stream(spark, sf):
    from orderflow.session import scratch_path
    from orderflow.sources.messages import read_messages, write_messages
    from orderflow.streaming.stream_ops import dedup_stream
    root = scratch_path(spark, "dedup")
    m = tb.messages_view(spark, sf)
    write_messages(m, f"{root}/source")
    resend = m.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    write_messages(resend, f"{root}/source")
    src = read_messages(spark, f"{root}/source", streaming=True).withColumn("ets", F.col("ts").cast("timestamp"))
    src = src.withColumn("oid", F.get_json_object("data", "$.order_id"))
    d = dedup_stream(src, ["shard", "oid"], "ets", "1 day")
    q = (d.select("shard", "data").writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    dec = validate.decode_orders(out)
    return dec.select("order_id", "shard", "customer_id")


# ---------------------------------------------------------------- P-11
@register("outcome_status_codes", with_views(["outcome"], """
SELECT shard, CASE WHEN ok THEN 200 WHEN reason = 'circuit_open' THEN 503 ELSE 502 END AS status_code,
       count(*) AS calls
FROM outcome GROUP BY ALL"""))
def q_outcome_status_codes(spark, sf):
    c = validate.classify_outcome(tb.outcomes_view(spark, sf))
    return c.groupBy("shard", "status_code").agg(F.count(F.lit(1)).alias("calls"))


@register("request_status_codes", with_views(["decoded", "requests"], """
SELECT 'order' AS kind, CASE WHEN errors = 0 THEN 200 ELSE 422 END AS status_code, count(*) AS requests
FROM (SELECT CASE WHEN o_orderkey % 10 <= 3 THEN 1 ELSE 0 END AS errors FROM msg) GROUP BY ALL
UNION ALL
SELECT 'acks', CASE WHEN error IS NULL THEN 200 ELSE 400 END, count(*) FROM parsed GROUP BY ALL"""))
def q_request_status_codes(spark, sf):
    text = F.lit(None).cast("string")
    bodies = tb.malformed_messages_view(spark, sf).select(F.lit("order").alias("kind"), "data", text.alias("ids"))
    lists = _requests(spark, sf).select(F.lit("acks").alias("kind"), text.alias("data"), "ids")
    c = validate.classify_requests(bodies.unionByName(lists), max_ids=5)
    return c.groupBy("kind", "status_code").agg(F.count(F.lit(1)).alias("requests"))


# ---------------------------------------------------------------- F-05
@register("items_json", with_views(["ord"], """
SELECT order_id, CAST(to_json(items) AS VARCHAR) AS encoded,
       CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, '|') AS items_text
FROM ord"""))
def q_items_json(spark, sf):
    o = tb.orders_view(spark, sf)
    j = o.select("order_id", codec.items_to_json("items").alias("items_json"))
    back = j.select("order_id", F.col("items_json").alias("encoded"),
                    codec.items_from_json("items_json").alias("items"))
    return back.select("order_id", "encoded", F.size("items").alias("n_items"), _items_text().alias("items_text"))
