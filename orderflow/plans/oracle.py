"""DuckDB SQL twins of the registered queries (the correctness oracle).

The driver registers the raw tables as views; each oracle query rebuilds
the pipeline views it needs as CTEs. These strings are written by hand from
the operator semantics, not generated from the Spark plans.
"""

from __future__ import annotations


def duck_sha1_shard(expr: str, n: int) -> str:
    """SHA-1 as a 160-bit integer mod n (Horner over five 32-bit words)."""
    step = pow(2, 32, n)
    acc = "0"
    for i in range(5):
        word = f"('0x' || sha1({expr})[{1 + 8 * i}:{8 + 8 * i}])::BIGINT"
        acc = f"(({acc}) * {step} + {word}) % {n}"
    return f"CAST({acc} AS INTEGER)"


def duck_java_hash(expr: str) -> str:
    u = (f"list_reduce(list_transform(string_split({expr}, ''), lambda c: unicode(c)::BIGINT), "
         f"lambda a, c: (a * 31 + c) % 4294967296)")
    return f"(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 ELSE {u} END)"


def duck_java_shard(expr: str, n: int) -> str:
    h = duck_java_hash(expr)
    return (f"CAST(CASE WHEN {h} = -2147483648 THEN (({h} % {n}) + {n}) % {n} "
            f"ELSE abs({h}) % {n} END AS INTEGER)")


#: Unicode white space and U+001C to U+001F, as a character class of RE2.
BLANK = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

SHARD4 = duck_sha1_shard("'ORD-' || o.o_orderkey", 4)

VIEWS: dict[str, str] = {
    "ord": f"""ord AS (
  SELECT 'ORD-' || o.o_orderkey AS order_id,
         'CUST-' || o.o_custkey AS customer_id,
         CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount,
         COALESCE(li.items, []::VARCHAR[]) AS items,
         o.o_orderdate AS ts,
         o.o_orderkey,
         {SHARD4} AS shard
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, list_sort(list_distinct(list('PART-' || l_partkey))) AS items
             FROM lineitem GROUP BY l_orderkey) li
    ON o.o_orderkey = li.l_orderkey)""",
    "msg": """msg AS (
  SELECT *, 'order_created' AS type, (epoch_us(ts) // 1000) AS msg_ms,
         row_number() OVER (PARTITION BY shard, (epoch_us(ts) // 1000) ORDER BY o_orderkey) - 1 AS msg_seq,
         (epoch_us(ts) // 1000) || '-' || (row_number() OVER (PARTITION BY shard, (epoch_us(ts) // 1000) ORDER BY o_orderkey) - 1) AS msg_id,
         CAST(to_json({'order_id': order_id, 'customer_id': customer_id,
                  'amount': CAST(amount AS DOUBLE), 'items': items}) AS VARCHAR) AS data
  FROM ord)""",
    "bad_msg": """bad_msg AS (
  SELECT shard, msg_id, msg_seq, msg_ms, ts, o_orderkey,
         CASE o_orderkey % 10
           WHEN 0 THEN substr(data, 1, 20)
           WHEN 1 THEN CAST(to_json({'order_id': order_id, 'customer_id': customer_id,
                                'amount': CAST(amount AS DOUBLE)}) AS VARCHAR)
           WHEN 2 THEN CAST(to_json({'order_id': order_id, 'customer_id': customer_id,
                                'amount': CAST(amount AS VARCHAR), 'items': items}) AS VARCHAR)
           WHEN 3 THEN CAST(to_json({'customer_id': customer_id, 'amount': CAST(amount AS DOUBLE),
                                'items': items}) AS VARCHAR)
           ELSE data END AS data
  FROM msg)""",
    "decoded": """decoded AS (
  SELECT *,
         list_filter([
           CASE WHEN NOT json_valid(data) THEN 'invalid_json' END,
           CASE WHEN json_valid(data) AND json_type(data) <> 'OBJECT' THEN 'not_object' END,
           CASE WHEN obj AND coalesce(json_type(j, '$.order_id'), 'NULL') = 'NULL' THEN 'missing:order_id'
                WHEN obj AND json_type(j, '$.order_id') <> 'VARCHAR' THEN 'type:order_id' END,
           CASE WHEN obj AND coalesce(json_type(j, '$.customer_id'), 'NULL') = 'NULL' THEN 'missing:customer_id'
                WHEN obj AND json_type(j, '$.customer_id') <> 'VARCHAR' THEN 'type:customer_id' END,
           CASE WHEN obj AND coalesce(json_type(j, '$.amount'), 'NULL') = 'NULL' THEN 'missing:amount'
                WHEN obj AND json_type(j, '$.amount') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'type:amount' END,
           CASE WHEN obj AND coalesce(json_type(j, '$.items'), 'NULL') = 'NULL' THEN 'missing:items'
                WHEN obj AND json_type(j, '$.items') <> 'ARRAY' THEN 'type:items' END
         ], lambda x: x IS NOT NULL) AS errors
  FROM (SELECT *, CASE WHEN json_valid(data) THEN data ELSE 'null' END AS j,
               json_valid(data) AND json_type(CASE WHEN json_valid(data) THEN data ELSE 'null' END) = 'OBJECT' AS obj
        FROM bad_msg)),
good AS (
  SELECT shard, msg_id, msg_seq, msg_ms, ts, o_orderkey,
         json_extract_string(j, '$.order_id') AS order_id,
         json_extract_string(j, '$.customer_id') AS customer_id,
         CAST(json_extract(j, '$.amount') AS DOUBLE) AS amount,
         CAST(json_extract(j, '$.items') AS VARCHAR[]) AS items
  FROM decoded WHERE len(errors) = 0)""",
    "outcome": """outcome AS (
  SELECT 'shard-' || (user_id % 4) AS name, CAST(user_id % 4 AS INTEGER) AS shard, ts, event_id,
         event_type <> 'error' AS ok,
         CASE WHEN event_type <> 'error' THEN NULL
              WHEN event_id % 2 = 0 THEN 'circuit_open' ELSE 'retries_exhausted' END AS reason,
         value / 100 AS latency_s
  FROM events)""",
    "attempt": """attempt AS (
  SELECT event_id // 3 AS op_id, CAST(event_id % 3 + 1 AS INTEGER) AS attempt, ts,
         event_type <> 'error' AS ok
  FROM events)""",
    "ack": f"""ack AS (
  SELECT {duck_sha1_shard("'ORD-' || event_id", 4)} AS shard, 'ORD-' || event_id AS order_id, ts AS ack_ts
  FROM events WHERE event_type <> 'error')""",
    "ack_log": f"""ack_log AS (
  SELECT {duck_sha1_shard("'ORD-' || (user_id + 1)", 4)} AS shard, 'ORD-' || (user_id + 1) AS order_id,
         ts AS ack_ts, event_id
  FROM events WHERE event_type <> 'error')""",
    "requests": """requests AS (
  SELECT order_id AS request_id,
         array_to_string(list_transform(items, lambda i: replace(i, 'PART-', 'ORD-')), ' ,	') || chr(10) || chr(160) || ' , ' || chr(9) || chr(12288) || ',' || chr(28) || order_id || chr(8195) || ',' || chr(133) AS ids
  FROM ord),
parsed AS (
  SELECT request_id, id_list, CAST(len(id_list) AS INTEGER) AS n_ids,
         CASE WHEN len(id_list) = 0 THEN 'ids param required'
              WHEN len(id_list) > 5 THEN 'max 5 ids per request' END AS error
  FROM (SELECT request_id,
               list_filter(list_transform(string_split(ids, ','), lambda x: regexp_replace(x, '^[{blank}]+|[{blank}]+$', '', 'g')), lambda x: x <> '') AS id_list
        FROM requests)),
req_ids AS (
  SELECT DISTINCT request_id, unnest(id_list) AS order_id FROM parsed WHERE len(id_list) BETWEEN 1 AND 10000),
status AS (
  SELECT r.request_id, r.order_id, r.shard,
         CASE WHEN a.hit THEN 'acked' ELSE 'pending' END AS status
  FROM (SELECT *, {shard} AS shard FROM req_ids) r
  LEFT JOIN (SELECT DISTINCT shard, order_id, TRUE AS hit FROM ack) a
    ON r.shard = a.shard AND r.order_id = a.order_id)""".replace(
        "{shard}", duck_sha1_shard("order_id", 4)).replace("{blank}", BLANK),
    "logrec": """logrec AS (
  SELECT ts, event_id, CASE WHEN ok THEN 'INFO' ELSE 'ERROR' END AS level, 'consumer' AS logger,
         CASE WHEN ok THEN 'inserted shard=' || shard || ' rows=' || CAST(floor(latency_s * 100) AS BIGINT)
              ELSE 'db insert failed shard=' || shard || ' msgs=' || CAST(floor(latency_s * 100) AS BIGINT)
                   || ' err=' || reason END AS msg
  FROM outcome)""",
}

DEPS = {"msg": ["ord"], "bad_msg": ["msg"], "decoded": ["bad_msg"], "requests": ["ord", "ack"],
        "logrec": ["outcome"]}


def with_views(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(VIEWS[n] for n in order) + "\n" + body
