"""Decode, validate, project and filter order messages (P-01 .. P-11).

Decoding goes through ``try_parse_json`` (VARIANT) so the JSON *type* of
each field can be checked: ``from_json`` would silently turn a number id
into text and a text amount into NULL. All of it is native expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.codec import encode_order_json, to_money
from orderflow.functions.routing import sha1_shard
from orderflow.operators.util import keep_if
from orderflow.schemas import EVENT_TYPE, ACK_MAX_IDS

# Accepted JSON types per field (as reported by schema_of_variant).
STRING_TYPES = ["STRING"]
NUMBER_PREFIXES = ["BIGINT", "DOUBLE", "DECIMAL"]
ITEMS_TYPES = ["ARRAY<STRING>", "ARRAY<VOID>"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _field_type(v: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def _missing(t: Column) -> Column:
    return t.isNull() | (t == "VOID")


FIELDS = ("order_id", "customer_id", "amount", "items")


def _is_object(v: Column) -> Column:
    # A JSON object converts to an empty struct; anything else gives NULL.
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def _errors_from(v: Column, obj: Column, types: dict[str, Column]) -> Column:
    checks = [F.when(v.isNull(), F.lit("invalid_json")),
              F.when(v.isNotNull() & ~obj, F.lit("not_object"))]
    ok_obj = v.isNotNull() & obj
    for name in ("order_id", "customer_id"):
        t = types[name]
        checks.append(F.when(ok_obj & _missing(t), F.lit(f"missing:{name}"))
                      .when(ok_obj & ~t.isin(*STRING_TYPES), F.lit(f"type:{name}")))
    t = types["amount"]
    is_num = F.lit(False)
    for p in NUMBER_PREFIXES:
        is_num = is_num | t.startswith(p)
    # An amount that money at rest can't hold is an error of the message: stored, it would be NULL.
    money = to_money(F.try_variant_get(v, "$.amount", "double"))
    checks.append(F.when(ok_obj & _missing(t), F.lit("missing:amount"))
                  .when(ok_obj & ~is_num, F.lit("type:amount"))
                  .when(ok_obj & money.isNull(), F.lit("overflow:amount")))
    t = types["items"]
    checks.append(F.when(ok_obj & _missing(t), F.lit("missing:items"))
                  .when(ok_obj & ~t.isin(*ITEMS_TYPES), F.lit("type:items")))
    # Joined and split: unlike array_compact, a higher-order function, it is compiled with the checks.
    return F.array_remove(F.split(F.concat_ws(";", *checks), ";"), "")


def _parsed(df: DataFrame, data: str) -> DataFrame:
    # Parse once, type each field once, each in its own projection: the
    # optimizer keeps a costly expression that is read several times in its
    # own projection rather than inlining copies of it.
    v = F.col("__v")
    p = df.withColumn("__v", F.try_parse_json(F.col(data)))
    p = p.select("*", _is_object(v).alias("__obj"),
                 *[_field_type(v, f).alias(f"__t_{f}") for f in FIELDS])
    errs = _errors_from(v, F.col("__obj"), {f: F.col(f"__t_{f}") for f in FIELDS})
    return p.withColumn("errors", errs).drop("__obj", *[f"__t_{f}" for f in FIELDS])


def decode_orders(df: DataFrame, data: str = "data") -> DataFrame:
    """P-01: JSON ``data`` -> order columns plus ``errors`` (array<string>)."""
    p = _parsed(df, data)
    v = F.col("__v")
    valid = F.size("errors") == 0
    return p.select(
        *df.columns,
        F.when(valid, F.try_variant_get(v, "$.order_id", "string")).alias("order_id"),
        F.when(valid, F.try_variant_get(v, "$.customer_id", "string")).alias("customer_id"),
        F.when(valid, F.try_variant_get(v, "$.amount", "double")).alias("amount"),
        F.when(valid, F.try_variant_get(v, "$.items", "array<string>")).alias("items"),
        "errors")


def validate_orders(df: DataFrame, data: str = "data") -> DataFrame:
    """P-04: keep every row, add ``errors`` and ``valid``.

    Codes: ``invalid_json``, ``not_object``, ``missing:<field>``,
    ``type:<field>``, ``overflow:amount``. Empty ``items`` and a zero amount
    are valid.
    """
    return _parsed(df, data).drop("__v").withColumn("valid", F.size("errors") == 0)


def split_malformed(df: DataFrame, data: str = "data") -> tuple[DataFrame, DataFrame]:
    """P-03: (good decoded rows, bad rows with ``reason``). One decode, two filters;
    a bad row never fails the batch."""
    d = decode_orders(df, data)
    good = keep_if(d, F.size("errors") == 0).drop("errors")
    bad = (keep_if(d, F.size("errors") > 0)
           .select(*[c for c in df.columns], F.array_join("errors", ";").alias("reason")))
    return good, bad


def encode_messages(df: DataFrame, n_shards: int) -> DataFrame:
    """P-02: order rows -> envelope columns ``shard, type, data``."""
    out = df if "shard" in df.columns else df.withColumn("shard", sha1_shard("order_id", n_shards))
    return (out.withColumn("type", F.lit(EVENT_TYPE))
            .withColumn("data", encode_order_json("order_id", "customer_id", "amount", "items")))


def of_type(df: DataFrame, t: str = EVENT_TYPE, col: str = "type") -> DataFrame:
    """P-05."""
    return df.filter(F.col(col) == t)


def to_ledger(decoded: DataFrame, created_at: Column | None = None) -> DataFrame:
    """P-06: ledger projection in the fixed column order; amount as money."""
    ca = created_at if created_at is not None else F.current_timestamp()
    return decoded.select(
        F.col("order_id").cast("string"), F.col("customer_id").cast("string"),
        to_money(F.col("amount")).alias("amount"),
        F.col("items").cast("array<string>"), F.col("msg_id").cast("string"),
        F.col("shard").cast("int"), ca.alias("created_at"))


def find_order(df: DataFrame, order_id: str, n_shards: int | None = None) -> DataFrame:
    """P-07: point lookup. With ``n_shards`` the shard is derived too, so a
    ledger stored ``partitionBy('shard')`` is pruned to one folder."""
    cond = F.col("order_id") == order_id
    if n_shards is not None and "shard" in df.columns:
        cond = (F.col("shard") == sha1_shard(F.lit(order_id), n_shards)) & cond
    return df.filter(cond)


def count_prefix(df: DataFrame, prefix: str, col: str = "order_id") -> DataFrame:
    """P-08: ``count(*) where col LIKE 'prefix%'``."""
    return df.filter(F.col(col).startswith(prefix)).agg(F.count(F.lit(1)).alias("n"))


def contains_items(df: DataFrame, items: list[str], col: str = "items") -> DataFrame:
    """P-09: rows whose items contain every one of ``items`` (``@>``)."""
    want = F.array(*[F.lit(i) for i in items])
    return df.filter(F.forall(want, lambda x: F.array_contains(F.col(col), x)))


#: White space at either end of a text: Unicode's white space and the separators U+001C to U+001F.
BLANK_ENDS = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


def parse_ids(df: DataFrame, text: str = "ids", max_ids: int = ACK_MAX_IDS) -> DataFrame:
    """P-10: comma list -> trimmed non-empty ids, with the request verdict.

    White space of any kind around an id is dropped: Unicode's, and the four
    ASCII separators. Adds ``id_list`` (array), ``n_ids`` (counted before dedup, as the services
    do), ``status`` (200 / 400) and ``error``.
    """
    ids = F.filter(F.transform(F.split(F.col(text), ","), lambda x: F.regexp_replace(x, BLANK_ENDS, "")), lambda x: x != "")
    n = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(ids))
    # The two replies' texts.
    err = (F.when(n == 0, F.lit("ids param required"))
           .when(n > max_ids, F.lit(f"max {max_ids} ids per request")))
    return (df.withColumn("id_list", ids).withColumn("n_ids", n)
            .withColumn("error", err)
            .withColumn("status", F.when(err.isNull(), F.lit(200)).otherwise(F.lit(400))))


def requested_ids(parsed: DataFrame, request: str = "request_id") -> DataFrame:
    """Accepted requests exploded to distinct ``(request_id, order_id)`` (U-02)."""
    return (parsed.filter(F.col("status") == 200)
            .select(request, F.explode("id_list").alias("order_id"))
            .distinct())


def classify_outcome(df: DataFrame, ok: str = "ok", reason: str = "reason") -> DataFrame:
    """P-11: outcome of a publish call -> HTTP-style status code (200 stored, 503
    circuit open, 502 retries exhausted). Requests that never become a call are
    classified by :func:`classify_requests`."""
    code = (F.when(F.col(ok), F.lit(200))
            .when(F.col(reason) == "circuit_open", F.lit(503))
            .otherwise(F.lit(502)))
    return df.withColumn("status_code", code)


def classify_requests(df: DataFrame, data: str = "data", ids: str = "ids", max_ids: int = ACK_MAX_IDS) -> DataFrame:
    """P-11: status of a request before any call: an order body (``data``) that
    doesn't validate is 422, an id list (``ids``) that is empty or too long is
    400, the rest is 200. A request has one of the two; the other is NULL."""
    bodies = validate_orders(df, data).drop("valid")
    listed = parse_ids(bodies, ids, max_ids)
    code = (F.when(F.col(data).isNotNull(), F.when(F.size("errors") > 0, F.lit(422)).otherwise(F.lit(200)))
            .otherwise(F.coalesce("status", F.lit(400))))
    return listed.withColumn("status_code", code).drop("errors", "id_list", "n_ids", "error", "status")
