"""Encoding / decoding expressions (F-03 .. F-07, F-09, F-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.schemas import STATE_CODES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_msg_id(col) -> tuple[Column, Column]:
    """``'<millis>-<seq>'`` -> (msg_ts timestamp, msg_seq long). Malformed -> NULLs.

    Message ids compare as the pair, never as text (``…-10`` < ``…-9`` as text).
    """
    c = _col(col)
    m = F.regexp_extract(c, r"^(\d+)-(\d+)$", 1)
    s = F.regexp_extract(c, r"^(\d+)-(\d+)$", 2)
    ok = m != ""
    ms = F.when(ok, m.cast("long"))
    return F.timestamp_millis(ms), F.when(ok, s.cast("long"))


def msg_id_millis(col) -> Column:
    m = F.regexp_extract(_col(col), r"^(\d+)-(\d+)$", 1)
    return F.when(m != "", m.cast("long"))


def msg_id_seq(col) -> Column:
    s = F.regexp_extract(_col(col), r"^(\d+)-(\d+)$", 2)
    return F.when(s != "", s.cast("long"))


def epoch_to_ts(col) -> Column:
    """Epoch text in seconds (Python services) or millis (JVM services) -> timestamp.

    Values >= 1e11 are millis (1e11 s is year 5138). Parsed as a decimal so
    the fraction is exact; NULL when the text is not a number.
    """
    d = _col(col).try_cast("decimal(24,6)")
    micros = F.when(d >= 100000000000, d * 1000).otherwise(d * 1000000)
    return F.timestamp_micros(micros.cast("long"))


def epoch_to_ts_ntz(col) -> Column:
    """As :func:`epoch_to_ts` but a zone-free ``timestamp_ntz`` (wall clock in UTC)."""
    d = _col(col).try_cast("decimal(24,6)")
    micros = F.when(d >= 100000000000, d * 1000).otherwise(d * 1000000).cast("long")
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def items_to_json(col) -> Column:
    return F.to_json(_col(col))


def items_from_json(col) -> Column:
    """JSON text -> array<string>; NULL when not an array of strings."""
    v = F.try_parse_json(_col(col))
    return F.when(F.schema_of_variant(v).isin("ARRAY<STRING>", "ARRAY<VOID>"),
                  F.try_variant_get(v, "$", "array<string>"))


def to_money(col) -> Column:
    """Amount at rest: decimal(12,2), half-up; NULL on overflow (quarantine)."""
    return _col(col).try_cast("decimal(12,2)")


def pct(part, total) -> Column:
    """``round(100 * part / total, 2)`` half-up, 0.0 when ``total`` is 0."""
    t = _col(total)
    return F.when(t == 0, F.lit(0.0)).otherwise(
        F.round(_col(part).cast("double") * 100.0 / t, 2))


def log_fields(msg) -> Column:
    """``'text k1=v1 k2=v2'`` -> map<string,string> of the ``k=v`` pairs; of a repeated key the last one."""
    pairs = F.regexp_extract_all(_col(msg), F.lit(r"([A-Za-z_]+)=(\S+)"), 0)

    def add(fields, p):
        key = F.substring_index(p, "=", 1)
        others = F.map_filter(fields, lambda k, _: k != key)
        return F.map_concat(others, F.create_map(key, F.regexp_extract(p, r"^[^=]+=(.*)$", 1)))

    empty = F.create_map().cast("map<string,string>")
    return F.when(_col(msg).isNotNull(), F.aggregate(pairs, empty, add))


def state_code(col) -> Column:
    """Breaker state -> gauge code; unknown states give 0."""
    c = _col(col)
    expr = F.lit(0)
    for name, code in STATE_CODES.items():
        expr = F.when(c == name, F.lit(code)).otherwise(expr)
    return expr


def encode_order_json(order_id, customer_id, amount, items) -> Column:
    """Order record -> JSON text of the envelope's ``data`` field."""
    return F.to_json(F.struct(
        _col(order_id).alias("order_id"),
        _col(customer_id).alias("customer_id"),
        _col(amount).cast("double").alias("amount"),
        _col(items).alias("items"),
    ))
