"""Shard routing expressions (F-01, F-02, F-08).

Routing is a projection: it never shuffles, keeps whole-stage codegen, and
lets a filter on ``shard`` prune a ledger stored ``partitionBy('shard')``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.schemas import STREAM_BASE, ACK_KEY_BASE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha1_shard(col, n: int) -> Column:
    """SHA-1 of the UTF-8 id read as a 160-bit integer, modulo ``n``.

    ``conv`` only reaches 64 bits, so the 40 hex digits are taken as five
    32-bit words and reduced with Horner's rule, every step already modulo
    ``n``: ``acc = (acc * 2^32 + word) mod n``. With ``n < 2^31`` all products
    stay below 2^63.
    """
    if not 1 <= n < 2 ** 31:
        raise ValueError("n must be in [1, 2^31)")
    return shard_of_sha1_hex(F.sha1(_col(col).cast("binary")), n)


def shard_of_sha1_hex(h, n: int) -> Column:
    """The 40-hex-digit SHA-1 text read as an integer, modulo ``n``.

    For a power of two only the last 8 digits matter. Otherwise the digits
    are taken as 15 + 15 + 10 (60, 60, 40 bits) and reduced with Horner's
    rule modulo ``n``; with ``n < 2^31`` every step stays below 2^63.
    """
    h = _col(h)
    nl = F.lit(n).cast("long")
    if n & (n - 1) == 0:
        return F.pmod(F.conv(F.substring(h, 33, 8), 16, 10).cast("long"), nl).cast("int")
    acc = F.lit(0).cast("long")
    start = 1
    for width in (15, 15, 10):
        word = F.conv(F.substring(h, start, width), 16, 10).cast("long")
        acc = F.pmod(acc * F.lit(pow(2, 4 * width, n)) + word, nl)
        start += width
    return acc.cast("int")


def add_sha1_shard(df, id_col: str, n: int, out: str = "shard"):
    """``df`` plus ``out = sha1_shard(id_col, n)``, hashing each id once."""
    return (df.withColumn("__sha1", F.sha1(F.col(id_col).cast("binary")))
            .withColumn(out, shard_of_sha1_hex("__sha1", n)).drop("__sha1"))


def check_history(history: list[tuple]) -> list[tuple]:
    """A routing history: ``(valid_from, shards)`` in ascending time, the first one valid from the beginning (None)."""
    history = list(history)
    starts = [h[0] for h in history[1:]]
    if not history or history[0][0] is not None or None in starts or starts != sorted(set(starts)):
        raise ValueError("a routing history starts with (None, shards); later entries ascend in time")
    return history


def add_shard_at(df, id_col: str, at: str, history: list[tuple], out: str = "shard"):
    """``df`` plus the shard that ``id_col`` was routed to at time ``at``, under a shard count that changed.

    ``history`` (see :func:`check_history`) is configuration, so routing stays a
    projection. A null time goes by the newest entry.
    """
    hexed, expr = F.col("__sha1"), None
    for start, n in check_history(history):
        here = shard_of_sha1_hex(hexed, n)
        expr = here if start is None else F.when(F.coalesce(F.col(at) >= F.lit(start), F.lit(True)), here).otherwise(expr)
    return df.withColumn("__sha1", F.sha1(F.col(id_col).cast("binary"))).withColumn(out, expr).drop("__sha1")


def add_all_shards(df, id_col: str, history: list[tuple], out: str = "shards"):
    """``df`` plus the distinct shards that ``id_col`` was ever routed to, the newest first."""
    every = [shard_of_sha1_hex(F.col("__sha1"), n) for _, n in reversed(check_history(history))]
    return df.withColumn("__sha1", F.sha1(F.col(id_col).cast("binary"))) \
        .withColumn(out, F.array_distinct(F.array(*every))).drop("__sha1")


def java_string_hash(col) -> Column:
    """JVM ``String.hashCode`` (signed 32-bit) over UTF-16 code units."""
    units = F.regexp_extract_all(F.hex(F.encode(_col(col), "UTF-16BE")), F.lit("(.{4})"), 1)
    codes = F.transform(units, lambda u: F.conv(u, 16, 10).cast("long"))
    unsigned = F.aggregate(codes, F.lit(0).cast("long"),
                           lambda a, x: (a * 31 + x).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.when(unsigned >= 2 ** 31, unsigned - 2 ** 32).otherwise(unsigned)


def java_shard(col, n: int) -> Column:
    """``abs(hashCode) % n`` as the JVM services route, but always in ``[0, n)``.

    ``Math.abs(Integer.MIN_VALUE)`` stays negative on the JVM; ``pmod`` maps
    that one value into range instead of producing a bad index.
    """
    h = java_string_hash(col)
    jabs = F.when(h == -(2 ** 31), h).otherwise(F.abs(h))
    return F.pmod(jabs, F.lit(n).cast("long")).cast("int")


def stream_key(shard, base: str = STREAM_BASE) -> Column:
    """``base:shard`` key of a shard log (or ack hash with ``ACK_KEY_BASE``)."""
    return F.concat_ws(":", F.lit(base), _col(shard).cast("string"))


def shard_of_key(key) -> Column:
    """Shard number parsed back from ``base:shard``; NULL when malformed."""
    digits = F.regexp_extract(_col(key), r":(\d+)$", 1)
    return F.when(digits != "", digits.cast("int"))


ACK_BASE = ACK_KEY_BASE
