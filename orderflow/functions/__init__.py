"""Column-level functions: all native Spark expressions (codegen, no Python UDF)."""

from orderflow.functions.routing import sha1_shard, java_shard, java_string_hash, stream_key, shard_of_key
from orderflow.functions.codec import (
    parse_msg_id, msg_id_seq, epoch_to_ts, items_to_json, items_from_json, to_money,
    pct, log_fields, state_code, encode_order_json,
)

__all__ = [
    "sha1_shard", "java_shard", "java_string_hash", "stream_key", "shard_of_key",
    "parse_msg_id", "msg_id_seq", "epoch_to_ts", "items_to_json", "items_from_json",
    "to_money", "pct", "log_fields", "state_code", "encode_order_json",
]
