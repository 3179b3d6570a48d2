"""Fixed schemas and configuration defaults of the order pipeline."""

from pyspark.sql import types as T

ORDER = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("items", T.ArrayType(T.StringType()), False),
])

MESSAGE = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("msg_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("amount", T.DecimalType(12, 2), False),
    T.StructField("items", T.ArrayType(T.StringType()), False),
    T.StructField("msg_id", T.StringType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("created_at", T.TimestampType(), False),
])

ACK = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("ack_ts", T.TimestampType()),
])

OUTCOME = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("reason", T.StringType()),
    T.StructField("latency_s", T.DoubleType()),
])

LOG = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("level", T.StringType()),
    T.StructField("logger", T.StringType()),
    T.StructField("msg", T.StringType()),
])

LEDGER_COLUMNS = ["order_id", "customer_id", "amount", "items", "msg_id", "shard", "created_at"]

# Configuration defaults of the order pipeline.
NUM_SHARDS = 4
POLL_BATCH = 500
ACK_BATCH = 500
ACK_FLUSH_INTERVAL_S = 5.0
ACK_TTL_S = 86400
ACK_MAX_IDS = 10000
RETENTION = 1_000_000
BREAKER_THRESHOLD = 3
BREAKER_RECOVERY_S = 30.0
RETRY_MAX = 3
RETRY_DELAY_S = 1.0
RETRY_BACKOFF = 2.0
LAG_ALERT = 50_000
STREAM_BASE = "orders:stream"
ACK_KEY_BASE = "orders:acks"
EVENT_TYPE = "order_created"

# Latency histogram bucket upper bounds (seconds).
PRODUCER_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
CONSUMER_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]

# Breaker state names and their gauge codes.
STATE_CODES = {"closed": 0, "half_open": 1, "open": 2}
