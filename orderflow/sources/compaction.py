"""Compaction of a ledger written batch by batch (S-04, S-07, T-01).

Batches that are closed (committed, never to be written again) are rewritten
from their ``shard=/writer=/batch_id=`` folders into files of a target size
under ``<path>-compact/data/gen=<n>/shard=/day=``. A generation counts once its
commit is written: ``<path>-compact/commits/gen=<n>`` holds the generations
then alive and the last closed batch of each writer. Readers take the newest
commit's generations and the open folders of later batches, so a job lost at
any point leaves no row out and none twice: before the commit the old folders
count, after it the new files do, and what is left over is removed by the next
run. A generation at most twice as large as the one being made is taken into
it, so their number, and how often a row is rewritten, grow with the logarithm
of the ledger. One compaction runs at a time;
readers that planned before it may miss removed files, as with any rewrite.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.schemas import LEDGER, LEDGER_COLUMNS
from orderflow.session import key_bloom, path_exists

TARGET_BYTES = 256 << 20
_STORED = T.StructType([*LEDGER.fields, T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())])
_COLUMNS = [*LEDGER_COLUMNS, "writer", "batch_id"]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def _bytes(spark: SparkSession, folders: list[str]) -> int:
    return sum(fs.getContentSummary(p).getLength() for fs, p in (_fs(spark, f) for f in folders))


def _number(folder: str, name: str) -> int:
    return int(re.search(rf"{name}=(\d+)", folder).group(1))


def _newest(spark: SparkSession, path: str) -> tuple[int, list[int], dict[str, int]]:
    """Number, living generations and closed batches of the newest commit; ``(-1, [], {})`` without any."""
    if not path_exists(spark, f"{path}-compact/commits"):
        return -1, [], {}
    done = [_number(f, "gen") for f in _glob(spark, f"{path}-compact/commits/gen=*/_SUCCESS")]
    if not done:
        return -1, [], {}
    row = spark.read.parquet(f"{path}-compact/commits/gen={max(done)}").first()
    return max(done), list(row["alive"]), dict(row["closed"])


def closed_upto(spark: SparkSession, path: str, writer: str) -> int:
    """The last batch of ``writer`` that compaction closed, or -1."""
    return _newest(spark, path)[2].get(writer, -1)


def committed_upto(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that a stream's checkpoint committed, or -1: later ones may be written again."""
    if not path_exists(spark, f"{checkpoint}/commits"):
        return -1
    return max((int(f.rsplit("/", 1)[1]) for f in _glob(spark, f"{checkpoint}/commits/*") if f.rsplit("/", 1)[1].isdigit()), default=-1)


def read_compacted(spark: SparkSession, path: str, files: bool = False) -> DataFrame:
    """All ledger rows with ``writer`` and ``batch_id``: the newest commit's generations and the batches after it.

    ``files`` adds each row's ``file_path`` and ``file_size``.
    """
    _, alive, closed = _newest(spark, path)
    columns = _COLUMNS + (["_metadata.file_path", "_metadata.file_size"] if files else [])
    rows = spark.read.schema(_STORED).parquet(path)
    for writer, upto in closed.items():
        rows = rows.filter((F.col("writer") != writer) | (F.col("batch_id") > upto))  # partition columns: pruned
    rows = rows.select(columns)
    for gen in alive:
        rows = rows.unionByName(spark.read.schema(_STORED).parquet(f"{path}-compact/data/gen={gen}").select(columns))
    return rows


def compact_ledger(spark: SparkSession, path: str, upto: dict[str, int], target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Rewrite each writer's batches up to ``upto[writer]`` into files of about ``target_bytes``.

    Rows are dealt by ``(shard, day, salt)`` with as many salts as the bytes of
    that shard and day ask for, so a hot shard is written by many tasks and
    each of its days ends in ``ceil(bytes / target_bytes)`` files or a few
    more. Inside a file rows are sorted by order id, with a Bloom filter on it.
    The driver handles one path per folder. Returns ``batches``, folders taken
    in, and ``generation`` (-1: nothing to do).
    """
    newest, alive, closed = _newest(spark, path)
    _drop_leftovers(spark, path, alive, closed)
    taken = [f for w, last in upto.items() for f in _glob(spark, f"{path}/shard=*/writer={w}/batch_id=*")
             if closed.get(w, -1) < _number(f, "batch_id") <= last]
    if not taken:
        return {"batches": 0, "generation": -1}
    size, rows = _bytes(spark, taken), spark.read.schema(_STORED).option("basePath", path).parquet(*taken).select(_COLUMNS)
    folded = []
    for gen in reversed(alive):
        folder = f"{path}-compact/data/gen={gen}"
        own = _bytes(spark, [folder])
        if own > 2 * size:
            break
        size += own
        folded.append(gen)
        rows = rows.unionByName(spark.read.schema(_STORED).parquet(folder).select(_COLUMNS))
    rows = rows.withColumn("day", F.to_date("created_at"))
    groups = rows.groupBy("shard", "day").agg(F.count(F.lit(1)).alias("__rows"))
    total = max(groups.agg(F.sum("__rows")).first()[0] or 0, 1)
    per_file = max(int(target_bytes * total / max(size, 1)), 1)
    # one row per shard and day: bounded by the configuration and the calendar
    salts = groups.select(F.col("shard").alias("__s"), F.col("day").alias("__d"), F.ceil(F.col("__rows") / per_file).cast("int").alias("__salts"))
    dealt = rows.join(F.broadcast(salts), F.col("shard").eqNullSafe(F.col("__s")) & F.col("day").eqNullSafe(F.col("__d"))) \
        .withColumn("__salt", F.pmod(F.xxhash64("msg_id", "order_id", "batch_id"), F.col("__salts")))
    new, parts = newest + 1, max(math.ceil(size / target_bytes), 1)
    key_bloom(dealt.repartition(parts, "shard", "day", "__salt").sortWithinPartitions("shard", "day", "order_id")
              .select(*_COLUMNS, "day").write).mode("overwrite").partitionBy("shard", "day").parquet(f"{path}-compact/data/gen={new}")
    alive = [g for g in alive if g not in folded] + [new]
    closed = {**closed, **{w: max(last, closed.get(w, -1)) for w, last in upto.items()}}
    spark.createDataFrame([(alive, closed)], "alive array<int>, closed map<string,bigint>").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}-compact/commits/gen={new}")
    _drop_leftovers(spark, path, alive, closed)
    return {"batches": len(taken), "generation": new}


def _drop_leftovers(spark: SparkSession, path: str, alive: list[int], closed: dict[str, int]) -> None:
    """Remove folders of closed batches and generations that the newest commit doesn't name."""
    gone = [f for w, last in closed.items() for f in _glob(spark, f"{path}/shard=*/writer={w}/batch_id=*") if _number(f, "batch_id") <= last]
    gone += [f for f in _glob(spark, f"{path}-compact/data/gen=*") if _number(f, "gen") not in alive]
    for fs, p in (_fs(spark, f) for f in gone):
        fs.delete(p, True)
