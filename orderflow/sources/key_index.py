"""Stored keys of a ledger, for first-wins inserts whose cost follows the batch (S-05, J-04, T-03).

A narrow table beside the ledger: one row per stored key, in folders
``bucket=/writer=/batch_id=`` by the key's hash, sorted by key inside a file;
merged files have a Parquet Bloom filter on the key. A batch reads the folders of the
buckets that its own keys fall into and no others, and nothing of the ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.joins import first_wins
from orderflow.session import key_bloom, path_exists, scratch_path

BUCKETS = 32


class KeyIndex:
    """The stored keys of one ledger. ``buckets`` is fixed when the index is made: about the number of
    keys expected over the keys that one task should read (thousands for a large ledger; a batch writes a
    file for each bucket it touches). :meth:`compact` keeps a bucket in few files."""

    def __init__(self, spark: SparkSession, path: str, key: str = "order_id", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def stored(self, buckets: list[int], writer: str, batch_id: int) -> DataFrame:
        """Keys in the given buckets, but for those that this very batch stored (a replay must not see itself)."""
        folders = [f for f in (f"{self.path}/bucket={b}" for b in buckets) if path_exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], f"{self.key} string, bucket int")
        schema = f"{self.key} string, bucket int, writer string, batch_id long"
        own = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
        # only the folders named are listed and read
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).filter(~own).select(self.key, "bucket")

    def unseen(self, batch: DataFrame, writer: str, batch_id: int, order: list[str] = ("msg_ms", "msg_seq")) -> DataFrame:
        """J-04: the earliest row of each key of the batch, without keys that other batches stored.

        The batch is reduced to one row per key map-side first. Which buckets
        it touches comes to the driver (``buckets`` numbers at most). A null key
        is a key like any other.
        """
        once = first_wins(batch, self.key, order).withColumn("__bucket", self.bucket())
        touched = sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().toLocalIterator())
        stored = self.stored(touched, writer, batch_id).select(F.col(self.key).alias("__stored"), F.col("bucket").alias("__in"))
        same = (F.col("__bucket") == F.col("__in")) & F.col(self.key).eqNullSafe(F.col("__stored"))
        # Sorted keys are small in their files and large in memory: they are never broadcast.
        return once.join(stored.hint("merge"), same, "left_anti").select(*batch.columns)

    def claim(self, rows: DataFrame, writer: str, batch_id: int) -> None:
        """Enter the keys of ``rows`` for this batch; a replay replaces its own.

        Call it before the ledger write: if that fails, the keys stay claimed
        for the replay of the same batch, which no longer sees them.
        """
        self._write(rows.select(F.col(self.key).cast("string").alias(self.key), self.bucket().alias("bucket"),
                                F.lit(writer).alias("writer"), F.lit(batch_id).cast("long").alias("batch_id")))

    def _write(self, rows: DataFrame, bloom: bool = False) -> None:
        w = rows.repartition("bucket").sortWithinPartitions("bucket", "writer", "batch_id", self.key).write
        (key_bloom(w, self.key) if bloom else w).mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("bucket", "writer", "batch_id").parquet(self.path)

    def rebuild(self, ledger: DataFrame) -> None:
        """Enter all keys of a ledger that has ``writer`` and ``batch_id``, as for one written without the index."""
        staged = scratch_path(self.spark, "keys")
        ledger.select(self.key, "writer", "batch_id").write.parquet(staged)
        self._write(self.spark.read.parquet(staged).withColumn("bucket", self.bucket()), bloom=True)

    def compact(self, writer: str, below: int) -> int:
        """Merge the keys of a writer's batches below ``below`` into one folder per bucket, ``batch_id=-1``.

        Only batches that can't be replayed any more (their offsets are
        committed) may be merged: under ``-1`` they count as another batch's.
        The merged folders are written before the old ones go, and a repeated
        call finds what a broken one left. Returns the folders removed.
        """
        schema = f"{self.key} string, bucket int, writer string, batch_id long"
        if not path_exists(self.spark, self.path):
            return 0
        old = self.spark.read.schema(schema).parquet(self.path).filter((F.col("writer") == writer) & (F.col("batch_id") < below))
        folders = [r for r in old.filter("batch_id >= 0").select("bucket", "batch_id").distinct().toLocalIterator()]
        if not folders:
            return 0
        staged = scratch_path(self.spark, "keys")
        touched = sorted({r["bucket"] for r in folders})
        old.filter(F.col("bucket").isin(touched)).select(self.key, "bucket").distinct().write.parquet(staged)
        self._write(self.spark.read.parquet(staged).withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(-1).cast("long")),
                    bloom=True)
        for r in folders:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/bucket={r['bucket']}/writer={writer}/batch_id={r['batch_id']}")
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        return len(folders)
