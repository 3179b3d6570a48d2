"""Ordered scans that go on where the last batch stood (W-01, W-02 over a growing log).

A table that grows by batches is numbered batch by batch: what an ordered scan
needs of the rows before a batch is one row per group, the carry, kept as a
written table. No batch reads older rows. Everything is keyed by batch id, so a
replayed batch finds the carry it found the first time and writes the same
rows again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.scan import ordered_scan
from orderflow.session import path_exists, scratch_path

FULL_EVERY = 16  # every so many batches the carry is written for all groups, else for those that the batch has


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys])


class CarryTable:
    """Totals per group after each batch, under ``full=0|1/batch_id=`` folders.

    A batch writes the groups it has, every :data:`FULL_EVERY`-th one (and the
    first) all groups, so a read takes at most the last full state and the
    changes since. One writer appends to a log; its batch ids ascend, and a
    failed batch is replayed before the next one starts (as ``foreachBatch``
    does).
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path, keys

    def history(self) -> DataFrame | None:
        """All states written, with ``full`` and ``batch_id``."""
        return self.spark.read.parquet(self.path) if path_exists(self.spark, self.path) else None

    def before(self, batch_id: int) -> DataFrame | None:
        """One row per group: its totals after the last batch below ``batch_id``; None if there is none."""
        rows = self.history()
        rows = rows.filter(F.col("batch_id") < batch_id) if rows is not None else None
        start = rows.filter("full = 1").agg(F.max("batch_id")).first()[0] if rows is not None else None
        if start is None:
            return None
        values = [c for c in rows.columns if c not in (*self.keys, "full", "batch_id")]
        return rows.filter(F.col("batch_id") >= start).groupBy(*self.keys) \
            .agg(*[F.max_by(v, "batch_id").alias(v) for v in values])

    def replace(self, batch_id: int, touched: DataFrame, before: DataFrame | None) -> None:
        """Write the state of the groups that batch ``batch_id`` has (with the others' if a full one is due)."""
        full = before is None or batch_id % FULL_EVERY == 0
        if full and before is not None:
            mine = touched.select(*[F.col(k).alias(f"__c_{k}") for k in self.keys])
            touched = before.join(mine, _same(self.keys), "left_anti").unionByName(touched)
        touched.withColumn("full", F.lit(int(full))).withColumn("batch_id", F.lit(batch_id).cast("long")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("full", "batch_id").parquet(self.path)


def append_scan(batch: DataFrame, keys: list[str], order: list, carry: CarryTable, batch_id: int, *,
                sums: dict[str, Column] | None = None, maxes: dict[str, Column] | None = None,
                mins: dict[str, Column] | None = None) -> DataFrame:
    """:func:`ordered_scan` over one batch of a growing table, continued from the batches before it.

    The running values are those that a scan over all batches, one after the
    other, would give. Groups may have null keys. Writes the new carry before it
    returns; an empty batch leaves the carry as it is.
    """
    spark = batch.sparkSession
    ops = [(F.sum, dict(sums or {}), lambda a, b: F.coalesce(a + b, a, b)), (F.max, dict(maxes or {}), F.greatest),
           (F.min, dict(mins or {}), F.least)]
    path = scratch_path(spark, "append-scan")
    ordered_scan(batch, keys, order, sums=sums, maxes=maxes, mins=mins).write.parquet(path)
    rows, before = spark.read.parquet(path), carry.before(batch_id)
    names = [n for _, exprs, _ in ops for n in exprs]
    touched = batch.groupBy(*keys).agg(*[f(e).alias(n) for f, exprs, _ in ops for n, e in exprs.items()])
    if before is not None:
        def plus(df: DataFrame) -> DataFrame:
            old = before.select(*[F.col(k).alias(f"__c_{k}") for k in keys], *[F.col(n).alias(f"__b_{n}") for n in names])
            return df.join(old, _same(keys), "left").select(*[c for c in df.columns if c not in names], *[
                merge(F.col(n), F.col(f"__b_{n}")).cast(df.schema[n].dataType).alias(n) for _, exprs, merge in ops for n in exprs])
        rows, touched = plus(rows), plus(touched)
    carry.replace(batch_id, touched, before)
    return rows.select(*batch.columns, *names)
