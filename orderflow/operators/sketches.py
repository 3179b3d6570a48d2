"""Mergeable sketches kept per minute (A-10, A-12): quantiles and distinct counts of any range without its events.

A written sketch table has one row per group and minute, in ``day=/writer=/batch_id=``
folders: the row count, a KLL sketch of a value and an HLL sketch of a key. A
replayed batch replaces its own folders; batches of one minute stand beside
each other and merge on read, so late events are simply another batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = 800  # items a KLL sketch keeps on its top level
LG = 12  # log2 of the HLL registers


def kll_rank_error(k: int = K) -> float:
    """The rank error of a merged KLL sketch that 99 of 100 single quantiles stay under, as a share of the rows."""
    return 2.296 / k ** 0.9021


def hll_relative_error(lg: int = LG, sigmas: float = 3.0) -> float:
    """``sigmas`` standard errors of a merged HLL count, as a share of the count."""
    return sigmas * 1.04 / 2 ** (lg / 2)


def minute_sketches(df: DataFrame, value: str, key: str, by: list[str], ts: str = "ts", k: int = K, lg: int = LG) -> DataFrame:
    """One row per group and minute: ``n`` events, ``value_sketch`` (KLL), ``key_sketch`` (HLL).

    Both aggregates combine map-side, so a hot group is sketched where its rows
    lie. Null values and keys are in ``n`` only; a minute without any value
    has an empty sketch. Rows without a time have the minute null.
    """
    return df.groupBy(*by, F.date_trunc("minute", ts).cast("timestamp_ntz").alias("minute")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("value_sketch"),
        F.hll_sketch_agg(F.col(key).cast("string"), lg).alias("key_sketch"))


def sink_sketches(sketches: DataFrame, path: str, batch_id: int, writer: str = "main") -> None:
    """Store the minute rows of one batch; a replay replaces that batch's folders and nothing else."""
    sketches.withColumn("day", F.to_date("minute")).withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(batch_id).cast("long")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "writer", "batch_id").parquet(path)


def read_sketches(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Minute rows with ``start <= minute < end`` (either may be left out); folders of other days are not listed."""
    df = spark.read.parquet(path)
    for bound, cmp in ((start, "__ge__"), (end, "__lt__")):
        if bound is not None:
            at = F.lit(bound).cast("timestamp_ntz")
            df = df.filter(getattr(F.col("minute"), cmp)(at))
            df = df.filter(F.col("day") >= F.to_date(at) if cmp == "__ge__" else F.col("day") <= F.to_date(at))
    return df


def merge_sketches(sketches: DataFrame, by: list[str], qs) -> DataFrame:
    """Quantiles ``p..`` of the value and ``keys``, the distinct keys, of all minutes of each group.

    ``n`` counts events, ``n_values`` those with a value; a group without values has null quantiles.
    """
    m = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("value_sketch").alias("__v"),
                                  F.hll_union_agg("key_sketch").alias("__k"))
    m = m.withColumn("n_values", F.kll_sketch_get_n_double("__v"))
    ps = [F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("__v", F.lit(float(q)))).alias("p" + format(q * 100, "g").replace(".", "_"))
          for q in qs]
    return m.select(*by, "n", "n_values", *ps, F.hll_sketch_estimate("__k").alias("keys"))
