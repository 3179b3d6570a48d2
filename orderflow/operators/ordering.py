"""Sorts and top-k (O-01 .. O-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_errors(outcomes: DataFrame, n: int = 10, ts: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """O-02: the first ``n`` failed outcomes by time.

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n`` and only those are merged - no full sort.
    """
    return outcomes.filter(~F.col("ok")).orderBy(ts, tiebreak).limit(n)


def oldest_per_group(df: DataFrame, n: int, by: list[str], order: list[str]) -> DataFrame:
    """O-03: the ``n`` oldest rows per group.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before
    the shuffle, so every task forwards at most ``n`` rows per group and a
    hot group never reaches one task whole.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
