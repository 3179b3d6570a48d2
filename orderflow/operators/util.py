"""Small helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (e.g. a global total) to every row.

    ``one_row`` must be a global aggregate (exactly one row), so broadcasting
    it is bounded; the join is an equi-join on a constant key.
    """
    k = "__scalar_key"
    return (df.withColumn(k, F.lit(1))
            .join(F.broadcast(one_row.withColumn(k, F.lit(1))), k)
            .drop(k))


def ts_micros(df: DataFrame, col: str):
    """Epoch micros of a timestamp column of either flavour (zone independent for NTZ)."""
    from pyspark.sql import types as T
    from orderflow.sources.tables import ntz_micros
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return ntz_micros(col)
    return F.unix_micros(F.col(col))


def keep_if(df: DataFrame, cond) -> DataFrame:
    """``df.filter(cond)`` for a costly derived condition, evaluated where it stands.

    A plain filter is pushed below the projections that compute its inputs,
    and each reference is then recomputed (a JSON decode several times per
    row). An explode of a zero- or one-element array keeps rows the same way
    but is evaluated on the already projected columns.
    """
    keep = F.explode(F.when(cond, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    return df.withColumn("__keep", keep).drop("__keep")
