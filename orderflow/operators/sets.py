"""Set operators (U-01); U-02 is :func:`orderflow.operators.validate.requested_ids`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_shards(frames: list[DataFrame]) -> DataFrame:
    """U-01: N shard logs as one relation (by column name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)

