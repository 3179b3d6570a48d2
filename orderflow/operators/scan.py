"""Ordered scans inside groups, exact at any group size, in native plans only.

A ``Window.partitionBy(shard)`` puts every row of a shard in one task; with
four shards that is a quarter of the data per task, and one hot key can hold
a third of everything. :func:`ordered_scan` gives the results of running
``sum`` / ``max`` / ``lag`` over such a window without that limit:

1. range-partition on ``(keys, order)``, so a hot group is split across
   partitions, sort, number the rows, and write them once to the shared
   folder: the place fixes partition and order for everything that follows;
2. plain windows over ``(keys, partition)`` give local results;
3. groups at the head of a partition, which alone can cross its border (one per
   partition, so a proven size bound for a broadcast), get one row per partition
   with the total, the maximum and the last values, and a window over these few
   rows carries them to the next partitions;
4. one join adds the carry to the rows of those groups.

Values keep their types: NULL sums stay NULL until the first value, BIGINT and
DECIMAL are never taken through a floating-point type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.session import scratch_path, write_scratch

_PLACE, _PID = "__scan_place", "__scan_pid"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def window_scan(df: DataFrame, keys: list[str], order: list, sums: dict, lags: dict,
                maxes: dict | None = None, mins: dict | None = None) -> DataFrame:
    """The same results with plain window functions: what :func:`ordered_scan` must equal."""
    w = Window.partitionBy(*keys).orderBy(*[_c(o) for o in order])
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("*", *[F.sum(_c(e)).over(run).alias(n) for n, e in sums.items()],
                     *[F.max(_c(e)).over(run).alias(n) for n, e in (maxes or {}).items()],
                     *[F.min(_c(e)).over(run).alias(n) for n, e in (mins or {}).items()],
                     *[F.lag(_c(e)).over(w).alias(n) for n, e in lags.items()])


def ordered_scan(df: DataFrame, keys: list[str], order: list, *,
                 sums: dict[str, Column] | None = None,
                 lags: dict[str, Column] | None = None,
                 maxes: dict[str, Column] | None = None,
                 mins: dict[str, Column] | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Add inclusive running sums, running maxima and previous-row values inside ``keys`` groups.

    ``order`` columns (sort orders allowed, e.g. ``F.col('ts').desc()``) must
    make the order total inside a group. ``sums`` maps an output name to a
    numeric expression (``F.lit(1)`` gives ``row_number``), ``maxes`` and ``mins`` to an
    orderable one (NULLs skipped), ``lags`` to one of any type whose
    previous row's value is returned (NULL on a group's first row). The only
    job before the caller's action is the write of step 1.
    """
    sums, lags, maxes, mins = dict(sums or {}), dict(lags or {}), dict(maxes or {}), dict(mins or {})
    spark = df.sparkSession
    types = {f.name: f.dataType for f in window_scan(df, keys, order, sums, lags, maxes, mins).schema.fields}
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = {n: f"__scan_src_{n}" for n in [*sums, *maxes, *mins, *lags]}
    sort_cols = [F.col(k) for k in keys] + [_c(o) for o in order]
    # the order columns may be derived: sort first, then number the rows and add the sources
    placed = df.repartitionByRange(parts, *sort_cols).sortWithinPartitions(*sort_cols).select(
        "*", *[_c(e).alias(src[n]) for n, e in {**sums, **maxes, **mins, **lags}.items()],
        F.monotonically_increasing_id().alias(_PLACE))
    staged = write_scratch(placed, scratch_path(spark, "scan"), "snappy") \
        .withColumn(_PID, F.shiftright(_PLACE, 33).cast("int"))  # the upper bits are the partition

    w = Window.partitionBy(*keys, _PID).orderBy(_PLACE)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = staged.select(
        "*", *[F.sum(src[n]).over(run).alias(n) for n in sums], *[F.max(src[n]).over(run).alias(n) for n in maxes],
        *[F.min(src[n]).over(run).alias(n) for n in mins],
        *[F.lag(src[n]).over(w).alias(n) for n in lags], F.row_number().over(w).alias("__scan_rn"))

    # A group that crosses a border is the first one of the next partition: totals are made for the groups at the
    # head of a partition only (one per partition, so a bounded broadcast), not for every group.
    heads = staged.where(F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) == 0) \
        .select(*[F.col(k).alias(f"__x_k{i}") for i, k in enumerate(keys)])
    crosses = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__x_k{i}")) for i, k in enumerate(keys)])
    totals = staged.join(F.broadcast(heads), crosses, "left_semi").groupBy(*keys, _PID).agg(
        *[F.sum(src[n]).alias(f"__t_{n}") for n in sums], *[F.max(src[n]).alias(f"__t_{n}") for n in maxes],
        *[F.min(src[n]).alias(f"__t_{n}") for n in mins],
        *[F.max_by(F.struct(src[n]), _PLACE).alias(f"__t_{n}") for n in lags], F.count(F.lit(1)).alias("__t_rows"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(_PID)
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        F.col(_PID).alias("__c_pid"), *[F.col(k).alias(f"__c_k{i}") for i, k in enumerate(keys)],
        *[F.sum(f"__t_{n}").over(before).alias(f"__c_{n}") for n in sums],
        *[F.max(f"__t_{n}").over(before).alias(f"__c_{n}") for n in maxes],
        *[F.min(f"__t_{n}").over(before).alias(f"__c_{n}") for n in mins],
        *[F.lag(f"__t_{n}").over(earlier)[src[n]].alias(f"__c_{n}") for n in lags])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__c_k{i}")) for i, k in enumerate(keys)],
                  F.col(_PID) == F.col("__c_pid"))
    joined = local.join(F.broadcast(carry), same, "left")
    outs = [F.coalesce(F.col(n) + F.col(f"__c_{n}"), F.col(n), F.col(f"__c_{n}")) for n in sums]
    outs += [F.greatest(F.col(n), F.col(f"__c_{n}")) for n in maxes]
    outs += [F.least(F.col(n), F.col(f"__c_{n}")) for n in mins]
    outs += [F.when(F.col("__scan_rn") == 1, F.col(f"__c_{n}")).otherwise(F.col(n)) for n in lags]
    names = [*sums, *maxes, *mins, *lags]
    return joined.select(*df.columns, *[o.cast(types[n]).alias(n) for o, n in zip(outs, names)])

