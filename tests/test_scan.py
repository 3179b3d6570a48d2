"""The ordered scan equals window functions for every type, also across partition borders."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators.scan import ordered_scan, window_scan


def _rows(seed, n):
    r = random.Random(seed)
    big = 2 ** 53
    out = []
    for i in range(n):
        out.append((r.choice([None, 0, 0, 0, 0, 1, 2]), r.randint(0, n // 4), i,
                    None if i < n // 3 or r.random() < 0.3 else big + r.randint(1, 999),
                    None if r.random() < 0.4 else Decimal(r.randint(-10 ** 9, 10 ** 9)).scaleb(-2),
                    None if r.random() < 0.3 else dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=r.randint(0, 10 ** 12)),
                    None if r.random() < 0.3 else f"s{r.randint(0, 99)}", [i] if i % 3 else None))
    return out


SCHEMA = "k int, v int, id long, big long, money decimal(12,2), ts timestamp, s string, arr array<int>"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scan_equals_plain_windows_for_all_types(spark, seed):
    df = spark.createDataFrame(_rows(seed, 600), SCHEMA)
    sums = {"rn": F.lit(1), "s_big": F.col("big"), "s_money": F.col("money")}
    lags = {"p_big": F.col("big"), "p_ts": F.col("ts"), "p_s": F.col("s"), "p_money": F.col("money"), "p_arr": F.col("arr")}
    maxes = {"m_big": F.col("big"), "m_ts": F.col("ts"), "m_s": F.col("s")}
    order = [F.col("v").desc(), "id"]
    got = ordered_scan(df, ["k"], order, sums=sums, lags=lags, maxes=maxes, num_partitions=7)
    want = window_scan(df, ["k"], order, sums, lags, maxes)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_leading_nulls_and_unscanned_columns_stay(spark):
    df = spark.createDataFrame([(0, 1, None, 2 ** 53 + 5), (0, 2, None, None), (0, 3, 4, 1), (0, 4, 5, 2)],
                               "k int, id int, x int, other long")
    got = ordered_scan(df, ["k"], ["id"], sums={"sx": F.col("x")}, num_partitions=4).orderBy("id").collect()
    assert [r.sx for r in got] == [None, None, 4, 9]
    assert [r.other for r in got] == [2 ** 53 + 5, None, 1, 2]


def test_many_small_groups_and_empty(spark):
    df = spark.createDataFrame([(i % 200, i) for i in range(1000)], "k int, id long")
    got = ordered_scan(df, ["k"], ["id"], sums={"rn": F.lit(1)}, lags={"p": F.col("id")}, num_partitions=9)
    want = window_scan(df, ["k"], ["id"], {"rn": F.lit(1)}, {"p": F.col("id")})
    assert sorted(got.collect()) == sorted(want.collect())
    assert ordered_scan(df.where("k < 0"), ["k"], ["id"], sums={"rn": F.lit(1)}).count() == 0


def test_scoped_tables_go_once_their_consumer_is_written(spark, tmp_path):
    import os

    from orderflow.session import checkpoint_dir, scoped, scratch_path, write_scratch
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))

    def left():
        return sorted(x.split("-")[0] for x in set(os.listdir(folder)) - before)

    def build():
        part = write_scratch(spark.range(50), scratch_path(spark, "part"))
        inner = scoped(spark, "inner", lambda: ordered_scan(part.withColumn("k", F.lit(1)), ["k"], ["id"], sums={"n": F.lit(1)}))
        assert [x for x in left() if x != "outer"] == ["inner", "part"]
        return inner.groupBy().agg(F.sum("n").alias("s"))

    got = scoped(spark, "outer", build)
    assert left() == ["outer"] and got.first().s == 1275

    def fails():
        build()
        raise ValueError("no")

    try:
        scoped(spark, "never", fails)
    except ValueError:
        pass
    assert left() == ["inner", "outer", "part"]
