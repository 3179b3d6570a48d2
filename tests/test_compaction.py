"""Compacted ledgers (S-04, S-07) and mergeable sketches (A-10, A-12)."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from orderflow.operators import sketches as sk
from orderflow.schemas import LEDGER
from orderflow.sources import compaction
from orderflow.sources.ledger import read_ledger, sink_ledger_idempotent


def batch(spark, b, n=40):
    day = dt.datetime(2024, 1, 1 + b % 2)
    rows = [(f"O-{b}-{i}", "C", None, ["x"], f"{b}-{i}", 0 if i % 3 else 1, day) for i in range(n)]
    return spark.createDataFrame(rows, "order_id string, customer_id string, amount decimal(12,2), items array<string>, "
                                       "msg_id string, shard int, created_at timestamp").select([f.name for f in LEDGER.fields]).coalesce(1)


def ids(df):
    return sorted(r[0] for r in df.select("order_id").collect())


def part_files(root):
    return [f for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]


def test_compaction_keeps_rows_and_ignores_replays(spark, tmp):
    path = f"{tmp}/ledger"
    for b in range(8):
        sink_ledger_idempotent(batch(spark, b), b, path, writer="123")
    want = ids(spark.read.parquet(path))
    assert compaction.compact_ledger(spark, path, {"123": 5}) == {"batches": 12, "generation": 0}
    assert len(part_files(f"{path}-compact/data")) == 4  # two shards, two days
    assert len(part_files(path)) == 4  # batches 6 and 7
    assert ids(read_ledger(spark, path)) == want
    sink_ledger_idempotent(batch(spark, 3, n=50), 3, path, writer="123")  # closed
    assert ids(read_ledger(spark, path)) == want
    sink_ledger_idempotent(batch(spark, 7), 7, path, writer="123")  # open: replaced
    sink_ledger_idempotent(batch(spark, 3, n=2).withColumn("order_id", F.concat(F.lit("other-"), "order_id")), 3, path, writer="w")
    want = sorted(want + ["other-O-3-0", "other-O-3-1"])
    assert ids(read_ledger(spark, path)) == want
    compaction.compact_ledger(spark, path, {"123": 7, "w": 3})
    assert ids(read_ledger(spark, path)) == want and not part_files(path)
    assert compaction.compact_ledger(spark, path, {"123": 7, "w": 3}) == {"batches": 0, "generation": -1}
    assert {r["shard"] for r in read_ledger(spark, path).filter("shard = 1").select("shard").distinct().collect()} == {1}


def test_small_generations_are_taken_in(spark, tmp):
    path = f"{tmp}/ledger"
    for b in range(6):
        sink_ledger_idempotent(batch(spark, 0, n=20 * (b + 1)), b, path)
        compaction.compact_ledger(spark, path, {"main": b})
    assert len(compaction._newest(spark, path)[1]) <= 3
    assert read_ledger(spark, path).count() == 20 * (1 + 2 + 3 + 4 + 5 + 6)


def test_target_size_splits_a_hot_shard(spark, tmp):
    path = f"{tmp}/ledger"
    sink_ledger_idempotent(batch(spark, 0, n=3000), 0, path)
    size = sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    compaction.compact_ledger(spark, path, {"main": 0}, target_bytes=size // 6)
    assert len(part_files(f"{path}-compact/data")) >= 4
    assert read_ledger(spark, path).count() == 3000


@pytest.mark.parametrize("where", ["data", "commit"])
def test_compaction_lost_on_its_way(spark, tmp, where, monkeypatch):
    path = f"{tmp}/ledger"
    for b in range(3):
        sink_ledger_idempotent(batch(spark, b), b, path)
    want = ids(spark.read.parquet(path))
    calls = []

    def lost(*a, **k):  # at the commit (a frame of one row), or at the removal after it
        calls.append(1)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if where == "data":
            m.setattr(type(spark), "createDataFrame", lost)
        else:
            drop = compaction._drop_leftovers
            m.setattr(compaction, "_drop_leftovers", lambda s, p, alive, closed: lost() if closed else drop(s, p, alive, closed))
        with pytest.raises(RuntimeError):
            compaction.compact_ledger(spark, path, {"main": 2})
    assert calls and ids(read_ledger(spark, path)) == want
    compaction.compact_ledger(spark, path, {"main": 2})
    assert ids(read_ledger(spark, path)) == want and not part_files(path)


def test_committed_upto(spark, tmp):
    assert compaction.committed_upto(spark, f"{tmp}/none") == -1
    os.makedirs(f"{tmp}/c/commits")
    for name in ("0", "9", "10", ".11.crc"):
        open(f"{tmp}/c/commits/{name}", "w").close()
    assert compaction.committed_upto(spark, f"{tmp}/c") == 10


def test_sketches_merge_over_batches_and_ranges(spark, tmp):
    rng, rows = random.Random(5), []
    for i in range(20000):
        rows.append((0 if i % 3 else 1, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=17 * i),
                     None if i % 50 == 0 else rng.lognormvariate(0, 1), None if i % 70 == 0 else rng.randrange(3000)))
    df = spark.createDataFrame(rows, "shard int, ts timestamp_ntz, v double, k long")
    for b in (0, 1, 1, 0):
        part = df.filter(F.pmod(F.xxhash64("ts"), F.lit(2)) == b)
        sk.sink_sketches(sk.minute_sketches(part, "v", "k", ["shard"]), f"{tmp}/s", b)
    start, end = dt.datetime(2024, 1, 1, 5, 30), dt.datetime(2024, 1, 3, 7, 0)
    got = sk.merge_sketches(sk.read_sketches(spark, f"{tmp}/s", start, end), ["shard"], [0.5, 0.99]).collect()
    assert len(got) == 2
    for r in got:
        mine = [x for x in rows if x[0] == r["shard"] and start <= x[1] < end]
        values, keys = [x[2] for x in mine if x[2] is not None], {x[3] for x in mine if x[3] is not None}
        assert (r["n"], r["n_values"]) == (len(mine), len(values))
        for name, q in (("p50", 0.5), ("p99", 0.99)):
            rank = sum(v <= r[name] for v in values) / len(values)
            assert abs(rank - q) <= 2 * sk.kll_rank_error()
        assert abs(r["keys"] - len(keys)) <= sk.hll_relative_error() * len(keys)


def test_sketches_of_groups_without_values(spark, tmp):
    df = spark.createDataFrame([(0, dt.datetime(2024, 1, 1), None, None)], "shard int, ts timestamp_ntz, v double, k long")
    sk.sink_sketches(sk.minute_sketches(df, "v", "k", ["shard"]), f"{tmp}/s", 0)
    rows = sk.merge_sketches(sk.read_sketches(spark, f"{tmp}/s"), ["shard"], [0.5]).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 0, None, 0)]
    empty = sk.merge_sketches(sk.minute_sketches(df.limit(0), "v", "k", ["shard"]), ["shard"], [0.5])
    assert empty.collect() == []
