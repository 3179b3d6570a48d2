"""Numbering and totals over a table that grows by batches (W-01, W-02, S-02, S-12)."""

import random

import pytest
from pyspark.sql import functions as F

from orderflow.operators import appends
from orderflow.operators.appends import CarryTable, append_scan
from orderflow.operators.scan import ordered_scan
from orderflow.sources.message_log import append_messages, log_from, polls, read_log, trim_log

ROWS = "shard int, ts timestamp_ntz, o_orderkey long, body string"


def messages(spark, n, seed, first_ms=0, span=20, shards=(0, 0, 0, 1, 2)):
    r = random.Random(seed)
    rows = [(r.choice(shards), first_ms + r.randrange(span), k, f"m{k}") for k in range(n)]
    return spark.createDataFrame(rows, "shard int, ms long, o_orderkey long, body string") \
        .select("shard", F.timestamp_millis("ms").cast("timestamp_ntz").alias("ts"), "o_orderkey", "body").repartition(3)


def scan_rows(df):
    """Rows handed out by the Parquet scans of a plan."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        todo, found = [df._jdf.queryExecution().executedPlan()], 0
        df._jdf.collectToPython()
        while todo:
            node = todo.pop()
            if node.nodeName().startswith("Scan parquet"):
                found += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return found
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_append_scan_equals_one_scan_over_all(spark, tmp, monkeypatch):
    monkeypatch.setattr(appends, "FULL_EVERY", 3)
    r = random.Random(1)
    rows = [(r.choice(["a", "a", "b", None, f"g{k}"]), b, k, r.choice([None, r.randint(-9, 9)]))
            for k, b in enumerate(sorted(r.randrange(5) for _ in range(300)))]
    df = spark.createDataFrame(rows, "g string, batch long, k long, v long")
    ops = {"sums": {"n": F.lit(1), "total": F.col("v")}, "maxes": {"hi": F.col("v")}, "mins": {"lo": F.col("v")}}
    want = sorted(map(str, ordered_scan(df, ["g"], ["k"], **ops).collect()))
    carry, got = CarryTable(spark, f"{tmp}/carry", ["g"]), []
    for b in range(5):
        part = df.filter(F.col("batch") == b)
        once = append_scan(part, ["g"], ["k"], carry, b, **ops).collect()
        if b in (0, 3):  # a replay gives the same rows, and leaves the carry as it was
            assert sorted(map(str, append_scan(part, ["g"], ["k"], carry, b, **ops).collect())) == sorted(map(str, once))
        got += map(str, once)
    assert sorted(got) == want
    assert carry.before(0) is None
    states = carry.history()
    assert states.filter("full = 1").select("batch_id").distinct().count() == 2  # the first and the fourth


def test_ids_ascend_and_go_on_inside_a_millisecond(spark, tmp):
    parts = [messages(spark, 60, 1), messages(spark, 60, 2, first_ms=19), messages(spark, 60, 3, first_ms=5, span=3)]
    for b, part in enumerate(parts):
        append_messages(part, f"{tmp}/log", b)
    log = read_log(spark, f"{tmp}/log").orderBy("shard", "pos").collect()
    assert len(log) == 180 and len({(r.shard, r.msg_id) for r in log}) == 180
    for s in {r.shard for r in log}:
        mine = [r for r in log if r.shard == s]
        ids = [(r.msg_ms, r.msg_seq) for r in mine]
        assert ids == sorted(ids) and [r.pos for r in mine] == list(range(1, len(mine) + 1))
        assert all(r.msg_id == f"{r.msg_ms}-{r.msg_seq}" for r in mine)
        assert [r.batch_id for r in mine] == sorted(r.batch_id for r in mine)
        late = [r for r in mine if r.batch_id == 2]  # older than the log: they take its last millisecond
        assert {r.msg_ms for r in late} == {max(r.msg_ms for r in mine if r.batch_id < 2)}
        for ms in {r.msg_ms for r in mine}:
            seqs = [r.msg_seq for r in mine if r.msg_ms == ms]
            assert seqs == list(range(len(seqs)))


def test_replayed_and_empty_appends(spark, tmp):
    path, parts = f"{tmp}/log", [messages(spark, 40, 4), messages(spark, 40, 5, first_ms=19)]
    append_messages(parts[0].limit(0), path, 0)
    append_messages(parts[0], path, 1)
    append_messages(parts[1], path, 2)
    once = sorted(map(str, read_log(spark, path).collect()))
    append_messages(parts[0], path, 1)
    append_messages(parts[1], path, 2)
    append_messages(parts[1].limit(0), path, 3)
    assert sorted(map(str, read_log(spark, path).collect())) == once


def test_append_reads_no_older_messages(spark, tmp, monkeypatch):
    path = f"{tmp}/log"
    append_messages(messages(spark, 200, 6), path, 0)
    import pyspark.sql.readwriter as rw
    seen, real = [], rw.DataFrameReader.parquet
    monkeypatch.setattr(rw.DataFrameReader, "parquet", lambda self, *p, **k: seen.append(p) or real(self, *p, **k))
    append_messages(messages(spark, 50, 7, first_ms=19), path, 1)
    log_reads = [p for p in seen if p[0].endswith("/log")]
    assert len(log_reads) == 1  # its own batch, for the new carry
    q = spark.read.parquet(f"{path}/log").filter(F.col("batch_id") == 1)
    assert scan_rows(q) == 50


def test_position_is_pushed_down_and_skips(spark, tmp):
    path = f"{tmp}/log"
    for b in range(5):
        append_messages(messages(spark, 100, b, first_ms=1000 * b), path, b)
    q = log_from(spark, path, "3000-5")
    plan = q._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(msg_ms,3000)" in pushed
    rows = q.collect()
    assert {r.batch_id for r in rows} == {3, 4} and scan_rows(q) <= 200   # of 500
    everything = read_log(spark, path).collect()
    assert sorted(map(str, rows)) == sorted(str(r) for r in everything if (r.msg_ms, r.msg_seq) > (3000, 5))
    mixed = log_from(spark, path, {0: "4010-0", 1: "$", 2: "0-0"}).collect()
    assert sorted(map(str, mixed)) == sorted(str(r) for r in everything if r.shard == 2 or (r.shard == 0 and (r.msg_ms, r.msg_seq) > (4010, 0)))
    assert log_from(spark, path, "$").count() == 0 and log_from(spark, path, "0-0").count() == 500


def test_trim_leaves_n_and_reads_only_the_cut_folder(spark, tmp, monkeypatch):
    path = f"{tmp}/log"
    for b in range(4):
        append_messages(messages(spark, 100, 10 + b, first_ms=1000 * b, shards=(0, 1)), path, b)
    before = {r.shard: r["max(pos)"] for r in read_log(spark, path).groupBy("shard").agg(F.max("pos")).collect()}
    newest = sorted(str(r) for r in read_log(spark, path).collect() if r.pos > before[r.shard] - 30)
    import pyspark.sql.readwriter as rw
    seen, real = [], rw.DataFrameReader.parquet
    monkeypatch.setattr(rw.DataFrameReader, "parquet", lambda self, *p, **k: seen.append(p[0]) or real(self, *p, **k))
    assert trim_log(spark, path, 30) == {"dropped": 6, "cut": 2}
    assert {p.split("/log/log/")[-1] for p in seen if "/log/log/" in p} == {"shard=0/batch_id=3", "shard=1/batch_id=3"}
    monkeypatch.undo()
    assert sorted(map(str, read_log(spark, path).collect())) == newest
    trim_log(spark, path, 30)
    assert sorted(map(str, read_log(spark, path).collect())) == newest
    append_messages(messages(spark, 10, 99, first_ms=9000, shards=(0,)), path, 4)   # positions go on
    assert read_log(spark, path).filter("shard = 0").agg(F.max("pos")).first()[0] == before[0] + 10


def test_polls_by_position_need_no_shuffle(spark, tmp):
    append_messages(messages(spark, 50, 20), f"{tmp}/log", 0)
    q = polls(read_log(spark, f"{tmp}/log"), 10)
    assert "Exchange" not in q._jdf.queryExecution().executedPlan().toString()
    assert all(r.batch_no == (r.pos - 1) // 10 for r in q.collect())


@pytest.fixture(autouse=True)
def _fresh(spark):
    spark.catalog.clearCache()
