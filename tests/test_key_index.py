"""First-wins inserts through the key index (S-05, J-04, T-03)."""

import random

from pyspark.sql import functions as F

from orderflow.operators.joins import insert_new
from orderflow.sources.key_index import KeyIndex
from tests.test_appends import scan_rows

SCHEMA = "order_id string, shard int, msg_ms long, msg_seq long, body string"


def batch(spark, ids, seed=1):
    r = random.Random(seed)
    return spark.createDataFrame([(i, 0, r.randrange(3), k, f"{i}:{k}") for k, i in enumerate(ids)], SCHEMA).repartition(3)


def run(index, rows, b):
    got = index.unseen(rows, "w", b).collect()
    index.claim(rows.sparkSession.createDataFrame(got, SCHEMA), "w", b)
    return sorted(r.body for r in got)


def test_equals_insert_new_over_the_whole_ledger(spark, tmp):
    index, r = KeyIndex(spark, f"{tmp}/keys", buckets=8), random.Random(3)
    ledger = spark.createDataFrame([], SCHEMA)
    for b in range(4):
        rows = batch(spark, [r.choice([f"o{r.randrange(60)}", None]) if r.random() < 0.9 else "hot" for _ in range(80)], b)
        want = insert_new(rows.filter("order_id is not null"), ledger)
        body = sorted(x.body for x in want.collect())
        got = run(index, rows, b)
        assert [x for x in got if not x.startswith("None:")] == body
        assert sum(x.startswith("None:") for x in got) == (1 if b == 0 else 0)     # a null key is one key
        assert run(index, rows, b) == got                                          # a replay doesn't see itself
        ledger = ledger.unionByName(want)
    assert index.unseen(batch(spark, []), "w", 9).count() == 0


def test_only_touched_buckets_are_read_and_reads_do_not_grow(spark, tmp):
    index = KeyIndex(spark, f"{tmp}/keys", buckets=64)
    reads = []
    for b in range(3):
        rows = batch(spark, [f"b{b}-{k}" for k in range(300)])
        index.claim(rows, "w", b)
        probe = [r[0] for r in batch(spark, [f"new{b}"]).select(index.bucket()).collect()]
        stored = index.stored(probe, "w", 99)
        assert all(f"/bucket={probe[0]}/" in f for f in stored.inputFiles())  # the only folder listed
        reads.append(scan_rows(stored))
        assert reads[-1] <= 900 * 3 / 64                     # one bucket of 64, not the table
        assert {r.bucket for r in stored.select("bucket").distinct().collect()} <= set(probe)


def test_rebuild_and_compact_keep_the_answers(spark, tmp):
    index = KeyIndex(spark, f"{tmp}/keys", buckets=4)
    for b in range(3):
        run(index, batch(spark, [f"o{k}" for k in range(30 * b, 30 * b + 40)]), b)
    again = batch(spark, ["o5", "o65", "o99x", "o35"])
    want = run(KeyIndex(spark, f"{tmp}/keys", buckets=4), again, 7)
    assert want == ["o99x:2"]
    assert index.compact("w", 2) > 0 and index.compact("w", 2) == 0
    merged = spark.read.parquet(f"{tmp}/keys").filter("batch_id = -1")
    assert merged.count() == 70 and merged.select("bucket", F.input_file_name()).distinct().count() <= 4
    assert [r.body for r in index.unseen(again, "w", 8).collect()] == []   # all stored by now
    stored = spark.createDataFrame([(f"o{k}", "v", 1) for k in range(10)], "order_id string, writer string, batch_id long")
    fresh = KeyIndex(spark, f"{tmp}/other", buckets=4)
    fresh.rebuild(stored)
    assert [r.order_id for r in fresh.unseen(batch(spark, ["o3", "o11"]), "w", 0).collect()] == ["o11"]
    assert fresh.unseen(batch(spark, ["o3"]), "v", 1).count() == 1         # the batch that stored it may store it again


def test_a_merged_file_skips_absent_keys_by_its_bloom_filter(spark, tmp):
    index = KeyIndex(spark, f"{tmp}/keys", buckets=1)
    index.claim(batch(spark, [f"o{2 * k:04}" for k in range(500)]), "w", 0)
    assert index.compact("w", 1) == 1
    read = spark.read.parquet(f"{tmp}/keys")
    assert scan_rows(read.filter(F.col("order_id") == "o0100")) > 0
    absent = [f"o{2 * k + 1:04}" for k in range(5, 400, 40)]     # between stored keys: minima and maxima can't tell
    assert sum(scan_rows(read.filter(F.col("order_id") == i)) > 0 for i in absent) <= 1


def test_point_lookup_in_the_ledger_skips_row_groups(spark, tmp):
    """P-07: a ledger file whose Bloom filter lacks the id hands out no row."""
    from orderflow.operators.validate import find_order, split_malformed, to_ledger
    from orderflow.sources import tables as tb
    from orderflow.sources.ledger import bulk_load
    good, _ = split_malformed(tb.malformed_messages_view(spark, "/root/testdata/sf0.001"))
    bulk_load(to_ledger(good), f"{tmp}/l")
    led = spark.read.parquet(f"{tmp}/l")
    ids = [r.order_id for r in led.select("order_id").limit(3).collect()]
    assert all(find_order(led, i, 4).count() == 1 and scan_rows(find_order(led, i, 4)) > 0 for i in ids)
    low = min(ids)
    assert sum(scan_rows(find_order(led, f"{low}{c}", 4)) > 0 for c in "abcdefgh") <= 1


def test_reconcile_by_digests(spark):
    from orderflow.operators import joins
    r = random.Random(2)
    sub = [f"o{k}" for k in range(300)] + ["o7", None]
    led = [x for x in sub if x != "o13"] + ["o20", "x1", "x1"]
    r.shuffle(led)
    a, b = (spark.createDataFrame([(x,) for x in ids], "order_id string").repartition(3) for ids in (sub, led))
    for buckets in (1, 64):
        got = joins.reconcile_digests(a, b, buckets=buckets)
        known = "order_id is not null"
        assert sorted(map(str, got.filter(known).collect())) == sorted(map(str, joins.reconcile(a, b).filter(known).collect()))
    equal = joins.reconcile_digests(a, a.repartition(5))
    plan = equal._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and {x.state for x in equal.collect()} == {"ok", "duplicate"}
    none = spark.createDataFrame([], "order_id string")
    assert joins.reconcile_digests(none, none).count() == 0
    assert {x.state for x in joins.reconcile_digests(none, a).filter("order_id is not null").collect()} == {"extra"}


def test_stored_keys_are_looked_up_once_a_batch_and_not_broadcast(spark, tmp, monkeypatch):
    from orderflow.sources import tables as tb
    from orderflow.streaming import ingest
    paths = ingest.IngestPaths(f"{tmp}/source", f"{tmp}/ledger", f"{tmp}/acks", f"{tmp}/quarantine", f"{tmp}/ckpt", key_buckets=2)
    m = tb.malformed_messages_view(spark, "/root/testdata/sf0.001").filter("o_orderkey < 200")
    ingest.process_batch(m.filter("o_orderkey < 100"), 0, paths, first_wins=True)
    rows, plans, unseen = spark.sparkContext.accumulator(0), [], KeyIndex.unseen

    def counted(self, *args):
        found = unseen(self, *args)
        plans.append(found._jdf.queryExecution().executedPlan().toString())

        def count(batches, rows=rows):
            for b in batches:
                rows.add(b.num_rows)
                yield b

        return found.mapInArrow(count, found.schema)

    monkeypatch.setattr(KeyIndex, "unseen", counted)
    res = ingest.process_batch(m, 1, paths, first_wins=True)
    assert (res["inserted"], res["duplicates"], res["skipped"]) == (60, 60, 80)
    assert rows.value == 60
    assert [line.split("[")[0].split()[-1] for line in plans[0].splitlines() if "Join" in line and "__in#" in line] == ["SortMergeJoin"]
