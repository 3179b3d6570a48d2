"""Files of the shard logs: as many as the bytes ask for, each shared by many reading tasks (S-03, T-01)."""

import glob

from pyspark.sql import functions as F

from orderflow.sources import messages as msgs
from orderflow.sources import tables as tb
from orderflow.streaming.ingest import IngestPaths, live_totals, start_ingest

SF = "/root/testdata/sf0.001"


def files_of(path):
    return sorted(glob.glob(f"{path}/shard=*/*.parquet"))


def long_messages(spark, n, shards=1):
    data = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(3)])
    return spark.range(0, n, 1, 16).select(
        F.concat(F.col("id").cast("string"), F.lit("-0")).alias("msg_id"), F.lit("order_created").alias("type"), data.alias("data"),
        F.lit("0.000").alias("timestamp"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), (F.col("id") % shards).cast("int").alias("shard"))


def test_micro_batches_do_not_grow_with_the_tasks_that_wrote_the_log(spark, tmp):
    m = tb.malformed_messages_view(spark, SF).repartition(12)
    msgs.write_messages(m, f"{tmp}/source")
    paths = IngestPaths(f"{tmp}/source", f"{tmp}/ledger", f"{tmp}/acks", f"{tmp}/quarantine", f"{tmp}/ckpt", counters=f"{tmp}/counters")
    start_ingest(spark, paths, max_files_per_trigger=1).awaitTermination()
    got = live_totals(spark, paths.counters).first()
    assert (got["batches"], got["received"]) == (4, m.count())


def test_many_tasks_read_one_file(spark, tmp):
    msgs.write_messages(long_messages(spark, 120_000), f"{tmp}/log")
    assert len(files_of(f"{tmp}/log")) == 1
    rows = msgs.read_messages(spark, f"{tmp}/log").groupBy(F.spark_partition_id()).count().collect()
    assert len(rows) > 2 and sum(r["count"] for r in rows) == 120_000


def test_a_large_shard_gets_several_files(spark, tmp, monkeypatch):
    monkeypatch.setattr(msgs, "FILE_BYTES", 1 << 20)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    m = long_messages(spark, 40_000, shards=2)
    msgs.write_messages(m, f"{tmp}/log")
    assert 4 <= len(files_of(f"{tmp}/log")) <= 16
    back = msgs.read_messages(spark, f"{tmp}/log").select(*m.columns)
    assert back.count() == 40_000 and back.exceptAll(m).count() == 0
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_a_shard_gets_the_files_asked_for_from_many_tasks(spark, tmp):
    m = tb.malformed_messages_view(spark, SF)
    for n in (3, 5):
        msgs.write_messages(m, f"{tmp}/log{n}", files=n)
        assert [len(glob.glob(f"{tmp}/log{n}/shard={s}/*.parquet")) for s in range(4)] == [n] * 4
    tasks = {f.rsplit("/part-", 1)[1].split("-")[0] for f in files_of(f"{tmp}/log3")}
    assert len(tasks) == 12  # three tasks wrote all of them with repartition(3)
    assert msgs.read_messages(spark, f"{tmp}/log3").count() == m.count()
