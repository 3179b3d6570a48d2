"""Plan shapes that matter at scale: pruning, pushdown, partial aggregation, top-k."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from orderflow.operators.validate import find_order, split_malformed, to_ledger
from orderflow.sources import tables as tb
from orderflow.sources.ledger import sink_ledger

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_point_lookup_prunes_shard_and_pushes_id(spark, tmp):
    good, _ = split_malformed(tb.malformed_messages_view(spark, SF))
    sink_ledger(to_ledger(good), f"{tmp}/l")
    p = plan(find_order(spark.read.parquet(f"{tmp}/l"), "ORD-7", 4))
    assert "PartitionFilters: [isnotnull(shard" in p
    assert "PushedFilters: [IsNotNull(order_id), EqualTo(order_id,ORD-7)]" in p


def test_audit_reads_two_columns_and_aggregates_partially(spark):
    p = plan(E.queries()["audit_by_shard"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p
    assert "partial_count" in p and "partial_sum" in p


def test_first_errors_is_top_k(spark):
    assert "TakeOrderedAndProject(limit=10" in plan(E.queries()["first_errors"](spark, SF))


def test_oldest_pending_limits_before_shuffle(spark):
    p = plan(E.queries()["oldest_pending"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_event_filter_reaches_scan(spark):
    p = plan(E.queries()["published_total"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in p
