"""the messages that the ingest queries write are built and decoded without the costly steps."""

from pyspark.sql import functions as F

from orderflow.operators import scan
from orderflow.operators.validate import decode_orders
from orderflow.sources import tables as tb

SF = "/root/testdata/sf0.001"


def test_rows_are_numbered_without_their_items(spark, monkeypatch):
    stored, write = [], scan.write_scratch
    monkeypatch.setattr(scan, "write_scratch", lambda df, *a: stored.append(df.inputFiles()) or write(df, *a))
    m = tb.messages_view(spark, SF)
    assert len(stored) == 1 and "orders" in str(stored[0]) and "lineitem" not in str(stored[0])
    got = {r.o_orderkey: (r.items, r["data"]) for r in m.select("o_orderkey", "items", "data").collect()}
    orders = {r.o_orderkey: list(r["items"]) for r in tb.orders_view(spark, SF).collect()}
    assert {k: v[0] for k, v in got.items()} == orders and any(not v for v in orders.values())


def test_items_are_distinct_sorted_names(spark, tmp_path):
    rows = [(1, 10), (1, 9), (1, 10), (2, None), (2, 7), (3, None), (None, 4)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.l_orderkey: list(r["items"]) for r in tb.order_items(spark, str(tmp_path)).collect()}
    assert got == {1: ["PART-10", "PART-9"], 2: ["PART-7"], 3: [], None: ["PART-4"]}


def test_items_are_not_combined_before_the_shuffle(spark):
    plan = tb.order_items(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" not in plan[plan.index("Exchange"):]


def test_errors_are_compiled(spark):
    bad = spark.createDataFrame([(None,), ("{",), ("[]",), ("{}",), ('{"order_id":1,"customer_id":"c","amount":"x","items":[]}',),
                                 ('{"order_id":"o","customer_id":"c","amount":1,"items":[]}',)], "data string")
    d = decode_orders(bad)
    assert [r.errors for r in d.collect()] == [
        ["invalid_json"], ["invalid_json"], ["not_object"],
        ["missing:order_id", "missing:customer_id", "missing:amount", "missing:items"], ["type:order_id", "type:amount"], []]
    assert "lambdafunction" not in d.select(F.size("errors"))._jdf.queryExecution().optimizedPlan().toString()
