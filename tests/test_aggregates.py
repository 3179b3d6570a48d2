"""Histogram buckets and quantiles (A-08 .. A-10), shard balance, health."""

from pyspark.sql import functions as F

from orderflow.operators.aggregates import (approx_quantiles, exact_quantiles, health, histogram,
                                            histogram_quantile)


def test_histogram_cumulative_with_inf(spark):
    df = spark.createDataFrame([(0.002,), (0.2,), (3.0,), (100.0,)], "v double")
    h = {r.le: r.bucket_count for r in histogram(df, "v", [0.001, 0.01, 1.0]).collect()}
    assert h == {0.001: 0, 0.01: 1, 1.0: 2, float("inf"): 4}


def test_histogram_quantile_edges(spark):
    df = spark.createDataFrame([(0.5,), (0.5,), (5.0,), (50.0,)], "v double")
    h = histogram(df, "v", [1.0, 10.0])
    assert histogram_quantile(h, 0.5).first().value == 1.0          # rank 2 at the top of bucket 1
    assert histogram_quantile(h, 0.99).first().value == 10.0        # in +Inf -> highest finite bound
    empty = histogram(df.filter("v < 0"), "v", [1.0])
    assert [r.value for r in histogram_quantile(empty, [0.5, 0.9]).collect()] == [None, None]


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(1001).select((F.col("id") % 2).alias("g"), (F.col("id") * 1.5).alias("v"), "id")
    got = {r.g: (r.p50, r.p90) for r in exact_quantiles(df, "v", ["g"], [0.5, 0.9], tiebreak="id").collect()}
    want = {r.g: (r.a, r.b) for r in df.groupBy("g").agg(
        F.percentile("v", 0.5).alias("a"), F.percentile("v", 0.9).alias("b")).collect()}
    assert got == want


def test_approx_quantiles_close(spark):
    df = spark.range(10000).select(F.lit(0).alias("g"), F.col("id").cast("double").alias("v"))
    r = approx_quantiles(df, "v", ["g"], [0.5]).first()
    assert abs(r.p50 - 5000) <= 10


def test_health_degraded_when_any_open(spark):
    s = spark.createDataFrame([("a", "closed"), ("b", "open")], "name string, state string")
    r = health(s).first()
    assert r.status == "degraded" and r.circuit_breakers == {"a": "closed", "b": "open"}
    ok = health(s.filter("name = 'a'")).first()
    assert ok.status == "ok"
