"""Retry rules (cases 20-23)."""

from orderflow.operators.aggregates import retry_rollup


def test_retry_waits_and_exhaustion(spark):
    df = spark.createDataFrame([(1, a, False) for a in (1, 2, 3)] + [(2, 1, False), (2, 2, True)],
                               "op_id long, attempt int, ok boolean")
    r = {x.op_id: x for x in retry_rollup(df).collect()}
    assert r[1].exhausted and not r[1].recovered and r[1].waited_s == 3.0 and r[1].attempts == 3
    assert r[2].recovered and r[2].waited_s == 1.0
