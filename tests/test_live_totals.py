"""Counts per micro-batch as a table (T-11)."""

from orderflow.streaming.ingest import live_totals, sink_counts


def test_totals_count_each_batch_once(spark, tmp):
    path = f"{tmp}/counters"

    def put(batch_id, received, inserted, writer):
        sink_counts(spark, {"batch_id": batch_id, "received": received, "inserted": inserted, "duplicates": 0,
                            "skipped": received - inserted}, path, writer)

    put(0, 10, 9, "a")
    put(1, 7, 3, "a")
    put(1, 7, 5, "a")  # replayed: replaces its row
    put(1, 4, 4, "0123")  # another writer, also one whose name looks like a number
    got = {r["writer"]: tuple(r)[1:] for r in live_totals(spark, path).collect()}
    assert got == {"a": (2, 17, 14, 0, 3), "0123": (1, 4, 4, 0, 0)}
