"""Minimax sharding and WARC round trips against plain Python."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

from orderflow.llm.sharding import _greedy, minimax_cuts, shard_documents
from orderflow.llm.warc import assemble, read_warc, resolve_revisits, warc_round_trip, write_warc
from orderflow.session import scratch_path


@pytest.mark.parametrize("seed", range(25))
def test_capacity_is_the_smallest(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.choice([1, 5, 100, 3000])), int(rng.choice([1, 2, 7, 40]))
    size = rng.lognormal(5, 1.3, n).astype(int) + 16
    if seed % 3 == 0:
        size[n // 2] = int(size.sum() * 0.3) + 1
    prefix = np.cumsum(size)

    def inside(stretches, per_cut):
        out = []
        for a, b in stretches:
            x = prefix[(prefix > a) & (prefix < b)]
            cell = (x - a - 1) * per_cut // (b - a)
            out += [(int(x[cell == c].min()), int(x[cell == c].max()), int((cell == c).sum())) for c in np.unique(cell)]
        return out

    blocks = sorted({*prefix[::20].tolist(), int(prefix[-1])})
    capacity, cuts = minimax_cuts(inside, blocks, int(size.max()), k, per_cut=16)
    ends = [0, *prefix.tolist()]
    assert _greedy(ends, capacity, k) and _greedy(ends, capacity - 1, k) is None
    assert np.diff([0, *cuts]).max() <= capacity and cuts[-1] == prefix[-1] and len(cuts) <= k


def test_shards(odd, odd_rows, none):
    rows = shard_documents(odd, shards=5, blocks=16, salts=3).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id) == sorted(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows if i)
    assert len(rows) == len(odd_rows)
    for s in range(5):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    by_text = {}
    for r in rows:
        by_text.setdefault((r.text_crc32, r.size, r.group_rows), set()).add(r.shard)
    assert all(len(v) <= 2 for v in by_text.values())  # null and empty texts are two groups
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert shard_documents(none).count() == 0


HARD = "WARC/1.0\r\nWARC-Type: response\r\n\r\n\r\n\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def test_round_trip(spark):
    r = random.Random(3)
    body = ["", "x", HARD, "é漢😀" * 50, "long " * 20_000, None]
    pages = [(k, f"http://h/{k}\r\nX: y" if k % 5 else None, r.choice(body), k, "d") for k in range(60)]
    pages += [(7, "http://h/7", "x", 1, "d"), (7, "http://h/7", "x", 1, "d"), (None, None, "only here", 1, "d"), (None, "u", "x", 1, "d")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest long, id string").repartition(3)
    got = warc_round_trip(df).collect()
    assert len(got) == len(pages) and all(x.digest_ok for x in got)
    best = {}
    for i, _, h, *_ in pages:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = sorted((i is not None, i or 0, len((h or "").encode()),
                   base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for i, _, h, *_ in pages)
    assert sorted((x.page_id is not None, x.page_id or 0, x.payload_bytes, x.payload_digest) for x in got) == want
    responses = {}
    for x in got:
        if x.record_type == "response":
            assert x.payload_digest not in responses and x.refers_to is None
            responses[x.payload_digest] = x.page_id
    for h, i in best.items():
        d = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        assert responses[d] == (None if i < 0 else i)
        assert all(x.refers_to == responses[d] for x in got if x.payload_digest == d and x.record_type == "revisit")
    small = warc_round_trip(df, min_payload=10).collect()
    assert all(x.record_type == "response" for x in small if x.payload_bytes < 10)
    assert warc_round_trip(df.where("page_id < -1")).count() == 0


def test_archives_hold_the_payload_and_chains_are_followed(spark):
    path = scratch_path(spark, "warc-test")
    write_warc(spark.createDataFrame([(1, "u", HARD), (2, "u", HARD)], "page_id long, url string, html string"), path)
    records = read_warc(spark, path)
    kept = {x.warc_type: x.payload for x in records.collect()}
    assert bytes(kept["response"]) == HARD.encode() and kept["request"] is None
    cap = resolve_revisits(assemble(records)).collect()
    assert len(cap) == 2 and all(c.request and c.metadata for c in cap)
    schema = records.schema
    chain = spark.createDataFrame([
        ("response", "r", None, None, "u", "d", 3, "d", None, b"abc"), ("request", "q", "r", None, "u", None, None, None, None, None),
        ("metadata", "m", "q", None, "u", None, None, None, 9, None), ("metadata", "lost", "nowhere", None, "u", None, None, None, 8, None),
        ("request", "free", None, None, "u", None, None, None, None, None)], schema)
    (one,) = assemble(chain).collect()
    assert one.capture_id == "r" and one.request.record_id == "q" and one.metadata.page_id == 9
