"""ORC token files against the tokenizers library; pruned reads skip row groups."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderflow.llm.token_files import (_Encoder, find_tokens, read_parts, read_tokens, token_checksums, token_file_round_trip,
                                       tokens_between, write_tokens)
from tests.llm.test_tokenizers import texts

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(lib, text, end=2):
    return [*lib.encode(text or "", add_special_tokens=False).ids, end]


def test_encoder_equals_library():
    lib, enc = Tokenizer.from_file(BYTE), _Encoder(BYTE)
    assert [len(x) for x in enc.encode_all([""])] == [0] and enc.encode_all([]) == []
    some = texts(1500, 7) + ["a b  c\n d", " lead", "trail ", "x<|endoftext|> y", "tab\t\tt", "\t", " \t x", "a　 b"]
    for _ in range(2):  # the second time from the store
        for x, raw in zip(some, enc.encode_all(some), strict=True):
            assert raw.tolist() == lib.encode(x, add_special_tokens=False).ids, repr(x)


def test_round_trip_of_odd_rows(spark, odd, odd_rows, none):
    lib = Tokenizer.from_file(BYTE)
    got = token_file_round_trip(odd, BYTE).collect()
    want = sorted((-1 if i is None else i, len(ids_of(lib, t)), zlib.crc32(np.array(ids_of(lib, t), "<u4").tobytes()))
                  for i, t, *_ in odd_rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0  # starts are gapless, in order of doc_id, null first
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered)
    assert token_file_round_trip(none, BYTE).count() == 0


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    r = random.Random(3)
    rows = [(2 * k, " ".join(r.choice(["river", "stone", "über", "a"]) for _ in range(r.randint(0, 80)))) for k in range(4000)]
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, BYTE, files=3,
                 stripe_bytes=1 << 16, stride=1000)
    return path, rows


def scanned(df) -> int:
    """Rows that the ORC scan of the token table handed out."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.collectToPython()
        found, todo = 0, [plan]
        while todo:
            node = todo.pop()
            if node.nodeName().startswith("Scan orc") and "n_tokens" in node.toString():
                found += node.metrics().apply("numOutputRows").value()
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        return found
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_files_stripes_and_parts(spark, written):
    path, rows = written
    parts = read_parts(spark, path).orderBy("part").collect()
    assert [p.part for p in parts] == [0, 1, 2] and sum(p.documents for p in parts) == len(rows)
    assert all(a.last_doc < b.first_doc and a.part_start + a.tokens == b.part_start for a, b in zip(parts, parts[1:]))
    files = read_tokens(spark, path).inputFiles()
    stripes = [orc.ORCFile(f.removeprefix("file://")).nstripes for f in files if "/tokens/" in f]
    assert len(stripes) == 3
    doc_ids = [r.doc_id for r in read_tokens(spark, path).orderBy("start").select("doc_id").collect()]
    assert doc_ids == [i for i, _ in rows]


def test_lookup_skips_row_groups(spark, written):
    path, rows = written
    lib = Tokenizer.from_file(BYTE)
    some = [rows[5], rows[1717], rows[3999]]
    got = {r.doc_id: list(r.ids) for r in find_tokens(spark, path, [i for i, _ in some]).collect()}
    assert got == {i: ids_of(lib, t) for i, t in some}
    assert scanned(find_tokens(spark, path, [rows[1717][0]])) <= 1000      # one row group of 4
    absent = [2 * k + 1 for k in (5, 400, 1717, 3000)]                     # inside the range, not there: the Bloom filter says so
    assert find_tokens(spark, path, absent).count() == 0
    assert sum(scanned(find_tokens(spark, path, [i])) for i in absent) <= 1000
    plan = find_tokens(spark, path, [4])._jdf.queryExecution().toString()
    assert "doc_id" in plan.split("PushedFilters")[1]


def test_window_of_the_stream(spark, written):
    path, rows = written
    lib = Tokenizer.from_file(BYTE)
    stream = [i for _, t in rows for i in ids_of(lib, t)]
    for a, b in ((0, 10), (12345, 13001), (len(stream) - 5, len(stream) + 50), (7, 7)):
        got = tokens_between(spark, path, a, b).orderBy("start").collect()
        assert [i for r in got for i in r.ids] == stream[a:b]
        assert sum(r.n_tokens for r in got) == len(stream[a:b])
    assert scanned(tokens_between(spark, path, 0, 10)) < len(rows)


def test_bloom_and_index_streams_exist(spark, written):
    path, _ = written
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    f = [x for x in read_tokens(spark, path).inputFiles() if "/tokens/" in x][0]
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getRowIndexStride() == 1000
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    codes = {footer.getColumns(i).getKind().toString() for i in range(footer.getColumnsCount())}
    assert "DIRECT_V2" in codes  # run-length encoded integers


def test_checksums_of_sliced_lists(spark):
    df = spark.createDataFrame([(1, 0, [1, 2]), (2, 2, [70000]), (3, 3, [])], "doc_id long, start long, ids array<int>")
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_checksums(df.where(F.col("doc_id") > 0)).collect()}
    assert got == {i: (len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for i, v in ((1, [1, 2]), (2, [70000]), (3, []))}


def test_line_ends_equal_library():
    lib, enc = Tokenizer.from_file(BYTE), _Encoder(BYTE, limit=50)
    r = random.Random(5)
    bits = ["\n", "\n\n", "\r\n", "\n ", " ", "\t", "\x0b", "\x85", "　", "\x1c", "a", "Erth", "stone.", "it's", "'s", "12", "über", "...", "漢字", "́"]
    some = ["\n", "a\n", "\na", "a\nb", "a.\n'sb", "a \nb"] + ["".join(r.choice(bits) for _ in range(r.randint(1, 12))) for _ in range(4000)]
    for k in range(0, len(some), 500):
        for x, raw in zip(some[k:k + 500], enc.encode_all(some[k:k + 500]), strict=True):
            assert raw.tolist() == lib.encode(x, add_special_tokens=False).ids, repr(x)
