"""Prefix BPE, unigram counts and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, normalizers

from orderflow.llm.bpe import PrefixBPE, _Worker, bpe_digests, chunks, decode, encode
from orderflow.llm.packing import pack, places, tokenize
from orderflow.llm.token_counts import MARK, CountViterbi, count_tokens, read_vocabulary

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "\t", " \t", "a", "the", "aaaa", "é", "ß", "漢", "\x1c", "\x85", "\xa0", "　", "'s", "'ll", "1",
         "23", "½", "_", "--", "!!!", "<|endoftext|>", "<|endof", "\r", "ñ", "😀", "٣", " a", " .", "\x00", "<unk>", "<0x41>", MARK]


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["a" * 500, " " * 50, "-" * 333, ""]


def test_prefix_bpe_equals_library():
    lib, worker = Tokenizer.from_file(BYTE), _Worker(BYTE)
    for x in texts(1500, 1):
        want = lib.encode(x, add_special_tokens=False).ids
        assert worker.bpe.encode(x) == want, repr(x)
        joined = ",".join(worker.encode(x))
        assert joined == ",".join(map(str, want)), repr(x)
        assert worker.decode(joined) == worker.bpe.decode(want) == lib.decode(want, skip_special_tokens=False)


def test_compatible_pairs_are_those_bpe_keeps_apart():
    bpe, lib = PrefixBPE(BYTE), Tokenizer.from_file(BYTE)
    r = random.Random(2)
    ids = [i for i, b in bpe.bytes_of.items() if b.isalpha() and b.isascii()]
    for _ in range(400):
        a, b = r.choice(ids), r.choice(ids)
        got = lib.encode((bpe.bytes_of[a] + bpe.bytes_of[b]).decode(), add_special_tokens=False).ids
        assert bpe.fits(a, b) == (got == [a, b])


def test_chunks_keep_the_text():
    for x in texts(300, 3):
        c = chunks(x)
        back = "".join(c[:1]) + "".join(y[1:] if y[:1] == "\t" else " " + y for y in c[1:])
        assert back == x


def test_bpe_queries(spark, odd, odd_rows, none):
    lib = Tokenizer.from_file(BYTE)
    got = sorted(map(tuple, bpe_digests(odd, BYTE).collect()), key=repr)
    want = []
    for i, t, *_ in odd_rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe_digests(none, BYTE).count() == 0
    back = decode(encode(odd, BYTE), BYTE).collect()
    assert sorted((r.doc_id, r.text) for r in back if r.doc_id) == sorted((i, t or "") for i, t, *_ in odd_rows if i)


def test_unigram_counts_equal_library(odd, odd_rows, none):
    vocabulary, unk = read_vocabulary(PIECE)
    lib = Tokenizer(models.Unigram(vocabulary, unk_id=unk, byte_fallback=True))
    lib.normalizer = normalizers.Sequence([normalizers.Prepend(MARK), normalizers.Replace(" ", MARK)])
    v = CountViterbi(vocabulary, unk)
    for x in texts(1000, 4):
        assert sum(map(v.count, v.parts(x))) == len(lib.encode(x, add_special_tokens=False).ids), repr(x)
    got = sorted(map(tuple, count_tokens(odd, PIECE).collect()), key=repr)
    assert got == sorted(((i, len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in odd_rows), key=repr)
    assert count_tokens(none, PIECE).count() == 0


def test_unigram_ties_go_to_the_longest_last_piece():
    vocabulary = [("<unk>", -9.0), ("a", -2.0), ("b", -2.0), ("c", -2.0), ("ab", -4.0), ("bc", -4.0), ("abc", -6.0)]
    lib = Tokenizer(models.Unigram(vocabulary, unk_id=0))
    v = CountViterbi(vocabulary, 0)
    for x in ("abc", "ab", "bcabc", "aabcb", "abxab"):
        want = [t for t in lib.encode(x).tokens]
        assert v.count(x) - sum(len(t.encode()) - 1 for t in want if t not in v.pieces) == len(want)


def _check_pieces(rows, odd_rows):
    lib = Tokenizer.from_file(WORD)
    want = sorted((i, tuple(lib.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t, *_ in odd_rows if i is not None)
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id, r.sequence_id, r.offset)):
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    got = []
    for (doc, n), pieces in by_doc.items():
        at, ids = 0, ()
        for r in pieces:  # repeated rows of one id follow each other in the stream
            assert r.start == at
            ids += tuple(r.ids)
            at = 0 if at + r.length == n else at + r.length
            if not at:
                got.append((doc, ids))
                ids = ()
        assert not ids
    assert sorted(x for x in got if x[0] is not None) == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(seqs) == list(range(len(seqs)))
    for s, parts in seqs.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 128 or s == max(seqs)


@pytest.mark.parametrize("weights", [None, {"a": 0.5, "b": 0.5}])
def test_packing_keeps_every_token_once(odd, odd_rows, none, weights):
    _check_pieces(pack(odd, WORD, seq_len=128, window=512, weights=weights).collect(), odd_rows)
    if weights is None:
        assert pack(none, WORD).count() == 0


def test_windows_hold_the_target_mixture(spark):
    r = random.Random(8)
    docs = spark.createDataFrame([(k, " ".join(["river"] * r.randint(5, 40)), "big" if k % 4 else "small") for k in range(800)],
                                 "doc_id long, text string, source string").repartition(5)
    tokens = tokenize(docs, WORD)
    rows = tokens.join(places(tokens, window=2000), ["part", "row"]).select("queue", "n", "place").collect()
    total = sum(x.n for x in rows)
    share = sum(x.n for x in rows if x.queue == "=small") / total
    for end in range(2000, total - 2000, 2000):
        small = sum(min(x.n, end - x.place) for x in rows if x.queue == "=small" and x.place < end)
        assert abs(small - share * end) <= 2 * 41 + 4


def test_packing_tokens_equal_library(spark):
    import random

    import numpy as np
    r = random.Random(2)
    bits = ["\n", " ", "\r\n", "\x0b", "\x1c", "\x85", "　", "İ", "ﬁ", "é", "ABC", "stone.", "it's", "12", "漢字",
            "<|startoftext|>", "<|", "Ⅷ", "ª", "ʰx", "ǅ", "ß", "\x00", "a"]
    some = ["", None, "İİ", "word " * 3000] + ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(1500)]
    docs = spark.createDataFrame([(k, "s", t) for k, t in enumerate(some)], "doc_id long, source string, text string")
    lib = Tokenizer.from_file(WORD)
    rows = tokenize(docs, WORD, 1).collect()
    assert len(rows) == len(some)
    for row in rows:
        want = [*lib.encode(some[row.doc_id] or "", add_special_tokens=False).ids, 1]
        assert np.frombuffer(row.ids, "<u2").tolist() == want and row.n == len(want), repr(some[row.doc_id])
