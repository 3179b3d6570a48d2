"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of a pre-token is found without merging: for every prefix the
last token of its encoding is unique, so it is stored once. A vocabulary
automaton (Aho-Corasick) lists the tokens that end at each position; a token
is the last one of the prefix exactly if it is compatible with the stored last
token of the prefix before it. Two tokens are compatible if BPE, run over
their joined bytes, gives back the two tokens. Back-pointers give the ids.

Text is cut into chunks at spaces where the pre-tokenizer can't look across,
and chunks met lately are kept per Python worker in bounded memory; that only
saves time, every text is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import RecentCache, slices
from orderflow.session import ship_package

#: A blank that another white space follows: chunks can't simply be cut at each space then.
DOUBLE = re.compile(r" \s")
_RUN = regex.compile(r"\s*\S+|\s+")


def byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in byte-level vocabularies -> the byte."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b < 256 and not 0x7F <= b <= 0xA0 and b != 0xAD]
    plain = [b for b in plain if b > 0x20]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixBPE:
    """A byte-level BPE model read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, sym = spec["model"], byte_symbols()
        if spec.get("normalizer") or model.get("unk_token") or model.get("end_of_word_suffix") \
                or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE model is needed")
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"]:
            raise ValueError("the byte-level pre-tokenizer without prefix space is needed")
        # the byte-level pre-tokenizer's fixed pattern
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        ids = {tok: i for tok, i in model["vocab"].items()}
        self.bytes_of: dict[int, bytes] = {i: bytes(sym[c] for c in tok) for tok, i in ids.items()}
        self.special: dict[str, int] = {}
        for t in spec.get("added_tokens", []):
            if t.get("single_word") or t.get("lstrip") or t.get("rstrip"):
                raise ValueError("added tokens with context rules aren't supported")
            self.special[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair, whole = (ids[a], ids[b]), ids[a + b]
            self.rank.setdefault(pair, r)
            if whole not in self.made:
                self.made[whole], self.halves[whole] = r, pair
        self.auto = ahocorasick.Automaton()
        for i in ids.values():
            raw = self.bytes_of[i]
            if len(raw) == 1 or i in self.made:
                self.auto.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.auto.make_automaton()
        if len({self.bytes_of[i] for i in ids.values() if len(self.bytes_of[i]) == 1}) < 256:
            raise ValueError("the vocabulary lacks a byte")
        self.fits = lru_cache(maxsize=1 << 18)(self._fits)

    def _fits(self, a: int, b: int) -> bool:
        """Whether BPE over the bytes of ``a`` then ``b`` ends in exactly these two tokens.

        The merges that made the two are taken back, latest first. A merge
        across the seam spoils the pair if it ranks before the merge, taken
        back last, that used up one of its parts; in the right token an equal
        rank spoils too, because of equal ranks the leftmost merges first.
        """
        rank, made, halves = self.rank, self.made, self.halves
        bound = len(rank) + 1
        while True:
            r = rank.get((a, b))
            if r is not None and r < bound:
                return False
            ra, rb = made.get(a, -1), made.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                bound, a = ra, halves[a][1]
            else:
                bound, b = rb + 1, halves[b][0]

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        n, fits = len(raw), self.fits
        last: list = [None] * n   # last token of the encoding of each prefix, by its last byte
        size = [0] * n
        for end, (tok, k) in self.auto.iter(raw.decode("latin-1")):
            if last[end] is None:
                before = end - k
                if before < 0 or fits(last[before], tok):
                    last[end], size[end] = tok, k
        out, n = [], n - 1
        while n >= 0:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        ids: list[int] = []
        for piece in self.pattern.findall(text):
            ids += self.encode_piece(piece.encode())
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for k, part in enumerate(self.parts(text)):
            ids += [self.special[part]] if k % 2 else self.encode_plain(part)
        return ids

    def parts(self, text: str) -> list[str]:
        """Plain stretches and special tokens in turn."""
        return self.split_special.split(text) if self.split_special else [text]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def chunks(text: str) -> list[str]:
    """Cut ``text`` where no pre-token crosses and no look-ahead matters.

    Either before a run of white space (a cut between a non-blank and a
    blank), or before a single space that a non-blank follows. The first space
    of every chunk but the first is left out; a chunk that doesn't begin with
    a space begins with a tab, so that it can be told apart.
    """
    if DOUBLE.search(text) or text[-1:] == " ":
        out = _RUN.findall(text)
        return out[:1] + [x[1:] if x[0] == " " and x[1:2] != "\t" else "\t" + x for x in out[1:]]
    out = text.split(" ")
    return out if "\t" not in text else out[:1] + [x if x[0] != "\t" else "\t " + x for x in out[1:]]


class _Worker:
    """One model and its stores of recent chunks, kept per Python worker."""

    def __init__(self, path: str):
        self.bpe = bpe = PrefixBPE(path)
        self.pieces = RecentCache(lambda new: [",".join(map(str, bpe.encode_piece(x.encode()))) for x in new], limit=200_000)
        self.ids = RecentCache(lambda new: [self._ids(" " + x if x[:1] != "\t" else x[1:]) for x in new], limit=500_000)
        n = max(bpe.bytes_of) + 1
        self.flat = np.frombuffer(b"".join(bpe.bytes_of.get(i, b"") for i in range(n)), np.uint8)
        self.length = np.array([len(bpe.bytes_of.get(i, b"")) for i in range(n)], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def _ids(self, chunk: str) -> str:
        return ",".join(map(self.pieces.__getitem__, self.bpe.pattern.findall(chunk)))

    def encode(self, text: str) -> list[str]:
        """Ids of a text as decimal strings, one string for each chunk."""
        out: list[str] = []
        for k, part in enumerate(self.bpe.parts(text)):
            if k % 2:
                out.append(str(self.bpe.special[part]))
            elif part:
                cut = chunks(part)
                if cut[0]:
                    out.append(self._ids(cut[0]))
                out += map(self.ids.__getitem__, cut[1:])
        return out

    def decode(self, joined: str) -> str:
        """The text of decimal ids joined by commas."""
        if not joined:
            return ""
        ids = np.fromstring(joined, np.int64, sep=",")
        size = self.length[ids]
        end = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - end + size, size) + np.arange(end[-1])].tobytes().decode("utf-8", "replace")


_WORKERS: dict[str, _Worker] = {}


def _worker(path: str) -> _Worker:
    if path not in _WORKERS:
        _WORKERS[path] = _Worker(path)
    return _WORKERS[path]


def _digest(path: str):
    def run(batches):
        worker = _worker(path)
        for batch in slices(batches, "text", 2 << 20):
            for store in (worker.pieces, worker.ids):
                store.turn()
            n_tokens, ids_sha, text_sha = [], [], []
            for text in batch.column("text").to_pylist():
                joined = ",".join(worker.encode(text or ""))
                n_tokens.append(joined.count(",") + 1 if joined else 0)
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sha.append(hashlib.sha256(worker.decode(joined).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def bpe_digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Encode and decode every whole text; digests of the ids and of the decoded text.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``. Null and empty
    texts have no ids (digests of the empty string); null ids and repeated
    rows are rows like any other; extra columns are ignored. There are no ties:
    the encoding is unique. ``vocab_path`` must be readable on every executor.
    """
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_digest(vocab_path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encode(path: str):
    def run(batches):
        bpe = _worker(path).bpe
        for batch in slices(batches, "text", 2 << 20):
            ids = [bpe.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return run


def encode(docs: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, ids`` of every whole text."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_encode(vocab_path), "doc_id long, ids array<int>")


def _decode(path: str):
    def run(batches):
        bpe = _worker(path).bpe
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return run


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null ids give the empty text."""
    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(vocab_path), "doc_id long, text string")
