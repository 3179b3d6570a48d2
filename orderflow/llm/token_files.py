"""Token-id tables in ORC: ids in ascending document order, pruned reads by document or by token position.

A table is two ORC folders. ``tokens`` has one row per document: its part (the
write task), its place in the part's token stream and its ids. ORC stores the
whole numbers in run-length encoded stripes, keeps minima and maxima of every
``stride`` rows and, for ``doc_id``, a Bloom filter of each such row group, so
a look-up reads the row groups that may hold the document and no others.
``parts`` has one row per part: document and token counts, first and last
document, and the tokens of all parts before it.

Scale. The texts are shuffled once, by ranges of ``doc_id`` (with the text's
hash and the row's place behind it, so that repeated and null ids spread over
ranges as well), and encoded inside the sorted ranges. Only the one row per
part is ever summed up in one place. A reader turns stripes into tasks; a
document's position in the whole stream is its part's start plus its own.
"""

from __future__ import annotations

import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm.bpe import DOUBLE, chunks
from orderflow.llm.common import slices
from orderflow.llm.word_store import WordStore, gather, strings
from orderflow.session import scratch_path, ship_package

#: ASCII signs but the apostrophe, with which a pre-token may begin behind a letter.
SIGNS = string.punctuation.replace("'", "")
#: A line end that touches another white space: it is no pre-token of its own then.
BLANK_LINE = re.compile(r"\n(?:(?=\s)|(?<=\s\n))")

TOKENS = "part int, doc_id long, at long, n_tokens long, ids array<int>"


class _Encoder:
    """The tokenizers library's ids of whole texts; words met lately are looked up.

    A text is cut at spaces that a non-blank follows, which no pre-token of a
    byte-level tokenizer crosses, at line ends between non-blanks, which are
    pre-tokens of their own, and behind a word's last letter or digit if only
    ASCII signs follow. What is new is encoded many words at a time, as one
    text, and told apart by the tokens that begin with a space. A piece that
    doesn't follow a space is marked by a leading tab; such pieces are told
    apart by line ends.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer, pre_tokenizers
        self.lib = lib = Tokenizer.from_file(path)
        lib.no_truncation()
        lib.no_padding()
        if not isinstance(lib.pre_tokenizer, pre_tokenizers.ByteLevel) or lib.normalizer is not None:
            raise ValueError("a byte-level tokenizer without a normalizer is needed")
        vocab = lib.get_vocab()
        self.kind = "<u2" if max(vocab.values()) < 1 << 16 else "<u4"
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for t, i in vocab.items() if t[0] == "Ġ"]] = True
        self.line_end = vocab.get("Ċ", -1)
        added = sorted((t.content for t in lib.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.store = WordStore(self._learn, self.kind, limit)

    def _alone(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]):
        plain, heads, rest = [], [], []
        for w in new:
            blank_free = len(w.split()) == 1
            if blank_free and not w[0].isspace() and not w[-1].isspace():
                plain.append(w)
            elif blank_free and w[0] == "\t" and not w[1].isspace() and not w[-1].isspace():
                heads.append(w)
            else:
                rest.append(w)
        for k in range(0, len(plain), 1024):
            some = plain[k:k + 1024]
            ids = self._alone([" " + " ".join(some)])[0]
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(some):
                yield some, ids, np.diff(cuts, append=len(ids))
            else:
                rest += some
        for k in range(0, len(heads), 1024):
            some = heads[k:k + 1024]
            ids = self._alone(["\n".join([w[1:] for w in some])])[0]
            seams = np.flatnonzero(ids == self.line_end)
            if len(seams) == len(some) - 1:
                yield some, np.delete(ids, seams), np.diff(seams, prepend=-1, append=len(ids)) - 1
            else:
                rest += some
        if rest:
            ids = self._alone([w[1:] if w[:1] == "\t" else " " + w for w in rest])
            yield rest, np.concatenate(ids), np.array([len(x) for x in ids])

    def _words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The distinct words' ids one behind the other, and where each word's end; signs at the end are words apart."""
        trimmed = pc.utf8_rtrim(distinct, characters=SIGNS)
        shorter = np.flatnonzero(np.asarray(pc.binary_length(trimmed)) < np.asarray(pc.binary_length(distinct)))
        words, tails = strings(trimmed), ["\t"] * len(distinct)
        for k, w in zip(shorter.tolist(), strings(distinct.take(pa.array(shorter))), strict=True):
            stem = words[k]
            if stem and stem[-1] < "\u0250" and stem[-1].isalnum():
                tails[k] = "\t" + w[len(stem):]
            else:
                words[k] = w
        flat, ends = self.store.runs(np.stack([self.store.find(words), self.store.find(tails)], axis=1).ravel())
        return flat, ends[1::2]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text: words are made distinct in Arrow, looked up once each, and their ids gathered by offsets."""
        self.store.turn()
        out: list = [None] * len(texts)
        lines, simple, blanks, lists = [], [], [], []
        for k, t in enumerate(texts):
            if self.added and self.added.search(t):
                out[k] = self._alone([t])[0]  # its special tokens are the library's to find
            elif DOUBLE.search(t) or t[-1:] == " ":
                blanks.append(k)
                c = chunks(t)
                lists.append(["\t" + c[0], *c[1:]])
            elif BLANK_LINE.search(t):
                simple.append(k)
            else:
                lines.append(k)
        single = pc.replace_substring(pa.array(["\t" + texts[k] for k in lines], pa.string()), "\n", " \t\n \t")
        cut = pc.split_pattern(pa.concat_arrays([single, pa.array(["\t" + texts[k] for k in simple], pa.string())]), " ")
        words = pa.concat_arrays([cut.flatten(), pa.array([w for c in lists for w in c], pa.string())]).dictionary_encode()
        flat, ends = self._words(words.dictionary)
        which = np.asarray(words.indices)
        size = np.diff(ends, prepend=0)
        flat, ends = gather(flat, (ends - size)[which], size[which])
        count = np.concatenate([np.diff(np.asarray(cut.offsets)), np.array([len(c) for c in lists], np.int64)])
        borders = np.concatenate([[0], ends])[np.cumsum(count)] if len(ends) else []
        at = 0
        for k, end in zip(lines + simple + blanks, map(int, borders), strict=True):
            out[k], at = flat[at:end], end
        return out


_ENCODERS: dict[str, _Encoder] = {}


def _encode_part(vocab_path: str, end_id: int):
    def run(batches):
        import os

        from pyspark import TaskContext
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if vocab_path not in _ENCODERS:
            _ENCODERS[vocab_path] = _Encoder(vocab_path)
        enc, part, at = _ENCODERS[vocab_path], TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", 4 << 20):
            rows = enc.encode_all([t or "" for t in batch.column("text").to_pylist()])
            n = np.array([len(x) + 1 for x in rows], np.int64)
            ends = np.cumsum(n)
            ids = np.full(int(ends[-1]) if len(n) else 0, end_id, np.int32)
            for x, end in zip(rows, ends.tolist(), strict=True):
                ids[end - 1 - len(x):end - 1] = x
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), batch.column("doc_id"), pa.array(at + ends - n), pa.array(n), lists],
                ["part", "doc_id", "at", "n_tokens", "ids"])
            at += int(ends[-1]) if len(n) else 0
    return run


def write_tokens(docs: DataFrame, path: str, vocab_path: str, end_id: int = 2, files: int | None = None,
                 stripe_bytes: int = 64 << 20, stride: int = 2000, fpp: float = 0.01) -> None:
    """Encode every whole text and write the token table at ``path`` (it must not exist yet).

    Each document's ids are followed by ``end_id``; null and empty texts are
    that id alone. Documents stand in ascending order of ``doc_id``, null ids
    first, rows with equal ids in the order of their texts' hashes; repeated
    rows are written as often as they occur. An empty table gives an empty
    token table. Columns other than ``doc_id`` and ``text`` are ignored. The
    number of files follows the data's size (AQE) unless ``files`` is given.
    """
    spark = docs.sparkSession
    ship_package(spark)
    key = ["doc_id", "__hash", "__row"]
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("__hash", F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id())
    ranges = src.repartitionByRange(files, *key) if files else src.repartitionByRange(*key)
    rows = ranges.sortWithinPartitions(*key).select("doc_id", "text").mapInArrow(_encode_part(vocab_path, end_id), TOKENS)
    rows.write.option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", stride) \
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", fpp) \
        .option("compression", "lz4").orc(f"{path}/tokens")
    parts = spark.read.schema(TOKENS).orc(f"{path}/tokens").groupBy("part").agg(
        F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
        F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts.withColumn("part_start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).coalesce(1).write.orc(f"{path}/parts")


PARTS = "part int, documents long, first_doc long, last_doc long, tokens long, part_start long"


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """One row per part: ``part, documents, first_doc, last_doc, tokens, part_start``."""
    return spark.read.schema(PARTS).orc(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document; filters on ``doc_id`` reach the ORC scan.

    ``start`` counts the ids of all documents before this one. What is
    broadcast has one row per written part.
    """
    rows = spark.read.schema(TOKENS).orc(f"{path}/tokens")
    starts = read_parts(spark, path).select("part", "part_start")
    return rows.join(F.broadcast(starts), "part") \
        .select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids")


def find_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of the given documents: row groups whose Bloom filter or range excludes all of them are skipped."""
    return read_tokens(spark, path).where(F.col("doc_id").isin([int(i) for i in doc_ids]))


def tokens_between(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Documents with ids at positions ``start <= p < stop`` of the whole stream, and the ids in that window.

    The part list gives the first and the last part; row groups of other parts
    are skipped by their minima and maxima. Returns ``doc_id, start, n_tokens,
    ids`` with ``start`` and ``ids`` cut to the window; an empty window gives no rows.
    """
    inside = read_parts(spark, path).where((F.col("part_start") < stop) & (F.col("part_start") + F.col("tokens") > start))
    first, last = inside.agg(F.min("part"), F.max("part")).first()
    rows = spark.read.schema(TOKENS).orc(f"{path}/tokens")
    rows = rows.where(F.col("part").between(first, last)) if first is not None else rows.where(F.lit(False))
    begin = F.col("part_start") + F.col("at")
    low, high = F.greatest(begin, F.lit(start)), F.least(begin + F.col("n_tokens"), F.lit(stop))
    return rows.join(F.broadcast(read_parts(spark, path).select("part", "part_start")), "part").where(low < high).select(
        "doc_id", low.alias("start"), (high - low).alias("n_tokens"),
        F.slice("ids", (low - begin + 1).cast("int"), (high - low).cast("int")).alias("ids"))


def _checksums(batches):
    for batch in batches:
        lists = batch.column("ids")
        flat, ends = np.asarray(lists.flatten(), dtype="<u4"), np.asarray(lists.offsets)
        ends = ends - ends[0]
        raw = memoryview(flat).cast("B")
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"),
                                          pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: crc32 of each row's ids as little-endian 32-bit integers."""
    ship_package(tokens.sparkSession)
    return tokens.select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), "ids") \
        .mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_round_trip(docs: DataFrame, vocab_path: str, end_id: int = 2) -> DataFrame:
    """Write the token table of ``docs`` to the shared folder, read it back and sum each document up."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, vocab_path, end_id)
    return token_checksums(read_tokens(docs.sparkSession, path))
