"""Mixture-controlled packing by deficit round robin over source queues.

Every source is a queue of tokenized documents. Windows (rounds) of
``window`` tokens are filled in turn: in each one a source earns its quantum,
``window`` times its target proportion, and serves whole documents as long as
it has credit. What it served beyond or below the quantum stays with it as a
deficit for the next windows, so after any number of windows each source is
within one document of its target. The output stream is cut into sequences of
``seq_len`` tokens; only the last one needs padding.

The round in which a document is served follows from its start in its queue
(``start // quantum``), and its place in the stream from prefix sums in the
order (round, source, start). Both are native windows over blocks, so nothing
runs in sequence and deficits carry over partitions by themselves:

* texts are tokenized once, without a shuffle, and written with their
  partition and row number; a queue's order is that of (partition, row);
* starts: a window inside each (source, partition) plus one row for each such
  block, so a source with a third of all rows is split by partition;
* places: a window inside each round (at most about ``window`` rows), and
  prefix sums of round totals in blocks of 1024 rounds;
* the ids are shuffled once, to meet their places.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import block_prefix, only, slices, written
from orderflow.llm.word_store import WordStore, gather, strings
from orderflow.session import ship_package

_STORES: dict[str, WordStore] = {}


def _store(path: str) -> WordStore:
    """Ids of blank-free chunks met lately, one store per Python worker.

    The tokenizer drops white space and never joins text across it, so the ids
    of a text are those of its chunks in turn. New chunks of letters are
    encoded many at a time, as one text, and told apart by the tokens that end
    a word; if a group holds a chunk of several words, its chunks go one by one.
    """
    if path not in only(_STORES):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        vocab, kind = tok.get_vocab(), _width(tok.get_vocab_size())
        closes = np.zeros(max(vocab.values()) + 1, bool)
        closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

        def learn(new: list[str]):
            letters, rest = [], []
            for w in new:
                (letters if w.isalpha() else rest).append(w)
            for k in range(0, len(letters), 1024):
                some = letters[k:k + 1024]
                ids = np.array(tok.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, kind)
                ends = np.flatnonzero(closes[ids]) + 1
                if len(ends) == len(some) and ends[-1] == len(ids):
                    yield some, ids, np.diff(ends, prepend=0)
                else:
                    rest += some
            for k in range(0, len(rest), 4096):
                some = rest[k:k + 4096]
                ids = [np.array(e.ids, kind) for e in tok.encode_batch_fast(some, add_special_tokens=False)]
                yield some, np.concatenate(ids), np.array([len(x) for x in ids])

        _STORES[path] = WordStore(learn, kind)
    return _STORES[path]


def _width(n_ids: int) -> str:
    return "<u2" if n_ids <= 1 << 16 else "<u4"


def _tokenize(path: str, end_id: int):
    def run(batches):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        store, row = _store(path), 0
        unit = np.dtype(store.kind).itemsize
        for batch in slices(batches, "text", 8 << 20):
            store.turn()
            rows = batch.num_rows
            cut = pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), ""))
            words = cut.flatten().dictionary_encode()
            ids, ends = store.runs(store.find(strings(words.dictionary)))
            size, which = np.diff(ends, prepend=0), np.asarray(words.indices)
            ids, ends = gather(ids, (ends - size)[which], size[which])
            n = np.diff(np.concatenate([[0], ends])[np.asarray(cut.offsets) - cut.offsets[0].as_py()]) + 1
            last = np.cumsum(n)  # a document's ids and the end id, one document behind the other
            flat, inside = np.full(len(ids) + rows, end_id, store.kind), np.ones(len(ids) + rows, bool)
            inside[last - 1] = False
            flat[inside] = ids
            places = np.concatenate([[0], last * unit]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("queue"), pa.array(np.arange(row, row + rows)), pa.array(n),
                 pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(places), pa.py_buffer(flat)])],
                ["doc_id", "queue", "row", "n", "ids"])
            row += rows
    return run


def tokenize(docs: DataFrame, vocab_path: str, end_id: int = 1) -> DataFrame:
    """Written table ``part, row, doc_id, queue, n, ids``: ids as packed little-endian integers, ``end_id`` last."""
    ship_package(docs.sparkSession)
    # null and empty sources are different queues
    queue = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"),
                      F.col("text").cast("string").alias("text"))
    out = src.mapInArrow(_tokenize(vocab_path, end_id), "doc_id long, queue string, row long, n long, ids binary")
    return written(out.withColumn("part", F.spark_partition_id()), "tokens")


def places(tokens: DataFrame, window: int = 1 << 17, weights: dict[str, float] | None = None) -> DataFrame:
    """``part, row, place``: each document's first position in the packed stream.

    ``weights`` are target proportions by source; without them a source's
    target is its share of all tokens, so every window mirrors the corpus. A
    source that has no weight keeps its share of tokens; no row is dropped.
    """
    size = tokens.select("part", "row", "queue", "n")
    blocks = size.groupBy("queue", "part").agg(F.sum("n").alias("block_n"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("queue")
    blocks = blocks.withColumn("block_start", F.coalesce(F.sum("block_n").over(earlier), F.lit(0))) \
        .withColumn("queue_n", F.sum("block_n").over(whole))
    total = size.agg(F.sum("n").alias("all_n"))  # one row
    share = F.col("queue_n") / F.col("all_n")
    if weights:
        whole_weight = float(sum(weights.values()))
        for source, w in weights.items():
            share = F.when(F.col("queue") == f"={source}", F.lit(w / whole_weight)).otherwise(share)
    quantum = F.greatest(F.lit(1), F.round(F.lit(window) * share)).cast("long")
    blocks = blocks.crossJoin(F.broadcast(total)).select("queue", "part", "block_start", quantum.alias("quantum"))
    inside = Window.partitionBy("queue", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    started = size.withColumn("in_block", F.coalesce(F.sum("n").over(inside), F.lit(0))) \
        .join(blocks, ["queue", "part"]) \
        .withColumn("start", F.col("block_start") + F.col("in_block")) \
        .withColumn("round", F.floor(F.col("start") / F.col("quantum")).cast("long")) \
        .select("part", "row", "queue", "n", "start", "round")
    started = written(started, "starts")
    rounds = started.groupBy("round").agg(F.sum("n").alias("round_n")) \
        .withColumn("block", F.floor(F.col("round") / 1024).cast("long"))
    base = block_prefix(rounds, "block", {"round_n": "base"})
    in_rounds = Window.partitionBy("block").orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    rounds = rounds.join(base, "block").select(
        "round", (F.col("base") + F.coalesce(F.sum("round_n").over(in_rounds), F.lit(0))).alias("round_place"))
    served = Window.partitionBy("round").orderBy("queue", "start").rowsBetween(Window.unboundedPreceding, -1)
    return started.withColumn("in_round", F.coalesce(F.sum("n").over(served), F.lit(0))) \
        .join(rounds, "round") \
        .select("part", "row", (F.col("round_place") + F.col("in_round")).cast("long").alias("place"))


def _cut(width: str, seq_len: int, keep_ids: bool):
    def run(batches):
        unit = np.dtype(width).itemsize
        for batch in slices(batches, "ids"):
            cols: list[list] = [[] for _ in range(8)]
            for doc, place, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "place", "n", "ids"))):
                wide = raw if unit == 4 else np.frombuffer(raw, width).astype("<u4").tobytes()
                at = 0
                while at < n:
                    seq, offset = divmod(place + at, seq_len)
                    k = min(seq_len - offset, n - at)
                    piece = wide[4 * at:4 * (at + k)]
                    for c, v in zip(cols, (doc, at, k, zlib.crc32(piece), n, seq, offset,
                                           np.frombuffer(piece, "<i4") if keep_ids else None)):
                        c.append(v)
                    at += k
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                arrays.append(pa.array(cols[7], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
    return run


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocab_path: str, seq_len: int = 2048, window: int = 1 << 17,
         weights: dict[str, float] | None = None, end_id: int = 1, keep_ids: bool = True) -> DataFrame:
    """Pack every document into sequences of ``seq_len`` tokens.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, if asked for, ``ids``. Each token lies in one
    piece; a sequence is gapless from offset 0. Null and empty texts are the
    end id alone; a null source is a queue of its own; null ids and repeated
    rows are packed like any other row; ties don't arise (queue order is that
    of partition and row); an empty table gives no rows; extra columns are
    ignored. A text longer than a sequence spans several.
    """
    import json
    with open(vocab_path, encoding="utf-8") as f:  # a bounded vocabulary file
        spec = json.load(f)
    n_ids = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
    tokens = tokenize(docs, vocab_path, end_id)
    where = places(tokens, window, weights)
    wide = tokens.select("part", "row", "doc_id", "n", "ids").join(where.hint("shuffle_hash"), ["part", "row"])
    return wide.select("doc_id", "place", "n", "ids").mapInArrow(
        _cut(_width(n_ids), seq_len, keep_ids), PIECES + (", ids array<int>" if keep_ids else ""))
