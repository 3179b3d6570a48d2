"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.session import scratch_path, ship_package, write_scratch

#: A word: code points other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    return write_scratch(df, scratch_path(df.sparkSession, f"llm-{name}"))


def fitted(sample: DataFrame, fit: Callable[[pa.Table], object]):
    """``fit(table)`` of a bounded sample, run in one task, which alone holds it; the driver gets the model.

    ``fit`` must not depend on the order of the rows.
    """
    def run(batches):
        held = list(batches)
        if held:
            model = pickle.dumps(fit(pa.Table.from_batches(held)))
            held.clear()
            pa.default_memory_pool().release_unused()  # the worker goes on to other tasks
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    ship_package(sample.sparkSession)
    got = sample.repartition(1).mapInArrow(run, "model binary").collect()  # one row; none if there are no rows
    return pickle.loads(got[0].model) if got else fit(sample.limit(0).toArrow())


def sieve(keys: DataFrame, key: str, most: int = 1 << 26) -> Callable[[str], Column]:
    """A test of a column: true for every value that ``key`` has in the written table ``keys``, and for few others.

    A Bloom filter of about 16 bits a key and at most ``most`` bits, which alone
    passes the driver; beyond that it lets more other values pass. What passes
    must still meet ``keys`` in a join, but the rest need not be shuffled for it.
    """
    spark = keys.sparkSession
    ship_package(spark)
    bits = min(most, 1 << max(16, (16 * keys.count()).bit_length()))
    h = F.xxhash64(key)
    at = keys.select(F.explode(F.array(*[x.bitwiseAND(F.lit(bits - 1)) for x in (h, F.shiftrightunsigned(h, 32))])).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set")).toArrow()  # at most bits / 64 rows
    table = np.zeros(bits // 64, np.uint64)
    table[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def passes(hashes: pa.Array) -> pa.Array:
        seen, h, out = sent.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64), True
        for at in (h, h >> np.uint64(32)):
            at = at & np.uint64(len(seen) * 64 - 1)
            out = out & (seen[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) > 0)
        return pa.array(out)

    return lambda column: passes(F.xxhash64(column))


def held_out(doc_id) -> Column:
    """The fold that training never reads: crc32 of the id's decimal text, mod 5, is 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def block_prefix(df: DataFrame, block: str, sums: dict[str, str]) -> DataFrame:
    """Exclusive prefix sums over whole blocks, one row per block.

    ``block`` is an integer column; ``sums`` maps a value column to the name of
    its prefix. The result has one row per block, so its size is the number of
    blocks, not of rows.
    """
    totals = df.groupBy(block).agg(*[F.sum(v).alias(p) for v, p in sums.items()])
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(block, *[F.coalesce(F.sum(p).over(before), F.lit(0)).cast("long").alias(p)
                                  for p in sums.values()])


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


_KEPT: list[dict] = []


def only(stores: dict) -> dict:
    """``stores`` of this Python worker; what other operators left in it is emptied, so a job's stages don't add up."""
    for other in _KEPT:
        if other is not stores and other:
            other.clear()
            pa.default_memory_pool().release_unused()
    if not any(other is stores for other in _KEPT):
        _KEPT.append(stores)
    return stores


class RecentCache(dict):
    """word -> value for the words met lately, in bounded memory.

    Two generations: when this one is full it becomes the old one, and words
    still in use are taken over at their next look-up. ``fill`` computes the
    values of a list of new words. Look up one by one with ``cache[word]``, or
    announce the words of a batch with :meth:`of`.
    """

    def __init__(self, fill: Callable[[list], list], limit: int = 200_000):
        super().__init__()
        self.fill, self.limit = fill, limit
        self.old: dict = {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.fill([word])[0]
        self[word] = value
        return value

    def turn(self) -> None:
        """Between batches: start a new generation if this one is full."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def of(self, words: set) -> Callable:
        """A look-up function that knows all of ``words``, filled in one call."""
        self.turn()
        old = self.old
        new = []
        for w in words.difference(self):
            v = old.get(w)
            if v is None:
                new.append(w)
            else:
                self[w] = v
        if new:
            self.update(zip(new, self.fill(new), strict=True))
        return self.__getitem__
