"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

A text's tokens are runs of letters and digits, and runs of other visible
characters; a token equal to the one before it is a repetition. Features are
the hashed single tokens, token pairs and triples of token shapes (lower case,
capitalised, upper case, digits, symbols, repetition), each with log(1 +
count), scaled to length one. Weights are learned with follow-the-regularised-
leader updates, one document at a time, on a bounded sample of labelled rows;
scoring is a sparse dot product per document, without a shuffle.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import RecentCache, fitted, held_out, only, slices
from orderflow.session import ship_package

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_REPEAT = 6
_CACHE: dict = {}


def _shape(token: str) -> int:
    if token.isdigit():
        return 3
    if not token[0].isalnum():
        return 4 if len(token) == 1 else 5
    if token.isupper():
        return 2
    return 1 if token[0].isupper() else 0


def _codes() -> RecentCache:
    """token -> hash and shape in one integer, one store per Python worker."""
    if "codes" not in only(_CACHE):
        _CACHE["codes"] = RecentCache(lambda new: [crc32(t.encode("utf-8", "replace")) << 3 | _shape(t) for t in new], limit=300_000)
    return _CACHE["codes"]


def features(tokens: list[str], of, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one text's features; the values have length one."""
    mask = np.uint64((1 << bits) - 1)
    code = np.fromiter(map(of, tokens), np.uint64, len(tokens))
    word, shape = code >> np.uint64(3), code & np.uint64(7)
    if len(tokens) > 1:
        shape[1:][word[1:] == word[:-1]] = _REPEAT
    mix = np.uint64(0x9E3779B97F4A7C15)
    spread = lambda x: (x * mix) >> np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        parts = [spread(word + np.uint64(1)), spread(word[1:] * np.uint64(31) + word[:-1] + np.uint64(1 << 40))]
        three = shape[:-2] * np.uint64(64) + shape[1:-1] * np.uint64(8) + shape[2:]
        parts.append(spread(three + np.uint64(3 << 50)))
        parts.append(spread(shape + np.uint64(5 << 50)))
    index, count = np.unique(np.concatenate(parts) & mask, return_counts=True)
    value = np.log1p(count)
    return index.astype(np.int64), value / max(np.sqrt((value ** 2).sum()), 1e-12)


def _featurize(bits: int):
    def run(batches):
        codes = _codes()
        for batch in slices(batches, "text"):
            tokens = [_TOKEN.findall(t or "") for t in batch.column("text").to_pylist()]
            of = codes.of(set().union(*tokens))
            rows = [features(t, of, bits) for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))], ["label", "index", "value"])
    return run


def ftrl(rows, bits: int, epochs: int | None = None, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
         l2: float = 1.0) -> np.ndarray:
    """Weights (the last one is the intercept's) from (label, index, value) rows by FTRL-proximal updates.

    Without ``epochs``, as many passes (4 to 40) as make 30,000 updates.
    """
    epochs = epochs or min(40, max(4, -(-30_000 // len(rows))))
    size = (1 << bits) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            label, index, value = rows[k]
            index, value = np.append(index, size - 1), np.append(value, 1.0)
            zi, ni = z[index], n[index]
            wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(wi @ value, -35, 35)))
            g = (p - label) * value
            z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * wi
            n[index] = ni + g * g
    live = np.abs(z) > l1
    w[live] = -(z[live] - np.sign(z[live]) * l1) / ((beta + np.sqrt(n[live])) / alpha + l2)
    return w


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 12_000, bits: int = 20) -> np.ndarray:
    """Fit on labelled rows outside the held-out fold.

    ``sample_rows`` bounds the sample (labels in the order of their id's hash);
    its texts alone meet the documents, by a broadcast of that many ids, and
    one task fits their features; the driver gets the weights. The rows are
    ordered by all they hold, so the weights don't depend on partitions or
    retries. Equal texts count once for each label they bear. Rows with null
    label are ignored. Without labels of both kinds the weights give a constant
    score: the share of label 1, or one half without labels.
    """
    ship_package(docs.sparkSession)
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out("doc_id")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    sample = usable.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(sample), "doc_id").select("text", "label") \
        .distinct().mapInArrow(_featurize(bits), "label int, index array<int>, value array<float>")
    return fitted(chosen, lambda got: _fit(got, bits))


def _fit(got: pa.Table, bits: int) -> np.ndarray:
    rows = sorted(((y, i, v) for b in got.to_batches() for y, i, v in zip(
        b.column("label").to_pylist(), _lists(b.column("index")), _lists(b.column("value")))),
        key=lambda r: (len(r[1]), r[0], r[1].tobytes(), r[2].tobytes()))
    ones = sum(r[0] for r in rows)
    if not 0 < ones < len(rows):
        w = np.zeros((1 << bits) + 1)
        w[-1] = 0.0 if not rows else (35.0 if ones else -35.0)
        return w
    return ftrl(rows, bits)


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    flat, at = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def _score(weights, bits: int, cut: float):
    def run(batches):
        w, codes = weights.value, _codes()
        for batch in slices(batches, "text"):
            tokens = [_TOKEN.findall(t or "") for t in batch.column("text").to_pylist()]
            of = codes.of(set().union(*tokens))
            total = np.array([w[i] @ v for i, v in (features(t, of, bits) for t in tokens)]) + w[-1]
            score = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                 pa.array((score >= cut).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, weights: np.ndarray, bits: int = 20, cut: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Null and empty texts get the intercept's score; null ids count as not held
    out; repeated rows are rows like any other; a score equal to ``cut`` is
    predicted 1; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(weights)  # a fixed 2**bits + 1 numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"),
                       F.col("text").cast("string").alias("text")) \
        .mapInArrow(_score(sent, bits, cut), "doc_id long, held_out boolean, score double, predicted int")


def _keep(weights, bits: int, cut: float):
    def run(batches):
        w, codes = weights.value, _codes()
        for batch in slices(batches, "text"):
            tokens = [_TOKEN.findall(t or "") for t in batch.column("text").to_pylist()]
            of = codes.of(set().union(*tokens))
            total = np.array([w[i] @ v for i, v in (features(t, of, bits) for t in tokens)]) + w[-1]
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))) >= cut))
    return run


def keep_good(docs: DataFrame, weights: np.ndarray, bits: int = 20, cut: float = 0.3) -> DataFrame:
    """``docs``, all columns, without the rows that score less than ``cut``."""
    spark = docs.sparkSession
    ship_package(spark)
    return docs.mapInArrow(_keep(spark.sparkContext.broadcast(weights), bits, cut), docs.schema)


def classify_quality(docs: DataFrame, labels: DataFrame, cut: float = 0.3, sample_rows: int = 12_000) -> DataFrame:
    """Train on ``labels`` and score ``docs``; see :func:`train` and :func:`score`."""
    return score(docs, train(docs, labels, "quality", sample_rows), cut=cut)
