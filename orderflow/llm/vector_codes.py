"""Vector codes: product quantization in whole numbers, searched in the Walsh-Hadamard domain.

Vectors are cut into parts, each part has a codebook of a few entries, and a
code names the nearest entry of every part. All arithmetic is on integers:
components are floor(scale * x), means are floor(sum / count).

* Each part is zero-padded to a power of two m and put through the
  Walsh-Hadamard transform, once, when the vectors are staged. The transform
  multiplies squared distances by exactly m, so distances are compared as
  scaled whole numbers; a sum of transforms is the transform of the sum, so the
  codebook's means come from sums of staged rows as well.
* Coordinates stand in order of sequency (number of sign changes), where smooth
  parts have their energy first. The search adds squared differences block by
  block. The entry that leads after the first block gives each vector a bound,
  its full distance; an entry whose partial sum is above the bound can't be
  nearest and leaves the search. Equal sums stay, so ties go to the lower index.

Scale. Vectors are never shuffled: a round reads the staged table and sends one
row per (part, entry, coordinate) and task, summed up map-side. The codebooks
(parts x entries x part length numbers) are all that passes the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.common import written
from orderflow.session import ship_package

#: Scaled components beyond this are set to it, so that every step stays exact.
LIMIT = 1 << 53
ROWS = 8192  # rows that a task works on at a time


def power_of_two(n: int) -> int:
    m = 1
    while m < n:
        m *= 2
    return m


def sequency_order(m: int) -> np.ndarray:
    """Rows of the natural-order Hadamard matrix, fewest sign changes first."""
    h = np.ones((1, 1), np.int64)
    while len(h) < m:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Natural-order transform of the last axis (a power of two long), by sums and differences."""
    m, h = x.shape[-1], 1
    while h < m:
        y = x.reshape(*x.shape[:-1], m // (2 * h), 2, h)
        a, b = y[..., 0, :], y[..., 1, :]
        x = np.stack([a + b, a - b], axis=-2).reshape(x.shape)
        h *= 2
    return x


def transform_parts(x: np.ndarray) -> np.ndarray:
    """Parts (last axis) zero-padded, transformed, in order of sequency."""
    m = power_of_two(x.shape[-1])
    if m > x.shape[-1]:
        x = np.concatenate([x, np.zeros((*x.shape[:-1], m - x.shape[-1]), x.dtype)], axis=-1)
    return walsh_hadamard(x)[..., sequency_order(m)]


def restore_sums(totals: np.ndarray, length: int) -> np.ndarray:
    """The sums of the original components, from summed transforms (exact: the inverse divides by m)."""
    m = totals.shape[-1]
    natural = np.empty_like(totals)
    natural[..., sequency_order(m)] = totals
    return walsh_hadamard(natural)[..., :length] // m


def _exact(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if squared distances fit there, as Python integers otherwise."""
    top = max(int(np.abs(a).max()) if a.size else 0 for a in (x, c))
    if 4 * top * top * x.shape[-1] < 1 << 62:
        return x.astype(np.int64, copy=False), c.astype(np.int64)
    return x.astype(object), c.astype(object)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and scaled squared distance of the nearest row of ``c`` for each row of ``x``, and pairs left after block one.

    Rows are transforms in order of sequency. Ties go to the lower index.
    """
    x, c = _exact(x, c)
    m, b = x.shape[1], max(1, x.shape[1] // 4)
    head = x[:, None, :b] - c[None, :, :b]
    partial = (head * head).sum(axis=2)
    lead = partial.argmin(axis=1)
    rest = x[:, b:] - c[lead, b:]
    bound = np.take_along_axis(partial, lead[:, None], 1)[:, 0] + (rest * rest).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    total, pairs = partial[row, entry], len(row)
    while b < m:
        diff = x[row, b:2 * b] - c[entry, b:2 * b]
        total = total + (diff * diff).sum(axis=1)
        stay = total <= bound[row]
        row, entry, total, b = row[stay], entry[stay], total[stay], 2 * b
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))  # every row keeps its leader at least
    best = np.minimum.reduceat(total, first)
    hits = np.flatnonzero(total == best[row])
    _, at = np.unique(row[hits], return_index=True)
    return entry[hits[at]], best, pairs


# --- staging -----------------------------------------------------------------------------------------

def _scaled(batch, scale: int):
    """Kept row numbers, lengths and scaled components (one flat array) of a batch of float lists."""
    lists = batch.column("vec")
    flat, offsets = lists.flatten(), np.asarray(lists.offsets)
    offsets = offsets - offsets[0]
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    good = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    lengths = np.diff(offsets)
    kept = np.flatnonzero((good[offsets[1:]] == good[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False))
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(np.where(np.isfinite(values), values, 0) * scale), -float(LIMIT), float(LIMIT))
    return kept, lengths, offsets, whole.astype(np.int64)


def _stage(parts: int, scale: int, width: int | None):
    def run(batches):
        for batch in batches:
            kept, lengths, offsets, whole = _scaled(batch, scale)
            packed = [b""] * len(kept)
            for size in np.unique(lengths[kept]):
                at = np.flatnonzero(lengths[kept] == size)
                length = -(-max(int(size), width or 0, 1) // parts)
                x = np.zeros((len(at), parts * length), np.int64)
                x[:, :size] = whole[offsets[kept[at]][:, None] + np.arange(size)]
                y = transform_parts(x.reshape(len(at), parts, length)).reshape(len(at), -1)
                y = y.astype("<i4" if np.abs(y).max(initial=0) < 1 << 31 else "<i8")
                for k, row in zip(at.tolist(), y, strict=True):
                    packed[k] = row.tobytes()
            out = batch.take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([out.column("vec_id"), out.column("label"), pa.array(lengths[kept], pa.int32()),
                                              pa.array(packed, pa.binary())], ["vec_id", "label", "width", "packed"])
    return run


@dataclass
class Staged:
    """Vectors kept, as transforms: ``rows`` (``vec_id, label, width, packed``) and the length of a part."""
    rows: DataFrame
    parts: int
    length: int


def stage(vectors: DataFrame, parts: int = 8, scale: int = 4096) -> Staged:
    """Scaled, cut and transformed vectors as a written table.

    ``vectors`` has ``vec_id, vec, label``. Rows whose vector is null, or has a
    null or non-finite component, are dropped. Vectors shorter than the longest
    kept one (its length rounded up to a multiple of ``parts``) count as
    followed by zeros. Components are floor(scale * x), at most 2^53 in
    magnitude. Null ids, repeated rows and null labels are kept.
    """
    ship_package(vectors.sparkSession)
    label = vectors.schema["label"].dataType.simpleString()
    floats = vectors.schema["vec"].dataType.simpleString() in ("array<float>", "array<double>")
    vec = F.col("vec") if floats else F.col("vec").cast("array<double>").alias("vec")
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec, "label")
    schema = f"vec_id long, label {label}, width int, packed binary"
    rows = written(src.mapInArrow(_stage(parts, scale, None), schema), "vectors")
    low, high = rows.agg(F.min("width"), F.max("width")).first()
    if low != high:  # vectors of several lengths: once more, all as long as the longest
        rows = written(src.mapInArrow(_stage(parts, scale, high), schema), "vectors")
    return Staged(rows, parts, -(-max(high or 0, 1) // parts))


def _unpack(batches, parts: int, m: int):
    """Transforms (rows, parts, m) and the batch, at most ROWS rows at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            some = batch.slice(lo, ROWS)
            raw = some.column("packed").to_pylist()
            size = 4 * parts * m
            if all(len(r) == size for r in raw):
                x = np.frombuffer(b"".join(raw), "<i4").astype(np.int64)
            else:
                x = np.concatenate([np.frombuffer(r, "<i4" if len(r) == size else "<i8").astype(np.int64) for r in raw])
            yield some, x.reshape(len(raw), parts, m)


# --- codebooks ---------------------------------------------------------------------------------------

Books = list  # [part][entry][component], Python integers


def _transformed(books: Books) -> np.ndarray:
    return transform_parts(np.array(books, dtype=object))


def _sums(books: Books):
    c = _transformed(books)
    parts, k, m = c.shape

    def run(batches):
        total, count = np.zeros((parts, k, m), object), np.zeros((parts, k), np.int64)
        for _, x in _unpack(batches, parts, m):
            safe = (int(np.abs(x).max(initial=0)) + 1) * len(x) < 1 << 62
            for p in range(parts):
                code, _, _ = nearest(x[:, p], c[p])
                part = np.zeros((k, m), np.int64 if safe else object)
                np.add.at(part, code, x[:, p] if safe else x[:, p].astype(object))
                total[p] += part
                count[p] += np.bincount(code, minlength=k)
        used = np.argwhere(count > 0)
        cols = [[], [], [], [], []]
        for p, e in used.tolist():
            for i in range(m):
                for col, v in zip(cols, (p, e, i, str(total[p, e, i]), int(count[p, e])), strict=True):
                    col.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
             pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())], ["part", "entry", "place", "total", "n"])
    return run


def train_codebooks(staged: Staged, entries: int = 16, rounds: int = 6) -> Books:
    """Codebooks after ``rounds`` of assignment and integer means.

    They start as the parts of the ``entries`` smallest vec_ids (fewer if there
    are fewer vectors; null ids last; equal ids by their components). An entry
    that no part uses stays as it is. No vectors give no entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    m = power_of_two(staged.length)
    first = staged.rows.orderBy(F.col("vec_id").asc_nulls_last(), "packed").limit(entries).select("packed").toArrow()
    if not first.num_rows:
        return [[] for _ in range(staged.parts)]
    start = np.concatenate([x for b in first.to_batches() for _, x in _unpack([b], staged.parts, m)]).astype(object)
    books = restore_sums(start, staged.length).transpose(1, 0, 2).tolist()
    for _ in range(rounds):
        sums = staged.rows.select("packed").mapInArrow(_sums(books), "part int, entry int, place int, total string, n long") \
            .groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        found: dict[tuple[int, int], dict] = {}
        for r in sums.toArrow().to_pylist():  # parts x entries x m rows, in one job
            found.setdefault((r["part"], r["entry"]), {"n": r["n"]})[r["place"]] = int(r["total"])
        for (p, e), got in found.items():
            whole = restore_sums(np.array([got[i] for i in range(m)], object), staged.length)
            books[p][e] = [int(s) // got["n"] for s in whole]
    return books


def codebooks_digest(books: Books) -> str:
    """sha256 of all entries' components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for part in books for entry in part for v in entry).encode()).hexdigest()


def codebook_table(spark: SparkSession, books: Books) -> DataFrame:
    """``part, entry, components`` of every codebook entry."""
    rows = [(p, e, [int(v) for v in vs]) for p, part in enumerate(books) for e, vs in enumerate(part)]
    return spark.createDataFrame(rows, "part int, entry int, components array<long>")


# --- codes -------------------------------------------------------------------------------------------

def _codes(books: Books):
    c = _transformed(books)
    parts, _, m = c.shape

    def run(batches):
        for some, x in _unpack(batches, parts, m):
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), object)
            for p in range(parts):
                code[:, p], dist, _ = nearest(x[:, p], c[p])
                error += dist
            digits = code.tobytes().hex()
            width = 2 * parts
            error = [v if v < 1 << 63 else None for v in (error // m).tolist()]
            yield pa.RecordBatch.from_arrays(
                [some.column("vec_id"), some.column("label"),
                 pa.array([digits[width * i:width * (i + 1)] for i in range(len(x))], pa.string()),
                 pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def encode_vectors(staged: Staged, books: Books) -> DataFrame:
    """``vec_id, label, code, error`` of every staged vector.

    ``code`` holds the entries' indexes in part order, two hexadecimal digits
    each; ``error`` is the squared distance to them summed over the parts (null
    if it doesn't fit in a long).
    """
    label = staged.rows.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label}, code string, error long"
    if not books[0]:
        return staged.rows.sparkSession.createDataFrame([], schema)
    return staged.rows.select("vec_id", "label", "packed").mapInArrow(_codes(books), schema)


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of ``vec_id, vec, label``.

    ``label_error`` is the error summed over the rows with an equal label, null
    labels together (null if it or one of the errors doesn't fit in a long). Rows and edge cases are
    those of :func:`stage`; ties go to the entry with the lower index.
    """
    staged = stage(vectors, parts, scale)
    books = train_codebooks(staged, entries, rounds)
    coded = written(encode_vectors(staged, books), "codes")
    sums = coded.groupBy(F.col("label").alias("__label")).agg(
        F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)"))).alias("__sum"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", F.col("__sum").try_cast("long").alias("label_error"),
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
