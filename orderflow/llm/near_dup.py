"""N-gram Jaccard join with count vectors in an R-tree.

Documents link when the Jaccard similarity of their sets of hashed word
n-grams reaches a threshold; the result is each document's connected component.

1. Every whole text becomes a set of 64-bit n-gram hashes (tokens). Equal sets
   are one class, so exact copies are one row from here on. Tokens are hashed
   into groups; a class's counts per group are its point.
2. Sets that link share one of their first tokens in any order that all sets
   agree on: a set of n tokens needs only n - ceil(t * n) + 1 of them. The order
   is by a fixed-size sketch of the frequencies of all tokens, rarest first, so
   that passages which many documents share hardly ever serve as keys. A key
   holds for one band of sizes; a set sends keys for its own band and, if a
   smaller partner can lie there, for the one below.
3. Classes with a common key are a bucket. The overlap of two sets is at most
   the sum of the smaller of their coordinates, of a set and a box at most that
   with the box's upper corner: an R-tree over a bucket's points passes over
   subtrees and points that can't reach the needed overlap. A coordinate stands
   for a few tokens only, or else sets that share a passage would pass the bound
   and chain unrelated ones into clusters that grow with the corpus. A bucket of m
   classes returns at most m - 1 edges: a spanning forest of the pairs that are
   left. The components of these edges are the candidate clusters.
4. Inside a cluster the same search runs again, now with the sets at hand:
   pairs not yet connected are verified, and verified links are joined. No list
   of all pairs is ever made.
5. Verified links give the components.

Scale. Buckets and clusters beyond ``block_rows`` (fewer of long sets) or ``block_bytes`` are cut, in
order of size, into blocks, and pairs of blocks with compatible sizes are tasks
of their own, so no task holds more than two blocks. The tree alone, over all
documents, would compare nearly all sets of similar size (sums of random groups
are alike in unrelated texts); the keys of step 2 keep it to sets that share a
rare token, and lose no link.

Classes are known by a 64-bit hash of their set: among n distinct sets, about
n * n / 3.7e19 pairs are mistaken for equal.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import sieve, slices, written
from orderflow.llm.graph import components
from orderflow.operators.scan import ordered_scan
from orderflow.session import scoped, ship_package

_GROUPS, _FULL = 64, 16     # least number of coordinates of a point, most tokens that one stands for on average
_FINE = 4                   # the latter while the sets aren't at hand, where each pair that passes costs two sets
_WIDE = 3                   # a band of sizes spans this many steps of the threshold
_ROWS, _BINS = 4, 1 << 16   # the frequency sketch
_LEAF = 16
_RUN = 1 << 20    # rows of one key that a task holds at once
_SHORT = 2048     # tokens up to which a set counts as one row of a bucket's block; points grow with the sets
_SMALL = 48       # buckets up to here are compared without a tree
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def shingles(text: str, width: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the text's word ``width``-grams; A-Z lower-cased.

    A text with fewer words has the whole sequence as its one n-gram; a text
    without words has none.
    """
    words = text.encode("utf-8", "replace").lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    if len(h) < width:
        h, n = h[None, :], 1
        parts = [h[0, k:k + 1] for k in range(h.shape[1])]
    else:
        n = len(h) - width + 1
        parts = [h[k:k + n] for k in range(width)]
    total = np.full(n, _U(len(parts)))
    with np.errstate(over="ignore"):
        for p in parts:
            total = _mix(total * _U(3) + p)
    return np.unique(total)


class Threshold:
    """Exact arithmetic of ``den * intersection >= num * union``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1]
        while self.edges[-1] < 1 << 48:
            self.edges.append(max(self.edges[-1] + 1, -(-self.edges[-1] * den ** _WIDE // num ** _WIDE)))
    def needed(self, sizes):
        """Smallest intersection of two sets of ``sizes`` tokens together."""
        return -(-self.num * sizes // (self.num + self.den))

    def links(self, both: int, a: int, b: int) -> bool:
        return self.den * both >= self.num * (a + b - both)

    def smallest(self, n: int) -> int:
        """Size of the smallest set that a set of n tokens can link to."""
        return -(-self.num * n // self.den)

    def largest(self, n: int) -> int:
        return n * self.den // self.num

    def bands(self, n: int) -> set[int]:
        """Bands of sizes in which a set of n tokens meets its partners: the smaller set's band decides."""
        return {bisect_right(self.edges, n), bisect_right(self.edges, self.smallest(n))}


def _bins(tokens: np.ndarray) -> list[np.ndarray]:
    """Bins of the tokens in each row of the sketch."""
    return [((tokens * _U(2 * r + 3)) >> _U(48)).astype(np.int64) + r * _BINS for r in range(_ROWS)]


def prefix(tokens: np.ndarray, sketch: np.ndarray, limit: Threshold) -> np.ndarray:
    """The keys of a set: its first tokens, rarest (by powers of two) first, then by hash, for each of its bands."""
    return _prefix(tokens, sketch, limit)[0]


def _prefix(tokens: np.ndarray, sketch: np.ndarray, limit: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """:func:`prefix`, and for each key the most sets that can send it."""
    n = len(tokens)
    if not n or limit.smallest(n) == n == limit.largest(n):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)  # links to equal sets only, and those are one class
    with np.errstate(over="ignore"):
        often = np.min([sketch[b] for b in _bins(tokens)], 0)
    rank = np.frexp(often.astype(np.float64))[1]
    at = np.lexsort((tokens, rank))[:n - limit.smallest(n) + 1]
    bands = sorted(limit.bands(n))
    with np.errstate(over="ignore"):
        keys = np.concatenate([_mix(tokens[at] + _U(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) for k in bands])
    return keys.view(np.int64), np.tile(often[at], len(bands))


def _node(tokens: np.ndarray) -> int | None:
    return int(np.array(xxhash.xxh64_intdigest(tokens.tobytes()), np.uint64).view(np.int64)) if len(tokens) else None


def _groups(n: int, full: int = _FULL) -> int:
    """Coordinates of the point of a set of n tokens: more for larger sets, whose sums differ less."""
    g = _GROUPS
    while g * full < n:
        g *= 2
    return g


def _point(tokens: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((_mix(tokens) % _U(groups)).astype(np.int64), minlength=groups).astype(np.int32)


def _packed(point: np.ndarray) -> bytes:
    """A point as bytes, half a one or one for each coordinate if they fit; the first byte tells."""
    if point.max() < 16 and not len(point) % 2:
        return bytes([0]) + (point[::2] | point[1::2] << 4).astype("<u1").tobytes()
    kind = "<u1" if point.max() < 256 else "<u4"
    return bytes([int(kind[-1])]) + point.astype(kind).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    if packed[0]:
        return np.frombuffer(packed, f"<u{packed[0]}", offset=1)
    both = np.frombuffer(packed, "<u1", offset=1)
    return np.stack([both & 15, both >> 4], 1).ravel()


def _points(packed: list[bytes]) -> np.ndarray:
    """Points in the fewest coordinates that one of them has; the others are folded."""
    rows = [_unpacked(p) for p in packed]
    least = min(map(len, rows))
    rows = [p.reshape(-1, least).sum(0, dtype=np.int32) if len(p) > least else p for p in rows]
    return np.array(rows, np.uint8 if max(p.max() for p in rows) < 256 else np.int32)


def _describe(width: int):
    def run(batches):
        sketch = np.zeros(_ROWS * _BINS, np.int64)
        names = ["doc_id", "n", "node", "point", "bins", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for batch in slices(batches, "text"):
            n, node, point, held = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text or "", width)
                n.append(len(s))
                node.append(_node(s))
                point.append(_packed(_point(s, _groups(len(s), _FINE))) if len(s) else None)
                held.append(s)
            with np.errstate(over="ignore"):
                for b in _bins(np.concatenate(held)):
                    sketch += np.bincount(b, minlength=len(sketch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n, node, point, *[[None] * len(n)] * 2), kinds[1:])], names)
        # the task's share of the sketch, as a row of its own: the bins that it met
        met = np.flatnonzero(sketch)
        yield pa.RecordBatch.from_arrays([pa.array([None], k) for k in kinds[:4]]
                                         + [pa.array([met.astype(np.int32)], kinds[4]), pa.array([sketch[met]], kinds[5])], names)
    return run


def _hot(sketch: np.ndarray) -> int:
    """Sets that a key may have before its rows are dealt by set: a small part of what a task holds anyway."""
    return max(_RUN, 2 * int(sketch.sum()) // len(sketch))


def _keys(width: int, num: int, den: int, sent):
    """``key, node, n`` of each set's keys; n is negative if so many sets can have the key that it is hot."""
    def run(batches):
        limit, sketch, seen = Threshold(num, den), sent.value, set()
        most = _hot(sketch)
        for batch in slices(batches, "text"):
            keys, node, size = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text or "", width)
                name = _node(s)
                if name is None or name in seen:
                    continue  # a copy in the same task sends the same keys
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(name)
                k, often = _prefix(s, sketch, limit)
                keys.append(k)
                node.append(np.full(len(k), name))
                size.append(np.where(often > most, -len(s), len(s)))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, node, size)], ["key", "node", "n"])
    return run


def _meet(batches):
    """Rows in order of (key, node) -> ``node, n, bucket`` of the keys with two classes at least.

    A key's bucket is named by its classes. Hot keys and those with more than
    _RUN rows here are named by the key; all rows of a hot key are kept, as the
    others of that key may be elsewhere.
    """
    def named(key, node, n, own):
        """Whole runs of keys; ``own``: rows whose bucket is named by the key."""
        with np.errstate(over="ignore"):
            bucket = _mix(key.view(_U) + _U(0x5851F42D4C957F2D))
        keep = own.copy()
        at = np.flatnonzero(~own)
        if len(at):
            k, v = key[at], node[at]
            fresh = np.r_[True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])]
            at, k, v = at[fresh], k[fresh], v[fresh].view(_U)
            first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            m = np.diff(np.r_[first, len(k)])
            with np.errstate(over="ignore"):
                name = _mix(v[first] + _U(3) * _mix(v[first + m - 1]) + _U(5) * _mix(np.bitwise_xor.reduceat(v, first)) + m.astype(_U))
            bucket[at] = np.repeat(name, m)
            keep[at] = np.repeat(m > 1, m)
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(np.abs(n[keep])), pa.array(bucket[keep].view(np.int64))],
                                          ["node", "n", "bucket"])

    held, long = [np.zeros(0, np.int64)] * 3, None
    for batch in batches:
        key, node, n = (np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("key", "node", "n")))
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))  # the last run may go on
        if key[-1] == long or len(key) - last > _RUN:
            long, last = key[-1], len(key)
        if last:
            yield named(key[:last], node[:last], n[:last], (n[:last] < 0) | (key[:last] == long if long is not None else False))
        held = [key[last:], node[last:], n[last:]]
    if len(held[0]):
        yield named(*held, held[2] < 0)


def _sets(width: int):
    def run(batches):
        for batch in slices(batches, "text"):
            keep, n, sets = [], [], []
            for k, (text, node) in enumerate(zip(batch.column("text").to_pylist(), batch.column("node").to_pylist())):
                s = shingles(text or "", width)
                if _node(s) == node:
                    keep.append(k)
                    n.append(len(s))
                    sets.append(s.tobytes())
            got = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*map(got.column, ("cluster", "block", "tiles", "node")), pa.array(n, pa.int64()),
                 pa.array(sets, pa.binary())], ["cluster", "block", "tiles", "node", "n", "tokens"])
    return run


class CountTree:
    """Packed R-tree over count vectors, searched by the overlap bound."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, limit: Threshold):
        """``points`` come in order of size; neighbours of similar size share a leaf."""
        self.points, self.sizes, self.limit = points, sizes, limit
        self.levels = []
        top, low, high = points, sizes, sizes
        while len(top) > _LEAF:
            cut = np.arange(0, len(top), _LEAF)
            top, low, high = np.maximum.reduceat(top, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((top, low, high))

    def search(self, k: int) -> np.ndarray:
        """Points after ``k`` whose overlap with point k may be enough."""
        point, size = self.points[k], int(self.sizes[k])
        least, most = self.limit.smallest(size), size * self.limit.den // self.limit.num
        live = None
        for top, low, high in reversed(self.levels):
            at = np.arange(len(top)) if live is None else live[live < len(top)]
            at = at[(high[at] >= least) & (low[at] <= most)]
            bound = np.minimum(top[at], point).sum(1)
            at = at[bound >= self.limit.needed(size + np.maximum(low[at], least))]
            live = (at[:, None] * _LEAF + np.arange(_LEAF)).ravel()
        live = np.arange(len(self.points)) if live is None else live
        live = live[(live > k) & (live < len(self.points))]
        live = live[(self.sizes[live] >= least) & (self.sizes[live] <= most)]
        bound = np.minimum(self.points[live], point).sum(1)
        return live[bound >= self.limit.needed(size + self.sizes[live])]


def forest(points: np.ndarray, sizes: np.ndarray, limit: Threshold, side: np.ndarray, holds=None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that pass the overlap bound and, if given, the test ``holds(k, j)``.

    Rows come in order of size. With two sides, only pairs across are looked at.
    """
    m = len(sizes)
    label, out = np.arange(m), []
    across = side.min() != side.max()
    near_of = None
    if m <= _SMALL:
        bound = np.minimum(points[:, None], points[None]).sum(2)
        fits = (bound >= limit.needed(sizes[:, None] + sizes[None])) & (limit.smallest(sizes)[None] <= sizes[:, None])
        near_of = np.triu(fits, 1)
    tree = CountTree(points, sizes, limit) if near_of is None else None
    for k in range(m - 1):
        near = np.flatnonzero(near_of[k]) if tree is None else tree.search(k)
        near = near[label[near] != label[k]]
        if across:
            near = near[side[near] != side[k]]
        for j in near:
            if label[j] != label[k] and (holds is None or holds(k, j)):
                out.append((k, int(j)))
                label[label == label[j]] = label[k]
    return out


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _buckets(num: int, den: int):
    """Runs of rows with equal (bucket, tile), in order of size -> edges of their forest."""
    def edges(rows, limit):
        node, size, side, point = zip(*rows)
        if len(set(node)) < 2:
            return []
        return [(node[i], node[j]) for i, j in forest(_points(point), np.array(size), limit, np.array(side))]

    def run(batches):
        limit, name, rows, out = Threshold(num, den), None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("bucket", "tile", "node", "n", "block", "point")]
            for bucket, tile, *row in zip(*cols):
                if (bucket, tile) != name:
                    if len(rows) > 1:
                        out += edges(rows, limit)
                    name, rows = (bucket, tile), []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])
                out = []
        if len(rows) > 1 and (out := edges(rows, limit)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])
    return run


def _tile(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        rows = {}
        for node, block, tokens in zip(table.column("node").to_pylist(), table.column("block").to_pylist(), table.column("tokens")):
            rows.setdefault(node, (block, np.frombuffer(tokens.as_buffer(), np.uint64)))
        nodes = sorted(rows, key=lambda x: (len(rows[x][1]), x))
        sets = [rows[x][1] for x in nodes]
        limit, sizes = Threshold(num, den), np.array([len(s) for s in sets], np.int64)

        def holds(k, j):
            return limit.links(_overlap(sets[k], sets[j]), len(sets[k]), len(sets[j]))

        groups = _groups(int(np.median(sizes)))
        pairs = forest(np.array([_point(s, groups) for s in sets]), sizes, limit, np.array([rows[x][0] for x in nodes]), holds)
        return pa.table({"a": pa.array([nodes[i] for i, _ in pairs], pa.int64()),
                         "b": pa.array([nodes[j] for _, j in pairs], pa.int64())})
    return run


def _tiles(rows: DataFrame, group: str, num: int, den: int) -> DataFrame:
    """``group, block, tile``: the tiles that each block takes part in, one per pair of blocks whose sizes can link."""
    blocks = rows.groupBy(group, "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = blocks.select(group, F.col("block").alias("with"), F.col("low").alias("low2"))
    tiles = blocks.join(other, group).where((F.col("block") <= F.col("with")) & (F.col("high") * den >= F.col("low2") * num))
    return tiles.select(group, F.explode(F.array_distinct(F.array("block", "with"))).alias("block"),
                        F.concat_ws("-", "block", "with").alias("tile"))


def _shared(keyed: DataFrame) -> DataFrame:
    """``node, n, bucket`` of the keys with two classes at least; keys with the same classes are one bucket.

    One exchange of the keys, from which single ones don't return. The rows of
    a hot key (negative n) are dealt by class, so they are in many tasks.
    """
    place = F.when(F.col("n") < 0, F.col("node")).otherwise(F.col("key"))
    return keyed.repartition(place).sortWithinPartitions("key", "node") \
        .mapInArrow(_meet, "node long, n long, bucket long").distinct()


def _in_blocks(rows: DataFrame, group: str, weight: Column, most: int) -> DataFrame:
    """``rows`` with ``block``: runs of at most ``most`` weight (one row at least) in order of size; a hot group is in many tasks."""
    scanned = ordered_scan(rows, [group], ["n", "node"], sums={"held": weight})
    return scanned.withColumn("block", F.floor((F.col("held") - weight) / most).cast("int")).drop("held")


def jaccard_components(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100,
                       block_bytes: int = 24 << 20, block_rows: int = 4096) -> DataFrame:
    """Component of every document under links of Jaccard similarity at least ``num / den``.

    Returns ``doc_id, n_shingles, component_id``; component_id is the smallest
    doc_id of the component. Null and empty texts have no n-grams and are
    linked with nothing (component_id is their own doc_id); rows with null ids
    take part, and their component's smallest id may be null if no row of it
    has an id; repeated rows and ties of similarity (exactly the threshold)
    link; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = written(src.mapInArrow(
        _describe(width), "doc_id long, n long, node long, point binary, bins array<int>, counts array<long>"), "sets")
    counts = described.where("bins is not null").select(F.inline(F.arrays_zip("bins", "counts"))) \
        .groupBy("bins").agg(F.sum("counts").alias("n")).toArrow()  # as many rows as the sketch has bins at most
    sketch = np.zeros(_ROWS * _BINS, np.int64)
    sketch[counts.column("bins").to_numpy()] = counts.column("n").to_numpy()
    described = described.where("bins is null").drop("bins", "counts")
    classes = written(described.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("point").alias("point")), "classes")

    sent = spark.sparkContext.broadcast(sketch)

    def candidates() -> DataFrame:
        keyed = src.mapInArrow(_keys(width, num, den, sent), "key long, node long, n long")
        places = scoped(spark, "places", lambda: _in_blocks(
            written(_shared(keyed), "shared"), "bucket", F.greatest("n", F.lit(_SHORT)), _SHORT * block_rows))
        edges = places.join(_tiles(places, "bucket", num, den), ["bucket", "block"]) \
            .join(classes.select("node", "point"), "node") \
            .repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "n", "node") \
            .mapInArrow(_buckets(num, den), "a long, b long").distinct()
        return components(scoped(spark, "candidates", lambda: edges), "a", "b")

    def links() -> DataFrame:
        clusters = scoped(spark, "clusters", candidates)
        member = clusters.select("node", F.col("component").alias("cluster")).join(classes.drop("point"), "node")
        # blocks of at most block_bytes of sets
        member = scoped(spark, "members", lambda: _in_blocks(member, "cluster", F.col("n") * 8, block_bytes))
        # tiles are known before the sets are made, so sets are shuffled once
        tiles = _tiles(member, "cluster", num, den).groupBy("cluster", "block").agg(F.collect_list("tile").alias("tiles"))
        # only the texts of members, and few others, are shuffled; always, as the sieve and _sets in one task would be two workers
        sets = src.where(sieve(member, "rep")("doc_id")).join(
            member.join(tiles, ["cluster", "block"]).select(F.col("rep").alias("doc_id2"), "node", "cluster", "block", "tiles").hint("merge"),
            F.col("doc_id").eqNullSafe(F.col("doc_id2"))) \
            .select("cluster", "block", "tiles", "node", "text") \
            .mapInArrow(_sets(width), "cluster long, block int, tiles array<string>, node long, n long, tokens binary")
        found = sets.withColumn("tile", F.explode("tiles")).drop("tiles").groupBy("cluster", "tile") \
            .applyInArrow(_tile(num, den), "a long, b long")
        return components(written(found, "links"), "a", "b")

    found = scoped(spark, "found", links)
    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("node", "component_id")
    return described.select("doc_id", "n", "node").join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
