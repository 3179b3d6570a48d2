"""Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf; the leaves of a group (a source) in order are the bottom
of a tree of arity three whose root is the group's subroot; the subroots in
order of the groups are the bottom of the top tree. Hashes are SHA-256 over the
children's hexadecimal digests. Trees are numbered: 0 is the top tree, 1, 2, ...
those of the groups; a node is (tree, level, idx).

Building. Leaves are hashed by native expressions, numbered inside their group
by the ordered scan and cut into blocks of 3^STEP consecutive ones. A task
hashes the lowest STEP levels of a block; the blocks' tops are the next round's
leaves, so a tree of any size takes log(n) / STEP rounds, and a group with a
third of all rows is in many tasks.

Proving. A block of leaves works out which nodes its proofs need and it can't
derive itself: level by level, of every run that holds a known node the other
nodes not known. That is the smallest union; it is fetched by one join with the
node table, at most two nodes a level for a whole block. The task then derives
the interiors that its leaves share, once, and writes each leaf's own proof.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import written
from orderflow.operators.scan import ordered_scan
from orderflow.session import ship_package

ARITY = 3
STEP = 7                # levels that a task builds at a time
BLOCK = ARITY ** STEP   # leaves in a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree long, level int, idx long, digest binary"


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves (a lone leaf is the root itself)."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def level_size(n: int, level: int) -> int:
    for _ in range(level):
        n = -(-n // ARITY)
    return n


def parent(digests: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def leaf_hash(columns: list[Column]) -> Column:
    """Hexadecimal SHA-256 of the columns, each ``-`` if null, else UTF-8 byte count, ``:`` and value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


# --- building ----------------------------------------------------------------------------------------

@dataclass
class Manifest:
    """Written tables: ``leaves`` (``tree, n, groups, pos, digest`` and the caller's columns), ``nodes``
    (``tree, level, idx, digest``; the interiors, and the subroots as level 0 of tree 0) and ``trees``
    (``tree, group, n, groups``)."""
    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def _grow(base: int):
    def run(table):
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        rows = sorted(zip(table.column("idx").to_pylist(), table.column("digest").to_pylist(), strict=True))
        idx, cur, out = rows[0][0], [d for _, d in rows], []
        for level in range(base + 1, min(base + STEP, height(n)) + 1):
            cur, idx = [parent(cur[k:k + ARITY]) for k in range(0, len(cur), ARITY)], idx // ARITY
            out += [(tree, level, idx + k, d) for k, d in enumerate(cur)]
        cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                         pa.array(cols[3], pa.binary())], ["tree", "level", "idx", "digest"])
    return run


def interiors(leaves: DataFrame) -> DataFrame:
    """All nodes above ``tree, n, pos, digest``: ``tree, level, idx, digest``, STEP levels a round."""
    spark = leaves.sparkSession
    deepest = height(leaves.agg(F.max("n")).first()[0] or 0)
    cur = leaves.where("n > 1").select("tree", "n", F.col("pos").alias("idx"), "digest")
    out, base = spark.createDataFrame([], NODES), 0
    sizes = leaves.select("tree", "n").where("n > 1").distinct()
    while base < deepest:
        made = written(cur.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block")).applyInArrow(_grow(base), NODES), "nodes")
        out, base = out.unionByName(made), base + STEP
        if base < deepest:  # trees that end below have no node at this level but their root
            cur = made.where(F.col("level") == base).join(sizes, "tree").where(F.col("n") > ARITY ** base) \
                .select("tree", "n", "idx", "digest")
    return out


def build(docs: DataFrame, digest: Column, group: str, order: list, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``: one tree for each value of ``group`` (null is one, and the first), and the top tree.

    ``digest`` is a leaf's hexadecimal digest; leaves stand in ``order``, ties
    by digest. ``keep`` names columns to carry to ``leaves``. Rows that repeat
    are leaves like any other. An empty table gives empty tables.
    """
    ship_package(docs.sparkSession)
    keep = keep or {}
    own = docs.select(F.col(group).alias("__group"), *[o.alias(f"__o{k}") for k, o in enumerate(order)],
                      F.unhex(digest).alias("digest"), *[c.alias(n) for n, c in keep.items()])
    placed = ordered_scan(own, ["__group"], [*[f"__o{k}" for k in range(len(order))], "digest"], sums={"__rank": F.lit(1)})
    placed = written(placed.select("__group", (F.col("__rank") - 1).alias("pos"), "digest", *keep), "leaves")
    groups = placed.groupBy("__group").agg(F.count(F.lit(1)).alias("n")).withColumn("__all", F.lit(0))
    trees = written(ordered_scan(groups, ["__all"], ["__group"], sums={"tree": F.lit(1)}).select(
        "tree", F.col("__group").alias("group"), "n"), "trees")
    trees = trees.withColumn("groups", F.lit(trees.count()).cast("long"))
    leaves = written(placed.join(trees, F.col("__group").eqNullSafe(F.col("group")))
                     .select("tree", "n", "groups", "pos", "digest", *keep), "leaves")
    nodes = interiors(leaves.select("tree", "n", "pos", "digest"))
    top_level = F.udf(lambda n: height(n), "int")  # once per tree
    lone = leaves.where("n = 1").select("tree", F.col("digest"))
    subroots = lone.unionByName(nodes.join(trees.where("n > 1").select("tree", top_level("n").alias("level")), ["tree", "level"])
                                .select("tree", "digest"))
    top = written(subroots.join(trees.select("tree", "groups"), "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("groups").alias("n"), (F.col("tree") - 1).alias("pos"), "digest"), "subroots")
    nodes = nodes.unionByName(top.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest")) \
        .unionByName(interiors(top))
    return Manifest(leaves, nodes, trees)


# --- proving -----------------------------------------------------------------------------------------

def missing_nodes(known: list[int], n: int) -> list[tuple[int, int]]:
    """(level, idx) of the fewest nodes that, with the ``known`` leaves, give the root of a tree of ``n`` leaves."""
    out, level, known = [], 0, sorted(set(known))
    while n > 1:
        have, runs = set(known), sorted({i // ARITY for i in known})
        out += [(level, i) for r in runs for i in range(ARITY * r, min(ARITY * r + ARITY, n)) if i not in have]
        known, n, level = runs, -(-n // ARITY), level + 1
    return out


def _coordinates(table):
    """What a block has to fetch: its multiproof's nodes, in its tree and in the top tree, and the two roots."""
    tree, block, n, groups = (table.column(c)[0].as_py() for c in ("tree", "block", "n", "groups"))
    rows = [(tree, level, i) for level, i in missing_nodes(table.column("pos").to_pylist(), n)]
    rows += [(0, level, i) for level, i in missing_nodes([tree - 1], groups)]
    rows += [(tree, height(n), 0)] * (n > 1) + [(0, height(groups), 0)] + [(0, 0, tree - 1)] * (n == 1 and groups > 1)
    return pa.table([pa.array([tree] * len(rows), pa.int64()), pa.array([block] * len(rows), pa.int64()),
                     pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.array([r[2] for r in rows], pa.int64())], ["tree", "block", "of_tree", "level", "idx"])


class Octopus:
    """One block's derived part of the path from its leaves to the root."""

    def __init__(self, tree: int, n: int, groups: int, leaves: dict[int, bytes], fetched: dict[tuple[int, int, int], bytes]):
        self.tree, self.n, self.groups, self.known = tree, n, groups, dict(fetched)
        self.top = height(n)
        known = sorted(leaves)
        self.known.update({(tree, 0, i): d for i, d in leaves.items()})
        self.published = fetched[(0, height(groups), 0)]
        self.subroot = fetched[(tree, self.top, 0)] if n > 1 else fetched[(0, 0, tree - 1)] if groups > 1 else leaves[0]
        for t, size, at in ((tree, n, known), (0, groups, [tree - 1])):
            level = 0
            while size > 1:
                runs = sorted({i // ARITY for i in at})
                for r in runs:
                    self.known[(t, level + 1, r)] = parent(self.run(t, level, r, size))
                at, size, level = runs, -(-size // ARITY), level + 1
            if t:
                self.known[(0, 0, tree - 1)] = self.known[(tree, level, 0)]
        self._above: dict = {}

    def run(self, t: int, level: int, r: int, size: int) -> list[bytes]:
        return [self.known[(t, level, i)] for i in range(ARITY * r, min(ARITY * r + ARITY, size))]

    def step(self, t: int, level: int, i: int) -> tuple | None:
        """(siblings before, siblings after, parent) of a node; None at the root. A subroot's parent is in the top tree."""
        key = (t, level, i)
        if key not in self._above:
            if t and level == self.top:
                self._above[key] = self.step(0, 0, t - 1)
            elif not t and level == height(self.groups):
                self._above[key] = None
            else:
                run = self.run(t, level, i // ARITY, level_size(self.n if t else self.groups, level))
                k = i % ARITY
                self._above[key] = (run[:k], run[k + 1:], (t, level + 1, i // ARITY))
        return self._above[key]

    def siblings(self, pos: int) -> list[bytes]:
        """A leaf's own proof, level by level, left to right."""
        out, step = [], self.step(self.tree, 0, pos)
        while step is not None:
            out += step[0] + step[1]
            step = self.step(*step[2])
        return out

    def fold(self, pos: int, digest: bytes) -> bytes:
        """The root that ``digest`` in the leaf's place leads to. From a node that is as derived, the rest is as derived."""
        at, step = (self.tree, 0, pos), self.step(self.tree, 0, pos)
        while step is not None:
            if digest == self.known[at]:
                return self.known[(0, height(self.groups), 0)]
            digest = parent([*step[0], digest, *step[1]])
            at, step = step[2], self.step(*step[2])
        return digest


def _expand(names: list[str], keep_siblings: bool):
    def run(table, fetched):
        tree, n, groups = (table.column(c)[0].as_py() for c in ("tree", "n", "groups"))
        pos, leaf, other = (table.column(c).to_pylist() for c in ("pos", "digest", "altered"))
        got = {(t, level, i): d for t, level, i, d in zip(*(fetched.column(c).to_pylist() for c in (
            "of_tree", "level", "idx", "digest")), strict=True)}
        octo = Octopus(tree, n, groups, dict(zip(pos, leaf, strict=True)), got)
        subroot, root = octo.subroot.hex(), octo.published.hex()
        digest, folded, whole = [], [], []
        for p, d, a in zip(pos, leaf, other, strict=True):
            path = [s.hex() for s in octo.siblings(p)]
            digest.append(hashlib.sha256("".join(path).encode()).hexdigest())
            folded.append(octo.fold(p, d if a is None else a).hex())
            if keep_siblings:
                whole.append(path)
        cols = [table.column(c) for c in names] + [
            pa.array([d.hex() for d in leaf]), pa.array([subroot] * len(pos)), pa.array([root] * len(pos)),
            pa.array(digest), pa.array(folded), pa.array([f == root for f in folded])]
        cols += [pa.array(whole, pa.list_(pa.string()))] if keep_siblings else []
        return pa.table(cols, [*names, *PROOF, *(["siblings"] if keep_siblings else [])])
    return run


PROOF = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def multiproofs(manifest: Manifest, leaves: DataFrame) -> DataFrame:
    """``tree, block, of_tree, level, idx, digest``: the nodes that each block of ``leaves`` needs, fetched once."""
    blocks = leaves.select("tree", "n", "groups", "pos", F.floor(F.col("pos") / BLOCK).alias("block"))
    wanted = blocks.groupBy("tree", "block").applyInArrow(
        _coordinates, "tree long, block long, of_tree long, level int, idx long")
    nodes = manifest.leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest") \
        .unionByName(manifest.nodes).withColumnRenamed("tree", "of_tree")
    return wanted.join(nodes, ["of_tree", "level", "idx"]).select("tree", "block", "of_tree", "level", "idx", "digest")


def prove(manifest: Manifest, leaves: DataFrame, keep: list[str] | None = None, keep_siblings: bool = True) -> DataFrame:
    """Proofs of ``leaves``: any rows of ``manifest.leaves``, with a column ``altered`` (a digest to check instead, or null).

    Returns the columns in ``keep`` and ``leaf, subroot, root, proof_sha256,
    folded_root, verified`` (and ``siblings``, level by level to the root).
    ``verified`` tells whether the altered or original leaf leads to the root
    of the manifest. No leaves give no rows.
    """
    ship_package(leaves.sparkSession)
    keep = list(keep or [])
    blocks = leaves.select("tree", "n", "groups", "pos", "digest", "altered", *keep).withColumn("block", F.floor(F.col("pos") / BLOCK))
    types = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    schema = ", ".join([f"{c} {types[c]}" for c in keep] + [f"{c} {'boolean' if c == 'verified' else 'string'}" for c in PROOF]
                       + (["siblings array<string>"] if keep_siblings else []))
    fetched = multiproofs(manifest, leaves)
    return blocks.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(_expand(keep, keep_siblings), schema)


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` by source, and the check of rows some of which lost their line breaks.

    Rows with an even crc32 of the decimal ``doc_id`` are checked with the
    text's line feeds deleted (null ids and null texts as they are). Returns
    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for
    every row: null sources are a source of their own and the first; rows with
    equal ids stand in the order of their leaves; a row repeated is a leaf
    each time; a source of one row has that leaf as its subroot, a table of one
    source that subroot as its root; the proof of a lone leaf is empty. An
    empty table gives no rows. Columns other than the five are ignored.
    """
    fields = {c: F.col(c).cast("long") if c in ("doc_id", "n_chars") else F.col(c).cast("string") for c in FIELDS}
    odd_out = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    stripped = leaf_hash([*[fields[c] for c in FIELDS[:-1]], F.replace(fields["text"], F.lit("\n"), F.lit(""))])
    src = docs.select(*[c.alias(n) for n, c in fields.items()])
    altered = F.when(odd_out & F.contains(F.col("text"), F.lit("\n")), F.unhex(stripped))
    manifest = build(src, leaf_hash([F.col(c) for c in FIELDS]), "source", [F.col("doc_id")],
                     {"doc_id": F.col("doc_id"), "altered": altered})
    return prove(manifest, manifest.leaves, ["doc_id"], keep_siblings=False)
