"""Minimax contiguous sharding of atomic groups.

Groups (documents with equal texts) stay whole. They are ordered by the hash
of their text, and the ordered sequence is cut into at most ``shards`` runs so
that the largest run is as small as possible.

Scale. Nothing but summaries reaches the driver. The hash's leading digits
deal the groups into ``blocks`` blocks of equal expected size, so prefix sums
need one native window per block plus one row per block. The capacity search
runs on the driver over a set of *known* prefix sums: at first the block ends;
then, round by round, those inside the stretches where a cut can still fall,
summarised in ``per_cut`` cells a stretch, until the capacity is settled. A hot group is one row after a map-side combined sum;
its documents are numbered in salted parts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import block_prefix, written


def _greedy(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cuts of the greedy filling with ``capacity`` over known prefix sums; None if it takes more shards."""
    cuts, at, total = [], 0, ends[-1]
    for _ in range(shards):
        if at == total:
            break
        nxt = ends[bisect_right(ends, at + capacity) - 1]
        if nxt == at:
            return None
        cuts.append(nxt)
        at = nxt
    return cuts if at == total else None


def _smallest(ends: list[int], lo: int, hi: int, shards: int) -> int:
    """Binary search for the smallest feasible capacity in [lo, hi]; hi is feasible."""
    while lo < hi:
        mid = (lo + hi) // 2
        if _greedy(ends, mid, shards) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _even(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Cuts within ``capacity`` that also keep the other shards near the mean of what is left.

    ``latest[i]`` is the first known position from which the rest still fits
    into the shards after the i-th; the greedy cuts serve where it is not known
    finely enough.
    """
    latest = [ends[-1]]
    for _ in range(shards):
        latest.append(ends[bisect_left(ends, max(0, latest[-1] - capacity))])
    latest = latest[::-1]
    greedy = _greedy(ends, capacity, shards)
    if latest[0] > 0:
        return greedy
    cuts, at = [], 0
    for i in range(shards):
        aim = max(at + (ends[-1] - at) // (shards - i), latest[i + 1])
        nxt = ends[bisect_right(ends, min(aim, at + capacity)) - 1]
        up = bisect_right(ends, nxt)
        if up < len(ends) and ends[up] <= at + capacity and (ends[up] - aim < aim - nxt or nxt == at):
            nxt = ends[up]
        cuts.append(nxt)
        at = nxt
    sizes = [b - a for a, b in zip([0, *cuts], cuts)]
    return cuts if at == ends[-1] and max(sizes) <= capacity else greedy


def _reach(known: list[int], open_after: list[bool], at: int, capacity: int) -> int:
    """No prefix sum that a shard from ``at`` can end on lies beyond this.

    Between two known prefix sums there may be others only if the gap is open.
    """
    k = bisect_right(known, at + capacity) - 1
    return min(at + capacity, known[-1]) if open_after[k] else known[k]


def _hopeful(known: list[int], open_after: list[bool], capacity: int, shards: int) -> bool:
    """Whether ``capacity`` may be feasible, as far as is known."""
    at = 0
    for _ in range(shards):
        at = _reach(known, open_after, at, capacity)
    return at >= known[-1]


def minimax_cuts(inside, block_ends: list[int], largest: int, shards: int, per_cut: int = 2048) -> tuple[int, list[int]]:
    """The smallest capacity and its cuts (ends of the shards, as prefix sums).

    ``block_ends``: some true prefix sums, the last being the total.
    ``inside(stretches, per_cut)`` divides each stretch ``(a, b)`` into
    ``per_cut`` equal cells and returns, for each cell that holds prefix sums,
    the smallest, the largest and how many. Each round the capacity is
    bracketed from what is known: feasible over known cuts from above, hopeless
    even with every open gap filled from below. The stretches that cuts can
    still fall into shrink with the bracket until they hold no open gap.
    """
    total = block_ends[-1]
    if total == 0:
        return 0, []
    known = sorted({0, *block_ends})
    open_after = [True] * (len(known) - 1) + [False]
    lo = max(largest, -(-total // shards))
    while True:
        hi = _smallest(known, lo, lo + total, shards)
        low, high = lo, hi
        while low < high:  # binary search for the smallest capacity that isn't hopeless
            mid = (low + high) // 2
            if _hopeful(known, open_after, mid, shards):
                high = mid
            else:
                low = mid + 1
        lo = low
        if hi == lo:
            return hi, _even(known, hi, shards)
        gaps, at, far = set(), 0, 0
        for _ in range(1, shards):  # where the cuts of any capacity in [lo, hi] lie
            at = known[bisect_right(known, at + lo) - 1]
            far = _reach(known, open_after, far, hi)
            gaps.update(k for k in range(bisect_right(known, at) - 1, bisect_left(known, far)) if open_after[k])
        stretches: list[tuple[int, int]] = []
        for k in sorted(gaps):
            if stretches and known[k] - stretches[-1][1] <= total // (64 * shards):
                stretches[-1] = (stretches[-1][0], known[k + 1])
            else:
                stretches.append((known[k], known[k + 1]))
        cells = sorted(inside(stretches, per_cut))
        keep = [(v, o) for v, o in zip(known, open_after) if not any(a < v < b for a, b in stretches)]
        starts = {a for a, _ in stretches}
        merged = {v: (False if v in starts else o) for v, o in keep}
        for first, last, n in cells:
            merged.setdefault(first, False)
            merged.setdefault(last, False)
            if n > 2:
                merged[first] = True
        known, open_after = map(list, zip(*sorted(merged.items())))


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16, blocks: int = 4096,
                    salts: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents into ``shards`` shards of near equal bytes; equal texts stay together.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard,
    group_rows``: size is the UTF-8 bytes of the text plus ``overhead``; law is
    ``bytes``; slot numbers a shard's documents from 0 without gaps (by group,
    then by salted part and id); grown_shard is null under this law.

    Null texts form one group of their own with size ``overhead`` and the crc
    of the empty string; null ids and repeated rows are rows like any other;
    an empty table gives no rows; extra columns are ignored. Ties of size need
    no rule: the order of groups is that of their hashes.
    """
    text = F.col(text_col)
    raw = F.coalesce(text, F.lit("")).cast("binary")
    rows = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(raw) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.when(text.isNull(), F.lit("0" * 64)).otherwise(F.sha2(raw, 256)).alias("grp"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt")), "shard-rows")
    block = F.pmod(F.conv(F.substring("grp", 1, 8), 16, 10).cast("long"), F.lit(blocks)).cast("int")
    parts = written(rows.groupBy("grp", "salt").agg(
        F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows")), "shard-parts")
    groups = parts.groupBy("grp").agg(F.sum("part_bytes").alias("g_bytes"), F.sum("part_rows").alias("g_rows")) \
        .withColumn("block", block)
    base = block_prefix(groups, "block", {"g_bytes": "bytes_base", "g_rows": "rows_base"})
    upto = Window.partitionBy("block").orderBy("grp").rowsBetween(Window.unboundedPreceding, 0)
    placed = written(groups.join(base, "block").select(
        "grp", "g_bytes", "g_rows",
        (F.col("bytes_base") + F.sum("g_bytes").over(upto)).alias("end_bytes"),
        (F.col("rows_base") + F.sum("g_rows").over(upto)).alias("end_rows"), "block"), "shard-groups")

    # one row per block: a bounded summary
    ends = [r[0] for r in placed.groupBy("block").agg(F.max("end_bytes")).select("max(end_bytes)").collect()]
    largest = placed.agg(F.max("g_bytes")).first()[0] or 0

    def inside(stretches, per_cut):
        # at most per_cut rows for each stretch
        cell = F.lit(None).cast("long")
        for k, (a, b) in reversed(list(enumerate(stretches))):
            cell = F.when((F.col("end_bytes") > a) & (F.col("end_bytes") < b),
                          F.lit(k * per_cut) + F.floor((F.col("end_bytes") - a - 1) * F.lit(per_cut) / F.lit(b - a))).otherwise(cell)
        cells = placed.select("end_bytes", cell.alias("cell")).where("cell is not null").groupBy("cell") \
            .agg(F.min("end_bytes").alias("first"), F.max("end_bytes").alias("last"), F.count("*").alias("n"))
        return [(r["first"], r["last"], r["n"]) for r in cells.collect()]

    _, cuts = minimax_cuts(inside, sorted(ends) or [0], largest, shards)
    start = F.col("end_bytes") - F.col("g_bytes")
    shard = sum([(start >= F.lit(c)).cast("int") for c in cuts[:-1]], F.lit(0)).alias("shard")
    placed = placed.select("grp", "g_rows", (F.col("end_rows") - F.col("g_rows")).alias("start_rows"), shard)
    first_rows = placed.groupBy("shard").agg(F.min("start_rows").alias("shard_start"))  # at most `shards` rows
    earlier = Window.partitionBy("grp").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("grp", "salt", F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("part_start")) \
        .join(placed.join(F.broadcast(first_rows), "shard"), "grp") \
        .select("grp", "salt", "shard", F.col("g_rows").alias("group_rows"),
                (F.col("start_rows") - F.col("shard_start") + F.col("part_start")).alias("slot_base"))
    in_part = Window.partitionBy("grp", "salt").orderBy(F.col("doc_id").asc_nulls_first())
    return rows.withColumn("nth", F.row_number().over(in_part)).join(offsets, ["grp", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("slot_base") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "group_rows")
