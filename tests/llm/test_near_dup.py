"""N-gram Jaccard join and components against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm.graph import components
from orderflow.llm import near_dup
from orderflow.llm.common import sieve
from orderflow.llm.near_dup import _FINE, CountTree, Threshold, _groups, _in_blocks, _meet, _packed, _point, _points, _shared, forest, jaccard_components, prefix, shingles


def _set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def brute(rows, width, num, den):
    sets = [_set(t, width) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    out = []
    for (i, _), s, k in zip(rows, sets, label):
        ids = [x for (x, _), z in zip(rows, label) if z == k and x is not None]
        out.append((i, len(s), (min(ids) if ids else None) if s else i))
    return sorted(out, key=repr)


def family(seed, n=60, words=120):
    """Copies of a few texts with a growing number of edits, and a passage that all share."""
    r = random.Random(seed)
    rows, passage = [], " ".join(f"p{k}" for k in range(30))
    for base in range(3):
        text = [f"b{base}w{r.randint(0, 300)}" for _ in range(words)]
        for k in range(n // 3):
            t = list(text)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5, 9])):
                t[r.randrange(len(t))] = f"e{r.randint(0, 999)}"
            rows.append((base * 100 + k, passage + " " + " ".join(t)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,num,den,blocks", [(3, 90, 100, {}), (5, 80, 100, {"block_bytes": 4000, "block_rows": 7})])
def test_components_equal_brute_force(spark, odd_rows, width, num, den, blocks):
    rows = family(1) + [(None if i is None else 1000 + i, t) for i, t, *_ in odd_rows]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, node int, cluster string").repartition(4)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, width, num, den, **blocks).collect()), key=repr)
    assert got == brute(rows, width, num, den)


def test_empty_table(none):
    assert jaccard_components(none).count() == 0


def test_linking_sets_share_a_key_and_pass_the_bound():
    r = random.Random(4)
    limit = Threshold(80, 100)
    sketch = np.random.default_rng(0).integers(0, 9, 4 << 16)
    for _ in range(300):
        n = r.randint(1, 80)
        a = np.unique(np.array([r.getrandbits(63) for _ in range(n)], np.uint64))
        b = np.unique(np.r_[a[r.randint(0, n // 5):], np.array([r.getrandbits(63) for _ in range(r.randint(0, n // 5))], np.uint64)])
        both = len(np.intersect1d(a, b))
        if limit.links(both, len(a), len(b)) and len(a) + len(b) > 2 * both:
            assert set(prefix(a, sketch, limit).tolist()) & set(prefix(b, sketch, limit).tolist())
            assert np.minimum(*_points([_packed(_point(x, _groups(len(x)))) for x in (a, b)])).sum() >= limit.needed(len(a) + len(b))


def test_points_fold_and_pack():
    tokens = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000).astype(np.uint64))
    wide, small = _point(tokens, _groups(len(tokens))), _point(tokens[:900], 64)
    assert len(wide) == 512 and wide.sum() == len(tokens)
    both = _points([_packed(wide), _packed(small)])
    assert (both[0] == _point(tokens, 64)).all() and (both[1] == small).all()
    assert (_points([_packed(np.array([300, 2], np.int32))]) == [[300, 2]]).all()


@pytest.mark.parametrize("top", [15, 16, 255, 256])
def test_points_pack_in_half_a_byte_or_more(top):
    points = np.array([[0, top, 3, 1], [1, 2, 0, 9]], np.int32)
    assert (_points([_packed(p) for p in points]) == points).all()
    assert len(_packed(np.full(64, top, np.int32))) == 1 + 64 * {15: 1, 16: 2, 255: 2, 256: 8}[top] // 2


@pytest.mark.parametrize("n", [300, 1000, 4000])
def test_sets_that_share_half_of_their_tokens_are_no_candidates(n):
    """They are far from a link; candidates among them would chain texts with a common passage into one cluster."""
    rng = np.random.default_rng(n)
    shared = rng.integers(0, 1 << 63, n // 2).astype(np.uint64)
    sets = [np.concatenate([shared, rng.integers(0, 1 << 63, n - n // 2).astype(np.uint64)]) for _ in range(60)]
    sets.append(np.r_[sets[0][:-n // 50], rng.integers(0, 1 << 63, n // 50).astype(np.uint64)])  # a near copy
    points = _points([_packed(_point(s, _groups(n, _FINE))) for s in sets])
    sizes = np.array([len(s) for s in sets])
    assert forest(points, sizes, Threshold(80, 100), np.zeros(len(sets))) == [(0, 60)]


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    points = rng.poisson(6, (900, 64)).astype(np.int32)
    points[1::2] = points[::2] + rng.integers(0, 2, points[::2].shape)
    points = points[np.argsort(points.sum(1), kind="stable")]
    sizes, limit = points.sum(1), Threshold(90, 100)
    tree = CountTree(points, sizes, limit)
    for k in range(0, 900, 7):
        bound = np.minimum(points, points[k]).sum(1)
        want = [j for j in range(k + 1, 900) if bound[j] >= limit.needed(sizes[k] + sizes[j]) and limit.smallest(int(sizes[j])) <= sizes[k]]
        assert tree.search(k).tolist() == want
    assert len(forest(points, sizes, limit, np.zeros(900))) <= 899


def test_few_words_are_one_sequence():
    assert len(shingles("a B")) == 1 and (shingles("a B") == shingles("A  b")).all()
    assert len(shingles("a b c")) == 1 and shingles("a b c")[0] not in shingles("a b")
    assert len(shingles(" \t\n")) == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 180)] + [(7, k) for k in range(8, 60)] + [(5, 5)]
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(df, "a", "b").collect()}
    assert got == {**{k: 100 for k in range(100, 181)}, **{k: 7 for k in range(7, 60)}, 5: 5}


def test_a_hot_group_is_in_many_tasks(spark):
    r = random.Random(8)
    rows = [(0, r.randint(1, 50), k) for k in range(3000)] + [(g, r.randint(1, 50), 5000 + g) for g in range(1, 20)]
    df = spark.createDataFrame(rows, "cluster long, n long, node long").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = _in_blocks(df, "cluster", F.col("n") * 8, 900).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = sorted((x for x in got if x.cluster == 0), key=lambda x: (x.n, x.node))
    tasks = [sum(x.task == t for x in hot) for t in {x.task for x in hot}]
    assert len(got) == len(rows) and len(tasks) > 2 and max(tasks) < 0.6 * len(hot)
    held = np.cumsum([x.n for x in hot])
    assert [x.block for x in hot] == [int((h - x.n) * 8 // 900) for h, x in zip(held, hot)]
    assert all(x.block == 0 for x in got if x.cluster)


def test_keys_with_the_same_classes_are_one_bucket(spark):
    rows = [(k, x, 5) for k in (1, 2) for x in (10, 11, 12)] + [(3, x, 5) for x in (10, 12)] + [(4, 10, 5), (4, 10, 5), (5, 13, 6)]
    df = spark.createDataFrame(rows, "key long, node long, n long").repartition(3)
    found = {}
    for x in _shared(df).collect():
        found.setdefault(x.bucket, []).append(x.node)
    assert sorted(map(sorted, found.values())) == [[10, 11, 12], [10, 12]]


@pytest.mark.parametrize("run", [1 << 20, 2])
def test_keys_meet_in_batches_of_any_size(run, monkeypatch):
    """Long and hot keys are buckets of their own; others are named by their classes, however batches are cut."""
    import pyarrow as pa
    monkeypatch.setattr(near_dup, "_RUN", run)
    rows = [(-5, 1, 9), (1, 10, 5), (1, 12, 5), (2, 10, 5), (2, 12, 5), (3, 7, 4), (4, 1, 2), (4, 1, 2), (5, 8, -6), (6, 8, -6), (6, 9, -6)]
    rows += [(7, x, 3) for x in range(20, 29)] + [(8, 10, 5), (8, 12, 5)]
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k:k + size])], ["key", "node", "n"])
                   for k in range(0, len(rows), size)]
        found = {}
        for b in _meet(batches):
            for node, n, bucket in zip(*(b.column(c).to_pylist() for c in ("node", "n", "bucket"))):
                assert n > 0
                found.setdefault(bucket, set()).add(node)
        # a pair that several keys share is one bucket; hot keys keep single rows
        assert sorted(map(sorted, found.values())) == [[8], [8, 9], [10, 12], list(range(20, 29))]


def test_hot_keys_lose_no_link(spark, monkeypatch):
    """Every key hot: rows are dealt by class and buckets named by key."""
    keys = near_dup._keys

    def hot(*args):
        run = keys(*args)

        def negative(batches):
            import pyarrow as pa
            for b in run(batches):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([-x for x in b.column(2).to_pylist()], pa.int64())], b.schema.names)
        return negative

    monkeypatch.setattr(near_dup, "_keys", hot)
    rows = family(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, 5, 80, 100).collect()), key=repr)
    assert got == brute(rows, 5, 80, 100)


def shuffled(df):
    """Bytes of rows that the exchanges of ``df``'s run took."""
    df.collect()

    def walk(plan):
        for name in ("executedPlan", "plan"):  # adaptive plans and their stages
            if name in dir(plan):
                return walk(getattr(plan, name)())
        own = plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0
        kids = plan.children()
        return own + sum(walk(kids.apply(k)) for k in range(kids.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_texts_that_link_with_nothing_are_not_shuffled(spark, monkeypatch):
    """Neither to get the sets of the candidates nor to leave out the copies."""
    import corpus_pipeline as cp
    r = random.Random(6)
    rows = [(k, " ".join(str(r.getrandbits(60)) for _ in range(200)), "en", "a", 1) for k in range(300)]
    rows += [(1000 + k, rows[k][1] + f" end{k}", "en", "a", 1) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    text, seen, keep = sum(len(x[1]) for x in rows), {}, near_dup.written

    def spy(df, name):
        if name == "links":
            seen[name] = shuffled(df)
        return keep(df, name)

    monkeypatch.setattr(near_dup, "written", spy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = cp.near_duplicates(spark, df, "")
        assert shuffled(got) < 0.2 * text and seen["links"] < 0.2 * text
        assert sorted(map(tuple, got.collect())) == sorted(x for x in rows if x[0] < 1000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("most", [1 << 26, 1 << 10])
def test_a_sieve_passes_every_key(spark, most):
    keys = [None, 0, -1, 1 << 62, *range(-3000, 3000, 7)]
    passes = sieve(spark.createDataFrame([(k,) for k in keys], "a long"), "a", most)
    other = spark.range(1 << 40, (1 << 40) + 5000).toDF("b")
    assert spark.createDataFrame([(k,) for k in keys], "b long").where(passes("b")).count() == len(keys)
    assert most < 1 << 26 or other.where(passes("b")).count() < 250
    assert other.where(sieve(other.limit(0), "b")("b")).count() == 0


def test_tables_on_the_way_are_removed(spark):
    import os

    from orderflow.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    df = spark.createDataFrame(family(2), "doc_id long, text string").repartition(3)
    rows = jaccard_components(df, 5, 80, 100)
    left = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before)
    assert left == ["found", "llm-classes", "llm-sets"] and rows.count() == 60
