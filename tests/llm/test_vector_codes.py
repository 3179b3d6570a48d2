"""Integer product quantization against plain Python, and the transform's identities."""

import hashlib
import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm.vector_codes import (LIMIT, codebook_table, compress, encode_vectors, nearest, restore_sums, sequency_order,
                                        stage, train_codebooks, transform_parts)

SCHEMA = "vec_id long, vec array<float>, label int, node string"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The definition, entry by entry."""
    kept = [(i, v, lab) for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max([len(v) for _, v, _ in kept], default=0)
    length = -(-max(width, 1) // parts)
    cut = []
    for _, v, _ in kept:
        w = [max(-LIMIT, min(LIMIT, math.floor(float(np.float32(x)) * scale))) for x in v] + [0] * (parts * length - len(v))
        cut.append([w[p * length:(p + 1) * length] for p in range(parts)])
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, cut[k]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            row = []
            for p in range(parts):
                d = [sum((a - b) ** 2 for a, b in zip(c[p], e)) for e in books[p]]
                row.append((d.index(min(d)), min(d)))
            out.append(row)
        return out

    for _ in range(rounds):
        a = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, r in zip(cut, a) if r[p][0] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    a = assign()
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    errors = [sum(d for _, d in r) for r in a]
    by = {}
    for (_, _, lab), e in zip(kept, errors):
        by[lab] = by.get(lab, 0) + e
    fit = lambda x: x if x < 1 << 63 else None
    return [(i, "".join(f"{e:02x}" for e, _ in r), fit(err), fit(by[lab]), sha) for (i, _, lab), r, err in zip(kept, a, errors)]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in compress(df, **kw).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()]
    assert sorted(got, key=repr) == sorted(plain(rows, **kw), key=repr)


def vectors(n, dim, seed, spread=1.0):
    r = random.Random(seed)
    return [(k, [r.gauss(0, spread) for _ in range(dim)], r.choice([0, 1, None]), "x") for k in range(n)]


def test_equals_plain_python(spark):
    check(spark, vectors(150, 64, 1))
    check(spark, vectors(120, 40, 2), rounds=3)          # parts of 5, padded to 8
    check(spark, vectors(60, 16, 3), entries=5, rounds=2)


def test_odd_rows(spark):
    base = vectors(40, 16, 4)
    odd = [(100, None, 1, "x"), (101, [None] * 16, 1, "x"), (102, [float("nan")] * 16, 0, "x"), (103, [float("inf")] * 16, 0, "x"),
           (None, base[0][1], None, "x"), (7, base[7][1], 1, "x"), (104, [], 0, "x"), (105, [1.0], 0, "x"), (-5, base[3][1], 2, "x")]
    check(spark, base + odd)
    check(spark, base[:3])                               # fewer vectors than entries
    check(spark, [base[0]] * 30)                         # all equal: every tie goes to entry 0
    assert compress(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, [(1, None, 0, "x")])


def test_large_components(spark):
    rows = vectors(20, 16, 5, 1e6) + [(50, [3e38] * 16, 0, "x"), (51, [-3e38] * 16, 1, "x")]
    check(spark, rows, entries=4, rounds=2)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3), st.integers(1, 20), st.integers(0, 10 ** 6), st.sampled_from([3, 50, 10 ** 6, 1 << 40]))
def test_nearest_is_exact(logm, k, seed, size):
    r = np.random.default_rng(seed)
    length = int(r.integers(1, 2 ** logm + 1))
    x, c = r.integers(-size, size + 1, (30, length)), r.integers(-size, size + 1, (k, length))
    xt, ct = transform_parts(x.astype(object)), transform_parts(c.astype(object))
    code, dist, _ = nearest(xt.astype(np.int64), ct)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c] for u in x]
    assert code.tolist() == [w.index(min(w)) for w in want]
    assert [int(d) // xt.shape[1] for d in dist] == [min(w) for w in want]
    assert (restore_sums(xt, length) == x).all()


def test_sequency_and_elimination():
    order = sequency_order(8)
    h = transform_parts(np.eye(8, dtype=np.int64)).T        # rows: basis functions in order of sequency
    assert [(row[1:] != row[:-1]).sum() for row in h] == list(range(8)) and sorted(order) == list(range(8))
    r = np.random.default_rng(1)
    walk = r.integers(-9, 10, (500, 8)).cumsum(axis=1)      # smooth parts: energy in the first coordinates
    x, c = transform_parts(walk), transform_parts(walk[:16])
    _, _, left = nearest(x, c)
    assert left < 500 * 16 / 3                              # most entries are out after the first block


def test_codebooks_as_a_table(spark):
    staged = stage(spark.createDataFrame(vectors(30, 16, 6), SCHEMA))
    books = train_codebooks(staged, 4, 2)
    rows = codebook_table(spark, books).collect()
    assert len(rows) == 32 and all(books[r.part][r.entry] == list(r.components) for r in rows)
    assert encode_vectors(staged, books).count() == 30
