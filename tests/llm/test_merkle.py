"""Merkle manifest and multiproofs against a plain tree."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow.llm import merkle
from orderflow.llm.merkle import build, height, leaf_hash, missing_nodes, multiproofs, prove, tamper_check

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, strip=False):
    i, text, lang, source, n = row[:5]
    text = text.replace("\n", "") if strip and text is not None else text
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k:k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def climb(levels_, pos, value):
    proof = []
    for lv in levels_[:-1]:
        a, k = pos // 3 * 3, pos % 3
        run = lv[a:a + 3]
        proof += run[:k] + run[k + 1:]
        value = H(*run[:k], value, *run[k + 1:])
        pos //= 3
    return proof, value


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for pos, r in enumerate(groups[s]):
            strip = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            proof, value = climb(trees[s], pos, leaf(r, strip))
            more, value = climb(top, at, value)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], H(*proof, *more), value, value == top[-1][0]))
    return out


def check(spark, rows):
    got = [tuple(r) for r in tamper_check(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def rows_of(n, sources, seed):
    r = random.Random(seed)
    return [(k, r.choice(["a\nb", "x", "", "\n", "é\n漢"]), r.choice(["en", None]), r.choice(sources), r.choice([None, k]), "c", 1)
            for k in range(n)]


def test_odd_rows(spark, odd, odd_rows, none):
    got = [tuple(r) for r in tamper_check(odd).collect()]
    assert sorted(got, key=repr) == sorted(plain([r[:5] for r in odd_rows]), key=repr)
    assert tamper_check(none).count() == 0


@pytest.mark.parametrize("step", [1, 2])
def test_many_blocks_equal_a_plain_tree(spark, monkeypatch, step):
    """Blocks of 3 or 9 leaves, so that proofs cross blocks and trees take several rounds."""
    monkeypatch.setattr(merkle, "STEP", step)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** step)
    check(spark, rows_of(70, ["s", "s", "s", "t", None, "", "Z", "é"], 1))
    check(spark, rows_of(28, ["one"], 2))
    check(spark, rows_of(10, [f"s{k}" for k in range(40)], 3))
    check(spark, rows_of(1, ["one"], 4))


def test_one_block(spark):
    check(spark, rows_of(300, ["a", "a", "b", None], 5) + rows_of(5, ["a"], 5))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.data())
def test_multiproof_is_minimal(n, data):
    known = data.draw(st.sets(st.integers(0, n - 1), min_size=1, max_size=20))
    need = missing_nodes(sorted(known), n)
    have, size, at = set(known), n, 0
    fetched = set(need)
    while size > 1:   # every run with a derivable node is complete, and nothing fetched was derivable
        mine = {i for level, i in fetched if level == at}
        assert not mine & have
        runs = {i // 3 for i in have}
        assert {i for r in runs for i in range(3 * r, min(3 * r + 3, size))} == have | mine
        have, size, at = runs, -(-size // 3), at + 1
    assert have == {0} and all(level < height(n) for level, _ in need)


def test_proofs_of_some_leaves_fetch_little(spark):
    rows = rows_of(500, ["a", "b"], 6)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    m = build(spark.createDataFrame(rows, SCHEMA), leaf_hash(fields), "source", [F.col("doc_id")], {"doc_id": F.col("doc_id")})
    some = m.leaves.where("doc_id % 50 = 0").withColumn("altered", F.lit(None).cast("binary"))
    got = prove(m, some, ["doc_id"]).collect()
    want = {r[0]: r for r in plain(rows)}
    assert len(got) == 10
    for r in got:
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == want[r.doc_id][1:5] and r.verified
        assert H(*r.siblings) == r.proof_sha256
    fetched = multiproofs(m, some)
    assert fetched.count() < sum(len(r.siblings) for r in got)      # shared nodes come once
    wrong = some.withColumn("altered", F.unhex(F.sha2(F.lit("x").cast("binary"), 256)))
    assert not any(r.verified for r in prove(m, wrong, ["doc_id"]).collect())
