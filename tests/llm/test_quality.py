"""Quality rules, the quality classifier, toxicity and the pipeline."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import quality_classifier as qc
from orderflow.llm import toxicity as tx
from orderflow.llm.common import held_out
from orderflow.llm.quality_rules import RULES, apply_rules, binomial_cdf, calibrate, measure


def _counts(text):
    x = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", x)
    five = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    many = Counter(five)
    repeated = {j for i, f in enumerate(five) if many[f] > 1 for j in range(i, i + 5)}
    lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(repeated)


def test_measures_equal_plain_python(spark, odd_rows, none, labels):
    r = random.Random(9)
    rows = [(i, t, "en") for i, t, *_ in odd_rows]
    rows += [(500 + k, "".join(r.choice(["a b ", "c ", "#x ", "\n", "a b c d e f ", "\t", "😀 ", "|", "a\n"]) for _ in range(r.randint(0, 60))), None)
             for k in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = apply_rules(df, labels).collect()
    want = sorted(((i,) + _counts(t) for i, t, _ in rows), key=repr)
    assert sorted(((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got), key=repr) == want
    assert all(x.base_failed == (x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words) for x in got)
    assert all(x.kept == (not x.base_failed) for x in got)  # no labels: no rule is certified
    assert apply_rules(none, labels).count() == 0


def test_binomial_sum_is_exact(spark):
    cases = [(k, n) for n in (1, 10, 500, 3000) for k in (0, 1, 5, 40) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long")
    for p in (0.001, 0.02, 0.3):
        for row in df.withColumn("c", binomial_cdf(F.col("k"), F.col("n"), p)).collect():
            logs = [math.lgamma(row.n + 1) - math.lgamma(j + 1) - math.lgamma(row.n - j + 1) + j * math.log(p) + (row.n - j) * math.log1p(-p)
                    for j in range(row.k + 1)]
            assert math.isclose(row.c, math.fsum(map(math.exp, logs)), rel_tol=1e-8, abs_tol=1e-300)


def test_certified_cutoffs_reject_bad_and_hold_the_bound(spark):
    r = random.Random(1)
    rows = []
    for k in range(4000):
        bad, lang = k % 10 == 0, "en" if k % 4 else "fr"
        words = [("w" if not bad else "###") + str(r.randint(0, 99_999)) for _ in range(20)]
        rows.append((k, " ".join(words), lang, 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    lab = df.select("doc_id", "quality")
    cut = {x.stratum: x for x in calibrate(measure(df), lab).collect()}
    assert cut["=en"].symbols is not None
    alpha = 0.05 / len(RULES)
    # too few good rows of the other language to certify anything: (1 - alpha) ** n is above delta / tests
    n = sum(1 for x in rows if x[2] == "fr" and x[3])
    assert ("=fr" in cut) == ((1 - alpha) ** n <= 0.05 / (2 * sum(len(c) for *_, c in RULES.values())))
    kept = {x.doc_id: x.kept for x in apply_rules(df, lab).collect()}
    en = [x for x in rows if x[2] == "en"]
    assert not any(kept[x[0]] for x in en if not x[3])
    assert sum(not kept[x[0]] for x in en if x[3]) <= 0.05 * sum(x[3] for x in en)


def _labelled(spark, n=400):
    r = random.Random(2)
    clean = [f"{a}{b}" for a in ("mar", "sol", "ten", "bri", "cal", "dor") for b in ("ona", "ish", "ent", "ule", "ard", "ico")]
    rows = []
    for k in range(n):
        toxic, bad = k % 3 == 0, k % 4 == 0
        s = [[r.choice(clean) for _ in range(r.randint(4, 9))] for _ in range(r.randint(2, 6))]
        if toxic:
            r.choice(s).insert(1, r.choice(["grubface", "snotbag", "zzplonker"]))
        text = ". ".join(" ".join(x) for x in s) + "."
        rows.append((k, text.upper() + " %%% !!" if bad else text, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")


def test_quality_classifier(spark, odd, none, labels):
    df = _labelled(spark)
    w = qc.train(df, df)
    got = qc.score(df, w).join(df, "doc_id").collect()
    assert np.mean([x.predicted == x.quality for x in got if x.held_out]) > 0.97
    strange = qc.score(odd, w).collect()
    assert len(strange) == odd.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in strange)
    assert qc.score(none, w).count() == 0
    assert qc.keep_good(odd, w).columns == odd.columns
    assert {x.score for x in qc.score(df, qc.train(df, labels)).collect()} == {0.5}
    same = qc.train(df, df)
    assert (same == w).all()


def test_held_out_labels_are_never_read(spark):
    df = _labelled(spark, 120)
    lie = df.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality"))) \
        .withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert (qc.train(df, df) == qc.train(df, lie)).all()
    a, b = tx.train(df, df), tx.train(df, lie)
    assert a.weights == b.weights and a.bias == b.bias


def test_toxicity(spark, odd, none, labels):
    df = _labelled(spark)
    machine = tx.train(df, df)
    got = tx.score(df, machine).join(df, "doc_id").collect()
    assert np.mean([x.predicted == x.toxic for x in got if x.held_out]) > 0.97
    words = ["snotbag", "s.n.o.t.b.a.g", "snoxtbag", "marona", "", "ab", "漢字漢字漢字"]
    assert np.allclose(machine.words(words), [machine.word(x) for x in words])
    hidden = spark.createDataFrame([(1, "marona solish s n o t b a g tenent."), (2, "marona g-r-u-b-f-a-c-e!"), (3, "marona solish tenent.")],
                                   "doc_id long, text string")
    assert [x.predicted for x in tx.score(hidden, machine).orderBy("doc_id").collect()] == [1, 1, 0]
    strange = tx.score(odd, machine).collect()
    assert len(strange) == odd.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in strange)
    assert tx.score(none, machine).count() == 0
    assert {x.predicted for x in tx.score(df, tx.train(df, labels)).collect()} <= {0, 1}


def test_short_and_broken_words_are_scored(spark):
    df = _labelled(spark)
    rows = [(r.doc_id, r.text.replace("snotbag", "oaf"), r.toxic) for r in df.collect()]
    machine = tx.train(*[spark.createDataFrame(rows, "doc_id long, text string, toxic int")] * 2)
    broken = ["oaf", "o a f", "o-a-f", "oa f", "zz plo nk er", "zzp lon ker", "gru bfa ce", "g  r  u  b  f  a  c  e", "g\tr\tu\tb\tf\ta\tc\te",
              "g\nr\nu\nb\nf\na\nc\ne", "g - r - u - b - f - a - c - e", "g.r u.b f.a c.e", "G. R. U. B. F. A. C. E."]
    texts = [f"marona solish {x} tenent." for x in broken] + ["marona solish tenent.", "marona an so it solish."]
    got = tx.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), machine).orderBy("doc_id").collect()
    assert [r.predicted for r in got] == [1] * len(broken) + [0, 0]
    assert tx.reject_toxic(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), machine).count() == 2


def test_letters_above_the_first_plane_are_told_apart():
    bold = "".join(chr(0x1D41A + ord(c) - 97) for c in "idiot")
    machine = tx.Machine({u: 1.0 for u in tx.subsequences(bold)} | {u: 0.5 for u in tx.subsequences("idiot")}, 0.0, 1.0, 0.0)
    low = "".join(chr(ord(c) & 0xFFFF) for c in bold)  # equal in the lower 16 bits
    words = [bold, low, "idiot", "marvel"]
    assert np.allclose(machine.words(words), [machine.word(w) for w in words])
    assert machine.word(bold) > 1 and machine.word(low) == 0


def test_neighbours_in_a_long_sentence_share_a_window():
    words = [f"w{k}" for k in range(200)]
    got = tx.sentences(" ".join(words))
    assert max(map(len, got)) <= tx.LONGEST and {w for s in got for w in s} == set(words)
    near = tx.LONGEST // 2 + 1
    assert all(any(set(words[k:k + near]) <= set(s) for s in got) for k in range(len(words) - near + 1))
    assert tx.sentences(" ".join(words[:40])) == [words[:40]] and len(tx.sentences(" ".join(words[:41]))) == 2
    machine = tx.Machine({u: 1.0 for u in tx.subsequences("snotbag")}, 0.0, 1.0, 0.0)
    at = [machine.margin(tx.parts(" ".join(words[:n] + ["snotbag", "snotbags"])), machine.word) for n in (38, 39, 58, 150)]
    assert np.allclose(at, at[0])


def test_quality_weights_do_not_depend_on_partitions(spark):
    df = _labelled(spark, 120)
    twist = df.where("doc_id < 30").withColumn("doc_id", F.col("doc_id") + 5000).withColumn("quality", 1 - F.col("quality"))
    both = df.unionByName(twist)  # equal texts under both labels
    first = qc.train(both.repartition(1), both)
    for n in (3, 7):
        assert (qc.train(both.repartition(n, "text"), both.repartition(n)) == first).all()


def test_a_worker_keeps_the_stores_of_one_operator():
    from orderflow.llm.common import only
    a, b = {"x": 1}, {"y": 2}
    assert only(a) is a and only(b) is b and a == {} and b == {"y": 2}
    a["z"] = 3
    assert only(a) == {"z": 3} and b == {}


def test_ftrl_equals_the_plain_rule():
    r = np.random.default_rng(2)
    rows = []
    for k in range(60):
        index = np.unique(r.integers(0, 1 << 6, 8))
        rows.append((k % 2, index, r.random(len(index))))
    got = qc.ftrl(rows, 6, epochs=3)
    size = (1 << 6) + 1
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.02 else -(z[i] - (0.02 if z[i] > 0 else -0.02)) / ((1.0 + n[i] ** 0.5) / 0.5 + 1.0)

    order = np.random.default_rng(7)
    for _ in range(3):
        for k in order.permutation(60):
            y, index, value = rows[k]
            x = [*zip(index.tolist(), value.tolist()), (size - 1, 1.0)]
            w = {i: weight(i) for i, _ in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = (p - y) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * w[i]
                n[i] += g * g
    assert np.allclose(got, [weight(i) for i in range(size)])


def test_spelled_words():
    assert tx.spelled("stu pid") == ["stupid"]
    assert tx.spelled("you st-up\n1 id") == ["youst", "youstup", "youstupid", "stup", "stupid", "upid"]
    assert tx.spelled("four ab letters cd") == [] == tx.spelled("")
    assert max(map(len, tx.spelled("a b c d e " * 2000))) == tx.SPELLED
    assert tx.kernel("oaf", "o.a.f") == pytest.approx(1) == tx.kernel("ab", "ab")
    assert not tx.subsequences("a")


def test_kernel_counts_gapped_subsequences():
    assert tx.kernel("idiot", "idiot") == pytest.approx(1)
    assert tx.kernel("idiot", "i.d.i.o.t") == pytest.approx(1)
    assert 0.2 < tx.kernel("idiot", "idxiot") < 1
    assert tx.kernel("idiot", "marvel") == 0
    word, sub = "<abcdab>", {}
    from itertools import combinations
    for at in combinations(range(len(word)), 4):
        if at[-1] - at[0] < tx.SPAN:
            u = "".join(word[i] for i in at)
            sub[u] = sub.get(u, 0) + tx.DECAY ** (at[-1] - at[0] + 1)
    assert tx.subsequences("abcdab") == pytest.approx(sub)


def test_pipeline_stages(spark, tmp):
    import corpus_pipeline as cp
    df = _labelled(spark, 160).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    copies = df.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 1000)
    docs = df.unionByName(copies)
    odd = spark.createDataFrame([(9000, None, None, None, None), (9001, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select(cp.COLUMNS).unionByName(odd)
    docs.write.parquet(f"{tmp}/documents.parquet")
    df.select("doc_id", "quality", "toxic").write.parquet(f"{tmp}/labels.parquet")
    assert len(cp.STAGES) in (4, 5)
    cur, sizes = spark.read.parquet(f"{tmp}/documents.parquet"), []
    truth = {r.doc_id: (r.quality, r.toxic) for r in df.collect()}
    for name, stage in cp.STAGES[:-1]:
        cur = stage(spark, cur, tmp)
        assert cur.columns == cp.COLUMNS
        path = f"{tmp}/{len(sizes)}"
        cur.write.parquet(path)
        cur = spark.read.parquet(path)
        sizes.append(cur.count())
    kept = {r.doc_id for r in cur.collect()}
    want = {i for i, (q, t) in truth.items() if q and not t}
    assert len(kept & want) > 0.95 * len(want) and not any(i >= 1000 for i in kept if i < 9000)
    assert len(kept - want - {9000, 9001}) <= 0.05 * len(truth)
    pieces = cp.run(spark, tmp)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept


def test_near_duplicates_keep_one_row_of_each_group(spark, tmp):
    import corpus_pipeline as cp
    one, two, three = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(5, one), (5, one), (5, two), (7, one + " end"), (3, two + " end"), (None, three), (None, three + " end"), (None, one), (None, two),
            (None, ""), (None, None), (8, ""), (8, " ")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = cp.near_duplicates(spark, docs, tmp)
    assert got.columns == cp.COLUMNS
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    last = [x for x in kept if x[0] is None and (x[1] or "").startswith("c0")]
    assert len(last) == 1 and last[0][1] in (three, three + " end")
    assert sorted([x for x in kept if x not in last], key=repr) == sorted([(5, one), (3, two + " end"), (None, ""), (None, None), (8, ""), (8, " ")], key=repr)


def test_pipeline_packing_holds_the_token_ids(spark, tmp):
    import zlib

    import corpus_pipeline as cp
    docs = spark.createDataFrame([(k, f"some words {k} " * 300 * k, "en", "s", 1) for k in range(6)] + [(9, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    rows = cp.packing(spark, docs, tmp).collect()
    assert {r.doc_id for r in rows} == {0, 1, 2, 3, 4, 5, 9}
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<i4").tobytes()) == r.ids_crc32 for r in rows)


def test_words_of_the_same_letters_are_valued_once(monkeypatch):
    """A word's value goes by its letters, however it is written."""
    machine = tx.Machine({u: 1.0 for u in tx.subsequences("idiot")}, 0.0, 1.0, 0.0)
    valued, parts = [], machine._parts
    monkeypatch.setattr(machine, "_parts", lambda group, n: valued.extend(group) or parts(group, n))
    words = ["idiot", "Idiot!", "i-d-i-o-t", "x", "", "id\niot", "fool,", "fool", "\u0391\u03a3."]
    assert machine.words(words) == pytest.approx([machine.word(w) for w in words])
    assert len(valued) == len(set(valued)) == 3


def test_a_fit_values_words_by_their_letters(monkeypatch):
    calls, real = [], tx.subsequences
    monkeypatch.setattr(tx, "subsequences", lambda w: calls.append(w) or real(w))
    sample = [(k % 2, f"word{k}, idiot" if k % 2 else f"(word{k}) fine") for k in range(200)]
    tx.fit(sample, landmarks=8)
    assert calls.count("word") <= 3 and not any(c.startswith("(") for c in calls)


def test_searches_split_as_written():
    sentence, spaced = re.compile(r"[.!?]+(?=\s|$)|\n"), re.compile(r"(?<!\S)(?:[^\W\d_][ ]){3,}[^\W\d_](?!\w)")
    rnd = random.Random(3)
    for _ in range(20_000):
        x = "".join(rnd.choice("ab  \u00e9\n.!?1_-\tZ") for _ in range(rnd.randint(0, 24)))
        assert tx._SENTENCE.split(x) == sentence.split(x)
        assert tx._SPACED.sub(lambda m: m[0].replace(" ", ""), x) == spaced.sub(lambda m: m[0].replace(" ", ""), x)
