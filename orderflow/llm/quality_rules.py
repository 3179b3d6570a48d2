"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each text is measured once (words, symbols, repeated lines, repeated word
windows, capitals); every rule rejects a document whose measure passes a
cutoff. Cutoffs are not chosen by hand: on labelled good documents, for every
stratum, rule and cutoff of a fixed grid, the exact binomial bound tells
whether the rate of false rejections can be held to be at most the rule's share
of ``alpha``; the chance of any wrong statement over all of them is at most
``delta`` (Bonferroni). Of the certified cutoffs of a stratum and rule the one
that separates the labelled bad documents best is used; without a certified
one the rule rejects nothing there. As the shares add up to ``alpha``, so do the
false rejections of all rules together.

Everything is row-wise but the calibration, whose input is one narrow row for
each labelled document and whose output is one row per stratum. Windows are
compared by hash inside the row; only texts with a repeated window are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import written

_BLANK = r"[\x20\x09-\x0D]+"

#: rule -> (measure, whether large values are bad, cutoffs from loose to strict)
RULES: dict[str, tuple[str, bool, list[float]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", True, [0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03]),
    "dup_lines": ("n_dup_lines / greatest(n_words, 1)", True, [0.2, 0.1, 0.05, 0.03, 0.02, 0.01]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", True, [0.19, 0.16, 0.13, 0.1, 0.07, 0.05]),
    "capitals": ("n_capitals / greatest(word_chars, 1)", True, [0.9, 0.7, 0.5, 0.35, 0.25, 0.18]),
    "long_words": ("word_chars / greatest(n_words, 1)", True, [20.0, 15.0, 12.0, 10.0, 9.0, 8.0]),
    "short_words": ("word_chars / greatest(n_words, 1)", False, [1.5, 2.0, 2.5, 3.0, 3.5, 4.0]),
}


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, stratum, text_key`` and the counts of every whole text; one narrow row a document.

    Null texts count as empty; null strata are a stratum of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("stratum"),
                       text.alias("text"))
    words = base.select(
        "doc_id", "stratum", F.xxhash64("text").alias("text_key"),
        F.array_remove(F.split("text", _BLANK), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"))
    n = F.size("words")
    windows = words.select(
        "doc_id", "stratum", "text_key", "n_symbols", "n_capitals",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 6, F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(
            *[F.get("words", i + k) for k in range(5)]))).otherwise(F.array().cast("array<bigint>")).alias("hashes"))
    # (hash, place) in order, for texts in which a window occurs twice
    ranked = windows.withColumn("twice", F.size(F.array_distinct("hashes")) < F.size("hashes")).withColumn(
        "ranked", F.when(F.col("twice"), F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))))
        .otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))).drop("hashes")
    places = ranked.withColumn("places", F.when(F.col("twice"), F.sort_array(F.filter(F.transform(
        "ranked", lambda x, i: F.when((x["h"] == F.get("ranked", i - 1)["h"]) | (x["h"] == F.get("ranked", i + 1)["h"]), x["at"])),
        lambda at: at.isNotNull()))).otherwise(F.array().cast("array<int>"))).drop("ranked")
    covered = F.aggregate(F.transform("places", lambda at, i: F.least(
        F.lit(5), F.coalesce(F.get("places", i + 1) - at, F.lit(5)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return places.withColumn("n_repeat_words", F.when(F.col("twice"), covered).otherwise(F.lit(0).cast("long"))) \
        .select("doc_id", "stratum", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words", "n_capitals",
                ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exactly summed in log space by a native fold."""
    from math import log, log1p
    start = n * F.lit(log1p(-p))
    odds = log(p) - log1p(-p)

    def step(acc, j):
        term = acc["term"] + F.log((n - j + 1) / j) + F.lit(odds)
        top, low = F.greatest(term, acc["total"]), F.least(term, acc["total"])
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(low - top))).alias("total"))

    folded = F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
                         F.struct(start.cast("double").alias("term"), start.cast("double").alias("total")), step)
    return F.exp(folded["total"])


def calibrate(measured: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per stratum: ``stratum`` and, for each rule, its cutoff (null: the rule is off).

    Labels other than 0 and 1 are ignored, equal texts count once, and so do
    repeated labels. Documents that fail the base rules are not counted: they
    go whatever the cutoffs are.
    """
    labelled = measured.where("not base_failed").join(
        labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), "quality").distinct(),
        "doc_id").dropDuplicates(["stratum", "text_key", "quality"])
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    counts = [F.sum(good.cast("long")).alias("good"), F.sum(bad.cast("long")).alias("bad")]
    cells = []
    for rule, (expr, large, cutoffs) in RULES.items():
        for k, cut in enumerate(cutoffs):
            reject = (F.expr(expr) > cut) if large else (F.expr(expr) < cut)
            counts += [F.sum((good & reject).cast("long")).alias(f"g_{rule}_{k}"),
                       F.sum((bad & reject).cast("long")).alias(f"b_{rule}_{k}")]
            cells.append(F.struct(F.lit(rule).alias("rule"), F.lit(k).alias("strict"), F.lit(float(cut)).alias("cut"),
                                  F.col(f"g_{rule}_{k}").alias("g"), F.col(f"b_{rule}_{k}").alias("b")))
    strata = written(labelled.groupBy("stratum").agg(*counts), "rule-counts")
    each = strata.crossJoin(strata.agg(F.count("*").alias("strata"))) \
        .select("stratum", "good", "bad", "strata", F.explode(F.array(*cells)).alias("c")).select("stratum", "good", "bad", "strata", "c.*")
    risk = alpha / len(RULES)
    tests = F.col("strata") * len(cells)
    sure = (F.col("g") < F.col("good") * risk) & (F.col("b") > 0)  # the sum is short where it is needed
    passed = each.where(sure).where(binomial_cdf(F.col("g"), F.col("good"), risk) <= F.lit(delta) / tests)
    gain = F.col("b") / F.greatest("bad", F.lit(1)) - F.col("g") / F.greatest("good", F.lit(1))
    return passed.groupBy("stratum").pivot("rule", list(RULES)).agg(F.max_by("cut", F.struct(gain, -F.col("strict"))))


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Measures, base verdict and ``kept`` of every document.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, failed_rules``. Null and empty texts
    have zero counts and fail the base rules; null ids and repeated rows are
    rows like any other (a null id has no label); a measure equal to a cutoff
    passes; without labels no rule rejects; an empty table gives no rows; extra
    columns are ignored.
    """
    measured = written(measure(docs), "measures")
    cutoffs = calibrate(measured, labels, alpha, delta)
    fails = F.array_compact(F.array(*[
        F.when((F.expr(expr) > F.col(rule)) if large else (F.expr(expr) < F.col(rule)), F.lit(rule))
        for rule, (expr, large, _) in RULES.items()]))
    return measured.join(cutoffs, "stratum", "left").withColumn("failed_rules", fails).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules")
