"""The corpus pipeline: two classifiers, one document of each near-duplicate group, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; its result is written as Parquet and read again. All but the last return
the columns of ``documents`` (extra ones are dropped). Rows whose text is null
count as empty texts, which the filters score like any other; repeated rows are
judged one by one; a score at the cut is toxic, or good; an empty table gives
no rows.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import quality_classifier, toxicity
from orderflow.llm.common import sieve, table, written
from orderflow.llm.near_dup import jaccard_components
from orderflow.llm.packing import pack
from orderflow.llm.queries import vocabulary
from orderflow.session import scoped

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine (operator 7) doesn't call toxic."""
    machine = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs.select(COLUMNS), machine, cut=0.5)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram classifier (operator 6) calls good."""
    weights = quality_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs.select(COLUMNS), weights, cut=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar documents (operator 2; five words, similarity 0.8).

    That with the smallest id stays, one without an id only if no row of its
    group has one; rows that repeat an id go by the hash of their text, equal
    ones by their place. Rows without words are in no group and stay.
    """
    rows = written(docs.select(COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = written(jaccard_components(rows.select(F.col("row").alias("doc_id"), "text"), width=5, num=80, den=100), "groups")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("hash"), "row")
    stay = found.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", first.alias("first")), "row") \
        .groupBy("component_id").agg(F.min("first").alias("first")).select("first.row")
    drop = written(found.select(F.col("doc_id").alias("row")).join(stay, "row", "left_anti"), "drop")
    # texts are shuffled for the rows that may have to go only
    may_go = sieve(drop, "row")("row")
    return rows.where(~may_go).unionByName(rows.where(may_go).join(drop, "row", "left_anti")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, mixed by source (operator 4); one row per piece, with its token ids."""
    return pack(docs, vocabulary("word_bpe_49k.json"), keep_ids=True)


STAGES = [("toxicity", toxicity_filter), ("quality classifier", quality_filter),
          ("n-gram Jaccard join", near_duplicates), ("packing", packing)]

#: SQL can't express the classifiers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows. What a stage writes on its way is removed once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        step = partial(stage, spark, docs, sf_dir)
        docs = scoped(spark, f"pipeline-{k}", step) if k < len(STAGES) - 1 else step()
    return docs
