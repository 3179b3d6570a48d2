"""Registered queries of the training-data operators, and their DuckDB twins."""

from __future__ import annotations

from orderflow.llm import oracle
from orderflow.llm.bpe import bpe_digests
from orderflow.llm.common import table
from orderflow.llm.merkle import tamper_check
from orderflow.llm.near_dup import jaccard_components
from orderflow.llm.packing import pack
from orderflow.llm.quality_classifier import classify_quality
from orderflow.llm.quality_rules import apply_rules
from orderflow.llm.search import top_k
from orderflow.llm.sharding import shard_documents
from orderflow.llm.token_counts import count_tokens
from orderflow.llm.token_files import token_file_round_trip
from orderflow.llm.toxicity import classify_toxicity
from orderflow.llm.vector_codes import compress
from orderflow.llm.warc import warc_round_trip


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's vocabulary file; the same on every executor."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_search(spark, sf_dir):
    """Best 10 documents by BM25 for every document whose id is divisible by 20, whole texts on both sides."""
    docs = table(spark, sf_dir, "documents")
    queries = docs.where("doc_id % 20 = 0").select(docs.doc_id.alias("query_id"), "text")
    return top_k(docs, queries, k=10)


def op2_ngram_jaccard(spark, sf_dir):
    """Components of all documents under 3-word shingle similarity of 0.9 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), 3, 90, 100)


def op3_quality_rules(spark, sf_dir):
    """Measures and verdicts of all documents; thresholds calibrated on the labels."""
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("failed_rules")


def op4_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens, mixed by source."""
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), keep_ids=False)


def op5_bpe(spark, sf_dir):
    """Every whole text encoded and decoded; digests of ids and text."""
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op6_quality(spark, sf_dir):
    """Quality score of every whole text; label 1 is predicted from 0.3."""
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.3)


def op7_toxicity(spark, sf_dir):
    """Toxicity score of every whole text; label 1 is predicted from 0.5."""
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.5)


def op8_sharding(spark, sf_dir):
    """All documents into 40 shards of near equal bytes, equal texts together."""
    return shard_documents(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    """All pages written as WARC transactions and read back."""
    return warc_round_trip(table(spark, sf_dir, "pages")) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark, sf_dir):
    """Unigram token count of every whole text."""
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_token_files(spark, sf_dir):
    """All documents written as ORC token files in doc_id order and read back."""
    return token_file_round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op12_vector_codes(spark, sf_dir):
    """Codes of all embeddings: 8 parts, 16 entries, 6 rounds."""
    vectors = table(spark, sf_dir, "embeddings")
    return compress(vectors.select("vec_id", vectors.embedding.alias("vec"), "label"))


def op13_merkle_manifest(spark, sf_dir):
    """Merkle proofs of all documents by source, checked against rows without their line breaks."""
    return tamper_check(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_search, op2_ngram_jaccard, op3_quality_rules, op4_packing, op5_bpe, op6_quality,
                                   op7_toxicity, op8_sharding, op9_token_counts, op10_warc, op11_token_files,
                                   op12_vector_codes, op13_merkle_manifest)}
ORACLE = {"op1_search": oracle.SEARCH, "op2_ngram_jaccard": oracle.JACCARD, "op10_warc": oracle.WARC,
          "op12_vector_codes": oracle.VECTOR_CODES, "op13_merkle_manifest": oracle.MERKLE}
