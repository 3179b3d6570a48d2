"""Token counts of a unigram tokenizer, without building the tokens.

An Aho-Corasick automaton over the vocabulary lists the pieces that end at
each position; dynamic programming keeps, for every prefix, the score of its
best segmentation and that segmentation's number of tokens. Ties go as in the
tokenizers library's unigram model: of equally good pieces that end at one
place the longest wins, and a character no piece covers alone is an unknown
piece that scores ten below the worst piece. Runs of unknown pieces count as
one token if the vocabulary has their string, else as their UTF-8 bytes
(byte fallback).

The text is cut before white-space marks that follow another character: no
piece has a mark there, so the best segmentation is that of the parts. Parts
met lately are kept per Python worker in bounded memory.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import RecentCache, slices
from orderflow.session import ship_package

MARK = "▁"
_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores, and the unknown piece's id, of a sentencepiece model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], sp.unk_id()


class CountViterbi:
    """Counts the tokens of the best segmentation under unigram scores."""

    def __init__(self, vocabulary: list[tuple[str, float]], unk_id: int):
        self.pieces = {p for p, _ in vocabulary}
        self.unk_score = min(s for _, s in vocabulary) - 10.0
        self.separable = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)
        self.auto = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            if piece:
                self.auto.add_word(piece, (len(piece), score, i == unk_id))
        self.auto.make_automaton()

    def _run(self, text: str) -> int:
        return 1 if text in self.pieces else len(text.encode())

    def count(self, s: str) -> int:
        n = len(s)
        ending: list[list] = [[] for _ in range(n + 1)]
        for end, match in self.auto.iter(s):
            ending[end + 1].append(match)
        best, tokens = [0.0] * (n + 1), [0] * (n + 1)
        run = [-1] * (n + 1)  # where the run of unknown pieces that ends here began
        for end in range(1, n + 1):
            top, size, unknown, single = None, 0, False, False
            for k, score, is_unk in ending[end]:  # longest first
                single |= k == 1
                here = best[end - k] + score
                if top is None or here > top:
                    top, size, unknown = here, k, is_unk
            if not single:
                here = best[end - 1] + self.unk_score
                if top is None or here > top:
                    top, size, unknown = here, 1, True
            best[end] = top
            if unknown:
                before = end - size
                run[end] = begin = run[before] if run[before] >= 0 else before
                tokens[end] = tokens[begin] + self._run(s[begin:end])
            else:
                tokens[end] = tokens[end - size] + 1
        return tokens[n]

    def parts(self, text: str) -> list[str]:
        """Stretches whose counts add up to the text's."""
        if not text:
            return []
        s = MARK + text.replace(" ", MARK)
        return _PART.findall(s) if self.separable else [s]


_MODELS: dict[str, tuple[CountViterbi, RecentCache]] = {}


def _model(path: str) -> tuple[CountViterbi, RecentCache]:
    if path not in _MODELS:
        v = CountViterbi(*read_vocabulary(path))
        _MODELS[path] = v, RecentCache(lambda new: [v.count(p) for p in new], limit=300_000)
    return _MODELS[path]


def _count(path: str):
    def run(batches):
        viterbi, store = _model(path)
        for batch in slices(batches, "text"):
            parts = [viterbi.parts(t or "") for t in batch.column("text").to_pylist()]
            of = store.of(set().union(*parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([sum(map(of, p)) for p in parts], pa.int64())], ["doc_id", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens`` of every whole text.

    Null and empty texts have no tokens; null ids and repeated rows are rows
    like any other; ties go by the tokenizer's rules; an empty table gives no
    rows; extra columns are ignored. ``model_path`` must be readable on every
    executor.
    """
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_count(model_path), "doc_id long, n_tokens long")
