"""Toxicity: a subsequence-kernel support vector machine with Nyström landmarks.

The kernel of two words, each between marks of its ends, counts common
subsequences of four letters or marks that span at most six, weighted by a decay for each letter spanned, and is scaled to 1
for equal words; so an insult with characters put in between still matches, and
one of two or three letters by its marks. The kernel of two sentences is the
sum over their distinct words. Adjacent pieces of at most three letters, with any
blanks or signs between, may be a word broken up: what each run of them spells
is scored as a sentence of its own (:func:`spelled`); training goes by the
sentences as written. Landmarks are words of the labelled sample; the Nyström
map turns a sentence into kernel values against them, whitened by the
landmarks' own kernel matrix, and a linear SVM is trained on the map.

Labels are given by document: every sentence of a clean document is clean, and
of a toxic one the sentence with the highest margin is taken as toxic, in a few
rounds. A document's score is the calibrated margin of its worst sentence.

As the kernel is a sum over words and subsequences, the trained machine folds
into one weight per landmark subsequence: scoring a text needs no kernel matrix
and no shuffle, and words met lately are kept per Python worker.
"""

from __future__ import annotations

import re
import uuid
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import RecentCache, fitted, held_out, only, slices
from orderflow.session import ship_package

LENGTH, SPAN, DECAY = 4, 6, 0.6
# Both begin with the character to look for, so that a search skips to it: [.!?]+ before a blank or the end, or a
# line end; and what follows the first of four letters or more set apart by single blanks.
_SENTENCE = re.compile(r"[.!?\n](?:(?<=\n)|[.!?]*(?=\s|$))")
_SPACED = re.compile(r" (?<=[^\W\d_] )(?<!\S..)(?:[^\W\d_][ ]){2,}[^\W\d_](?!\w)")
_LETTERS = re.compile(r"[\W\d_]+")
_NO_LETTERS = re.compile(r"(?:[^\w\n]|[\d_])+")  # the same, line ends kept
LEAST = LENGTH - 2  # letters of a word that has a subsequence with its marks
SPELLED = 16  # letters that a run of short pieces may spell
_PIECES = re.compile(r"(?<![^\W\d_])[^\W\d_]{1,3}+(?:[\W\d_]++[^\W\d_]{1,3}+(?![^\W\d_]))+")
#: Letter positions after the first, and the weight of that choice.
_PICKS = [(c, DECAY ** (c[-1] + 1)) for c in combinations(range(1, SPAN), LENGTH - 1)]
LONGEST = 40  # words; a longer sentence is scored in windows of this many, each half over the one before


def _letters(word: str) -> str:
    """The letters of ``word``, all that its value depends on."""
    word = word.lower()
    return word if word.isalpha() else _LETTERS.sub("", word)


def subsequences(word: str) -> dict[str, float]:
    """Weighted gapped subsequences of the letters of ``word``."""
    letters = _letters(word)
    out: dict[str, float] = {}
    if len(letters) < LEAST:
        return out
    letters = f"<{letters}>"
    n = len(letters)
    for i in range(n - LENGTH + 1):
        first = letters[i]
        for (a, b, c), weight in _PICKS:
            if i + c < n:
                u = first + letters[i + a] + letters[i + b] + letters[i + c]
                out[u] = out.get(u, 0.0) + weight
    return out


def _unit(sub: dict[str, float]) -> dict[str, float]:
    norm = sum(v * v for v in sub.values()) ** 0.5
    return {u: v / norm for u, v in sub.items()} if norm else {}


def kernel(a: str, b: str) -> float:
    """Subsequence kernel of two words, 1 for equal ones of at least two letters."""
    x, y = _unit(subsequences(a)), _unit(subsequences(b))
    return sum(v * y.get(u, 0.0) for u, v in x.items())


def sentences(text: str) -> list[list[str]]:
    """Distinct words of each sentence; single letters set apart by blanks are one word.

    A sentence of more than LONGEST words is as many windows of that length,
    each overlapping the next by half: any LONGEST // 2 + 1 neighbours are in one.
    """
    text = _SPACED.sub(lambda m: m[0].replace(" ", ""), text)
    out = []
    for s in _SENTENCE.split(text):
        words = s.split()
        if len(words) <= LONGEST:
            out.append(list(dict.fromkeys(words)))
            continue
        for k in range(0, len(words) - LONGEST // 2, LONGEST // 2):
            out.append(list(dict.fromkeys(words[k:k + LONGEST])))
    return out


def spelled(text: str) -> list[str]:
    """Distinct words that two or more adjacent pieces of one to three letters spell, up to SPELLED letters.

    Pieces are split by anything but letters, line and sentence ends included.
    """
    out: dict[str, None] = {}
    for run in _PIECES.findall(text):
        pieces = _LETTERS.split(run)
        for i, word in enumerate(pieces):
            for piece in pieces[i + 1:i + SPELLED]:
                word += piece
                if len(word) > SPELLED:
                    break
                out[word] = None
    return list(out)


def parts(text: str) -> list[list[str]]:
    """What a document is scored by: its sentences, and each spelled word as one more."""
    text = text.lower()
    return sentences(text) + [[w] for w in spelled(text)]


def _code(sub: str) -> int:
    """Four letters up to U+FFFF as one number."""
    a, b, c, d = map(ord, sub)
    return a << 48 | b << 32 | c << 16 | d


class Machine:
    """A trained machine: weight of each landmark subsequence, bias, calibration."""

    def __init__(self, weights: dict[str, float], bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift
        self._keys = self._values = None

    def word(self, word: str) -> float:
        """A word's part in the margin."""
        sub, weights = subsequences(word), self.weights
        hit = sum(v * weights[u] for u, v in sub.items() if u in weights)
        return hit / sum(v * v for v in sub.values()) ** 0.5 if hit else 0.0

    def words(self, words: list[str]) -> list[float]:
        """:meth:`word` of many words at once, in arrays of words of equal length; words with letters above U+FFFF go one by one."""
        if not self.weights:
            return [0.0] * len(words)
        if self._keys is None:
            by_code = {_code(u): v for u, v in self.weights.items() if max(u) <= "\uffff"}
            self._keys = np.array(sorted(by_code), np.uint64)
            self._values = np.array([by_code[int(k)] for k in self._keys])
        lines = _NO_LETTERS.sub("", "\n".join(words).lower()).split("\n")  # the letters of all words in one pass
        if len(lines) != len(words):  # a word with a line end in it
            lines = [_letters(w) for w in words]
        place = {w: k for k, w in enumerate(dict.fromkeys(lines))}  # words of the same letters are valued once
        of = [place[w] for w in lines]
        known, out = list(place), np.zeros(len(place))
        size = np.fromiter(map(len, known), np.int64, len(known))
        one = np.zeros(len(known), bool)
        if not len(self._keys):
            one = size >= LEAST
        elif max(map(max, filter(None, known)), default="") > "\uffff":
            one = np.array([len(w) >= LEAST and max(w) > "\uffff" for w in known])
        for k in np.flatnonzero(one):
            out[k] = self.word(known[k])
        size[one] = 0
        order = np.argsort(size, kind="stable")
        order = order[np.searchsorted(size[order], LEAST):]
        for at in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            n = int(size[at[0]]) + 2 if len(at) else 1
            rows = max(1, 300_000 // (n * len(_PICKS)))
            for k in range(0, len(at), rows):
                out[at[k:k + rows]] = self._parts([known[i] for i in at[k:k + rows]], n)
        return out[of].tolist()

    def _parts(self, group: list[str], n: int) -> np.ndarray:
        x = np.empty((len(group), n), np.uint64)  # words between their marks
        x[:, 0], x[:, -1] = ord("<"), ord(">")
        x[:, 1:-1] = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).reshape(len(group), n - 2)
        codes, weights = [], []
        for (a, b, c), weight in _PICKS:
            if c < n:
                codes.append(x[:, :n - c] << np.uint64(48) | x[:, a:n - c + a] << np.uint64(32)
                             | x[:, b:n - c + b] << np.uint64(16) | x[:, c:])
                weights.append(np.full(n - c, weight))
        code, weight = np.concatenate(codes, 1), np.concatenate(weights)
        order = np.argsort(code, 1)
        code, weight = np.take_along_axis(code, order, 1), weight[order]
        new = np.ones(code.shape, bool)
        new[:, 1:] = code[:, 1:] != code[:, :-1]
        first = np.flatnonzero(new)
        value, code = np.add.reduceat(weight.ravel(), first), code.ravel()[first]
        row = np.searchsorted(first, np.arange(len(group)) * weight.shape[1])
        at = np.minimum(np.searchsorted(self._keys, code), len(self._keys) - 1)
        hit = np.where(self._keys[at] == code, self._values[at], 0.0) * value
        return np.add.reduceat(hit, row) / np.sqrt(np.add.reduceat(value * value, row))

    def margin(self, parts: list[list[str]], of) -> float:
        return self.bias + max([sum(map(of, words)) if len(words) != 1 else of(words[0]) for words in parts], default=0.0)

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35))))


def _landmarks(sample: list[tuple[int, str]], most: int) -> tuple[list[str], int]:
    """Words far more frequent in toxic documents than in clean ones, then clean words like them and
    common clean words; how many the first are."""
    clean: dict[str, int] = {}
    toxic: dict[str, list[int]] = {}
    for k, (y, text) in enumerate(sample):
        for w in {_letters(x) for s in sentences(text) for x in s}:
            if len(w) >= LEAST:
                if y:
                    toxic.setdefault(w, []).append(k)
                else:
                    clean[w] = clean.get(w, 0) + 1
    n_clean = max(1, sum(not y for y, _ in sample))
    n_toxic = max(1, sum(y for y, _ in sample))
    rate = {w: len(v) / n_toxic - 4 * clean.get(w, 0) / n_clean for w, v in toxic.items() if len(v) > 1 or n_toxic < 20}
    order = sorted((w for w, r in rate.items() if r > 0), key=lambda w: (-rate[w], w))
    # words that reach documents not yet covered five times come first, so that copies don't crowd out the rest
    seen: dict[int, int] = {}
    first, rest = [], []
    for w in order:
        fresh = sum(seen.get(k, 0) < 5 for k in toxic[w])
        (first if fresh > 0.3 * len(toxic[w]) else rest).append(w)
        if fresh > 0.3 * len(toxic[w]):
            for k in toxic[w]:
                seen[k] = seen.get(k, 0) + 1
    ranked = first + rest
    eighth = most // 8
    ranked = ranked[:most - 3 * eighth]
    # words of two or three letters would be nearly all of these
    often = sorted(clean, key=lambda w: (-clean[w], w))
    common = [w for w in often if len(w) >= LENGTH][:eighth]
    # clean words most like the toxic ones
    pull: dict[str, float] = {}
    for w in ranked:
        for u, v in _unit(subsequences(w)).items():
            pull[u] = max(v, pull.get(u, 0.0))
    known = sorted(clean)
    like = dict(zip(known, Machine(pull, 0.0, 1.0, 0.0).words(known)))
    alike = sorted(known, key=lambda w: (-like[w] * min(1.0, 0.5 + 0.1 * clean[w]), w))[:2 * eighth]
    return list(dict.fromkeys([*ranked, *alike, *common])), len(ranked)


def fit(sample: list[tuple[int, str]], landmarks: int = 160, rounds: int = 5, ridge: float = 1e-3,
        steps: int = 100, clean_rows: int = 20_000) -> Machine:
    """Train on (label, text) rows; without rows of both labels the score is the share of label 1.

    Each round trains on the worst sentence of every toxic document and on
    ``clean_rows`` sentences of clean documents: the hardest so far and others.
    """
    ones = sum(y for y, _ in sample)
    if not 0 < ones < len(sample):
        return Machine({}, 0.0, 0.0, 0.0 if not sample else (35.0 if ones else -35.0))
    marks, n_toxic_marks = _landmarks(sample, landmarks)
    m = len(marks)
    units = [_unit(subsequences(w)) for w in marks]
    index = {u: k for k, u in enumerate(dict.fromkeys(u for sub in units for u in sub))}
    table = np.zeros((len(index), m), np.float32)  # landmark subsequences x landmarks
    for j, sub in enumerate(units):
        for u, v in sub.items():
            table[index[u], j] = v

    def against(word: str) -> np.ndarray | None:
        """Kernel values of a word against the landmarks; None if all are 0."""
        sub = subsequences(word)
        hits = [(index[u], v) for u, v in sub.items() if u in index]
        if not hits:
            return None
        at, value = zip(*hits)
        return np.asarray(value, np.float32) @ table[list(at)] / sum(v * v for v in sub.values()) ** 0.5

    none = np.zeros(m, np.float32)
    own = np.array([none if (r := against(w)) is None else r for w in marks], float).reshape(m, m)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    whiten = vectors / np.sqrt(np.maximum(values, 0) + ridge) @ vectors.T
    # kernel values of every sentence that has any, in half precision; first the sentence without any
    # values of the words met lately, by their letters: words as written are many more
    words: dict[str, np.ndarray | None] = {}
    known = RecentCache(lambda new: [against(w) for w in new], limit=40_000)
    rows, owner = [none[None].astype(np.float16)], [-1]
    for k, (_, text) in enumerate(sample):
        held = []
        known.turn()
        for s in sentences(text):
            total = None
            for w in s:
                if w not in words:
                    if len(words) >= 50_000:
                        words.clear()
                    words[w] = known[_letters(w)]
                row = words[w]
                if row is not None:
                    total = row if total is None else total + row
            if total is not None:
                held.append(total)
        if held:
            rows.append(np.array(held).astype(np.float16))
            owner += [k] * len(held)
    raw, owner = np.concatenate(rows), np.array(owner)
    del rows, words

    def margins(weight: np.ndarray) -> np.ndarray:
        """Kernel values times ``weight``, a block of sentences at a time."""
        weight = weight.astype(np.float32)
        return np.concatenate([raw[k:k + 8192].astype(np.float32) @ weight for k in range(0, len(raw), 8192)])

    label = np.array([y for y, _ in sample])
    toxic_rows = np.flatnonzero((owner >= 0) & (label[owner] == 1))
    clean_all = np.flatnonzero((owner < 0) | (label[owner] == 0))
    margin = margins(np.arange(m) < n_toxic_marks)  # first guess: the kernel sum against the toxic landmarks
    order = np.random.default_rng(11).permutation(clean_all)
    wb = np.zeros(m + 1)
    for _ in range(rounds):
        ranked = toxic_rows[np.lexsort((-margin[toxic_rows], owner[toxic_rows]))]
        positive = ranked[np.r_[True, owner[ranked][1:] != owner[ranked][:-1]]] if len(ranked) else ranked
        hard = clean_all[np.argsort(-margin[clean_all], kind="stable")][:clean_rows // 2]
        negative = np.unique(np.r_[0, hard, order[:clean_rows - len(hard)]])
        use = np.r_[positive, negative]
        y = np.r_[np.ones(len(positive)), -np.ones(len(negative))].astype(np.float32)
        # squared hinge, each side half of the loss; accelerated gradient steps
        cost = np.where(y > 0, 0.5 / max(1, len(positive)), 0.5 / len(negative)).astype(np.float32)
        xs = np.c_[raw[use].astype(np.float32) @ whiten.astype(np.float32), np.ones(len(use), np.float32)]
        lam, prev = 1e-4, wb
        step = 1 / (2 * np.linalg.eigvalsh((xs * cost[:, None]).T @ xs)[-1] + lam)
        for t in range(steps):
            look = wb + t / (t + 3) * (wb - prev)
            gap = np.maximum(0, 1 - y * (xs @ look.astype(np.float32)))
            prev, wb = wb, look - step * (lam * np.r_[look[:-1], 0] - 2 * (cost * y * gap) @ xs)
        margin = margins(whiten @ wb[:-1]) + np.float32(wb[-1])
    folded = table @ (whiten @ wb[:-1])
    machine = Machine({u: float(folded[k]) for u, k in index.items()}, float(wb[-1]), 1.0, 0.0)
    worst = np.full(len(sample), float(wb[-1]))
    np.maximum.at(worst, owner[1:], margin[1:])
    machine.slope, machine.shift = _calibrate(worst, label)
    return machine


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label on the margin (Newton steps, smoothed targets)."""
    pos, neg = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        s = p * (1 - p)
        h = np.array([[(s * margin ** 2).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        move = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = 2500) -> Machine:
    """Fit on labelled rows outside the held-out fold.

    ``per_label`` bounds the rows of either label (in the order of their id's
    hash); equal texts count once for each label they bear. Only that sample
    meets the documents (a broadcast of so many ids); one task fits it, and the
    driver gets the machine. Null labels are ignored.
    """
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out("doc_id")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    one, zero = (usable.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (1, 0))
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(one.unionByName(zero)), "doc_id").select("label", F.coalesce("text", F.lit("")).alias("text")) \
        .distinct()
    return fitted(got, lambda rows: fit(sorted(zip(rows.column("label").to_pylist(), rows.column("text").to_pylist()))))


_WORDS: dict[int, RecentCache] = {}


def _score(sent, cut: float):
    def run(batches):
        machine: Machine = sent.value
        store = _store(sent)
        for batch in slices(batches, "text"):
            docs = [parts(t or "") for t in batch.column("text").to_pylist()]
            of = store.of(set().union(*(s for p in docs for s in p)))
            scores = [machine.score(machine.margin(p, of)) for p in docs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(x >= cut) for x in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])
    return run


def _store(sent) -> RecentCache:
    """Margins of words met lately under this machine; a worker keeps those of one machine."""
    if sent.id not in only(_WORDS):
        _WORDS.clear()
        _WORDS[sent.id] = RecentCache(sent.value.words, limit=300_000)
    return _WORDS[sent.id]


class _Sent:
    """A broadcast machine with an id that a worker can key its store by."""

    def __init__(self, broadcast, ident: str):
        self.broadcast, self.id = broadcast, ident

    @property
    def value(self):
        return self.broadcast.value


def _sent(spark, machine: Machine) -> _Sent:
    return _Sent(spark.sparkContext.broadcast(machine), uuid.uuid4().hex)  # bounded by the landmarks


def score(docs: DataFrame, machine: Machine, cut: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Null and empty texts score the machine's bias; null ids count as not held
    out; repeated rows are rows like any other; a score equal to ``cut`` is
    predicted 1; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = _sent(spark, machine)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"),
                       F.col("text").cast("string").alias("text")) \
        .mapInArrow(_score(sent, cut), "doc_id long, held_out boolean, score double, predicted int")


def classify_toxicity(docs: DataFrame, labels: DataFrame, cut: float = 0.5, per_label: int = 2500) -> DataFrame:
    """Train on ``labels`` and score ``docs``; see :func:`train` and :func:`score`."""
    return score(docs, train(docs, labels, "toxic", per_label), cut)


def _keep(sent, cut: float):
    def run(batches):
        machine: Machine = sent.value
        store = _store(sent)
        for batch in slices(batches, "text"):
            docs = [parts(t or "") for t in batch.column("text").to_pylist()]
            of = store.of(set().union(*(s for p in docs for s in p)))
            yield batch.filter(pa.array([machine.score(machine.margin(p, of)) < cut for p in docs], pa.bool_()))
    return run


def reject_toxic(docs: DataFrame, machine: Machine, cut: float = 0.5) -> DataFrame:
    """``docs``, all columns, without the rows that score ``cut`` or more."""
    ship_package(docs.sparkSession)
    return docs.mapInArrow(_keep(_sent(docs.sparkSession, machine), cut), docs.schema)
