"""Toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

The kernel compares words by their common subsequences of three letters, gaps allowed, each weighted by DECAY to the power
of the length it spans; so an insult with inserted or missing characters, or another ending, stays close to the insult.
Landmark words span the Nystroem feature space in which a linear SVM is trained on words of labelled texts. As every
landmark is a sum over subsequences, the trained machine folds into one table with a weight for each subsequence, and
scoring a word is a sum of table entries. A text's score is a calibrated function of its worst words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD

#: Letters a-z, two word ends, and classes for all other letters.
ALPHABET = 64
DECAY, REACH = 0.7, 6
LANDMARKS = 256
#: Times that hard negatives are added.
HARD_ROUNDS = 2
#: Longer words are scored in overlapping pieces.
LONGEST = 24
#: The fit uses at most this many labelled texts, by hash of the id, and at most this many words of each class.
SAMPLE_DOCS, WORDS_EACH = 20_000, 3000
#: Evidence a word needs to be a positive example: log-likelihood gain of its toxic occurrences.
EVIDENCE = 8.0
#: Kernel value from which words support each other.
ALIKE = 0.4
#: A margin near 1, the target of positive words.
SAFE = 0.8
#: Texts that a scoring task takes at a time, in characters.
_GROUP = 2_000_000
_START, _END = 27, 28
#: No letter lies beyond this code point.
LETTERS = 0x40000

_WORDS = re.compile(WORD)
_SPACED = re.compile(r"(?<!\S)\w(?:[ \t]\w){2,}(?!\S)")


def _codes() -> np.ndarray:
    """Code of each code point below LETTERS: 0 for what is not a letter."""
    table = np.zeros(LETTERS, dtype=np.uint8)
    for cp in range(LETTERS):
        c = chr(cp)
        if "a" <= c <= "z":
            table[cp] = cp - 96
        elif c.isalpha():
            table[cp] = 29 + cp % (ALPHABET - 29)
    return table


_CODES = _codes()
#: Offsets (j, k) of subsequences (0, j, k) and their weights.
_STEPS = list(combinations(range(1, REACH), 2))


def encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all words one after another, word ends included, and the length of each."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < LETTERS, _CODES[np.minimum(points, LETTERS - 1)], 0)
    word = np.repeat(np.arange(len(words)), lengths)
    keep = codes > 0
    codes, word = codes[keep], word[keep]
    n = np.bincount(word, minlength=len(words))
    out = np.zeros(len(codes) + 2 * len(words), dtype=np.int64)
    start = np.cumsum(n + 2) - (n + 2)
    out[start] = _START
    out[start + n + 1] = _END
    out[np.arange(len(codes)) + 2 * word + 1] = codes
    return out, n + 2


def _norm(n: int) -> float:
    """Length of the feature vector of a word of n distinct letters; it normalises the kernel."""
    return max(1e-9, sum(max(0, n - k) * DECAY ** (2 * (k + 1)) for _, k in _STEPS)) ** 0.5


_NORMS = np.array([_norm(n) for n in range(LONGEST + 3)])


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, code matrix) for each length; long words come in pieces."""
    codes, n = encoded(words)
    start = np.cumsum(n) - n
    for length in np.unique(n[n >= 3]):
        at = np.flatnonzero(n == length)
        if length <= LONGEST + 2:
            for a in range(0, len(at), 20_000):
                own = at[a : a + 20_000]
                yield own, codes[start[own][:, None] + np.arange(length)]
        else:
            for own in at.tolist():
                whole = codes[start[own] : start[own] + length]
                begin = np.r_[np.arange(0, length - LONGEST, LONGEST // 2), length - LONGEST]
                for a in range(0, len(begin), 20_000):
                    rows = whole[begin[a : a + 20_000, None] + np.arange(LONGEST)]
                    yield np.full(len(rows), own), rows


def subsequences(m: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Numbers of the subsequences in a code matrix, with their weights."""
    length = m.shape[1]
    pair = m[:, :-1] * ALPHABET
    for j, k in _STEPS:
        if length > k:
            yield (pair[:, : length - k] + m[:, j : length - k + j]) * ALPHABET + m[:, k:], DECAY ** (k + 1)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values of words and landmarks; a long word has those of its best pieces."""
    number, at, value = _sparse(landmarks)
    known = np.unique(number)
    table = np.zeros((len(known) + 1, len(landmarks)), dtype=np.float32)
    np.add.at(table, (np.searchsorted(known, number), at), value)
    out = np.zeros((len(words), len(landmarks)))
    for own, m in _by_length(words):
        for a in range(0, len(own), 64):
            rows = m[a : a + 64]
            total = np.zeros((len(rows), len(landmarks)))
            for index, weight in subsequences(rows):
                slot = np.minimum(np.searchsorted(known, index), len(known) - 1)
                slot = np.where(known[slot] == index, slot, len(known))
                total += weight * table[slot].sum(1)
            np.maximum.at(out, own[a : a + 64], total / _NORMS[m.shape[1]])
    return out


def _sparse(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(subsequence, word, value) of the normalised features of words."""
    number, at, value = [], [], []
    for own, m in _by_length(words):
        for index, weight in subsequences(m):
            number.append(index.ravel())
            at.append(np.repeat(own, index.shape[1]))
            value.append(np.full(index.size, weight / _NORMS[m.shape[1]]))
    return np.concatenate(number), np.concatenate(at), np.concatenate(value)


class Machine:
    """A folded SVM and the calibration of texts."""

    def __init__(self, table: np.ndarray, bias: float, calibration: np.ndarray):
        self.table, self.bias, self.calibration = table, bias, calibration

    def margins(self, words: list[str]) -> np.ndarray:
        best = np.full(len(words), -np.inf)
        for own, m in _by_length(words):
            length = m.shape[1]
            total = np.zeros(len(m))
            for index, weight in subsequences(m):
                total += self.table[index].sum(1) * weight
            np.maximum.at(best, own, total / _NORMS[length])
        return np.where(np.isfinite(best), best, -1.0) + self.bias

    def measures(self, texts: list[str]) -> np.ndarray:
        """For each text: 1, its two largest margins among distinct words, and how far these are into the safe side."""
        found = []
        for t in texts:
            t = t.lower()
            words = set(_WORDS.findall(t))
            words.update(re.sub(r"\s", "", x) for x in _SPACED.findall(t))
            found.append(words)
        every = list(set().union(*found)) if found else []
        margin = dict(zip(every, self.margins(every).tolist(), strict=True)) if every else {}
        out = np.empty((len(texts), 5))
        for row, words in zip(out, found, strict=True):
            m = [margin[w] for w in words]
            top = max(m, default=-2.0)
            if len(m) > 1:
                m.remove(top)
            next_ = max([*m, -2.0])
            row[:] = 1.0, max(top, -2.0), next_, 5 * max(0.0, top - SAFE), 5 * max(0.0, next_ - SAFE)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.measures(texts) @ self.calibration, -30, 30)))


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 60, c: float = 3.0) -> np.ndarray:
    """Linear SVM (squared hinge) by Newton steps on the active set; the last column of z is the bias."""
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(epochs):
        active = y * (z @ w) < 1
        za, wa = z[active], weight[active, None] * c
        new = np.linalg.solve(ridge + 2 * (za * wa).T @ za, 2 * (za * wa).T @ y[active])
        if np.allclose(new, w, atol=1e-7):
            break
        w = 0.5 * (w + new)
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _spread(words: list[str], n: int) -> list[str]:
    return [words[i] for i in np.unique(np.linspace(0, len(words) - 1, min(n, len(words))).astype(int))] if words else []


def train_words(positive: list[str], negative: list[str], landmarks: int = LANDMARKS) -> tuple[np.ndarray, float]:
    """The folded table and bias of an SVM on words. Landmarks are taken evenly from both lists, without words that come in pieces."""
    whole = lambda words: [w for w in words if len(w) <= LONGEST] or words[:1]
    pick = _spread(whole(positive), landmarks // 2)
    pick += _spread(whole(negative), landmarks - len(pick))
    value, vector = np.linalg.eigh(kernel(pick, pick))
    good = value > 1e-3
    root = vector[:, good] / np.sqrt(value[good])
    z = np.c_[kernel([*positive, *negative], pick) @ root, np.ones(len(positive) + len(negative))]
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    weight = np.where(y > 0, 0.5 / len(positive), 0.5 / len(negative)) * len(y)
    w = _svm(z, y, weight)
    number, at, amount = _sparse(pick)
    table = np.zeros(ALPHABET**3)
    np.add.at(table, number, amount * (root @ w[:-1])[at])
    return table.astype(np.float32), float(w[-1])


def _fold(column: str):
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5))


def _margins(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(machine.margins(batch.column(0).to_pylist()))], names=["word", "m"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Machine | None:
    """Fit on at most sample_docs labelled texts outside the held-out fold; None if a class is missing.

    Three fifths of the texts give the words, the rest calibrates. Copies and near copies among the texts count once: a
    text goes if an earlier one has the same least hash among its long words.
    """
    own = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(_fold("doc_id") != 0)
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id")).limit(sample_docs)
    part = F.when(F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5)) < 3, "words").otherwise("texts")
    read = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = read.join(F.broadcast(own.withColumn("part", part)), "doc_id")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    long_words = F.filter("words", lambda x: F.length(x) >= 8)
    least = F.array_min(F.transform(long_words, lambda x: F.xxhash64(x)))
    sample = sample.withColumn("words", words).withColumn("least", F.coalesce(least, F.xxhash64("doc_id")))
    sample = sample.withColumn("turn", F.row_number().over(W.partitionBy("least").orderBy("doc_id"))).where("turn = 1").cache()
    n = {(r["part"], r["toxic"]): r["n"] for r in sample.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()}
    nt, nc = n.get(("words", 1), 0), n.get(("words", 0), 0)
    if not nt or not nc:
        sample.unpersist()
        return None
    letters = F.transform("words", lambda x: F.regexp_replace(x, r"[^\p{L}]", ""))
    counts = sample.where("part = 'words'").select("toxic", F.explode(F.array_distinct(letters)).alias("word")).groupBy("word").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("c")
    ).cache()
    share = nt / (nt + nc)
    gain = F.col("a") * F.log(F.col("a") / (F.col("a") + F.col("c")) / share)
    strong = counts.where((gain >= EVIDENCE) & (F.col("a") * nc > 10 * F.col("c") * nt)).orderBy(gain.desc(), "word").limit(WORDS_EACH)
    plain = counts.where("c >= 2").where(F.col("a") * nc <= 2 * F.col("c") * nt).orderBy(F.xxhash64("word")).limit(WORDS_EACH)
    found, negative = strong.select("word", gain.alias("gain")).collect(), [r["word"] for r in plain.collect()]
    positive = [r["word"] for r in found]
    if positive:  # by chance a word may lack clean occurrences; without much evidence it needs others like it
        alike = (kernel(positive, positive) > ALIKE).sum(1) - 1
        positive = [r["word"] for r, n in zip(found, alike.tolist(), strict=True) if r["gain"] >= 2 * EVIDENCE or n >= 2]
    if not positive or not negative:
        sample.unpersist()
        return None
    machine = Machine(*train_words(positive, negative), np.zeros(5))
    clean = counts.where("c >= 2").where(F.col("a") * nc <= 2 * F.col("c") * nt).select("word")
    for _ in range(HARD_ROUNDS):  # clean words that look worst join the negatives
        hard = clean.mapInArrow(_margins(machine), "word string, m double").where("m > -0.8").orderBy(F.col("m").desc(), "word").limit(WORDS_EACH)
        negative = list(dict.fromkeys([*[r["word"] for r in hard.collect()], *negative]))
        machine = Machine(*train_words(positive, negative), np.zeros(5))
    kind = "toxic int, measures array<double>"

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = machine.measures(batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0).cast(pa.int32()), pa.array(m.tolist(), pa.list_(pa.float64()))], names=["toxic", "measures"])

    rows = sample.where("part = 'texts'").select("toxic", "text").mapInArrow(measured, kind).collect()  # at most sample_docs rows
    sample.unpersist()
    if rows:
        x, y = np.array([r["measures"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float)
        machine.calibration = _logistic(x, y)
    else:
        machine.calibration = np.array([0.0, 2.0, 0.0, 0.0, 0.0])
    return machine


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted for every document. Without a machine every score is 0.

    A null text is an empty one; null ids and repeated rows are rows of their own; other columns are not read; an empty
    table gives an empty result. Scores come from the text alone.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if machine is None:
        return read.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    kind = read.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ends = np.cumsum([len(t) for t in texts])
            s = [own.scores(texts[a:b]) for a, b in _cuts(ends)]
            s = np.concatenate(s) if s else np.empty(0)
            yield pa.record_batch([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return read.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, machine: Machine | None, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all columns, whose text scores below 0.5."""
    if machine is None:
        return docs
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            ends = np.cumsum([len(t) for t in texts])
            s = [own.scores(texts[a:b]) for a, b in _cuts(ends)]
            if s:
                yield batch.filter(pa.array(np.concatenate(s) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def _cuts(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        nxt = max(at + 1, int(np.searchsorted(ends, before + _GROUP)))
        yield at, nxt
        at = nxt
