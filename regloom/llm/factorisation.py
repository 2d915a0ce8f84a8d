"""Quality classifier: a factorisation machine on hashed words, structure statistics and the text's length.

Every text is a sparse vector: its distinct words hashed to buckets, sharing one unit of weight by how often they occur, and
one entry for each structure statistic, its step on a fixed scale. Besides a weight w_i each feature has a vector v_i of RANK
numbers, and the score is a logistic function of

    w_0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

where the pairs are summed in time linear in the entries: half of (sum_i v_i x_i)^2 - sum_i v_i^2 x_i^2, over all factors.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of hashed words, steps of a statistic, factors.
BUCKETS, STEPS, RANK = 2**15, 12, 8
#: The fit uses at most this many labelled texts, by hash of the id.
SAMPLE_DOCS = 20_000
#: From this score a text is called good.
GOOD = 0.3
PASSES, BATCH, RATE = 12, 256, 0.05
#: Shrinkage of weights and of factors.
RIDGE, RIDGE_FACTORS = 1e-5, 1e-4
_SEED = 13
#: Bytes of texts that are scored together.
GROUP = 1_000_000

#: Kinds of bytes whose shares are statistics; the first parts words.
_KINDS = [b" \t\n\x0b\x0c\r", b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?", b"!?", b"{}()[]/\\_=@", b"\n", bytes(range(128, 256))]
_IS_KIND = np.array([[c in kind for kind in _KINDS] for c in range(256)], dtype=float)
N_STATISTICS = len(_KINDS) + 6
N_FEATURES = BUCKETS + N_STATISTICS * (STEPS + 1)


def statistics(raw: bytes, words: list[bytes], counts: Counter) -> np.ndarray:
    """Numbers from 0 to 1: shares of kinds of bytes, of repeated lines and words, and sizes on a logarithmic scale."""
    held = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _IS_KIND
    n, size = max(1, len(words)), max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    number = dict(zip(counts, range(len(counts)), strict=True))
    order = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    runs = (order[:-2] * n + order[1:-1]) * n + order[2:]  # three words in a row; equal numbers by chance do no harm
    return np.array(
        [
            *np.sqrt(held / size),
            1 - len(set(lines)) / max(1, len(lines)),
            1 - len(np.unique(runs)) / max(1, len(runs)),
            len(counts) / n,
            min(1.0, (len(raw) - held[0]) / n / 24),
            min(1.0, np.log1p(n) / 12),
            min(1.0, np.log1p(len(raw) / max(1, len(lines))) / 12),
        ]
    )


def features(raw: bytes | None, buckets: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the features of a text in UTF-8. An empty text has its statistics alone. buckets: those known so far."""
    raw = raw or b""
    words = raw.split()  # by the same six characters as WORD
    counts = Counter(words)
    for w in counts:
        if w not in buckets:
            buckets[w] = zlib.crc32(w) % BUCKETS
    bucket = np.fromiter(map(buckets.__getitem__, counts), np.int64, len(counts))
    at, place = np.unique(bucket, return_inverse=True)
    value = np.sqrt(np.bincount(place, np.fromiter(counts.values(), float, len(counts)), len(at)) / max(1, len(words)))  # of length 1
    # a statistic lies between two steps and is shared by them
    x = statistics(raw, words, counts) * (STEPS - 1e-6)
    low = x.astype(int)
    base = BUCKETS + np.arange(N_STATISTICS) * (STEPS + 1) + low
    return np.concatenate([at, base, base + 1]), np.concatenate([value, 1 - (x - low), x - low])


def _all_features(texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    buckets: dict[bytes, int] = {}
    return [features(t, buckets) for t in texts]


class Machine:
    """Weights of a factorisation machine."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def logits(self, at: np.ndarray, value: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Of n texts, whose entries are (row, feature, value)."""
        x = value[:, None] * self.factors[at]
        sums = _summed(x, rows, n)
        squares = _summed((x**2).sum(1, keepdims=True), rows, n)[:, 0]
        return self.bias + _summed((value * self.weights[at])[:, None], rows, n)[:, 0] + 0.5 * ((sums**2).sum(1) - squares)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        return _chance(self.logits(*_stacked(_all_features(texts)), len(texts)))


def _summed(x: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the runs of equal, ascending rows; every text has entries."""
    return np.add.reduceat(x, np.searchsorted(rows, np.arange(n)), axis=0) if n else x[:0]


def _stacked(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = [len(a) for a, _ in found]
    at = np.concatenate([a for a, _ in found]) if found else np.empty(0, np.int64)
    value = np.concatenate([v for _, v in found]) if found else np.empty(0)
    return at, value, np.repeat(np.arange(len(found)), lengths)


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(found: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, passes: int = PASSES) -> Machine:
    """Logistic loss by AdaGrad over small batches, in a fixed order of chance. Both classes weigh as in the sample."""
    rng = np.random.default_rng(_SEED)
    share = np.clip(y.mean(), 0.01, 0.99)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(N_FEATURES), rng.normal(0, 0.05, (N_FEATURES, RANK)))
    seen_w, seen_v, seen_b = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, RANK), 1e-6), 1e-6
    for _ in range(passes):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), BATCH):
            own = order[begin : begin + BATCH]
            at, value, rows = _stacked([found[i] for i in own])
            x = value[:, None] * m.factors[at]
            sums = _summed(x, rows, len(own))
            slope = (_chance(m.logits(at, value, rows, len(own))) - y[own]) / len(own)
            g = slope[rows] * value
            known, place = np.unique(at, return_inverse=True)
            gw = np.bincount(place, g, len(known)) + RIDGE * m.weights[known]
            # d/dv of the pairs: x_i (sum_j v_j x_j - v_i x_i)
            each = g[:, None] * (sums[rows] - x)
            gv = np.stack([np.bincount(place, each[:, f], len(known)) for f in range(RANK)], axis=1) + RIDGE_FACTORS * m.factors[known]
            seen_w[known] += gw**2
            seen_v[known] += gv**2
            seen_b += slope.sum() ** 2
            m.weights[known] -= 2 * RATE * gw / np.sqrt(seen_w[known])
            m.factors[known] -= RATE * gv / np.sqrt(seen_v[known])
            m.bias -= RATE * slope.sum() / seen_b**0.5
    return Machine(m.bias, m.weights.astype(np.float32), m.factors.astype(np.float32))


def _fold(column: str):
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _all_features(batch.column(1).cast(pa.binary()).to_pylist())
        at = pa.array([a.tolist() for a, _ in found], pa.list_(pa.int32()))
        value = pa.array([v.tolist() for _, v in found], pa.list_(pa.float32()))
        yield pa.record_batch([batch.column(0).cast(pa.int32()), at, value], names=["y", "at", "value"])


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Machine | None:
    """Fit on at most sample_docs labelled texts outside the held-out fold (crc32 of the id as text, modulo 5, is 0).

    Labels that are null or have no id take no part; of several labels of one id the larger counts; ids of several texts
    give several examples. Null and empty texts are examples by their statistics. Without both classes there is no machine,
    so None; an empty table is such a case. Other columns are not read.
    """
    own = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(_fold("doc_id") != 0)
    own = own.groupBy("doc_id").agg(F.max("quality").alias("y")).orderBy(F.xxhash64("doc_id")).limit(sample_docs)
    read = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("doc_id", "y", "text")
    rows = read.select("y", "text").mapInArrow(_sample_features, "y int, at array<int>, value array<float>").toArrow()
    y = rows["y"].to_numpy()
    if len(np.unique(y)) < 2:
        return None
    at, value = rows["at"].combine_chunks(), rows["value"].combine_chunks()
    ends = at.offsets.to_numpy()
    found = list(zip(np.split(at.values.to_numpy(), ends[1:-1]), np.split(value.values.to_numpy(), ends[1:-1]), strict=True))
    return train(found, (y > 0).astype(float))


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score from 0 to 1 (higher: good likelier) and predicted (1 from GOOD) for every document; without a machine, 1.

    A null text is an empty one and scored too; null ids and repeated rows are rows of their own; equal texts have equal
    scores; whole texts are read, however long; other columns are not; an empty table gives an empty result.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if machine is None:
        return read.select("doc_id", F.lit(1.0).alias("score"), F.lit(1).alias("predicted"))
    kind = read.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # BUCKETS and RANK bound it: some MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            size = np.cumsum([len(t.as_py() or b"") for t in texts])
            group = np.flatnonzero(np.diff(size // GROUP, prepend=-1)).tolist()  # where a further GROUP of bytes begins
            s = [shared.value.scores(texts[a:b].to_pylist()) for a, b in zip(group, [*group[1:], len(texts)], strict=True)]
            s = np.concatenate(s) if s else np.empty(0)
            yield pa.record_batch([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= GOOD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return read.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
