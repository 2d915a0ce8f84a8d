"""Hard-negative mining with exact scores from a residue-number-system matrix product.

A score is an integer inner product. Each component matrix is reduced modulo several small primes; the residues, taken
symmetrically around 0, are multiplied as float32 matrices, which is exact while sums stay below 2^24; and the signed scores
come back from their residues by Chinese remaindering in mixed radix. A tile takes as many primes as its own largest norms
ask for, so scores are exact whatever the data.

Anchors and rows are dealt to blocks by hash of their id, and each pair of an anchor block and a row block is one tile. Two
passes over the tiles: the first finds each anchor's positives, the second its negatives within each positive's window; a
tile returns its own best few, and a window function picks the best of these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these shares of the positive's, in hundredths.
LOWEST, HIGHEST = 50, 95
#: A block holds a sixteenth of all rows, within these bounds; so does a block of anchors.
LEAST_BLOCK, MOST_BLOCK = 4096, 65_536
#: The largest norm of a scaled vector; 100 times the product of two such vectors fits in 64 bits.
MOST_NORM = 2**28
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
#: Float32 holds all integers up to this.
_EXACT = 2**24
#: Anchors and rows of a matrix product.
_ANCHORS, _ROWS = 128, 16_384


def primes_for(bound: int) -> tuple[int, ...]:
    """The fewest primes whose residues tell apart all integers from -bound to bound."""
    product = 1
    for n, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * bound:
            return PRIMES[:n]
    raise ValueError("scores are too large for the residue system")


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p as float32, from -(p-1)/2 to (p-1)/2."""
    r = x % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def _modulo(x: np.ndarray, p: int) -> np.ndarray:
    """Symmetric residue of integers held as float32, exact."""
    return x - p * np.rint(x / np.float32(p))


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p of residues; columns are taken in runs whose sums stay exact."""
    run = _EXACT // (p // 2) ** 2 - 1
    total = None
    for at in range(0, max(1, a.shape[1]), run):
        part = _modulo(a[:, at : at + run] @ b[:, at : at + run].T, p)
        total = part if total is None else _modulo(total + part, p)
    return total


def reconstructed(parts: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The integers with these symmetric residues, as int64, by mixed-radix digits."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        d = parts[i]
        for digit, q in zip(digits, primes, strict=False):  # p > 0 is prime to every q
            d = _modulo((d - digit) * np.float32(pow(q, -1, p)), p)
        digits.append(d)
    whole = np.zeros(parts[0].shape, dtype=np.int64)
    for digit, p in zip(reversed(digits), reversed(primes), strict=True):
        whole *= p
        whole += digit.astype(np.int64)
    return whole


class Rows:
    """Integer vectors and their residues."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norm = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(1).max(initial=0.0)))
        self._residues: dict[int, np.ndarray] = {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self._residues:
            self._residues[p] = residues(self.vectors, p)
        return self._residues[p]


def scores(anchors: Rows, rows: Rows, a: slice, r: slice) -> np.ndarray:
    """Exact inner products of some anchors and some rows."""
    primes = primes_for(int(anchors.norm * rows.norm * 1.000001) + 1)
    return reconstructed([product_modulo(anchors.modulo(p)[a], rows.modulo(p)[r], p) for p in primes], primes)


def first(score: np.ndarray, use: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores among those of use, whose places ascend with the ids; ties go to the first."""
    if len(use) > 4 * k:
        own = score[use]
        use = use[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return use[np.argsort(-score[use], kind="stable")[:k]]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Shorter vectors count as followed by zeros."""
    lists = column.combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(n), width), dtype=np.int64)
    out[np.arange(width) < n[:, None]] = lists.flatten().to_numpy()
    return out


def _width(*tables: pa.Table) -> int:
    return max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in tables)


def _tile(anchors: pa.Table, rows: pa.Table):
    """Both sides with rows in order of their ids."""
    rows = rows.sort_by("vec_id")
    width = _width(anchors, rows)
    return Rows(_matrix(anchors["v"], width)), Rows(_matrix(rows["v"], width)), rows["vec_id"].to_numpy(), rows["label"].to_numpy()


FOUND_POSITIVES = "anchor_id long, positive_id long, positive_score long"


def _positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(anchors) and len(rows):
            anchors = anchors.sort_by("label")
            a, r, ids, labels = _tile(anchors, rows)
            own_ids, own_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            for label in np.unique(own_labels):
                alike = np.flatnonzero(labels == label)
                r_alike = Rows(r.vectors[alike])
                mine = np.flatnonzero(own_labels == label)
                for at in range(mine[0], mine[-1] + 1, _ANCHORS):
                    group = slice(at, min(at + _ANCHORS, mine[-1] + 1))
                    for begin in range(0, len(alike), _ROWS):
                        s = scores(a, r_alike, group, slice(begin, begin + _ROWS))
                        id_ = ids[alike[begin : begin + _ROWS]]
                        for anchor, own in zip(own_ids[group].tolist(), s, strict=True):
                            best = first(own, np.flatnonzero(id_ != anchor), k)
                            out += [(anchor, i, x) for i, x in zip(id_[best].tolist(), own[best].tolist(), strict=True)]
        return _table(out, ["anchor_id", "positive_id", "positive_score"])

    return run


FOUND_NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _negatives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            a, r, ids, labels = _tile(anchors, rows)
            own_ids, own_labels, wanted = anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), anchors["positives"].to_pylist()
            for at in range(0, len(own_ids), _ANCHORS):
                for begin in range(0, len(ids), _ROWS):
                    block = slice(begin, begin + _ROWS)
                    s = scores(a, r, slice(at, at + _ANCHORS), block)
                    for i, own in enumerate(s, at):
                        low = min(-(-LOWEST * p["positive_score"] // 100) for p in wanted[i])
                        other = np.flatnonzero((own >= low) & (labels[block] != own_labels[i]))
                        for p in wanted[i]:
                            # whole numbers: ceil and floor of the window's ends
                            low, high = -(-LOWEST * p["positive_score"] // 100), HIGHEST * p["positive_score"] // 100
                            best = first(own, other[(own[other] >= low) & (own[other] <= high)], k)
                            for j, x in zip(ids[block][best].tolist(), own[best].tolist(), strict=True):
                                out.append((own_ids[i], p["positive_id"], p["positive_score"], j, x))
        return _table(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """vec_id, label, v: components to floor(256 x), one row for each id; what takes no part is left out (see hard_negatives)."""
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * SCALE))
    finite = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < MOST_NORM // SCALE))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.when(finite, x.cast("array<int>")).alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (norm < float(MOST_NORM) ** 2))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v")


def _best(found: DataFrame, keys: list[str], score: str, id_: str, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.col(score).desc(), id_))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`; an anchor's positives are its best others of the same label; a
    positive's negatives are the best rows of other labels whose score is 50 to 95 hundredths of the positive's. Higher
    scores come first, ties by smaller ids; fewer are returned where there are fewer, and a positive without a negative has
    no row.

    Rows with a null id, label or vector, a null or non-finite component, or a scaled norm of 2^28 or more (whose scores
    may not fit in 64 bits) take no part. Rows of one id count once: the one with the smallest label, then vector. Shorter
    vectors count as followed by zeros, an empty one as zeros. Other columns are not read; an empty table gives an empty
    result. label: the column of labels, "label" if not given.
    """
    n = vectors.count()
    size = min(MOST_BLOCK, max(LEAST_BLOCK, -(-n // 16)))
    blocks, anchor_blocks = max(1, -(-n // size)), max(1, -(-n // (every * size)))
    every_block = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    anchor_block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(anchor_blocks)).cast("int")
    whole = staged(whole_vectors(vectors, id_col, vector_col, F.col("label") if label is None else label), "vectors")
    rows = whole.select("vec_id", "label", "v", block.alias("b"), every_block(anchor_blocks).alias("a"))

    def tiles(anchors: DataFrame, run, schema: str) -> DataFrame:
        left = anchors.select("*", anchor_block.alias("a"), every_block(blocks).alias("b"))
        apart = left.toDF(*left.columns).groupBy("b", "a")  # under names of its own, as both sides stem from one table
        return apart.cogroup(rows.groupBy("b", "a")).applyInArrow(run, schema)

    anchors = whole.where(F.col("vec_id") % every == 0)
    near = _best(tiles(anchors, _positives(positives), FOUND_POSITIVES), ["anchor_id"], "positive_score", "positive_id", positives)
    own = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    found = tiles(anchors.join(own, "vec_id"), _negatives(negatives), FOUND_NEGATIVES)
    best = _best(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
