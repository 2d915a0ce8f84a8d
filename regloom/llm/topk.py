"""Exact top-k search by inner product with paged M-trees.

Vectors are dealt to blocks by hash of their id, and each block holds an M-tree: pages of routing vectors with covering
radii and distances to their parents, and leaf pages with distances to their routing vector. A query block meets every
vector block once. Within a block the search is best-first: pages are opened in the order of their smallest possible
distance, and stored distances rule out pages and vectors by the triangle inequality before any distance is computed.

With one more component sqrt(M^2 - |x|^2) for a vector x and 0 for a query q, d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so the
nearest vectors are those with the largest inner products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 5
SCALE = 256
#: Vectors and queries of a block; entries of a page.
BLOCK, QUERY_BLOCK, PAGE = 8192, 4096, 256
_SLACK = 1e-9


class _Page:
    """A page: `at` are vectors (leaf) or its children's routing vectors; `to_parent` their distances to its own routing vector."""

    __slots__ = ("at", "vectors", "to_parent", "radius", "children")

    def __init__(self, at, vectors, to_parent, radius=None, children=None):
        self.at, self.vectors, self.to_parent, self.radius, self.children = at, vectors, to_parent, radius, children


class MTree:
    def __init__(self, vectors: np.ndarray, page: int = PAGE):
        self.vectors = vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.top = float(norms.max(initial=0.0))
        self.lift = np.sqrt(np.maximum(self.top - norms, 0.0))
        self.page = page
        self.computed = 0
        self.root = self._build(np.arange(len(vectors)), None)

    def _between(self, at: np.ndarray, pivot: int) -> np.ndarray:
        x = self.vectors[at] - self.vectors[pivot]
        return np.sqrt(np.einsum("ij,ij->i", x, x) + (self.lift[at] - self.lift[pivot]) ** 2)

    def _build(self, at: np.ndarray, pivot: int | None) -> _Page:
        if len(at) <= self.page:
            return _Page(at, self.vectors[at], np.zeros(len(at)) if pivot is None else self._between(at, pivot))
        n = min(self.page, -(-len(at) // self.page) + 1)
        pivots = at[np.linspace(0, len(at) - 1, n).astype(int)]
        x, p = self.vectors[at], self.vectors[pivots]
        near = (p**2).sum(1) + self.lift[pivots] ** 2 - 2 * (x @ p.T + np.outer(self.lift[at], self.lift[pivots]))
        owner = near.argmin(1)
        parts = [(int(pivots[i]), at[owner == i]) for i in range(n) if (owner == i).any()]
        if max(len(part) for _, part in parts) > 0.9 * len(at):  # mostly equal vectors: any even split will do
            parts = [(int(part[0]), part) for part in np.array_split(at, n)]
        radius = np.array([self._between(part, i).max() for i, part in parts])
        routing = np.array([i for i, _ in parts])
        to_parent = np.zeros(len(parts)) if pivot is None else self._between(routing, pivot)
        return _Page(routing, self.vectors[routing], to_parent, radius, [self._build(part, i) for i, part in parts])

    def _leaves(self, queries: np.ndarray, whole: np.ndarray) -> tuple[list[_Page], np.ndarray, np.ndarray]:
        """All leaf pages, the smallest possible distance of each query to each, and the distance to its routing vector."""
        pages, bounds, centres = [], [], []
        stack = [(self.root, np.zeros(len(queries)), np.full(len(queries), np.nan))]
        while stack:
            page, bound, centre = stack.pop()
            if page.children is None:
                pages.append(page)
                bounds.append(bound)
                centres.append(centre)
                continue
            d = np.sqrt(np.maximum(whole[:, None] - 2 * queries @ page.vectors.T, 0.0))
            self.computed += d.size
            for i, child in enumerate(page.children):
                stack.append((child, np.maximum(bound, d[:, i] - page.radius[i]), d[:, i]))
        return pages, np.stack(bounds, axis=1), np.stack(centres, axis=1)

    def search(self, queries: np.ndarray, k: int, ids: np.ndarray, own: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each query the k best (score, id) with an id other than its own; ties to smaller ids.

        Every query opens its pages best first. Queries that open the same page in a step share its distance computations,
        and entries that the stored distances rule out for all of them are skipped.
        """
        q = queries.astype(np.float64)
        whole = np.einsum("ij,ij->i", q, q) + self.top
        pages, bounds, centres = self._leaves(q, whole)
        order = np.argsort(bounds, axis=1, kind="stable")
        best: list[list[tuple[int, int]]] = [[] for _ in q]
        worst = np.full(len(q), -np.inf)
        reach = np.full(len(q), np.inf)  # distance of the k-th best so far, a little more
        active = np.arange(len(q))
        for step in range(len(pages)):
            page_of = order[active, step]
            active = active[bounds[active, page_of] <= reach[active]]  # later pages are farther still
            if not len(active):
                break
            page_of = order[active, step]
            for p in np.unique(page_of).tolist():
                page, group = pages[p], active[page_of == p]
                near = np.abs(centres[group, p][:, None] - page.to_parent) <= reach[group][:, None]
                use = near.any(0) | np.isnan(centres[group[0], p])
                rows, vectors = (page.at, page.vectors) if use.all() else (page.at[use], page.vectors[use])
                self.computed += len(rows) * len(group)
                dots = vectors @ q[group].T
                hopeful = np.flatnonzero(dots.max(0) >= worst[group])
                for i, score in zip(group[hopeful].tolist(), dots.T[hopeful], strict=True):
                    hope = np.flatnonzero(score >= worst[i])
                    if len(hope) > 4 * k:  # keep what can be among the k best, ties included
                        least = np.partition(score[hope], len(hope) - k - 1)[len(hope) - k - 1]
                        hope = hope[score[hope] >= least]
                    new = [(-int(s), int(d)) for s, d in zip(score[hope], ids[rows[hope]], strict=True) if d != own[i]]
                    best[i] = sorted([*best[i], *new])[:k]
                    if len(best[i]) == k:
                        worst[i] = -best[i][-1][0]
                        reach[i] = math.sqrt(max(0.0, whole[i] - 2 * worst[i])) * (1 + _SLACK) + _SLACK * math.sqrt(whole[i] + 1)
        return [[(-s, d) for s, d in b] for b in best]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components to floor(256 x); vectors that are null or hold null or non-finite components go."""
    for batch in batches:
        ids, out = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if i is None or not v.is_valid or v.values.null_count:
                continue
            x = np.floor(SCALE * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if np.isfinite(x).all():
                ids.append(i)
                out.append(x.astype("<f8").tobytes())
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])


def _matrix(bodies: list[bytes], width: int) -> np.ndarray:
    """Shorter vectors count as followed by zeros."""
    out = np.zeros((len(bodies), width))
    for row, b in zip(out, bodies, strict=True):
        row[: len(b) // 8] = np.frombuffer(b)
    return out


FOUND = "query_id long, vec_id long, score long"


def _search(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int]] = []
        if len(vectors) and len(queries):
            width = max(len(b) // 8 for b in [*vectors["v"], *queries["v"]])
            tree = MTree(_matrix(vectors["v"].tolist(), width))
            ids = vectors["vec_id"].to_numpy()
            own = queries["vec_id"].to_numpy()
            for q, found in zip(own.tolist(), tree.search(_matrix(queries["v"].tolist(), width), k, ids, own), strict=True):
                rows += [(q, i, score) for score, i in found]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible by `every` the k best others by inner product.

    Ties go to smaller ids. Vectors that are null or hold null or non-finite components, or have no id, take no part;
    repeated rows of an id count once if they are equal (else each is a candidate); shorter vectors count as followed by
    zeros; other columns are not read; an empty table gives an empty result. Scores are exact while they stay below 2^53.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    whole = rows.mapInArrow(_whole, "vec_id long, v binary").distinct()
    n = rows.count()
    blocks = max(1, -(-n // BLOCK))
    query_blocks = max(1, -(-n // (every * QUERY_BLOCK)))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    query_block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(query_blocks))
    side = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = whole.select("vec_id", "v", block.cast("int").alias("b"), side(query_blocks).alias("q")).groupBy("b", "q")
    right = whole.where(F.col("vec_id") % every == 0).select("vec_id", "v", side(blocks).alias("b"), query_block.cast("int").alias("q")).groupBy("b", "q")
    found = left.cogroup(right).applyInPandas(_search(k), FOUND)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
