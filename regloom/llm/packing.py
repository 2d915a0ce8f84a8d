"""Best-fit packing of tokenized documents into sequences of fixed capacity.

The packing is planned on the histogram of piece lengths, which has at most `capacity` entries whatever the corpus holds.
Pieces above a third of the capacity are matched greedily, at most two to a sequence; smaller ones, largest first, go
where they leave the smallest gap. The plan maps (length, rank among pieces of that length) to a sequence and an offset,
so Spark places every piece by its rank alone.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import salts, staged

CAPACITY = 2048
END_ID = 0
#: Strings that byte_bpe_50k.json maps to an id of their own wherever a text holds them.
SPECIAL = {"<|endoftext|>": 50256}
#: Vocabulary of byte_bpe_50k.json as ranks; the ids are the same.
VOCABULARY = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str = VOCABULARY):
    """The public byte-level BPE."""
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(capacity: int, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocabulary)

        def encode(text: str) -> list[int]:
            return own.encode(text, allowed_special="all") if any(s in text for s in SPECIAL) else own.encode_ordinary(text)

        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for column, value in zip(out, (doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        column.append(value)
            yield pa.record_batch(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *[pa.array(x, pa.int64()) for x in out[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def tokenized_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each piece; documents above the capacity are cut into full pieces behind a first one that may be shorter."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_pieces(capacity, vocabulary), PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Rows (length, rank, sequence, offset): from this rank on, pieces of this length go to consecutive sequences.

    The number of rows depends on the number of lengths, not on the number of pieces.
    """
    left = {n: c for n, c in histogram.items() if c}
    ranks = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, count); the next offset is capacity - gap
    sizes: list[int] = []  # the gaps there are, in order
    opened = 0

    def put(length: int, sequence: int, offset: int, count: int) -> None:
        rows.append((length, ranks[length], sequence, offset))
        ranks[length] += count
        left[length] -= count

    def add_gap(gap: int, sequence: int, count: int) -> None:
        if gap > 0 and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((sequence, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        count = left[a]
        i = bisect_left(large, capacity - a + 1) - 1  # the largest partner that fits
        if i < 0:
            put(a, opened, 0, count)
            add_gap(capacity - a, opened, count)
        else:
            b = large[i]
            count = min(count, left[b]) if a != b else count // 2
            if count:
                put(a, opened, 0, count)
                put(b, opened, a, count)
                add_gap(capacity - a - b, opened, count)
            else:  # one piece is left that fits only with its like
                large.pop(i)
                if i := bisect_left(large, capacity - a + 1):
                    large.insert(bisect_left(large, a), a)
                    b = large[i - 1]
                    put(a, opened, 0, 1)
                    put(b, opened, a, 1)
                    add_gap(capacity - a - b, opened, 1)
                else:
                    put(a, opened, 0, 1)
                    add_gap(capacity - a, opened, 1)
                count = 1
        opened += count
        large = [n for n in large if left[n]]

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            i = bisect_left(sizes, n)
            if i == len(sizes):
                each = min(capacity // n, left[n])
                count = left[n] // each
                for k in range(each):
                    put(n, opened, k * n, count)
                add_gap(capacity - each * n, opened, count)
                opened += count
                continue
            gap = sizes[i]
            sequence, runs = gaps[gap].pop()
            count = min(runs, left[n])
            put(n, sequence, capacity - gap, count)
            if count < runs:
                gaps[gap].append((sequence + count, runs - count))
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(i)
            add_gap(gap - n, sequence, count)
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), columns, strict=True)) | {"sequences": np.int64(opened)}


#: Ranks of one length stay below this.
_RANKS = 1 << 50


def _place(p: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = p["length"] * _RANKS + p["rank"]
        for batch in batches:
            t = pa.Table.from_batches([batch])
            length, rank = t["length"].to_numpy(), t["rank"].to_numpy()
            at = np.searchsorted(keys, length * _RANKS + rank, side="right") - 1
            t = t.drop_columns("rank").append_column("sequence_id", pa.array(p["sequence"][at] + rank - p["rank"][at]))
            yield from t.append_column("offset", pa.array(p["offset"][at])).combine_chunks().to_batches()

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to (doc_id, piece, start, length, ids_crc32) rows with lengths of 1 to capacity."""
    spark = pieces.sparkSession
    pieces = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts(spark))).cast("int"))
    cells = staged(pieces.groupBy("length", "cell").agg(F.count("*").alias("n")), "pack-cells")
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = W.partitionBy("length").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = W.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("at", F.row_number().over(inside) - 1).join(cells, ["length", "cell"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("at")).alias("rank"))
    return ranked.mapInArrow(_place(plan(histogram, capacity)), f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokenize all documents and pack them: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is an empty one and gives the end id alone; null ids and repeated rows are documents of their own; other
    columns are not read; an empty table gives an empty result.
    """
    return pack(staged(tokenized_pieces(docs, id_col, text_col, capacity, vocabulary), "pack-pieces"), capacity)
