"""Sharding by minimax contiguous partition, in DataFrame functions only.

Documents with equal texts form one atomic group. Groups stand in the order of their text's MD5, and running byte
totals over that order are kept in a table. The smallest shard capacity for which a greedy left-to-right filling needs
no more than n_shards shards is found by search; each greedy step is an aggregate over the table for many capacities at
once. The driver holds one running total for each of 4096 ranges of the order, however many documents there are.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import salts, staged, text_or_empty

#: Ranges of the group order: the first three hex digits of the MD5.
RANGES = 4096
#: Capacities tried in one pass.
TRIED = 500


class _Totals:
    """Running byte totals over the ordered groups, with lookups for many positions in one job."""

    def __init__(self, groups: DataFrame):
        self.groups = groups.select("rng", "end")
        per = {r["rng"]: r["b"] for r in groups.groupBy("rng").agg(F.sum("bytes").alias("b")).collect()}
        self.base = [0]
        for i in range(RANGES):
            self.base.append(self.base[-1] + per.get(i, 0))
        self.total = self.base[-1]

    def ends(self, targets: list[int]) -> list[int]:
        """For each target the largest running total that is not above it."""
        where = [min(bisect_right(self.base, t) - 1, RANGES - 1) for t in targets]
        asked = self.groups.sparkSession.createDataFrame(
            pa.table({"i": range(len(targets)), "rng": pa.array(where, pa.int32()), "target": pa.array(targets, pa.int64())})
        )
        found = (
            self.groups.join(F.broadcast(asked), "rng").where(F.col("end") <= F.col("target")).groupBy("i").agg(F.max("end").alias("e"))
        )
        got = {r["i"]: r["e"] for r in found.collect()}
        return [got.get(i, self.base[r]) for i, r in enumerate(where)]

    def feasible(self, capacities: list[int], n: int) -> list[bool]:
        """Whether greedy filling up to each capacity needs at most n shards."""
        at = {c: 0 for c in capacities}
        good: set[int] = set()
        for _ in range(n):
            good |= {c for c, p in at.items() if p + c >= self.total}
            open_ = [c for c in at if c not in good]
            if not open_:
                break
            at.update(zip(open_, self.ends([at[c] + c for c in open_]), strict=True))
        return [c in good for c in capacities]

    def by_ranges(self, start: int, capacity: int, n: int, whole: bool) -> bool:
        """Greedy filling that cuts at the ends of ranges only, without a job.

        whole: cuts stand before the point that fits, so True is certain. Otherwise they stand after it, so False is.
        """
        at = start
        for _ in range(n):
            if at + capacity >= self.total:
                return True
            r = bisect_right(self.base, at + capacity)
            nxt = self.base[r - 1] if whole else self.base[r]
            if nxt <= at:
                return False
            at = nxt
        return False


def smallest_capacity(totals: _Totals, largest: int, n: int) -> int:
    """The smallest feasible capacity. A capacity of the mean plus the largest group is always feasible.

    Two binary searches over ranges bound it on the driver; then each pass over the groups tries many capacities.
    """
    low = max(largest, -(-totals.total // n))
    high = max(low, min(totals.total, -(-totals.total // n) + largest))

    def first(lo: int, hi: int, good) -> int:
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if good(mid) else (mid + 1, hi)
        return lo

    low = first(low, high, lambda c: totals.by_ranges(0, c, n, whole=False))
    high = first(low, high, lambda c: totals.by_ranges(0, c, n, whole=True))
    while low < high:
        step = max(1, (high - low) // (TRIED + 1))
        tried = sorted({min(high - 1, low + step * i) for i in range(TRIED)} | {low, high - 1})
        good = totals.feasible(tried, n)
        i = next((i for i, g in enumerate(good) if g), None)
        if i is None:
            return high
        high = tried[i]
        low = tried[i - 1] + 1 if i else high
    return high


def cut_points(totals: _Totals, capacity: int, n: int) -> list[int]:
    """Byte positions that end the shards 0 to n-2.

    A shard ends at what is left for it on average if the rest surely fits the capacity then; else it is filled to it.
    With groups far larger than the mean, this spreads the small ones over all other shards.
    """
    cuts, at = [], 0
    for k in range(n - 1):
        left = n - k
        even = at + -(-(totals.total - at) // left)
        full, level = totals.ends([min(totals.total, at + capacity), min(totals.total, even)])
        # level is at where the next group alone is above the average left; it is taken with what else the capacity holds
        at = level if level > at and totals.by_ranges(level, capacity, left - 1, whole=True) else full
        cuts.append(at)
    return cuts


def _shard(start: Column, cuts: list[int]) -> Column:
    return sum((F.when(start >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")


def shard_documents(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal all documents into n_shards shards of near-equal bytes; equal texts stay together.

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law ('bytes'), shard, slot (gapless from 0 in its shard),
    grown_shard (null: it belongs to another law). A null text counts as empty; null ids and repeated rows are rows like
    others; other columns are not read; an empty table gives an empty result. A group above the mean fills a shard of
    its own beyond the mean, as groups are atomic.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("grp"),
            F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts(spark))).cast("int").alias("salt"),
        ),
        "shard-rows",
    )
    # A hot text's rows meet in cells of (text, salt) first, so nothing gathers all of its copies.
    cells = rows.groupBy("grp", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    by_range = W.partitionBy("rng").orderBy("grp").rowsBetween(W.unboundedPreceding, 0)
    grouped = staged(
        cells.groupBy("grp").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        .withColumn("rng", F.conv(F.substring("grp", 1, 3), 16, 10).cast("int")),
        "shard-groups",
    )
    ranges = grouped.groupBy("rng").agg(F.sum("bytes").alias("rb"), F.sum("n").alias("rn"))
    before = W.orderBy("rng").rowsBetween(W.unboundedPreceding, -1)  # 4096 rows at most
    ranges = ranges.select(
        "rng", F.coalesce(F.sum("rb").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("rn").over(before), F.lit(0)).alias("n0")
    )
    groups = staged(
        grouped.join(F.broadcast(ranges), "rng").select(
            "grp", "rng", "bytes",
            (F.sum("bytes").over(by_range) + F.col("b0")).alias("end"),
            (F.sum("n").over(by_range) - F.col("n") + F.col("n0")).alias("rows_before"),
        ),
        "shard-prefix",
    )
    largest = groups.agg(F.max("bytes")).first()[0] or 0
    totals = _Totals(groups)
    cuts = cut_points(totals, smallest_capacity(totals, largest, n_shards), n_shards) if largest else []
    placed = groups.withColumn("shard", _shard(F.col("end") - F.col("bytes"), cuts))
    first = {r["shard"]: r["m"] for r in placed.groupBy("shard").agg(F.min("rows_before").alias("m")).collect()}
    base = F.coalesce(*[F.when(F.col("shard") == s, F.lit(m)) for s, m in first.items()], F.lit(0)) if first else F.lit(0)
    placed = placed.select("grp", "shard", (F.col("rows_before") - base).alias("slot0"))
    in_group = W.partitionBy("grp").orderBy("salt").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.select("grp", "salt", (F.sum("n").over(in_group) - F.col("n")).alias("cell0")).join(placed, "grp")
    ranked = rows.withColumn("at", F.row_number().over(W.partitionBy("grp", "salt").orderBy("doc_id")) - 1)
    return ranked.join(cells, ["grp", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("slot0") + F.col("cell0") + F.col("at")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
