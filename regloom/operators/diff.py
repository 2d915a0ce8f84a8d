"""Set drift, exact key sets, snapshot deltas, change sets and write-if-changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.evidence import changes, row_fingerprint


def drift(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, side ('left_only' or 'right_only')."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only = a.join(b, key, "left_anti").withColumn("side", F.lit("left_only"))
    return only.unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right_only")))


def exact_set(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: matched, missing, extra, duplicates, exact."""
    a = left.groupBy(key).agg(F.count("*").alias("n")).alias("a")
    b = right.select(key).distinct().withColumn("has", F.lit(1)).alias("b")
    both = a.join(b, F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "full")
    out = both.agg(
        F.count_if(F.col("n").isNotNull() & F.col("has").isNotNull()).alias("matched"),
        F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("has").isNull()).alias("extra"), F.count_if(F.col("n") > 1).alias("duplicates"),
    )
    return out.withColumn("exact", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("duplicates") == 0))


def snapshot_delta(before: DataFrame, after: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """key, change ('added', 'removed' or 'changed'), fields array<struct<field, before, after>>."""
    b = before.select(key, *[F.col(c).alias(f"b_{c}") for c in tracked], F.lit(1).alias("_b"))
    a = after.select(key, *[F.col(c).alias(f"a_{c}") for c in tracked], F.lit(1).alias("_a"))
    both = b.join(a, key, "full")
    fields = changes({c: F.col(f"b_{c}") for c in tracked}, {c: F.col(f"a_{c}") for c in tracked})
    kind = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(F.size("fields") > 0, "changed")
    out = both.withColumn("fields", fields).withColumn("change", kind).where("change IS NOT NULL")
    return out.select(key, "change", F.when(F.col("change") == "changed", F.col("fields")).otherwise(F.array().cast("array<struct<field:string,before:string,after:string>>")).alias("fields"))


def delta_summary(delta: DataFrame) -> DataFrame:
    return delta.agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "changed")])


def fingerprints(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.select(key, row_fingerprint({c: F.col(c) for c in columns}).alias("fingerprint"))


def change_set(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, change from two (key, fingerprint) tables."""
    b, a = before.select(key, F.col("fingerprint").alias("_b")), after.select(key, F.col("fingerprint").alias("_a"))
    kind = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return b.join(a, key, "full").withColumn("change", kind).where("change IS NOT NULL").select(key, "change")


def dataset_fingerprint(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """One row: the number of rows and an order-free checksum over all columns but the volatile ones."""
    h = F.xxhash64(F.to_json(F.struct(*[c for c in sorted(df.columns) if c not in ignore]), {"ignoreNullFields": "false"}))
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor"), F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0)).alias("total"))


def changed(old: DataFrame, new: DataFrame, ignore: Sequence[str] = ()) -> bool:
    """Whether two tables differ beyond volatile columns."""
    return dataset_fingerprint(old, ignore).first() != dataset_fingerprint(new, ignore).first()
