"""Faceted, accent-insensitive search with paging and global ordinals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import fold_d


def facet_filter(df: DataFrame, equal: Mapping[str, str], flags: Sequence[str], query: str, columns: Sequence[str]) -> DataFrame:
    """Rows with all given values and flags whose folded columns hold the folded query."""
    for c, v in equal.items():
        if v:
            df = df.where(F.col(c) == v)
    for f in flags:
        df = df.where(F.col(f))
    if query and query.strip():
        q = fold_d(F.lit(query))
        hit = F.lit(False)
        for c in columns:
            hit = hit | F.coalesce(fold_d(F.col(c)).contains(q), F.lit(False))
        df = df.where(hit)
    return df


def fold_order(*columns: str) -> list[Column]:
    """Order by folded texts, then by the last column as it is."""
    return [*[fold_d(F.col(c)) for c in columns[:-1]], F.col(columns[-1])]


def case_order(*columns: str) -> list[Column]:
    """Order by texts in lower case, equal ones as they are."""
    return [*[F.lower(F.col(c)) for c in columns], *[F.col(c) for c in columns]]


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 30) -> DataFrame:
    """A page of a total order; pages before the first are the first."""
    return df.orderBy(*order).offset((max(number, 1) - 1) * size).limit(size)


def clamp(number: int, rows: int, size: int = 30) -> int:
    return min(max(number, 1), max(1, -(-rows // size)))


def top_facets(df: DataFrame, column: str, n: int = 8) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column).limit(n)


def locale_order(column: str, collation: str = "vi") -> Column:
    return F.collate(F.col(column), collation)


def ordinal(df: DataFrame, order: Sequence[Column], key: str, name: str = "ordinal", parts: int | None = None) -> DataFrame:
    """Global row numbers of a total order without one task that sees all rows.

    Rows are range-partitioned, into as many parts as shuffles have unless parts says otherwise; a partition's rows are numbered within it, and the counts of earlier ones are added. The
    order must be total (end it with the key).
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    from ..sources.tables import kept

    ranged = kept(ranged)
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + inner).cast("long")).drop("_part", "_before")
