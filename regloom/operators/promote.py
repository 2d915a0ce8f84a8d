"""Promotion of gated values into blanks, with evidence and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_filled

READY, CONFIRMED = "ready", "confirmed"
EVIDENCE = "array<struct<role:string,article_url:string,attachment_url:string,decisions:array<string>,kind:string,repeal:boolean>>"


def source_evidence(sources: Column, role: str, kind: str) -> Column:
    """Evidence of an item's sources (articles, attachment_url, decisions), in order: of each its first article; none without a url."""
    one = lambda s: F.struct(
        F.lit(role).alias("role"), F.get(s["articles"], F.lit(0)).alias("article_url"), s["attachment_url"].alias("attachment_url"),
        F.coalesce(s["decisions"], F.array().cast("array<string>")).alias("decisions"), F.lit(kind).alias("kind"), F.lit(False).alias("repeal"),
    )
    named = F.filter(F.transform(sources, one), lambda e: is_filled(e["article_url"]) | is_filled(e["attachment_url"]))
    return F.coalesce(named, F.array()).cast(EVIDENCE)


def promote(master: DataFrame, key: str, column: str, items: DataFrame, order: Sequence[str], evidence: str | None = None, role: str = "", kind: str = "", most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Rows of master with blanks of `column` filled from items, and the counters of the run in one row.

    items: bucket (ready or confirmed), status, key, value and sources. An item of the ready bucket counts only if its status is
    ready too. All ready items come before the confirmed ones, each by `order`, which must tell them apart. For each key the first
    item with a value fills a blank, and its evidence goes before the row's own, `most` in all; a value that is there never changes.
    Counters, for items: ready, confirmed; missing (no such key), skipped (the row has a value, its own or that of an earlier item),
    promoted. An item without a value for a blank row is none of the last three. Null keys of items are missing. Keys of master are
    unique. The winners are partial aggregates by key, so a key with many items is no burden for one task; what is counted for each
    item is counted against these winners by a join, and aggregated at once.
    """
    i = items.where((F.col("bucket") == CONFIRMED) | ((F.col("bucket") == READY) & (F.col("status") == READY)))
    i = i.withColumn("_place", F.struct((F.col("bucket") == CONFIRMED).alias("late"), *order)).withColumn("_value", F.trim(F.coalesce(F.col("value"), F.lit(""))))
    first = i.where("_value <> ''").groupBy(key).agg(F.min(F.struct("_place", F.col("_value").alias("value"), "sources")).alias("_first"))
    rows = master.join(first, key, "left")
    blank = ~is_filled(F.trim(F.col(column)))
    fills = F.col("_first").isNotNull() & blank
    # keys of master with their place from which on items come too late: all, where the row has a value of its own
    known = rows.select(key, blank.alias("_blank"), F.col("_first._place").alias("_from"), F.lit(True).alias("_known"))
    judged = i.select(key, "bucket", "_place").join(known, key, "left")
    here, open_ = F.coalesce("_known", F.lit(False)), F.coalesce("_blank", F.lit(False))
    counts = judged.agg(
        F.count_if(F.col("bucket") == READY).alias("ready"), F.count_if(F.col("bucket") == CONFIRMED).alias("confirmed"),
        F.count_if(open_ & (F.col("_place") == F.col("_from"))).alias("promoted"),
        F.count_if(here & (~open_ | (F.col("_place") > F.col("_from")))).alias("skipped"), F.count_if(~here).alias("missing"),
    )
    out = {column: F.when(fills, F.col("_first.value")).otherwise(F.col(column))}
    if evidence:
        new = F.slice(F.concat(source_evidence(F.col("_first.sources"), role, kind), F.coalesce(F.col(evidence), F.array().cast(EVIDENCE))), 1, most)
        out[evidence] = F.when(fills, new).otherwise(F.col(evidence))
    return rows.withColumns(out).drop("_first"), counts
