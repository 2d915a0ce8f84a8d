"""Reconciliation of a catalogue against published totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resolve import latest_by


def levels(master: DataFrame, key: str, hints: DataFrame, table_levels: DataFrame, label: str, in_scope: Sequence[str], hint_order: Sequence[Column]) -> DataFrame:
    """key, level (the latest hint, else the table's, else the label), source, conflict, in_scope, ambiguous."""
    h = latest_by(hints.where(F.col("hint") != ""), [key], hint_order).select(key, "hint")
    t = table_levels.groupBy(key).agg(F.min("level").alias("_t"), F.count_distinct("level").alias("_n"))
    out = master.join(h, key, "left").join(t, key, "left")
    level = F.coalesce("hint", F.when(F.col("_n") == 1, F.col("_t")), F.nullif(F.col(label), F.lit("")))
    source = F.when(F.col("hint").isNotNull(), "hint").when(F.col("_n") == 1, "table").when(F.col(label) != "", "label").otherwise("none")
    evidenced = F.coalesce("hint", F.when(F.col("_n") == 1, F.col("_t")))
    return out.select(
        key, level.alias("level"), source.alias("level_source"),
        F.coalesce((F.col(label) != "") & (evidenced != F.col(label)), F.lit(False)).alias("conflict"),
        F.coalesce(level.isin(*in_scope), F.lit(False)).alias("in_scope"),
        (F.coalesce(F.col("_n") > 1, F.lit(False)) & F.col("hint").isNull()).alias("ambiguous"),
    )


def buckets(resolved: DataFrame, key: str, target: int) -> DataFrame:
    """One row: in_scope, out_of_scope, misclassified, ambiguous, missing_at_least, drift. Missing keys are never invented."""
    n = F.count_distinct(F.when(F.col("in_scope"), F.col(key)))
    return resolved.agg(
        n.alias("in_scope"), F.count_distinct(F.when(~F.col("in_scope"), F.col(key))).alias("out_of_scope"),
        F.count_distinct(F.when(F.col("conflict"), F.col(key))).alias("misclassified"), F.count_distinct(F.when(F.col("ambiguous"), F.col(key))).alias("ambiguous"),
        F.greatest(F.lit(0), F.lit(target) - n).alias("missing_at_least"), (n - target).alias("drift"),
    )


def results(resolved: DataFrame, key: str, label: str, provisional: Sequence[str], unclear: Sequence[str], evidenced: Sequence[str]) -> DataFrame:
    """bucket, key of every record: MATCHED where evidence puts it into scope, EXTRA where it is out of scope, MISCLASSIFIED where
    evidence and label disagree, AMBIGUOUS where its label is unclear and no evidence decides, PROVISIONAL where only the label
    says it is in scope.

    resolved: as levels() gives it, with the label. A record may stand in several buckets. MISSING has no keys: without a list of
    keys from the publisher none is invented, see buckets() for how many are missing at least.
    """
    decided = F.col("level_source").isin("hint", "table")
    told = F.array(
        F.when(decided & F.col("level").isin(*evidenced), "MATCHED"),
        F.when(~F.col("in_scope"), "EXTRA"),
        F.when(F.col("conflict"), "MISCLASSIFIED"),
        F.when(~decided & F.col(label).isin(*unclear), "AMBIGUOUS"),
        F.when(F.col(label).isin(*provisional), "PROVISIONAL"),
    )
    return resolved.select(F.explode(F.array_compact(told)).alias("bucket"), key).distinct()


def crosswalk(items: DataFrame, master: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """items with in_master, master and live columns; live must have exactly the items' keys."""
    from .diff import exact_set

    if not exact_set(live, items, key).first()["exact"]:
        raise ValueError("the live result has other keys than the crosswalk")
    m = master.withColumn("in_master", F.lit(True))
    return items.join(m, key, "left").withColumn("in_master", F.coalesce("in_master", F.lit(False))).join(live, key)
