"""Promotion gates of single fields, with their own reasons. Only candidates of high confidence take part.

One aggregation by key, then one join with the canonical rows. Each gives key, value, bucket, reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gates import CONFIRMED, PENDING, READY, REVIEW, contains_either


def _say(bucket: str, reason: str) -> Column:
    return F.struct(F.lit(bucket).alias("bucket"), F.lit(reason).alias("reason"))


def _high(candidates: DataFrame, key: str, value: Column, confidence: Column) -> DataFrame:
    """Rows of high confidence with a key."""
    k = F.trim(F.col(key).cast("string"))
    return candidates.where((confidence == "high") & (k != "")).select(k.alias("key"), value.alias("v"))


def fee_gate(candidates: DataFrame, canonical: DataFrame, key: str, raw: Column, confidence: Column, current: Column, safe) -> DataFrame:
    """safe: turns a text into its safe marker, or null. One unsafe candidate of a key sends it to review."""
    rows = _high(candidates, key, safe(raw), confidence)
    seen = rows.groupBy("key").agg(F.count("*").alias("n"), F.count("v").alias("n_safe"), F.min("v").alias("least"), F.max("v").alias("most"))
    base = canonical.select(F.trim(F.col(key).cast("string")).alias("key"), current.alias("_current"), F.lit(True).alias("_has"))
    is_blank = F.col("_current").isNull() | (F.col("_current") == "")
    verdict = (
        F.when(F.col("n_safe") == 0, _say(REVIEW, "unsafe_or_truncated_fee_text"))
        .when(F.col("n_safe") < F.col("n"), _say(REVIEW, "mixed_candidate_quality"))
        .when(F.col("least") != F.col("most"), _say(REVIEW, "candidate_disagreement"))
        .when(F.col("_has").isNull(), _say(PENDING, "no_record"))
        .when(is_blank, _say(READY, "blank"))
        .when(safe(F.col("_current")).eqNullSafe(F.col("least")), _say(CONFIRMED, "equal"))
        .otherwise(_say(REVIEW, "conflicts_with_canonical"))
    )
    out = seen.join(base, "key", "left").withColumn("_say", verdict)
    agreed = (F.col("n_safe") == F.col("n")) & (F.col("least") == F.col("most"))
    return out.select("key", F.when(agreed, F.col("least")).alias("value"), "_say.bucket", "_say.reason")


def duration_gate(candidates: DataFrame, canonical: DataFrame, key: str, raw: Column, confidence: Column, current: Column, normal, clear) -> DataFrame:
    """Keys without a canonical row do not take part.

    normal: makes values comparable. clear: whether a value can be read in one way only. The smallest of the values that
    are equal when made comparable stands for them. A value that holds the current one, or the other way round, confirms it.
    """
    rows = _high(candidates, key, F.trim(raw), confidence).where("v <> ''")
    seen = rows.groupBy("key").agg(F.min("v").alias("value"), F.min(normal(F.col("v"))).alias("least"), F.max(normal(F.col("v"))).alias("most"))
    base = canonical.select(F.trim(F.col(key).cast("string")).alias("key"), F.coalesce(F.trim(current), F.lit("")).alias("_current"))
    verdict = (
        F.when(F.col("least") != F.col("most"), _say(REVIEW, "candidate_disagreement"))
        .when(~F.coalesce(clear(F.col("value")), F.lit(False)), _say(REVIEW, "multiple_or_ambiguous_duration_tokens"))
        .when(F.col("_current") == "", _say(READY, "blank"))
        .when(contains_either(normal(F.col("_current")), normal(F.col("value"))), _say(CONFIRMED, "equal"))
        .otherwise(_say(REVIEW, "conflicts_with_canonical"))
    )
    out = seen.join(base, "key").withColumn("_say", verdict)
    return out.select("key", F.when(F.col("least") == F.col("most"), F.col("value")).alias("value"), "_say.bucket", "_say.reason")
