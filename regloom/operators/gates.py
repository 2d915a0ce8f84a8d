"""Promotion gates: a value is promoted only if all evidence agrees, it is safe and it overwrites nothing.

Gates work in long form (key, field, value), so one aggregation serves all fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

READY, CONFIRMED, REVIEW, PENDING = "ready", "confirmedExisting", "needsReview", "pendingCanonicalPhase2"


def gate(candidates: DataFrame, canonical: DataFrame, key: str, value: Column, current: Column, unsafe: Column | None = None, allowed: Sequence[str] | None = None, unknown: Sequence[str] = ("",), normal=None, same=None) -> DataFrame:
    """key, value, n_values, bucket, reason.

    normal: makes values comparable. same: tells whether the current value says the same as the promoted one. A key
    whose values are all null has nothing to promote and needs review.
    """
    norm = normal or (lambda c: c)
    bad = F.coalesce(unsafe, F.lit(False)) if unsafe is not None else F.lit(False)
    rows = candidates.select(key, value.alias("_v"), bad.alias("_bad"))
    if allowed is not None:
        rows = rows.where(F.col("_v").isin(*allowed))
    seen = rows.groupBy(key).agg(F.count_distinct(norm(F.col("_v"))).alias("n_values"), F.min("_v").alias("value"), F.bool_or("_bad").alias("_bad"))
    out = seen.join(canonical.select(key, current.alias("_current"), F.lit(True).alias("_has")), key, "left")
    agree = same or (lambda a, b: a == b)
    blank = F.col("_current").isNull() | F.col("_current").isin(*unknown)
    say = lambda b, r: F.struct(F.lit(b).alias("bucket"), F.lit(r).alias("reason"))
    verdict = (
        F.when(F.col("_bad"), say(REVIEW, "unsafe"))
        .when(F.col("n_values") > 1, say(REVIEW, "disagreement"))
        .when(F.col("n_values") == 0, say(REVIEW, "no_value"))
        .when(F.col("_has").isNull(), say(PENDING, "no_record"))
        .when(blank, say(READY, "blank"))
        .when(agree(norm(F.col("_current")), norm(F.col("value"))), say(CONFIRMED, "equal"))
        .otherwise(say(REVIEW, "conflict"))
    )
    out = out.withColumn("_say", verdict)
    return out.select(key, F.when(F.col("n_values") == 1, F.col("value")).alias("value"), "n_values", F.col("_say.bucket").alias("bucket"), F.col("_say.reason").alias("reason"))


def level_gate(candidates: DataFrame, canonical: DataFrame, key: str, value: Column, confidence: Column, current: Column, allowed: Sequence[str], unknown: str = "UNKNOWN") -> DataFrame:
    """The gate of a closed list of levels: only values of high confidence that the list holds count, whatever their case.

    Values that disagree go to review with none of them; a current level that is blank or unknown is filled, an equal one
    confirmed, another one held for review. Reasons as in gate, but candidate_disagreement and conflicts_with_canonical.
    """
    level = F.upper(F.trim(value))
    sure = candidates.where((confidence == "high") & level.isin(*allowed) & (F.coalesce(F.col(key).cast("string"), F.lit("")) != ""))
    out = gate(sure, canonical, key, level, F.upper(F.trim(current)), unknown=("", unknown))
    names = {"disagreement": "candidate_disagreement", "conflict": "conflicts_with_canonical"}
    reason = F.coalesce(*[F.when(F.col("reason") == k, F.lit(v)) for k, v in names.items()], F.col("reason"))
    return out.withColumn("reason", reason)


def contains_either(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def field_status(values: Column) -> Column:
    """insufficient, verified or conflicting by the number of distinct values."""
    n = F.size(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != ""))))
    return F.when(n == 0, "insufficient").when(n == 1, "verified").otherwise("conflicting")


def promotion_plan(gates: DataFrame, key: str, field: str, contract: str, needed: str) -> DataFrame:
    """field, ready keys, blocked: what could be promoted, held back while the contract is older than needed."""
    ready = gates.where(F.col("bucket") == READY)
    return ready.groupBy(field).agg(F.count_distinct(key).alias("ready_keys")).withColumn("blocked", F.lit(contract < needed))


def candidate_rows(snippets: DataFrame, fields: dict[str, Column], carry: Sequence[str]) -> DataFrame:
    """Long form (carry, field, value, confidence) of what was found; rows without any value go."""
    found = F.array(*[F.when(c.isNotNull(), F.struct(F.lit(n).alias("field"), c["value"].alias("value"), c["confidence"].alias("confidence"))) for n, c in fields.items()])
    return snippets.select(*carry, F.inline(F.filter(found, lambda x: x.isNotNull())))


def set_gate(candidates: DataFrame, canonical: DataFrame, key: str, values: Column, confidence: Column, current: Column, parse, allowed: Sequence[str] = ("medium", "high")) -> DataFrame:
    """key, value, bucket, reason: the gate of a field that holds a set of references.

    values, current: arrays of raw texts. parse: text to an array of canonical references. What any candidate of a key names
    is taken together; a candidate text that is blank or names nothing holds the whole key for review. A current list is
    confirmed where it names the same set, whatever the order. value is the sorted set; for review it holds what was read.
    Candidates of other confidence, without a list or without a key, take no part.
    """
    texts = F.coalesce(values, F.array().cast("array<string>"))
    read = candidates.where(confidence.isin(*allowed) & values.isNotNull() & (F.coalesce(F.col(key).cast("string"), F.lit("")) != ""))
    read = read.select(key, F.transform(texts, lambda x: parse(F.coalesce(x, F.lit("")))).alias("_refs"))
    torn = F.exists("_refs", lambda r: F.size(r) == 0)
    # a null beside the references carries the mark of a torn text and keeps keys without any
    long = read.select(key, torn.alias("_torn"), F.explode(F.concat(F.flatten("_refs"), F.array(F.lit(None).cast("string")))).alias("_ref"))
    seen = long.groupBy(key).agg(F.array_sort(F.collect_set("_ref")).alias("value"), F.bool_or("_torn").alias("_torn"))
    named = F.array_sort(F.array_distinct(F.flatten(F.transform(current, lambda x: parse(F.coalesce(x, F.lit("")))))))
    out = seen.join(canonical.select(key, named.alias("_current"), (F.size(F.coalesce(current, F.array().cast("array<string>"))) > 0).alias("_filled"), F.lit(True).alias("_has")), key, "left")
    say = lambda b, r: F.struct(F.lit(b).alias("bucket"), F.lit(r).alias("reason"))
    verdict = (
        F.when(F.col("_torn") | (F.size("value") == 0), say(REVIEW, "incomplete_or_ocr_truncated_legal_reference"))
        .when(F.col("_has").isNull(), say(PENDING, "no_record"))
        .when(~F.col("_filled"), say(READY, "blank"))
        .when(F.col("_current") == F.col("value"), say(CONFIRMED, "equal"))
        .otherwise(say(REVIEW, "conflicts_with_canonical"))
    )
    return out.withColumn("_say", verdict).select(key, "value", "_say.bucket", "_say.reason")


def _trimmed(values: Column) -> Column:
    """Distinct texts that are not blank, in order."""
    there = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.coalesce(F.trim(v), F.lit("")) != "")
    return F.array_distinct(F.transform(there, lambda v: F.trim(v)))


def single_value(values: Column) -> Column:
    """struct(status, value, reason): insufficient, verified or conflicting by the number of distinct values."""
    given = _trimmed(values)
    n = F.size(given)
    status = F.when(n == 0, "insufficient").when(n == 1, "verified").otherwise("conflicting")
    return F.struct(status.alias("status"), F.when(n == 1, F.get(given, F.lit(0))).alias("value"), F.lit(None).cast("string").alias("reason"))


def set_value(values: Column) -> Column:
    """struct(status, value, reason) of a field that takes a list: verified if it names anything; value is the list, line by line."""
    given = _trimmed(values)
    return F.struct(F.when(F.size(given) > 0, "verified").otherwise("insufficient").alias("status"), F.when(F.size(given) > 0, F.array_join(given, "\n")).alias("value"), F.lit(None).cast("string").alias("reason"))


def agency_value(values: Column, segments: Column, labels: Sequence[str], places: Sequence[str], reach: int = 240) -> Column:
    """struct(status, value, reason): one agency, no place that only receives, and named within `reach` characters from a label.

    The first occurrence of each label in each segment counts. A mention anywhere else may be of the applicant or of another
    body, so it verifies nothing.
    """
    given = _trimmed(values)
    value = F.get(given, F.lit(0))
    low = F.lower(value)
    place = F.lit(False)
    for p in places:
        place = place | low.contains(p)

    def named(segment: Column) -> Column:
        s = F.lower(F.coalesce(segment, F.lit("")))
        hit = F.lit(False)
        for label in labels:
            at = F.locate(label.lower(), s)
            hit = hit | ((at > 0) & F.substring(s, at, F.lit(reach)).contains(low))
        return F.coalesce(hit, F.lit(False))

    labelled = F.coalesce(F.exists(segments, named), F.lit(False))
    say = lambda s, r: F.struct(F.lit(s).alias("status"), F.lit(None).cast("string").alias("value"), F.lit(r).cast("string").alias("reason"))
    return (
        F.when(F.size(given) == 0, say("insufficient", None))
        .when(F.size(given) > 1, say("conflicting", "multiple_agency_mentions"))
        .when(place, say("insufficient", "reception_location_only"))
        .when(~labelled, say("insufficient", "unlabelled_agency_mention"))
        .otherwise(F.struct(F.lit("verified").alias("status"), value.alias("value"), F.lit(None).cast("string").alias("reason")))
    )


def validated_fields(rows: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """key, promotable (sorted names of verified fields), verification and one struct for each field."""
    df = rows.select(key, *[c.alias(n) for n, c in fields.items()])
    good = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"`{n}`.status") == "verified", F.lit(n)) for n in fields])))
    return df.withColumn("promotable", good).withColumn("verification", F.when(F.size(good) > 0, "field_validated").otherwise("no_promotable_field"))


def field_counts(validated: DataFrame, fields: Sequence[str]) -> DataFrame:
    """field, verified, conflicting, insufficient: how many keys have which status, in one pass."""
    each = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"`{n}`.status").alias("status")) for n in fields])
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return validated.select(F.inline(each)).groupBy("field").agg(n("verified"), n("conflicting"), n("insufficient"))
