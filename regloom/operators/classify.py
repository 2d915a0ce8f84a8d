"""Classifiers by ordered rules on folded text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_marker, fold


def by_markers(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Value of the first rule any of whose markers the folded text holds."""
    out = F.when(F.lit(False), F.lit(default))
    for value, markers in rules:
        out = out.when(any_marker(text, markers), value)
    return out.otherwise(default)


def candidate_link(url: Column, text: Column, decision: str, topic: str) -> Column:
    both = fold(F.concat_ws(" ", url, text))
    return both.rlike(decision) & both.rlike(topic)


def change_type(status: Column, context: Column, reduced: str, not_reduced: str) -> Column:
    """A modification is a reduction where its context says so and does not deny it."""
    f = fold(context)
    return F.when((status == "modified") & f.contains(reduced) & ~f.contains(not_reduced), "reduced").otherwise(status)


def level_label(hint: Column, labels: Mapping[str, str], fallback: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, hint), fallback)


def domain(df: DataFrame, key: str, given: Column, evidence: str, slugs: Sequence[tuple[str, str]], words: Sequence[tuple[str, Sequence[str]]], default: str) -> DataFrame:
    """key, domain: the given value, else the first slug, else the first word rule, over evidence from new to old.

    evidence: array of (date, url, title).
    """
    e = df.select(key, given.alias("given"), F.explode_outer(evidence).alias("e"))
    by_slug = F.coalesce(*[F.when(F.col("e.url").contains(s), v) for s, v in slugs])
    by_word = F.coalesce(*[F.when(any_marker(F.col("e.title"), m), v) for v, m in words])
    at = F.struct("e.date", "e.url")
    best = e.groupBy(key).agg(F.max("given").alias("given"), F.max_by(by_slug, F.when(by_slug.isNotNull(), at)).alias("slug"), F.max_by(by_word, F.when(by_word.isNotNull(), at)).alias("word"))
    return best.select(key, F.coalesce(F.nullif(F.col("given"), F.lit("")), "slug", "word", F.lit(default)).alias("domain"))


def live_result(body: Column, name: Column, agency: Column, blocked: Sequence[str]) -> Column:
    """blocked, both_visible, name_visible or unresolved."""
    f = fold(body)
    has_name, has_agency = f.contains(fold(name)), f.contains(fold(agency))
    return F.when(any_marker(body, blocked), "blocked").when(has_name & has_agency, "both_visible").when(has_name, "name_visible").otherwise("unresolved")


def classify_record(label: Column, own_flag: Column, online: Column, rules: Sequence[tuple[str, bool, str, str]], ambiguous: Sequence[str], levels: Sequence[str]) -> Column:
    """struct(authority, scope, receivable, online) of a record by its label, without inventing an authority.

    rules: (label, is a prefix, authority, scope), the first that holds decides, and such records are receivable. Ambiguous
    labels are receivable, with authority and scope OTHER; any other label is OTHER too and keeps the record's own flag
    (null: not receivable). An online level outside levels is UNKNOWN.
    """
    name = F.trim(F.coalesce(label, F.lit("")))
    out = F.when(F.lit(False), F.struct(F.lit("").alias("authority"), F.lit("").alias("scope"), F.lit(False).alias("receivable")))
    say = lambda a, s, r: F.struct(F.lit(a).alias("authority"), F.lit(s).alias("scope"), r.alias("receivable"))
    for text, prefix, authority, scope in rules:
        out = out.when(F.lower(name).startswith(text.lower()) if prefix else name == text, say(authority, scope, F.lit(True)))
    out = out.when(name.isin(*ambiguous), say("OTHER", "OTHER", F.lit(True))).otherwise(say("OTHER", "OTHER", F.coalesce(own_flag, F.lit(False))))
    level = F.upper(F.trim(F.coalesce(online, F.lit(""))))
    return F.struct(out["authority"].alias("authority"), out["scope"].alias("scope"), out["receivable"].alias("receivable"), F.when(level.isin(*levels), level).otherwise("UNKNOWN").alias("online"))
