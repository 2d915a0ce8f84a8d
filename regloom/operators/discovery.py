"""Incremental discovery of decisions on listing pages: what is new, what only repeats, what needs another look.

The state is one table: a row for each url ever listed (kind url) and one for each decision taken over (kind decision), so that
one version holds both. A step joins a batch of links with it by url, by source and by decision number; nothing of the state
is held in memory, and no key's rows are gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

def _texts(names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names.split()])


STATE = _texts("kind source url number day title class status")
#: Columns of a batch of links: what the listing shows, and what the article gave when it was fetched.
LINKS = _texts("source url number day title failed class article_number article_day article_title pdf pdf_failed")
REVIEW = "needs_review"


def _given(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def _first(*cs: Column) -> Column:
    return F.coalesce(*[F.when(_given(c), c) for c in cs], F.lit(""))


def step(state: DataFrame, links: DataFrame, baseline_sources: Sequence[str] | None = None) -> DataFrame:
    """The next whole state, with a column action: kept, baseline, mirror, excluded, review or added for what it is after the step.

    A url takes part if it is new, or waits for review. Rules in order: a source never seen before gives its urls as a
    baseline (with the class of the decision where that is known); a listed number that is known, or that an earlier link of
    the batch adds, makes a mirror; an article that could not be fetched waits; references to other authorities and articles
    on other matters are left out, as are internal ones without a number; without a number it waits; an internal decision is
    recorded; a public one needs its document, else it waits; what is left is added. Of links of one url in a batch the last by
    source counts; of links of one new number the first by day, number and url adds it and the others are mirrors. A decision
    without a day takes the day on which all listings of the batch agree. Links without a url or source take no part.

    baseline_sources: sources to treat as never seen, besides those of which the state has no url.
    """
    urls, decisions = state.where("kind = 'url'"), state.where("kind = 'decision'")
    key = F.rtrim(F.col("url"), F.lit("/"))
    batch = links.where(_given(F.col("url")) & _given(F.col("source"))).withColumn("url", key)
    batch = batch.groupBy("url").agg(F.max(F.struct("source", *[c for c in LINKS.fieldNames() if c not in ("source", "url")])).alias("l")).select("url", "l.*")
    seen = urls.select(F.rtrim("url", F.lit("/")).alias("url"), F.col("class").alias("was"))
    old = urls.select("source").distinct().withColumn("old", F.lit(True))
    known = decisions.groupBy("number").agg(F.min(F.struct("class", "status", "title")).alias("known"))
    work = batch.join(seen, "url", "left").where("was IS NULL OR was = 'needs_review'").join(old, "source", "left").join(known, "number", "left")
    fresh = F.col("old").isNull() | (F.col("source").isin(*baseline_sources) if baseline_sources else F.lit(False))
    listed = _given(F.col("number"))
    number, day, title = _first(F.col("article_number"), F.col("number")), _first(F.col("article_day"), F.col("day")), _first(F.col("article_title"), F.col("title"))
    kind = F.col("class")
    say = lambda a, c, s: F.struct(F.lit(a).alias("action"), (c if isinstance(c, Column) else F.lit(c)).alias("class"), (s if isinstance(s, Column) else F.lit(s)).alias("status"))
    verdict = (
        F.when(fresh, say("baseline", F.coalesce("known.class", F.lit("baseline_only")), F.coalesce("known.status", F.lit("baseline_only"))))
        .when(listed & F.col("known").isNotNull(), say("mirror", "mirror_known_decision", "known_decision_new_listing_url"))
        .when(_given(F.col("failed")), say("review", REVIEW, F.concat(F.lit("article_fetch_failed: "), "failed")))
        .when(kind == "external_reference", say("excluded", kind, "excluded_external_authority"))
        .when(kind == "non_tthc", say("excluded", kind, "excluded_non_tthc"))
        .when((kind == "internal_process") & (number == ""), say("excluded", kind, "excluded_internal_unidentified"))
        .when(number == "", say("review", REVIEW, "missing_decision_number"))
        .when(kind == "internal_process", say("added", kind, "excluded_internal"))
        .when(~F.coalesce(kind == "public_tthc", F.lit(False)), say("review", REVIEW, "unclassified_article"))
        .when(~_given(F.col("pdf")), say("review", REVIEW, "missing_official_pdf"))
        .when(_given(F.col("pdf_failed")), say("review", REVIEW, F.concat(F.lit("pdf_download_failed: "), "pdf_failed")))
        .otherwise(say("added", kind, "auto_discovered"))
    )
    own = work.withColumn("v", verdict).withColumn("no", F.when(F.col("v.action").isin("added", "review", "excluded"), number).otherwise(F.coalesce("number", F.lit(""))))
    own = own.withColumn("at", F.struct(day.alias("day"), F.col("no").alias("no"), F.col("url").alias("url")))
    adder = own.where("v.action = 'added'").groupBy("no").agg(F.min("at").alias("first"))
    own = own.join(adder, "no", "left")
    # behind the link that adds a number, others that list it or were to add it only repeat it
    repeats = F.col("first").isNotNull() & (F.col("at") > F.col("first")) & (F.col("v.action") != "baseline") & (listed | (F.col("v.action") == "added"))
    own = own.withColumn("v", F.when(repeats, say("mirror", "mirror_known_decision", "known_decision_new_listing_url")).otherwise(F.col("v")))
    shown = F.when(F.col("v.action").isin("baseline"), F.col("title")).when(F.col("v.action") == "mirror", _first(F.col("known.title"), title)).otherwise(title)
    told = own.select(F.lit("url").alias("kind"), "source", "url", "no", F.col("at.day").alias("day"), shown.alias("title"), F.col("v.class").alias("class"), F.col("v.status").alias("status"), F.col("v.action").alias("action")).withColumnRenamed("no", "number")
    new = told.where("action = 'added'").withColumn("kind", F.lit("decision"))
    rest = urls.withColumn("k", F.rtrim("url", F.lit("/"))).join(told.select(F.col("url").alias("k")), "k", "left_anti").drop("k").withColumn("action", F.lit("kept"))
    days = batch.where(listed & _given(F.col("day"))).groupBy("number").agg(F.min("day").alias("lo"), F.max("day").alias("hi")).where("lo = hi").select("number", "lo")
    dated = decisions.withColumn("action", F.lit("kept")).unionByName(new).join(days, "number", "left")
    fills = (F.col("class") == "public_tthc") & ~_given(F.col("day"))
    dated = dated.withColumn("day", F.when(fills, F.coalesce("lo", "day")).otherwise(F.col("day"))).drop("lo")
    return rest.unionByName(told).unionByName(dated)
