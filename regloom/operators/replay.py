"""Replay of dated change events into a state per key, as of a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_state(status: Column, effective: Column, as_of: Column, field: Column, review: Sequence[str], applied: str = "applied") -> Column:
    """needs_review, future_effective or current; a missing field overrides all unless the event was applied."""
    state = F.when(status.isin(*review), status).when(effective > as_of, "future_effective").otherwise("current")
    return F.when((F.coalesce(field, F.lit("")) == "") & (F.coalesce(status, F.lit("")) != applied), "needs_field_review").otherwise(state)


def row_state(own: Column, parent: Column, as_of: Column) -> Column:
    """A row's own effective date decides where its parent is current or future."""
    return F.when(own.isNotNull() & parent.isin("current", "future_effective"), F.when(own > as_of, "future_effective").otherwise("current")).otherwise(parent)


def replay(events: DataFrame, key: str, order: Sequence[str], kind: Column, evidence: Column | None = None) -> DataFrame:
    """Fold each key's events in order into its state.

    kind: 'review' counts only; 'future' annotates a current key and excludes any other as future; 'repealed' excludes;
    'current' makes or updates a public row where it has evidence. Returns key, state, since (order of the decisive
    event), n_reviews, n_updates (current events with evidence, those that make the row included), future (order of the
    latest future event since the public row was made: later updates keep it, only a row made anew after a repeal has
    none). A starting state is given as events that come before all others.

    The state needs the decisive events only, so it comes from partial aggregates and no key's history is gathered. Only keys
    that were updated after a future event are joined with their events again, and reduced to one row each.
    """
    good = F.coalesce(evidence, F.lit(True)) if evidence is not None else F.lit(True)
    at = F.struct(*order)
    rows = events.select(key, at.alias("at"), kind.alias("kind"), good.alias("good"))
    makes, repeals, waits = (F.col("kind") == "current") & F.col("good"), F.col("kind") == "repealed", F.col("kind") == "future"
    agg = rows.groupBy(key).agg(
        F.max(F.when(makes, F.col("at"))).alias("made"), F.max(F.when(repeals, F.col("at"))).alias("gone"),
        F.max(F.when(waits, F.col("at"))).alias("waits"), F.count_if(F.col("kind") == "review").alias("n_reviews"), F.count_if(makes).alias("n_updates"),
    )
    # whether a row was public already when its latest future event came: plain where no update came after that, else an
    # earlier one must stand between the last repeal and it; only events of such keys are looked up
    unsure = agg.where("made > waits AND (gone IS NULL OR waits > gone)").select(key, F.col("gone").alias("_gone"), F.col("waits").alias("_waits"))
    between = rows.where(makes).join(unsure, key).where("at < _waits AND (_gone IS NULL OR at > _gone)").select(key).distinct().withColumn("_before", F.lit(True))
    agg = agg.join(between, key, "left")
    public = F.col("made").isNotNull() & (F.col("gone").isNull() | (F.col("made") > F.col("gone")))
    # a future event that comes after the last repeal excludes a key that is not public as future
    future = F.col("waits").isNotNull() & (F.col("gone").isNull() | (F.col("waits") > F.col("gone")))
    state = F.when(public, "current").when(future, "future_effective").when(F.col("gone").isNotNull(), "repealed").otherwise("unknown")
    since = F.when(public, F.col("made")).when(future, F.col("waits")).otherwise(F.col("gone"))
    pending = F.when(public & future & ((F.col("made") < F.col("waits")) | F.col("_before")), F.col("waits"))
    return agg.select(key, state.alias("state"), since.alias("since"), "n_reviews", "n_updates", pending.alias("future"))


def merge_verified(current: DataFrame, verified: DataFrame, key: str, date: str, repealed: Column) -> DataFrame:
    """Precedence merge of a verification matrix; action tells what was done.

    A repeal is ignored where the row's own date is later; a current verdict where the key was excluded at that date or
    later; others annotate or add.
    """
    c = current.select(key, F.col("state").alias("_s"), F.col(date).alias("_d"))
    v = verified.select(key, F.col(date).alias("_v"), repealed.alias("_r"))
    both = c.join(v, key, "full")
    d = F.coalesce("_d", F.lit(""))
    action = (
        F.when(F.col("_v").isNull(), "keep")
        .when(F.col("_r") & (F.col("_s") == "current") & (d > F.col("_v")), "ignore_repeal")
        .when(F.col("_r"), "repeal")
        .when((F.col("_s") == "repealed") & (d >= F.col("_v")), "ignore_current")
        .when(F.col("_s").isNull() | (F.col("_s") != "current"), "add")
        .otherwise("annotate")
    )
    both = both.withColumn("action", action)
    state = F.when(F.col("action") == "repeal", "repealed").when(F.col("action") == "add", "current").otherwise(F.col("_s"))
    latest = F.when(F.col("action").isin("repeal", "add", "annotate"), F.greatest(d, F.col("_v"))).otherwise(F.col("_d"))
    return both.select(key, state.alias("state"), latest.alias(date), "action")


def dataset_version(existing: Column, newest: Column) -> Column:
    """Never lower than before, as YYYY.MM.DD."""
    return F.greatest(F.coalesce(existing, F.lit("")), F.coalesce(F.replace(newest, F.lit("-"), F.lit(".")), F.lit("")))
