"""Health and guards of a scheduled job, from its run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def local_day(ts: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def health(runs: DataFrame, days: DataFrame, ts: str, record: Column, active: Column, deadline_hour: int, now: Column, zone: str = "UTC") -> DataFrame:
    """day, verdict for every day, by the first rule that holds; runs of other days do not count.

    record: what the run's own record says, one of ok, duplicate_skip, paused, failed or another word; null if it left
    none. active: the run still goes on. Before the deadline a day is NOT_DUE whatever was seen; without runs it is
    STOPPED_SILENTLY; then HEALTHY by an ok record, STOPPED_LOUDLY by a duplicate skip, PAUSED, STOPPED_LOUDLY by a
    failure, RUNNING by an active run, and STOPPED_LOUDLY for all that is left.
    """
    day = local_day(F.col(ts), zone).alias("day")
    seen = runs.select(day, record.alias("r"), active.alias("a")).groupBy("day").agg(F.collect_set("r").alias("seen"), F.bool_or("a").alias("active"))
    has = lambda s: F.array_contains("seen", s)
    due = F.from_utc_timestamp(now, zone) >= F.col("day").cast("timestamp") + F.make_dt_interval(hours=F.lit(deadline_hour))
    verdict = (
        F.when(~due, "NOT_DUE").when(F.col("seen").isNull(), "STOPPED_SILENTLY").when(has("ok"), "HEALTHY").when(has("duplicate_skip"), "STOPPED_LOUDLY")
        .when(has("paused"), "PAUSED").when(has("failed"), "STOPPED_LOUDLY").when(F.col("active"), "RUNNING").otherwise("STOPPED_LOUDLY")
    )
    return days.join(seen, "day", "left").select("day", verdict.alias("verdict"))


def calendar(df: DataFrame, ts: str, zone: str = "UTC") -> DataFrame:
    """Every day from the first to the last of a log."""
    span = df.agg(F.min(local_day(F.col(ts), zone)).alias("a"), F.max(local_day(F.col(ts), zone)).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("day"))


def guard(runs: DataFrame, ts: str, status: Column, now: Column, paused: Column, start_hour: int, end_hour: int, zone: str = "UTC") -> DataFrame:
    """One row: PAUSED, OUTSIDE_WINDOW, ALREADY_SUCCEEDED or READY."""
    today = local_day(now, zone)
    hour = F.hour(F.from_utc_timestamp(now, zone))
    done = runs.agg(F.coalesce(F.bool_or((local_day(F.col(ts), zone) == today) & (status == "success")), F.lit(False)).alias("done"))
    verdict = F.when(paused, "PAUSED").when(~hour.between(start_hour, end_hour - 1), "OUTSIDE_WINDOW").when(F.col("done"), "ALREADY_SUCCEEDED").otherwise("READY")
    return done.select(verdict.alias("verdict"))


def last_record(records: DataFrame, run_id: str, ts: str) -> DataFrame:
    from .resolve import latest_by

    return latest_by(records, [run_id], [F.col(ts).desc()])
