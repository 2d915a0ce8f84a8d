"""Whole plans: the daily run from events to master and delta, and field promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import diff, expect, gates, replay, resolve


def daily(events: DataFrame, key: str, order: Sequence[str], kind: Column, names: DataFrame, previous: DataFrame, rules: Sequence[expect.Rule]) -> dict[str, DataFrame]:
    """master, excluded, findings and delta of one run; one shuffle by key serves the replay and the joins."""
    state = replay.replay(events, key, order, kind).join(names, key, "left")
    public, gone = state.where("state = 'current'"), state.where("state <> 'current'")
    return {
        "master": public,
        "excluded": gone,
        "findings": expect.findings(public, key, rules),
        "delta": diff.snapshot_delta(previous, public.select(*previous.columns), key, [c for c in previous.columns if c != key]),
    }


def promote(candidates: DataFrame, canonical: DataFrame, key: str, field: str, value: str, unsafe: Column, contract: str, needed: str) -> dict[str, DataFrame]:
    """The gates of all fields in one aggregation over (key, field, value), and the plan."""
    both = F.struct(F.col(key).alias("k"), F.col(field).alias("f"))
    verdicts = gates.gate(candidates.withColumn("_k", both), canonical.withColumn("_k", both), "_k", F.col(value), F.col("current"), unsafe)
    verdicts = verdicts.withColumn(key, F.col("_k.k")).withColumn(field, F.col("_k.f")).drop("_k")
    return {"gates": verdicts, "plan": gates.promotion_plan(verdicts, key, field, contract, needed)}


def fill_ready(master: DataFrame, verdicts: DataFrame, key: str, column: str) -> DataFrame:
    """Promote ready values into blanks."""
    ready = verdicts.where(F.col("bucket") == gates.READY).select(key, F.col("value").alias(column))
    return resolve.fill(master, [key], ready, [column])
