"""Declarative expectations: each rule is a condition, and all rules over a table are evaluated in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """bad: the condition under which a row is a finding."""

    code: str
    bad: Column
    message: Column | str = ""
    severity: str = "error"


def findings(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """severity, code, key, message for every row and rule that fails; a null condition does not."""
    told = [
        F.when(F.coalesce(r.bad, F.lit(False)), F.struct(F.lit(r.severity).alias("severity"), F.lit(r.code).alias("code"), (r.message if isinstance(r.message, Column) else F.lit(r.message)).alias("message")))
        for r in rules
    ]
    return df.select(F.col(key).cast("string").alias("key"), F.inline(F.filter(F.array(*told), lambda x: x.isNotNull()))).select("severity", "code", "key", "message")


def with_duplicates(df: DataFrame, key: str, name: str = "same_key") -> DataFrame:
    return df.withColumn(name, F.count("*").over(W.partitionBy(key)))


def missing(columns: Sequence[str], code: str = "MISSING_FIELD") -> list[Rule]:
    return [Rule(code, F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), c) for c in columns]


def one_of(column: str, values: Sequence[str], code: str = "BAD_ENUM") -> Rule:
    return Rule(code, F.col(column).isNotNull() & ~F.col(column).isin(*values), F.col(column).cast("string"))


def matches(column: str, pattern: str, code: str = "FORMAT") -> Rule:
    return Rule(code, ~F.col(column).rlike(pattern), F.col(column).cast("string"))


def precedence(field_roles: Column, field: str, needed: Sequence[str], forbidden: Sequence[str], code: str = "PRECEDENCE") -> list[Rule]:
    """A field's sources must hold a needed role, and no forbidden one. field_roles: map(field -> array of roles)."""
    roles = F.try_element_at(field_roles, F.lit(field))
    want = F.array(*map(F.lit, needed)) if needed else None
    out = [Rule(code, roles.isNotNull() & ~F.arrays_overlap(roles, want), f"{field}: lacks {'/'.join(needed)}")] if needed else []
    if forbidden:
        out.append(Rule(code, F.arrays_overlap(roles, F.array(*map(F.lit, forbidden))), f"{field}: {'/'.join(forbidden)}"))
    return out


def lifecycle(status: str, start: str, end: str, as_of: Column, active: str = "active", code: str = "LIFECYCLE") -> list[Rule]:
    return [
        Rule(code, (F.col(end) != "") & (F.col(start) > F.col(end)), "ends before it starts"),
        Rule(code, (F.col(status) == active) & (F.col(end) != "") & (F.col(end) < as_of), "active behind its end"),
        Rule(code, (F.col(status) == active) & (F.col(start) > as_of), "active before its start"),
    ]


def review_queue(found: DataFrame) -> DataFrame:
    """key, n, errors, codes: what a person has to look at."""
    return found.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == "error").alias("errors"), F.array_join(F.sort_array(F.collect_set("code")), ",").alias("codes"))


def rule_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("severity", "code").agg(F.count("*").alias("n"))


def gate(found: DataFrame, drifted: DataFrame | None = None) -> bool:
    """Whether nothing stops a release: no error and no drift."""
    return found.where("severity = 'error'").isEmpty() and (drifted is None or drifted.isEmpty())


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Stop the job on the first row that breaks a precondition."""
    return df.where(F.when(condition, True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
