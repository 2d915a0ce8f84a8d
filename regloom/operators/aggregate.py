"""Counters, coverage, crosstabs, facets and additive checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def summary(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """One row of conditional counts."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in metrics.items()])


def distinct_summary(df: DataFrame, key: str, metrics: Mapping[str, Column]) -> DataFrame:
    """One row of distinct keys by condition."""
    return df.agg(*[F.count_distinct(F.when(c, F.col(key))).alias(n) for n, c in metrics.items()])


def split_counter(df: DataFrame, text: Column, pattern: str, alias: Mapping[str, str] | None = None) -> DataFrame:
    """token, n: every occurrence counts, aliases are rewritten, blanks go."""
    t = df.select(F.explode(F.split(text, pattern)).alias("token")).withColumn("token", F.trim("token")).where("token <> ''")
    if alias:
        pairs = F.create_map(*[F.lit(x) for kv in alias.items() for x in kv])
        t = t.withColumn("token", F.coalesce(F.try_element_at(pairs, F.col("token")), "token"))
    return t.groupBy("token").agg(F.count("*").alias("n"))


def grouped_counter(df: DataFrame, group: str, token: str, row: str) -> DataFrame:
    """group, token, n: distinct rows; ordered within a group by -n, then token, as `place`."""
    n = df.groupBy(group, token).agg(F.count_distinct(row).alias("n"))
    return n.withColumn("place", F.row_number().over(W.partitionBy(group).orderBy(F.col("n").desc(), token)))


def first_and_count(df: DataFrame, group: str, text: str, pos: str) -> DataFrame:
    return df.groupBy(group).agg(F.min_by(text, pos).alias(text), F.count("*").alias("n"))


def long_form(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.unpivot([key], [F.col(c).cast("string").alias(c) for c in columns], "field", "value")


def coverage(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """field, filled, blank."""
    filled = F.coalesce(F.col("value") != "", F.lit(False))
    return long_form(df, key, columns).groupBy("field").agg(F.count_if(filled).alias("filled"), F.count_if(~filled).alias("blank"))


def unresolved(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """field, key: the keys whose field is blank."""
    return long_form(df, key, columns).where(F.coalesce("value", F.lit("")) == "").select("field", key)


def totals_by(df: DataFrame, column: str, classes: Sequence[str], other: str = "other") -> DataFrame:
    """class, n: rows of each of a closed list of classes, those without a row included, and of all others."""
    asked = F.array(*map(F.lit, [*classes, other]))
    known = F.when(F.col(column).isin(*classes), F.col(column)).otherwise(other)
    n = df.groupBy(known.alias("class")).agg(F.count("*").alias("n"))
    return df.sparkSession.range(1).select(F.explode(asked).alias("class")).join(n, "class", "left").select("class", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(str(v)) for v in values])


def several(df: DataFrame, key: str, n: int = 50) -> DataFrame:
    """The n keys with most rows, of those with more than one."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.col("n").desc(), key).limit(n)


def facets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """facet, value, n of several columns in one scan."""
    spread = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(spread)).groupBy("facet", "value").agg(F.count("*").alias("n"))


def additive(df: DataFrame, outer: str, inner: str, value: Column) -> DataFrame:
    """outer, inner, n, total, level by rollup: 0 the parts, 1 each group, 3 all."""
    return df.rollup(outer, inner).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.grouping_id().cast("int").alias("level"))


def additive_errors(parts: DataFrame, group: str, value: str, totals: DataFrame) -> DataFrame:
    """Groups whose parts do not sum to their given total."""
    s = parts.groupBy(group).agg(F.sum(value).alias("parts"))
    return s.join(totals.select(group, F.col(value).alias("given")), group, "full").where(~F.col("parts").eqNullSafe(F.col("given")))


def newest_date(df: DataFrame, raw: Column, names: Sequence[str]) -> DataFrame:
    """The latest date of any of the named keys anywhere in raw JSON texts."""
    found = F.regexp_extract_all(raw, F.lit(rf'"(?:{"|".join(names)})"\s*:\s*"(\d{{4}}-\d{{2}}-\d{{2}})'), F.lit(1))
    return df.agg(F.max(F.array_max(found)).alias("newest"))


def report_lines(sections: Mapping[str, DataFrame]) -> DataFrame:
    """(section, line) rows for a text sink, from one-row tables."""
    out = None
    for i, (title, t) in enumerate(sections.items()):
        lines = F.array(F.lit(f"## {title}"), *[F.concat(F.lit(f"- {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in t.columns])
        rows = t.select(F.lit(i).alias("section"), F.posexplode(lines).alias("pos", "line"))
        out = rows if out is None else out.unionByName(rows)
    return out


def link_findings(rows: DataFrame, key: Column, url: Column, route: Column, wanted: Column, got: Column) -> DataFrame:
    """kind, value, key of submission links: the route each takes, and what is missing, invalid, mismatched or by keyword.

    route: struct(ok, route) of the link. wanted, got: the id of the record and that in its link. A row is missing without a
    link, invalid by its reason, else it has a route, and besides a mismatch where it has an id that the link lacks, or a
    keyword where it has none. Rows with an id are told as with_id.
    """
    # what several conditions ask for is made once, as columns: the route alone holds dozens of patterns
    rows = rows.select(key.cast("string").alias("key"), F.trim(url).alias("url"), F.trim(wanted).alias("wanted"), got.alias("got"), route["ok"].alias("ok"), route["route"].alias("route"))
    there, has_id = F.coalesce("url", F.lit("")) != "", F.coalesce("wanted", F.lit("")) != ""
    ok, name, none = F.col("ok"), F.col("route"), F.lit("")
    told = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    seen = F.array(
        F.when(has_id, told("with_id", none)),
        F.when(~there, told("missing", none)),
        F.when(there & ~ok, told("invalid", name)),
        F.when(there & ok, told("route", name)),
        F.when(there & ok & has_id & ~F.col("wanted").eqNullSafe(F.col("got")), told("mismatch", none)),
        F.when(there & ok & ~has_id, told("keyword", name)),
    )
    return rows.select("key", F.inline(F.filter(seen, lambda x: x.isNotNull()))).select("kind", "value", "key")


def link_audit(found: DataFrame) -> DataFrame:
    """kind, value, n of link_findings."""
    return found.groupBy("kind", "value").agg(F.count("*").alias("n"))
