"""Assemble published records: prioritised sources, parsed items, cards and digests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import dmy, first_filled
from .resolve import first_source
from .search import ordinal


def materialise(targets: DataFrame, key: str, sources: Sequence[DataFrame], execution: DataFrame, legal: DataFrame, times: DataFrame, values: Sequence[str]) -> DataFrame:
    """Each target with its first source (exceptions before candidates), execution, legal basis and time override.

    legal has `base` and `own`, of which the own one wins. `missing` lists what a complete record lacks.
    """
    picked = first_source(sources, key).select(key, *values)
    out = targets.select(key).join(picked, key, "left").join(execution.select(key, "agency"), key, "left")
    out = out.join(legal.select(key, first_filled(F.col("own"), F.col("base")).alias("legal")), key, "left")
    out = out.join(times.select(key, F.col("time").alias("_time")), key, "left")
    if "time" in values:
        out = out.withColumn("time", first_filled(F.col("_time"), F.col("time")))
    else:
        out = out.withColumnRenamed("_time", "time").withColumn("_time", F.lit(None))
    parts = [*values, "agency", "legal"]
    lacks = F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c)) for c in parts])
    return out.drop("_time").withColumn("missing", F.filter(lacks, lambda x: x.isNotNull()))


def bullet_items(text: Column, bullet: str = r"[-•*+]") -> Column:
    """Items of a bulleted text, without bullets and blanks; none for a blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), rf"(?:^|\n)\s*{bullet}\s+|\n")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def channel_items(text: Column, separator: str = " — ") -> Column:
    """array<struct<channel, quantity, unit, note>> from lines CHANNEL — QTY UNIT — note."""
    def item(line: Column) -> Column:
        p = F.split(line, separator)
        amount = F.trim(F.get(p, F.lit(1)))
        return F.struct(
            F.trim(F.get(p, F.lit(0))).alias("channel"), F.try_to_number(F.regexp_extract(amount, r"^(\d+)", 1), F.lit("999999")).cast("int").alias("quantity"),
            F.trim(F.regexp_replace(amount, r"^\d+", "")).alias("unit"), F.coalesce(F.trim(F.get(p, F.lit(2))), F.lit("")).alias("note"),
        )

    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\n"), lambda x: F.trim(x) != "")
    return F.transform(lines, item)


def published(items: Column) -> Column:
    return F.when(F.size(items) > 0, "published").otherwise("not_published")


def decision_labels(df: DataFrame, date: str, published_on: str, number: str, title: str, effective: Column, as_of: Column, default_title: str) -> DataFrame:
    """Labels of decisions with their order: newest first, by date or else publication, then number."""
    when = first_filled(F.col(date), F.col(published_on))
    out = df.select(
        number, first_filled(F.col(title), F.lit(default_title)).alias("title"), dmy(when).alias("date"),
        F.when(effective > as_of, F.concat(F.lit("from "), dmy(effective))).otherwise("in force").alias("label"), when.alias("_when"),
    )
    return ordinal(out, [F.col("_when").desc(), F.col(number).desc()], number, "place").drop("_when")


def card(labels: Mapping[str, str], kind: Column, parts: Sequence[Column], sources: Column, role: str) -> Column:
    """struct(label, text, url): a mapped label, joined parts, and the url of the preferred role, else of the last source."""
    names = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    own = F.filter(sources, lambda s: s["role"] == role)
    url = F.coalesce(F.get(own, F.lit(0))["url"], F.get(sources, F.size(sources) - 1)["url"])
    text = F.concat_ws(" · ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])
    return F.struct(F.coalesce(F.try_element_at(names, kind), kind).alias("label"), text.alias("text"), url.alias("url"))


def digest(tasks: DataFrame, basis: DataFrame, ids: Sequence[str], basis_id: str, domain: str, name: str, pos: str, first: int = 6) -> DataFrame:
    """For each domain: tasks, those with a legal basis by any of several id columns, and the first names."""
    b = basis.select(F.col(basis_id).cast("string").alias("_id")).distinct().withColumn("_has", F.lit(1))
    any_id = F.array_distinct(F.filter(F.array(*[F.col(c).cast("string") for c in ids]), lambda x: x.isNotNull()))
    hit = tasks.select(pos, F.explode(any_id).alias("_id")).join(b, "_id", "left_semi").select(pos).distinct().withColumn("_basis", F.lit(True))
    counts = tasks.join(hit, pos, "left").groupBy(domain).agg(F.count("*").alias("tasks"), F.count_if(F.col("_basis")).alias("with_basis"))
    # the rank is a group limit: of a domain with many tasks only the first come to its task
    rank = F.row_number().over(W.partitionBy(domain).orderBy(pos))
    few = tasks.select(domain, pos, name).withColumn("_rank", rank).where(F.col("_rank") <= first)
    names = F.array_sort(F.collect_list(F.struct("_rank", F.col(name).alias("n"))))
    told = few.groupBy(F.col(domain).alias("_domain")).agg(F.array_join(F.transform(names, lambda x: x["n"]), "; ").alias("names"))
    return counts.join(told, F.col(domain).eqNullSafe(F.col("_domain"))).drop("_domain")


def tracking(events: DataFrame, key: str, current: DataFrame, excluded: DataFrame, states: Mapping[str, str]) -> DataFrame:
    """Each event with where its key stands now: current, an excluded state, or nowhere."""
    c = current.select(key).distinct().withColumn("_c", F.lit(True))
    pairs = F.create_map(*[F.lit(x) for kv in states.items() for x in kv])
    e = excluded.groupBy(key).agg(F.max(F.try_element_at(pairs, F.col("reason"))).alias("_e"))
    out = events.join(c, key, "left").join(e, key, "left")
    return out.withColumn("state", F.when(F.col("_c"), "current").otherwise(F.coalesce("_e", F.lit("not_in_current_master")))).drop("_c", "_e")
