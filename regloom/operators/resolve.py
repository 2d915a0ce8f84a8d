"""One winner per key from many conflicting rows, and joins that fill or override.

Ties are always decided by an explicit position column; nothing relies on the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under a total order."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each key, with their rank from 1."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def top_evidence(df: DataFrame, keys: Sequence[str], same: Sequence[str], order: Sequence[Column], n: int = 8) -> DataFrame:
    """At most n rows of each key after one row is kept of each `same` group."""
    return top_by(latest_by(df, [*keys, *same], order), keys, order, n)


def evidence_status(df: DataFrame, key: str, date: Column, repeal: Column) -> DataFrame:
    """key, active, repealed (their latest dates, '' without any) and status; a repeal wins a tie."""
    latest = lambda p: F.coalesce(F.max(F.when(p & (date != ""), date)), F.lit(""))
    out = df.groupBy(key).agg(latest(~repeal).alias("active"), latest(repeal).alias("repealed"))
    status = F.when((F.col("repealed") == "") & (F.col("active") == ""), "needs_verification").when(F.col("repealed") >= F.col("active"), "repealed").otherwise("active")
    return out.withColumn("status", status)


def best_mapping(candidates: Sequence[DataFrame], key: str, order: Sequence[Column]) -> DataFrame:
    """Union of sources, each with its source_ord, and the best row of each key."""
    union = None
    for i, c in enumerate(candidates):
        c = c.withColumn("source_ord", F.lit(i))
        union = c if union is None else union.unionByName(c, allowMissingColumns=True)
    return latest_by(union, [key], order)


def consensus(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """keys, value (where all rows agree), n_values."""
    n = F.count_distinct(value)
    return df.groupBy(*keys).agg(F.when(n == 1, F.min(value)).alias("value"), n.alias("n_values"))


def poisoned(df: DataFrame, keys: Sequence[str], unsafe: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.bool_or(F.coalesce(unsafe, F.lit(False))).alias("poisoned"))


def ordered_distinct(df: DataFrame, keys: Sequence[str], value: str, pos: str, n: int) -> DataFrame:
    """keys, value (array): the first n distinct values of each key in order of position; nulls are left out.

    Values are reduced to their first position before the shuffle, and the rank is a group limit, so a key that many rows
    share brings few rows to its task.
    """
    firsts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(pos).alias("_p"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("_p", value))
    few = firsts.withColumn("_rank", rank).where(F.col("_rank") <= n)
    pairs = F.array_sort(F.collect_list(F.struct("_rank", F.col(value).alias("v"))))
    return few.groupBy(*keys).agg(F.transform(pairs, lambda p: p["v"]).alias(value))


def merge_rows(df: DataFrame, keys: Sequence[str], pos: str, status: str, priority: Sequence[str], flag: str, name: str, context: str, longest: int = 240, chars: int = 2400, first: Sequence[str] = ()) -> DataFrame:
    """One row per key: highest status (first of equals), any flag, the longest name, contexts joined and cut, and of the first
    row the columns `first`.

    The first row's name is replaced only by a strictly longer one of at most `longest` characters. Of the contexts no more
    are gathered than can stand within `chars`; all else are partial aggregates.
    """
    level = F.coalesce(*[F.when(F.col(status) == s, F.lit(len(priority) - i)) for i, s in enumerate(priority)], F.lit(0))
    rows = df.withColumn("_level", level)
    length = lambda c: F.length(F.coalesce(c, F.lit("")))
    whole = rows.groupBy(*keys).agg(
        F.max_by(status, F.struct("_level", -F.col(pos))).alias(status),
        F.bool_or(flag).alias(flag),
        F.min_by(F.struct(F.col(name).alias("name"), *first), pos).alias("_first"),
        F.max_by(name, F.struct(F.when(length(F.col(name)) <= longest, length(F.col(name))).otherwise(-1), -F.col(pos))).alias("_longest"),
    )
    own = F.col("_first.name")
    better = (length(F.col("_longest")) > length(own)) & (length(F.col("_longest")) <= longest)
    whole = whole.withColumn(name, F.when(better, F.col("_longest")).otherwise(own))
    whole = whole.select(*keys, status, flag, name, *[F.col(f"_first.{c}").alias(c) for c in first])
    most = chars // 4 + 1  # a context and what joins it have four characters at least
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(pos))
    said = df.where(F.col(context) != "").select(*keys, pos, F.substring(context, 1, chars).alias("_c")).withColumn("_rank", rank).where(F.col("_rank") <= most)
    pairs = F.array_sort(F.collect_list(F.struct("_rank", "_c")))
    told = said.groupBy(*keys).agg(F.substring(F.array_join(F.transform(pairs, lambda x: x["_c"]), " | "), 1, chars).alias(context))
    return whole.join(told, list(keys), "left").withColumn(context, F.coalesce(context, F.lit("")))


def merge_longer(df: DataFrame, keys: Sequence[str], pos: str, texts: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """One row per key: of each text the longest that is not blank, the earliest of equals, else the empty text; flags as any row's."""
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.length(c).alias("n"), -F.col(pos)))
    best = [F.coalesce(F.max_by(c, filled(c)), F.lit("")).alias(c) for c in texts]
    return df.groupBy(*keys).agg(*best, *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in flags])


def merge_baseline(df: DataFrame, keys: Sequence[str], pos: str, texts: Sequence[str], lists: Sequence[str], fills: Sequence[str], separator: str = "; ") -> DataFrame:
    """One row per key: the longest text (the greatest of equals), the union of lists in order of appearance, blanks filled by
    the first row that has a value.

    A list is text whose entries stand between separators; entries are split, trimmed and kept once. Entries are reduced to
    their first place before they are gathered.
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    out = df.groupBy(*keys).agg(
        *[F.coalesce(F.max(F.when(filled(c), F.struct(F.length(c).alias("n"), F.col(c).alias("v"))))["v"], F.lit("")).alias(c) for c in texts],
        *[F.coalesce(F.min_by(c, F.when(filled(c), F.col(pos))), F.lit("")).alias(c) for c in fills],
    )
    for c in lists:
        entries = df.where(filled(c)).select(*keys, pos, F.posexplode(F.split(c, separator.strip())).alias("_i", "_e")).withColumn("_e", F.trim("_e")).where("_e <> ''")
        firsts = entries.groupBy(*keys, "_e").agg(F.min(F.struct(pos, "_i")).alias("_at"))
        joined = firsts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_e"))), lambda x: x["_e"]), separator).alias(c))
        out = out.join(joined, list(keys), "left").withColumn(c, F.coalesce(c, F.lit("")))
    return out


def longest_text(df: DataFrame, keys: Sequence[str], value: str, pos: str, most: int | None = None) -> DataFrame:
    """keys, value: the longest filled value of at most `most` characters; the earliest of equals."""
    good = df.where(F.col(value).isNotNull() & (F.col(value) != ""))
    if most is not None:
        good = good.where(F.length(value) <= most)
    return good.groupBy(*keys).agg(F.max_by(F.struct(F.col(pos), F.col(value)), F.struct(F.length(value), -F.col(pos))).alias("w")).select(*keys, f"w.{pos}", f"w.{value}")


def flagged_first(df: DataFrame, key: str, flag: str, name: str, pos: str) -> DataFrame:
    """One row per key: a flagged one, else the longer name, else the earlier; the flag is any row's."""
    any_flag = F.max(F.col(flag)).over(W.partitionBy(key))
    best = latest_by(df.withColumn("_any", any_flag), [key], [F.col(flag).desc(), F.length(name).desc(), F.col(pos)])
    return best.withColumn(flag, F.col("_any")).drop("_any")


def fill_agreed(df: DataFrame, key: str, column: str, listings: DataFrame, value: str) -> DataFrame:
    """Fill a missing value where all listings of the key give one."""
    one = consensus(listings.where(F.col(value) != ""), [key], F.col(value)).where("n_values = 1").select(key, F.col("value").alias("_agreed"))
    return df.join(one, key, "left").withColumn(column, F.coalesce(F.nullif(F.col(column), F.lit("")), "_agreed")).drop("_agreed")


def override(df: DataFrame, keys: Sequence[str], overrides: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of overrides replace those of existing rows; nulls there leave them. `changed` tells whether one differs."""
    o = overrides.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in columns])
    out = df.join(o, list(keys), "left")
    differs = F.lit(False)
    for c in columns:
        differs = differs | (F.col(f"_o_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_o_{c}")))
    out = out.withColumn("changed", differs)
    return out.withColumns({c: F.coalesce(f"_o_{c}", c) for c in columns}).drop(*[f"_o_{c}" for c in columns])


def override_with_evidence(df: DataFrame, key: str, level: str, evidence: str, overrides: DataFrame, n: int = 8) -> DataFrame:
    """Override a level only where it differs; the overriding evidence goes first and the list stays at n."""
    o = overrides.select(key, F.col(level).alias("_level"), F.col(evidence).alias("_evidence"))
    new = F.col("_level").isNotNull() & ~F.col("_level").eqNullSafe(F.col(level))
    out = df.join(o, key, "left").withColumn("changed", new)
    out = out.withColumn(evidence, F.when(new, F.slice(F.concat(F.array("_evidence"), F.col(evidence)), 1, n)).otherwise(F.col(evidence)))
    return out.withColumn(level, F.when(new, F.col("_level")).otherwise(F.col(level))).drop("_level", "_evidence")


def fill(df: DataFrame, keys: Sequence[str], more: DataFrame, columns: Sequence[str], unless: Column | None = None) -> DataFrame:
    """Values of more fill blanks only; rows for which `unless` holds stay as they are."""
    m = more.select(*keys, *[F.col(c).alias(f"_m_{c}") for c in columns])
    out = df.join(m, list(keys), "left")
    skip = F.coalesce(unless, F.lit(False)) if unless is not None else F.lit(False)
    value = lambda c: F.when(skip, F.col(c)).otherwise(F.coalesce(F.nullif(F.col(c), F.lit("")), f"_m_{c}", c))
    return out.withColumns({c: value(c) for c in columns}).drop(*[f"_m_{c}" for c in columns])


def flag_known(df: DataFrame, key: str, known: DataFrame, flag: str) -> DataFrame:
    k = known.select(key).distinct().withColumn("_known", F.lit(True))
    return df.join(k, key, "left").withColumn(flag, F.col("_known").isNotNull()).drop("_known")


def state_label(df: DataFrame, key: str, tables: Mapping[str, DataFrame], default: str, name: str = "state") -> DataFrame:
    """The name of the first table that holds the key."""
    out, label = df, F.when(F.lit(False), F.lit(default))
    for i, (state, table) in enumerate(tables.items()):
        out = out.join(table.select(key).distinct().withColumn(f"_in{i}", F.lit(True)), key, "left")
        label = label.when(F.col(f"_in{i}"), state)
    return out.withColumn(name, label.otherwise(default)).drop(*[f"_in{i}" for i in range(len(tables))])


def first_source(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Union by priority: each key from the first table that has it."""
    return best_mapping(tables, key, [F.col("source_ord")]).drop("source_ord")


def enrich(df: DataFrame, key: str, guidance: DataFrame, columns: Sequence[str], link: str, valid: Column) -> DataFrame:
    """Nest the filled guidance fields as `guidance`; the link is replaced only by one valid for the row itself."""
    nested = F.struct(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns])
    g = guidance.select(key, nested.alias("guidance"), F.col(link).alias("_link"))
    out = df.join(g, key, "left").withColumn(link, F.when(F.col("_link").isNotNull() & valid, F.col("_link")).otherwise(F.col(link)))
    return out.drop("_link")


def rule_flag(df: DataFrame, key: str, kind: str, types: DataFrame, rules: DataFrame, own: DataFrame) -> DataFrame:
    """Key -> type -> rule, with a rule of the key itself before that of its type."""
    r = rules.select(F.col(kind), F.col("rule").alias("_of_type"))
    out = df.join(types.select(key, kind), key, "left").join(r, kind, "left").join(own.select(key, F.col("rule").alias("_own")), key, "left")
    return out.withColumn("rule", F.coalesce("_own", "_of_type")).drop("_own", "_of_type")


def conflicts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie: Sequence[str], material: Sequence[str]) -> DataFrame:
    """Winners with `conflict`: another row of equal date and rank differs in a material column."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    rows = df.withColumn("_rank", rank)
    win = rows.where("_rank = 1").drop("_rank")
    lost = rows.where("_rank > 1").select(*keys, F.struct(*tie).alias("_tie"), F.struct(*material).alias("_m"))
    both = win.select(*keys, F.struct(*tie).alias("_wt"), F.struct(*material).alias("_wm")).join(lost, list(keys))
    bad = both.where(F.col("_wt").eqNullSafe(F.col("_tie")) & ~F.col("_wm").eqNullSafe(F.col("_m"))).select(*keys).distinct().withColumn("conflict", F.lit(True))
    return win.join(bad, list(keys), "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))
