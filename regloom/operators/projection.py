"""The projection plan: rows of several producers, labelled by sheet, one winner for each key, and what people must look at.

All producers go through one aggregation by sheet, key and rank: of each rank only its first row and the order of arrival are
kept, so a key that many rows share makes no large group. A second aggregation over these few rows picks winners.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REVIEW = "review"


@dataclass(frozen=True)
class Producer:
    """rows: one source. sheet: the sheet a row belongs to, null for rows that take no part. values: the columns of the plan.
    doubts: reason to the condition under which the row is put up for review, beside its place in a sheet; a reason that
    starts with only: (as "only:unclassified") is for rows that go to review alone, whose sheet is named by `review_sheet`."""

    rows: DataFrame
    sheet: Column
    key: Column
    day: Column
    status: Column
    order: Column
    values: Mapping[str, Column] = field(default_factory=dict)
    doubts: Mapping[str, Column] = field(default_factory=dict)
    review_sheet: Column | None = None


def plan(producers: Sequence[Producer], ranks: Mapping[str, int], material: Sequence[str], default_rank: int = 0) -> DataFrame:
    """sheet, key, day, status, values, reason, n of all sheets and of the review queue (sheet 'review').

    A sheet has one row for each key: the one of the latest day, then of the highest rank of its status, then the one that
    arrives first, by producer in the order given and by its `order`. To the review queue, with the sheet it concerns in
    `of` and a reason, go rows that raise a doubt, rows without a key (missing_code), and rows that tie with the winner so far
    by day and rank but differ from it in a material value (same_date_material_conflict, one for each different text). n is
    the number of rows behind a row of the plan. Days and statuses that are null count as blank.
    """
    names = list(producers[0].values)
    long = None
    for i, p in enumerate(producers):
        day, status = F.coalesce(p.day.cast("string"), F.lit("")), F.coalesce(p.status, F.lit(""))
        at = F.struct(F.lit(i).alias("producer"), p.order.cast("string").alias("place"))
        values = F.struct(*[F.coalesce(p.values[n].cast("string"), F.lit("")).alias(n) for n in names])
        key = F.trim(F.coalesce(p.key.cast("string"), F.lit("")))
        own = lambda sheet, of, reason: F.struct(sheet.alias("sheet"), of.alias("of"), reason.alias("reason"))
        of = p.sheet if p.review_sheet is None else F.coalesce(p.sheet, p.review_sheet)
        told = [F.when(p.sheet.isNotNull() & (key != ""), own(p.sheet, F.lit(""), F.lit(""))), F.when(p.sheet.isNotNull() & (key == ""), own(F.lit(REVIEW), of, F.lit("missing_code")))]
        for reason, doubt in p.doubts.items():
            alone = reason.startswith("only:")
            there = p.sheet.isNull() if alone else p.sheet.isNotNull()
            told.append(F.when(there & F.coalesce(doubt, F.lit(False)), own(F.lit(REVIEW), of, F.lit(reason.removeprefix("only:")))))
        rows = p.rows.select(key.alias("key"), day.alias("day"), status.alias("status"), at.alias("at"), values.alias("values"), F.inline(F.filter(F.array(*told), lambda x: x.isNotNull())))
        long = rows if long is None else long.unionByName(rows)
    rank = F.lit(default_rank)
    for status_, r in ranks.items():
        rank = F.when(F.col("status") == status_, F.lit(r)).otherwise(rank)
    same = F.struct("status", *[F.col(f"values.{m}").alias(m) for m in material])
    long = long.withColumn("class", F.struct("day", rank.alias("rank"))).withColumn("same", same)
    # one row for each different text of a rank: who came first with it
    texts = long.groupBy("sheet", "of", "reason", "key", "class", "same").agg(F.min(F.struct("at", "status", "values")).alias("first"), F.count("*").alias("n"))
    ranked = texts.groupBy("sheet", "of", "reason", "key", "class").agg(F.min(F.struct("first", "same")).alias("head"), F.collect_list(F.struct("first", "same", "n")).alias("texts"))
    whole = ranked.groupBy("sheet", "of", "reason", "key").agg(F.array_sort(F.collect_list(F.struct("class", "head", "texts"))).alias("ranks"))
    # a rank leads from its first row on until a row of a higher one arrives
    best = F.element_at("ranks", -1)

    def doubted(x: Column, i: Column) -> Column:
        above = F.array_min(F.transform(F.slice("ranks", i + 2, F.size("ranks")), lambda r: r["head"]["first"]["at"]))
        other = F.filter(x["texts"], lambda t: (t["same"] != x["head"]["same"]) & (above.isNull() | (t["first"]["at"] < above)))
        return F.transform(other, lambda t: F.struct(F.lit(REVIEW).alias("sheet"), F.col("sheet").alias("of"), F.lit("same_date_material_conflict").alias("reason"), x["class"]["day"].alias("day"), t["first"]["status"].alias("status"), t["first"]["values"].alias("values"), t["n"].alias("n")))

    n = F.aggregate(F.flatten(F.transform("ranks", lambda r: F.transform(r["texts"], lambda t: t["n"]))), F.lit(0).cast("long"), lambda a, b: a + b)
    winner = F.struct(F.col("sheet"), F.lit("").alias("of"), F.lit("").alias("reason"), best["class"]["day"].alias("day"), best["head"]["first"]["status"].alias("status"), best["head"]["first"]["values"].alias("values"), n.alias("n"))
    conflicts = F.flatten(F.transform("ranks", doubted))
    queued = F.flatten(F.transform("ranks", lambda r: F.transform(r["texts"], lambda t: F.struct(F.col("sheet").alias("sheet"), F.col("of").alias("of"), F.col("reason").alias("reason"), r["class"]["day"].alias("day"), t["first"]["status"].alias("status"), t["first"]["values"].alias("values"), t["n"].alias("n")))))
    out = F.when(F.col("sheet") == REVIEW, queued).otherwise(F.concat(F.array(winner), conflicts))
    return whole.select("key", F.explode(out).alias("r")).select("r.sheet", "r.of", "r.reason", "key", "r.day", "r.status", "r.values.*", "r.n")
