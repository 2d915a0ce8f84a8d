"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a target number of words. Its weight schedule over training time u in [0, 1] is linear; the integral of
the schedule is the source's cumulative demand, and its inverse gives each document the training position at which its
words are due. Documents are range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, salts, staged, text_or_empty

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Slopes of the schedules in the same order: a source with slope a has weight in proportion to 1 + a (2u - 1).
SLOPES = (-0.5, 0.5, 0.0)
SHARE = 1.5
MOST_REPEATS = 2
#: Cells of sources, of about 60 bytes each, that are sent to all tasks; more are joined by key.
SMALL = 100_000


def source_targets(sizes: DataFrame, share: float = SHARE, weights=WEIGHTS, slopes=SLOPES, most: int = MOST_REPEATS) -> DataFrame:
    """From (source, source_size) to (source, source_size, target, slope); one row for each source.

    Targets share `share` of all sizes by weight, none above `most` times its source; the excess goes to the others by
    weight. In the order of cap / weight the capped sources come first, so one running sum finds them all.
    """
    every = W.partitionBy()
    k = F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    s = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (k + 1).cast("int"))).withColumn(
        "slope", F.element_at(F.array(*[F.lit(float(x)) for x in slopes]), (k + 1).cast("int"))
    )
    s = s.withColumn("cap", F.col("source_size") * most).withColumn("goal", F.sum("source_size").over(every) * F.lit(share))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    s = s.withColumn("capped", F.col("cap") <= level * F.col("weight"))
    left = F.col("goal") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    share_of = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(left * F.col("weight") / share_of).cast("double")
    return s.select("source", "source_size", target.alias("target"), "slope")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more) -> DataFrame:
    h = F.xxhash64(F.lit("mix"), F.col(id_col))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
        h.alias("h"), F.pmod(h, F.lit(salts(docs.sparkSession))).cast("int").alias("cell"), *more,
    )


def _assigned(rows: DataFrame) -> DataFrame:
    """rows with source_size, target, slope, start (words of its source before it in hash order) and taken."""
    # The running word count of a source is a count over its cells plus one within a cell: no task gets a whole source.
    cells = staged(rows.groupBy("source", "cell").agg(F.sum("size").alias("words")), "mix-cells")
    targets = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")))
    before = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("words_before", F.coalesce(F.sum("words").over(before), F.lit(0))).alias("c")
    t = targets.alias("t")
    cells = cells.join(t, F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        F.col("c.source").alias("c_source"), F.col("c.cell").alias("c_cell"), "words_before", "source_size", "target", "slope"
    )
    cells = staged(cells, "mix-targets")
    if cells.count() <= SMALL:  # few sources: documents need not be dealt out a second time
        cells = F.broadcast(cells)
    inside = W.partitionBy("source", "cell").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    d = rows.withColumn("in_cell", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell")))
    d = d.withColumn("start", F.col("in_cell") + F.col("words_before")).drop("c_source", "c_cell", "in_cell", "words_before")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    last = F.round(F.col("target") - passes * F.col("source_size")).cast("long")
    return d.withColumn("taken", (passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), last - F.col("start")))).cast("long"))


def _position(words_before, words):
    """Training position at which the middle of some words of a source is due: the inverse of its cumulative demand."""
    q = F.least(F.lit(1.0), (words_before + words / 2) / F.col("target"))
    a = F.col("slope")
    return F.when(a == 0, q).otherwise((a - 1 + F.sqrt((1 - a) * (1 - a) + 4 * a * q)) / (2 * a))


def _range_sorted(d: DataFrame) -> DataFrame:
    """By position; the hash spreads documents without one."""
    return d.repartitionByRange(F.col("position").asc_nulls_last(), "h").sortWithinPartitions(F.col("position").asc_nulls_last(), "h")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Return doc_id, size, source_size, target, taken, position for every document, range-sorted by position.

    taken: words that the mix takes of a document: whole passes over its source, then one more pass in hash order that
    stops at the target, within a document if need be. position: where on [0, 1] its first words are due (null: nothing
    is taken). Null texts have size 0; null sources form a source that comes last; repeated rows are documents of their
    own; other columns are not read; an empty table gives an empty result. Hash order depends on the id and size alone, so
    reruns agree.
    """
    d = _assigned(staged(_rows(docs, id_col, text_col, source_col), "mix-rows"))
    position = _position(F.col("start"), F.least(F.col("taken"), F.col("size")))
    d = _range_sorted(d.withColumn("position", F.when(F.col("taken") > 0, position)))
    return d.select("doc_id", "size", "source_size", "target", "taken", "position")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: docs' rows, one for each pass that takes them, range-sorted by training position.

    Texts stay whole: a document of which a pass takes only some words (one for each source at most) is taken if these are
    half of it or more, so a source is off its target by half a document at most. Documents without words, null texts
    among them, are in no pass; a null source is a source of its own; null ids and repeated rows are documents of their
    own; other columns stay; an empty table stays empty.
    """
    columns = docs.columns
    d = _assigned(_rows(docs, id_col, text_col, source_col, F.struct(*columns).alias("row"))).where("taken > 0")
    n = F.ceil(F.col("taken") / F.col("size")).cast("int")
    d = d.withColumn("pass", F.explode(F.sequence(F.lit(0), n - 1)))
    words = F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size"))
    d = d.withColumn("words", words).where(2 * F.col("words") >= F.col("size"))
    d = d.withColumn("position", _position(F.col("pass") * F.col("source_size") + F.col("start"), F.col("words")))
    d = _range_sorted(d.select("row", "position", "h"))
    return d.select(*[F.col(f"row.{c}").alias(c) for c in columns])
