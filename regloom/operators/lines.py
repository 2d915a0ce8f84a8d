"""Operators on the lines of documents. Frames are partitioned by document (and page), so state is bounded by a page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def document_lines(df: DataFrame, doc: str, page: str, text: str, skip: int = 0) -> DataFrame:
    """doc, page, line_no, line: squeezed filled lines; the first `skip` pages go where a document has more."""
    if skip:
        df = df.withColumn("_pages", F.max(page).over(W.partitionBy(doc))).where((F.col("_pages") <= skip) | (F.col(page) > skip))
    lines = df.select(doc, page, F.posexplode(F.split(F.col(text), r"\r\n|\r|\n")).alias("line_no", "line"))
    return lines.withColumn("line", F.trim(F.regexp_replace("line", r"(?U)\s+", " "))).where("line <> ''")


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, name: str, initial: Column | None = None) -> DataFrame:
    """The last non-null value up to and with this row."""
    last = F.last(value, ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn(name, F.coalesce(last, initial) if initial is not None else last)


def split_token_repair(df: DataFrame, keys: Sequence[str], order: Sequence[Column], line: str, partial: str, rest: str) -> DataFrame:
    """Where a line ends in a part of a token and the next one starts with its rest, the rest moves up."""
    w = W.partitionBy(*keys).orderBy(*order)
    here, nxt, prev = F.col(line), F.lead(line).over(w), F.lag(line).over(w)
    moved = F.regexp_extract(nxt, f"^({rest})", 1)
    completes = here.rlike(f"{partial}$") & (moved != "")
    was = F.coalesce(prev.rlike(f"{partial}$") & (F.regexp_extract(here, f"^({rest})", 1) != ""), F.lit(False))
    kept = F.when(was, F.trim(F.regexp_replace(here, f"^({rest})", ""))).otherwise(here)
    return df.withColumn("_full", F.when(F.coalesce(completes, F.lit(False)), F.concat(kept, moved)).otherwise(kept)).withColumn(line, F.col("_full")).drop("_full")


def frame(df: DataFrame, keys: Sequence[str], order: Sequence[Column], line: str, before: int, after: int, name: str, separator: str = " ") -> DataFrame:
    """Lines from `before` above to `after` below, joined."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(-before, after)
    return df.withColumn(name, F.array_join(F.collect_list(line).over(w), separator))


def forward_name(df: DataFrame, keys: Sequence[str], order: Sequence[Column], line: str, stop: str, name: str, most: int = 15, chars: int = 220) -> DataFrame:
    """This and the next lines up to one that matches `stop`, or until `chars` are reached."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(1, most)
    nxt = F.collect_list(line).over(w)
    ends = F.array_position(F.transform(nxt, lambda x: x.rlike(stop)), True).cast("int")
    whole = F.when(ends > 0, F.slice(nxt, 1, ends - 1)).otherwise(nxt)
    return df.withColumn(name, F.substring(F.trim(F.array_join(F.concat(F.array(line), whole), " ")), 1, chars))


def until_next(df: DataFrame, keys: Sequence[str], order: Sequence[Column], opens: Column, name: str = "block") -> DataFrame:
    """Number the blocks that start at rows where `opens` holds; 0 before the first."""
    return df.withColumn(name, F.sum(opens.cast("int")).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def heading_asof(df: DataFrame, keys: Sequence[str], order: Sequence[Column], heading: Column, name: str) -> DataFrame:
    """The last heading strictly above, carried over pages."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(name, F.last(heading, ignorenulls=True).over(w))


def cell_bounds(df: DataFrame, keys: Sequence[str], y: str, reach: float = 58.0, ties: Sequence[str] = ()) -> DataFrame:
    """top and bottom of each cell: the middles to its neighbours, else `reach` away; cells of one height by ties, ascending."""
    w = W.partitionBy(*keys).orderBy(F.col(y).desc(), *ties)
    above, below = F.lag(y).over(w), F.lead(y).over(w)
    return df.withColumns({"top": F.coalesce((above + F.col(y)) / 2, F.col(y) + reach), "bottom": F.coalesce((below + F.col(y)) / 2, F.col(y) - reach)})


def last_marker_before(text: Column, at: Column, markers: dict[str, str], within: int = 1200) -> Column:
    """Class of the marker that stands last before a place, at most `within` characters away."""
    head = F.substring(text, F.greatest(at - within, F.lit(1)), F.least(at - 1, F.lit(within)))
    back = F.reverse(head)
    hits = [F.struct((-F.locate(marker[::-1], back)).alias("p"), F.lit(cls).alias("cls")) for marker, cls in markers.items()]
    return F.array_max(F.filter(F.array(*hits), lambda h: h["p"] < 0))["cls"]
