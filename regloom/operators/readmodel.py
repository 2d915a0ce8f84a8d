"""A keyed read model: manual columns stay, rows that vanish are held, every change is logged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import catalogue
from ..functions.evidence import change_json, changes
from ..functions.text import first_filled, fold


def scope(authority: Column, prefixes: dict[str, Sequence[str]], default: str = "unknown") -> Column:
    """Scope whose prefix the folded authority starts with."""
    f = fold(F.trim(authority))
    out = F.when(F.lit(False), F.lit(default))
    for value, starts in prefixes.items():
        for s in starts:
            out = out.when(f.startswith(s), value)
    return out.otherwise(default)


def project(df: DataFrame, columns: dict[str, Sequence[str] | Column]) -> DataFrame:
    """String columns: an expression, or the first filled of several columns."""
    return df.select(*[(c if isinstance(c, Column) else first_filled(*map(F.col, c))).cast("string").alias(n) for n, c in columns.items()])


#: Columns of a record that a projected column takes its value from: the first filled one counts.
PROJECTED_FROM = {
    "Mã TTHC": ("key", "code"), "Thủ tục hành chính": ("title", "name"), "Lĩnh vực": ("domain", "field"), "Cơ quan/đơn vị giải quyết": ("agency",),
    "Cấp thực hiện": ("level",), "Quyết định ban hành/công bố": ("decision",), "Thời gian giải quyết": ("time",), "Phí": ("fee",), "Dịch vụ công": ("online",),
    "Ngày hiệu lực": ("future_date",), "Nguồn chính thức": ("article_url",), "Nguồn đối soát bổ sung": ("attachment_url",), "Ngày kiểm tra/cập nhật": ("snapshot_date",),
}


def record_projection(df: DataFrame, status: Column, note: Column, given: dict[str, Column] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """All projected columns of records, in their order, as texts; blank where nothing is known.

    given: values of a producer by projected column, which go before the record's own ones unless blank. Who published a decision
    and which decision ended a record follow from the decision and the status. A row without a title or a field asks for review.
    Null and blank are the same; columns of PROJECTED_FROM that df lacks count as blank; one row for each row of df. carry: further
    columns that stay.
    """
    given = given or {}

    def value(c: str) -> Column:
        more = [given[c]] if c in given else []
        return first_filled(*more, *[F.col(n) for n in PROJECTED_FROM.get(c, ()) if n in df.columns])

    columns = {c: value(c) for c in catalogue.PROJECTED_COLUMNS}
    derived = catalogue.derived_columns(columns["Quyết định ban hành/công bố"], status)
    columns |= {"Cơ quan công bố": derived["publisher"], "Quyết định/văn bản thay thế, bãi bỏ": derived["ended_by"]}
    columns |= {"Tình trạng hiệu lực": F.coalesce(status, F.lit("")), "Ghi chú cập nhật": F.coalesce(note, F.lit(""))}
    columns["Cần đối soát?"] = F.when((columns["Thủ tục hành chính"] == "") | (columns["Lĩnh vực"] == ""), "Có").otherwise("")
    return df.select(*[F.col(c) for c in carry], *[x.alias(c) for c, x in columns.items()])


def upsert(existing: DataFrame, projected: DataFrame, key: str, automatic: Sequence[str], manual: Sequence[str], status: str, held: str, marker: str, note: str) -> DataFrame:
    """Merge a projection into the read model; action is insert, update, keep or hold.

    Manual columns of an existing row always win, even blank ones. A key that the projection lacks keeps its row, with the
    held status and the marker appended once to the note. before and after are JSON of what changed.
    """
    columns = [*automatic, *manual]
    e = existing.select(key, *[F.col(c).alias(f"e_{c}") for c in columns], F.lit(1).alias("_e"))
    p = projected.select(key, *[F.col(c).alias(f"p_{c}") for c in columns], F.lit(1).alias("_p"))
    both = e.join(p, key, "full")
    old, new = F.col("_e").isNotNull(), F.col("_p").isNotNull()

    def merged(c: str) -> Column:
        if c == status:
            gone = F.lit(held)
        elif c == note:
            before = F.coalesce(f"e_{c}", F.lit(""))
            gone = F.when(before.contains(marker), before).otherwise(F.trim(F.concat_ws(" ", F.nullif(before, F.lit("")), F.lit(marker))))
        else:
            gone = F.col(f"e_{c}")
        here = F.when(old, F.col(f"e_{c}")).otherwise(F.col(f"p_{c}")) if c in manual else F.col(f"p_{c}")
        return F.when(new, here).otherwise(gone)

    out = both.withColumns({c: merged(c) for c in columns})
    diff = changes({c: F.col(f"e_{c}") for c in columns}, {c: F.col(c) for c in columns})
    out = out.withColumn("_d", diff)
    action = F.when(~old, "insert").when(~new, "hold").when(F.size("_d") > 0, "update").otherwise("keep")
    return out.select(key, *columns, action.alias("action"), F.when(old, change_json(F.col("_d"), "before")).alias("before"), change_json(F.col("_d"), "after").alias("after"))


def refuse_empty(projected: DataFrame) -> DataFrame:
    if projected.isEmpty():
        raise ValueError("the projection is empty; the read model stays as it is")
    return projected


def refuse_conflicts(manual: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Duplicates of a key must agree in their manual columns."""
    n = manual.groupBy(key).agg(F.count_distinct(F.struct(*[F.coalesce(c, F.lit("")) for c in columns])).alias("n"))
    if not n.where("n > 1").isEmpty():
        raise ValueError("manual rows of one key differ")
    return manual


def write_verified(spark: SparkSession, model: DataFrame, path: str, key: str, automatic: Sequence[str]) -> DataFrame:
    """Write a new version, read it back and compare it before anyone is pointed to it."""
    model.write.mode("errorifexists").parquet(path)
    back = spark.read.parquet(path)
    want, got = model.select(key, *automatic), back.select(key, *automatic)
    if not (want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()):
        raise ValueError(f"{path} does not hold what was written")
    return back


def delta_notes(delta: DataFrame, key: str, labels: dict[str, str]) -> DataFrame:
    """A note for each key; a removed key is not said to be repealed."""
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return delta.select(key, F.try_element_at(pairs, F.col("change")).alias("note"))
