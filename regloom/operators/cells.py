"""Table cells of pages to records: headers are found by what they say, and columns by theirs, within the row's arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as tx

#: A header stands among the first rows of a table.
WITHIN = 6
#: What headers say, folded.
PROCESS = ("hinh thuc nop", "thoi han")
CHANNEL, TIME, FEE, NOTE = ("hinh thuc nop", "cach thuc"), ("thoi han",), ("phi", "le phi"), ("mo ta", "ghi chu")
PAPER, FORM, ORIGINAL, COPY, AMOUNT = ("ten giay to", "thanh phan ho so", "loai giay to"), ("mau don", "to khai", "bieu mau"), ("ban chinh",), ("ban sao",), ("so luong",)
UNKNOWN_CHANNEL = "Không xác định"
NOT_LISTED, NOT_LISTED_NOTE = "not_listed_on_dvcqg", "Cột Phí, lệ phí trên nguồn DVCQG chính thức không hiển thị mức thu."

TIMES = "array<struct<channel:string,time:string,note:string>>"
FEES = "array<struct<channel:string,fee:string,status:string,note:string>>"
PAPERS = "array<struct<name:string,form:string,original:string,copy:string,amount:string>>"


def _clean(row: Column) -> Column:
    return F.transform(F.coalesce(row, F.array().cast("array<string>")), lambda c: F.coalesce(tx.squeeze(c), F.lit("")))


def _says(folded: Column, terms: Sequence[str], all_: bool) -> Column:
    hits = [folded.contains(t) for t in terms]
    out = hits[0]
    for h in hits[1:]:
        out = (out & h) if all_ else (out | h)
    return out


def _headed(table: Column, terms: Sequence[str], all_: bool) -> Column:
    """struct(head, body) of a table whose header is the first of its first rows that says the terms; null without one."""
    rows = F.transform(table, _clean)
    at = F.array_position(F.transform(F.slice(rows, 1, WITHIN), lambda r: _says(tx.fold(F.array_join(r, " ")), terms, all_)), True).cast("int")
    body = F.filter(F.slice(rows, at + 1, F.greatest(F.size(rows), F.lit(1))), lambda r: F.exists(r, lambda c: c != ""))
    return F.when(at > 0, F.struct(F.get(rows, at - 1).alias("head"), body.alias("body")))


def _column(head: Column, needles: Sequence[str]) -> Column:
    """Place from 0 of the first header that says a needle; null without one."""
    at = F.array_position(F.transform(head, lambda c: _says(tx.fold(c), needles, False)), True).cast("int")
    return F.when(at > 0, at - 1)


def _cell(row: Column, at: Column) -> Column:
    return F.coalesce(F.get(row, at), F.lit(""))


def process(tables: Column) -> Column:
    """struct(times, fees) of the first table on ways to hand in and time limits; each entry once, in order.

    tables: array of tables of rows of cells. A blank channel is unknown; where there is a column of fees without any fee, one
    entry says so. Without such a table both are empty. Short rows count as filled up with blanks; null rows as empty.
    """
    found = F.filter(F.transform(tables, lambda t: _headed(t, PROCESS, True)), lambda t: t.isNotNull())
    t = F.get(found, F.lit(0))
    head, body = t["head"], t["body"]
    channel, time, fee, note = (_column(head, n) for n in (CHANNEL, TIME, FEE, NOTE))
    blank_as = lambda x, other: F.when(x != "", x).otherwise(F.lit(other))
    times = F.transform(
        F.filter(body, lambda r: _cell(r, time) != ""), lambda r: F.struct(blank_as(_cell(r, channel), UNKNOWN_CHANNEL).alias("channel"), _cell(r, time).alias("time"), F.nullif(_cell(r, note), F.lit("")).alias("note"))
    )
    empty = F.lit(None).cast("string")
    fees = F.transform(
        F.filter(body, lambda r: _cell(r, fee) != ""), lambda r: F.struct(blank_as(_cell(r, channel), UNKNOWN_CHANNEL).alias("channel"), _cell(r, fee).alias("fee"), empty.alias("status"), empty.alias("note"))
    )
    unlisted = F.array(F.struct(empty.alias("channel"), empty.alias("fee"), F.lit(NOT_LISTED).alias("status"), F.lit(NOT_LISTED_NOTE).alias("note")))
    fees = F.when(fee.isNotNull() & (F.size(fees) == 0), unlisted).otherwise(fees)
    none = F.array()
    return F.struct(F.coalesce(F.array_distinct(times).cast(TIMES), none.cast(TIMES)).alias("times"), F.coalesce(F.array_distinct(fees).cast(FEES), none.cast(FEES)).alias("fees"))


def dossier(tables: Column) -> Column:
    """Papers to hand in, of all tables that list them: the first of each name and form, as folded, in order.

    Counts of originals and copies come from their columns, else from the text of the amount. Repeated headers are no papers.
    """
    found = F.filter(F.transform(tables, lambda t: _headed(t, PAPER, False)), lambda t: t.isNotNull())

    def papers(t: Column) -> Column:
        head = t["head"]
        name, form, original, copy, amount = (_column(head, n) for n in (PAPER, FORM, ORIGINAL, COPY, AMOUNT))
        listed = F.filter(t["body"], lambda r: (_cell(r, name) != "") & ~tx.fold(_cell(r, name)).isin(*PAPER))
        given = lambda x: F.nullif(x, F.lit(""))
        counted = lambda r, what: given(F.regexp_extract(_cell(r, amount), rf"(?iu){what}\s*:\s*(\d+)", 1))
        return F.transform(
            listed,
            lambda r: F.struct(
                _cell(r, name).alias("name"), given(_cell(r, form)).alias("form"), F.coalesce(given(_cell(r, original)), counted(r, "bản chính")).alias("original"),
                F.coalesce(given(_cell(r, copy)), counted(r, "bản sao")).alias("copy"), given(_cell(r, amount)).alias("amount"),
            ),
        )

    every = F.flatten(F.transform(found, papers))
    keys = F.transform(every, lambda p: F.struct(tx.fold(p["name"]).alias("n"), tx.fold(F.coalesce(p["form"], F.lit(""))).alias("f")))
    once = F.transform(F.filter(F.arrays_zip(every.alias("p"), keys.alias("k")), lambda x, i: F.array_position(keys, x["k"]) == i + 1), lambda x: x["p"])
    return F.coalesce(once.cast(PAPERS), F.array().cast(PAPERS))
