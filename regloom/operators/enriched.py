"""The public view of a record: guidance before the record's own columns before a default, and values of any type as one text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import catalogue
from ..functions.text import is_filled
from ..functions.urls import encoded


@dataclass(frozen=True)
class Items:
    """Names of the parts of an item, in the order in which they are asked; a part that a table lacks is null."""

    channel: str = "channel"
    main: Sequence[str] = ("value", "amount", "name", "result")
    note: Sequence[str] = ("description", "note")
    status: str = "status"
    unpublished: str = "not_published"
    access: str = "access_url"


def _part(x: Column, kind: T.StructType, name: str) -> Column:
    return x[name].cast("string") if name in kind.names else F.lit(None).cast("string")


def _not_blank(*xs: Column) -> Column:
    return F.array_compact(F.array(*[F.nullif(x, F.lit("")) for x in xs]))


def _item(x: Column, kind: T.DataType, names: Items) -> Column:
    """One item as a text: `channel: value — note`; blank where it says nothing."""
    if not isinstance(kind, T.StructType):
        return F.coalesce(x.cast("string"), F.lit(""))
    channel = _part(x, kind, names.channel)
    lead = F.when(F.coalesce(channel, F.lit("")) != "", F.concat(channel, F.lit(": "))).otherwise("")
    main = F.coalesce(*[_part(x, kind, n) for n in names.main], F.lit(""))
    silent = F.when((main == "") & F.coalesce(_part(x, kind, names.status) == names.unpublished, F.lit(False)), catalogue.FEE_UNPUBLISHED).otherwise("")
    note = F.coalesce(*[_part(x, kind, n) for n in names.note], F.lit(""))
    return F.when(x.isNull(), "").otherwise(F.array_join(_not_blank(F.concat(lead, F.when(main != "", main).otherwise(silent)), note), " — "))


def structured_text(x: Column, kind: T.DataType, fallback: Column, names: Items = Items()) -> Column:
    """A value of any type as one text; the fallback where it says nothing.

    Arrays are joined by semicolons, their items being texts, numbers or structs with the parts that `names` lists (the first
    part that is not null counts, even a blank one). A struct with an access url says that the service is online; of another one
    the texts and numbers are joined.
    """
    if isinstance(kind, T.ArrayType):
        told = F.array_join(F.filter(F.transform(x, lambda i: _item(i, kind.elementType, names)), lambda s: s != ""), "; ")
    elif isinstance(kind, T.StructType):
        plain = [x[f.name].cast("string") for f in kind.fields if isinstance(f.dataType, (T.StringType, T.NumericType))]
        told = F.array_join(F.array_compact(F.array(*plain)), " · ") if plain else F.lit("")
        if names.access in kind.names:
            told = F.when(is_filled(x[names.access]), catalogue.ONLINE_SERVICE).otherwise(told)
    else:
        told = x.cast("string")
    return F.when(is_filled(told), told).otherwise(fallback)


def paper_items(x: Column, kind: T.ArrayType) -> Column:
    """Papers as texts, `name (originals, copies) form`, in order and without those that say nothing; none for null."""

    def one(p: Column) -> Column:
        if not isinstance(kind.elementType, T.StructType):
            return F.coalesce(p.cast("string"), F.lit(""))
        part = lambda n: F.coalesce(_part(p, kind.elementType, n), F.lit(""))
        said = lambda label, n: F.when(part(n) != "", F.concat(F.lit(label), part(n))).otherwise("")
        counts = _not_blank(said(catalogue.ORIGINALS, "original"), said(catalogue.COPIES, "copies"))
        bracket = F.when(F.size(counts) > 0, F.concat(F.lit("("), F.array_join(counts, ", "), F.lit(")"))).otherwise("")
        return F.when(p.isNull(), "").otherwise(F.array_join(_not_blank(part("name"), bracket, said(catalogue.PAPER_FORM, "form")), " "))

    return F.coalesce(F.filter(F.transform(x, one), lambda s: s != ""), F.array().cast("array<string>"))


def _search(name: Column) -> Column:
    """A search for the quoted name on the official site; its home page without a name."""
    q = F.trim(F.coalesce(name, F.lit("")))
    wanted = F.concat(F.lit('"'), q, F.lit(f'" site:{catalogue.PORTAL_SITE}'))
    return F.when(q == "", catalogue.PORTAL_HOME).otherwise(F.concat(F.lit(catalogue.SEARCH_BASE), encoded(wanted)))


def enriched(df: DataFrame, names: Items = Items(), unknown: str = catalogue.UNKNOWN) -> DataFrame:
    """Records as a reader sees them, one row for each, within the row.

    df holds what it has of: name, level, fee, fee_basis (array of replaces, direct, basis), decision, time, agency, result,
    online, link, formality_id, submission_url, steps and papers (arrays of texts), verified, verification, and guidance, a struct
    of what it has of fee, time, agency, result, papers (values of any type), steps, submission_url and online (access_url,
    status). A column or part that is not there counts as null. Guidance goes before the record's own value, that before
    `unknown`; the first basis that replaces the fee goes before both. All other columns stay; a repeated row stays repeated.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    inner = types.get("guidance")
    parts = {f.name: f.dataType for f in inner.fields} if isinstance(inner, T.StructType) else {}
    text = lambda n: F.coalesce(F.col(n).cast("string"), F.lit("")) if n in types else F.lit("")
    words = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    own = lambda n: F.when(text(n) != "", text(n)).otherwise(unknown)
    lists = lambda n: words(F.col(n)) if n in types else F.array().cast("array<string>")
    g = F.col("guidance") if parts else None

    def told(n: str) -> Column:
        return structured_text(g[n], parts[n], own(n), names) if n in parts else own(n)

    def either(mine: Column, theirs: Column) -> Column:
        return F.when(F.size(mine) > 0, mine).otherwise(theirs)

    fee = told("fee")
    if "fee_basis" in types:
        basis = F.get(F.filter("fee_basis", lambda b: F.coalesce(b["replaces"], F.lit(False))), F.lit(0))
        fee = F.when(basis.isNotNull(), F.concat(F.coalesce(basis["direct"], F.lit("")), F.lit(" ("), F.coalesce(basis["basis"], F.lit("")), F.lit(")"))).otherwise(fee)
    online = structured_text(F.col("online"), types["online"], F.lit(unknown), names) if "online" in types else F.lit(unknown)
    submitted = text("submission_url")
    given = [g["submission_url"]] if "submission_url" in parts else []
    if "online" in parts:
        service = g["online"]
        status = F.coalesce(service["status"], F.lit(""))
        online = F.when(service.isNotNull(), F.when(status != "", F.concat(F.lit(catalogue.VERIFIED + " · "), status)).otherwise(catalogue.VERIFIED)).otherwise(online)
        given.append(service["access_url"])
    guided = F.trim(F.coalesce(*[F.nullif(c, F.lit("")) for c in given], F.lit("")))
    has_guidance = F.lit(False)
    for n in parts:
        has_guidance = has_guidance | g[n].isNotNull()
    flag = F.coalesce(F.col("verified"), F.lit(False)) if "verified" in types else F.lit(False)
    by_id = F.when(text("formality_id") != "", F.concat(F.lit(catalogue.PORTAL_HOME + "/"), encoded(text("formality_id")))).otherwise("")
    return df.withColumns({
        "level": own("level"), "decision": own("decision"), "fee": fee, "time": told("time"), "agency": told("agency"), "result": told("result"), "online": online,
        "link": F.coalesce(*[F.nullif(c, F.lit("")) for c in (text("link"), by_id)], _search(text("name"))),
        "submission_url": F.when(F.trim(submitted) != "", F.trim(submitted)).otherwise(guided),
        "steps": either(words(g["steps"]), lists("steps")) if "steps" in parts else lists("steps"),
        "papers": either(paper_items(g["papers"], parts["papers"]), lists("papers")) if "papers" in parts else lists("papers"),
        "verified": F.coalesce(flag | (text("verification") == "verified_official") | has_guidance, F.lit(False)),
        "has_guidance": F.coalesce(has_guidance, F.lit(False)),
        "route": F.when(F.lower(F.trim(text("level"))).startswith(catalogue.PROVINCE_LEVEL), "province").otherwise("ward"),
    })
