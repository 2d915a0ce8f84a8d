"""Validators of whole tables: each gives findings (severity, code, key, message), row rules in one scan.

What one row can tell is one array of findings for that row. What needs other rows (repeated keys, portfolio counts) comes
from partial aggregates, so a key that many rows share makes no large group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls

OUT = ("severity", "code", "key", "message")


def _finding(code: str, message: Column | str, severity: str = "error") -> Column:
    said = message if isinstance(message, Column) else F.lit(message)
    return F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), said.alias("message"))


def _if(bad: Column, code: str, message: Column | str, severity: str = "error") -> Column:
    """The finding where the condition holds, else null; an unknown condition does not hold."""
    return F.when(F.coalesce(bad, F.lit(False)), _finding(code, message, severity))


def _each(items: Column, bad, code: str, message) -> Column:
    """A finding for each element, or null; bad and message take the element and its place from 0."""
    found = F.transform(items, lambda x, i: _if(bad(x, i), code, message(x, i)))
    return F.coalesce(found, F.array().cast("array<struct<severity:string,code:string,message:string>>"))


def _rows(df: DataFrame, key: Column, *found: Column) -> DataFrame:
    """All findings of each row; every argument is an array with nulls where nothing was found."""
    all_ = F.filter(F.concat(*found), lambda x: x.isNotNull())
    return df.select(key.alias("key"), F.inline(all_)).select(*OUT)


def repeated(df: DataFrame, key: Column, code: str) -> DataFrame:
    """One finding for each row of a key beyond its first; blank keys are left out."""
    n = df.select(key.alias("key")).where("key <> ''").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    again = n.select("key", F.explode(F.sequence(F.lit(2), F.col("n"))).alias("i"))
    return again.select(F.lit("error").alias("severity"), F.lit(code).alias("code"), "key", F.lit("given again").alias("message"))


def blank(c: Column) -> Column:
    """Null, an empty text, or an array or map without entries."""
    shown = c.cast("string")
    return c.isNull() | F.when(F.typeof(c).rlike("^(array|map)<"), shown.isin("[]", "{}")).otherwise(shown == "")


def no_items(c: Column) -> Column:
    return c.isNull() | (F.size(c) == 0)


def governance(rows: DataFrame, meta: DataFrame, key: Column, required: Mapping[str, Column], evidence: Column, evidence_fields: Sequence[str], url_fields: Sequence[str], received: Column, label: Column, receivers: Sequence[str], online: Column, link: Column, formats: Sequence[str]) -> DataFrame:
    """The audit of a canonical table and of its one-row envelope meta (format, snapshot).

    A row without a key gives MISSING_CODE alone. Evidence is an array of structs; a null array or element is BAD_EVIDENCE.
    """
    k = F.coalesce(F.trim(key), F.lit(""))
    keyed = rows.where(k != "")
    told = F.array(
        *[_if(blank(c), "MISSING_FIELD", name) for name, c in required.items()],
        _if(evidence.isNull(), "BAD_EVIDENCE", "no list of evidence"),
        _if(received & ~F.lower(F.coalesce(label, F.lit(""))).rlike("|".join(receivers)), "AUTHORITY_RECEPTION_MISMATCH", "received where the level does not say so", "warning"),
        _if(online & ~blank(link) & ~link.startswith("https://"), "BAD_SUBMISSION_URL", "not https"),
    )
    place = lambda name: lambda _, i: F.concat(i.cast("string"), F.lit("." + name))
    seen = [_each(evidence, lambda x, _: x.isNull(), "BAD_EVIDENCE", place("evidence"))]
    seen += [_each(evidence, lambda x, _, f=f: x.isNotNull() & blank(x[f]), "MISSING_PROVENANCE", place(f)) for f in evidence_fields]

    def no_url(x, _):
        return x.isNotNull() & F.forall(F.array(*[blank(x[f]) for f in url_fields]), lambda b: b)

    seen.append(_each(evidence, no_url, "MISSING_PROVENANCE_URL", place("url")))
    keyless = rows.where(k == "").select(F.lit("error").alias("severity"), F.lit("MISSING_CODE").alias("code"), F.lit("").alias("key"), F.lit("no key").alias("message"))
    envelope = _rows(
        meta, F.lit(""), F.array(_if(~F.coalesce(F.col("format").isin(*formats), F.lit(False)), "FORMAT", "another format"), _if(blank(F.col("snapshot")), "MISSING_SNAPSHOT", "no date"))
    )
    return _rows(keyed, k, told, *seen).unionByName(repeated(keyed, k, "DUPLICATE_CODE")).unionByName(keyless).unionByName(envelope)


def guidance(rows: DataFrame, key: Column, code_pattern: str, status: Column, statuses: Sequence[str], fields: Mapping[str, Column], sources: Column, provenance: Column, roles: Sequence[str], suffixes: Sequence[str], own_only: Mapping[str, str], link: tuple[Column, Column, str, Mapping[str, str]] | None = None, meta: DataFrame | None = None, format_: str = "", version: int = 1) -> DataFrame:
    """The contract of enrichment rows: every filled field names sources that exist, and every source is official.

    sources: array of structs (id, role, url). provenance: map of field to source ids. own_only: fields that take only
    sources of one role. link: a submission link, the id that it must carry (blank: none), its host and the parameters that
    it must have. meta: the one-row envelope, with format, version and roles (array, or null where it names none).
    """
    k = F.coalesce(F.trim(key), F.lit(""))
    filled = {n: ~blank(c) for n, c in fields.items()}
    substance = F.exists(F.array(*filled.values()), lambda b: b)
    ids = F.coalesce(F.transform(sources, lambda s: F.coalesce(s["id"], F.lit(""))), F.array().cast("array<string>"))
    told = [
        _if(~k.rlike(code_pattern), "BAD_CODE", k),
        _if(~F.coalesce(status.isin(*statuses), F.lit(False)), "BAD_STATUS", F.coalesce(status, F.lit(""))),
        _if(substance & no_items(sources), "NO_SOURCES", "no sources"),
        _if(substance & provenance.isNull(), "NO_PROVENANCE", "no provenance"),
    ]
    if link is not None:
        told += _submission(*link)
    place = lambda s, i: i.cast("string")
    by_source = [
        _each(sources, lambda s, _: s.isNull(), "SOURCE_NULL", place),
        _each(sources, lambda s, _: s.isNotNull() & blank(s["id"]), "SOURCE_WITHOUT_ID", place),
        _each(sources, lambda s, i: ~blank(s["id"]) & (F.array_position(ids, s["id"]) <= i), "SOURCE_ID_AGAIN", lambda s, _: s["id"]),
        _each(sources, lambda s, _: s.isNotNull() & ~F.coalesce(s["role"].isin(*roles), F.lit(False)), "BAD_ROLE", place),
        _each(sources, lambda s, _: s.isNotNull() & ~F.coalesce(urls.official(s["url"], suffixes), F.lit(False)), "UNOFFICIAL_URL", place),
    ]
    by_field = []
    for name in fields:
        refs = F.try_element_at(provenance, F.lit(name))
        told.append(_if(filled[name] & no_items(refs), "FIELD_WITHOUT_SOURCE", name))
        by_field.append(_each(F.when(filled[name], refs), lambda r, _: blank(r) | ~F.array_contains(ids, r), "UNKNOWN_SOURCE", lambda r, _, n=name: F.concat(F.lit(n + ":"), F.coalesce(r, F.lit("")))))
        if name in own_only:
            cited = F.filter(sources, lambda s: F.array_contains(refs, s["id"]))
            foreign = F.exists(cited, lambda s: ~s["role"].eqNullSafe(F.lit(own_only[name])))
            told.append(_if(filled[name] & foreign, "FOREIGN_ROLE", name))
    out = _rows(rows, k, F.array(*told), *by_source, *by_field).unionByName(repeated(rows, k, "DUPLICATE_CODE"))
    if meta is None:
        return out
    lacking = F.array_except(F.array(*map(F.lit, sorted(roles))), F.col("roles"))
    envelope = [
        _if(~F.coalesce(F.col("format") == format_, F.lit(False)), "FORMAT", "another format"),
        _if(~F.coalesce(F.col("version") == version, F.lit(False)), "VERSION", "another version"),
        _if(F.size(lacking) > 0, "ROLES_MISSING", F.array_join(lacking, ", ")),
    ]
    return out.unionByName(_rows(meta, F.lit(""), F.array(*envelope)))


def _submission(url: Column, wanted: Column, host: str, parameters: Mapping[str, str]) -> list[Column]:
    """A link of the given host with the given parameters, and with the id that the record has."""
    u, own = F.trim(F.coalesce(url, F.lit(""))), F.trim(F.coalesce(wanted, F.lit("")))
    there, par = u != "", lambda p: F.coalesce(urls.param(u, p), F.lit(""))
    return [
        _if(there & ((urls.scheme(u) != "https") | (urls.host(u) != host)), "LINK_HOST", u),
        *[_if(there & (par(p) != v), "LINK_PARAMETER", F.concat(F.lit(p + "="), par(p))) for p, v in parameters.items()],
        _if(there & (own != "") & (par("formalityId") != own), "LINK_ID", par("formalityId")),
    ]


def registry(rows: DataFrame, key: str, url: str, suffixes: Sequence[str], needed: Sequence[str], enums: Mapping[str, Sequence[str]], kind: str, portfolio: Mapping[str, int]) -> DataFrame:
    """The register of sources: unique ids and urls, official https hosts, roles from closed lists, and enough of each kind.

    portfolio: prefix of a kind to the least number of sources; what is short has the prefix as its key.
    """
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    good = F.coalesce(urls.official(F.col(url), suffixes), F.lit(False))
    told = [_if(~good, "UNOFFICIAL_URL", F.coalesce(F.col(url), F.lit("")))]
    told += [_if(blank(F.col(c)), "MISSING_FIELD", c) for c in needed]
    told += [_if(~F.coalesce(F.col(c).isin(*v), F.lit(False)), "BAD_ENUM", c) for c, v in enums.items()]
    counts = rows.agg(*[F.count_if(F.col(kind).startswith(p)).alias(f"n{i}") for i, p in enumerate(portfolio)])
    short = counts.select(F.inline(F.array(*[F.struct(F.lit(p).alias("key"), F.col(f"n{i}").alias("n"), F.lit(least).alias("least")) for i, (p, least) in enumerate(portfolio.items())])))
    short = short.where("n < least").select(F.lit("error").alias("severity"), F.lit("PORTFOLIO").alias("code"), "key", F.concat_ws(" of ", "n", "least").alias("message"))
    same_url = repeated(rows, F.rtrim(F.col(url), F.lit("/")), "DUPLICATE_URL")
    return _rows(rows, k, F.array(*told)).unionByName(repeated(rows, k, "DUPLICATE_ID")).unionByName(same_url).unionByName(short)


def priority_set(master: DataFrame, guidance: DataFrame, key: str, wanted: Column, fields: Mapping[str, Column], provenance: Column, target: int, complete: bool = False) -> DataFrame:
    """severity, code, key, message, n of a set of keys that guidance must cover: as many keys as the target says, a row of guidance
    for each of them and for no other, provenance for every filled field, and, if asked for, every field filled.

    One scan of each table: see integrity.findings.
    """
    from .expect import Rule
    from .integrity import Pair, Side, Table, findings

    k = F.trim(F.col(key))
    rules = [Rule("FIELD_WITHOUT_PROVENANCE", ~blank(c) & no_items(F.try_element_at(provenance, F.lit(f))), f) for f, c in fields.items()]
    if complete:
        rules += [Rule("INCOMPLETE", blank(c), f) for f, c in fields.items()]
    tables = {"master": Table(master.where(wanted), k, unique={"PRIORITY_AGAIN": k}, totals={"wanted": F.lit(1)}), "guidance": Table(guidance, k, rules)}
    pair = Pair("master and guidance", Side("master", k), Side("guidance", k), lambda m, g: [Rule("GUIDANCE_MISSING", m.there & ~g.there), Rule("GUIDANCE_EXTRA", g.there & ~m.there)])
    return findings(tables, [pair], lambda v: [Rule("PRIORITY_COUNT", v.n("wanted") != target, F.concat_ws(" of ", v.text("wanted"), F.lit(str(target))))])
