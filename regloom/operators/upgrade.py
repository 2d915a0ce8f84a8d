"""Upgrade of whole records: evidence normalised and told apart by content, its ids tied to every field that it supports.

All of it is done within the row, with functions on its arrays and maps: nothing is exploded or shuffled, so a record of any
number of sources stays in its task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.evidence import evidence_id

LEGAL, EXECUTION, CENTRAL = "local_legal_effect", "local_execution", "central_content_reference"
ROLES = (CENTRAL, LEGAL, EXECUTION)
#: What an evidence id is made of; verifiedAt is not.
HASHED = ("sourceRole", "url", "articleUrl", "attachmentUrl", "attachmentSha256", "decisionNumbers", "publishedDate", "effectiveDate", "classification", "repealContext")
EVIDENCE = "struct<evidenceId:string,sourceRole:string,url:string,articleUrl:string,attachmentUrl:string,attachmentSha256:string,decisionNumbers:array<string>,publishedDate:string,effectiveDate:string,classification:string,repealContext:boolean,verifiedAt:string>"
_NAMES = [f.split(":", 1)[0] for f in EVIDENCE.removeprefix("struct<").replace("array<string>", "x")[:-1].split(",")]


def content_id(e: Column) -> Column:
    """The id that the content of an evidence struct has; no list of decisions counts as an empty one, no mark of repeal as false."""
    parts = {n: e[n] for n in HASHED}
    parts["decisionNumbers"] = F.coalesce(e["decisionNumbers"], F.array().cast("array<string>"))
    parts["repealContext"] = F.coalesce(e["repealContext"], F.lit(False))
    return evidence_id(parts)


def _given(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def _rebuilt(e: Column, **new: Column) -> Column:
    return F.struct(*[new.get(n, e[n]).alias(n) for n in _NAMES]).cast(EVIDENCE)


def normalised(e: Column, execution_host: str) -> Column:
    """An evidence struct with a known role (else by its urls), a url (else of its article, else its attachment) and its id."""
    at_host = F.lit(False)
    for n in ("url", "articleUrl", "attachmentUrl"):
        at_host = at_host | F.coalesce(e[n].contains(execution_host), F.lit(False))
    role = F.trim(e["sourceRole"])
    role = F.when(role.isin(*ROLES), role).when(at_host, EXECUTION).otherwise(LEGAL)
    url = F.when(_given(e["url"]), e["url"]).when(_given(e["articleUrl"]), e["articleUrl"]).otherwise(F.coalesce(e["attachmentUrl"], F.lit("")))
    known = _rebuilt(e, sourceRole=role, url=url)
    return _rebuilt(known, evidenceId=content_id(known))


def _evidence(**fields: Column | None) -> Column:
    kinds = {"decisionNumbers": F.lit(None).cast("array<string>"), "repealContext": F.lit(False)}
    made = F.struct(*[(fields.get(n) if fields.get(n) is not None else kinds.get(n, F.lit(None).cast("string"))).alias(n) for n in _NAMES]).cast(EVIDENCE)
    return made


def execution_evidence(url: Column, classification: str, checked: Column, suffixes: Sequence[str]) -> Column:
    """Evidence of a link, or null where the link is not an official one."""
    u = F.trim(F.coalesce(url, F.lit("")))
    item = _evidence(sourceRole=F.lit(EXECUTION), url=u, classification=F.lit(classification), verifiedAt=F.when(_given(checked), checked))
    return F.when(urls.official(u, suffixes), _rebuilt(item, evidenceId=content_id(item)))


def first_of_each(evidence: Column, ids: Column) -> Column:
    """Evidence structs, the first of each id, in order; ids are theirs.

    Both should be columns of a table: what they are made of would be made again for each element.
    """
    return F.filter(evidence, lambda e, i: F.array_position(ids, e["evidenceId"]) == i + 1)


def ids_where(evidence: Column, condition) -> Column:
    return F.transform(F.filter(evidence, condition), lambda e: e["evidenceId"])


def evidence_day(e: Column) -> Column:
    return F.when(_given(e["effectiveDate"]), e["effectiveDate"]).otherwise(e["publishedDate"])


def latest_day(evidence: Column, repeal: bool) -> Column:
    """The latest day of legal evidence that repeals, or that does not; null without any."""
    own = F.filter(evidence, lambda e: (e["sourceRole"] == LEGAL) & (F.coalesce(e["repealContext"], F.lit(False)) == repeal) & _given(evidence_day(e)))
    return F.array_max(F.transform(own, evidence_day))


@dataclass(frozen=True)
class Guide:
    """Guidance of a record: sources (array of struct id, url, sourceRole, classification, publishedDate, effectiveDate),
    provenance (map of field to source ids), which fields are filled, and those of them that only execution evidence supports."""

    sources: Column
    provenance: Column
    filled: Mapping[str, Column]
    execution_only: Mapping[str, Column]
    prefix: str = "huongDan."


def upgraded(
    rows: DataFrame,
    evidence: Column,
    legal_fields: Mapping[str, Column],
    execution_fields: Mapping[str, Column],
    duration: Column,
    links: Sequence[tuple[Column, str, Column]],
    as_of: Column,
    suffixes: Sequence[str],
    execution_host: str,
    guide: Guide | None = None,
    known: Column | None = None,
) -> DataFrame:
    """rows with sourceEvidence, lifecycle and fieldSources.

    evidence: array of EVIDENCE structs (ids are made anew). links: (url, classification, day checked) of what becomes
    execution evidence. legal_fields, execution_fields: field to whether it is filled. duration: whether the duration field
    is filled; it takes evidence classed as such. known: a map of field to ids to which new ones are added.

    Null lists and elements, and guide sources without a url, are left out; a repeated source counts once, the first one
    stays. A reference of the guide to an unknown source is dropped; a field left without any takes all guide sources, or all
    execution evidence where only that supports it.
    """
    none = F.array().cast(f"array<{EVIDENCE}>")
    own = F.transform(F.filter(F.coalesce(evidence, none), lambda e: e.isNotNull()), lambda e: normalised(e, execution_host))
    linked = F.array(*[execution_evidence(u, c, d, suffixes) for u, c, d in links]) if links else none
    guided = F.array().cast(f"array<struct<id:string,e:{EVIDENCE}>>")
    if guide is not None:

        def item(s: Column) -> Column:
            e = _evidence(
                sourceRole=F.trim(F.when(_given(s["sourceRole"]), s["sourceRole"]).otherwise(CENTRAL)), url=F.trim(s["url"]),
                classification=F.when(_given(s["classification"]), s["classification"]).otherwise("official_guidance"), publishedDate=s["publishedDate"], effectiveDate=s["effectiveDate"],
            )
            return F.struct(F.trim(s["id"]).alias("id"), normalised(e, execution_host).alias("e"))

        there = F.filter(guide.sources, lambda s: s.isNotNull() & _given(F.trim(s["url"])))
        guided = F.coalesce(F.transform(there, item), guided)
    df = rows.withColumn("_guided", guided)
    df = df.withColumn("_all", F.filter(F.concat(own, linked, F.transform("_guided", lambda g: g["e"])), lambda e: e.isNotNull()))
    df = df.withColumn("_ids", F.transform("_all", lambda e: e["evidenceId"]))
    df = df.withColumn("sourceEvidence", first_of_each(F.col("_all"), F.col("_ids")))
    all_ = F.col("sourceEvidence")
    df = df.withColumn("_legal", ids_where(all_, lambda e: e["sourceRole"] == LEGAL)).withColumn("_execution", ids_where(all_, lambda e: e["sourceRole"] == EXECUTION))
    df = df.withColumn("_timed", ids_where(all_, lambda e: e["classification"] == "official_table_guidance_duration")).withColumn("_from", latest_day(all_, False))
    supports: list[tuple[str, Column, Column]] = [(f, filled, F.col("_legal")) for f, filled in legal_fields.items()]
    supports += [("lifecycle.status", F.lit(True), F.col("_legal")), ("lifecycle.effectiveFrom", F.col("_from").isNotNull(), F.col("_legal"))]
    supports.append(("thoiHan", duration, F.col("_timed")))
    supports += [(f, filled, F.col("_execution")) for f, filled in execution_fields.items()]
    if guide is not None:
        any_source = F.size("_guided") > 0
        every = F.transform("_guided", lambda g: g["e"]["evidenceId"])
        for fields, only, fallback in ((guide.filled, False, every), (guide.execution_only, True, F.col("_execution"))):
            for f, filled in fields.items():
                cited = _cited(F.try_element_at(guide.provenance, F.lit(f)), F.col("_guided"), only)
                supports.append((guide.prefix + f, filled & any_source, F.when(F.size(cited) > 0, cited).otherwise(fallback)))
    before = F.coalesce(known if known is not None else F.lit(None), F.create_map().cast("map<string,array<string>>"))
    entries = []
    for f, filled, ids in supports:
        had = F.coalesce(F.try_element_at(before, F.lit(f)), F.array().cast("array<string>"))
        got = F.concat(had, F.array_except(F.when(F.coalesce(filled, F.lit(False)), ids).otherwise(F.array().cast("array<string>")), had))
        entries.append(F.when(F.size(got) > 0, F.struct(F.lit(f).alias("key"), got.alias("value"))))
    fresh = F.map_from_entries(F.filter(F.array(*entries), lambda x: x.isNotNull()))
    others = F.map_filter(before, lambda k, _: ~k.isin(*[f for f, _, _ in supports]))
    lifecycle = F.struct(F.lit("active").alias("status"), as_of.cast("string").alias("asOf"), F.col("_from").alias("effectiveFrom"), F.lit(None).cast("string").alias("effectiveTo"))
    df = df.withColumn("lifecycle", lifecycle).withColumn("fieldSources", F.map_concat(others, fresh))
    return df.drop("_guided", "_all", "_ids", "_legal", "_execution", "_timed", "_from")


def _cited(refs: Column, guided: Column, execution_only: bool) -> Column:
    """Ids of the sources that references name; of sources of one id the last counts."""

    def of(r: Column) -> Column:
        named = F.filter(guided, lambda g: (g["id"] == r) & (g["id"] != ""))
        last = F.try_element_at(named, F.lit(-1))["e"]
        return F.when(~F.lit(execution_only) | (last["sourceRole"] == EXECUTION), last["evidenceId"])

    return F.coalesce(F.filter(F.transform(refs, of), lambda x: x.isNotNull()), F.array().cast("array<string>"))
