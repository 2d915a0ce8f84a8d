"""The contract of canonical records: names, lifecycle, evidence, field provenance, links and guidance, checked in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from .upgrade import CENTRAL, EXECUTION, LEGAL, ROLES, content_id, latest_day
from .validators import _each, _if, _rows, no_items, repeated

DAY = r"^\d{4}-\d{2}-\d{2}$"
STATUSES = ("active", "future_effective", "repealed")
#: Box-drawing characters that UTF-8 read as code page 437 leaves behind, and words that a scan has split.
CP437 = "├┬┌└┼╬╟╚╠╩╦╔║╒╘╞╪╧╤"
SPLIT_WORDS = ("tr ạm", "Ch ứng", "nh ập", "th ấp", "đi ểm", "t ờ", "th ẩm", "quy ền")
LEGAL_FIELDS = ("ma", "ten", "linhVuc", "cap", "quyetDinh", "lifecycle.status", "lifecycle.effectiveFrom", "lifecycle.effectiveTo")
EXECUTION_FIELDS = ("formalityId", "nopHoSoUrl", "nopHoSoScope", "submissionLinkStatus", "huongDan.submissionUrl", "huongDan.dvctt")
GUIDANCE_FIELDS = ("huongDan.quyTrinh", "huongDan.thanhPhanHoSo", "huongDan.bieuMau", "huongDan.lePhi", "huongDan.thoiHan", "huongDan.coQuanThucHien", "huongDan.ketQua")
#: The states of a link that was verified.
LINK_STATUSES = ("resolution_level_scope_verified", "vinhbao_scope_parameters_verified", "verified_official_guidance")
FORBIDDEN_AT_PROVINCE = ("wardCode", "ward", "agency", "departmentId", "commune")


@dataclass(frozen=True)
class Link:
    """A submission link: its columns, its host, the province, and the parameters of the commune."""

    url: Column
    status: Column
    id: Column
    level: Column
    host: str = "dichvucong.gov.vn"
    province: str = "31"
    commune: Mapping[str, str] = field(default_factory=lambda: {"wardCode": "11824", "commune": "WARD"})


@dataclass(frozen=True)
class Guidance:
    """Guidance of a record; a null status stands for no guidance only where the sources are null too."""

    status: Column
    sources: Column
    link: Column


def _named(**columns: Column) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def _given(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def _unless(good: Column) -> Column:
    """True where a condition is false or unknown."""
    return ~F.coalesce(good, F.lit(False))


def canonical(rows: DataFrame, meta: DataFrame, code: Column, name: Column, required: Mapping[str, Column], link: Link, guidance: Guidance, suffixes: Sequence[str], format_: str, commit_kind: str, commit: str | None = None) -> DataFrame:
    """severity, code, key, message of every breach.

    rows hold lifecycle, sourceEvidence and fieldSources as `upgrade.upgraded` makes them. meta: one row with format, version,
    dataset_version, source_commit and source_commit_kind. required: field to whether the record must tell its sources.
    Evidence ids are computed anew from the content. A key is the code, else empty.
    """
    # what many rules ask for is made once, as columns
    rows = rows.select("lifecycle", "sourceEvidence", "fieldSources", *_named(
        _code=F.trim(F.coalesce(code, F.lit(""))), _name=F.trim(F.coalesce(name, F.lit(""))), _status=guidance.status, _sources=guidance.sources, _guide_link=guidance.link,
        _url=F.trim(F.coalesce(link.url, F.lit(""))), _link_status=link.status, _id=link.id, _level=link.level, **{f"_want_{i}": w for i, w in enumerate(required.values())},
    ))
    required = {f: F.col(f"_want_{i}") for i, f in enumerate(required)}
    guidance = Guidance(F.col("_status"), F.col("_sources"), F.col("_guide_link"))
    link = replace(link, url=F.col("_url"), status=F.col("_link_status"), id=F.col("_id"), level=F.col("_level"))
    rows = rows.withColumns({
        "_items": F.coalesce("sourceEvidence", F.array().cast(rows.schema["sourceEvidence"].dataType)),
        **{f"_par_{p}": F.coalesce(urls.param(link.url, p), F.lit("")) for p in _parameters(link)},
    })
    rows = rows.withColumn("_item_ids", F.transform("_items", lambda e: F.coalesce(e["evidenceId"], F.lit(""))))
    rows = rows.withColumn("_entries", F.transform(F.map_entries("fieldSources"), lambda x: F.struct(x["key"].alias("field"), x["value"].alias("ids"), _roles(x["value"], F.col("_items")).alias("roles"))))
    k, n = F.col("_code"), F.col("_name")
    life, evidence, refs = F.col("lifecycle"), F.col("sourceEvidence"), F.col("fieldSources")
    told = [
        _if((k == "") | (n == ""), "NO_CODE_OR_NAME", n),
        _if(n.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"), "NAME_CONTROL", "a control character"),
        _if(n.rlike(f"[{CP437}]"), "NAME_CP437", "a character of another encoding"),
        _if(n.rlike("|".join(SPLIT_WORDS)), "NAME_SPLIT", F.regexp_extract(n, "|".join(SPLIT_WORDS), 0)),
        _if(tx.not_composed(n), "NAME_NOT_NFC", "not composed"),
        _if(life.isNull(), "NO_LIFECYCLE", "no lifecycle"),
        _if(no_items(evidence), "NO_EVIDENCE", "no evidence"),
        _if(refs.isNull(), "NO_FIELD_SOURCES", "no map of sources"),
        *_lifecycle(life),
    ]
    items = F.col("_items")
    told += _effect(life, items)
    told += _required(required, refs)
    told += _link(link)
    guide = guidance.status.isNotNull() | guidance.sources.isNotNull()
    told += [
        _if(guide & _unless(guidance.status == "verified_official"), "GUIDE_STATUS", F.coalesce(guidance.status, F.lit(""))),
        _if(guide & no_items(guidance.sources), "GUIDE_NO_SOURCES", "no sources"),
        _if(guide & _given(F.trim(guidance.link)) & ~urls.official(guidance.link, suffixes), "GUIDE_LINK", guidance.link),
    ]
    place = lambda x, i: (i + 1).cast("string")
    by_source = [
        _each(guidance.sources, lambda s, _: _unless(urls.official(F.trim(s["url"]), suffixes)), "GUIDE_SOURCE_URL", place),
        _each(guidance.sources, lambda s, _: _unless(F.trim(s["sourceRole"]).isin(*ROLES)), "GUIDE_SOURCE_ROLE", place),
    ]
    single = repeated(rows, k, "DUPLICATE_CODE")
    envelope = _rows(meta, F.lit(""), F.array(*_envelope(format_, commit_kind, commit)))
    empty = rows.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("error").alias("severity"), F.lit("NO_ROWS").alias("code"), F.lit("").alias("key"), F.lit("no records").alias("message"))
    return _rows(rows, k, F.array(*told), *_by_evidence(items, F.col("_item_ids"), suffixes), *_by_field(F.col("_entries"), F.col("_item_ids")), *by_source).unionByName(single).unionByName(envelope).unionByName(empty)


def _envelope(format_: str, commit_kind: str, commit: str | None) -> list[Column]:
    out = [
        _if(_unless(F.col("format") == format_), "FORMAT", "another format"),
        _if(_unless(F.col("version") == 4), "VERSION", "another version"),
        _if(_unless(F.col("dataset_version").rlike(r"^\d{4}\.\d{2}\.\d{2}$")), "DATASET_VERSION", "not YYYY.MM.DD"),
        _if(_unless(F.col("source_commit").rlike("^[0-9a-f]{40}$")), "COMMIT", "no SHA-1"),
        _if(_unless(F.col("source_commit_kind") == commit_kind), "COMMIT_KIND", "another kind"),
    ]
    return [*out, _if(_unless(F.col("source_commit") == commit), "COMMIT_MISMATCH", "not that of the sources")] if commit is not None else out


def _lifecycle(life: Column) -> list[Column]:
    there, start, end, day = life.isNotNull(), life["effectiveFrom"], life["effectiveTo"], life["asOf"]
    return [
        _if(there & _unless(life["status"].isin(*STATUSES)), "LIFECYCLE_STATUS", F.coalesce(life["status"], F.lit(""))),
        _if(there & _unless(day.rlike(DAY)), "LIFECYCLE_AS_OF", F.coalesce(day, F.lit(""))),
        *[_if(_given(x) & ~x.rlike(DAY), "LIFECYCLE_DATE", F.concat_ws("=", F.lit(f), x)) for f, x in (("effectiveFrom", start), ("effectiveTo", end))],
        _if((life["status"] == "future_effective") & _given(start) & _given(day) & (start <= day), "LIFECYCLE_FUTURE", start),
        _if((life["status"] == "repealed") & _given(end) & _given(day) & (end > day), "LIFECYCLE_REPEALED", end),
    ]


def _effect(life: Column, items: Column) -> list[Column]:
    """An active record rests on legal evidence, the latest of which does not repeal it."""
    active = life["status"] == "active"
    made, gone = latest_day(items, False), latest_day(items, True)
    return [
        _if(active & ~F.exists(items, lambda e: F.coalesce(e["sourceRole"] == LEGAL, F.lit(False))), "ACTIVE_WITHOUT_LEGAL", "no legal evidence"),
        _if(active & gone.isNotNull() & (made.isNull() | (gone >= made)), "ACTIVE_BUT_REPEALED", gone),
    ]


def _by_evidence(items: Column, ids: Column, suffixes: Sequence[str]) -> list[Column]:
    place = lambda x, i: (i + 1).cast("string")
    shaped = lambda e: F.coalesce(e["evidenceId"].rlike("^ev_[0-9a-f]{24}$"), F.lit(False))
    there = lambda e: e.isNotNull()
    links = lambda e: F.array(*[F.trim(F.coalesce(e[n], F.lit(""))) for n in ("url", "articleUrl", "attachmentUrl")])
    foreign = lambda e: F.filter(links(e), lambda u: (u != "") & ~urls.official(u, suffixes))
    return [
        _each(items, lambda e, _: e.isNull(), "EVIDENCE_NULL", place),
        _each(items, lambda e, _: there(e) & _unless(e["sourceRole"].isin(*ROLES)), "EVIDENCE_ROLE", place),
        _each(items, lambda e, _: there(e) & ~shaped(e), "EVIDENCE_ID", place),
        _each(items, lambda e, _: there(e) & shaped(e) & (e["evidenceId"] != content_id(e)), "EVIDENCE_ID_CONTENT", place),
        _each(items, lambda e, i: there(e) & _given(e["evidenceId"]) & (F.array_position(ids, e["evidenceId"]) <= i), "EVIDENCE_AGAIN", lambda e, i: e["evidenceId"]),
        _each(items, lambda e, _: there(e) & F.forall(links(e), lambda u: u == ""), "EVIDENCE_NO_URL", place),
        _each(items, lambda e, _: there(e) & (F.size(foreign(e)) > 0), "EVIDENCE_URL", lambda e, i: F.array_join(foreign(e), " ")),
        _each(items, lambda e, _: _given(F.trim(e["attachmentSha256"])) & ~F.trim(e["attachmentSha256"]).rlike("^[0-9a-f]{64}$"), "EVIDENCE_SHA", place),
        *[_each(items, lambda e, _, f=f: _given(e[f]) & ~e[f].rlike(DAY), "EVIDENCE_DATE", lambda e, i, f=f: F.concat_ws(".", (i + 1).cast("string"), F.lit(f))) for f in ("publishedDate", "effectiveDate")],
    ]


def _required(required: Mapping[str, Column], refs: Column) -> list[Column]:
    return [_if(F.coalesce(want, F.lit(False)) & no_items(F.try_element_at(refs, F.lit(f))), "FIELD_WITHOUT_SOURCE", f) for f, want in required.items()]


def _by_field(entries: Column, ids: Column) -> list[Column]:
    """Rules on each entry of the map (field, ids, roles): its ids exist, once each, and their roles may support the field."""
    name = lambda x, i: x["field"]
    unknown = lambda x: F.filter(x["ids"], lambda r: ~F.coalesce(F.array_contains(ids, r), F.lit(False)))
    lacks = lambda x, role: ~F.array_contains(x["roles"], role)
    legal, execution, guided = (lambda x, f=f: x["field"].isin(*f) for f in (LEGAL_FIELDS, EXECUTION_FIELDS, GUIDANCE_FIELDS))
    filled = lambda x: ~no_items(x["ids"])
    return [
        _each(entries, lambda x, _: ~filled(x), "FIELD_NO_IDS", name),
        _each(entries, lambda x, _: filled(x) & (F.size(x["ids"]) != F.size(F.array_distinct(x["ids"]))), "FIELD_ID_AGAIN", name),
        _each(entries, lambda x, _: F.size(unknown(x)) > 0, "FIELD_UNKNOWN_ID", lambda x, i: F.concat_ws(":", x["field"], F.array_join(unknown(x), ",", ""))),
        _each(entries, lambda x, _: filled(x) & legal(x) & lacks(x, LEGAL), "FIELD_NEEDS_LEGAL", name),
        _each(entries, lambda x, _: filled(x) & execution(x) & lacks(x, EXECUTION), "FIELD_NEEDS_EXECUTION", name),
        _each(entries, lambda x, _: filled(x) & (legal(x) | execution(x)) & F.array_contains(x["roles"], CENTRAL), "FIELD_CENTRAL", name),
        _each(entries, lambda x, _: filled(x) & guided(x) & (F.size(F.array_except(x["roles"], F.array(F.lit(CENTRAL), F.lit(LEGAL)))) > 0), "FIELD_GUIDANCE_ROLE", name),
    ]


def _roles(ids: Column, items: Column) -> Column:
    cited = F.filter(items, lambda e: F.coalesce(F.array_contains(ids, e["evidenceId"]), F.lit(False)))
    return F.array_distinct(F.transform(cited, lambda e: F.coalesce(e["sourceRole"], F.lit(""))))


def _parameters(x: Link) -> list[str]:
    return list(dict.fromkeys(("provinceCode", "isProvince", "formalityId", *FORBIDDEN_AT_PROVINCE, *x.commune)))


def _link(x: Link) -> list[Column]:
    """Rules on a link; its parameters are columns."""
    u = x.url
    there = u != ""
    par = lambda p: F.col(f"_par_{p}")
    province = F.lower(F.trim(F.coalesce(x.level, F.lit("")))).startswith("cấp tỉnh")
    forced = F.array_compact(F.array(*[F.when(par(p) != "", F.lit(p)) for p in FORBIDDEN_AT_PROVINCE]))
    return [
        _if(there & _unless(x.status.isin(*LINK_STATUSES)), "LINK_STATUS", F.coalesce(x.status, F.lit(""))),
        _if(there & ((urls.scheme(u) != "https") | (urls.host(u) != x.host)), "LINK_HOST", u),
        _if(there & (par("provinceCode") != x.province), "LINK_PROVINCE", par("provinceCode")),
        _if(there & province & (par("isProvince") != "1"), "LINK_NOT_PROVINCE", par("isProvince")),
        _if(there & province & (F.size(forced) > 0), "LINK_FORCED_COMMUNE", F.array_join(forced, ",")),
        *[_if(there & ~province & (par(p) != v), "LINK_COMMUNE", F.concat_ws("=", F.lit(p), par(p))) for p, v in x.commune.items()],
        _if(there & ~province & ~par("isProvince").isin("", "0"), "LINK_IS_PROVINCE", par("isProvince")),
        _if(there & _given(F.trim(x.id)) & (par("formalityId") != F.trim(x.id)), "LINK_ID", par("formalityId")),
    ]
