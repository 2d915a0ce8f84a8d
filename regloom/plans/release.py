"""Cross-table integrity of a release: the tables of a registry, its sources and its crosswalk agree with each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalogue, urls
from ..operators.expect import Rule
from ..operators.integrity import Pair, Side, Table, Totals, findings
from ..operators.validators import blank, no_items

_UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_FAILED = ("missing_", "unclassified_", "article_fetch_failed", "pdf_download_failed")


@dataclass(frozen=True)
class Expected:
    """What a release is held against. Lists of codes are known cases; counts are the sizes of the crosswalk and its matrix."""

    repealed: Sequence[str] = ()
    future: Sequence[str] = ()
    current: Sequence[str] = ()
    decisions: Sequence[str] = ()
    #: code to the field under which one decision publishes it, and codes that it must not publish
    received_by: str = ""
    received: Mapping[str, str] = field(default_factory=dict)
    shared: Sequence[str] = ()
    #: code to the section in which a decision lists it, a replaced and a replacing side
    sections_of: str = ""
    sections: Mapping[str, str] = field(default_factory=dict)
    crosswalk: int = 0
    crosswalk_ids: int = 0
    keyword_only: Sequence[str] = ()
    crosswalk_repealed: Sequence[str] = ()
    crosswalk_base: str = ""
    live: tuple[int, int, int] = (0, 0, 0)
    legal: tuple[int, int] = (0, 0)
    primary_sources: int = 0
    hosts: Sequence[str] = ()
    least_mapped: int = 0
    samples: Mapping[str, str] = field(default_factory=dict)


CURRENT, REPEALED = "current_official_commune_evidence", "repealed_official_evidence"
_VERIFIED = ("VERIFIED_VISIBLE_IDENTITY", "VERIFIED_VISIBLE_IDENTITY_AND_AGENCY")


def _c(name: str) -> Column:
    return F.col(name)


def _is(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _not(c: Column, value) -> Column:
    """Unequal, null included."""
    return ~c.eqNullSafe(F.lit(value))


def release_findings(t: Mapping[str, DataFrame], e: Expected, parts: DataFrame | None = None) -> DataFrame:
    """severity, code, key, message, n for a release of these tables, whose columns are read as follows.

    public: code, name, field, status, verified, evidence (array), formality_id, priority, ordinal, legal_status, article_url.
    excluded: code, status. export: code. legacy: code. samples: code, formality_id. updates: code, decision, section,
    received, field. decisions: number. manifest: number, class, day, article_url, pdf_url, path. files: path. index: url,
    class, status. crosswalk: code, ordinal, formality_id, mode, url, assertion, name, in_public, public_name, same_name,
    live_result, live_visible. live: code, result, visible. legal: code, status, basis, role, sources (array of struct url).
    summary (one row): snapshot, as_of, version, commit; published, excluded, audited, needs_review, mapped, crosswalk,
    in_public, gap, legal, legal_current, legal_repealed, legal_pending, legal_added, superseded; cw_in_public, cw_missing,
    cw_version, cw_commit, cw_verified, cw_unresolved, cw_waf; live_format, live_items, live_unresolved, live_waf; primary,
    primary_checked, primary_containing, repeal_code, repeal_decision.

    A blank key takes no part in what compares tables. parts: as in integrity.findings, several releases side by side.
    """
    code, status = F.trim(_c("code")), F.coalesce(_c("status"), F.lit(""))
    faults = catalogue.name_faults(_c("name"))
    public = Table(
        t["public"], code,
        [
            Rule("NO_CODE", blank(code)),
            *[Rule(f, F.array_contains(faults, f), _c("name")) for f in ("NAME_MISSING", "NAME_EXTRACTED", "NAME_UNCLEAN", "NAME_SPLIT")],
            Rule("FIELD_UNKNOWN", blank(F.trim(_c("field"))) | _c("field").startswith("CHƯA XÁC MINH")),
            Rule("STATUS_FORBIDDEN", status.contains("repealed") | status.contains("future_effective"), status),
            Rule("NOT_VERIFIED", ~_is(_c("verified"))),
            Rule("NO_EVIDENCE", no_items(_c("evidence"))),
            Rule("REPEALED_IN_PUBLIC", code.isin(*e.repealed)),
            Rule("FUTURE_IN_PUBLIC", code.isin(*e.future)),
        ],
        unique={"CODE_AGAIN": code},
        required={"CURRENT_MISSING": (e.current, F.lit(True)), "RECEIVED_UNPUBLISHED": (list(e.received), F.lit(True))},
        totals={"public": F.lit(1), "mapped": F.when(~blank(_c("formality_id")), 1)},
    )
    excluded = Table(
        t["excluded"], code,
        required={"REPEALED_WITHOUT_TRACE": (e.repealed, F.lit(True)), "FUTURE_NOT_MARKED": (e.future, status.contains("future_effective"))},
        totals={"excluded": F.lit(1)},
    )
    own, sections = _c("decision") == e.received_by, _c("decision") == e.sections_of
    wanted = F.create_map(*[F.lit(x) for kv in e.received.items() for x in kv]) if e.received else F.create_map().cast("map<string,string>")
    section = F.create_map(*[F.lit(x) for kv in e.sections.items() for x in kv]) if e.sections else F.create_map().cast("map<string,string>")
    listed, shown = F.try_element_at(section, code), F.try_element_at(wanted, code)
    updates = Table(
        t["updates"], code,
        [
            Rule("RECEIVED_FIELD", own & _is(_c("received")) & shown.isNotNull() & ~shown.eqNullSafe(_c("field")), _c("field")),
            Rule("RECEIVED_UNEXPECTED", own & _is(_c("received")) & shown.isNull() & ~code.isin(*e.shared)),
            Rule("SHARED_RECEIVED", own & _is(_c("received")) & code.isin(*e.shared)),
            Rule("SECTION_WRONG", sections & listed.isNotNull() & ~listed.eqNullSafe(_c("section")), _c("section")),
        ],
        required={"RECEIVED_MISSING": (list(e.received), own & _is(_c("received"))), "SECTION_MISSING": (list(e.sections), sections)},
    )
    decisions = Table(t["decisions"], _c("number"), required={"DECISION_MISSING": (e.decisions, F.lit(True))})
    official = _c("class") == "public_tthc"
    manifest = Table(
        t["manifest"], _c("number"),
        [Rule("MANIFEST_FIELD", official & blank(_c(c)), c) for c in ("day", "article_url", "pdf_url", "path")],
        unique={"DECISION_AGAIN": _c("number")},
    )
    waits = (_c("class") == "needs_review") | F.coalesce(_c("status"), F.lit("")).rlike("^(" + "|".join(_FAILED) + ")")
    index = Table(t["index"], F.rtrim(_c("url"), F.lit("/")), [Rule("SOURCE_NEEDS_REVIEW", waits)], unique={"URL_AGAIN": F.rtrim(_c("url"), F.lit("/"))})
    fid = F.lower(F.trim(_c("formality_id")))
    keyword = _c("mode") == "keyword_fallback"
    crosswalk = Table(
        t["crosswalk"], code,
        [
            Rule("CROSSWALK_NO_CODE", blank(code)),
            Rule("CROSSWALK_ORDINAL", ~_is(_c("ordinal").between(1, e.crosswalk)), _c("ordinal").cast("string")),
            Rule("CROSSWALK_ID", ~blank(fid) & ~fid.rlike(_UUID), fid),
            Rule("CROSSWALK_KEYWORD", keyword & ~code.isin(*e.keyword_only)),
            Rule("CROSSWALK_URL", ~_is(_c("url").startswith(e.crosswalk_base)), _c("url")),
            Rule("CROSSWALK_ASSERTS", _not(_c("assertion"), "none_from_priority_crosswalk"), _c("assertion")),
        ],
        unique={"CROSSWALK_CODE_AGAIN": code, "CROSSWALK_ID_AGAIN": fid, "ORDINAL_AGAIN": _c("ordinal")},
        required={"KEYWORD_MISSING": (e.keyword_only, keyword)},
        totals={"crosswalk": F.lit(1), "crosswalk_ids": F.when(~blank(fid), 1), "said_in": F.when(_is(_c("in_public")), 1)},
    )
    result = _c("result")
    live = Table(
        t["live"], code,
        totals={"live": F.lit(1), "live_verified": F.when(result.isin(*_VERIFIED), 1), "live_unresolved": F.when(result == "UNRESOLVED_VISIBLE_IDENTITY", 1), "live_waf": F.when(result == "WAF_REJECTED", 1)},
    )
    foreign = F.filter(_c("sources"), lambda s: ~_is(urls.host(s["url"]).isin(*e.hosts)))
    legal = Table(
        t["legal"], code,
        [
            Rule("LEGAL_NO_CODE", blank(code)),
            Rule("LEGAL_STATUS", ~_is(_c("status").isin(CURRENT, REPEALED)), _c("status")),
            Rule("LEGAL_REPEALED_UNEXPECTED", (_c("status") == REPEALED) & ~code.isin(*e.crosswalk_repealed)),
            Rule("LEGAL_BASIS", _not(_c("basis"), "official_haiphong_source"), _c("basis")),
            Rule("LEGAL_ROLE", _not(_c("role"), "technical_identity_only"), _c("role")),
            Rule("LEGAL_NO_SOURCE", no_items(_c("sources"))),
            Rule("LEGAL_HOST", F.size(foreign) > 0, F.get(foreign, F.lit(0))["url"]),
        ],
        unique={"LEGAL_CODE_AGAIN": code},
        required={"LEGAL_REPEALED_MISSING": (e.crosswalk_repealed, _c("status") == REPEALED)},
        totals={"legal": F.lit(1), "legal_current": F.when(_c("status") == CURRENT, 1), "legal_repealed": F.when(_c("status") == REPEALED, 1)},
    )
    summary = Table(t["summary"], F.lit(""), values={f"summary.{c}": _c(c) for c in t["summary"].columns if c != "part"})
    samples = Table(t["samples"], code, required={"SAMPLE_MISSING": (list(e.samples), F.lit(True))}, rules=[Rule("SAMPLE_CHANGED", code.isin(*e.samples) & ~F.coalesce(*[F.when(code == k, _c("formality_id").eqNullSafe(F.lit(v))) for k, v in e.samples.items()], F.lit(True)), _c("formality_id"))])
    tables = {
        "public": public, "excluded": excluded, "updates": updates, "decisions": decisions, "manifest": manifest, "files": Table(t["files"], _c("path")), "index": index, "crosswalk": crosswalk, "live": live, "legal": legal,
        "export": Table(t["export"], code), "legacy": Table(t["legacy"], code, totals={"legacy": F.lit(1)}), "samples": samples, "summary": summary,
    }
    shown = {c: _c(c) for c in ("name", "priority", "ordinal", "formality_id", "legal_status", "article_url")}
    crossed = {c: _c(c) for c in ("name", "ordinal", "formality_id", "in_public", "public_name", "same_name", "live_result", "live_visible")}
    given = lambda x: F.coalesce(x, F.lit("")) != ""
    pairs = [
        Pair("crosswalk and public", Side("crosswalk", code, crossed), Side("public", code, shown), _crosswalk_and_public(e, given)),
        Pair(
            "crosswalk and live", Side("crosswalk", code, crossed), Side("live", code, {"result": result, "visible": _c("visible")}),
            lambda c, v: [
                Rule("LIVE_KEY_SET", c.there != v.there, F.when(c.there, "not in live").otherwise("not in the crosswalk")),
                Rule("LIVE_RESULT", c.there & v.there & ~c("live_result").eqNullSafe(v("result")), c("live_result")),
                Rule("LIVE_VISIBLE", c.there & v.there & ((F.coalesce(c("live_visible"), F.lit("false")) == "true") != (F.coalesce(v("visible"), F.lit("false")) == "true"))),
            ],
        ),
        Pair(
            "legal and public", Side("legal", code, {"status": _c("status")}), Side("public", code, shown),
            lambda x, p: [
                Rule("LEGAL_CURRENT_UNPUBLISHED", (x("status") == CURRENT) & ~p.there),
                Rule("LEGAL_STATUS_NOT_TAKEN", (x("status") == CURRENT) & p.there & _not(p("legal_status"), CURRENT), p("legal_status")),
                Rule("LEGAL_NOT_PRIORITY", (x("status") == CURRENT) & p.there & _not(p("priority"), "true")),
                Rule("LEGAL_NO_ARTICLE", (x("status") == CURRENT) & p.there & ~given(p("article_url"))),
                Rule("LEGAL_REPEALED_PUBLIC", (x("status") == REPEALED) & p.there),
            ],
        ),
        Pair(
            "legal and excluded", Side("legal", code, where=_c("status") == REPEALED), Side("excluded", code, {"status": _c("status")}),
            lambda x, p: [Rule("LEGAL_REPEALED_NOT_EXCLUDED", x.there & _not(p("status"), REPEALED), p("status"))],
        ),
        Pair("internal and public decisions", Side("manifest", _c("number"), where=_c("class") == "internal_process"), Side("decisions", _c("number")), lambda m, d: [Rule("INTERNAL_IS_PUBLIC", m.there & d.there)]),
        Pair("manifest and files", Side("manifest", _c("path"), {"number": _c("number")}, official), Side("files", _c("path")), lambda m, f: [Rule("FILE_MISSING", m.there & ~f.there, m("number"))]),
        Pair("export and public", Side("export", code), Side("public", code), lambda x, p: [Rule("EXPORT_KEY_SET", x.there != p.there, F.when(x.there, "only in the export").otherwise("not in the export"))]),
    ]
    return findings(tables, pairs, lambda v: _totals(v, e), parts)


def _crosswalk_and_public(e: Expected, given):
    def rules(c, p):
        both, alone = c.there & p.there, c.there & ~p.there
        return [
            Rule("CROSSWALK_NOT_MARKED", both & _not(c("in_public"), "true")),
            Rule("CROSSWALK_PUBLIC_NAME", both & ~c("public_name").eqNullSafe(p("name")), c("public_name")),
            Rule("CROSSWALK_SAME_NAME", both & ~c("same_name").eqNullSafe(c("name").eqNullSafe(p("name")).cast("string")), c("same_name")),
            Rule("CROSSWALK_MARKED", alone & _not(c("in_public"), "false")),
            Rule("CROSSWALK_KEEPS_NAME", alone & (c("public_name").isNotNull() | c("same_name").isNotNull())),
            Rule("PRIORITY_NOT_MARKED", both & _not(p("priority"), "true")),
            Rule("PRIORITY_ORDINAL", both & ~p("ordinal").eqNullSafe(c("ordinal")), p("ordinal")),
            Rule("PRIORITY_ID", both & given(c("formality_id")) & ~p("formality_id").eqNullSafe(c("formality_id")), p("formality_id")),
            # codes that only the crosswalk holds are the repealed ones, no more and no fewer
            Rule("CROSSWALK_GAP", alone & ~_key_in(e.crosswalk_repealed)),
            Rule("CROSSWALK_GAP_FILLED", both & _key_in(e.crosswalk_repealed)),
        ]

    return rules


def _key_in(keys: Sequence[str]) -> Column:
    return F.col("key").isin(*keys)


def _totals(v: Totals, e: Expected) -> list[Rule]:
    """Totals of the tables against each other, against the summary and against what is expected; all names are codes of findings."""
    said = lambda name: v.n(f"summary.{name}")
    text = lambda name: v.text(f"summary.{name}")
    inside = e.crosswalk - len(e.crosswalk_repealed)
    equal = {
        "SUM_PUBLISHED": (said("published"), v.n("public")), "SUM_EXCLUDED": (said("excluded"), v.n("excluded")), "SUM_AUDITED": (said("audited"), v.n("public") + v.n("excluded")), "SUM_MAPPED": (said("mapped"), v.n("mapped")),
        "N_CROSSWALK": (v.n("crosswalk"), F.lit(e.crosswalk)), "N_CROSSWALK_IDS": (v.n("crosswalk_ids"), F.lit(e.crosswalk_ids)), "N_IN_PUBLIC": (v.n("said_in"), F.lit(inside)),
        "SUM_CROSSWALK": (said("crosswalk"), F.lit(e.crosswalk)), "SUM_IN_PUBLIC": (said("in_public"), F.lit(inside)), "SUM_GAP": (said("gap"), F.lit(len(e.crosswalk_repealed))),
        "CW_IN_PUBLIC": (said("cw_in_public"), v.n("said_in")), "CW_MISSING": (said("cw_missing"), v.n("crosswalk") - v.n("said_in")),
        "N_LIVE": (v.n("live"), F.lit(e.crosswalk)), "N_LIVE_VERIFIED": (v.n("live_verified"), F.lit(e.live[0])), "N_LIVE_UNRESOLVED": (v.n("live_unresolved"), F.lit(e.live[1])), "N_LIVE_WAF": (v.n("live_waf"), F.lit(e.live[2])),
        "LIVE_ITEMS": (said("live_items"), v.n("live")), "LIVE_SUM_UNRESOLVED": (said("live_unresolved"), v.n("live_unresolved")), "LIVE_SUM_WAF": (said("live_waf"), v.n("live_waf")),
        "CW_LIVE_VERIFIED": (said("cw_verified"), v.n("live_verified")), "CW_LIVE_UNRESOLVED": (said("cw_unresolved"), v.n("live_unresolved")), "CW_LIVE_WAF": (said("cw_waf"), v.n("live_waf")),
        "N_LEGAL_CURRENT": (v.n("legal_current"), F.lit(e.legal[0])), "N_LEGAL_REPEALED": (v.n("legal_repealed"), F.lit(e.legal[1])), "N_LEGAL": (v.n("legal"), F.lit(sum(e.legal))),
        "SUM_LEGAL": (said("legal"), F.lit(sum(e.legal))), "SUM_LEGAL_CURRENT": (said("legal_current"), v.n("legal_current")), "SUM_LEGAL_REPEALED": (said("legal_repealed"), v.n("legal_repealed")),
        "SUM_LEGAL_PENDING": (said("legal_pending"), F.lit(0)), "SUM_SUPERSEDED": (said("superseded"), F.lit(0)),
        "N_PRIMARY": (said("primary"), F.lit(e.primary_sources)), "N_PRIMARY_CHECKED": (said("primary_checked"), F.lit(e.primary_sources - 1)), "N_PRIMARY_CONTAINING": (said("primary_containing"), F.lit(e.primary_sources - 1)),
    }
    rules = [Rule(c, ~a.eqNullSafe(b), F.concat_ws(" for ", F.coalesce(a.cast("string"), F.lit("none")), F.coalesce(b.cast("string"), F.lit("none")))) for c, (a, b) in equal.items()]
    return [
        *rules,
        Rule("BAD_SNAPSHOT", ~_is(text("snapshot").rlike(_DAY)), text("snapshot")),
        Rule("SNAPSHOT_DRIFT", given(text("as_of")) & ~text("as_of").eqNullSafe(text("snapshot")), text("as_of")),
        Rule("CW_VERSION", ~text("cw_version").eqNullSafe(text("version")), text("cw_version")),
        Rule("CW_COMMIT", ~text("cw_commit").eqNullSafe(text("commit")), text("cw_commit")),
        Rule("LIVE_FORMAT", _not(text("live_format"), "DVCQG_LIVE_READONLY_VERIFICATION"), text("live_format")),
        Rule("UPDATES_NEED_REVIEW", said("needs_review") > 0, text("needs_review")),
        Rule("LEAST_MAPPED", v.n("mapped") < e.least_mapped, v.text("mapped")),
        Rule("LEGAL_ADDED", ~_is(F.coalesce(said("legal_added"), F.lit(0)).between(0, v.n("legal_current"))), text("legal_added")),
        Rule("REPEAL_NOT_CHECKED", blank(text("repeal_code")) | ~_is(text("repeal_code").isin(*e.crosswalk_repealed)) | blank(text("repeal_decision")), text("repeal_code")),
        Rule("NO_LEGACY", v.n("legacy") == 0),
    ]


def given(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) != ""
