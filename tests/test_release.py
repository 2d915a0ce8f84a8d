"""A whole small release without findings, and one change for each code that a release can be found to break."""

import re

from pyspark.sql import functions as F

from regloom.functions import catalogue
from regloom.operators.expect import Rule
from regloom.operators.integrity import Pair, Side, Table, findings
from regloom.plans import release
from regloom.plans.release import CURRENT, REPEALED, Expected, release_findings

ID = "0{}9d2bfd-95d6-778f-889b-e3045003fa5e"
KINDS = {
    "public": "code string, name string, field string, status string, verified boolean, evidence array<string>, formality_id string, priority boolean, ordinal int, legal_status string, article_url string",
    "excluded": "code string, status string", "export": "code string", "legacy": "code string", "samples": "code string, formality_id string",
    "updates": "code string, decision string, section string, received boolean, field string", "decisions": "number string",
    "manifest": "number string, class string, day string, article_url string, pdf_url string, path string", "files": "path string", "index": "url string, class string, status string",
    "crosswalk": "code string, ordinal int, formality_id string, mode string, url string, assertion string, name string, in_public boolean, public_name string, same_name boolean, live_result string, live_visible boolean",
    "live": "code string, result string, visible boolean", "legal": "code string, status string, basis string, role string, sources array<struct<url:string>>",
}
EXPECTED = Expected(
    repealed=["9.000001"], future=["9.000002"], current=["1.000001"], decisions=["1/Q"], received_by="1/Q", received={"1.000001": "A"}, shared=["1.000009"], sections_of="2/Q", sections={"9.000001": "repealed", "1.000002": "new"},
    crosswalk=3, crosswalk_ids=2, keyword_only=["9.000003"], crosswalk_repealed=["9.000003"], crosswalk_base="https://dvc.example/", live=(2, 1, 0), legal=(1, 1), primary_sources=2, hosts=["gov.example"], least_mapped=2, samples={"1.000001": ID.format(1)},
)
GOOD = {
    "public": [
        ("1.000001", "Cấp giấy", "A", "current", True, ["e"], ID.format(1), True, 1, CURRENT, "u"),
        ("1.000002", "Thủ tục (b)", "A", "", True, ["e"], ID.format(2), True, 2, None, None),
        ("1.000004", "Hồ sơ", "B", None, True, ["e"], None, None, None, None, None),
    ],
    "excluded": [("9.000001", REPEALED), ("9.000002", "future_effective"), ("9.000003", REPEALED)],
    "export": [("1.000001",), ("1.000002",), ("1.000004",)],
    "legacy": [("x",)],
    "samples": [("1.000001", ID.format(1)), ("5", "y")],
    "updates": [("1.000001", "1/Q", "new", True, "A"), ("1.000009", "1/Q", "new", False, "B"), ("9.000001", "2/Q", "repealed", False, ""), ("1.000002", "2/Q", "new", None, None)],
    "decisions": [("1/Q",), ("2/Q",)],
    "manifest": [("1/Q", "public_tthc", "2024-01-01", "a", "p", "f1"), ("3/Q", "internal_process", None, None, None, None)],
    "files": [("f1",)],
    "index": [("https://a/1/", "public_tthc", "ok"), ("https://a/2", "public_tthc", None)],
    "crosswalk": [
        ("1.000001", 1, ID.format(1), "id", "https://dvc.example/1", "none_from_priority_crosswalk", "Cấp giấy", True, "Cấp giấy", True, "VERIFIED_VISIBLE_IDENTITY", True),
        ("1.000002", 2, ID.format(2), "id", "https://dvc.example/2", "none_from_priority_crosswalk", "Khác", True, "Thủ tục (b)", False, "VERIFIED_VISIBLE_IDENTITY_AND_AGENCY", True),
        ("9.000003", 3, None, "keyword_fallback", "https://dvc.example/3", "none_from_priority_crosswalk", "Cũ", False, None, None, "UNRESOLVED_VISIBLE_IDENTITY", None),
    ],
    "live": [("1.000001", "VERIFIED_VISIBLE_IDENTITY", True), ("1.000002", "VERIFIED_VISIBLE_IDENTITY_AND_AGENCY", True), ("9.000003", "UNRESOLVED_VISIBLE_IDENTITY", False)],
    "legal": [("1.000001", CURRENT, "official_haiphong_source", "technical_identity_only", [("https://gov.example/x",)]), ("9.000003", REPEALED, "official_haiphong_source", "technical_identity_only", [("https://gov.example/y",)])],
}
SUMMARY = {
    "snapshot": "2024-07-01", "as_of": "2024-07-01", "version": "v", "commit": "c", "published": 3, "excluded": 3, "audited": 6, "needs_review": 0, "mapped": 2, "crosswalk": 3, "in_public": 2, "gap": 1, "legal": 2, "legal_current": 1,
    "legal_repealed": 1, "legal_pending": 0, "legal_added": 1, "superseded": 0, "cw_in_public": 2, "cw_missing": 1, "cw_version": "v", "cw_commit": "c", "cw_verified": 2, "cw_unresolved": 1, "cw_waf": 0,
    "live_format": "DVCQG_LIVE_READONLY_VERIFICATION", "live_items": 3, "live_unresolved": 1, "live_waf": 0, "primary": 2, "primary_checked": 1, "primary_containing": 1, "repeal_code": "9.000003", "repeal_decision": "4/Q",
}


def found(spark, *cases):
    """For each case the (code, key) of its findings; a case gives rows of tables, and changed values of the summary as a dict."""
    tables = {}
    for n, rows in GOOD.items():
        held = [(str(i), *r) for i, changed in enumerate(cases) for r in changed.get(n, rows)]
        tables[n] = spark.createDataFrame(held, f"part string, {KINDS[n]}").coalesce(1)
    held = [(str(i), *{**SUMMARY, **changed.get("summary", {})}.values()) for i, changed in enumerate(cases)]
    kind = ", ".join(f"{k} {'string' if isinstance(SUMMARY[k], str) else 'int'}" for k in SUMMARY)
    tables["summary"] = spark.createDataFrame(held, f"part string, {kind}").coalesce(1)
    parts = spark.createDataFrame([(str(i),) for i in range(len(cases))], "part string").coalesce(1)
    out = [set() for _ in cases]
    for r in release_findings(tables, EXPECTED, parts).collect():
        assert r["severity"] == "error" and (r["code"], r["key"]) not in out[int(r["part"])] or r["code"] == "MANIFEST_FIELD"
        out[int(r["part"])].add((r["code"], r["key"]))
    return out


def row(table, i, **values):
    names = [x.split()[0] for x in re.split(r", (?=\w+ )", KINDS[table])]
    return tuple(values.get(n, v) for n, v in zip(names, GOOD[table][i], strict=True))


def with_row(table, i, **values):
    return {table: [row(table, j, **values) if j == i else r for j, r in enumerate(GOOD[table])]}


def plus(table, *rows):
    return {table: [*GOOD[table], *rows]}


CASES = [
    ({**with_row("public", 2, name=" ")}, {("NAME_MISSING", "1.000004")}),
    ({**with_row("public", 2, name="Xin BƯỚC 1 của")}, {("NAME_EXTRACTED", "1.000004")}),
    ({**with_row("public", 2, name="Hồ sơ (a")}, {("NAME_UNCLEAN", "1.000004")}),
    ({**with_row("public", 2, name="Hồ t ờ sơ")}, set()),
    ({**with_row("public", 2, name="Hồ t rong")}, {("NAME_SPLIT", "1.000004")}),
    ({**with_row("public", 2, name="theo điểm b khoản")}, set()),
    ({**with_row("public", 2, field="CHƯA XÁC MINH x")}, {("FIELD_UNKNOWN", "1.000004")}),
    ({**with_row("public", 2, status="x_repealed")}, {("STATUS_FORBIDDEN", "1.000004")}),
    ({**with_row("public", 2, verified=None)}, {("NOT_VERIFIED", "1.000004")}),
    ({**with_row("public", 2, evidence=[])}, {("NO_EVIDENCE", "1.000004")}),
    ({**with_row("public", 2, code=" ")}, {("NO_CODE", ""), ("EXPORT_KEY_SET", "1.000004")}),
    ({**plus("public", row("public", 2))}, {("CODE_AGAIN", "1.000004"), ("SUM_PUBLISHED", ""), ("SUM_AUDITED", "")}),
    ({**with_row("public", 2, code="9.000001")}, {("REPEALED_IN_PUBLIC", "9.000001"), ("EXPORT_KEY_SET", "1.000004"), ("EXPORT_KEY_SET", "9.000001")}),
    ({**with_row("public", 2, code="9.000002"), **with_row("export", 2, code="9.000002")}, {("FUTURE_IN_PUBLIC", "9.000002")}),
    ({**with_row("excluded", 0, code="7")}, {("REPEALED_WITHOUT_TRACE", "9.000001")}),
    ({**with_row("excluded", 1, status="x")}, {("FUTURE_NOT_MARKED", "9.000002")}),
    ({**with_row("updates", 0, field="B")}, {("RECEIVED_FIELD", "1.000001")}),
    ({**with_row("updates", 0, received=False)}, {("RECEIVED_MISSING", "1.000001")}),
    ({**plus("updates", ("3", "1/Q", "new", True, "A"))}, {("RECEIVED_UNEXPECTED", "3")}),
    ({**with_row("updates", 1, received=True)}, {("SHARED_RECEIVED", "1.000009")}),
    ({**with_row("updates", 2, section="new")}, {("SECTION_WRONG", "9.000001")}),
    ({**with_row("updates", 3, code="1.7")}, {("SECTION_MISSING", "1.000002")}),
    ({**with_row("decisions", 0, number="0")}, {("DECISION_MISSING", "1/Q")}),
    ({**plus("decisions", ("3/Q",))}, {("INTERNAL_IS_PUBLIC", "3/Q")}),
    ({**with_row("manifest", 0, pdf_url="")}, {("MANIFEST_FIELD", "1/Q")}),
    ({**plus("manifest", row("manifest", 1))}, {("DECISION_AGAIN", "3/Q")}),
    ({**with_row("files", 0, path="f2")}, {("FILE_MISSING", "f1")}),
    ({**with_row("index", 1, url="https://a/1")}, {("URL_AGAIN", "https://a/1")}),
    ({**with_row("index", 1, status="pdf_download_failed: 404")}, {("SOURCE_NEEDS_REVIEW", "https://a/2")}),
    ({**with_row("index", 0, **{"class": "needs_review"})}, {("SOURCE_NEEDS_REVIEW", "https://a/1")}),
    ({**with_row("crosswalk", 0, ordinal=4), **with_row("public", 0, ordinal=4)}, {("CROSSWALK_ORDINAL", "1.000001")}),
    ({**with_row("crosswalk", 0, ordinal=2), **with_row("public", 0, ordinal=2)}, {("ORDINAL_AGAIN", "2")}),
    ({**with_row("crosswalk", 0, formality_id="zz"), **with_row("public", 0, formality_id="zz")}, {("CROSSWALK_ID", "1.000001")}),
    ({**with_row("crosswalk", 0, formality_id=ID.format(2)), **with_row("public", 0, formality_id=ID.format(2))}, {("CROSSWALK_ID_AGAIN", ID.format(2))}),
    ({**with_row("crosswalk", 0, mode="keyword_fallback")}, {("CROSSWALK_KEYWORD", "1.000001")}),
    ({**with_row("crosswalk", 2, mode="id")}, {("KEYWORD_MISSING", "9.000003")}),
    ({**with_row("crosswalk", 0, url="http://dvc.example/1")}, {("CROSSWALK_URL", "1.000001")}),
    ({**with_row("crosswalk", 0, assertion=None)}, {("CROSSWALK_ASSERTS", "1.000001")}),
    ({**with_row("crosswalk", 0, in_public=False)}, {("CROSSWALK_NOT_MARKED", "1.000001"), ("N_IN_PUBLIC", ""), ("CW_IN_PUBLIC", ""), ("CW_MISSING", "")}),
    ({**with_row("crosswalk", 0, public_name="x")}, {("CROSSWALK_PUBLIC_NAME", "1.000001")}),
    ({**with_row("crosswalk", 1, same_name=True)}, {("CROSSWALK_SAME_NAME", "1.000002")}),
    ({**with_row("crosswalk", 2, in_public=None)}, {("CROSSWALK_MARKED", "9.000003")}),
    ({**with_row("crosswalk", 2, public_name="x")}, {("CROSSWALK_KEEPS_NAME", "9.000003")}),
    ({**with_row("public", 1, priority=False)}, {("PRIORITY_NOT_MARKED", "1.000002")}),
    ({**with_row("public", 1, ordinal=1)}, {("PRIORITY_ORDINAL", "1.000002")}),
    ({**with_row("public", 1, formality_id=ID.format(7))}, {("PRIORITY_ID", "1.000002")}),
    ({**with_row("crosswalk", 1, code="8"), **with_row("live", 1, code="8")}, {("CROSSWALK_GAP", "8"), ("CROSSWALK_MARKED", "8"), ("CROSSWALK_KEEPS_NAME", "8")}),
    ({**with_row("public", 2, code="9.000003"), **with_row("export", 2, code="9.000003")}, {(c, "9.000003") for c in ("CROSSWALK_GAP_FILLED", "LEGAL_REPEALED_PUBLIC", "CROSSWALK_SAME_NAME", "PRIORITY_ORDINAL", "PRIORITY_NOT_MARKED", "CROSSWALK_PUBLIC_NAME", "CROSSWALK_NOT_MARKED")}),
    ({**with_row("crosswalk", 1, code="1.000001")}, {("LIVE_KEY_SET", "1.000002"), *((c, "1.000001") for c in ("CROSSWALK_CODE_AGAIN", "CROSSWALK_PUBLIC_NAME", "LIVE_RESULT", "PRIORITY_ID", "PRIORITY_ORDINAL"))}),
    ({**plus("crosswalk", row("crosswalk", 2, code="", ordinal=None))}, {("CROSSWALK_NO_CODE", ""), ("CROSSWALK_ORDINAL", ""), ("CROSSWALK_KEYWORD", ""), ("N_CROSSWALK", ""), ("CW_MISSING", "")}),
    ({**with_row("crosswalk", 0, formality_id=None)}, {("N_CROSSWALK_IDS", "")}),
    ({**with_row("live", 0, visible=False)}, {("LIVE_VISIBLE", "1.000001")}),
    ({**with_row("crosswalk", 0, live_result=None)}, {("LIVE_RESULT", "1.000001")}),
    ({**with_row("live", 0, result="WAF_REJECTED"), **with_row("crosswalk", 0, live_result="WAF_REJECTED")}, {("N_LIVE_VERIFIED", ""), ("N_LIVE_WAF", ""), ("LIVE_SUM_WAF", ""), ("CW_LIVE_VERIFIED", ""), ("CW_LIVE_WAF", "")}),
    ({**with_row("live", 2, result="x"), **with_row("crosswalk", 2, live_result="x")}, {("N_LIVE_UNRESOLVED", ""), ("LIVE_SUM_UNRESOLVED", ""), ("CW_LIVE_UNRESOLVED", "")}),
    ({**plus("live", ("7", "x", None))}, {("LIVE_KEY_SET", "7"), ("N_LIVE", ""), ("LIVE_ITEMS", "")}),
    ({**with_row("legal", 0, status="pending")}, {("LEGAL_STATUS", "1.000001"), ("N_LEGAL_CURRENT", ""), ("SUM_LEGAL_CURRENT", ""), ("LEGAL_ADDED", "")}),
    ({**with_row("legal", 1, code="9.000001")}, {("LEGAL_REPEALED_UNEXPECTED", "9.000001"), ("LEGAL_REPEALED_MISSING", "9.000003")}),
    ({**with_row("legal", 0, basis=None)}, {("LEGAL_BASIS", "1.000001")}),
    ({**with_row("legal", 0, role="x")}, {("LEGAL_ROLE", "1.000001")}),
    ({**with_row("legal", 0, sources=[])}, {("LEGAL_NO_SOURCE", "1.000001")}),
    ({**with_row("legal", 0, sources=[("https://gov.example/a",), ("https://a.gov.example/",)])}, {("LEGAL_HOST", "1.000001")}),
    ({**plus("legal", row("legal", 0, code="1.000002"))}, {("LEGAL_STATUS_NOT_TAKEN", "1.000002"), ("LEGAL_NO_ARTICLE", "1.000002"), ("N_LEGAL", ""), ("N_LEGAL_CURRENT", ""), ("SUM_LEGAL_CURRENT", "")}),
    ({**with_row("legal", 0, code="")}, {("LEGAL_NO_CODE", "")}),
    ({**plus("legal", row("legal", 1))}, {("LEGAL_CODE_AGAIN", "9.000003"), ("N_LEGAL", ""), ("N_LEGAL_REPEALED", ""), ("SUM_LEGAL_REPEALED", "")}),
    ({**with_row("legal", 0, code="6")}, {("LEGAL_CURRENT_UNPUBLISHED", "6")}),
    ({**with_row("legal", 0, code="1.000004")}, {("LEGAL_STATUS_NOT_TAKEN", "1.000004"), ("LEGAL_NOT_PRIORITY", "1.000004"), ("LEGAL_NO_ARTICLE", "1.000004")}),
    ({**with_row("excluded", 2, status="x")}, {("LEGAL_REPEALED_NOT_EXCLUDED", "9.000003")}),
    ({**plus("export", ("6",))}, {("EXPORT_KEY_SET", "6")}),
    ({"legacy": []}, {("NO_LEGACY", "")}),
    ({**with_row("samples", 0, formality_id="x")}, {("SAMPLE_CHANGED", "1.000001")}),
    ({**with_row("samples", 0, code="x")}, {("SAMPLE_MISSING", "1.000001")}),
    ({"summary": {"snapshot": "today"}}, {("BAD_SNAPSHOT", ""), ("SNAPSHOT_DRIFT", "")}),
    ({"summary": {"as_of": "2024-07-02"}}, {("SNAPSHOT_DRIFT", "")}),
    ({"summary": {"as_of": None}}, set()),
    ({"summary": {"cw_version": None}}, {("CW_VERSION", "")}),
    ({"summary": {"cw_commit": "x"}}, {("CW_COMMIT", "")}),
    ({"summary": {"live_format": None}}, {("LIVE_FORMAT", "")}),
    ({"summary": {"needs_review": 2}}, {("UPDATES_NEED_REVIEW", "")}),
    ({"summary": {"legal_added": 2}}, {("LEGAL_ADDED", "")}),
    ({"summary": {"repeal_code": "1.000001"}}, {("REPEAL_NOT_CHECKED", "")}),
    ({"summary": {"primary": 3, "primary_checked": None, "primary_containing": 0}}, {("N_PRIMARY", ""), ("N_PRIMARY_CHECKED", ""), ("N_PRIMARY_CONTAINING", "")}),
    ({"summary": {"published": 4, "excluded": None, "audited": 0, "mapped": 3}}, {("SUM_PUBLISHED", ""), ("SUM_EXCLUDED", ""), ("SUM_AUDITED", ""), ("SUM_MAPPED", "")}),
    ({"summary": {"crosswalk": 4, "in_public": 3, "gap": 0, "legal": 3, "legal_pending": 1, "superseded": 1}}, {("SUM_CROSSWALK", ""), ("SUM_IN_PUBLIC", ""), ("SUM_GAP", ""), ("SUM_LEGAL", ""), ("SUM_LEGAL_PENDING", ""), ("SUM_SUPERSEDED", "")}),
    ({**with_row("public", 1, formality_id=None), "summary": {"mapped": 1}}, {("LEAST_MAPPED", ""), ("PRIORITY_ID", "1.000002")}),
]


def test_every_code_is_found(spark):
    """The good release has no findings; each change has just those that it must have."""
    good, gone, *got = found(spark, {}, {"public": GOOD["public"][1:], "export": GOOD["export"][1:]}, *[c for c, _ in CASES])
    assert good == set()
    assert {("CURRENT_MISSING", "1.000001"), ("RECEIVED_UNPUBLISHED", "1.000001"), ("CROSSWALK_GAP", "1.000001"), ("LEGAL_CURRENT_UNPUBLISHED", "1.000001")} <= gone
    wrong = [(c, g - w, w - g) for (c, w), g in zip(CASES, got, strict=True) if g != w]
    assert not wrong, wrong
    source = open(release.__file__, encoding="utf-8").read()
    codes = set(re.findall(r'Rule\("([A-Z_]+)"', source)) | set(re.findall(r'"([A-Z_]{4,})": \(', source)) | set(re.findall(r'"([A-Z_]+_AGAIN)"', source))
    assert codes - {"VERIFIED_VISIBLE_IDENTITY"} <= {c for g in [gone, *got] for c, _ in g}


def test_names(spark):
    names = [None, "", "Tên:", "a|b", "(a))", "tốt", "Thủ tục thủ tục x", "Cấp c hứng", "điểm c khoản"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(catalogue.name_faults(F.col("n")).alias("f")).collect()
    assert [r["f"] for r in got] == [["NAME_MISSING"], ["NAME_MISSING"], ["NAME_UNCLEAN"], ["NAME_UNCLEAN"], ["NAME_UNCLEAN"], [], ["NAME_EXTRACTED"], ["NAME_SPLIT"], []]


def test_one_scan_of_each_table_and_no_join(spark, tmp_path):
    for n in ("a", "b"):
        spark.range(100).selectExpr("cast(id % 40 as string) k", "id v").write.parquet(f"{tmp_path}/{n}")
    tables = {n: Table(spark.read.parquet(f"{tmp_path}/{n}"), F.col("k"), [Rule("BIG", F.col("v") > 97)], {"AGAIN": F.col("v") % 99}, {"GONE": (["39", "40"], F.lit(True))}, {f"n_{n}": F.lit(1)}) for n in ("a", "b")}
    pairs = [Pair(f"p{i}", Side("a", F.col("k"), {"v": F.col("v")}), Side("b", F.col("k"), {"v": F.col("v")}, F.col("v") < 99), lambda a, b: [Rule("DIFFERS", ~a("v").eqNullSafe(b("v")), b("v"))]) for i in range(3)]
    df = findings(tables, pairs, lambda t: [Rule("SUM", t.n("n_a") + t.n("n_b") != 201)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 2 and "Join" not in plan
    got = sorted((r["code"], r["key"], r["n"]) for r in df.collect())
    # of rows of one key the largest text counts: 99 and 59 for a, but b has no 99
    differ = sorted({str(k) for k in range(40) if max(str(v) for v in range(k, 100, 40)) != max(str(v) for v in range(k, 99, 40))})
    assert got == sorted([*[("BIG", k, 2) for k in ("18", "19")], *[("GONE", "40", 1)] * 2, *[("AGAIN", "0", 2)] * 2, ("SUM", "", 1), *[("DIFFERS", k, 3) for k in differ]])
