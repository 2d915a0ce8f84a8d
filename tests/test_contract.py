"""Record upgrade and the canonical contract: a clean record passes, and each change to it has just its findings."""

import copy
import hashlib
import json
import random
import unicodedata

from pyspark.sql import functions as F

from regloom.functions import text as tx
from regloom.operators import contract, upgrade, validators

HOST = "dichvucong.gov.vn"
SUFFIXES = ["gov.vn"]
LINK = f"https://{HOST}/tim?provinceCode=31&wardCode=11824&commune=WARD&isProvince=0&formalityId=f1"
EVIDENCE = upgrade.EVIDENCE
SOURCE = "struct<id:string,url:string,sourceRole:string,classification:string,publishedDate:string,effectiveDate:string>"
RECORD = f"ma string, ten string, linhVuc string, cap string, quyetDinh string, thoiHan string, formalityId string, nopHoSoUrl string, status string, evidence array<{EVIDENCE}>, sources array<{SOURCE}>, provenance map<string,array<string>>, fee string, dvctt string, guideStatus string, guideLink string, known map<string,array<string>>"
FULL = RECORD + f", sourceEvidence array<{EVIDENCE}>, lifecycle struct<status:string,asOf:string,effectiveFrom:string,effectiveTo:string>, fieldSources map<string,array<string>>"


def names(kind):
    return [x.split()[0] for x in kind.replace(f"array<{EVIDENCE}>", "x").replace(f"array<{SOURCE}>", "x").replace("map<string,array<string>>", "x").replace("struct<status:string,asOf:string,effectiveFrom:string,effectiveTo:string>", "x").split(", ")]


def evidence(**more):
    e = {"articleUrl": "https://haiphong.gov.vn/tin", "publishedDate": "2026-09-20", "effectiveDate": "2026-09-20", "classification": "public", "attachmentUrl": "https://haiphong.gov.vn/a.pdf", "attachmentSha256": "a" * 64, "decisionNumbers": ["123/QĐ-UBND"], "repealContext": False, **more}
    return {n: e.get(n) for n in upgrade._NAMES}


def record(**more):
    r = {"ma": "1.000001", "ten": "Thủ tục hợp lệ", "linhVuc": "TƯ PHÁP", "cap": "Xã", "evidence": [evidence()], **more}
    return tuple(r.get(n) for n in names(RECORD))


def filled(name):
    return F.coalesce(F.col(name), F.lit("")) != ""


def upgraded(spark, *records):
    df = spark.createDataFrame(list(records), RECORD).coalesce(1)
    guide = upgrade.Guide(F.col("sources"), F.col("provenance"), {"lePhi": filled("fee")}, {"dvctt": filled("dvctt"), "submissionUrl": filled("guideLink")})
    legal = {"ma": F.lit(True), "ten": F.lit(True), "linhVuc": F.lit(True), "cap": F.lit(True), "quyetDinh": filled("quyetDinh")}
    execution = {"formalityId": filled("formalityId"), **dict.fromkeys(("nopHoSoUrl", "nopHoSoScope", "submissionLinkStatus"), filled("nopHoSoUrl"))}
    links = [(F.col("nopHoSoUrl"), "dvcqg_submission_link", F.lit(""))]
    return upgrade.upgraded(df, F.col("evidence"), legal, execution, filled("thoiHan"), links, F.lit("2026-09-20"), SUFFIXES, HOST, guide, F.col("known"))


def plain_id(e):
    kept = {n: e.get(n) for n in upgrade.HASHED}
    kept["decisionNumbers"], kept["repealContext"] = e.get("decisionNumbers") or [], bool(e.get("repealContext"))
    return "ev_" + hashlib.sha1(json.dumps(kept, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:24]


def test_upgrade(spark):
    source = lambda i, u, role=None: (i, u, role, None, None, None)
    mapped = evidence(sourceRole="odd", articleUrl=f"https://{HOST}/x", attachmentUrl=None, effectiveDate=None)
    repeal = evidence(repealContext=True, effectiveDate="2027-01-01")
    timed = evidence(classification="official_table_guidance_duration", effectiveDate="", publishedDate="2026-10-05", decisionNumbers=None, repealContext=None)
    rows = upgraded(
        spark,
        record(evidence=[evidence(), None, mapped, evidence(verifiedAt="later"), repeal, timed], thoiHan="5 ngày", formalityId="f1", nopHoSoUrl=LINK, quyetDinh="1/Q",
               sources=[source("s1", " https://moj.gov.vn/1 "), source("s2", f"https://{HOST}/2", "local_execution"), source("s3", " "), None, source("s2", "https://moj.gov.vn/last", "local_execution")],
               provenance={"lePhi": ["s1", "none", None], "dvctt": ["s1", "s2"]}, fee="f", dvctt="d", guideLink=LINK, known={"ma": ["old", "old"], "own": ["k"], "thoiHan": []}),
        record(ma="2", evidence=None, sources=[source("a", "https://moj.gov.vn/1")], fee="f", provenance=None, dvctt="d", nopHoSoUrl="http://x"),
        record(ma="3", evidence=[], sources=None, fee="f"),
    ).orderBy("ma").collect()
    one, two, three = (r.asDict(recursive=True) for r in rows)
    own = [evidence(sourceRole="local_legal_effect", url="https://haiphong.gov.vn/tin"), {**mapped, "sourceRole": "local_execution", "url": mapped["articleUrl"]}, {**repeal, "sourceRole": "local_legal_effect", "url": repeal["articleUrl"]}, {**timed, "sourceRole": "local_legal_effect", "url": timed["articleUrl"]}]
    link = {"sourceRole": "local_execution", "url": LINK, "classification": "dvcqg_submission_link"}
    guide = [{"sourceRole": r, "url": u, "classification": "official_guidance"} for r, u in (("central_content_reference", "https://moj.gov.vn/1"), ("local_execution", f"https://{HOST}/2"), ("local_execution", "https://moj.gov.vn/last"))]
    ids = [plain_id(e) for e in [*own, link, *guide]]
    assert [e["evidenceId"] for e in one["sourceEvidence"]] == ids
    legal, execution = [ids[0], ids[2], ids[3]], [ids[1], ids[4], ids[6], ids[7]]
    assert one["lifecycle"] == {"status": "active", "asOf": "2026-09-20", "effectiveFrom": "2026-10-05", "effectiveTo": None}
    want = dict.fromkeys(("ten", "linhVuc", "cap", "quyetDinh", "lifecycle.status", "lifecycle.effectiveFrom"), legal)
    want |= dict.fromkeys(("formalityId", "nopHoSoUrl", "nopHoSoScope", "submissionLinkStatus", "huongDan.submissionUrl"), execution)
    want |= {"ma": ["old", "old", *legal], "own": ["k"], "thoiHan": [ids[3]], "huongDan.lePhi": [ids[5]], "huongDan.dvctt": [ids[7]]}
    assert one["fieldSources"] == want
    assert [e["sourceRole"] for e in two["sourceEvidence"]] == ["central_content_reference"] and two["lifecycle"]["effectiveFrom"] is None
    assert two["fieldSources"] == {"huongDan.lePhi": [two["sourceEvidence"][0]["evidenceId"]]}
    assert three["sourceEvidence"] == [] and three["fieldSources"] == {}


def good(spark):
    row = upgraded(spark, record(formalityId="f1", nopHoSoUrl=LINK, status="verified_official_guidance", fee="f", guideStatus="verified_official", sources=[("s1", "https://moj.gov.vn/1", None, None, None, None)])).first().asDict(recursive=True)
    row["sources"][0]["sourceRole"] = "central_content_reference"
    return row


def set_(*path):
    *way, last, value = path

    def change(r):
        for p in way:
            r = r[p]
        r[last] = value

    return change


def rehashed(**more):
    """Change the first evidence and everything that cites it."""

    def change(r):
        e = r["sourceEvidence"][0]
        old = e["evidenceId"]
        e.update(more)
        e["evidenceId"] = plain_id(e)
        r["fieldSources"] = {f: [e["evidenceId"] if i == old else i for i in ids] for f, ids in r["fieldSources"].items()}

    return change


def add_repeal(day):
    def change(r):
        e = {**r["sourceEvidence"][0], "repealContext": True, "effectiveDate": day}
        e["evidenceId"] = plain_id(e)
        r["sourceEvidence"].append(e)

    return change


def cite(field, *places):
    def change(r):
        r["fieldSources"][field] = [r["sourceEvidence"][i]["evidenceId"] for i in places]

    return change


def drop_legal(r):
    r["sourceEvidence"] = r["sourceEvidence"][1:]


CASES = [
    (lambda r: None, []),
    (set_("ten", " "), ["NO_CODE_OR_NAME"]),
    (set_("ten", "\x07Tên\x07"), ["NAME_CONTROL"]),
    (set_("ten", "Th├╗ tß╗Ñc"), ["NAME_CP437"]),
    (set_("ten", "Cấp Ch ứng chỉ hành nghề đấu giá"), ["NAME_SPLIT"]),
    (set_("ten", unicodedata.normalize("NFD", "Thủ tục")), ["NAME_NOT_NFC"]),
    (set_("lifecycle", None), ["NO_LIFECYCLE"]),
    (set_("lifecycle", "status", "gone"), ["LIFECYCLE_STATUS"]),
    (set_("lifecycle", "asOf", None), ["LIFECYCLE_AS_OF"]),
    (set_("lifecycle", "effectiveTo", "1/2/2026"), ["LIFECYCLE_DATE"]),
    (set_("lifecycle", {"status": "future_effective", "asOf": "2026-09-20", "effectiveFrom": "2026-09-20", "effectiveTo": None}), ["LIFECYCLE_FUTURE"]),
    (set_("lifecycle", {"status": "future_effective", "asOf": "2026-09-20", "effectiveFrom": "2026-09-21", "effectiveTo": ""}), []),
    (set_("lifecycle", {"status": "repealed", "asOf": "2026-09-20", "effectiveFrom": None, "effectiveTo": "2026-09-21"}), ["LIFECYCLE_REPEALED"]),
    (set_("sourceEvidence", []), ["NO_EVIDENCE", "ACTIVE_WITHOUT_LEGAL", "FIELD_UNKNOWN_ID", "FIELD_NEEDS_LEGAL", "FIELD_NEEDS_EXECUTION"]),
    (lambda r: r["sourceEvidence"].append(None), ["EVIDENCE_NULL"]),
    (rehashed(sourceRole="x"), ["EVIDENCE_ROLE", "ACTIVE_WITHOUT_LEGAL", "FIELD_NEEDS_LEGAL"]),
    (set_("sourceEvidence", 1, "evidenceId", "ev_1"), ["EVIDENCE_ID", "FIELD_UNKNOWN_ID", "FIELD_NEEDS_EXECUTION"]),
    (set_("sourceEvidence", 1, "publishedDate", "2026-01-01"), ["EVIDENCE_ID_CONTENT"]),
    (set_("sourceEvidence", 1, "verifiedAt", "2026-01-01"), []),
    (lambda r: r["sourceEvidence"].append(r["sourceEvidence"][0]), ["EVIDENCE_AGAIN"]),
    (rehashed(url=" ", articleUrl="", attachmentUrl=None), ["EVIDENCE_NO_URL"]),
    (rehashed(articleUrl="https://haiphong.gov.vn.example"), ["EVIDENCE_URL"]),
    (rehashed(attachmentSha256="abc"), ["EVIDENCE_SHA"]),
    (rehashed(publishedDate="20/9/2026"), ["EVIDENCE_DATE"]),
    (add_repeal("2026-09-20"), ["ACTIVE_BUT_REPEALED"]),
    (add_repeal("2026-09-19"), []),
    (set_("fieldSources", None), ["NO_FIELD_SOURCES", "FIELD_WITHOUT_SOURCE"]),
    (lambda r: r["fieldSources"].pop("cap"), ["FIELD_WITHOUT_SOURCE"]),
    (set_("fieldSources", "other", []), ["FIELD_NO_IDS"]),
    (set_("fieldSources", "cap", []), ["FIELD_NO_IDS", "FIELD_WITHOUT_SOURCE"]),
    (cite("cap", 0, 0), ["FIELD_ID_AGAIN"]),
    (set_("fieldSources", "ma", ["ev_deadbeefdeadbeefdeadbeef"]), ["FIELD_UNKNOWN_ID", "FIELD_NEEDS_LEGAL"]),
    (set_("fieldSources", "other", [None]), ["FIELD_UNKNOWN_ID"]),
    (cite("ma", 1), ["FIELD_NEEDS_LEGAL"]),
    (cite("formalityId", 0), ["FIELD_NEEDS_EXECUTION"]),
    (cite("cap", 0, 2), ["FIELD_CENTRAL"]),
    (cite("nopHoSoUrl", 1, 2), ["FIELD_CENTRAL"]),
    (cite("huongDan.lePhi", 1), ["FIELD_GUIDANCE_ROLE"]),
    (cite("huongDan.lePhi", 0, 2), []),
    (set_("status", None), ["LINK_STATUS"]),
    (set_("nopHoSoUrl", LINK.replace("https", "http")), ["LINK_HOST"]),
    (set_("nopHoSoUrl", LINK.replace("e=31", "e=32")), ["LINK_PROVINCE"]),
    (set_("nopHoSoUrl", LINK.replace("=WARD", "=X")), ["LINK_COMMUNE"]),
    (set_("nopHoSoUrl", LINK.replace("isProvince=0", "isProvince=1")), ["LINK_IS_PROVINCE"]),
    (set_("nopHoSoUrl", LINK.replace("=f1", "=f2")), ["LINK_ID"]),
    (set_("cap", "Cấp tỉnh"), ["LINK_NOT_PROVINCE", "LINK_FORCED_COMMUNE"]),
    (lambda r: r.update(cap="Cấp tỉnh - x", nopHoSoUrl=f"https://{HOST}/t?provinceCode=31&isProvince=1&formalityId=f1"), []),
    (set_("guideStatus", "draft"), ["GUIDE_STATUS"]),
    (set_("sources", []), ["GUIDE_NO_SOURCES"]),
    (lambda r: r.update(guideStatus=None, sources=None), []),
    (set_("guideLink", "http://x"), ["GUIDE_LINK"]),
    (set_("sources", 0, "url", "https://example.org"), ["GUIDE_SOURCE_URL"]),
    (set_("sources", 0, "sourceRole", None), ["GUIDE_SOURCE_ROLE"]),
]
META = ("master-data", 4, "2026.09.20", "a" * 40, "kind")
META_KIND = "format string, version int, dataset_version string, source_commit string, source_commit_kind string"


def checked(spark, rows, meta=META, commit=None):
    df = spark.createDataFrame([tuple(r[n] for n in names(FULL)) for r in rows], FULL).coalesce(1)
    required = {"ma": F.lit(True), "cap": F.lit(True), "huongDan.lePhi": filled("fee"), "nopHoSoUrl": filled("nopHoSoUrl")}
    link = contract.Link(F.col("nopHoSoUrl"), F.col("status"), F.col("formalityId"), F.col("cap"))
    guide = contract.Guidance(F.col("guideStatus"), F.col("sources"), F.col("guideLink"))
    return contract.canonical(df, spark.createDataFrame([meta], META_KIND), F.col("ma"), F.col("ten"), required, link, guide, SUFFIXES, META[0], "kind", commit)


def test_every_code_of_the_contract(spark):
    clean, rows = good(spark), []
    for i, (change, _) in enumerate(CASES):
        r = copy.deepcopy(clean)
        change(r)
        rows.append({**r, "ma": str(i)})
    got = {}
    for f in checked(spark, rows).collect():
        got.setdefault(int(f["key"]), set()).add(f["code"])
    wrong = {i: (got.get(i, set()), want) for i, (_, want) in enumerate(CASES) if got.get(i, set()) != set(want)}
    assert not wrong, wrong


def test_envelope_and_codes_of_the_contract(spark):
    row = good(spark)
    codes = lambda *a, **b: sorted((f["code"], f["key"]) for f in checked(spark, *a, **b).collect())
    assert codes([row], ("x", None, "2026-09-20", "A" * 40, "y"), "b") == [(c, "") for c in ("COMMIT", "COMMIT_KIND", "COMMIT_MISMATCH", "DATASET_VERSION", "FORMAT", "VERSION")]
    assert codes([row], commit="a" * 40) == []
    assert codes([]) == [("NO_ROWS", "")]
    assert codes([row, row, {**row, "ma": None}]) == [("DUPLICATE_CODE", "1.000001"), ("NO_CODE_OR_NAME", "")]


def test_not_composed(spark):
    r = random.Random(1)
    pool = [0x41, 0x61, 0x65, 0x75, 0x71, 0x300, 0x301, 0x302, 0x323, 0x327, 0x328, 0x31B, 0x309, 0x340, 0x212B, 0x1EA5, 0xE2, 0x1B0, 0x1100, 0x1161, 0x11A8, 0xAC00, 0xAC01, 0x3B1, 0x313, 0x342, 0x345, 0x1F00, 0x915, 0x93C, 0x958, 0x304B, 0x3099, 0x20]
    texts = ["".join(chr(r.choice(pool)) for _ in range(r.randint(1, 5))) for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", tx.not_composed(F.col("x")).alias("b")).collect()
    assert [x for x, b in rows if b != (unicodedata.normalize("NFC", x) != x)] == []


def test_fold_beyond_latin(spark):
    texts = ["ἄᾀ", "Ậ", "が", "Å", "đ"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "x string").select(tx.fold(F.col("x"))).collect()]
    assert got == ["".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn").lower() for x in texts]


def governed(spark, evidence):
    rows = spark.createDataFrame([("1", "n", evidence)], "k string, name string, evidence array<struct<id:string,url:string>>")
    meta = spark.createDataFrame([("master", "2024-07-01")], "format string, snapshot string")
    out = validators.governance(rows, meta, F.col("k"), {"name": F.col("name"), "evidence": F.col("evidence")}, F.col("evidence"), ["id"], ["url"], F.lit(False), F.lit(""), ["x"], F.lit(False), F.lit(""), ["master"])
    return sorted((r["code"], r["message"]) for r in out.collect())


def test_governance_of_empty_lists(spark):
    assert governed(spark, [("a", "u")]) == []
    assert governed(spark, []) == [("MISSING_FIELD", "evidence")]
    assert governed(spark, None) == [("BAD_EVIDENCE", "no list of evidence"), ("MISSING_FIELD", "evidence")]


def guided(spark, fee, sources, provenance):
    rows = spark.createDataFrame([("1.000001", "verified", fee, sources, provenance)], "k string, status string, fee array<string>, sources array<struct<id:string,role:string,url:string>>, prov map<string,array<string>>")
    out = validators.guidance(rows, F.col("k"), r"^\d\.\d{6}$", F.col("status"), ["verified"], {"fee": F.col("fee")}, F.col("sources"), F.col("prov"), ["law"], ["gov.vn"], {})
    return sorted((r["code"], r["message"]) for r in out.collect())


def test_guidance_of_empty_lists_and_null_references(spark):
    source = ("a", "law", "https://x.gov.vn/1")
    assert guided(spark, ["f"], [source], {"fee": ["a"]}) == []
    assert guided(spark, [], [], None) == []
    assert guided(spark, ["f"], [], {}) == [("FIELD_WITHOUT_SOURCE", "fee"), ("NO_SOURCES", "no sources")]
    assert guided(spark, ["f"], [source], {"fee": [None]}) == [("UNKNOWN_SOURCE", "fee:")]
    assert guided(spark, ["f"], [("", "law", "https://x.gov.vn/1"), source], {"fee": [""]}) == [("SOURCE_WITHOUT_ID", "0"), ("UNKNOWN_SOURCE", "fee:")]
