"""Rules of the curation operators on small literal tables."""

import difflib
import hashlib

from pyspark.sql import functions as F

from regloom.functions import catalogue
from regloom.functions import evidence as ev
from regloom.functions import text as tx
from regloom.functions import urls
from regloom.operators import classify, diff, expect, gates, lines, readmodel, reconcile, replay, resolve, runs, search
from regloom.plans import curation
from regloom.sources import tables, web
from regloom.streaming import streams


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_fold_keeps_barred_d(spark):
    assert one(spark, tx.fold(F.lit("Sửa ĐỔI"))) == "sua đoi"
    assert one(spark, tx.fold_d(F.lit(" Đất đai "))) == "dat dai"


def test_codes(spark):
    assert one(spark, tx.codes(F.lit("1.00488 and 12.345678, 3.12"))) == ["1.00488", "12.345678"]
    assert one(spark, tx.code_norm(F.lit(" none "))) == "none"
    assert one(spark, tx.pad_code(F.lit("1.0048"))) == "1.004800"


def test_first_filled(spark):
    assert one(spark, tx.first_filled(F.lit(None), F.lit("  "), F.lit(" b "))) == "b"
    assert one(spark, tx.is_true_flag(F.lit("Có"))) is True


def test_name_and_durations(spark):
    n = tx.name_from_snippet(F.lit("1.00488 Issue a permit 15 days at the office"), F.lit("1.00488"), ["at the office"], r"\d+ days")
    assert one(spark, n) == "Issue a permit"
    assert one(spark, tx.unambiguous_duration(F.lit("15 days."), r"\d+ days")) is True
    assert one(spark, tx.unambiguous_duration(F.lit("15 days or 3 days"), r"\d+ days")) is False
    got = one(spark, tx.duration_candidate(F.lit("x" * 300 + " 15 days"), r"\d+ days"))
    assert (got["value"], got["confidence"]) == ("15 days", "medium")
    assert one(spark, tx.duration_tokens(F.lit("within 8 hours; from 7 hours 30"), r"\d+ hours(?: \d+)?", r"hours \d+")) == ["8 hours"]


def test_level_fee_and_references(spark):
    labels = {"full": "whole service", "part": "partial service"}
    assert one(spark, tx.marked_level(F.lit("x whole service, partial service"), labels)) == "full"
    assert one(spark, tx.marked_level(F.lit("x whole service, x partial service"), labels)) is None
    assert one(spark, tx.safe_fee(F.lit("No fee."), ["no fee", "not stated"])) == "no fee"
    assert one(spark, tx.safe_fee(F.lit("no fee until 10"), ["no fee"])) is None
    kinds = [(r"Decree (\d+ ?/ ?\d+)", "Decree {1}"), (r"Circular (\d+/\d+)", "Circular {1}")]
    assert one(spark, tx.legal_refs(F.lit("Circular 3/2020, Decree 15 / 2021, Decree 15/2021"), kinds)) == ["Decree 15/2021", "Circular 3/2020"]


def test_dates_and_sections(spark):
    d = tx.effective_date(F.lit("takes effect from 1/2/2024"), [r"from (\d{1,2})/(\d{1,2})/(\d{4})"], "signing", F.lit("2024-01-05"))
    assert tuple(one(spark, d)) == ("2024-02-01", "stated")
    d = tx.effective_date(F.lit("silent"), [r"from (\d{1,2})/(\d{1,2})/(\d{4})"], "signing", F.lit("2024-01-05"))
    assert tuple(one(spark, d)) == ("2024-01-05", "default")
    assert one(spark, tx.dmy(F.lit("2024-02-01T00"))) == "01/02/2024"
    assert one(spark, tx.section(F.lit("# A\none\n## B\ntwo\n# C"), "B")) == "two"
    assert one(spark, tx.labelled_value(F.lit("Fee:\n\n 5 \nTime: 3 days"), "Fee")) == "5"
    assert one(spark, tx.labelled_value(F.lit("Fee:\n\n 5 \nTime: 3 days"), "Time")) == "3 days"


def test_similarity(spark):
    assert one(spark, tx.similarity(F.lit("Issue permit"), F.lit("issue permits"))) == round(difflib.SequenceMatcher(None, "issue permit", "issue permits").ratio(), 3)
    assert one(spark, tx.similarity(F.lit(""), F.lit("a"))) is None
    assert one(spark, tx.nfc(F.lit("é"))) == "é"


def test_urls(spark):
    assert one(spark, urls.official(F.lit("https://a.gov.vn/x"), ["gov.vn"])) is True
    assert one(spark, urls.official(F.lit("https://a.gov.vn.evil.com/x"), ["gov.vn"])) is False
    r = lambda u, level="Xã": tuple(one(spark, urls.scoped_route(F.lit(u), F.lit(level), "g.vn", "31", "11824")))
    ward = "https://g.vn/x?provinceCode=31&wardCode=11824&commune=WARD&isProvince=0"
    assert [r(ward), r("https://g.vn/?provinceCode=31&isProvince=1", "Cấp tỉnh - x"), r(ward.replace("Code=31", "Code=&provinceCode=31"))] == [(True, "ward"), (True, "province"), (True, "ward")]
    bad = [("https://[::1", "Xã"), (ward.replace("https", "http"), "Xã"), (ward.replace("g.vn", "a.g.vn"), "Xã"), (ward.replace("=31", "=1"), "Xã"), (ward.replace("=11824", ""), "Xã"), (ward.replace("WARD", "X"), "Xã"), (ward.replace("isProvince=0", ""), None), (ward, "cấp tỉnh"), (ward.replace("e=0", "e=1"), "Cấp tỉnh"), (None, "Xã"), ("https://g.vn/#?provinceCode=31", "Xã")]
    assert [r(u, level)[1] for u, level in bad] == ["invalid_url", "invalid_host", "invalid_host", "wrong_province", "wrong_ward", "wrong_commune", "ward_wrong_isProvince", "province_missing_isProvince", "province_forced_to_ward", "invalid_host", "wrong_province"]
    u = urls.submission_url("https://g/x", {"a": "1"}, F.lit("city"), {"city": {"s": "c"}, "ward": {"s": "w"}}, "id", F.lit(""), "q", F.lit("a b"))
    assert one(spark, u) == "https://g/x?a=1&s=c&q=a+b"


def test_evidence_ids(spark):
    got = one(spark, ev.evidence_id({"b": F.lit(None).cast("string"), "a": F.lit("x")}))
    assert got == "ev_" + hashlib.sha1(b'{"a":"x","b":null}').hexdigest()[:24]
    want = hashlib.sha1(b"blob 4\0a\nb\n").hexdigest()
    assert one(spark, ev.git_blob_sha1(F.lit(bytearray(b"a\r\nb\n")))) == want == one(spark, ev.git_blob_sha1(F.lit(bytearray(b"a\nb\n"))))


def test_evidence_arrays(spark):
    e = spark.sql("SELECT array(named_struct('id','1','role','legal','repeal',false,'date','2024-01-01'), named_struct('id','2','role','exec','repeal',false,'date','2024-03-01'), named_struct('id','1','role','legal','repeal',true,'date','2024-05-01')) AS e, map('s1','1','s2','2') AS m")
    r = e.select(
        F.size(ev.first_by_id(F.col("e"))).alias("n"), ev.effective_from(F.col("e"), "legal").alias("d"),
        ev.resolve_refs(F.array(F.lit("s1"), F.lit("s2")), F.col("m"), F.col("e"), "legal").alias("r"), ev.dangling(F.array(F.lit("1"), F.lit("9")), F.transform("e", lambda x: x["id"])).alias("x"),
    ).first()
    assert (r["n"], r["d"], r["r"], r["x"]) == (2, "2024-01-01", ["1"], ["9"])


def test_evidence_status(spark):
    df = spark.createDataFrame([("a", "2024-01-01", False), ("b", "2024-01-01", False), ("b", "2024-01-01", True), ("c", "2024-02-01", False), ("c", "2024-01-01", True), ("d", "", False)], "k string, d string, r boolean")
    assert rows(resolve.evidence_status(df, "k", F.col("d"), F.col("r")), "k", "status") == [("a", "active"), ("b", "repealed"), ("c", "active"), ("d", "needs_verification")]


def test_ties_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(k, p, f"v{p}") for k in range(5) for p in range(20)], "k int, pos int, v string")
    order = [F.col("pos").desc()]
    a = rows(resolve.latest_by(df.repartition(7), ["k"], order), "k", "v")
    assert a == rows(resolve.latest_by(df.orderBy("v").coalesce(1), ["k"], order), "k", "v") == [(k, "v19") for k in range(5)]


def test_merge_rows(spark):
    df = spark.createDataFrame([("k", 1, "current", False, "short", "a"), ("k", 2, "repealed", True, "a longer name", "b"), ("k", 3, "repealed", False, "x" * 300, "")], "k string, pos int, s string, f boolean, n string, c string")
    assert rows(resolve.merge_rows(df, ["k"], "pos", "s", ["repealed", "current"], "f", "n", "c"), "k", "s", "f", "n", "c") == [("k", "repealed", True, "a longer name", "a | b")]


def test_gate_buckets(spark):
    c = spark.createDataFrame([("a", "full", False), ("a", "full", False), ("b", "full", False), ("b", "part", False), ("c", "full", False), ("d", "full", True), ("e", "full", False), ("f", "part", False)], "k string, v string, bad boolean")
    m = spark.createDataFrame([("a", ""), ("b", ""), ("d", ""), ("e", "full"), ("f", "full")], "k string, cur string")
    got = rows(gates.gate(c, m, "k", F.col("v"), F.col("cur"), F.col("bad")), "k", "bucket", "reason")
    assert got == [("a", "ready", "blank"), ("b", "needsReview", "disagreement"), ("c", "pendingCanonicalPhase2", "no_record"), ("d", "needsReview", "unsafe"), ("e", "confirmedExisting", "equal"), ("f", "needsReview", "conflict")]


def test_fill_never_overwrites(spark):
    a = spark.createDataFrame([(1, ""), (2, "x"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "n"), (2, "n")], "k int, v string")
    assert rows(resolve.fill(a, ["k"], b, ["v"]), "k", "v")[:2] == [(1, "n"), (2, "x")]
    assert rows(resolve.override(a.where("k < 3"), ["k"], b, ["v"]), "k", "v", "changed") == [(1, "n", True), (2, "n", True)]


def test_lines(spark):
    df = spark.createDataFrame([("d", 1, "A head\n1. 1.00488\n9 name one\n2. 2.000111 two")], "d string, p int, t string")
    ls = lines.document_lines(df, "d", "p", "t")
    assert ls.count() == 4
    fixed = lines.split_token_repair(ls, ["d", "p"], [F.col("line_no")], "line", r"\d\.\d{5}", r"\d\s")
    assert [r[0] for r in fixed.orderBy("line_no").select("line").collect()] == ["A head", "1. 1.004889 ", "name one", "2. 2.000111 two"]
    marker = lines.last_marker_before(F.lit("xx PROVINCE yy WARD zz CODE"), F.lit(24), {"PROVINCE": "p", "WARD": "w"})
    assert one(spark, marker) == "w"


def test_snapshot_delta(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, None), (4, "n")], "k int, v string")
    assert rows(diff.snapshot_delta(a, b, "k", ["v"]), "k", "change") == [(1, "changed"), (3, "removed"), (4, "added")]
    assert diff.changed(a, b) and not diff.changed(a, a.repartition(3))


def test_replay(spark):
    e = [("a", 1, "current"), ("b", 1, "current"), ("b", 2, "repealed"), ("c", 1, "repealed"), ("c", 2, "current"), ("d", 1, "review"), ("e", 1, "current"), ("e", 2, "future"), ("f", 1, "future")]
    df = spark.createDataFrame(e, "k string, t int, kind string").repartition(5)
    got = rows(replay.replay(df, "k", ["t"], F.col("kind")), "k", "state")
    assert got == [("a", "current"), ("b", "repealed"), ("c", "current"), ("d", "unknown"), ("e", "current"), ("f", "future_effective")]


def test_event_state(spark):
    s = lambda st, eff, field: one(spark, replay.event_state(F.lit(st), F.lit(eff), F.lit("2024-06-01"), F.lit(field), ["needs_text"]))
    assert [s("applied", "2024-01-01", ""), s("x", "2024-07-01", "f"), s("needs_text", "2024-01-01", "f"), s("x", "2024-01-01", "")] == ["current", "future_effective", "needs_text", "needs_field_review"]


def test_upsert_holds_and_keeps_manual(spark):
    e = spark.createDataFrame([("a", "old", "ok", ""), ("b", "old", "ok", "mine")], "k string, auto string, status string, note string")
    p = spark.createDataFrame([("a", "new", "ok", "proj"), ("c", "new", "ok", "proj")], "k string, auto string, status string, note string")
    got = readmodel.upsert(e, p, "k", ["auto", "status"], ["note"], "status", "held", "[gone]", "note")
    assert rows(got, "k", "auto", "status", "note", "action") == [("a", "new", "ok", "", "update"), ("b", "old", "held", "mine [gone]", "hold"), ("c", "new", "ok", "proj", "insert")]
    again = readmodel.upsert(got.select("k", "auto", "status", "note"), p, "k", ["auto", "status"], ["note"], "status", "held", "[gone]", "note")
    assert rows(again.where("k = 'b'"), "note") == [("mine [gone]",)]


def test_findings(spark):
    df = spark.createDataFrame([(1, ""), (2, "x"), (3, None)], "k int, v string")
    assert rows(expect.findings(df, "k", expect.missing(["v"])), "code", "key") == [("MISSING_FIELD", "1"), ("MISSING_FIELD", "3")]


def test_buckets(spark):
    m = spark.createDataFrame([("a", "city"), ("b", "ward"), ("c", "")], "k string, label string")
    h = spark.createDataFrame([("a", "ward", 1), ("a", "city", 2)], "k string, hint string, t int")
    t = spark.createDataFrame([("c", "ward"), ("c", "city")], "k string, level string")
    r = reconcile.levels(m, "k", h, t, "label", ["ward"], [F.col("t").desc()])
    assert rows(r, "k", "level_source", "in_scope", "ambiguous") == [("a", "hint", False, False), ("b", "label", True, False), ("c", "none", False, True)]
    assert tuple(reconcile.buckets(r, "k", 3).first()) == (1, 2, 0, 1, 2, -2)


def test_guard(spark):
    log = spark.sql("SELECT timestamp'2024-01-02 01:00:00' AS ts, 'success' AS s")
    g = lambda now, paused=False: runs.guard(log, "ts", F.col("s"), F.lit(now).cast("timestamp"), F.lit(paused), 6, 12, "Asia/Ho_Chi_Minh").first()[0]
    assert [g("2024-01-02 02:00:00", True), g("2024-01-02 12:00:00"), g("2024-01-02 02:00:00"), g("2024-01-03 02:00:00")] == ["PAUSED", "OUTSIDE_WINDOW", "ALREADY_SUCCEEDED", "READY"]


def test_classifiers(spark):
    assert one(spark, classify.by_markers(F.lit("Công bố nội bộ"), [("internal", ["noi bo"]), ("public", ["cong bo"])], "review")) == "internal"
    assert one(spark, classify.change_type(F.lit("modified"), F.lit("sau cắt giảm"), "sau cat giam", "khong thuc hien cat giam")) == "reduced"


def test_html(spark):
    df = spark.createDataFrame([(1, "<p>a<script>x</script> b</p><table><tr><th>Name</th><th>Days</th></tr><tr><td>n1</td><td>3</td></tr></table>")], "k int, h string")
    b = web.blocks(df, "k", "h")
    assert b.first()["body"].startswith("a b")
    assert rows(web.table_rows(b, "k", "tables", {"name": "name", "days": "days"}), "k", "name", "days") == [(1, "n1", "3")]


def test_discover(spark):
    index = spark.createDataFrame([("s", "u1", "public"), ("s", "u2", "needs_review")], "src string, url string, classification string")
    links = spark.createDataFrame([("s", "u1"), ("s", "u2"), ("s", "u3"), ("t", "u4"), ("t", "u4")], "src string, url string")
    assert rows(streams.discover(index, links, "src", "url"), "url", "action") == [("u1", "known"), ("u2", "retry"), ("u3", "new"), ("u4", "baseline")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, as_of string")
    p = f"file://{tmp_path}/t"
    assert tables.write_if_changed(df, p, ["as_of"]) and not tables.write_if_changed(df.withColumn("as_of", F.lit("z")), p, ["as_of"])
    assert tables.write_if_changed(df.where("k = 1"), p, ["as_of"])
    store = spark.createDataFrame([("f", "1" * 64)], "k string, sha256 string")
    new = spark.createDataFrame([("f", "1" * 64), ("f", "2" * 64), ("g", "3" * 64)], "k string, sha256 string")
    assert rows(tables.store_evidence(store, new, "k"), "name") == [("f-222222222222",), ("g",)]
    (tmp_path / "l.js").write_text('x\n{ code:"1.1", name:"a \\"b\\"", flag:true },\nend\n{ code:"2.2" }\n')
    assert rows(tables.literal_rows(spark, f"file://{tmp_path}/l.js", ["code", "name"], ["flag"], "^end"), "code", "name", "flag") == [("1.1", 'a "b"', True)]


def test_ordinal_and_page(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    got = search.ordinal(df, [F.col("v"), F.col("id")], "id", parts=5)
    want = {i: n + 1 for n, (v, i) in enumerate(sorted((i % 7, i) for i in range(100)))}
    assert {r["id"]: r["ordinal"] for r in got.collect()} == want
    assert [r[0] for r in search.page(df, [F.col("id")], 2, 3).select("id").collect()] == [3, 4, 5]


def test_catalogue_presets(spark):
    from regloom.functions import catalogue as c

    assert one(spark, c.online_level(F.lit("x Toàn trình, Một phần"))) == "FULL"
    assert one(spark, c.safe_fee(F.lit("Không  thu phí"))) == "Không thu phí" and one(spark, c.safe_fee(F.lit("8.000 đồng"))) is None
    assert one(spark, c.legal_refs(F.lit("Thông tư số 02 / 2020/TT-BTP; Nghị định 123/ 2015/NĐ-CP"))) == ["Nghị định số 123/2015/NĐ-CP", "Thông tư số 02/2020/TT-BTP"]
    refs = lambda x: one(spark, c.legal_refs(F.lit(x)))
    assert refs("Nghị định số 280 /2025/NĐ-CP; Thông tư số 01/2020/TT-BTP; Quyết định số 320/QĐ- BNV") == ["Nghị định số 280/2025/NĐ-CP", "Thông tư số 01/2020/TT-BTP", "Quyết định số 320/QĐ-BNV"]
    assert refs("Luật Đất đai số 31/2024/QH15 ngày trường hợp chuyển nhượng") == ["Luật số 31/2024/QH15"]
    assert refs("luật  hộ tịch ngày 20 tháng 11 năm 2014. Luật Nhà ở ngày 5/6/2023; luật 3/2020/QH 14") == ["Luật số 3/2020/QH14", "luật hộ tịch ngày 20 tháng 11 năm 2014", "Luật Nhà ở ngày 5/6/2023"]
    assert [refs(x) for x in ("Nghị định số 28", "Thông tư số 226", "Luật việc làm ngày 16 thá", "Nghị định số 151/2026/NĐ - C", "")] == [[]] * 5
    assert tuple(one(spark, c.effective_date(F.lit("Quyết định này có hiệu lực kể từ ngày 01/3/2024"), F.lit("2024-02-20")))) == ("2024-03-01", "stated")
    assert tuple(one(spark, c.effective_date(F.lit("có hiệu lực kể từ ngày ký"), F.lit("2024-02-20")))) == ("2024-02-20", "signing")
    assert tuple(one(spark, c.decision_identity(F.lit("/quyet-dinh-so-12-qd-ubnd-ngay-3-4-2024"), F.lit("")))) == ("12/QĐ-UBND", "2024-04-03")
    assert one(spark, c.category(F.lit("ĐẤT ĐAI"), F.lit(""))) == "Tài nguyên & Xây dựng" and one(spark, c.category(F.lit(""), F.lit("khác"))) == "UBND xã"
    assert one(spark, c.excluded_status(F.lit(""), F.lit("Bãi bỏ theo"))) == "Bãi bỏ"
    assert one(spark, c.name(F.lit("1.00488 Cấp giấy phép xây dựng 15 ngày làm việc"), F.lit("1.00488"))) == "Cấp giấy phép xây dựng"


def test_legal_gate(spark):
    whole, other, torn = "Nghị định số 280/2025/NĐ-CP", "Thông tư số 01/2020/TT-BTP", "Thông tư số 226"
    rows_ = [("1", [whole, torn], "medium"), ("2", [whole], "high"), ("2", [other], "medium"), ("3", [whole, other], "high"), ("4", [whole], "high"), ("5", [whole], "low"), ("6", [" "], "high"), ("7", [], "high"), ("8", None, "high"), ("9", [whole], "medium"), (" ", [whole], "high"), (None, [whole], "high")]
    cand = spark.createDataFrame(rows_, "key string, raw array<string>, sure string").where("key <> ' ' OR key IS NULL")
    known = spark.createDataFrame([("1", None), ("2", []), ("3", [f"theo {other} và {whole}"]), ("4", [other]), ("9", ["văn bản khác"])], "key string, cur array<string>")
    out = gates.set_gate(cand, known, "key", F.col("raw"), F.col("sure"), F.col("cur"), catalogue.legal_refs)
    got = {r["key"]: (r["value"], r["bucket"], r["reason"]) for r in out.collect()}
    review, torn_ = "needsReview", "incomplete_or_ocr_truncated_legal_reference"
    assert got == {"1": ([whole], review, torn_), "2": ([whole, other], "ready", "blank"), "3": ([whole, other], "confirmedExisting", "equal"), "4": ([whole], review, "conflicts_with_canonical"), "6": ([], review, torn_), "7": ([], review, torn_), "9": ([whole], review, "conflicts_with_canonical")}


def test_agency_and_single_values(spark):
    body, place = "Ủy ban nhân dân cấp xã", "Trung tâm Phục vụ hành chính công thành phố"
    cases = [
        ([place], [f"1.000001 Tên thủ tục {place}"], ("insufficient", None, "reception_location_only")),
        ([body], [f"1.000001 Cơ quan A trả lời {body}"], ("insufficient", None, "unlabelled_agency_mention")),
        ([body], [f"Cơ quan thực hiện: {body}"], ("verified", body, None)),
        ([body, place], [], ("conflicting", None, "multiple_agency_mentions")),
        ([" ", None], None, ("insufficient", None, None)),
        ([body, f" {body}"], [None, "", f"CƠ QUAN CÓ THẨM QUYỀN {'x' * 196}{body.upper()}"], ("verified", body, None)),
        ([body], [f"Cơ quan có thẩm quyền {'x' * 197}{body}"], ("insufficient", None, "unlabelled_agency_mention")),
        ([body], None, ("insufficient", None, "unlabelled_agency_mention")),
    ]
    df = spark.createDataFrame([(i, v, s) for i, (v, s, _) in enumerate(cases)], "i int, v array<string>, s array<string>")
    got = df.orderBy("i").select(gates.agency_value(F.col("v"), F.col("s"), catalogue.AGENCY_LABELS, catalogue.RECEPTION_PLACES).alias("x")).collect()
    assert [tuple(r["x"]) for r in got] == [want for _, _, want in cases]
    row = spark.createDataFrame([("1", ["FULL"], ["05 ngày", "03 ngày"], ["Nghị định 01/2026/NĐ-CP", "x"])], "k string, a array<string>, b array<string>, c array<string>")
    out = gates.validated_fields(row, "k", {"level": gates.single_value(F.col("a")), "duration": gates.single_value(F.col("b")), "legal": gates.set_value(F.col("c"))})
    assert out.first()["promotable"] == ["legal", "level"] and out.first()["duration"]["status"] == "conflicting"
    assert rows(gates.field_counts(out, ["level", "duration"]), "field", "verified", "conflicting", "insufficient") == [("duration", 0, 1, 0), ("level", 1, 0, 0)]


def test_promote_keeps_keys_that_hold_the_separator(spark):
    cand = spark.createDataFrame([("a|b", "f", "v"), ("a", "b|f", "w")], "k string, field string, v string")
    known = spark.createDataFrame([("a|b", "f", ""), ("a", "b|f", "x")], "k string, field string, current string")
    got = curation.promote(cand, known, "k", "field", "v", F.lit(False), "4", "5")["gates"]
    assert rows(got, "k", "field", "bucket") == [("a", "b|f", "needsReview"), ("a|b", "f", "ready")]


def test_baseline_rows_merge(spark):
    df = spark.createDataFrame([("k", 1, "ab", "A; B;A", ""), ("k", 2, "ba", "B;C ; ", "n2"), ("k", 3, None, None, "n3"), ("e", 1, None, " ; ", None)], "k string, p int, name string, agencies string, note string")
    assert rows(resolve.merge_baseline(df, ["k"], "p", ["name"], ["agencies"], ["note"]), "k", "name", "agencies", "note") == [("e", "", "", ""), ("k", "ba", "A; B; C", "n2")]


def test_csv_with_a_mark(spark, tmp_path):
    tables.write_csv(spark.createDataFrame([(1, "é")], "k int, v string").coalesce(1), f"{tmp_path}/c", bom=True)
    (part,) = tmp_path.glob("c/part-*")
    assert part.read_bytes() == "﻿k,v\n1,é\n".encode()


def test_write_if_changed_moves_are_checked(spark, tmp_path):
    p = f"{tmp_path}/t"
    one, two = (spark.createDataFrame([(i, "x")], "k int, v string") for i in (1, 2))
    assert tables.write_if_changed(one, p, check=True) and not (tmp_path / "t").exists()
    assert tables.write_if_changed(one, p) and not tables.write_if_changed(one, p, check=True) and tables.write_if_changed(two, p, check=True)
    assert [r["k"] for r in spark.read.parquet(p).collect()] == [1]
    assert tables.write_if_changed(two.withColumn("w", F.lit(1)), p)  # other columns
    assert sorted(spark.read.parquet(p).columns) == ["k", "v", "w"] and [x.name for x in tmp_path.iterdir()] == ["t"]


def test_merge_rows_keeps_the_first_row(spark):
    df = spark.createDataFrame([("k", 2, "s", False, "long name", "c2", 20), ("k", 1, "s", None, "name", "c1", 10), ("k", 3, "s", False, "x" * 300, "", 30)], "k string, p int, s string, f boolean, n string, c string, page int")
    got = resolve.merge_rows(df, ["k"], "p", "s", ["repealed"], "f", "n", "c", first=["page"])
    assert rows(got, "n", "c", "page", "f") == [("long name", "c1 | c2", 10, False)]
    alone = df.where("p = 3")
    assert rows(resolve.merge_rows(alone, ["k"], "p", "s", ["repealed"], "f", "n", "c", first=["page"]), "n", "c") == [("x" * 300, "")]
