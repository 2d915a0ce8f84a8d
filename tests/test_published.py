"""Published records: values of every type as texts, the enriched view, projected columns, promotion and its counters."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from regloom.functions import catalogue, urls
from regloom.operators import enriched, promote, readmodel


def told(spark, schema, value, names=enriched.Items()):
    df = spark.createDataFrame([(value,)], f"x {schema}")
    return df.select(enriched.structured_text(F.col("x"), df.schema["x"].dataType, F.lit("?"), names).alias("t")).first()["t"]


ITEM = "array<struct<channel:string,value:string,name:string,description:string,note:string,status:string>>"


def test_structured_text(spark):
    assert told(spark, "string", None) == "?"
    assert told(spark, "string", "") == "?"
    assert told(spark, "int", 0) == "0"
    assert told(spark, "array<string>", []) == "?"
    assert told(spark, "array<string>", ["a", None, "", "b"]) == "a; b"
    assert told(spark, "array<double>", [1.5]) == "1.5"
    assert told(spark, ITEM, [None, ("online", "5", "n", None, "note", None), (None, None, "n", "d", "note", None)]) == "online: 5 — note; n — d"
    # a value that is blank, not null, hides the next one; only then an unpublished fee is told
    assert told(spark, ITEM, [(None, "", "n", None, None, "not_published")]) == catalogue.FEE_UNPUBLISHED
    assert told(spark, ITEM, [(None, "3", None, None, None, "not_published"), ("desk", None, None, "", "", "x")]) == "3; desk: "
    assert told(spark, "struct<access_url:string,n:int>", ("http://x", 1)) == catalogue.ONLINE_SERVICE
    assert told(spark, "struct<access_url:string,n:int,l:array<string>>", ("", 1, ["z"])) == " · 1"
    assert told(spark, "struct<a:string>", None) == "?"


def test_paper_items(spark):
    df = spark.createDataFrame([([("form", "1", "2", "F"), ("", None, None, ""), None, ("", "", "3", None)],), (None,)], "x array<struct<name:string,original:string,copies:string,form:string>>")
    got = [r["p"] for r in df.select(enriched.paper_items(F.col("x"), df.schema["x"].dataType).alias("p")).collect()]
    assert got == [["form (bản chính: 1, bản sao: 2) Biểu mẫu: F", "(bản sao: 3)"], []]
    plain = spark.createDataFrame([(["a", "", None],)], "x array<string>")
    assert plain.select(enriched.paper_items(F.col("x"), plain.schema["x"].dataType).alias("p")).first()["p"] == ["a"]


def test_encoded(spark):
    text = "a b+c/é'(~)!*-_.%21"
    assert spark.range(1).select(urls.encoded(F.lit(text)).alias("u")).first()["u"] == "a%20b%2Bc%2F%C3%A9'(~)!*-_.%2521"


def test_enriched_on_bare_records(spark):
    """Neither guidance nor most columns: defaults throughout, other columns and repeated rows stay."""
    df = spark.createDataFrame([("k", None, 1), ("k", None, 1), ("m", "Cấp tỉnh", 2)], "key string, level string, more int")
    a, b, c = sorted(enriched.enriched(df).collect(), key=lambda r: r["key"])
    assert a == b and (a["more"], a["level"], a["fee"], a["online"], a["route"]) == (1, catalogue.UNKNOWN, catalogue.UNKNOWN, catalogue.UNKNOWN, "ward")
    assert (a["link"], a["submission_url"], a["papers"], a["steps"], a["verified"], a["has_guidance"]) == (catalogue.PORTAL_HOME, "", [], [], False, False)
    assert c["route"] == "province"
    assert enriched.enriched(df.limit(0)).count() == 0


def test_enriched_prefers_guidance(spark):
    schema = """name string, time string, steps array<string>, verification string, submission_url string, fee_basis array<struct<replaces:boolean,direct:string,basis:string>>,
        guidance struct<time:array<string>,steps:array<string>,submission_url:string,online:struct<access_url:string,status:string>>"""
    rows = [
        ("a", "own", ["1"], None, " ", [(None, "x", "y")], (["g"], [], None, ("http://in", None))),
        ("b", "own", ["1"], "verified_official", "http://own ", None, None),
        ("c", "", None, "other", None, [(False, "x", "y"), (True, "5", "law"), (True, "6", "later")], (None, ["2"], "http://sub", None)),
        ("d", "own", None, None, None, [], (None, None, None, None)),
    ]
    got = {r["name"]: r for r in enriched.enriched(spark.createDataFrame(rows, schema)).collect()}
    assert [got[k]["time"] for k in "abcd"] == ["g", "own", catalogue.UNKNOWN, "own"]
    assert [got[k]["steps"] for k in "abcd"] == [["1"], ["1"], ["2"], []]
    assert [got[k]["submission_url"] for k in "abcd"] == ["http://in", "http://own", "http://sub", ""]
    assert [got[k]["online"] for k in "abcd"] == [catalogue.VERIFIED, catalogue.UNKNOWN, catalogue.UNKNOWN, catalogue.UNKNOWN]
    assert got["c"]["fee"] == "5 (law)" and got["a"]["fee"] == catalogue.UNKNOWN
    assert [(got[k]["verified"], got[k]["has_guidance"]) for k in "abcd"] == [(True, True), (True, False), (True, True), (False, False)]


def test_record_projection(spark):
    df = spark.createDataFrame([("1.1", " t ", None, "9/QĐ-UBND", "x"), (None, "", "f", None, "y")], "code string, title string, field string, decision string, more string")
    p = readmodel.record_projection(df, F.when(F.col("more") == "x", "Hết hiệu lực"), F.lit(None).cast("string"), {"Lĩnh vực": F.lit("")}, ["more"])
    assert tuple(p.columns) == ("more", *catalogue.PROJECTED_COLUMNS) and len(catalogue.PROJECTED_COLUMNS) == 29
    a, b = sorted((r.asDict() for r in p.collect()), key=lambda r: r["more"])
    assert (a["Thủ tục hành chính"], a["Cơ quan công bố"], a["Quyết định/văn bản thay thế, bãi bỏ"], a["Cần đối soát?"]) == ("t", "UBND thành phố Hải Phòng", "9/QĐ-UBND", "Có")
    assert (b["Mã TTHC"], b["Lĩnh vực"], b["Tình trạng hiệu lực"], b["Quyết định/văn bản thay thế, bãi bỏ"], b["Cần đối soát?"]) == ("", "f", "", "", "Có")
    assert None not in a.values() and None not in b.values()
    assert set(catalogue.MANUAL_COLUMNS) <= set(catalogue.PROJECTED_COLUMNS)


SOURCES = "array<struct<articles:array<string>,attachment_url:string,decisions:array<string>>>"


def test_promotion_by_hand(spark):
    """Held against a loop over the items in order, on rows that cover each branch."""
    master = {"a": "", "b": None, "c": "own", "d": " "}
    items = [
        ("ready", "ready", "a", 1, " "), ("ready", "ready", "a", 2, "v2"), ("ready", "ready", "a", 3, ""), ("confirmed", None, "a", 0, "w"),
        ("confirmed", None, "b", 0, "w0"), ("ready", "ready", "b", 9, "v9"), ("ready", "held", "c", 1, "x"), ("confirmed", "any", "c", 1, "x"),
        ("ready", "ready", "z", 1, "x"), ("ready", "ready", None, 1, "x"), ("confirmed", None, "d", 5, None), ("other", "ready", "d", 1, "x"),
    ]
    want = {"ready": 0, "confirmed": 0, "promoted": 0, "skipped": 0, "missing": 0}
    state = dict(master)
    for bucket, status, key, _, value in sorted((i for i in items if i[0] == "confirmed" or i[:2] == ("ready", "ready")), key=lambda i: (i[0] == "confirmed", i[3])):
        want[bucket] += 1
        if key not in state:
            want["missing"] += 1
        elif (state[key] or "").strip():
            want["skipped"] += 1
        elif (value or "").strip():
            state[key] = value.strip()
            want["promoted"] += 1
    m = spark.createDataFrame([Row(k=k, p=p) for k, p in master.items()], "k string, p string").withColumn("ev", F.lit(None).cast(promote.EVIDENCE))
    i = spark.createDataFrame([(*x, [([f"http://{x[4]}"], None, None), (None, "", ["1"])]) for x in items], f"bucket string, status string, k string, pos int, value string, sources {SOURCES}")
    rows, counts = promote.promote(m, "k", "p", i, ["pos"], "ev", "local", "table")
    got = {r["k"]: r for r in rows.collect()}
    assert {k: r["p"] for k, r in got.items()} == state
    assert counts.first().asDict() == want
    assert [e["article_url"] for e in got["a"]["ev"]] == ["http://v2"] and got["a"]["ev"][0]["decisions"] == [] and got["c"]["ev"] is None
    rows, counts = promote.promote(m, "k", "p", i.limit(0), ["pos"])
    assert {r["k"]: r["p"] for r in rows.collect()} == master and counts.first().asDict() == dict.fromkeys(want, 0)


def test_promotion_keeps_few_evidence(spark):
    old = [("r", f"http://{n}", None, [], "k", False) for n in range(8)]
    m = spark.createDataFrame([("a", None, old)], f"k string, p string, ev {promote.EVIDENCE}")
    i = spark.createDataFrame([("ready", "ready", "a", 1, "v", [(["http://new"], None, None)])], f"bucket string, status string, k string, pos int, value string, sources {SOURCES}")
    ev = promote.promote(m, "k", "p", i, ["pos"], "ev", "local", "table")[0].first()["ev"]
    assert [e["article_url"] for e in ev] == ["http://new", *[f"http://{n}" for n in range(7)]]
