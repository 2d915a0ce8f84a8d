"""Queries for functions on texts: the texts are made from the columns of a table, so the SQL can say what must be found."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import catalogue
from .functions import evidence as ev
from .functions import text as tx
from .queries import query


def _code(k: str):
    return F.concat(F.lit("1."), F.lpad(F.col(k).cast("string"), 6, "0"))


@query("SELECT o_orderkey, '1.' || lpad(o_orderkey::VARCHAR, 6, '0') AS code, CASE WHEN o_orderkey % 2 = 0 THEN '2.' || rpad(o_orderstatus, 6, '0') ELSE o_orderstatus END AS padded FROM orders")
def code_forms(t):
    text = F.concat(F.lit("Item "), _code("o_orderkey"), F.lit(" and 3.141592"))
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" 2."), F.col("o_orderstatus"))).otherwise(F.col("o_orderstatus"))
    return t("orders").select("o_orderkey", tx.code_norm(text).alias("code"), tx.pad_code(raw).alias("padded"))


@query("SELECT o_orderkey, 'name of ' || chr(233) || ' ' || o_orderstatus AS name FROM orders")
def names_from_snippets(t):
    """A decomposed accent in the name must not move the cut."""
    snippet = F.concat(_code("o_orderkey"), F.lit(" - name of e\u0301 "), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 2 == 0, " Thời hạn: 3 ngày").otherwise(" - 5 ngày, 2.000001 more"))
    return t("orders").select("o_orderkey", tx.name_from_snippet(snippet, _code("o_orderkey"), ["thoi han"], catalogue.DURATION_WITH_NUMBER).alias("name"))


@query("""
SELECT l_orderkey, l_linenumber, l_linenumber || ' ngày' AS value, CASE WHEN l_linenumber = 1 THEN 'medium' ELSE 'high' END AS confidence, true AS plain, l_linenumber <> 2 AS single FROM lineitem
""")
def duration_forms(t):
    n = F.col("l_linenumber").cast("string")
    far = F.when(F.col("l_linenumber") == 1, F.repeat(F.lit("x "), 150)).otherwise("in ")
    found = tx.duration_candidate(F.concat(far, n, F.lit(" ngày, then 9 tháng")), catalogue.DURATION_WITH_NUMBER)
    plain = tx.unambiguous_duration(F.concat(n, F.lit(" ngày.")), catalogue.DURATION_WITH_NUMBER)
    single = tx.unambiguous_duration(F.concat(n, F.when(F.col("l_linenumber") == 2, " ngày 3 tháng").otherwise(" ngày")), catalogue.DURATION_WITH_NUMBER)
    return t("lineitem").select("l_orderkey", "l_linenumber", found.alias("d"), plain.alias("plain"), single.alias("single")).select("l_orderkey", "l_linenumber", "d.*", "plain", "single")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FULL' WHEN 'O' THEN 'PARTIAL' END AS level FROM orders")
def online_levels(t):
    mark = lambda s: F.when(F.col("o_orderstatus").isin(s, "P"), "X ").otherwise("- ")
    text = F.concat(mark("F"), F.lit("Toàn trình; "), mark("O"), F.lit("Một phần"))
    return t("orders").select("o_orderkey", tx.marked_level(text, catalogue.ONLINE_LABELS).alias("level"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Lệ phí: ' || (100 + o_custkey % 900) || '.000 đồng' END AS fee, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE (100 + o_custkey % 900) || '.000' END AS amount FROM orders")
def fee_forms(t):
    amount = F.concat((100 + F.col("o_custkey") % 900).cast("string"), F.lit(".000 đồng"))
    text = F.concat(F.lit("Thủ tục; "), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("Lệ phí: "), amount)))
    short = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(amount)
    return t("orders").select("o_orderkey", tx.fee_excerpt(text, ["le phi"]).alias("fee"), F.array_join(tx.money(short, "đồng"), ",").alias("amount"))


@query("SELECT o_orderkey, 'Nghị định số ' || o_custkey || '/2020/NĐ-CP;Luật số 5/2019/QH14;Luật Đất đai ngày ' || (1 + o_orderkey % 28) || ' tháng 11 năm 2013' AS refs FROM orders")
def legal_references(t):
    day = (1 + F.col("o_orderkey") % 28).cast("string")
    text = F.concat(
        F.lit("Luật Hộ tịch số 5/2019/QH14 và Nghị  định số "), F.col("o_custkey").cast("string"), F.lit(" / 2020/nđ-CP, Nghị định "), F.col("o_custkey").cast("string"), F.lit("/2020/NĐ-CP; Luật Đất đai  ngày "), day, F.lit(" tháng 11 năm 2013; Thông tư số 226"),
    )
    return t("orders").select("o_orderkey", F.array_join(catalogue.legal_refs(text), ";").alias("refs"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '2020-03-02' ELSE strftime(o_orderdate::DATE, '%Y-%m-%d') END AS date, CASE o_orderkey % 4 WHEN 0 THEN 'stated' WHEN 1 THEN 'signing' ELSE 'default' END AS basis FROM orders")
def effective_dates(t):
    text = F.when(F.col("o_orderkey") % 4 == 0, "Có hiệu lực thi hành kể từ ngày 2/3/2020").when(F.col("o_orderkey") % 4 == 1, "có hiệu lực từ ngày ký").otherwise("")
    return t("orders").select("o_orderkey", catalogue.effective_date(text, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d")).select("o_orderkey", "d.*")


@query("SELECT o_orderkey, o_custkey || '/QĐ-UBND' AS number, CASE WHEN o_orderkey % 2 = 0 THEN '2021-02-01' END AS date FROM orders")
def decision_identities(t):
    k = F.col("o_custkey").cast("string")
    url = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://x.vn/quyet-dinh-so-"), k, F.lit("-qd-ubnd-ngay-1-2-2021.html"))).otherwise("https://x.vn/")
    title = F.concat(F.lit("Quyết định "), k, F.lit("/QD-UBND ngày"))
    return t("orders").select("o_orderkey", catalogue.decision_identity(url, title).alias("d")).select("o_orderkey", "d.*")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Bãi bỏ' WHEN 'O' THEN 'Chưa hiệu lực' ELSE 'Cần xác minh' END AS status FROM orders")
def excluded_statuses(t):
    status = F.when(F.col("o_orderstatus") == "F", "Đã bị BÃI BỎ").otherwise("")
    reason = F.when(F.col("o_orderstatus") == "O", "future_effective").otherwise("?")
    return t("orders").select("o_orderkey", catalogue.excluded_status(status, reason).alias("status"))


@query("SELECT c_custkey, 'part of ' || c_mktsegment AS part, c_name AS value, CASE WHEN c_acctbal < 0 THEN 'next' END AS below FROM customer")
def sections_and_labels(t):
    text = F.concat(F.lit("# All\nfirst\n## Part\n part of "), F.col("c_mktsegment"), F.lit("\n# End\nName: "), F.col("c_name"), F.lit("\nMore:\n\n"), F.when(F.col("c_acctbal") < 0, " next ").otherwise(""))
    return t("customer").select("c_custkey", tx.section(text, "Part").alias("part"), tx.labelled_value(text, "Name").alias("value"), F.nullif(tx.labelled_value(text, "More"), F.lit("")).alias("below"))


@query("SELECT c_custkey, '&lt;b title=&quot;' || c_name || '&quot;&gt;&amp;&#39;' AS escaped, c_acctbal < 0 AS flag FROM customer")
def escapes_and_flags(t):
    return t("customer").select("c_custkey", tx.html_escape(F.concat(F.lit('<b title="'), F.col("c_name"), F.lit("\">&'"))).alias("escaped"), tx.is_true_flag(F.when(F.col("c_acctbal") < 0, " Yes ").otherwise("no")).alias("flag"))


@query("SELECT o_orderkey, '1.' || lpad(o_orderkey::VARCHAR, 6, '0') || ' own part ' AS own, 'x ' || '1.' || lpad(o_orderkey::VARCHAR, 6, '0') || ' ow' AS around FROM orders")
def code_windows(t):
    text = F.concat(F.lit("before x "), _code("o_orderkey"), F.lit(" own part 2.000001 other"))
    return t("orders").select("o_orderkey", tx.until_next_code(text, _code("o_orderkey")).alias("own"), tx.window_around(text, _code("o_orderkey"), 2, 3).alias("around"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'e1' ELSE 'e1,e2' END AS got, CASE WHEN o_orderkey % 3 = 0 THEN 'zz' ELSE '' END AS dangling, CASE WHEN o_orderstatus = 'P' THEN 'given' WHEN o_orderkey % 2 = 0 THEN 'law' ELSE 'other' END AS role FROM orders
""")
def evidence_references(t):
    e = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(r).alias("role")) for i, r in (("e1", "law"), ("e2", "law"), ("e3", "local"))])
    ids = F.create_map(*[F.lit(x) for x in ("s1", "e1", "s3", "e3")])
    refs = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("s1"), F.lit("s1"), F.lit("s3"))).otherwise(F.array(F.lit("s3"), F.lit("s9")))
    held = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("e1"), F.lit("zz"))).otherwise(F.array(F.lit("e1")))
    host = F.when(F.col("o_orderkey") % 2 == 0, "www.law.example").otherwise("outlaw.example")
    role = ev.infer_role(F.when(F.col("o_orderstatus") == "P", "given"), host, [("law.example", "law")], "other")
    return t("orders").select("o_orderkey", F.array_join(ev.resolve_refs(refs, ids, e, "law"), ",").alias("got"), F.array_join(ev.dangling(held, F.array(F.lit("e1"), F.lit("e2"))), ",").alias("dangling"), role.alias("role"))


@query(r"""
SELECT n_regionkey, sha1(string_agg(n_name || chr(0) || blob || chr(10), '' ORDER BY n_name || chr(0) || blob)) AS bundle FROM (SELECT n_regionkey, n_name, sha1('blob ' || (length(n_name) + 1) || chr(0) || n_name || chr(10)) AS blob FROM nation) GROUP BY 1
""")
def bundle_fingerprints(t):
    blob = ev.git_blob_sha1(F.encode(F.concat("n_name", F.lit("\r\n")), "UTF-8"))
    return t("nation").select("n_regionkey", "n_name", blob.alias("blob")).groupBy("n_regionkey").agg(ev.bundle_fingerprint(F.col("n_name"), F.col("blob")).alias("bundle"))


@query("SELECT page_id, 'composed ' || chr(233) AS n FROM pages")
def composed(t):
    return t("pages").select("page_id", tx.nfc(F.when(F.col("page_id") % 2 == 0, "composed \u00e9").otherwise("composed e\u0301")).alias("n"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN '' ELSE o_custkey || '/QĐ-UBND' END AS number, CASE o_orderkey % 4 WHEN 0 THEN '2021-02-01' WHEN 1 THEN '2022-05-' || lpad((1 + o_orderkey % 28)::VARCHAR, 2, '0') ELSE '' END AS date,
  CASE o_orderkey % 5 WHEN 0 THEN 'ĐẤT ĐAI ' || o_custkey WHEN 1 THEN 'Y TẾ' ELSE '' END AS field FROM orders
""")
def decisions_of_titles(t):
    k, m, f = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 4, F.col("o_orderkey") % 5
    url = F.when(m == 0, F.concat(F.lit("https://x.vn/quyet-dinh-so-"), k, F.lit("-QD-UBND-ngay-1-2-2021.html"))).otherwise("https://x.vn/")
    head = F.when(m == 1, F.concat(F.lit("QUYẾT ĐỊNH số: "), k, F.lit(" /QD-UBND ngày "), (1 + F.col("o_orderkey") % 28).cast("string"), F.lit(" /5-2022"))).when(m == 2, F.concat(F.lit("Quyết định "), k, F.lit("/QĐ-UBND")))
    tail = F.when(f == 0, F.concat(F.lit(" Lĩnh vực  đất đai "), k, F.lit("; thuộc phạm vi"))).when(f == 1, " lĩnh vực y tế do Sở").when(f == 2, " lĩnh vực x của Sở").otherwise("")
    title = F.concat(F.coalesce(head, F.lit("")), tail)
    return t("orders").select("o_orderkey", catalogue.decision_of(url, title).alias("d"), catalogue.field_of_title(title).alias("field")).select("o_orderkey", "d.*", "field")


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Lệ phí: 5.000 đồng' WHEN 1 THEN 'KHÔNG THU PHÍ, Phí: 1' WHEN 2 THEN 'phí: x' END AS value, CASE o_orderkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' END AS confidence,
  CASE o_orderkey % 4 WHEN 0 THEN 'lệ phí:' WHEN 1 THEN 'không thu phí' WHEN 2 THEN 'phí:' END AS marker FROM orders
""")
def fee_candidates(t):
    m = F.col("o_orderkey") % 4
    far = lambda n: F.repeat(F.lit("x"), F.lit(n))
    text = F.when(m == 0, F.concat(far(400), F.lit("Lệ phí:  5.000 đồng"))).when(m == 1, "a KHÔNG THU PHÍ, Phí: 1").when(m == 2, F.concat(far(500), F.lit("phí: x"))).otherwise(F.concat(far(750), F.lit("phí: x")))
    return t("orders").select("o_orderkey", F.inline_outer(F.array_compact(F.array(catalogue.fee_candidate(text)))))


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '5.000 đồng;' || (100 + c_nationkey) || ' 000 ĐỒNG' WHEN 1 THEN '' WHEN 2 THEN '' ELSE '10.000 đồng' END AS fees, CASE c_custkey % 4 WHEN 1 THEN 'NOT_PUBLISHED' WHEN 2 THEN 'EXEMPT' ELSE 'UNKNOWN' END AS fee_status,
  CASE c_custkey % 3 WHEN 0 THEN 'Ủy ban nhân dân cấp xã;Trung tâm PVHCC thành phố' WHEN 1 THEN 'UBND cấp xã' ELSE '' END AS agencies, c_custkey % 3 = 2 AND c_nationkey > 4 AS override,
  CASE WHEN c_nationkey < 9 THEN 'UBND thành phố Hải Phòng' ELSE '' END AS publisher, CASE WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_nationkey < 9 THEN '1/QĐ-UBND' ELSE '2/QĐ-BTP' END ELSE '' END AS ended_by FROM customer
""")
def free_guidance(t):
    m, a, n = F.col("c_custkey") % 4, F.col("c_custkey") % 3, F.col("c_nationkey")
    fees = F.when(m == 0, F.concat(F.lit("nộp 5.000  đồng, 5.000 đồng hoặc "), (100 + n).cast("string"), F.lit(" 000 ĐỒNG"))).when(m == 1, "Không quy định").when(m == 2, "Miễn  lệ phí").otherwise("10.000 đồng; không quy định")
    body = F.when(a == 0, "trung tâm pvhcc thành phố; ỦY BAN NHÂN DÂN CẤP XÃ").when(a == 1, "UBND cấp xã, UBND cấp huyện").otherwise("Ủy ban nhân dân huyện")
    g = catalogue.guidance_of(F.concat_ws(" ", fees, body))
    decision = F.when(n < 9, "1/QĐ-UBND").otherwise("2/QĐ-BTP")
    derived = catalogue.derived_columns(decision, F.when(F.col("c_mktsegment") == "BUILDING", "Bãi bỏ").otherwise("Còn hiệu lực"))
    return t("customer").select("c_custkey", F.array_join(g["fees"], ";").alias("fees"), g["fee_status"].alias("fee_status"), F.array_join(g["agencies"], ";").alias("agencies"), catalogue.needs_local_agency(body, F.when(n > 4, True)).alias("override"), *[c.alias(k) for k, c in derived.items()])
