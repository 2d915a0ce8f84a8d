"""Queries for published records: the enriched view, all projected columns, promotion with counters; with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions.catalogue import PROJECTED_COLUMNS
from .operators import enriched, promote, readmodel
from .queries import query


def _text(c):
    return F.col(c).cast("string")


@query("""
WITH i AS (SELECT o_custkey AS k, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || ': ' ELSE '' END AS lead,
    CASE o_orderstatus WHEN 'P' THEN o_custkey::VARCHAR WHEN 'O' THEN o_orderkey::VARCHAR ELSE '' END AS main,
    CASE WHEN o_orderkey % 3 = 0 THEN 'note ' || o_orderkey END AS note, o_orderpriority AS paper, o_orderstatus AS s FROM orders),
  w AS (SELECT k, o_orderkey,
    concat_ws(' — ', nullif(lead || CASE WHEN main <> '' THEN main WHEN o_orderkey % 2 = 0 THEN 'Nguồn chính thức không công bố mức thu' ELSE '' END, ''), note) AS fee,
    concat_ws(' ', paper, '(' || nullif(concat_ws(', ', CASE WHEN o_orderkey % 2 = 1 THEN 'bản chính: 1' END, CASE WHEN o_orderkey % 3 = 0 THEN 'bản sao: 2' END), '') || ')', CASE WHEN s = 'P' THEN 'Biểu mẫu: F1' END) AS paper FROM i),
  g AS (SELECT k, coalesce(string_agg(fee, '; ' ORDER BY o_orderkey) FILTER (fee <> ''), '') AS fee, string_agg(paper, '|' ORDER BY o_orderkey) AS papers FROM w GROUP BY 1)
SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN ' Cấp Tỉnh' WHEN 1 THEN 'Cấp xã' ELSE 'Chưa xác minh' END AS level,
  CASE WHEN c_custkey % 9 = 0 THEN c_mktsegment || ' (basis)' WHEN coalesce(g.fee, '') <> '' THEN g.fee WHEN c_acctbal < 0 THEN 'Chưa xác minh' ELSE c_mktsegment END AS fee,
  CASE WHEN g.k IS NOT NULL AND c_nationkey % 4 > 0 THEN 'agency ' || c_nationkey ELSE 'Chưa xác minh' END AS agency,
  CASE WHEN g.k IS NOT NULL AND c_custkey % 5 > 1 THEN 'Đã xác minh · live' WHEN g.k IS NOT NULL AND c_custkey % 5 = 1 THEN 'Đã xác minh' ELSE 'partly' END AS online,
  CASE WHEN c_custkey % 7 = 0 THEN 'https://dichvucong.gov.vn/thu-tuc-hanh-chinh/id%20' || c_custkey ELSE 'https://www.google.com/search?q=%22' || url_encode(c_name) || '%22%20site%3Adichvucong.gov.vn' END AS link,
  CASE WHEN c_custkey % 6 = 0 THEN 'http://own' WHEN g.k IS NOT NULL AND c_custkey % 4 = 0 THEN 'http://given' WHEN g.k IS NOT NULL AND c_custkey % 5 > 0 THEN 'http://access' ELSE '' END AS submission_url,
  coalesce(g.papers, c_mktsegment) AS papers, g.k IS NOT NULL OR c_custkey % 8 = 0 AS verified, g.k IS NOT NULL AS has_guidance, CASE WHEN c_nationkey % 3 = 0 THEN 'province' ELSE 'ward' END AS route
FROM customer LEFT JOIN g ON g.k = c_custkey
""")
def enriched_records(t):
    """Customers as records; their orders are the fees and papers of the guidance."""
    key, s, k, n = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("c_custkey"), F.col("c_nationkey")
    fee = F.struct(
        F.when(s == "F", F.col("o_orderpriority")).otherwise("").alias("channel"), F.when(s == "O", key.cast("string")).when(s == "F", "").alias("value"),
        _text("o_custkey").alias("amount"), F.when(key % 3 == 0, F.concat(F.lit("note "), key)).alias("note"), F.when(key % 2 == 0, "not_published").alias("status"),
    )
    paper = F.struct(F.col("o_orderpriority").alias("name"), F.when(key % 2 == 1, "1").alias("original"), F.when(key % 3 == 0, "2").alias("copies"), F.when(s == "P", "F1").alias("form"))
    items = F.array_sort(F.collect_list(F.struct("o_orderkey", fee.alias("fee"), paper.alias("paper"))))
    g = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(items.alias("i")).select("c_custkey", F.col("i.fee").alias("fees"), F.col("i.paper").alias("given"))
    guidance = F.struct(
        F.col("fees").alias("fee"), F.when(n % 4 > 0, F.concat(F.lit("agency "), n)).otherwise("").alias("agency"), F.col("given").alias("papers"),
        F.when(k % 4 == 0, " http://given ").otherwise("").alias("submission_url"),
        F.when(k % 5 > 0, F.struct(F.lit("http://access").alias("access_url"), F.when(k % 5 > 1, "live").alias("status"))).alias("online"),
    )
    basis = F.array(F.struct(F.lit(False).alias("replaces"), F.lit("x").alias("direct"), F.lit("y").alias("basis")), F.struct((k % 9 == 0).alias("replaces"), F.col("c_mktsegment").alias("direct"), F.lit("basis").alias("basis")))
    own = t("customer").join(g, "c_custkey", "left").select(
        "c_custkey", F.col("c_name").alias("name"), F.when(n % 3 == 0, " Cấp Tỉnh").when(n % 3 == 1, "Cấp xã").alias("level"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("fee"),
        basis.alias("fee_basis"), F.lit("partly").alias("online"), F.when(k % 7 == 0, F.concat(F.lit("id "), k)).alias("formality_id"), F.when(k % 6 == 0, " http://own").alias("submission_url"),
        F.array("c_mktsegment").alias("papers"), F.when(k % 8 == 0, "verified_official").alias("verification"), F.when(F.col("fees").isNotNull(), guidance).alias("guidance"),
    )
    e = enriched.enriched(own)
    return e.select("c_custkey", "level", "fee", "agency", "online", "link", "submission_url", F.array_join("papers", "|").alias("papers"), "verified", "has_guidance", "route")


_DECISION = "o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN '/QĐ-TTg' ELSE '/QĐ-UBND' END"
_PROJECTED = {
    "Mã TTHC": "'1.' || o_orderkey", "Thủ tục hành chính": "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'task ' || o_orderkey END", "Lĩnh vực": "o_orderpriority",
    "Cơ quan công bố": "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'UBND thành phố Hải Phòng' END", "Cơ quan/đơn vị giải quyết": "'clerk ' || o_custkey",
    "Cấp thực hiện": "CASE WHEN o_orderkey % 2 = 0 THEN 'Cấp thành phố' ELSE 'Cấp xã' END", "Quyết định ban hành/công bố": _DECISION,
    "Tình trạng hiệu lực": "CASE o_orderstatus WHEN 'F' THEN 'Bãi bỏ' WHEN 'O' THEN 'Còn hiệu lực' ELSE 'Cần xác minh' END",
    "Ngày hiệu lực": "strftime(o_orderdate::DATE, '%Y-%m-%d')", "Ghi chú cập nhật": "'Không thay đổi'",
    "Quyết định/văn bản thay thế, bãi bỏ": f"CASE WHEN o_orderstatus = 'F' THEN {_DECISION} ELSE '' END", "Nguồn chính thức": "'https://a/' || o_orderkey",
    "Cần đối soát?": "CASE WHEN o_orderkey % 7 = 0 THEN 'Có' ELSE '' END",
}


@query("SELECT o_orderkey, " + ", ".join(f'{_PROJECTED.get(c, chr(39) * 2)} AS "{c}"' for c in PROJECTED_COLUMNS) + " FROM orders")
def record_projection(t):
    key, s = _text("o_orderkey"), F.col("o_orderstatus")
    o = t("orders").select(
        "o_orderkey", s, F.concat(F.lit("1."), key).alias("code"), F.when(F.col("o_orderkey") % 7 == 0, "  ").otherwise(F.concat(F.lit(" task "), key)).alias("title"), F.col("o_orderpriority").alias("field"),
        F.lit(" ").alias("domain"), F.concat(F.lit("clerk "), "o_custkey").alias("agency"), F.lit("Cấp xã").alias("level"), F.concat("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, "/QĐ-TTg").otherwise("/QĐ-UBND")).alias("decision"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("future_date"), F.concat(F.lit("https://a/"), key).alias("article_url"),
    )
    status = F.when(s == "F", "Bãi bỏ").when(s == "O", "Còn hiệu lực").otherwise("Cần xác minh")
    given = {"Cấp thực hiện": F.when(F.col("o_orderkey") % 2 == 0, "Cấp thành phố")}
    return readmodel.record_projection(o, status, F.lit("Không thay đổi"), given, ["o_orderkey"])


def _promoted(t):
    k, key = F.col("c_custkey"), F.col("o_orderkey")
    master = t("customer").select("c_custkey", F.when(k % 4 == 0, "own").when(k % 4 == 1, "  ").alias("p"))
    sources = F.array(F.struct(F.when(key % 2 == 0, F.array(F.concat(F.lit("http://a/"), key))).alias("articles"), F.when(key % 5 == 0, F.concat(F.lit("http://f/"), key)).alias("attachment_url"), F.array(_text("o_orderkey")).alias("decisions")))
    items = t("orders").select(
        F.when(key % 13 > 0, F.col("o_custkey")).alias("c_custkey"), key, F.when(F.col("o_orderstatus") == "O", "confirmed").otherwise("ready").alias("bucket"),
        F.when(F.col("o_orderstatus") == "P", "held").otherwise("ready").alias("status"), F.when(key % 3 == 0, " ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("value"), sources.alias("sources"),
    )
    evidence = F.array().cast(promote.EVIDENCE)
    return promote.promote(master.withColumn("evidence", evidence), "c_custkey", "p", items, ["o_orderkey"], "evidence", "local_legal_effect", "official_table_guidance_duration")


_ITEMS = """
WITH i AS (SELECT CASE WHEN o_orderkey % 13 > 0 THEN o_custkey END AS k, o_orderkey, (o_orderstatus = 'O')::INT AS late, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS v FROM orders WHERE o_orderstatus <> 'P'),
f AS (SELECT * FROM i WHERE v <> '' AND k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY late, o_orderkey) = 1)
"""


@query(_ITEMS + """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'own' WHEN f.k IS NOT NULL THEN f.v WHEN c_custkey % 4 = 1 THEN '  ' END AS p,
  CASE WHEN c_custkey % 4 > 0 AND f.o_orderkey % 2 = 0 THEN 'http://a/' || f.o_orderkey END AS article, CASE WHEN c_custkey % 4 > 0 AND f.o_orderkey % 5 = 0 THEN 'http://f/' || f.o_orderkey END AS attachment
FROM customer LEFT JOIN f ON f.k = c_custkey
""")
def promoted_values(t):
    e = F.get("evidence", F.lit(0))
    return _promoted(t)[0].select("c_custkey", "p", e["article_url"].alias("article"), e["attachment_url"].alias("attachment"))


@query(_ITEMS + """
SELECT count(*) FILTER (i.late = 0) AS ready, count(*) FILTER (i.late = 1) AS confirmed,
  count(*) FILTER (c_custkey % 4 > 0 AND i.o_orderkey = f.o_orderkey) AS promoted,
  count(*) FILTER (c_custkey % 4 = 0 OR (c_custkey % 4 > 0 AND (i.late, i.o_orderkey) > (f.late, f.o_orderkey))) AS skipped, count(*) FILTER (c_custkey IS NULL) AS missing
FROM i LEFT JOIN customer ON c_custkey = i.k LEFT JOIN f ON f.k = i.k
""")
def promotion_counts(t):
    return _promoted(t)[1]
