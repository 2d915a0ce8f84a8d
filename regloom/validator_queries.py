"""Queries over the test tables for validators and for the gates of single fields, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import catalogue
from .functions import text as tx
from .operators import contract, field_gates, gates, upgrade, validators
from .operators.expect import Rule
from .operators.integrity import Pair, Side, Table, findings
from .queries import query
from .sources import tables


@query("""
WITH c AS (SELECT CASE WHEN c_custkey % 40 = 0 THEN '' ELSE c_custkey::VARCHAR END AS key, * FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_nationkey = 3)),
k AS (SELECT * FROM c WHERE key <> '')
SELECT 'error' AS severity, 'MISSING_CODE' AS code, '' AS key, 'no key' AS message FROM c WHERE key = ''
UNION ALL SELECT 'error', 'DUPLICATE_CODE', key, 'given again' FROM (SELECT DISTINCT key FROM k WHERE c_nationkey = 3)
UNION ALL SELECT 'error', 'MISSING_FIELD', key, 'name' FROM k WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT 'error', 'BAD_EVIDENCE', key, 'no list of evidence' FROM k WHERE c_nationkey = 5
UNION ALL SELECT 'error', 'BAD_EVIDENCE', key, '1.evidence' FROM k WHERE c_nationkey = 7
UNION ALL SELECT 'error', 'MISSING_PROVENANCE', key, '0.id' FROM k WHERE c_nationkey = 9
UNION ALL SELECT 'error', 'MISSING_PROVENANCE_URL', key, '0.url' FROM k WHERE c_nationkey >= 10 AND c_acctbal <= 0
UNION ALL SELECT 'warning', 'AUTHORITY_RECEPTION_MISMATCH', key, 'received where the level does not say so' FROM k WHERE c_acctbal > 5000 AND c_mktsegment NOT LIKE 'BUILD%' AND c_mktsegment NOT LIKE 'AUTO%'
UNION ALL SELECT 'error', 'BAD_SUBMISSION_URL', key, 'not https' FROM k WHERE c_nationkey < 4
UNION ALL SELECT 'error', 'FORMAT', '', 'another format'
UNION ALL SELECT 'error', 'MISSING_SNAPSHOT', '', 'no date'
""")
def governance_audit(t):
    c = t("customer")
    n = F.col("c_nationkey")
    c = c.unionByName(c.where(n == 3))
    item = F.struct(F.when(n == 9, "").otherwise(F.col("c_name")).alias("id"), F.when(n < 10, "u").alias("url"), F.when(F.col("c_acctbal") > 0, "a").otherwise("").alias("articleUrl"))
    evidence = F.when(n == 7, F.array(item, F.lit(None))).when(n != 5, F.array(item))
    link = F.when(n < 4, "http://x").when(n < 8, "").otherwise("https://x")
    rows = c.select("c_mktsegment", "c_acctbal", n, F.when(F.col("c_custkey") % 40 == 0, " ").otherwise(F.col("c_custkey").cast("string")).alias("k"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("name"), evidence.alias("evidence"), link.alias("link"))
    meta = t("region").agg(F.max(F.lit("other")).alias("format"), F.max(F.when(F.col("r_regionkey") < 0, "2024-07-01")).alias("snapshot"))
    return validators.governance(
        rows, meta, F.col("k"), {"name": F.col("name")}, F.col("evidence"), ["id"], ["url", "articleUrl"], F.col("c_acctbal") > 5000, F.col("c_mktsegment"), ["build", "auto"], n < 12, F.col("link"), ["master"]
    )


@query("""
WITH k AS (SELECT CASE WHEN c_custkey % 30 = 0 THEN 'x' ELSE '1.' || lpad(c_custkey::VARCHAR, 6, '0') END AS key, *, c_acctbal > 0 AS fee FROM customer)
SELECT 'error' AS severity, 'BAD_CODE' AS code, key, 'x' AS message FROM k WHERE key = 'x'
UNION ALL SELECT 'error', 'DUPLICATE_CODE', key, 'given again' FROM (SELECT key, row_number() OVER () AS i FROM k WHERE key = 'x') WHERE i > 1
UNION ALL SELECT 'error', 'BAD_STATUS', key, 'draft' FROM k WHERE c_nationkey = 1
UNION ALL SELECT 'error', 'NO_SOURCES', key, 'no sources' FROM k WHERE c_nationkey = 6 AND fee
UNION ALL SELECT 'error', 'UNKNOWN_SOURCE', key, CASE c_nationkey WHEN 6 THEN 'fee:a' ELSE 'fee:z' END FROM k WHERE c_nationkey IN (6, 13) AND fee
UNION ALL SELECT 'error', 'NO_PROVENANCE', key, 'no provenance' FROM k WHERE c_nationkey = 12 AND fee
UNION ALL SELECT 'error', 'FIELD_WITHOUT_SOURCE', key, 'fee' FROM k WHERE c_nationkey = 12 AND fee
UNION ALL SELECT 'error', 'FOREIGN_ROLE', key, 'link' FROM k WHERE c_nationkey < 3
UNION ALL SELECT 'error', 'SOURCE_ID_AGAIN', key, 'a' FROM k WHERE c_nationkey = 8
UNION ALL SELECT 'error', 'SOURCE_WITHOUT_ID', key, '1' FROM k WHERE c_nationkey = 9
UNION ALL SELECT 'error', 'BAD_ROLE', key, '1' FROM k WHERE c_nationkey = 11
UNION ALL SELECT 'error', 'UNOFFICIAL_URL', key, '1' FROM k WHERE c_nationkey = 10
UNION ALL SELECT 'error', 'SOURCE_NULL', key, '1' FROM k WHERE c_nationkey = 14
UNION ALL SELECT 'error', 'LINK_HOST', key, 'http://gate.example/?province=31&formalityId=' || c_custkey FROM k WHERE c_nationkey = 15
UNION ALL SELECT 'error', 'LINK_PARAMETER', key, 'province=' FROM k WHERE c_nationkey = 16
UNION ALL SELECT 'error', 'LINK_ID', key, c_custkey::VARCHAR FROM k WHERE c_nationkey = 17
UNION ALL SELECT 'error', 'FORMAT', '', 'another format' UNION ALL SELECT 'error', 'VERSION', '', 'another version' UNION ALL SELECT 'error', 'ROLES_MISSING', '', 'local'
""")
def guidance_contract(t):
    n = F.col("c_nationkey")
    source = lambda i, r, u: F.struct(i.alias("id"), r.alias("role"), u.alias("url"))
    second = source(F.when(n == 8, "a").when(n == 9, "").otherwise("b"), F.when(n == 11, "odd").otherwise("local"), F.when(n == 10, "http://y.example.org").otherwise("https://y.example.org"))
    sources = F.when(n != 6, F.array(source(F.lit("a"), F.lit("law"), F.lit("https://example.org/1")), F.when(n != 14, second)))
    k = F.col("c_custkey").cast("string")
    gate = F.concat(F.when(n == 15, "http").otherwise("https"), F.lit("://gate.example/?"), F.when(n != 16, "province=31&").otherwise(""), F.lit("formalityId="), k)
    cites = F.create_map(F.lit("fee"), F.array(F.when(n == 13, "z").otherwise("a")), F.lit("link"), F.array(F.when(n < 3, "a").otherwise("b")))
    rows = t("customer").select(
        F.when(F.col("c_custkey") % 30 == 0, "x").otherwise(F.concat(F.lit("1."), F.lpad(F.col("c_custkey").cast("string"), 6, "0"))).alias("k"),
        F.when(n == 1, "draft").otherwise("verified").alias("status"),
        F.when(F.col("c_acctbal") > 0, "f").otherwise("").alias("fee"),
        F.when(n < 5, "l").alias("link"),
        sources.alias("sources"),
        F.when(n != 12, cites).alias("cites"),
        F.when(n > 14, gate).alias("gate"),
        F.when(n == 17, "x").otherwise(k).alias("id"),
    )
    fields = {"fee": F.col("fee"), "link": F.col("link")}
    meta = t("region").agg(F.max(F.lit("other")).alias("format"), F.max(F.lit(2)).alias("version"), F.max(F.array(F.lit("law"))).alias("roles"))
    link = (F.col("gate"), F.col("id"), "gate.example", {"province": "31"})
    return validators.guidance(rows, F.col("k"), r"^\d{1,2}\.\d{3,6}$", F.col("status"), ["verified"], fields, F.col("sources"), F.col("cites"), ["law", "local"], ["example.org"], {"link": "local"}, link, meta, "guidance")


@query("""
WITH s AS (SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'same' ELSE s_suppkey::VARCHAR END AS key, CASE WHEN s_suppkey % 5 = 0 THEN 'http' ELSE 'https' END || '://s' || s_nationkey || '.example.org/' AS url, * FROM supplier)
SELECT 'error' AS severity, 'UNOFFICIAL_URL' AS code, key, url AS message FROM s WHERE s_suppkey % 5 = 0
UNION ALL SELECT 'error', 'MISSING_FIELD', key, 'authority' FROM s WHERE s_suppkey % 3 = 0
UNION ALL SELECT 'error', 'BAD_ENUM', key, 'role' FROM s WHERE s_nationkey % 2 = 1
UNION ALL SELECT 'error', 'DUPLICATE_ID', key, 'given again' FROM (SELECT key, row_number() OVER (PARTITION BY key) AS i FROM s) WHERE i > 1
UNION ALL SELECT 'error', 'DUPLICATE_URL', left(url, length(url) - 1), 'given again' FROM (SELECT url, row_number() OVER (PARTITION BY url) AS i FROM s) WHERE i > 1
UNION ALL SELECT 'error', 'PORTFOLIO', 'local_', count(*) FILTER (s_acctbal <= 0) || ' of 1000000' FROM s
""")
def source_registry(t):
    n = F.col("s_nationkey")
    secure = F.when(F.col("s_suppkey") % 5 == 0, "http").otherwise("https")
    rows = t("supplier").select(
        F.when(F.col("s_suppkey") % 7 == 0, "same").otherwise(F.col("s_suppkey").cast("string")).alias("id"),
        F.concat(secure, F.lit("://s"), n, F.lit(".example.org/")).alias("url"),
        F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.col("s_name")).alias("authority"),
        F.when(n % 2 == 1, "odd").otherwise("listing").alias("role"),
        F.when(F.col("s_acctbal") > 0, "department").otherwise("local_x").alias("kind"),
    )
    return validators.registry(rows, "id", "url", ["example.org"], ["authority"], {"role": ["listing"]}, "kind", {"department": 1, "local_": 1_000_000})


@query("""
WITH o AS (SELECT o_custkey AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'Không thu phí' WHEN '5-LOW' THEN NULL ELSE 'Không quy định' END AS v FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 100000),
g AS (SELECT k, count(*) AS n, count(v) AS s, min(v) AS lo, max(v) AS hi FROM o GROUP BY 1),
c AS (SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_acctbal > 3000 THEN 'Không quy định' ELSE '5.000 đồng' END AS cur FROM customer WHERE c_nationkey < 20)
SELECT g.k::VARCHAR AS key, CASE WHEN s = n AND lo = hi THEN lo END AS value,
  CASE WHEN s < n OR lo <> hi THEN 'needsReview' WHEN c.k IS NULL THEN 'pendingCanonicalPhase2' WHEN cur = '' THEN 'ready' WHEN cur = lo THEN 'confirmedExisting' ELSE 'needsReview' END AS bucket,
  CASE WHEN s = 0 THEN 'unsafe_or_truncated_fee_text' WHEN s < n THEN 'mixed_candidate_quality' WHEN lo <> hi THEN 'candidate_disagreement' WHEN c.k IS NULL THEN 'no_record' WHEN cur = '' THEN 'blank' WHEN cur = lo THEN 'equal' ELSE 'conflicts_with_canonical' END AS reason
FROM g LEFT JOIN c USING (k)
""")
def fee_gate(t):
    p = F.col("o_orderpriority")
    raw = F.when(p == "1-URGENT", "Không  thu phí đối với hồ sơ").when(p == "5-LOW", "Phí: 5.000").otherwise("Không quy định")
    o = t("orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("k"), raw.alias("raw"), F.when(F.col("o_orderstatus") == "P", "medium").otherwise("high").alias("sure"))
    c = t("customer").where("c_nationkey < 20")
    c = c.select(F.col("c_custkey").alias("k"), F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_acctbal") > 3000, "Không quy định").otherwise("5.000 đồng").alias("cur"))
    return field_gates.fee_gate(o, c, "k", F.col("raw"), F.col("sure"), F.col("cur"), catalogue.safe_fee)


@query("""
WITH o AS (SELECT o_custkey AS k, CASE WHEN o_orderpriority = '5-LOW' THEN '3 ngày 5 ngày' WHEN o_orderpriority < '3' THEN '5 Ngày' ELSE '5 ngày' END AS v FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 150000 AND o_orderpriority <> '4-NOT SPECIFIED'),
g AS (SELECT k, min(v) AS v, min(lower(v)) AS lo, max(lower(v)) AS hi FROM o GROUP BY 1),
c AS (SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_acctbal > 3000 THEN '15 ngày làm việc' ELSE '7 ngày' END AS cur FROM customer WHERE c_nationkey < 20)
SELECT g.k::VARCHAR AS key, CASE WHEN lo = hi THEN v END AS value, CASE WHEN lo <> hi OR lo LIKE '3 %' THEN 'needsReview' WHEN cur = '' THEN 'ready' WHEN contains(cur, lo) THEN 'confirmedExisting' ELSE 'needsReview' END AS bucket,
  CASE WHEN lo <> hi THEN 'candidate_disagreement' WHEN lo LIKE '3 %' THEN 'multiple_or_ambiguous_duration_tokens' WHEN cur = '' THEN 'blank' WHEN contains(cur, lo) THEN 'equal' ELSE 'conflicts_with_canonical' END AS reason
FROM g JOIN c USING (k)
""")
def duration_gate(t):
    p = F.col("o_orderpriority")
    raw = F.when(p == "5-LOW", "3 ngày 5 ngày").when(p == "4-NOT SPECIFIED", " ").when(p < "3", "5 Ngày").otherwise("5 ngày")
    o = t("orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("k"), raw.alias("raw"), F.when(F.col("o_orderstatus") == "F", "high").otherwise("medium").alias("sure"))
    c = t("customer").where("c_nationkey < 20")
    c = c.select(F.col("c_custkey").alias("k"), F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_acctbal") > 3000, "15 ngày làm việc").otherwise("7 ngày").alias("cur"))
    clear = lambda x: tx.unambiguous_duration(x, catalogue.DURATION_WITH_NUMBER)
    return field_gates.duration_gate(o, c, "k", F.col("raw"), F.col("sure"), F.col("cur"), F.lower, clear)


@query("""
WITH p AS (SELECT c_custkey::VARCHAR AS key, CASE WHEN c_custkey % 50 = 1 THEN '' WHEN c_custkey % 50 = 2 THEN 'Tên bước 1' WHEN c_custkey % 50 = 3 THEN 'a (b' WHEN c_custkey % 50 = 4 THEN 'x b cd' ELSE 'N' END AS name, c_mktsegment AS seg, c_nationkey AS n
  FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 40 = 6) WHERE c_nationkey < 20),
x AS (SELECT c_custkey::VARCHAR AS key, c_acctbal > 0 AS good FROM customer WHERE c_nationkey >= 18),
o AS (SELECT o_custkey::VARCHAR AS key, max(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
u AS (SELECT key, min(name) AS name, max(seg) AS seg FROM p GROUP BY 1),
r AS (SELECT unnest(['5', '6', '1000000000']) AS key),
f AS (SELECT 'NAME_MISSING' AS code, key, name AS message, count(*) AS n FROM p WHERE name = '' GROUP BY key, name
UNION ALL SELECT 'NAME_EXTRACTED', key, name, count(*) FROM p WHERE name LIKE '%bước%' GROUP BY key, name
UNION ALL SELECT 'NAME_UNCLEAN', key, name, count(*) FROM p WHERE name LIKE '%(%' GROUP BY key, name
UNION ALL SELECT 'NAME_SPLIT', key, name, count(*) FROM p WHERE name LIKE 'x b%' GROUP BY key, name
UNION ALL SELECT 'CODE_AGAIN', key, 'given again in public', count(*) FROM p GROUP BY key HAVING count(*) > 1
UNION ALL SELECT 'KNOWN_MISSING', key, 'missing in public', 1 FROM r WHERE key NOT IN (SELECT key FROM p)
UNION ALL SELECT 'IN_BOTH', key, '', 1 FROM u SEMI JOIN x USING (key)
UNION ALL SELECT 'SEGMENT', key, seg, 1 FROM u JOIN o USING (key) WHERE left(seg, 1) <> left(v, 1) AND left(v, 1) = '5'
UNION ALL SELECT 'ORDERED_NOWHERE', key, '', 1 FROM o WHERE key NOT IN (SELECT key FROM p) AND key NOT IN (SELECT key FROM x WHERE good)
UNION ALL SELECT 'AUDITED', '', (SELECT count(*) FROM p) || ' and ' || (SELECT count(*) FROM x) || ' of ' || (SELECT count(*) FROM customer), 1 WHERE (SELECT count(*) FROM p) + (SELECT count(*) FROM x) <> (SELECT count(*) FROM customer)
UNION ALL SELECT 'SNAPSHOT', '', max(ts)::DATE::VARCHAR, 1 FROM events)
SELECT 'error' AS severity, code, key, message, CAST(n AS BIGINT) AS n FROM f
""")
def release_integrity(t):
    c, k, n = t("customer"), F.col("c_custkey"), F.col("c_nationkey")
    again = c.unionByName(c.where(k % 40 == 6)).where(n < 20)
    name = F.when(k % 50 == 1, " ").when(k % 50 == 2, "Tên bước 1").when(k % 50 == 3, "a (b").when(k % 50 == 4, "x b cd").otherwise("N")
    public = again.select(k.cast("string").alias("code"), F.trim(name).alias("name"), "c_mktsegment", "c_nationkey")
    excluded = c.where(n >= 18).select(k.cast("string").alias("code"), (F.col("c_acctbal") > 0).alias("good"))
    events = t("events").select("ts")
    code, faults = F.col("code"), catalogue.name_faults(F.col("name"))
    both = {"name": F.col("name"), "seg": F.col("c_mktsegment")}
    suite = {
        "public": Table(public, code, [Rule(f, F.array_contains(faults, f), F.col("name")) for f in ("NAME_MISSING", "NAME_EXTRACTED", "NAME_UNCLEAN", "NAME_SPLIT")], {"CODE_AGAIN": code}, {"KNOWN_MISSING": (["5", "6", "1000000000"], F.lit(True))}, {"public": F.lit(1)}),
        "excluded": Table(excluded, code, totals={"excluded": F.lit(1)}),
        "orders": Table(t("orders"), F.col("o_custkey")),
        "all": Table(c, k, totals={"customers": F.lit(1)}),
        "events": Table(events, F.lit(""), values={"last": F.date_format("ts", "yyyy-MM-dd")}),
    }
    placed = Side("orders", F.col("o_custkey"), {"v": F.col("o_orderpriority")}, F.col("o_orderstatus") == "P")
    first = lambda x: F.substring(x, 1, 1)
    pairs = [
        Pair("public and excluded", Side("public", code, both), Side("excluded", code), lambda p, x: [Rule("IN_BOTH", p.there & x.there)]),
        Pair("public and orders", Side("public", code, both), placed, lambda p, o: [Rule("SEGMENT", p.there & (first(o("v")) == "5") & (first(p("seg")) != first(o("v"))), p("seg"))]),
        # a key of an order stands among the public ones or the good excluded ones: both are one side here
        Pair("orders and all", placed, Side("all", k, where=(n < 20) | (F.col("c_acctbal") > 0)), lambda o, a: [Rule("ORDERED_NOWHERE", o.there & ~a.there)]),
    ]
    said = lambda v: F.concat(v.text("public"), F.lit(" and "), v.text("excluded"), F.lit(" of "), v.text("customers"))
    return findings(suite, pairs, lambda v: [Rule("AUDITED", v.n("public") + v.n("excluded") != v.n("customers"), said(v)), Rule("SNAPSHOT", v.text("last") != "2024-07-01", v.text("last"))])


@query("""
WITH o AS (SELECT o_custkey AS k, o_orderpriority AS p, o_orderkey % 5 AS r FROM orders WHERE o_orderpriority <> '2-HIGH' AND o_totalprice > 250000),
g AS (SELECT k, bool_or(p = '5-LOW') AS torn, array_to_string(list_sort(list(DISTINCT 'Nghị định số ' || r || '/2020/NĐ-CP')), ';') AS v, count(DISTINCT r) AS n FROM o GROUP BY 1),
c AS (SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE 'Nghị định số ' || (c_custkey % 5) || '/2020/NĐ-CP' END AS cur FROM customer WHERE c_nationkey < 20)
SELECT g.k::VARCHAR AS key, v AS value, CASE WHEN torn THEN 'needsReview' WHEN c.k IS NULL THEN 'pendingCanonicalPhase2' WHEN cur = '' THEN 'ready' WHEN cur = v THEN 'confirmedExisting' ELSE 'needsReview' END AS bucket,
  CASE WHEN torn THEN 'incomplete_or_ocr_truncated_legal_reference' WHEN c.k IS NULL THEN 'no_record' WHEN cur = '' THEN 'blank' WHEN cur = v THEN 'equal' ELSE 'conflicts_with_canonical' END AS reason
FROM g LEFT JOIN c USING (k)
""")
def legal_gate(t):
    p, ref = F.col("o_orderpriority"), F.concat(F.lit("Nghị  định "), (F.col("o_orderkey") % 5).cast("string"), F.lit("/2020/NĐ - CP"))
    raw = F.when(p == "5-LOW", F.array(ref, F.lit("Thông tư số 226"))).otherwise(F.array(ref))
    o = t("orders").where("o_totalprice > 250000").select(F.col("o_custkey").cast("string").alias("key"), raw.alias("raw"), F.when(p == "2-HIGH", "low").when(p == "1-URGENT", "high").otherwise("medium").alias("sure"))
    held = F.concat(F.lit("theo Nghị định số "), (F.col("c_custkey") % 5).cast("string"), F.lit("/2020/NĐ-CP ngày"))
    c = t("customer").where("c_nationkey < 20").select(F.col("c_custkey").cast("string").alias("key"), F.when(F.col("c_mktsegment") != "BUILDING", F.array(held)).alias("cur"))
    return gates.set_gate(o, c, "key", F.col("raw"), F.col("sure"), F.col("cur"), catalogue.legal_refs).withColumn("value", F.array_join("value", ";"))


@query("""
WITH c AS (SELECT c_custkey AS k, c_custkey % 6 AS m, c_nationkey AS n FROM customer)
SELECT k, CASE m WHEN 0 THEN 'insufficient' WHEN 1 THEN 'conflicting' WHEN 2 THEN 'insufficient' WHEN 3 THEN 'insufficient' WHEN 4 THEN CASE WHEN n < 12 THEN 'verified' ELSE 'insufficient' END ELSE 'verified' END AS agency,
  CASE m WHEN 1 THEN 'multiple_agency_mentions' WHEN 2 THEN 'reception_location_only' WHEN 3 THEN 'unlabelled_agency_mention' WHEN 4 THEN CASE WHEN n < 12 THEN NULL ELSE 'unlabelled_agency_mention' END END AS reason,
  CASE WHEN n < 8 THEN 'conflicting' WHEN n < 16 THEN 'verified' ELSE 'insufficient' END AS duration,
  concat_ws(',', CASE WHEN m = 5 OR m = 4 AND n < 12 THEN 'agency' END, CASE WHEN n BETWEEN 8 AND 15 THEN 'duration' END) AS promotable,
  CASE WHEN m = 5 OR m = 4 AND n < 12 OR n BETWEEN 8 AND 15 THEN 'field_validated' ELSE 'no_promotable_field' END AS verification FROM c
""")
def validated_fields(t):
    m, n = F.col("c_custkey") % 6, F.col("c_nationkey")
    body = F.lit("Ủy ban nhân dân xã")
    values = F.when(m == 0, F.array(F.lit(" "))).when(m == 1, F.array(body, F.lit("Sở Y tế"))).when(m == 2, F.array(F.lit("Trung tâm PVHCC xã"))).otherwise(F.array(body, F.concat(body, F.lit(" "))))
    far = F.concat(F.lit("Mã; CƠ QUAN THỰC HIỆN: "), F.repeat(F.lit("x"), F.when(n < 12, 203).otherwise(204)), body)
    segments = F.when(m == 3, F.array(F.concat(F.lit("gửi "), body))).when(m == 4, F.array(F.lit(None).cast("string"), far)).otherwise(F.array(F.concat(F.lit("Cơ quan có thẩm quyền "), body)))
    days = F.when(n < 8, F.array(F.lit("5 ngày"), F.lit("3 ngày"))).when(n < 16, F.array(F.lit("5 ngày"), F.lit("5 ngày")))
    out = gates.validated_fields(t("customer").withColumn("k", F.col("c_custkey")), "k", {"agency": gates.agency_value(values, segments, catalogue.AGENCY_LABELS, catalogue.RECEPTION_PLACES), "duration": gates.single_value(days)})
    return out.select("k", F.col("agency.status").alias("agency"), "agency.reason", F.col("duration.status").alias("duration"), F.array_join("promotable", ",").alias("promotable"), "verification")


_RECORDS = """
WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, 'https://a.gov.vn/' || c_custkey AS u, '2024-01-' || lpad((1 + c_custkey % 28)::VARCHAR, 2, '0') AS d FROM customer),
j AS (SELECT *, 'ev_' || left(sha1('{"articleUrl":"' || u || '","attachmentSha256":null,"attachmentUrl":null,"classification":"public","decisionNumbers":["' || n || '/QĐ"],"effectiveDate":null,"publishedDate":"' || d || '","repealContext":false,"sourceRole":"local_legal_effect","url":"' || u || '"}'), 24) AS legal,
  'ev_' || left(sha1('{"articleUrl":null,"attachmentSha256":null,"attachmentUrl":null,"classification":"dvcqg_submission_link","decisionNumbers":[],"effectiveDate":null,"publishedDate":null,"repealContext":false,"sourceRole":"local_execution","url":"' || 'https://gate.gov.vn/f?provinceCode=31&wardCode=11824&commune=WARD&formalityId=' || k || '"}'), 24) AS link,
  'ev_' || left(sha1('{"articleUrl":null,"attachmentSha256":null,"attachmentUrl":null,"classification":"official_guidance","decisionNumbers":[],"effectiveDate":null,"publishedDate":null,"repealContext":false,"sourceRole":"central_content_reference","url":"https://m.gov.vn/' || n || '"}'), 24) AS guide FROM c)
"""


def _records(t):
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    text, texts = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    fields = {"articleUrl": F.concat(F.lit("https://a.gov.vn/"), k), "publishedDate": F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("c_custkey") % 28).cast("string"), 2, "0")), "classification": F.lit("public"), "decisionNumbers": F.array(F.concat(n, F.lit("/QĐ"))), "repealContext": F.lit(None).cast("boolean")}
    e = F.struct(*[fields.get(x, texts if x == "decisionNumbers" else text).alias(x) for x in upgrade._NAMES]).cast(upgrade.EVIDENCE)
    link = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("https://gate.gov.vn/f?provinceCode=31&wardCode=11824&commune=WARD&formalityId="), k))
    source = F.struct(F.lit("s").alias("id"), F.concat(F.lit("https://m.gov.vn/"), n).alias("url"), F.when(F.col("c_nationkey") >= 0, "central_content_reference").alias("sourceRole"), text.alias("classification"), text.alias("publishedDate"), text.alias("effectiveDate"))
    rows = tables.spread(t("customer")).select(
        k.alias("ma"), F.col("c_name").alias("ten"), F.col("c_nationkey").alias("n"), F.array(e, F.when(F.col("c_nationkey") < 8, e)).alias("evidence"), link.alias("link"),
        F.when(F.col("c_nationkey") < 12, F.array(source)).alias("sources"), F.create_map(F.lit("lePhi"), F.array(F.when(F.col("c_nationkey") < 6, "s").otherwise("none"))).alias("cites"),
    )
    there = F.col("link").isNotNull()
    guide = upgrade.Guide(F.col("sources"), F.col("cites"), {"lePhi": F.lit(True)}, {})
    out = upgrade.upgraded(rows, F.col("evidence"), {"ma": F.lit(True), "quyetDinh": F.lit(False)}, {"nopHoSoUrl": there}, F.lit(False), [(F.col("link"), "dvcqg_submission_link", F.lit(""))], F.lit("2024-07-01"), ["gov.vn"], "gate.gov.vn", guide)
    return out


@query(_RECORDS + """
SELECT k::VARCHAR AS key, d AS effective_from, concat_ws(',', legal, CASE WHEN n % 2 = 0 THEN link END, CASE WHEN n < 12 THEN guide END) AS ids,
  concat_ws(';', CASE WHEN n < 12 THEN 'huongDan.lePhi=' || guide END, 'lifecycle.effectiveFrom=' || legal, 'lifecycle.status=' || legal, 'ma=' || legal, CASE WHEN n % 2 = 0 THEN 'nopHoSoUrl=' || link END) AS sources FROM j
""")
def record_upgrade(t):
    pairs = F.array_sort(F.transform(F.map_entries("fieldSources"), lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["value"], ","))))
    ids = F.array_join(F.transform("sourceEvidence", lambda e: e["evidenceId"]), ",")
    return _records(t).select(F.col("ma").alias("key"), F.col("lifecycle.effectiveFrom").alias("effective_from"), ids.alias("ids"), F.array_join(pairs, ";").alias("sources"))


@query(_RECORDS + """,
f AS (SELECT 'NAME_CP437' AS code, k, 'a character of another encoding' AS message FROM j WHERE k % 40 = 1
UNION ALL SELECT 'NAME_SPLIT', k, 'Ch ứng' FROM j WHERE k % 40 = 2
UNION ALL SELECT 'NAME_NOT_NFC', k, 'not composed' FROM j WHERE k % 40 = 3
UNION ALL SELECT 'NAME_CONTROL', k, 'a control character' FROM j WHERE k % 40 = 4
UNION ALL SELECT 'LIFECYCLE_STATUS', k, 'gone' FROM j WHERE k % 40 = 5
UNION ALL SELECT 'EVIDENCE_ID_CONTENT', k, '1' FROM j WHERE k % 40 = 6
UNION ALL SELECT 'ACTIVE_BUT_REPEALED', k, '2024-06-01' FROM j WHERE k % 40 = 7
UNION ALL SELECT 'FIELD_UNKNOWN_ID', k, 'ma:ev_deadbeefdeadbeefdeadbeef' FROM j WHERE k % 40 = 8
UNION ALL SELECT 'FIELD_NEEDS_LEGAL', k, 'ma' FROM j WHERE k % 40 = 8
UNION ALL SELECT 'FIELD_WITHOUT_SOURCE', k, 'nopHoSoUrl' FROM j WHERE k % 40 = 9 AND n % 2 = 0
UNION ALL SELECT 'EVIDENCE_AGAIN', k, legal FROM j WHERE k % 40 = 10
UNION ALL SELECT 'LINK_ID', k, k::VARCHAR FROM j WHERE k % 40 = 11 AND n % 2 = 0
UNION ALL SELECT 'LINK_COMMUNE', k, 'wardCode=' FROM j WHERE k % 40 = 12 AND n % 2 = 0
UNION ALL SELECT 'GUIDE_STATUS', k, 'draft' FROM j WHERE k % 40 = 13 AND n < 12
UNION ALL SELECT 'LIFECYCLE_FUTURE', k, d FROM j WHERE k % 40 = 14)
SELECT 'error' AS severity, code, k::VARCHAR AS key, message FROM f
UNION ALL SELECT 'error', 'VERSION', '', 'another version'
""")
def canonical_contract(t):
    m = F.col("ma").cast("int") % 40
    df = _records(t)
    first = F.get("sourceEvidence", F.lit(0))
    repeal = upgrade._rebuilt(first, repealContext=F.lit(True), effectiveDate=F.lit("2024-06-01"))
    repeal = upgrade._rebuilt(repeal, evidenceId=upgrade.content_id(repeal))
    spoiled = F.transform("sourceEvidence", lambda e, i: F.when((i == 0) & (m == 6), upgrade._rebuilt(e, attachmentSha256=F.lit("a" * 64))).otherwise(e))
    evidence = F.when(m == 7, F.concat("sourceEvidence", F.array(repeal))).when(m == 10, F.concat("sourceEvidence", F.array(first))).otherwise(spoiled)
    life = F.col("lifecycle")
    status = F.when(m == 5, "gone").when(m == 14, "future_effective").otherwise(life["status"])
    lifecycle = F.struct(status.alias("status"), F.when(m == 14, life["effectiveFrom"]).otherwise(life["asOf"]).alias("asOf"), life["effectiveFrom"].alias("effectiveFrom"), life["effectiveTo"].alias("effectiveTo"))
    unknown = F.transform_values("fieldSources", lambda f, ids: F.when((m == 8) & (f == "ma"), F.array(F.lit("ev_deadbeefdeadbeefdeadbeef"))).otherwise(ids))
    sources = F.map_filter(unknown, lambda f, _: ~((m == 9) & (f == "nopHoSoUrl")))
    name = F.when(m == 1, "Th├╗").when(m == 2, "Cấp Ch ứng chỉ").when(m == 3, "é").when(m == 4, "a\x07b").otherwise(F.col("ten"))
    df = df.withColumns({"sourceEvidence": evidence, "lifecycle": lifecycle, "fieldSources": sources, "ten": name})
    url = F.when(m == 12, F.replace("link", F.lit("wardCode=11824&"), F.lit(""))).otherwise(F.col("link"))
    link = contract.Link(url, F.lit("verified_official_guidance"), F.when(m == 11, "x").otherwise(F.col("ma")), F.lit("Xã"), "gate.gov.vn")
    guide = contract.Guidance(F.when(F.col("sources").isNotNull(), F.when(m == 13, "draft").otherwise("verified_official")), F.col("sources"), F.lit(None).cast("string"))
    meta = t("region").agg(F.max(F.lit("f")).alias("format"), F.max(F.lit(3)).alias("version"), F.max(F.lit("2024.07.01")).alias("dataset_version"), F.max(F.sha1(F.lit("x"))).alias("source_commit"), F.max(F.lit("kind")).alias("source_commit_kind"))
    return contract.canonical(df, meta, F.col("ma"), F.col("ten"), {"ma": F.lit(True), "nopHoSoUrl": F.col("link").isNotNull()}, link, guide, ["gov.vn"], "f", "kind")
