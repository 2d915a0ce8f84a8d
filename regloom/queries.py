"""Queries over the driver's tables for the curation operators, with DuckDB SQL for each where SQL can express it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions import catalogue
from .functions import evidence as ev
from .functions import text as tx
from .functions import urls
from .operators import aggregate, cells, classify, diff, discovery, expect, gates, lines, materialise, readmodel, reconcile, replay, resolve, runs, search, validators
from .sources import tables, web
from .sources.versions import Versions
from .streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
AS_OF = "2024-07-01"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name, *columns: tables.parquet(spark, sf_dir, name, columns or None))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return run

    return add


def _day():
    return F.date_format("ts", "yyyy-MM-dd")


@query("""
SELECT user_id, active, repealed, CASE WHEN active = '' AND repealed = '' THEN 'needs_verification' WHEN repealed >= active THEN 'repealed' ELSE 'active' END AS status
FROM (SELECT user_id, coalesce(max(CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END), '') AS active,
             coalesce(max(CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d') END), '') AS repealed FROM events GROUP BY user_id)
""")
def evidence_status(t):
    return resolve.evidence_status(t("events"), "user_id", _day(), F.col("event_type") == "error")


@query("SELECT doc_id, md5(lower(strip_accents(text))) AS folded FROM documents")
def fold_text(t):
    return t("documents", "doc_id", "text").select("doc_id", F.md5(tx.fold(F.col("text"))).alias("folded"))


@query("""
WITH c AS (SELECT o_custkey || '-' || year(o_orderdate) AS k, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS v, bool_or(o_orderstatus = 'P') AS bad FROM orders GROUP BY 1),
m AS (SELECT c_custkey || '-1995' AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_acctbal > 5000 THEN '1-URGENT' ELSE '3-MEDIUM' END AS cur FROM customer)
SELECT c.k, CASE WHEN n = 1 THEN v END AS value, n AS n_values,
  CASE WHEN bad OR n > 1 THEN 'needsReview' WHEN m.k IS NULL THEN 'pendingCanonicalPhase2' WHEN cur = '' THEN 'ready' WHEN cur = v THEN 'confirmedExisting' ELSE 'needsReview' END AS bucket,
  CASE WHEN bad THEN 'unsafe' WHEN n > 1 THEN 'disagreement' WHEN m.k IS NULL THEN 'no_record' WHEN cur = '' THEN 'blank' WHEN cur = v THEN 'equal' ELSE 'conflict' END AS reason
FROM c LEFT JOIN m USING (k)
""")
def consensus_gate(t):
    o = t("orders").withColumn("k", F.concat_ws("-", "o_custkey", F.year("o_orderdate")))
    cur = F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_acctbal") > 5000, "1-URGENT").otherwise("3-MEDIUM")
    m = t("customer").select(F.concat("c_custkey", F.lit("-1995")).alias("k"), cur.alias("cur"))
    return gates.gate(o, m, "k", F.col("o_orderpriority"), F.col("cur"), F.col("o_orderstatus") == "P")


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS signup FROM events
""")
def carry_forward(t):
    e = lines.carry_forward(t("events"), ["user_id"], [F.col("ts"), F.col("event_id")], F.when(F.col("event_type") == "signup", F.col("event_id")), "signup")
    return e.select("event_id", "signup")


def _kind():
    e = F.col("event_type")
    return F.when(e == "view", "review").when((e == "error") & (F.col("ts") > F.lit(AS_OF).cast("timestamp")), "future").when(e == "error", "repealed").otherwise("current")


_REPLAY = """
WITH k AS (SELECT user_id, {'t': ts, 'i': event_id} AS o, CASE WHEN event_type = 'view' THEN 'review' WHEN event_type = 'error' AND ts > TIMESTAMP '2024-07-01' THEN 'future' WHEN event_type = 'error' THEN 'repealed' ELSE 'current' END AS kind FROM events),
a AS (SELECT user_id, max(o) FILTER (kind = 'current') AS made, max(o) FILTER (kind = 'repealed') AS gone, max(o) FILTER (kind = 'future') AS waits,
  count(*) FILTER (kind = 'review') AS n_reviews, count(*) FILTER (kind = 'current') AS n_updates FROM k GROUP BY user_id),
c AS (SELECT k.user_id, min(o) AS created FROM k JOIN a USING (user_id) WHERE kind = 'current' AND (gone IS NULL OR o > gone) GROUP BY k.user_id),
s AS (SELECT a.*, c.created, made IS NOT NULL AND (gone IS NULL OR made > gone) AS pub, waits IS NOT NULL AND (gone IS NULL OR waits > gone) AS fut FROM a LEFT JOIN c ON c.user_id = a.user_id)
"""


@query(_REPLAY + """SELECT user_id, CASE WHEN pub THEN 'current' WHEN fut THEN 'future_effective' WHEN gone IS NOT NULL THEN 'repealed' ELSE 'unknown' END AS state,
  (CASE WHEN pub THEN made WHEN fut THEN waits ELSE gone END).i AS since_id, n_reviews, n_updates, CASE WHEN pub AND waits > created THEN waits.i END AS future_id FROM s""")
def lifecycle_replay(t):
    r = replay.replay(t("events"), "user_id", ["ts", "event_id"], _kind())
    return r.select("user_id", "state", F.col("since.event_id").alias("since_id"), "n_reviews", "n_updates", F.col("future.event_id").alias("future_id"))


_ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"''][^\"'']*[\"''][^>]*>.*?</a>"


@query(rf"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '{_ANCHOR}') AS a FROM pages), y AS (SELECT page_id, unnest(a) AS a, generate_subscripts(a, 1) - 1 AS pos FROM x)
SELECT page_id, CAST(pos AS INT) AS pos, regexp_extract(a, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) AS href, trim(regexp_replace(regexp_replace(a, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM y
""")
def html_links(t):
    return web.links(t("pages"), "page_id", "html")


@query(r"""
SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title,
  CASE WHEN lower(strip_accents(html)) LIKE '%stat%' THEN 's' WHEN lower(strip_accents(html)) LIKE '%the%' THEN 't' ELSE 'other' END AS cls FROM pages
""")
def title_classify(t):
    cls = classify.by_markers(F.col("html"), [("s", ["stat"]), ("t", ["the"])], "other")
    return t("pages").select("page_id", web.title(F.col("html")).alias("title"), cls.alias("cls"))


_SNAP = """
WITH b AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'),
a AS (SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW')
"""


@query(_SNAP + """
SELECT o_orderkey, CASE WHEN b.o_orderstatus IS NULL THEN 'added' WHEN a.o_orderstatus IS NULL THEN 'removed' ELSE 'changed' END AS change,
  CASE WHEN a.o_orderstatus IS NOT NULL AND b.o_orderstatus IS NOT NULL THEN 'o_orderstatus:' || b.o_orderstatus || '>' || a.o_orderstatus ELSE '' END AS fields
FROM b FULL JOIN a USING (o_orderkey) WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
""")
def snapshot_delta(t):
    d = diff.snapshot_delta(*_snapshots(t), "o_orderkey", ["o_orderstatus", "o_orderpriority"])
    told = F.array_join(F.transform("fields", lambda f: F.concat(f["field"], F.lit(":"), f["before"], F.lit(">"), f["after"])), ",")
    return d.select("o_orderkey", "change", told.alias("fields"))


def _snapshots(t):
    c = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    o = t("orders")
    after = o.where("o_orderpriority <> '5-LOW'").withColumn("o_orderstatus", F.when(F.col("o_totalprice") > 100000, "F").otherwise(F.col("o_orderstatus")))
    return o.where("o_orderstatus <> 'P'").select(*c), after.select(*c)


@query(_SNAP + """
SELECT o_orderkey, CASE WHEN b.o_orderstatus IS NULL THEN 'added' WHEN a.o_orderstatus IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM b FULL JOIN a USING (o_orderkey) WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_orderpriority IS DISTINCT FROM b.o_orderpriority
""")
def change_set(t):
    before, after = _snapshots(t)
    c = ["o_orderstatus", "o_orderpriority"]
    return diff.change_set(diff.fingerprints(before, "o_orderkey", c), diff.fingerprints(after, "o_orderkey", c), "o_orderkey")


@query("""SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '"}') AS fingerprint FROM customer""")
def fingerprint(t):
    return diff.fingerprints(t("customer"), "c_custkey", ["c_name", "c_mktsegment", "c_custkey"])


@query("""
SELECT o_orderkey, 'ev_' || left(sha1('{"date":"' || strftime(o_orderdate, '%Y-%m-%d') || '","note":null,"owner":' || o_custkey || ',"role":"' || o_orderstatus || '"}'), 24) AS evidence_id FROM orders
""")
def evidence_ids(t):
    c = {"role": F.col("o_orderstatus"), "date": F.date_format("o_orderdate", "yyyy-MM-dd"), "owner": F.col("o_custkey"), "note": F.lit(None).cast("string")}
    return t("orders").select("o_orderkey", ev.evidence_id(c).alias("evidence_id"))


_LINES = r"""
WITH p AS (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS l FROM documents),
q AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no FROM p),
l AS (SELECT doc_id, CAST(line_no AS INT) AS line_no, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line FROM q WHERE trim(regexp_replace(line, '\s+', ' ', 'g')) <> '')
"""


def _lines(t):
    return lines.document_lines(t("documents", "doc_id", "text").withColumn("page", F.lit(1)), "doc_id", "page", "text")


@query(_LINES + "SELECT doc_id, line_no, md5(list_aggregate(list(line) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING), 'string_agg', ' ')) AS frame FROM l")
def line_frame(t):
    f = lines.frame(_lines(t), ["doc_id", "page"], [F.col("line_no")], "line", 3, 2, "frame")
    return f.select("doc_id", "line_no", F.md5("frame").alias("frame"))


@query(_LINES + r""", w AS (SELECT *, coalesce(list(line) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 15 FOLLOWING), []) AS nxt FROM l),
e AS (SELECT *, list_position(list_transform(nxt, lambda x: regexp_matches(x, '[0-9]{3}')), true) AS ends FROM w)
SELECT doc_id, line_no, md5(left(trim(array_to_string(list_concat([line], CASE WHEN ends > 0 THEN nxt[1:ends - 1] ELSE nxt END), ' ')), 220)) AS name FROM e""")
def forward_frame_name(t):
    f = lines.forward_name(_lines(t), ["doc_id", "page"], [F.col("line_no")], "line", "[0-9]{3}", "name")
    return f.select("doc_id", "line_no", F.md5("name").alias("name"))


@query(_LINES + r""", w AS (SELECT *, lead(line) OVER o AS nxt, lag(line) OVER o AS prev FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
m AS (SELECT *, regexp_extract(coalesce(nxt, ''), '^(The )', 1) AS moved, regexp_extract(line, '^(The )', 1) AS own FROM w),
k AS (SELECT *, CASE WHEN coalesce(regexp_matches(prev, 'e\.$'), false) AND own <> '' THEN trim(regexp_replace(line, '^(The )', '')) ELSE line END AS kept FROM m)
SELECT doc_id, line_no, md5(CASE WHEN regexp_matches(line, 'e\.$') AND moved <> '' THEN kept || moved ELSE kept END) AS line FROM k""")
def split_token_repair(t):
    f = lines.split_token_repair(_lines(t), ["doc_id", "page"], [F.col("line_no")], "line", r"e\.", "The ")
    return f.select("doc_id", "line_no", F.md5("line").alias("line"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM conversations""")
def heading_asof(t):
    h = lines.heading_asof(t("conversations"), ["conv_id"], [F.col("turn")], F.when(F.col("role") == "user", F.col("turn")), "heading")
    return h.select("conv_id", "turn", "heading")


@query("SELECT facet, value, count(*) AS n FROM (SELECT 'lang' AS facet, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents) GROUP BY 1, 2")
def facet_sets(t):
    return aggregate.facets(t("documents", "lang", "source"), ["lang", "source"])


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_by_key(t):
    return resolve.latest_by(t("events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_id", "event_type")


@query("""
SELECT l_partkey, l_suppkey, source_ord FROM (SELECT l_partkey, l_suppkey, l_shipdate, l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS source_ord FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY source_ord, l_shipdate DESC, l_orderkey, l_linenumber) = 1
""")
def best_mapping(t):
    c = ["l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber"]
    li = t("lineitem")
    sides = [li.where("l_returnflag = 'R'").select(*c), li.where("l_returnflag <> 'R'").select(*c)]
    best = resolve.best_mapping(sides, "l_partkey", [F.col("source_ord"), F.col("l_shipdate").desc(), F.col("l_orderkey"), F.col("l_linenumber")])
    return best.select("l_partkey", "l_suppkey", "source_ord")


@query("""
WITH d AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate DESC, l_linenumber) = 1)
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber) AS INT) AS rank FROM d QUALIFY rank <= 8
""")
def topn_evidence(t):
    d = resolve.top_evidence(t("lineitem"), ["l_orderkey"], ["l_partkey"], [F.col("l_shipdate").desc(), F.col("l_linenumber")])
    return d.select("l_orderkey", "l_linenumber", "rank")


@query("SELECT lang, source, doc_id, md5(text) AS text FROM documents WHERE text <> '' AND length(text) <= 5000 QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY length(text) DESC, doc_id) = 1")
def longest_text(t):
    d = resolve.longest_text(t("documents"), ["lang", "source"], "text", "doc_id", 5000)
    return d.select("lang", "source", "doc_id", F.md5("text").alias("text"))


@query("""
SELECT user_id, array_to_string(list_slice(list(event_type ORDER BY f), 1, 3), ',') AS first_types FROM (SELECT user_id, event_type, min(event_id) AS f FROM events GROUP BY ALL) GROUP BY user_id
""")
def ordered_distinct(t):
    d = resolve.ordered_distinct(t("events"), ["user_id"], "event_type", "event_id", 3)
    return d.select("user_id", F.array_join("event_type", ",").alias("first_types"))


@query("""
WITH e AS (SELECT *, min(event_id) OVER (PARTITION BY user_id) AS f, event_type || '-' || CAST(event_id % 7 AS VARCHAR) AS said, repeat('n', CAST(event_id % 9 AS INT)) || user_id AS name FROM events)
SELECT user_id, CASE max(CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END) WHEN 3 THEN 'error' WHEN 2 THEN 'purchase' WHEN 1 THEN 'click' ELSE arg_min(event_type, event_id) END AS event_type,
  bool_or(value > 50) AS big, CASE WHEN max(CASE WHEN length(name) <= 7 THEN length(name) END) > max(CASE WHEN event_id = f THEN length(name) END)
    THEN arg_max(name, {'n': CASE WHEN length(name) <= 7 THEN length(name) ELSE -1 END, 'p': -event_id}) ELSE max(CASE WHEN event_id = f THEN name END) END AS name,
  left(coalesce(string_agg(said, ' | ' ORDER BY event_id) FILTER (event_id % 3 <> 0), ''), 60) AS context, max(CASE WHEN event_id = f THEN value END) AS value FROM e GROUP BY user_id
""")
def merge_rows(t):
    n = F.col("event_id")
    e = t("events").withColumn("big", F.col("value") > 50).withColumn("name", F.concat(F.repeat(F.lit("n"), (n % 9).cast("int")), F.col("user_id").cast("string")))
    e = e.withColumn("context", F.when(n % 3 != 0, F.concat_ws("-", "event_type", (n % 7).cast("string"))))
    return resolve.merge_rows(e, ["user_id"], "event_id", "event_type", ["error", "purchase", "click"], "big", "name", "context", 7, 60, ["value"])


@query("""
WITH o AS (SELECT o_custkey AS k, o_orderkey AS p, CASE WHEN o_totalprice >= 150000 THEN o_orderstatus || repeat('x', CAST(o_orderkey % 5 AS INT)) ELSE '' END AS mode, o_orderpriority = '5-LOW' AS low FROM orders)
SELECT k, coalesce(arg_max(mode, {'n': length(mode), 'p': -p}) FILTER (mode <> ''), '') AS mode, bool_or(low) AS low FROM o GROUP BY 1
""")
def merge_longer(t):
    text = F.when(F.col("o_totalprice") >= 150000, F.concat("o_orderstatus", F.repeat(F.lit("x"), (F.col("o_orderkey") % 5).cast("int"))))
    rows = t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey", text.alias("mode"), (F.col("o_orderpriority") == "5-LOW").alias("low"))
    return resolve.merge_longer(rows, ["k"], "o_orderkey", ["mode"], ["low"])


@query("""
WITH e AS (SELECT o_custkey AS k, o_orderkey AS p, i, v FROM (SELECT o_custkey, o_orderkey, unnest([o_orderpriority, o_orderstatus]) AS v, unnest([0, 1]) AS i FROM orders)),
f AS (SELECT k, v, min({'p': p, 'i': i}) AS seq FROM e GROUP BY 1, 2),
l AS (SELECT k, string_agg(v, '; ' ORDER BY seq) AS agencies FROM f GROUP BY 1)
SELECT o_custkey AS k, max({'n': length(o_orderpriority), 'v': o_orderpriority}).v AS name, agencies, coalesce(arg_min(o_orderstatus, o_orderkey) FILTER (o_orderkey % 3 = 0), '') AS note FROM orders JOIN l ON l.k = o_custkey GROUP BY 1, 3
""")
def merge_baseline(t):
    agencies = F.concat_ws(" ;", "o_orderpriority", "o_orderstatus", F.lit(" "), "o_orderstatus")
    rows = t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey", F.col("o_orderpriority").alias("name"), agencies.alias("agencies"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("note"))
    return resolve.merge_baseline(rows, ["k"], "o_orderkey", ["name"], ["agencies"], ["note"])


@query("""
SELECT c AS class, count(user_id) AS n FROM (SELECT unnest(['click', 'error', 'never', 'other']) AS c) LEFT JOIN (SELECT user_id, CASE WHEN event_type IN ('click', 'error') THEN event_type ELSE 'other' END AS e FROM events) ON e = c GROUP BY 1
""")
def class_totals(t):
    return aggregate.totals_by(t("events"), "event_type", ["click", "error", "never"])


@query("""
WITH g AS (SELECT o_custkey AS k, count(DISTINCT o_orderpriority) AS n, min(upper(o_orderpriority)) AS v FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') GROUP BY 1),
c AS (SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'MACHINERY' THEN 'UNKNOWN' WHEN c_acctbal > 3000 THEN '1-URGENT' ELSE '5-LOW' END AS cur FROM customer WHERE c_nationkey < 20)
SELECT g.k, CASE WHEN n = 1 THEN v END AS value, n AS n_values, CASE WHEN n > 1 THEN 'needsReview' WHEN c.k IS NULL THEN 'pendingCanonicalPhase2' WHEN cur IN ('', 'UNKNOWN') THEN 'ready' WHEN cur = v THEN 'confirmedExisting' ELSE 'needsReview' END AS bucket,
  CASE WHEN n > 1 THEN 'candidate_disagreement' WHEN c.k IS NULL THEN 'no_record' WHEN cur IN ('', 'UNKNOWN') THEN 'blank' WHEN cur = v THEN 'equal' ELSE 'conflicts_with_canonical' END AS reason FROM g LEFT JOIN c USING (k)
""")
def level_gate(t):
    o = t("orders").select(F.col("o_custkey").alias("k"), F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("v"), F.when(F.col("o_orderstatus") == "P", "high").otherwise("medium").alias("sure"))
    cur = F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") == "MACHINERY", "unknown").when(F.col("c_acctbal") > 3000, "1-Urgent").otherwise("5-LOW")
    c = t("customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("k"), cur.alias("cur"))
    return gates.level_gate(o, c, "k", F.col("v"), F.col("sure"), F.col("cur"), ["1-URGENT", "4-NOT SPECIFIED"])


@query("""
WITH m AS (SELECT c_custkey::VARCHAR AS key FROM customer WHERE c_mktsegment = 'BUILDING'),
g AS (SELECT c_custkey::VARCHAR AS key, c_nationkey AS n FROM customer WHERE (c_mktsegment = 'BUILDING' AND c_nationkey <> 3) OR (c_mktsegment = 'MACHINERY' AND c_nationkey = 4))
SELECT 'error' AS severity, 'PRIORITY_COUNT' AS code, '' AS key, (SELECT count(*) FROM m) || ' of 7' AS message, CAST(1 AS BIGINT) AS n
UNION ALL SELECT 'error', 'GUIDANCE_MISSING', key, '', 1 FROM m ANTI JOIN g USING (key)
UNION ALL SELECT 'error', 'GUIDANCE_EXTRA', key, '', 1 FROM g ANTI JOIN m USING (key)
UNION ALL SELECT 'error', 'FIELD_WITHOUT_PROVENANCE', key, 'fee', 1 FROM g WHERE n % 5 = 1
UNION ALL SELECT 'error', 'INCOMPLETE', key, 'fee', 1 FROM g WHERE n % 5 = 2
UNION ALL SELECT 'error', 'INCOMPLETE', key, 'time', 1 FROM g WHERE n % 5 = 3
""")
def priority_set(t):
    n, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    c = t("customer").withColumn("key", F.col("c_custkey").cast("string"))
    told = F.create_map(F.lit("fee"), F.when(n % 5 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("s"))), F.lit("time"), F.array(F.lit("s")))
    g = c.where(((seg == "BUILDING") & (n != 3)) | ((seg == "MACHINERY") & (n == 4))).select("key", F.when(n % 5 != 2, F.array("c_name")).otherwise(F.array().cast("array<string>")).alias("fee"), F.when(n % 5 != 3, F.col("c_name")).alias("time"), told.alias("prov"))
    return validators.priority_set(c, g, "key", seg == "BUILDING", {"fee": F.col("fee"), "time": F.col("time")}, F.col("prov"), 7, True)


@query("SELECT 'c_phone' AS field, c_custkey FROM customer WHERE c_nationkey = 3 UNION ALL SELECT 'c_mktsegment', c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def unresolved_fields(t):
    c = t("customer").select("c_custkey", F.when(F.col("c_nationkey") == 3, "").otherwise("x").alias("c_phone"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    return aggregate.unresolved(c, "c_custkey", ["c_phone", "c_mktsegment"])


@query("""
SELECT p_partkey, CAST(row_number() OVER (ORDER BY lower(p_type), p_name, p_partkey) AS BIGINT) AS ordinal FROM (SELECT p_partkey, p_type, lower(p_name) AS p_name FROM part)
""")
def fold_sort(t):
    """Types with accents and of either case sort like plain ones, equal ones by name."""
    k = F.col("p_partkey")
    kind = F.when(k % 3 == 0, F.upper("p_type")).when(k % 3 == 1, F.translate("p_type", "aeo", "áèö")).otherwise(F.col("p_type"))
    p = t("part").select("p_partkey", kind.alias("kind"), F.when(k % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"))
    return search.ordinal(p, search.fold_order("kind", "name", "p_partkey"), "p_partkey").select("p_partkey", "ordinal")


@query("SELECT p_partkey, CAST(row_number() OVER (ORDER BY lower(p_name), p_name, p_partkey) AS BIGINT) AS ordinal FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS p_name FROM part)")
def case_sort(t):
    p = t("part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"))
    return search.ordinal(p, [*search.case_order("name"), F.col("p_partkey")], "p_partkey").select("p_partkey", "ordinal")


@query(r"""SELECT doc_id, array_to_string(list_distinct_in_order, ',') AS codes, first FROM (
SELECT doc_id, c AS list_distinct_in_order, CASE WHEN len(c) > 0 THEN c[1] ELSE 'none' END AS first FROM (SELECT doc_id, regexp_extract_all(text, '\b\d{3,6}\b') AS c FROM documents))""")
def code_extract(t):
    d = t("documents", "doc_id", "text")
    c = tx.codes(F.col("text"), r"\b\d{3,6}\b")
    return d.select("doc_id", F.array_join(c, ",").alias("codes"), F.coalesce(F.get(c, F.lit(0)), F.lit("none")).alias("first"))


@query(r"""
SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host, page_id % 9 = 0 OR page_id % 9 = 8 AS ok,
  CASE page_id % 9 WHEN 0 THEN 'ward' WHEN 1 THEN 'invalid_host' WHEN 2 THEN 'wrong_province' WHEN 3 THEN 'province_missing_isProvince' WHEN 4 THEN 'province_forced_to_ward' WHEN 5 THEN 'wrong_ward'
    WHEN 6 THEN 'wrong_commune' WHEN 7 THEN 'ward_wrong_isProvince' ELSE 'province' END AS route FROM pages
""")
def url_scope(t):
    kind = F.col("page_id") % 9
    host = F.concat(F.when(kind == 1, "http").otherwise("https"), F.lit("://gate.example/f?id="), F.col("page_id").cast("string"))
    province = F.when(kind == 2, "&provinceCode=30").otherwise("&provinceCode=31")
    rest = F.when(kind == 3, "&isProvince=0").when(kind == 4, "&isProvince=1&ward=").when(kind == 8, "&isProvince=1").when(kind == 5, "&wardCode=2&commune=WARD&isProvince=0").when(kind == 6, "&wardCode=1&isProvince=0").when(kind == 7, "&wardCode=1&commune=WARD").otherwise("&wardCode=1&commune=WARD&isProvince=0")
    u = F.concat(host, province, rest, F.when(kind == 4, "x").otherwise(""))
    level = F.when(kind.isin(3, 4, 8), "Cấp tỉnh").otherwise("Xã")
    return t("pages").select("page_id", urls.host(F.col("url")).alias("host"), F.inline(F.array(urls.scoped_route(u, level, "gate.example", "31", "1"))))


_LINKS = """
WITH c AS (SELECT c_custkey::VARCHAR AS key, c_custkey % 10 AS m, c_nationkey AS n FROM customer),
f AS (SELECT 'with_id' AS kind, '' AS value, key FROM c WHERE n < 20
UNION ALL SELECT 'missing', '', key FROM c WHERE m = 0
UNION ALL SELECT 'invalid', CASE m WHEN 1 THEN 'invalid_host' ELSE 'wrong_ward' END, key FROM c WHERE m IN (1, 2)
UNION ALL SELECT 'route', 'ward', key FROM c WHERE m > 2
UNION ALL SELECT 'mismatch', '', key FROM c WHERE m > 2 AND n < 20 AND (m = 3 OR n < 5)
UNION ALL SELECT 'keyword', 'ward', key FROM c WHERE m > 2 AND n >= 20)
"""


def _links(t):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    m = k % 10
    got = F.when(m == 3, F.lit("other")).otherwise(k.cast("string"))
    u = F.concat(F.when(m == 1, "http").otherwise("https"), F.lit("://gate.example/f?provinceCode=31&commune=WARD&isProvince=0&wardCode="), F.when(m == 2, "2").otherwise("1"), F.when(n < 5, "&q=w").otherwise(F.concat(F.lit("&formalityId="), got)))
    rows, url = tables.spread(t("customer")).withColumn("url", F.when(m > 0, u)), F.col("url")
    return aggregate.link_findings(rows, k, url, urls.scoped_route(url, F.lit("Xã"), "gate.example", "31", "1"), F.when(n < 20, k.cast("string")), urls.param(url, "formalityId"))


@query(_LINKS + "SELECT kind, value, key FROM f")
def link_findings(t):
    return _links(t)


@query(_LINKS + "SELECT kind, value, count(*) AS n FROM f GROUP BY 1, 2")
def link_audit(t):
    return aggregate.link_audit(_links(t))


@query("""
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') THEN 'current' WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'repealed' ELSE 'not_in_current_master' END AS state FROM orders
""")
def state_label_join(t):
    c = t("customer").withColumnRenamed("c_custkey", "o_custkey")
    d = resolve.state_label(t("orders"), "o_custkey", {"current": c.where("c_mktsegment = 'BUILDING'"), "repealed": c.where("c_acctbal < 0")}, "not_in_current_master")
    return d.select("o_orderkey", "state")


@query("""
SELECT p_partkey, CASE WHEN s.k IS NOT NULL THEN 'OVER' ELSE p_brand END AS p_brand, s.k IS NOT NULL AND p_brand <> 'OVER' AS changed FROM part LEFT JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity >= 50) s ON k = p_partkey
""")
def override_join(t):
    o = t("lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("p_brand", F.lit("OVER"))
    return resolve.override(t("part"), ["p_partkey"], o, ["p_brand"]).select("p_partkey", "p_brand", "changed")


@query("""
SELECT p_partkey, coalesce(nullif(CASE WHEN p_size < 10 THEN '' ELSE p_brand END, ''), m.b, '') AS p_brand FROM part LEFT JOIN (SELECT l_partkey AS k, min(l_returnflag) AS b FROM lineitem GROUP BY 1) m ON k = p_partkey
""")
def fill_join(t):
    m = t("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_returnflag").alias("p_brand"))
    p = t("part").withColumn("p_brand", F.when(F.col("p_size") < 10, "").otherwise(F.col("p_brand")))
    return resolve.fill(p, ["p_partkey"], m, ["p_brand"]).select("p_partkey", "p_brand")


@query("""
SELECT c_custkey, CASE WHEN n = 1 THEN d END AS agreed FROM customer LEFT JOIN (SELECT o_custkey, count(DISTINCT o_orderstatus) AS n, min(o_orderstatus) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey
""")
def dates_agree(t):
    c = t("customer", "c_custkey").withColumn("agreed", F.lit(""))
    o = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return resolve.fill_agreed(c, "c_custkey", "agreed", o, "o_orderstatus").select("c_custkey", "agreed")


@query("SELECT doc_id, 'left_only' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right_only' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def drift(t):
    return diff.drift(t("documents"), t("labels"), "doc_id")


@query("""
SELECT count(*) FILTER (n IS NOT NULL AND b.k IS NOT NULL) AS matched, count(*) FILTER (n IS NULL) AS missing, count(*) FILTER (b.k IS NULL) AS extra, count(*) FILTER (n > 1) AS duplicates, false AS exact
FROM (SELECT doc_id AS k, count(*) AS n FROM documents GROUP BY 1) a FULL JOIN (SELECT DISTINCT item_id AS k FROM benchmark) b USING (k)
""")
def exact_set_check(t):
    return diff.exact_set(t("documents").select(F.col("doc_id").alias("k")), t("benchmark").select(F.col("item_id").alias("k")), "k")


@query("""
SELECT 'error' AS severity, 'NEGATIVE' AS code, count(*) AS n FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0
UNION ALL SELECT 'warning', 'BAD_ENUM', count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') HAVING count(*) > 0
UNION ALL SELECT 'error', 'FORMAT', count(*) FROM customer WHERE NOT regexp_matches(c_name, '[02468]$') HAVING count(*) > 0
""")
def findings(t):
    rules = [
        expect.Rule("NEGATIVE", F.col("c_acctbal") < 0, "balance"),
        expect.Rule("BAD_ENUM", ~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment"), "warning"),
        expect.matches("c_name", "[02468]$"),
    ]
    return expect.rule_counts(expect.findings(t("customer"), "c_custkey", rules))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, (c_acctbal < 0)::BIGINT + (c_mktsegment = 'BUILDING')::BIGINT AS n, (c_acctbal < 0)::BIGINT AS errors,
  CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'NEGATIVE,SEGMENT' WHEN c_acctbal < 0 THEN 'NEGATIVE' ELSE 'SEGMENT' END AS codes FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'
""")
def review_queue(t):
    rules = [expect.Rule("NEGATIVE", F.col("c_acctbal") < 0), expect.Rule("SEGMENT", F.col("c_mktsegment") == "BUILDING", "", "warning")]
    return expect.review_queue(expect.findings(t("customer"), "c_custkey", rules))


@query("""
SELECT field, count(*) FILTER (value <> '') AS filled, count(*) FILTER (coalesce(value, '') = '') AS blank FROM (
SELECT 'props' AS field, props AS value FROM events UNION ALL SELECT 'event_type', event_type FROM events UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events) GROUP BY 1
""")
def coverage_unpivot(t):
    return aggregate.coverage(t("events"), "event_id", ["props", "event_type", "user_id"])


@query("SELECT lang, count(*) FILTER (source = 'src0') AS src0, count(*) FILTER (source = 'src1') AS src1 FROM documents GROUP BY 1")
def status_crosstab(t):
    return aggregate.crosstab(t("documents"), "lang", "source", ["src0", "src1"])


@query("""
SELECT CASE token WHEN 'purchase' THEN 'buy' ELSE token END AS token, count(*) AS n FROM (SELECT trim(unnest(string_split(event_type || ';' || CASE WHEN value > 50 THEN 'big' ELSE '' END, ';'))) AS token FROM events) WHERE token <> '' GROUP BY 1
""")
def counter_split(t):
    text = F.concat_ws(";", "event_type", F.when(F.col("value") > 50, "big").otherwise(""))
    return aggregate.split_counter(t("events"), text, ";", {"purchase": "buy"})


@query("""
SELECT lang, source, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS INT) AS place FROM (SELECT lang, source, count(DISTINCT doc_id) AS n FROM documents GROUP BY 1, 2)
""")
def grouped_counter(t):
    return aggregate.grouped_counter(t("documents"), "lang", "source", "doc_id")


@query("""
SELECT r_name, n_name, count(*) AS n, sum(c_custkey) AS total, CAST(grouping(r_name) * 2 + grouping(n_name) AS INT) AS level FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)
""".replace("sum(c_custkey)", "CAST(sum(c_custkey) AS BIGINT)"))
def additive_rollup(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return aggregate.additive(c, "r_name", "n_name", F.col("c_custkey"))


@query("SELECT doc_id FROM documents WHERE contains(lower(strip_accents(text)), 'elle la') AND lang = 'fr'")
def facet_search(t):
    return search.facet_filter(t("documents"), {"lang": "fr"}, [], "Éllé LA", ["text"]).select("doc_id")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_mktsegment, c_name, c_custkey LIMIT 30 OFFSET 30")
def page(t):
    return search.page(t("customer"), [F.col("c_mktsegment"), F.col("c_name"), F.col("c_custkey")], 2).select("c_custkey", "c_name")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS ordinal FROM orders")
def ordinal(t):
    return search.ordinal(t("orders", "o_orderkey", "o_orderpriority"), [F.col("o_orderpriority"), F.col("o_orderkey")], "o_orderkey").select("o_orderkey", "ordinal")


@query("""
WITH e AS (SELECT c_custkey AS k, c_mktsegment AS seg, CASE WHEN c_acctbal < 0 THEN 'kept by hand' ELSE '' END AS remark, 'active' AS status FROM customer),
p AS (SELECT o_custkey AS k, 'SEG' AS seg, 'projected' AS remark, 'active' AS status FROM orders GROUP BY o_custkey)
SELECT k, CASE WHEN p.seg IS NOT NULL THEN p.seg ELSE e.seg END AS seg, CASE WHEN p.seg IS NOT NULL THEN 'active' ELSE 'held' END AS status,
  CASE WHEN p.seg IS NULL THEN trim(e.remark || ' [gone]') WHEN e.seg IS NOT NULL THEN e.remark ELSE p.remark END AS remark, CASE WHEN e.seg IS NULL THEN 'insert' WHEN p.seg IS NULL THEN 'hold' WHEN e.seg <> 'SEG' THEN 'update' ELSE 'keep' END AS action
FROM e FULL JOIN p USING (k)
""")
def read_model_upsert(t):
    remark = F.when(F.col("c_acctbal") < 0, "kept by hand").otherwise("")
    e = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.lit("active").alias("status"), remark.alias("remark"))
    p = t("orders").select(F.col("o_custkey").alias("k")).distinct().select("k", F.lit("SEG").alias("seg"), F.lit("active").alias("status"), F.lit("projected").alias("remark"))
    return readmodel.upsert(e, p, "k", ["seg", "status"], ["remark"], "status", "held", "[gone]", "remark").select("k", "seg", "status", "remark", "action")


@query("""
WITH d AS (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY))::DATE AS day FROM events), s AS (SELECT ts::DATE AS day, list_distinct(list(event_type)) AS seen FROM events WHERE value > 90 GROUP BY 1)
SELECT strftime(d.day, '%Y-%m-%d') AS day, CASE WHEN d.day > DATE '2024-07-01' THEN 'NOT_DUE' WHEN seen IS NULL THEN 'STOPPED_SILENTLY' WHEN list_contains(seen, 'purchase') THEN 'HEALTHY' WHEN list_contains(seen, 'view') THEN 'STOPPED_LOUDLY'
  WHEN list_contains(seen, 'signup') THEN 'PAUSED' WHEN list_contains(seen, 'error') THEN 'STOPPED_LOUDLY' WHEN list_contains(seen, 'click') THEN 'RUNNING' ELSE 'STOPPED_LOUDLY' END AS verdict FROM d LEFT JOIN s USING (day)
""")
def run_health(t):
    e = t("events")
    kinds = F.create_map(*[F.lit(x) for x in ("purchase", "ok", "view", "duplicate_skip", "signup", "paused", "error", "failed")])
    record = F.try_element_at(kinds, F.col("event_type"))
    h = runs.health(e.where("value > 90"), runs.calendar(e, "ts"), "ts", record, F.col("event_type") == "click", 12, F.lit("2024-07-01 13:00:00").cast("timestamp"))
    return h.withColumn("day", F.col("day").cast("string"))


@query("""
WITH w AS (SELECT o_custkey, o_orderdate::DATE AS d, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC, o_orderkey) AS r FROM orders)
SELECT a.o_custkey, a.o_orderkey, count(b.o_orderkey) > 0 AS conflict FROM w a LEFT JOIN w b ON a.o_custkey = b.o_custkey AND b.r > 1 AND a.d = b.d AND a.o_orderstatus <> b.o_orderstatus WHERE a.r = 1 GROUP BY ALL
""")
def conflicts(t):
    o = t("orders").withColumn("d", F.to_date("o_orderdate"))
    c = resolve.conflicts(o, ["o_custkey"], [F.col("d").desc(), F.col("o_orderkey")], ["d"], ["o_orderstatus"])
    return c.select("o_custkey", "o_orderkey", "conflict")


@query("""
WITH h AS (SELECT o_custkey AS k, o_orderpriority AS hint FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
g AS (SELECT o_custkey AS k, min(o_orderpriority) AS lo, count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
r AS (SELECT c_custkey AS k, c_mktsegment AS label, hint, lo, n FROM customer LEFT JOIN h ON h.k = c_custkey LEFT JOIN g ON g.k = c_custkey)
SELECT k, coalesce(hint, CASE WHEN n = 1 THEN lo END, label) AS level, CASE WHEN hint IS NOT NULL THEN 'hint' WHEN n = 1 THEN 'table' ELSE 'label' END AS level_source,
  coalesce(coalesce(hint, CASE WHEN n = 1 THEN lo END) <> label, false) AS conflict, coalesce(hint, CASE WHEN n = 1 THEN lo END, label) IN ('1-URGENT', 'BUILDING') AS in_scope, coalesce(n > 1, false) AND hint IS NULL AS ambiguous FROM r
""")
def reconcile_levels(t):
    m = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label"))
    o = t("orders").withColumnRenamed("o_custkey", "k")
    h = o.where("o_orderstatus = 'F'").withColumnRenamed("o_orderpriority", "hint")
    g = o.where("o_orderstatus = 'P'").select("k", F.col("o_orderpriority").alias("level"))
    return reconcile.levels(m, "k", h, g, "label", ["1-URGENT", "BUILDING"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("""
WITH a AS (SELECT user_id, max(CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END) AS d, count(*) FILTER (event_type = 'error') > count(*) FILTER (event_type = 'signup') AS bad FROM events GROUP BY 1),
c AS (SELECT user_id, CASE WHEN bad THEN 'repealed' ELSE 'current' END AS s, d FROM a), v AS (SELECT user_id, max(strftime(ts, '%Y-%m-%d')) AS v, bool_or(event_type = 'error' AND value > 80) AS r FROM events WHERE value > 60 GROUP BY 1),
x AS (SELECT *, coalesce(d, '') AS d0, CASE WHEN v IS NULL THEN 'keep' WHEN r AND s = 'current' AND coalesce(d, '') > v THEN 'ignore_repeal' WHEN r THEN 'repeal' WHEN s = 'repealed' AND coalesce(d, '') >= v THEN 'ignore_current' WHEN s IS NULL OR s <> 'current' THEN 'add' ELSE 'annotate' END AS action FROM c FULL JOIN v USING (user_id))
SELECT user_id, CASE action WHEN 'repeal' THEN 'repealed' WHEN 'add' THEN 'current' ELSE s END AS state, CASE WHEN action IN ('repeal', 'add', 'annotate') THEN greatest(d0, v) ELSE d END AS d, action FROM x
""")
def merge_verified(t):
    e = t("events")
    bad = F.count_if(F.col("event_type") == "error") > F.count_if(F.col("event_type") == "signup")
    c = e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") != "error", _day())).alias("d"), F.when(bad, "repealed").otherwise("current").alias("state"))
    v = e.where("value > 60").groupBy("user_id").agg(F.max(_day()).alias("d"), F.bool_or((F.col("event_type") == "error") & (F.col("value") > 80)).alias("r"))
    return replay.merge_verified(c, v, "user_id", "d", F.col("r"))


@query("""
WITH e AS (SELECT p_partkey AS k, p_brand AS name, 0 AS o FROM part WHERE p_size > 40), c AS (SELECT l_partkey AS k, min(l_returnflag) AS name, 1 AS o FROM lineitem GROUP BY 1),
s AS (SELECT k, name FROM (SELECT * FROM e UNION ALL SELECT * FROM c) QUALIFY row_number() OVER (PARTITION BY k ORDER BY o) = 1),
x AS (SELECT l_partkey AS k, CAST(max(l_suppkey) AS VARCHAR) AS agency FROM lineitem WHERE l_quantity > 25 GROUP BY 1)
SELECT p_partkey AS k, s.name, x.agency, CASE WHEN p_size > 20 THEN p_type ELSE p_brand END AS legal, array_to_string(list_filter([CASE WHEN s.name IS NULL THEN 'name' END, CASE WHEN x.agency IS NULL THEN 'agency' END], lambda v: v IS NOT NULL), ',') AS missing
FROM part LEFT JOIN s ON s.k = p_partkey LEFT JOIN x ON x.k = p_partkey
""")
def materialised(t):
    p, li = t("part"), t("lineitem").withColumnRenamed("l_partkey", "k")
    sources = [p.where("p_size > 40").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("name")), li.groupBy("k").agg(F.min("l_returnflag").alias("name"))]
    x = li.where("l_quantity > 25").groupBy("k").agg(F.max("l_suppkey").cast("string").alias("agency"))
    legal = p.select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("base"), F.when(F.col("p_size") > 20, F.col("p_type")).alias("own"))
    times = p.select(F.col("p_partkey").alias("k"), F.lit("").alias("time"))
    m = materialise.materialise(p.select(F.col("p_partkey").alias("k")), "k", sources, x, legal, times, ["name"])
    return m.select("k", "name", "agency", "legal", F.array_join("missing", ",").alias("missing"))


@query("""
WITH t AS (SELECT o_orderkey, o_orderpriority, o_custkey, EXISTS (SELECT 1 FROM customer WHERE c_acctbal < 0 AND c_custkey IN (o_custkey, o_orderkey)) AS has, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r FROM orders)
SELECT o_orderpriority, count(*) AS tasks, count(*) FILTER (has) AS with_basis, string_agg(CASE WHEN r <= 6 THEN CAST(o_custkey AS VARCHAR) END, '; ' ORDER BY r) AS names FROM t GROUP BY 1
""")
def digest(t):
    o = t("orders").withColumn("name", F.col("o_custkey").cast("string"))
    return materialise.digest(o, t("customer").where("c_acctbal < 0"), ["o_custkey", "o_orderkey"], "c_custkey", "o_orderpriority", "name", "o_orderkey")


@query("""
SELECT event_id, CASE WHEN user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 90) THEN 'current' WHEN x.m = 'E' THEN 'repealed' WHEN x.m = 'D' THEN 'future_effective' ELSE 'not_in_current_master' END AS state
FROM events LEFT JOIN (SELECT user_id, max(CASE event_type WHEN 'error' THEN 'E' WHEN 'click' THEN 'D' END) AS m FROM events WHERE value > 98 GROUP BY 1) x USING (user_id)
""")
def tracking(t):
    e = t("events")
    states = {"error": "repealed", "click": "future_effective"}
    return materialise.tracking(e, "user_id", e.where("event_type = 'signup' AND value > 90"), e.where("value > 98").withColumnRenamed("event_type", "reason"), states).select("event_id", "state")


@query("""
SELECT c_custkey, coalesce(o.r, CASE n_regionkey WHEN 0 THEN 'free' WHEN 1 THEN 'half' END) AS rule FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, 'own' AS r FROM orders WHERE o_totalprice > 400000 GROUP BY 1) o ON o_custkey = c_custkey
""")
def rule_lookup(t):
    types = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey")
    rules = t("region").select(F.col("r_regionkey").alias("n_regionkey"), F.when(F.col("r_regionkey") == 0, "free").when(F.col("r_regionkey") == 1, "half").alias("rule"))
    own = t("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"), F.lit("own").alias("rule")).distinct()
    return resolve.rule_flag(t("customer", "c_custkey"), "c_custkey", "n_regionkey", types, rules, own).select("c_custkey", "rule")


@query("""
SELECT c_custkey, c_nationkey, coalesce((lag(c_acctbal) OVER w + c_acctbal) / 2, c_acctbal + 58) AS top, coalesce((lead(c_acctbal) OVER w + c_acctbal) / 2, c_acctbal - 58) AS bottom FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)
""".replace("coalesce((lag", "round(coalesce((lag").replace("+ 58) AS top", "+ 58), 3) AS top").replace("coalesce((lead", "round(coalesce((lead").replace("- 58) AS bottom", "- 58), 3) AS bottom"))
def cell_bounds(t):
    b = lines.cell_bounds(t("customer"), ["c_nationkey"], "c_acctbal", ties=["c_custkey"])
    return b.select("c_custkey", "c_nationkey", F.round("top", 3).alias("top"), F.round("bottom", 3).alias("bottom"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'needs_text' WHEN coalesce(props, '') = '' THEN 'needs_field_review' WHEN strftime(ts, '%Y-%m-%d') > '2024-07-01' THEN 'future_effective' ELSE 'current' END AS state FROM events
""".replace("CASE WHEN event_type = 'view' THEN 'needs_text' WHEN coalesce(props, '') = '' THEN 'needs_field_review'", "CASE WHEN coalesce(props, '') = '' THEN 'needs_field_review' WHEN event_type = 'view' THEN 'view'"))
def event_states(t):
    return t("events").select("event_id", replay.event_state(F.col("event_type"), _day(), F.lit(AS_OF), F.col("props"), ["view"]).alias("state"))


@query("""
SELECT user_id, coalesce(s, w, 'other') AS domain FROM (SELECT user_id, arg_max(CASE WHEN event_type = 'purchase' THEN 'shop' WHEN event_type = 'signup' THEN 'join' END, event_id) FILTER (event_type IN ('purchase', 'signup')) AS s,
  arg_max('err', event_id) FILTER (event_type = 'error') AS w FROM events GROUP BY 1)
""")
def domain(t):
    e = t("events").withColumn("e", F.array(F.struct(F.lpad(F.col("event_id").cast("string"), 12, "0").alias("date"), F.col("event_type").alias("url"), F.col("event_type").alias("title"))))
    return classify.domain(e, "user_id", F.lit(None).cast("string"), "e", [("purchase", "shop"), ("signup", "join")], [("err", ["error"])], "other")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, o_custkey LIMIT 50")
def several_candidates(t):
    return aggregate.several(t("orders"), "o_custkey")


@query("""
SELECT event_type, arg_min(props, event_id) AS props, count(*) AS n FROM events GROUP BY 1
""")
def first_and_count(t):
    return aggregate.first_and_count(t("events"), "event_type", "props", "event_id")


@query()
def similarity(t):
    p = t("part", "p_partkey", "p_name", "p_type")
    return p.select("p_partkey", tx.similarity(F.col("p_name"), F.col("p_type")).alias("similarity"))


#: A page's lines by patterns alone: hidden elements and comments out, tags to line ends or spaces, entities (as in browsers also
#: without their semicolon), blanks.
_LINES = r"""
WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '\s+', ' ', 'g'), '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<!DOCTYPE[^>]*>', '', 'g'), '<[^>]*$', '') AS h FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(h, '</?(p|div|section|article|header|footer|main|aside|li|br|h[1-6]|tr|table)( [^>]*)?>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS h FROM a),
c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '&copy;?', chr(169), 'g'), '&middot;?', chr(183), 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS h FROM b),
d AS (SELECT page_id, list_filter(list_transform(string_split_regex(h, '[\n\r]'), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), lambda x: x <> '') AS lines FROM c)
"""


@query(_LINES + """SELECT page_id, md5('Cách thức Thời hạn' || chr(10) || page_id || ' ngày' || chr(10) || array_to_string(lines, chr(10))) AS body, CASE page_id % 2 WHEN 0 THEN 1 ELSE 0 END AS n_tables FROM d""")
def html_blocks(t):
    """Pages with a table in front; of odd ones it stands outside any table element."""
    k = F.col("page_id").cast("string")
    rows = F.concat(F.lit("<tr><th>Cách  thức</th><th>Thời hạn</th></tr><tr><td></td></tr><tr><td><b>"), k, F.lit("</b> ngày</td></tr>"))
    front = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<TABLE class=x>"), rows, F.lit("</TABLE>"))).otherwise(rows)
    pages = t("pages").withColumn("html", F.concat(front, "html"))
    return web.blocks(pages, "page_id", "html").select("page_id", F.md5("body").alias("body"), F.size("tables").alias("n_tables"))


@query("""
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'Trực tiếp=' || page_id || ' ngày;Không xác định=3 ngày(ghi)' WHEN 1 THEN 'Trực tiếp=' || page_id || ' ngày' ELSE '' END AS times,
  CASE page_id % 3 WHEN 0 THEN 'Trực tiếp=5.000' WHEN 1 THEN 'not_listed_on_dvcqg' ELSE '' END AS fees,
  CASE page_id % 3 WHEN 2 THEN '' ELSE 'Tờ khai|M1|1|2;Giấy ' || page_id || '|||' END AS papers FROM pages
""")
def table_cells(t):
    k = F.col("page_id").cast("string")
    row = lambda *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c if not isinstance(c, str) else F.lit(c), F.lit("</td>")) for c in cells], F.lit("</tr>"))
    table = lambda *rows: F.concat(F.lit("<table>"), *rows, F.lit("</table>"))
    head, day = row("Hình thức NỘP", "Thời hạn giải quyết", "Phí, lệ phí", "Mô tả"), F.concat(k, F.lit("  ngày"))
    full = table(row("x"), head, row("Trực tiếp", day, "5.000"), row("Trực tiếp", day, "5.000", ""), row("", "3 ngày", "", "ghi"))
    bare = table(head, row("Trực tiếp", day))
    papers = table(row("Tên giấy tờ", "Mẫu đơn, tờ khai", "Số lượng"), row("Tờ khai", "M1", "Bản chính: 1 Bản sao:2"), row("TEN GIAY TO"), row("", "M2"), row("tờ KHAI", "m1"), row(F.concat(F.lit("Giấy "), k)))
    m = F.col("page_id") % 3
    html = F.when(m == 0, F.concat(full, papers)).when(m == 1, F.concat(papers, bare)).otherwise(table(row("a", "b")))
    cut = web.blocks(t("pages", "page_id").withColumn("html", html), "page_id", "html")
    p, given = cells.process(F.col("tables")), lambda x: F.coalesce(x, F.lit(""))
    note = lambda x: F.when(x.isNotNull(), F.concat(F.lit("("), x, F.lit(")"))).otherwise("")
    times = F.transform(p["times"], lambda x: F.concat(x["channel"], F.lit("="), x["time"], note(x["note"])))
    fees = F.transform(p["fees"], lambda x: F.coalesce(x["status"], F.concat(x["channel"], F.lit("="), x["fee"])))
    told = F.transform(cells.dossier(F.col("tables")), lambda x: F.concat(x["name"], F.lit("|"), given(x["form"]), F.lit("|"), given(x["original"]), F.lit("|"), given(x["copy"])))
    return cut.select("page_id", F.array_join(times, ";").alias("times"), F.array_join(fees, ";").alias("fees"), F.array_join(told, ";").alias("papers"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 'Tên riêng' WHEN p_partkey % 7 = 1 THEN 'Cấp giấy ' || p_name WHEN p_partkey % 7 = 2 THEN 'Cấp giấy ' || p_name WHEN p_partkey % 7 = 3 THEN 'đi a ' || p_name WHEN p_partkey % 7 = 4 THEN 'é ' || p_name ELSE p_name END AS name,
  CASE WHEN p_partkey % 7 = 5 THEN 'only_control' WHEN p_partkey % 7 = 6 THEN 'control_character' END AS fault FROM part
""")
def repaired_names(t):
    """Names with words split by a scan, other columns run in, decomposed letters, control marks."""
    m, n = F.col("p_partkey") % 7, F.col("p_name")
    raw = F.when(m == 1, F.concat(F.lit("C ấp  giấy "), n, F.lit(" - Thời hạn 5 ngày"))).when(m == 2, F.concat(F.lit("\x07 "), F.lit("C ấp giấy "), n, F.lit(";\x07x"))).when(m == 3, F.concat(F.lit("d i a "), n)).when(m == 4, F.concat(F.lit("e\u0301 "), n, F.lit(" -"))).otherwise(n)
    title = F.when(m == 5, "\x07 \x07").when(m == 6, "a\x01b").otherwise(n)
    pairs = [("C ấp", "Cấp"), ("d i", "đ i"), ("đ i", "đi"), ("Cấp giấy x", "y")]
    over = F.create_map(F.lit(0), F.lit("Tên riêng"))
    name = tx.repaired_name(raw, F.col("p_partkey") % 50, pairs, catalogue.NAME_BLEED, over)
    return t("part").select("p_partkey", name.alias("name"), tx.cleaned_title(title, catalogue.TITLE_WORDS)["fault"].alias("fault"))


def _scratch(spark: SparkSession, name: str) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        tables.kept(spark.range(1))  # sets one
        folder = spark.conf.get("spark.checkpoint.dir")
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex}")


def _sliced(spark: SparkSession, events: DataFrame, path: str, slices: int = 3) -> int:
    """The events as files of a stream: slices of time, out of order by up to 50 minutes, then its end.

    Returns the files of the largest slice: micro-batches of as many files take no slice in three, so no event of a slice is
    behind the watermark that the first of it has set.
    """
    late = F.pmod(F.xxhash64("event_id"), F.lit(50)) * 60
    first, last = events.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    width = max(1, -(-((last or 0) - (first or 0) + 3001) // slices))
    files = [0]
    for i in range(slices):
        arrives = F.floor((F.unix_seconds("ts") + late - (first or 0)) / width)
        events.where(arrives == i).write.mode("append").parquet(path)
        files.append(len(spark.read.schema(events.schema).parquet(path).inputFiles()))
    streams.close_stream(events.schema, spark, "user_id", "ts").write.mode("append").parquet(path)
    return max(b - a for a, b in zip(files, files[1:], strict=False))


def _stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.parquet(spark, sf_dir, "events")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    source = _scratch(spark, "stream-in")
    files = _sliced(spark, events, source)
    before = spark.conf.get(streams.STATE_STORE[0])
    spark.conf.set(*streams.STATE_STORE)
    try:
        stream = streams.replay_stream(streams.file_stream(spark, source, events.schema, max(1, files)), "user_id", "ts", "event_id", _kind(), "1 hour", 7 * 86_400)
        out = streams.run_available(stream, _scratch(spark, "stream-out"), _scratch(spark, "stream-state"))
    finally:
        spark.conf.set(streams.STATE_STORE[0], before)
    return streams.latest_states(out).select(F.col("key").alias("user_id"), "state", "n_reviews", "n_updates")


QUERIES["stream_replay"] = _stream_replay
ORACLES["stream_replay"] = _REPLAY + "SELECT user_id, CASE WHEN pub THEN 'current' WHEN fut THEN 'future_effective' WHEN gone IS NOT NULL THEN 'repealed' ELSE 'unknown' END AS state, n_reviews, n_updates FROM s"


def _stream_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of three days: a user is a source, an event type of theirs a url, a purchase carries a decision number."""
    e = tables.parquet(spark, sf_dir, "events")
    e = e.withColumn("n", F.col("user_id") % 3).select("user_id", "event_type", "n").distinct()
    number = F.when(F.col("event_type") == "purchase", F.concat((F.col("user_id") % 40).cast("string"), F.lit("/Q"))).otherwise("")
    url, text = F.concat_ws("/", "user_id", "event_type"), F.lit("").cast("string")
    columns = {"source": (F.col("user_id") % 7).cast("string"), "url": url, "number": number, "class": F.when(F.col("event_type").isin("purchase", "error"), "public_tthc").otherwise("non_tthc"), "pdf": F.lit("p")}
    links = e.select("n", *[columns.get(c, text).alias(c) for c in discovery.LINKS.fieldNames()])
    source = _scratch(spark, "stream-in")
    for i in range(3):  # each day lists what came before again
        links.where(F.col("n") <= i).drop("n").coalesce(1).write.mode("append").parquet(source)
    state = Versions(spark, _scratch(spark, "stream-state"), discovery.STATE)
    streams.discovery_batches(streams.file_stream(spark, source, discovery.LINKS, 1), state, _scratch(spark, "stream-checkpoint")).awaitTermination()
    return state.read().where("kind = 'url'").select("source", "url", "number", "class", "status")


QUERIES["stream_discovery"] = _stream_discovery
ORACLES["stream_discovery"] = """
WITH e AS (SELECT DISTINCT user_id, event_type, user_id % 3 AS n, (user_id % 7)::VARCHAR AS source, user_id || '/' || event_type AS url, CASE WHEN event_type = 'purchase' THEN (user_id % 40) || '/Q' ELSE '' END AS number FROM events),
b AS (SELECT source, min(n) AS first_day FROM e GROUP BY 1),
a AS (SELECT e.*, n = first_day AS base FROM e JOIN b USING (source)),
d AS (SELECT number, min({'n': n, 'u': url}) AS added FROM a WHERE number <> '' AND NOT base GROUP BY 1)
SELECT source, url, number, CASE WHEN base THEN 'baseline_only' WHEN event_type NOT IN ('purchase', 'error') THEN 'non_tthc' WHEN event_type = 'error' THEN 'needs_review' WHEN d.added.u = url THEN 'public_tthc' ELSE 'mirror_known_decision' END AS class,
  CASE WHEN base THEN 'baseline_only' WHEN event_type NOT IN ('purchase', 'error') THEN 'excluded_non_tthc' WHEN event_type = 'error' THEN 'missing_decision_number' WHEN d.added.u = url THEN 'auto_discovered' ELSE 'known_decision_new_listing_url' END AS status
FROM a LEFT JOIN d USING (number)
"""


def _stream_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of three days as projections of their customers: manual columns stay, customers who are gone are held."""
    o = tables.parquet(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("k"), F.col("o_orderpriority").alias("name"), F.lit("ok").alias("status"), F.lit("").alias("note"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus")).otherwise("").alias("mine"), F.col("o_orderkey").alias("at"))
    source = _scratch(spark, "stream-in")
    for i in range(3):
        o.where(F.col("k").cast("long") % 5 >= i).where(F.col("at") % 3 == i).coalesce(1).write.mode("append").parquet(source)
    kinds = {"model": "k string, name string, status string, note string, mine string", "log": "k string, action string, before string, after string, batch long"}
    model, log = (Versions(spark, _scratch(spark, n), StructType.fromDDL(k)) for n, k in kinds.items())
    merge = lambda now, new: readmodel.upsert(now, new, "k", ["name", "status", "note"], ["mine"], "status", "held", "[gone]", "note")
    streams.upsert_batches(streams.file_stream(spark, source, o.schema, 1), model, log, "k", "at", merge, _scratch(spark, "stream-checkpoint")).awaitTermination()
    changes = log.read().groupBy("k").agg(F.count("*").alias("n_changes"))
    return model.read().join(changes, "k")


QUERIES["stream_upserts"] = _stream_upserts
ORACLES["stream_upserts"] = """
WITH o AS (SELECT o_custkey::VARCHAR AS k, o_orderpriority AS name, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus ELSE '' END AS mine, o_orderkey AS nr, o_orderkey % 3 AS d FROM orders),
h AS (SELECT DISTINCT k, k::BIGINT % 5 AS h FROM o),
l AS (SELECT k, d, max_by(name, nr) AS name, max_by(mine, nr) AS mine FROM o JOIN h USING (k) WHERE h >= d GROUP BY 1, 2),
f AS (SELECT k, min(d) AS first, max(d) AS last, min_by(mine, d) AS mine, max_by(name, d) AS name FROM l GROUP BY 1),
s AS (SELECT f.k, x.d, y.name AS name, y.k IS NOT NULL AS here FROM f CROSS JOIN (SELECT unnest([0, 1, 2]) AS d) x LEFT JOIN l y ON y.k = f.k AND y.d = x.d WHERE x.d >= f.first),
t AS (SELECT s.*, f.first, last_value(CASE WHEN here THEN s.name END IGNORE NULLS) OVER (PARTITION BY s.k ORDER BY d ROWS UNBOUNDED PRECEDING) AS held, lag(here) OVER (PARTITION BY s.k ORDER BY d) AS was FROM s JOIN f ON f.k = s.k),
u AS (SELECT *, lag(held) OVER (PARTITION BY k ORDER BY d) AS before FROM t)
SELECT f.k, f.name, CASE WHEN here THEN 'ok' ELSE 'held' END AS status, CASE WHEN here THEN '' ELSE '[gone]' END AS note, f.mine,
  (SELECT count(*) FROM u v WHERE v.k = f.k AND (v.d = v.first OR NOT v.here OR NOT v.was OR v.held <> v.before)) AS n_changes
FROM f JOIN u ON u.k = f.k AND u.d = 2
"""
