"""Queries over the test tables for rules, sources and fills, with their DuckDB SQL."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from .functions import urls
from .operators import aggregate, classify, diff, expect, gates, materialise, readmodel, reconcile, replay, resolve, search, projection
from .plans import curation
from .queries import query
from .sources import tables
from .streaming import streams


def _place(df, name: str) -> str:
    """A new path in the folder all machines share."""
    return os.path.join(tables.shared_folder(df.sparkSession), f"{name}-{uuid.uuid4().hex}")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def csv_round_trip(t):
    c = t("customer").select("c_custkey", "c_name", "c_mktsegment")
    path = _place(c, "csv")
    tables.write_csv(c, path)
    return tables.csv(c.sparkSession, path, c.schema)


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority FROM orders")
def compact_round_trip(t):
    o = t("orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"))
    path = _place(o, "compact")
    tables.write_compact(o, path)
    return tables.records(o.sparkSession, path, o.schema, "*.txt", lines=True)


@query("SELECT n_regionkey AS region, n_nationkey AS nation, n_name AS name FROM nation")
def nested_rows(t):
    n = t("nation")
    one = n.groupBy(F.col("n_regionkey").alias("region")).agg(F.collect_list(F.struct(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))).alias("rows"))
    path = _place(n, "json")
    tables.write_json(one, path)
    doc = n.sparkSession.read.schema(one.schema).json(path)
    return tables.snippets(doc, "rows", ["region"]).drop("pos")


@query("SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def keyed_scan(t):
    wanted = t("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return tables.keyed(t("lineitem").select("l_orderkey", "l_returnflag"), wanted, "l_orderkey", ["l_orderkey", "l_returnflag"])


@query("SELECT count(*) AS rows, count(*) FILTER (c_acctbal < 0) AS debtors, count(*) FILTER (c_mktsegment = 'BUILDING') AS builders FROM customer")
def conditional_counts(t):
    return aggregate.summary(t("customer"), {"rows": F.lit(True), "debtors": F.col("c_acctbal") < 0, "builders": F.col("c_mktsegment") == "BUILDING"})


@query("SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS pending FROM orders")
def distinct_counts(t):
    return aggregate.distinct_summary(t("orders"), "o_custkey", {"customers": F.lit(True), "pending": F.col("o_orderstatus") == "P"})


@query("""
WITH e AS (SELECT user_id, event_id, event_type, event_type = 'error' AS flag FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY flag DESC, length(event_type) DESC, event_id) AS n, max(flag) OVER (PARTITION BY user_id) AS any_flag FROM e)
SELECT user_id, event_id, any_flag AS flag FROM r WHERE n = 1
""")
def flagged_dedupe(t):
    e = t("events").select("user_id", "event_id", "event_type", (F.col("event_type") == "error").alias("flag"))
    return resolve.flagged_first(e, "user_id", "flag", "event_type", "event_id").select("user_id", "event_id", "flag")


@query("SELECT strftime(max(o_orderdate)::DATE, '%Y-%m-%d') AS newest FROM orders")
def newest_date(t):
    raw = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"), "o_orderkey"))
    return aggregate.newest_date(t("orders"), raw, ["checked", "updated"])


@query("""
WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-07-01' GROUP BY 1), b AS (SELECT user_id, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-03-01' GROUP BY 1)
SELECT count(*) FILTER (a.n IS NULL) AS added, count(*) FILTER (b.n IS NULL) AS removed, count(*) FILTER (a.n <> b.n) AS changed FROM a FULL JOIN b USING (user_id)
""")
def delta_counts(t):
    count = lambda c: t("events").where(c).groupBy("user_id").agg(F.count("*").cast("string").alias("n"))
    return diff.delta_summary(diff.snapshot_delta(count("ts < TIMESTAMP '2024-07-01'"), count("ts >= TIMESTAMP '2024-03-01'"), "user_id", ["n"]))


@query("""
WITH d AS (SELECT coalesce(c.c_custkey, o.k) AS k, CASE WHEN c.c_custkey IS NULL THEN 'added' WHEN o.k IS NULL THEN 'removed' END AS change FROM customer c FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON o.k = c.c_custkey)
SELECT k, CASE change WHEN 'added' THEN 'new in the list' ELSE 'no longer listed' END AS note FROM d WHERE change IS NOT NULL
""")
def delta_notes(t):
    before = t("customer").select(F.col("c_custkey").alias("k"), F.lit("x").alias("v"))
    after = t("orders").select(F.col("o_custkey").alias("k"), F.lit("x").alias("v")).distinct()
    return readmodel.delta_notes(diff.snapshot_delta(before, after, "k", ["v"]), "k", {"added": "new in the list", "removed": "no longer listed"})


@query("SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') AS known FROM orders")
def crosswalk_flag(t):
    c = t("customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return resolve.flag_known(t("orders").select("o_orderkey", "o_custkey"), "o_custkey", c, "known").select("o_orderkey", "known")


@query("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN p_brand WHEN p_brand = 'Brand#11' OR p_brand = '' THEN coalesce(v, p_brand) ELSE p_brand END AS brand
FROM (SELECT p_partkey, p_size, CASE WHEN p_brand = 'Brand#11' THEN '' ELSE p_brand END AS p_brand FROM part) LEFT JOIN (SELECT l_partkey AS k, max(l_returnflag) AS v FROM lineitem GROUP BY 1) ON k = p_partkey
""")
def guarded_fill(t):
    p = t("part").select("p_partkey", "p_size", F.when(F.col("p_brand") == "Brand#11", "").otherwise(F.col("p_brand")).alias("brand"))
    more = t("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_returnflag").alias("brand"))
    return resolve.fill(p, ["p_partkey"], more, ["brand"], unless=F.col("p_size") < 10).select("p_partkey", "brand")


@query("""
WITH o AS (SELECT o_custkey AS k, max(o_orderpriority) AS lvl, 'order' AS ev FROM orders GROUP BY 1),
c AS (SELECT c_custkey AS k, CASE WHEN c_acctbal > 0 THEN '5-LOW' ELSE '1-URGENT' END AS lvl FROM customer)
SELECT c.k, CASE WHEN o.lvl IS NOT NULL AND o.lvl <> c.lvl THEN o.lvl ELSE c.lvl END AS lvl, coalesce(o.lvl <> c.lvl, false) AS changed,
  CASE WHEN coalesce(o.lvl <> c.lvl, false) THEN 'order,list' ELSE 'list' END AS evidence FROM c LEFT JOIN o USING (k)
""")
def override_evidence(t):
    c = t("customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") > 0, "5-LOW").otherwise("1-URGENT").alias("lvl"), F.array(F.lit("list")).alias("evidence"))
    o = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("lvl"), F.lit("order").alias("evidence"))
    d = resolve.override_with_evidence(c, "k", "lvl", "evidence", o)
    return d.select("k", "lvl", "changed", F.array_join("evidence", ",").alias("evidence"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'COMMUNE' WHEN lower(o_orderpriority) LIKE '2-%' THEN 'PROVINCE' ELSE 'OTHER' END AS authority,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'COMMUNE_AUTHORITY' WHEN lower(o_orderpriority) LIKE '2-%' THEN 'COMMUNE_RECEPTION_ONLY' ELSE 'OTHER' END AS scope,
  o_orderpriority = '1-URGENT' OR lower(o_orderpriority) LIKE '2-%' OR o_orderpriority = '3-MEDIUM' OR o_orderstatus = 'F' AS receivable,
  CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderstatus ELSE 'UNKNOWN' END AS online FROM orders
""")
def classify_record(t):
    rules = [("1-URGENT", False, "COMMUNE", "COMMUNE_AUTHORITY"), ("2-", True, "PROVINCE", "COMMUNE_RECEPTION_ONLY")]
    c = classify.classify_record(F.col("o_orderpriority"), F.col("o_orderstatus") == "F", F.lower("o_orderstatus"), rules, ["3-MEDIUM"], ["F", "P"])
    return t("orders").select("o_orderkey", c.alias("c")).select("o_orderkey", "c.*")


@query("""
SELECT page_id, CASE WHEN body LIKE '%statistic%' THEN 'blocked' WHEN body LIKE '%the%' AND body LIKE '%data%' THEN 'both_visible' WHEN body LIKE '%the%' THEN 'name_visible' ELSE 'unresolved' END AS live
FROM (SELECT page_id, lower(strip_accents(html)) AS body FROM pages)
""")
def live_check(t):
    return t("pages").select("page_id", classify.live_result(F.col("html"), F.lit("The"), F.lit("Data"), ["statistic"]).alias("live"))


@query("SELECT page_id, regexp_matches(both_, 'page|doc') AND regexp_matches(both_, '[02468]') AS hit FROM (SELECT page_id, lower(strip_accents(url || ' ' || left(html, 40))) AS both_ FROM pages)")
def candidate_links(t):
    hit = classify.candidate_link(F.col("url"), F.substring("html", 1, 40), "page|doc", "[02468]")
    return t("pages").select("page_id", hit.alias("hit"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'modified' WHEN event_type = 'click' THEN CASE WHEN value > 50 THEN 'reduced' ELSE 'modified' END ELSE event_type END AS change FROM events
""")
def change_types(t):
    status = F.when(F.col("event_type").isin("view", "click"), "modified").otherwise(F.col("event_type"))
    context = F.when(F.col("event_type") == "view", "Not Reduced fee").when(F.col("value") > 50, "Fee Reduced").otherwise("same fee")
    return t("events").select("event_id", classify.change_type(status, context, "reduced", "not reduced").alias("change"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderpriority END AS label FROM orders")
def level_labels(t):
    return t("orders").select("o_orderkey", classify.level_label(F.col("o_orderstatus"), {"F": "finished", "O": "open"}, F.col("o_orderpriority")).alias("label"))


@query("""
SELECT event_id, CASE WHEN own IS NOT NULL AND parent IN ('current', 'future_effective') THEN CASE WHEN own > DATE '2024-07-01' THEN 'future_effective' ELSE 'current' END ELSE parent END AS state
FROM (SELECT event_id, CASE WHEN value > 50 THEN ts::DATE END AS own, CASE event_type WHEN 'error' THEN 'needs_review' WHEN 'view' THEN 'future_effective' ELSE 'current' END AS parent FROM events)
""")
def row_dates(t):
    own = F.when(F.col("value") > 50, F.to_date("ts"))
    parent = F.when(F.col("event_type") == "error", "needs_review").when(F.col("event_type") == "view", "future_effective").otherwise("current")
    return t("events").select("event_id", replay.row_state(own, parent, F.lit("2024-07-01").cast("date")).alias("state"))


@query("SELECT c_custkey, greatest(v, n) AS version FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE '1995.01.01' END AS v, coalesce(strftime(max(o_orderdate)::DATE, '%Y.%m.%d'), '') AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)")
def versions(t):
    n = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("n"))
    v = F.when(F.col("c_acctbal") < 0, "").otherwise("1995.01.01")
    return t("customer").join(n, "c_custkey", "left").select("c_custkey", replay.dataset_version(v, F.col("n")).alias("version"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_orderpriority LIMIT 3")
def top_facets(t):
    return search.top_facets(t("orders"), "o_orderpriority", 3)


@query("SELECT n_name, row_number() OVER (ORDER BY n_name COLLATE NOCASE, n_nationkey) AS place FROM nation")
def locale_sort(t):
    n = t("nation").withColumn("_o", search.locale_order("n_name", "UNICODE_CI"))
    return search.ordinal(n, [F.col("_o"), F.col("n_nationkey")], "n_nationkey", "place").select("n_name", "place")


@query("""
SELECT o_orderkey, title, date, label, row_number() OVER (ORDER BY day DESC, o_orderkey DESC) AS place
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'decision' ELSE o_orderpriority END AS title, strftime(o_orderdate::DATE, '%d/%m/%Y') AS date, strftime(o_orderdate::DATE, '%Y-%m-%d') AS day,
  CASE WHEN o_orderdate::DATE > DATE '1997-01-01' THEN 'from ' || strftime(o_orderdate::DATE, '%d/%m/%Y') ELSE 'in force' END AS label FROM orders)
""")
def decision_labels(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    o = t("orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("t"), F.when(F.col("o_orderkey") % 2 == 0, day).alias("d"), day.alias("p"))
    return materialise.decision_labels(o, "d", "p", "o_orderkey", "t", F.col("p"), F.lit("1997-01-01"), "decision")


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Builders' ELSE c_mktsegment END AS label, CASE WHEN c_acctbal < 0 THEN c_name ELSE c_name || ' · ' || c_nationkey END AS text,
  CASE WHEN c_nationkey < 10 THEN 'own' ELSE 'last' END AS url FROM customer
""")
def cards(t):
    role = F.when(F.col("c_nationkey") < 10, "official").otherwise("other")
    sources = F.array(F.struct(role.alias("role"), F.lit("own").alias("url")), F.struct(F.lit("other").alias("role"), F.lit("last").alias("url")))
    parts = [F.col("c_name"), F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("c_nationkey").cast("string"))]
    return t("customer").select("c_custkey", materialise.card({"BUILDING": "Builders"}, F.col("c_mktsegment"), parts, sources, "official").alias("c")).select("c_custkey", "c.*")


@query("SELECT o_orderkey, CAST(1 AS INT) AS pos, o_orderpriority AS item FROM orders UNION ALL SELECT o_orderkey, 0, 'status ' || o_orderstatus FROM orders")
def bullet_items(t):
    text = F.concat(F.lit("- status "), F.col("o_orderstatus"), F.lit("\n\n  + "), F.col("o_orderpriority"))
    return t("orders").select("o_orderkey", F.posexplode(materialise.bullet_items(text)).alias("pos", "item"))


@query("SELECT l_orderkey, l_linenumber, l_returnflag AS channel, CAST(l_quantity AS INT) AS quantity, 'days' AS unit, CASE WHEN l_linenumber = 1 THEN 'first' ELSE '' END AS note FROM lineitem")
def channel_items(t):
    text = F.concat(F.col("l_returnflag"), F.lit(" — "), F.col("l_quantity").cast("int"), F.lit(" days"), F.when(F.col("l_linenumber") == 1, " — first").otherwise(""))
    return t("lineitem").select("l_orderkey", "l_linenumber", F.inline(materialise.channel_items(text)))


@query("""
SELECT l_orderkey, CASE count(DISTINCT l_returnflag) WHEN 1 THEN 'verified' ELSE 'conflicting' END AS status FROM lineitem GROUP BY 1
""")
def field_status(t):
    return t("lineitem").groupBy("l_orderkey").agg(gates.field_status(F.collect_set("l_returnflag")).alias("status"))


@query("""
SELECT a.l_orderkey, list_sort(a.m) = list_sort(b.m) AS same FROM (SELECT l_orderkey, list(DISTINCT l_linestatus) AS m FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) a JOIN (SELECT l_orderkey, list(DISTINCT l_linestatus) AS m FROM lineitem GROUP BY 1) b USING (l_orderkey)
""")
def same_sets(t):
    modes = lambda c, n: t("lineitem").where(c).groupBy("l_orderkey").agg(F.collect_list("l_linestatus").alias(n))
    both = modes("l_returnflag <> 'N'", "a").join(modes("true", "b"), "l_orderkey")
    return both.select("l_orderkey", gates.same_set(F.col("a"), F.col("b")).alias("same"))


@query("""
SELECT event_id, 'kind' AS field, event_type AS value, 'high' AS confidence FROM events WHERE event_type <> 'view'
UNION ALL SELECT event_id, 'amount', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 'medium' FROM events WHERE value > 50
""")
def candidate_rows(t):
    found = lambda v, c: F.struct(v.alias("value"), F.lit(c).alias("confidence"))
    kind = F.when(F.col("event_type") != "view", found(F.col("event_type"), "high"))
    amount = F.when(F.col("value") > 50, found(F.floor("value").cast("string"), "medium"))
    return gates.candidate_rows(t("events"), {"kind": kind, "amount": amount}, ["event_id"])


@query("""
WITH c AS (SELECT o_custkey AS k, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS v, bool_or(o_orderstatus = 'P') AS bad FROM orders GROUP BY 1)
SELECT 'priority' AS field, count(*) AS ready_keys, true AS blocked FROM c JOIN customer ON c_custkey = k WHERE NOT bad AND n = 1 AND c_acctbal < 5000 HAVING count(*) > 0
""")
def promotion_plan(t):
    o = t("orders").select(F.col("o_custkey").alias("k"), F.lit("priority").alias("field"), F.col("o_orderpriority").alias("v"), "o_orderstatus")
    c = t("customer").select(F.col("c_custkey").alias("k"), F.lit("priority").alias("field"), F.when(F.col("c_acctbal") < 5000, "").otherwise("none").alias("current"))
    return curation.promote(o, c, "k", "field", "v", F.col("o_orderstatus") == "P", "4", "5")["plan"]


@query("""
WITH g AS (SELECT o_custkey AS k, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS v FROM orders GROUP BY 1)
SELECT c_custkey AS k, CASE WHEN c_acctbal < 5000 THEN coalesce(CASE WHEN n = 1 THEN v END, '') ELSE 'none' END AS p FROM customer LEFT JOIN g ON g.k = c_custkey
""")
def fill_ready(t):
    c = t("customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") < 5000, "").otherwise("none").alias("p"))
    verdicts = gates.gate(t("orders").withColumnRenamed("o_custkey", "k"), c, "k", F.col("o_orderpriority"), F.col("p"))
    return curation.fill_ready(c, verdicts, "k", "p")


@query("""
SELECT 'changed' AS change, user_id FROM (SELECT user_id FROM events WHERE false) UNION ALL
SELECT CASE WHEN p.user_id IS NULL THEN 'added' WHEN c.user_id IS NULL THEN 'removed' ELSE 'changed' END, coalesce(c.user_id, p.user_id) FROM
(SELECT user_id, max(CASE WHEN event_type <> 'view' AND event_type <> 'error' THEN strftime(ts, '%Y%m%d%H%M%S%f') || '|' || lpad(event_id::VARCHAR, 12, '0') END) AS made, coalesce(max(CASE WHEN event_type = 'error' AND ts <= TIMESTAMP '2024-07-01' THEN strftime(ts, '%Y%m%d%H%M%S%f') || '|' || lpad(event_id::VARCHAR, 12, '0') END), '') AS gone FROM events GROUP BY 1 HAVING made > gone) c
FULL JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup') p USING (user_id) WHERE p.user_id IS NULL OR c.user_id IS NULL
""")
def daily_delta(t):
    e = t("events")
    kind = F.when(F.col("event_type") == "view", "review").when((F.col("event_type") == "error") & (F.col("ts") > F.lit("2024-07-01").cast("timestamp")), "future").when(F.col("event_type") == "error", "repealed").otherwise("current")
    names = e.select("user_id").distinct().withColumn("name", F.concat(F.lit("u"), F.col("user_id")))
    previous = e.where("event_type = 'signup'").select("user_id").distinct().withColumn("name", F.concat(F.lit("u"), F.col("user_id")))
    rules = [expect.Rule("NO_NAME", F.coalesce(F.col("name"), F.lit("")) == "", "a public row without a name")]
    run = curation.daily(e, "user_id", ["ts", "event_id"], kind, names, previous, rules)
    return run["delta"].select("change", "user_id")


@query("SELECT o_orderkey, strftime(o_orderdate::DATE, '%Y-%m-%d') AS day FROM orders WHERE o_totalprice > 0")
def preconditions(t):
    o = t("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_totalprice")
    return expect.require(o, F.col("o_totalprice") > 0, "an order without a price").select("o_orderkey", "day")


@query("SELECT r_name, n_name, coalesce(n, 0) AS customers FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey WHERE coalesce(n, 0) % 2 = 1")
def additive_errors(t):
    parts = t("customer").select(F.col("c_nationkey").alias("n_nationkey"), F.lit(1).alias("customers")).unionByName(t("nation").select("n_nationkey", F.lit(0).alias("customers")))
    totals = parts.groupBy("n_nationkey").agg((F.sum("customers") - F.sum("customers") % 2).alias("customers"))
    wrong = aggregate.additive_errors(parts, "n_nationkey", "customers", totals)
    named = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return wrong.join(named, "n_nationkey").select("r_name", "n_name", F.col("parts").alias("customers"))


@query("SELECT CAST(section AS INT) AS section, CAST(pos AS INT) AS pos, line FROM (SELECT 0 AS section, 0 AS pos, '## customers' AS line UNION ALL SELECT 0, 1, '- rows: ' || count(*) FROM customer UNION ALL SELECT 1, 0, '## orders' UNION ALL SELECT 1, 1, '- rows: ' || count(*) FROM orders UNION ALL SELECT 1, 2, '- pending: ' || count(*) FILTER (o_orderstatus = 'P') FROM orders)")
def report_lines(t):
    rows = lambda n, **more: aggregate.summary(t(n), {"rows": F.lit(True), **more})
    return aggregate.report_lines({"customers": rows("customer"), "orders": rows("orders", pending=F.col("o_orderstatus") == "P")})


@query("SELECT n_nationkey AS nation, n_name AS name, (SELECT count(*) FROM nation) AS total FROM nation")
def envelope_scan(t):
    n = t("nation")
    doc = n.agg(F.count("*").alias("total"), F.collect_list(F.struct(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))).alias("rows"))
    path = _place(n, "envelope")
    tables.write_json(doc, path)
    meta, rows = tables.json_envelope(n.sparkSession, path, doc.schema, "rows")
    missing, none = tables.json_envelope(n.sparkSession, path + "-missing", doc.schema, "rows")
    return rows.unionByName(none).join(F.broadcast(meta.unionByName(missing)))


@query("SELECT DISTINCT o_orderpriority FROM orders")
def harvested_keys(t):
    o = t("orders").select("o_orderkey", "o_orderpriority")
    path = _place(o, "text")
    tables.write_compact(o, path)
    return tables.harvested_keys(o.sparkSession, path, "o_orderpriority")


@query("SELECT c_name, c_mktsegment, c_acctbal < 0 AS debtor FROM customer")
def literal_scan(t):
    c = t("customer")
    line = F.concat(F.lit('  {c_name:"'), F.col("c_name"), F.lit('", c_mktsegment: "'), F.col("c_mktsegment"), F.lit('", debtor: '), (F.col("c_acctbal") < 0).cast("string"), F.lit("},"))
    path = _place(c, "lines")
    c.select(line.alias("value")).write.text(path)
    return tables.literal_rows(c.sparkSession, path, ["c_name", "c_mktsegment"], ["debtor"]).drop("pos")


@query("SELECT c_custkey, c_name AS name, CASE WHEN c_nationkey < 9 THEN NULL ELSE c_mktsegment END AS segment FROM customer")
def aliased_scan(t):
    c = t("customer").select("c_custkey", F.lit("None").alias("Name"), F.col("c_name").alias("full-name"), F.when(F.col("c_nationkey") >= 9, F.col("c_mktsegment")).otherwise("  ").alias("mkt_segment"))
    return c.select("c_custkey", tables.aliased(c, ["name"]).alias("name"), tables.aliased(c, ["segment"]).alias("segment"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY 1")
def appended_log(t):
    o = t("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    path = _place(o, "log")
    tables.append_log(o.where("o_orderstatus <> 'P'"), path)
    tables.append_log(o, path)
    return o.sparkSession.read.schema(o.schema).json(path)


@query("SELECT true AS first, false AS again, true AS after, count(*) FILTER (c_acctbal >= 0) AS rows FROM customer")
def write_if_changed(t):
    c = t("customer").select("c_custkey", "c_name", F.current_timestamp().alias("seen"), "c_acctbal")
    path = _place(c, "versions")
    told = [tables.write_if_changed(x, path, ["seen"]) for x in (c, c, c.where("c_acctbal >= 0"))]
    rows = c.sparkSession.read.parquet(path).agg(F.count("*").alias("rows"))
    return rows.select(*[F.lit(x).alias(n) for n, x in zip(("first", "again", "after"), told, strict=True)], "rows")


@query("""
WITH s AS (SELECT c_custkey AS k, sha256(c_name) AS sha FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN sha256(c_name) ELSE sha256(c_mktsegment) END AS sha FROM customer)
SELECT n.k::VARCHAR AS k, n.sha, CASE WHEN s.k IS NULL THEN n.k::VARCHAR ELSE n.k || '-' || left(n.sha, 12) END AS name FROM n LEFT JOIN s USING (k) WHERE s.k IS NULL OR s.sha <> n.sha
""")
def store_evidence(t):
    c = t("customer").withColumn("k", F.col("c_custkey").cast("string"))
    new = c.select("k", F.sha2(F.when(F.col("c_custkey") % 4 == 0, F.col("c_name")).otherwise(F.col("c_mktsegment")), 256).alias("sha"))
    new = c.select("k").join(new, "k")
    own = c.where("c_custkey % 2 = 0").select("k", F.sha2("c_name", 256).alias("sha"))
    return tables.store_evidence(own, new, "k", "sha").select("k", "sha", "name")


@query("SELECT c_custkey AS k, c_name AS name FROM customer")
def verified_write(t):
    c = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return readmodel.write_verified(c.sparkSession, c, _place(c, "model"), "k", ["name"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def never_observed(t):
    return streams.never_observed(t("customer").select("c_custkey"), t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT n_nationkey AS k, n_name, coalesce(c.n > 0, false) AS in_master, c.n, r_name FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey > 3 GROUP BY 1) c ON c_nationkey = n_nationkey")
def crosswalk(t):
    items = t("nation").select(F.col("n_nationkey").alias("k"), "n_name")
    master = t("customer").where("c_nationkey > 3").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    live = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("k"), "r_name")
    return reconcile.crosswalk(items, master, live, "k")


@query("""
SELECT c_custkey AS k, CASE WHEN g.p IS NOT NULL AND c_acctbal > 0 THEN 'new' ELSE 'old' END AS link, g.p AS priority, CASE WHEN g.k IS NOT NULL AND g.s <> 'P' THEN g.s END AS status
FROM customer LEFT JOIN (SELECT o_custkey AS k, max(o_orderpriority) AS p, min(o_orderstatus) AS s FROM orders GROUP BY 1) g ON g.k = c_custkey
""")
def guidance_enrichment(t):
    c = t("customer").select(F.col("c_custkey").alias("k"), F.lit("old").alias("link"), "c_acctbal")
    g = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("priority"), F.min("o_orderstatus").alias("status"))
    g = g.withColumn("status", F.when(F.col("status") == "P", "").otherwise(F.col("status"))).withColumn("link", F.lit("new"))
    return resolve.enrich(c, "k", g, ["priority", "status"], "link", F.col("c_acctbal") > 0).select("k", "link", "guidance.priority", "guidance.status")


@query("""
SELECT c_custkey, 'https://example.org/q?lang=en&' || CASE WHEN c_acctbal > 0 THEN 'level=1&' ELSE 'level=2&' END || CASE WHEN c_nationkey < 12 THEN 'id=' || c_custkey ELSE 'word=' || replace(c_name, '#', '%23') END AS url FROM customer
""")
def submission_urls(t):
    scope = F.when(F.col("c_acctbal") > 0, "own").otherwise("other")
    fid = F.when(F.col("c_nationkey") < 12, F.col("c_custkey").cast("string"))
    url = urls.submission_url("https://example.org/q", {"lang": "en"}, scope, {"own": {"level": "1"}, "other": {"level": "2"}}, "id", fid, "word", F.col("c_name"))
    return t("customer").select("c_custkey", url.alias("url"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment LIKE 'BUILD%' THEN 'own' WHEN c_mktsegment LIKE 'MACH%' OR c_mktsegment LIKE 'AUTO%' THEN 'shared' ELSE 'unknown' END AS scope FROM customer")
def authority_scope(t):
    return t("customer").select("c_custkey", readmodel.scope(F.col("c_mktsegment"), {"own": ["build"], "shared": ["mach", "auto"]}).alias("scope"))


@query("""
WITH g AS (SELECT c_custkey AS k, c_mktsegment AS label, h FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS h FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey),
r AS (SELECT *, coalesce(h, label) AS level FROM g), n AS (SELECT count(*) FILTER (level IN ('BUILDING', '1-URGENT')) AS n FROM r)
SELECT n.n AS in_scope, count(*) - n.n AS out_of_scope, count(*) FILTER (h <> label) AS misclassified, 0 AS ambiguous, greatest(0, 100 - n.n) AS missing_at_least, n.n - 100 AS drift FROM r, n GROUP BY n.n
""")
def result_buckets(t):
    m = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label"))
    o = t("orders").withColumnRenamed("o_custkey", "k").withColumnRenamed("o_orderpriority", "hint").where("o_orderstatus = 'P'")
    none = m.select("k", F.col("label").alias("level")).where("false")
    resolved = reconcile.levels(m, "k", o, none, "label", ["BUILDING", "1-URGENT"], [F.col("hint").desc(), F.col("o_orderkey")])
    return reconcile.buckets(resolved, "k", 100)


@query("""
WITH h AS (SELECT o_custkey AS k, max(o_orderpriority) AS h FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
t AS (SELECT p_partkey AS k, count(DISTINCT p_partkey % 2) AS n FROM part WHERE p_partkey % 4 = 1 GROUP BY 1),
r AS (SELECT c_custkey AS k, c_mktsegment AS label, h, CASE WHEN t.n = 1 THEN 'BUILDING' END AS tab FROM customer LEFT JOIN h ON h.k = c_custkey LEFT JOIN t ON t.k = c_custkey),
l AS (SELECT *, coalesce(h, tab, label) AS level, coalesce(h, tab) AS e FROM r)
SELECT 'MATCHED' AS bucket, k FROM l WHERE e IN ('1-URGENT', 'BUILDING')
UNION ALL SELECT 'EXTRA', k FROM l WHERE level NOT IN ('BUILDING', '1-URGENT')
UNION ALL SELECT 'MISCLASSIFIED', k FROM l WHERE e <> label
UNION ALL SELECT 'AMBIGUOUS', k FROM l WHERE e IS NULL AND label = 'MACHINERY'
UNION ALL SELECT 'PROVISIONAL', k FROM l WHERE label = 'BUILDING'
""")
def reconciled_records(t):
    m = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label"))
    o = t("orders").withColumnRenamed("o_custkey", "k").withColumnRenamed("o_orderpriority", "hint").where("o_orderstatus = 'P'")
    tables = t("part").where("p_partkey % 4 = 1").select(F.col("p_partkey").alias("k"), F.lit("BUILDING").alias("level"))
    resolved = reconcile.levels(m, "k", o, tables, "label", ["BUILDING", "1-URGENT"], [F.col("hint").desc(), F.col("o_orderkey")])
    return reconcile.results(resolved.join(m, "k"), "k", "label", ["BUILDING"], ["MACHINERY"], ["BUILDING", "1-URGENT"])


@query("SELECT count(*) AS rows FROM customer")
def dataset_fingerprint(t):
    """The same rows in another order, with another volatile column, have one fingerprint; other rows have another."""
    c = t("customer").withColumn("seen", F.current_timestamp())
    a = diff.dataset_fingerprint(c, ["seen"])
    b = diff.dataset_fingerprint(c.repartition(5, "c_name").withColumn("seen", F.lit(None).cast("timestamp")), ["seen"])
    c = diff.dataset_fingerprint(c.withColumn("c_name", F.upper("c_mktsegment")), ["seen"])
    return a.join(b, ["rows", "xor", "total"]).join(c, ["xor", "total"], "left_anti").select("rows")


@query("""
WITH a AS (SELECT CASE WHEN c_nationkey < 12 THEN 'commune' WHEN c_nationkey < 22 THEN 'city' END AS sheet, CASE WHEN c_custkey % 60 = 0 THEN '' ELSE c_custkey::VARCHAR END AS key, '1995-01-01' AS day, 'live' AS status, c_mktsegment AS name, 0 AS p, c_custkey AS o, false AS doubt FROM customer
UNION ALL SELECT CASE WHEN o_custkey % 2 = 0 THEN 'commune' ELSE 'city' END, o_custkey::VARCHAR, CASE WHEN o_orderstatus = 'P' THEN '1995-01-01' ELSE o_orderdate::DATE::VARCHAR END, CASE o_orderstatus WHEN 'O' THEN 'gone' WHEN 'F' THEN 'future' ELSE 'live' END, o_orderpriority, 1, o_orderkey, o_orderpriority = '5-LOW' FROM orders WHERE o_orderkey % 8 < 3),
r AS (SELECT *, {'d': day, 'r': CASE status WHEN 'live' THEN 4 WHEN 'future' THEN 3 WHEN 'gone' THEN 2 ELSE 0 END} AS c, {'p': p, 'o': o} AS seq FROM a),
k AS (SELECT * FROM r WHERE sheet IS NOT NULL AND key <> ''),
w AS (SELECT *, row_number() OVER (PARTITION BY sheet, key ORDER BY c DESC, seq) AS i, count(*) OVER (PARTITION BY sheet, key) AS n,
  max(c) OVER (PARTITION BY sheet, key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lead, first_value(name) OVER (PARTITION BY sheet, key, c ORDER BY seq) AS held FROM k),
x AS (SELECT sheet, key, c, day, status, name FROM w WHERE c = lead AND name <> held)
SELECT sheet, '' AS of, '' AS reason, key, day, status, name, n FROM w WHERE i = 1
UNION ALL SELECT 'review', sheet, 'missing_code', '', day, status, name, count(*) FROM r WHERE sheet IS NOT NULL AND key = '' GROUP BY ALL
UNION ALL SELECT 'review', sheet, 'low', key, day, status, name, count(*) FROM k WHERE doubt GROUP BY ALL
UNION ALL SELECT 'review', 'none', 'unclassified', key, day, status, name, count(*) FROM r WHERE sheet IS NULL GROUP BY ALL
UNION ALL SELECT 'review', x.sheet, 'same_date_material_conflict', x.key, x.day, x.status, x.name, count(*) FROM (SELECT DISTINCT * FROM x) x JOIN k ON k.sheet = x.sheet AND k.key = x.key AND k.c = x.c AND k.name = x.name GROUP BY ALL
""")
def projection_plan(t):
    """Customers and a part of the orders as two producers of two sheets; the review queue beside them."""
    n, k, s, p = F.col("c_nationkey"), F.col("c_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    place = lambda c: F.lpad(F.col(c).cast("string"), 20, "0")
    first = projection.Producer(
        t("customer"), F.when(n < 12, "commune").when(n < 22, "city"), F.when(k % 60 == 0, " ").otherwise(k.cast("string")), F.lit("1995-01-01"), F.lit("live"), place("c_custkey"), {"name": F.col("c_mktsegment")}, {"only:unclassified": F.lit(True)}, F.lit("none")
    )
    second = projection.Producer(
        t("orders").where("o_orderkey % 8 < 3"), F.when(F.col("o_custkey") % 2 == 0, "commune").otherwise("city"), F.col("o_custkey"), F.when(s == "P", "1995-01-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        F.when(s == "O", "gone").when(s == "F", "future").otherwise("live"), place("o_orderkey"), {"name": p}, {"low": p == "5-LOW"},
    )
    return projection.plan([first, second], {"live": 4, "future": 3, "gone": 2}, ["name"])
