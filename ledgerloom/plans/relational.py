"""Queries of the relational core. Every query has its SQL counterpart next to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import relational as R
from ..operators import retrieval
from ..sources.tables import table as T
from .registry import CORE

Q = CORE.add


@Q("s01_list_ordered_limit", "S1 L1 L3 P1", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50")
def _(spark: SparkSession, d: str) -> DataFrame:
    return T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(50)


@Q("s02_point_lookup", "S2", "SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42")
def _(spark, d):
    return T(spark, d, "customer").where("c_custkey = 42").select("c_custkey", "c_name")


@Q("s06_json_props", "S6", "SELECT event_id, json_type(props) IS NOT NULL AS has_props, length(props) AS n FROM events")
def _(spark, d):
    e = T(spark, d, "events")
    return e.select("event_id", F.expr("try_parse_json(props)").isNotNull().alias("has_props"), F.length("props").cast("bigint").alias("n"))


@Q("k03_idempotent_insert", "K3 S15 T8", "SELECT event_id FROM events n WHERE event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM events o WHERE o.event_type = 'view' AND o.user_id = n.user_id)")
def _(spark, d):
    e = T(spark, d, "events")
    return R.insert_missing(e.where("event_type = 'view'"), e.where("event_type = 'purchase'"), ["user_id"]).select("event_id")


@Q("k04_url_upsert_promote", "K4", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY media ORDER BY discovered_at, result_id, ingested_at) rn FROM search_result WHERE media IS NOT NULL)
SELECT media, max(CASE WHEN rn = 1 THEN result_id END) AS result_id, CASE WHEN bool_or(decision = 'keep') THEN 'keep' ELSE max(CASE WHEN rn = 1 THEN decision END) END AS decision FROM r GROUP BY media""")
def _(spark, d):
    r = T(spark, d, "search_result").where("media is not null").select("media", "result_id", "discovered_at", "ingested_at", "decision")
    return R.promote(r, "media", ["discovered_at", "result_id", "ingested_at"], "decision").select("media", "result_id", "decision")


@Q("k05_merge_archive", "K5", """SELECT p_partkey, CASE WHEN p_size >= 10 THEN 'candidate' ELSE 'archived' END AS status FROM part""")
def _(spark, d):
    p = T(spark, d, "part").select("p_partkey", "p_size")
    new = p.where("p_size >= 10").select("p_partkey", F.lit("candidate").alias("status"))
    return R.merge_archive(p.select("p_partkey", F.lit("candidate").alias("status")), new, "p_partkey", "status")


@Q("k06_replace_reaggregate", "K6 A7", """SELECT o_orderkey, count(l_linenumber) AS event_count, min(l_shipdate) AS first_seen, max(l_shipdate) AS latest_seen, CASE WHEN count(l_linenumber) = 0 THEN 'archived' ELSE 'active' END AS status
FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag <> 'R') l ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def _(spark, d):
    kept = T(spark, d, "lineitem").where("l_returnflag <> 'R'").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("l_shipdate").alias("first_seen"), F.max("l_shipdate").alias("latest_seen"))
    o = T(spark, d, "orders").select("o_orderkey").join(kept, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("event_count"), "first_seen", "latest_seen", F.when(F.col("n").isNull(), "archived").otherwise("active").alias("status"))


@Q("k07_snapshot_swap", "K7", """WITH ok AS (SELECT NOT bool_or(status LIKE 'failed%') AS ok, plan_id FROM search_task GROUP BY plan_id)
SELECT p.plan_id, CASE WHEN o.ok AND p.status = 'pending' THEN 'candidate' WHEN o.ok AND p.status = 'completed' THEN 'archived' ELSE p.status END AS status FROM research_plan p LEFT JOIN ok o ON o.plan_id = p.plan_id""")
def _(spark, d):
    ok = T(spark, d, "search_task").groupBy("plan_id").agg((~F.bool_or(F.col("status").startswith("failed"))).alias("ok"))
    p = T(spark, d, "research_plan").select("plan_id", "status").join(ok, "plan_id", "left")
    s = F.when(F.col("ok") & (F.col("status") == "pending"), "candidate").when(F.col("ok") & (F.col("status") == "completed"), "archived").otherwise(F.col("status"))
    return p.select("plan_id", s.alias("status"))


@Q("k11_export_join", "K14 S10", "SELECT s.task_id, s.status, p.status AS plan_status, array_to_string(p.regions, ';') AS regions FROM search_task s LEFT JOIN research_plan p ON p.plan_id = s.plan_id")
def _(spark, d):
    p = T(spark, d, "research_plan").select("plan_id", F.col("status").alias("plan_status"), F.array_join("regions", ";").alias("regions"))
    return T(spark, d, "search_task").join(p, "plan_id", "left").select("task_id", "status", "plan_status", "regions")


@Q("k14_union_row_types", "K14", "SELECT 'direction' AS row_type, label AS name FROM topic WHERE status = 'active' UNION ALL SELECT 'discarded', label FROM topic WHERE status IS DISTINCT FROM 'active'")
def _(spark, d):
    t = T(spark, d, "topic")
    a = t.where("status = 'active'").select(F.lit("direction").alias("row_type"), F.col("label").alias("name"))
    return a.unionByName(t.where("status is distinct from 'active'").select(F.lit("discarded").alias("row_type"), F.col("label").alias("name")))


@Q("p02_predicates", "P2 P4 P7 J1", """SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O','F') AND o_orderpriority NOT IN ('1-URGENT') AND o_totalprice BETWEEN 1000 AND 50000 AND (o_orderdate IS NULL OR o_orderdate < TIMESTAMP '1997-01-01')""")
def _(spark, d):
    c = F.col
    return T(spark, d, "orders").where(c("o_orderstatus").isin("O", "F") & ~c("o_orderpriority").isin("1-URGENT") & c("o_totalprice").between(1000, 50000) & (c("o_orderdate").isNull() | (c("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")))).select("o_orderkey")


@Q("p03_like_prefix", "P3", "SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'PROMO%'")
def _(spark, d):
    return T(spark, d, "part").where(F.col("p_type").startswith("PROMO")).select("p_partkey", "p_type")


@Q("p05_dynamic_in_empty", "P5", "SELECT 'given' AS asked, o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (1, 2, 40, 41, 70) UNION ALL SELECT 'none', o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def _(spark, d):
    """Orders by optional lists of customers: no list leaves the condition out, an empty list finds nothing."""
    o = T(spark, d, "orders").where("o_orderstatus = 'O'")
    found = [R.by_optional(o, "o_custkey", ids).select(F.lit(name).alias("asked"), "o_orderkey") for name, ids in (("given", [1, 2, 40, 41, 70]), ("empty", []), ("none", None))]
    return found[0].unionByName(found[1]).unionByName(found[2])


@Q("p06_exists_not_exists", "P6 J6 J7", """SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'O') AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'F')""")
def _(spark, d):
    c, o = T(spark, d, "customer"), T(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return c.join(o.where("o_orderstatus = 'O'"), "c_custkey", "left_semi").join(o.where("o_orderstatus = 'F'"), "c_custkey", "left_anti").select("c_custkey")


@Q("p08_review_overrides", "P8", """WITH r AS (SELECT *, coalesce(regexp_matches(url, '/search(list)?([/?]|$)|[?&](q|query|searchword|keyword)='), false) AS listing, CASE WHEN regexp_matches(publish_date, '^\\d{4}-\\d{2}-\\d{2}') THEN try_cast(substr(publish_date, 1, 10) AS DATE) END AS day FROM search_result)
SELECT DISTINCT result_id, CASE WHEN listing THEN 'source_entry' ELSE url_type END AS url_type, CASE WHEN listing OR day NOT BETWEEN DATE '2023-01-01' AND DATE '2025-12-31' THEN 'drop' ELSE decision END AS decision FROM r""")
def _(spark, d):
    listing = F.coalesce(F.col("url").rlike(r"/search(list)?([/?]|$)|[?&](q|query|searchword|keyword)="), F.lit(False))
    day = F.when(F.col("publish_date").rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring("publish_date", 1, 10).try_cast("date"))
    outside = F.coalesce(~day.between(F.lit("2023-01-01").cast("date"), F.lit("2025-12-31").cast("date")), F.lit(False))
    r = T(spark, d, "search_result")
    return r.select("result_id", F.when(listing, "source_entry").otherwise(F.col("url_type")).alias("url_type"), F.when(listing | outside, "drop").otherwise(F.col("decision")).alias("decision")).distinct()


@Q("p09_citations", "P9", "SELECT result_id, cast(u.n AS BIGINT) AS cited FROM (SELECT DISTINCT result_id, unnest(list_distinct(list_transform(regexp_extract_all(snippet, '\\[(?:citation:)?(\\d{1,3})\\]', 1), lambda x: cast(x AS BIGINT)))) AS n FROM search_result) u")
def _(spark, d):
    n = F.explode(F.array_distinct(F.transform(F.regexp_extract_all("snippet", F.lit(r"\[(?:citation:)?(\d{1,3})\]"), F.lit(1)), lambda x: x.cast("bigint"))))
    return T(spark, d, "search_result").select("result_id", n.alias("cited")).distinct()


@Q("p13_reference_accounting", "P13 U3", """WITH e AS (SELECT DISTINCT topic_id FROM topic), u AS (SELECT t AS topic_id, count(*) AS n FROM (SELECT unnest(topic_ids) AS t FROM track) GROUP BY t)
SELECT coalesce(e.topic_id, u.topic_id) AS topic_id, CASE WHEN e.topic_id IS NULL THEN 'unknown' WHEN u.n IS NULL THEN 'missing' ELSE 'duplicate' END AS violation, coalesce(u.n, 0) AS n FROM e FULL JOIN u ON e.topic_id = u.topic_id WHERE e.topic_id IS NULL OR u.n IS NULL OR u.n > 1""")
def _(spark, d):
    used = T(spark, d, "track").select(F.explode("topic_ids").alias("topic_id"))
    return R.accounting(T(spark, d, "topic"), used, "topic_id")


@Q("p14_shared_member_legality", "P14", """WITH m AS (SELECT track_id, unnest(topic_ids) AS topic_id, offering_family FROM track) SELECT DISTINCT a.track_id AS track_a, b.track_id AS track_b, a.topic_id, a.offering_family = b.offering_family AS same_family FROM m a JOIN m b ON a.topic_id = b.topic_id AND a.track_id < b.track_id""")
def _(spark, d):
    m = T(spark, d, "track").select("track_id", F.explode("topic_ids").alias("topic_id"), "offering_family")
    a, b = m.alias("a"), m.alias("b")
    j = a.join(b, (F.col("a.topic_id") == F.col("b.topic_id")) & (F.col("a.track_id") < F.col("b.track_id")))
    return j.select(F.col("a.track_id").alias("track_a"), F.col("b.track_id").alias("track_b"), "a.topic_id", (F.col("a.offering_family") == F.col("b.offering_family")).alias("same_family")).distinct()


@Q("p15_identity_normalise", "P15 W2 F12", """SELECT track_id, name FROM (SELECT *, row_number() OVER (PARTITION BY replace(lower(regexp_replace(name, '[^\\p{L}\\p{N}_]', '', 'g')), 'ß', 'ss') ORDER BY track_id) AS rn FROM track WHERE len(topic_ids) > 0 AND NOT contains(name, '政策')) WHERE rn = 1""")
def _(spark, d):
    t = T(spark, d, "track").where((F.size("topic_ids") > 0) & ~F.col("name").contains("政策"))
    return R.first_seen(t, X.identity_form(F.col("name")), [F.col("track_id")]).select("track_id", "name")


@Q("p16_region_in_name", "P16", """SELECT DISTINCT s.task_id, s.region IS NOT NULL AND contains(s.query, s.region) AS regional FROM search_task s""")
def _(spark, d):
    hit = F.col("region").isNotNull() & F.coalesce(F.contains("query", "region"), F.lit(False))
    return T(spark, d, "search_task").select("task_id", hit.alias("regional")).distinct()


@Q("p17_unknown_members", "P17 U1", """SELECT k.track_id, count(u.t) FILTER (WHERE NOT EXISTS (SELECT 1 FROM topic a WHERE a.status = 'active' AND a.topic_id = u.t)) AS ignored FROM track k LEFT JOIN (SELECT track_id, unnest(topic_ids) AS t FROM track) u ON u.track_id = k.track_id GROUP BY k.track_id""")
def _(spark, d):
    known = T(spark, d, "topic").where("status = 'active'").select("topic_id")
    m = T(spark, d, "track").select("track_id", F.explode_outer("topic_ids").alias("topic_id")).where("topic_id is not null")
    ignored = m.join(known, "topic_id", "left_anti").groupBy("track_id").count()
    return T(spark, d, "track").select("track_id").join(ignored, "track_id", "left").select("track_id", F.coalesce("count", F.lit(0)).alias("ignored"))


@Q("p19_batch_rules", "P19", """SELECT plan_id, count(*) AS tasks, count(DISTINCT region) AS regions, bool_or(status = 'completed') AS any_done, count(*) BETWEEN 4 AND 40 AS in_limits FROM search_task GROUP BY plan_id""")
def _(spark, d):
    n = F.count("*")
    return T(spark, d, "search_task").groupBy("plan_id").agg(n.alias("tasks"), F.count_distinct("region").alias("regions"), F.bool_or(F.col("status") == "completed").alias("any_done"), ((n >= 4) & (n <= 40)).alias("in_limits"))


@Q("p22_supplement_targets", "P22", """SELECT region, count(*) AS tasks, count(DISTINCT completion_reason) AS reasons FROM search_task WHERE region IS NOT NULL GROUP BY region HAVING count(completion_reason) > 0 ORDER BY tasks, reasons DESC, region LIMIT 12""")
def _(spark, d):
    g = T(spark, d, "search_task").where("region is not null").groupBy("region").agg(F.count("*").alias("tasks"), F.count_distinct("completion_reason").alias("reasons"))
    return g.where("reasons > 0").orderBy("tasks", F.desc("reasons"), "region").limit(12)


@Q("j02_plan_candidates_distinct", "J2 J4 A1", """SELECT n_name, count(DISTINCT o_orderkey) AS candidates FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey WHERE r_name = 'ASIA' GROUP BY n_name""")
def _(spark, d):
    n = T(spark, d, "region").where("r_name = 'ASIA'").join(T(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = T(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return T(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(F.count_distinct("o_orderkey").alias("candidates"))


@Q("j03_six_way_chain", "J3 J16", """SELECT r_name, cast(sum(l_quantity) AS DOUBLE) AS qty, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) rn FROM lineitem) l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE rn = 1 GROUP BY r_name""")
def _(spark, d):
    first = R.latest_per_key(T(spark, d, "lineitem"), ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]).select("l_orderkey", "l_quantity")
    j = first.join(T(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(T(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(T(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(T(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(F.sum("l_quantity").alias("qty"), F.count("*").alias("n"))


@Q("j05_left_not_captured", "J5 J9", """SELECT DISTINCT s.result_id FROM search_result s LEFT JOIN remote_page_result p ON p.result_id = s.result_id WHERE p.result_id IS NULL OR p.extracted_text IS NULL""")
def _(spark, d):
    p = T(spark, d, "remote_page_result").select("result_id", F.col("extracted_text").isNull().alias("failed"), F.lit(True).alias("there"))
    return T(spark, d, "search_result").select("result_id").join(p, "result_id", "left").where("there is null or failed").select("result_id").distinct()


@Q("j08_stage_status", "J8 A2 A3 A4", """SELECT kind, k, count(*) AS n FROM (SELECT 'task' AS kind, status AS k FROM search_task UNION ALL SELECT 'decision', decision FROM search_result UNION ALL SELECT 'plan', status FROM research_plan) WHERE k IS NOT NULL GROUP BY kind, k""")
def _(spark, d):
    part = lambda n, c, k: T(spark, d, n).select(F.lit(k).alias("kind"), F.col(c).alias("k"))
    u = part("search_task", "status", "task").unionByName(part("search_result", "decision", "decision")).unionByName(part("research_plan", "status", "plan"))
    return u.where("k is not null").groupBy("kind", "k").agg(F.count("*").alias("n"))


@Q("j15_ref_expand_ordered", "J15", """SELECT t.track_id, string_agg(tp.label, '|' ORDER BY u.pos) AS labels FROM track t, unnest(t.topic_ids) WITH ORDINALITY AS u(topic_id, pos) JOIN topic tp ON tp.topic_id = u.topic_id GROUP BY t.track_id""")
def _(spark, d):
    m = T(spark, d, "track").select("track_id", F.posexplode("topic_ids").alias("pos", "topic_id")).join(T(spark, d, "topic").select("topic_id", "label"), "topic_id")
    items = F.array_sort(F.collect_list(F.struct("pos", "label")))
    return m.groupBy("track_id").agg(F.array_join(F.transform(items, lambda x: x["label"]), "|").alias("labels"))


@Q("j17_decision_overlay", "J17 F30", """SELECT DISTINCT s.result_id, CASE WHEN p.http_status >= 400 THEN 'NOT_MATCH' WHEN s.decision = 'keep' THEN 'MATCH' WHEN p.page_id IS NULL THEN 'UNRESOLVED' ELSE coalesce(upper(nullif(s.decision, '')), 'UNRESOLVED') END AS final_status
FROM (SELECT DISTINCT result_id, decision FROM search_result) s LEFT JOIN (SELECT result_id, min(page_id) AS page_id, max(http_status) AS http_status FROM remote_page_result GROUP BY result_id) p ON p.result_id = s.result_id""")
def _(spark, d):
    s = T(spark, d, "search_result").select("result_id", "decision").distinct()
    p = T(spark, d, "remote_page_result").groupBy("result_id").agg(F.min("page_id").alias("page_id"), F.max("http_status").alias("http_status"))
    f = F.when(F.col("http_status") >= 400, "NOT_MATCH").when(F.col("decision") == "keep", "MATCH").when(F.col("page_id").isNull(), "UNRESOLVED").otherwise(F.coalesce(F.upper(F.nullif(F.col("decision"), F.lit(""))), F.lit("UNRESOLVED")))
    return s.join(p, "result_id", "left").select("result_id", f.alias("final_status")).distinct()


@Q("a02_group_counts", "A2 A1 A11", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def _(spark, d):
    return T(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


AUDIT_SQL = """WITH b AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders), o AS (SELECT orders.*, o_orderdate::DATE <= lo + ((hi - lo) // 2)::INTEGER AS first_half FROM orders, b)
SELECT n_name AS region, count(o_orderkey) AS urls, count(DISTINCT o_custkey) AS sources, count(*) FILTER (WHERE o_orderstatus = 'F') AS kept, count(*) FILTER (WHERE first_half) AS first_half, count(*) FILTER (WHERE NOT first_half) AS second_half,
array_to_string(list_sort(list_distinct(list(o_orderpriority) FILTER (WHERE o_orderpriority IS NOT NULL))), '|') AS reasons
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN o ON o_custkey = c_custkey GROUP BY n_name"""


@Q("a05_coverage_audit", "A5 W13 P7 A6", AUDIT_SQL)
def coverage_audit(spark: SparkSession, d: str) -> DataFrame:
    o = T(spark, d, "orders")
    day = F.to_date("o_orderdate")
    span = o.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(F.expr("date_add(lo, cast(floor(date_diff(hi, lo) / 2) as int))").alias("middle"))
    o = o.crossJoin(F.broadcast(span)).withColumn("early", F.to_date("o_orderdate") <= F.col("middle"))  # one row
    j = T(spark, d, "nation").join(T(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(o, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.groupBy(F.col("n_name").alias("region")).agg(
        F.count("o_orderkey").alias("urls"), F.count_distinct("o_custkey").alias("sources"), F.count_if(F.col("o_orderstatus") == "F").alias("kept"),
        F.count_if("early").alias("first_half"), F.count_if(~F.col("early")).alias("second_half"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("reasons"),
    )


@Q("a06_top_domains", "A6 F2", """WITH h AS (SELECT lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host FROM search_result) SELECT host, count(*) AS n, round(count(*) * 1.0 / (SELECT count(*) FROM h), 6) AS share FROM h GROUP BY host ORDER BY n DESC, host LIMIT 10""")
def _(spark, d):
    h = T(spark, d, "search_result").select(X.host(F.col("url")).alias("host"))
    total = h.agg(F.count("*").alias("total"))
    top = h.groupBy("host").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(10)
    return top.crossJoin(F.broadcast(total)).select("host", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))  # one row


@Q("a07_ordered_union", "A7 W2", """WITH f AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS p FROM orders GROUP BY 1, 2) SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY p, o_orderpriority) AS "values" FROM f GROUP BY o_custkey""")
def _(spark, d):
    return R.ordered_union(T(spark, d, "orders"), ["o_custkey"], "o_orderpriority", F.col("o_orderkey"))


@Q("a08_job_state", "A8 T5", """SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS failed, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS done, bool_or(event_type = 'view') AS active FROM events GROUP BY user_id""")
def _(spark, d):
    return T(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("failed"), F.count_if(F.col("event_type") == "purchase").alias("done"), F.bool_or(F.col("event_type") == "view").alias("active"))


@Q("a09_rollup_status", "A9", """SELECT plan_id, CASE WHEN bool_and(status = 'completed') THEN 'completed' WHEN bool_or(status = 'running') THEN 'running' WHEN bool_or(status = 'failed_terminal') THEN 'failed_terminal' WHEN bool_or(status = 'failed_retryable') THEN 'failed_retryable' ELSE 'pending' END AS state, count(*) AS n FROM search_task GROUP BY plan_id""")
def _(spark, d):
    return R.rollup_status(T(spark, d, "search_task"), "plan_id", "status")


@Q("a10_usage_sum", "A10", """SELECT model, key AS usage_key, sum(value)::BIGINT AS total FROM (SELECT model, unnest(map_entries(usage)) AS e FROM remote_page_result), LATERAL (SELECT e.key AS key, e.value AS value) GROUP BY model, key""")
def _(spark, d):
    return T(spark, d, "remote_page_result").select("model", F.explode("usage").alias("usage_key", "v")).groupBy("model", "usage_key").agg(F.sum("v").alias("total"))


@Q("a12_combine_identity", "A12 U1 U2", """SELECT replace(lower(regexp_replace(name, '[^\\p{L}\\p{N}_]', '', 'g')), 'ß', 'ss') || '|' || supplier_role AS key, count(*) AS n, min(confidence) AS confidence, bool_or(status = 'watchlist') AS watch FROM track GROUP BY 1""")
def _(spark, d):
    key = F.concat(X.identity_form(F.col("name")), F.lit("|"), F.col("supplier_role"))
    return T(spark, d, "track").groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min("confidence").alias("confidence"), F.bool_or(F.col("status") == "watchlist").alias("watch"))


@Q("a13_merge_min_any", "A13 G12", """SELECT offering_family, min(confidence) AS confidence, CASE WHEN bool_or(status = 'watchlist') THEN 'watchlist' ELSE 'candidate' END AS status, count(DISTINCT t) AS topics FROM (SELECT *, unnest(CASE WHEN len(topic_ids) = 0 THEN [NULL] ELSE topic_ids END) AS t FROM track) GROUP BY offering_family""")
def _(spark, d):
    m = T(spark, d, "track").withColumn("t", F.explode_outer("topic_ids"))
    return m.groupBy("offering_family").agg(F.min("confidence").alias("confidence"), F.when(F.bool_or(F.col("status") == "watchlist"), "watchlist").otherwise("candidate").alias("status"), F.count_distinct("t").alias("topics"))


@Q("a14_duplicate_groups", "A14", """WITH g AS (SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text) SELECT count(*) FILTER (WHERE n > 1) AS groups, coalesce(sum(n - 1), 0)::BIGINT AS excess FROM g""")
def _(spark, d):
    g = T(spark, d, "documents").where("text is not null").groupBy(F.md5("text").alias("m")).agg(F.count("*").alias("n"))
    return g.agg(F.count_if(F.col("n") > 1).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))


@Q("a16_quantiles", "A16", """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.995), 6) AS q995 FROM lineitem GROUP BY l_returnflag""")
def _(spark, d):
    q = lambda p: F.round(F.percentile("l_extendedprice", F.lit(p)), 6)
    return T(spark, d, "lineitem").groupBy("l_returnflag").agg(q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.995).alias("q995"))


@Q("a17_company_rollup", "A17", """WITH f AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, string_agg(o_orderstatus || ':' || n, '|' ORDER BY n DESC, o_orderstatus) AS labels FROM f GROUP BY o_custkey""")
def _(spark, d):
    f = T(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    items = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), "o_orderstatus", F.concat_ws(":", "o_orderstatus", "n").alias("s"))))
    return f.groupBy("o_custkey").agg(F.array_join(F.transform(items, lambda x: x["s"]), "|").alias("labels"))


@Q("a18_histogram_of_counts", "A18", "SELECT n AS size, count(*) AS batches FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY n")
def _(spark, d):
    return T(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("batches"))


@Q("a19_province_summary", "A19", """SELECT region, count(DISTINCT task_id) AS tasks, count(DISTINCT plan_id) AS plans FROM (SELECT coalesce(region, 'unmapped') AS region, task_id, plan_id FROM search_task) GROUP BY region""")
def _(spark, d):
    return T(spark, d, "search_task").groupBy(F.coalesce("region", F.lit("unmapped")).alias("region")).agg(F.count_distinct("task_id").alias("tasks"), F.count_distinct("plan_id").alias("plans"))


@Q("a20_dashboard_metrics", "A20", """SELECT count(*) AS tracks, count(*) FILTER (WHERE status = 'candidate') AS candidates, round(avg(confidence), 6) AS confidence, count(*) FILTER (WHERE len(topic_ids) >= 3) AS hot FROM track""")
def _(spark, d):
    return T(spark, d, "track").agg(F.count("*").alias("tracks"), F.count_if(F.col("status") == "candidate").alias("candidates"), F.round(F.avg("confidence"), 6).alias("confidence"), F.count_if(F.size("topic_ids") >= 3).alias("hot"))


@Q("a22_transitions", "A22", """WITH e AS (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT before || '->' || event_type AS transition, count(*) AS n FROM e WHERE before IS NOT NULL GROUP BY 1""")
def _(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = T(spark, d, "events").withColumn("before", F.lag("event_type").over(w)).where("before is not null")
    return e.groupBy(F.concat_ws("->", "before", "event_type").alias("transition")).agg(F.count("*").alias("n"))


@Q("w01_latest_per_key", "W1", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn = 1")
def _(spark, d):
    return R.latest_per_key(T(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@Q("w03_rank_tier", "W3 L4", """SELECT l_orderkey, l_linenumber, CASE WHEN rn <= 100 THEN 'core' ELSE 'extended' END AS tier, rn AS global_rank FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) rn FROM lineitem) WHERE rn <= 200""")
def _(spark, d):
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    top = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(*order).limit(200)  # ranks are global only over the top
    ranked = top.withColumn("global_rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    return ranked.select("l_orderkey", "l_linenumber", F.when(F.col("global_rank") <= 100, "core").otherwise("extended").alias("tier"), "global_rank")


@Q("w09_recent_source_diverse", "W9", """SELECT site, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY published_on DESC NULLS LAST, doc_id) r2 FROM (SELECT *, row_number() OVER (PARTITION BY site, source ORDER BY published_on DESC NULLS LAST, doc_id) r1 FROM documents WHERE site IS NOT NULL) WHERE r1 = 1) WHERE r2 <= 2""")
def _(spark, d):
    order = [F.desc_nulls_last("published_on"), F.asc("doc_id")]
    one = R.latest_per_key(T(spark, d, "documents").where("site is not null").select("site", "source", "published_on", "doc_id"), ["site", "source"], order)
    return R.budgeted(one, "site", order, F.lit(2)).select("site", "doc_id")


@Q("w10_sequence_after_dedupe", "W10 J16", """SELECT task_id, refer, row_number() OVER (PARTITION BY task_id ORDER BY first_id) AS seq FROM (SELECT task_id, refer, min(result_id) AS first_id FROM search_result WHERE task_id IS NOT NULL GROUP BY 1, 2)""")
def _(spark, d):
    g = T(spark, d, "search_result").where("task_id is not null").groupBy("task_id", "refer").agg(F.min("result_id").alias("first_id"))
    return g.select("task_id", "refer", F.row_number().over(Window.partitionBy("task_id").orderBy("first_id")).cast("bigint").alias("seq"))


@Q("w11_budget_admission", "W11", """SELECT o_custkey, o_orderkey, rn AS admitted_rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) rn FROM orders WHERE o_orderstatus <> 'P') WHERE rn <= 3""")
def _(spark, d):
    return R.budgeted(T(spark, d, "orders").where("o_orderstatus <> 'P'"), "o_custkey", [F.col("o_orderkey")], F.lit(3)).select("o_custkey", "o_orderkey", F.col("admitted_rank").cast("bigint").alias("admitted_rank"))


@Q("w12_stratified_sample", "W12", """SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(cast(doc_id AS VARCHAR))) rn FROM documents WHERE source IS NOT NULL) ORDER BY rn, source LIMIT 40""")
def _(spark, d):
    return R.stratified(T(spark, d, "documents").where("source is not null"), "source", "doc_id", 40).select("doc_id", "source")


@Q("w13_window_halves", "W13", """SELECT o_custkey, (min(o_orderdate)::DATE + ((max(o_orderdate)::DATE - min(o_orderdate)::DATE) // 2)::INTEGER)::DATE AS middle FROM orders GROUP BY o_custkey""")
def _(spark, d):
    g = T(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    return g.select("o_custkey", F.expr("date_add(lo, cast(floor(date_diff(hi, lo) / 2) as int))").alias("middle"))


@Q("l02_resort_after_limit", "L2 L6", """SELECT p_partkey, p_name FROM (SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 30) ORDER BY lower(p_name), p_partkey""")
def _(spark, d):
    return T(spark, d, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(30).orderBy(F.lower("p_name"), "p_partkey").select("p_partkey", "p_name")


@Q("u01_unassigned", "U1", "SELECT topic_id FROM topic EXCEPT SELECT unnest(topic_ids) FROM track")
def _(spark, d):
    return T(spark, d, "topic").select("topic_id").subtract(T(spark, d, "track").select(F.explode("topic_ids").alias("topic_id")))


@Q("u04_edge_ablation", "U4 U5", """WITH e AS (SELECT DISTINCT a.track_id AS a, b.track_id AS b FROM (SELECT track_id, unnest(topic_ids) t FROM track) a JOIN (SELECT track_id, unnest(topic_ids) t FROM track) b ON a.t = b.t AND a.track_id < b.track_id), f AS (SELECT a, b FROM e JOIN track x ON x.track_id = a JOIN track y ON y.track_id = b WHERE x.supplier_role = y.supplier_role) SELECT a, b FROM e EXCEPT SELECT a, b FROM f""")
def _(spark, d):
    m = T(spark, d, "track").select("track_id", "supplier_role", F.explode("topic_ids").alias("t"))
    j = m.alias("x").join(m.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("x.track_id") < F.col("y.track_id")))
    e = j.select(F.col("x.track_id").alias("a"), F.col("y.track_id").alias("b"), (F.col("x.supplier_role") == F.col("y.supplier_role")).alias("same"))
    return e.select("a", "b").subtract(e.where("same").select("a", "b"))


ENCODED = "replace(url_encode(%s), '%%20', '+')"


@Q("f01_canonical_url", "F1", r"""WITH u AS (SELECT DISTINCT url FROM search_result WHERE url IS NOT NULL), p AS (SELECT url, lower(regexp_extract(url, '^(https?)://', 1)) AS s, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS h, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: x <> '') AS q FROM u),
k AS (SELECT *, list_sort(list_filter(list_transform(q, lambda x: {'k': url_decode(replace(split_part(x, '=', 1), '+', ' ')), 'v': url_decode(replace(regexp_replace(x, '^[^=]*=?', ''), '+', ' '))}), lambda x: NOT starts_with(lower(x.k), 'utm_') AND lower(x.k) NOT IN ('""" + "', '".join(X.TRACKING) + """'))) AS l FROM p)
SELECT url, s || '://' || h || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(l) = 0 THEN '' ELSE '?' || array_to_string(list_transform(l, lambda x: """ + ENCODED % "x.k" + " || '=' || " + ENCODED % "x.v" + """), '&') END AS canonical FROM k""")
def _(spark, d):
    return T(spark, d, "search_result").select("url").where("url is not null").distinct().select("url", X.canonical_url(F.col("url")).alias("canonical"))


E = f"regexp_replace(%s, '{X.EDGES}', '', 'g')"


@Q("f03_clean_lines", "F3", f"""SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split(replace(replace(text, chr(160), ' '), chr(8203), ''), chr(10)), lambda x: {E % ("regexp_replace(x, '" + X.BLANKS + "+', ' ', 'g')")}), lambda x: x <> ''), chr(10))) AS cleaned FROM documents WHERE text IS NOT NULL""")
def _(spark, d):
    return T(spark, d, "documents").where("text is not null").select("doc_id", F.md5(X.clean_lines(F.col("text"))).alias("cleaned"))


FLAT = f"regexp_replace(regexp_replace(coalesce(text, ''), '{X.WIDE}+', ' ', 'g'), '{X.EDGES}', '', 'g')"


@Q("f08_quality_gate", "F8 P11", f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, {FLAT} AS f FROM documents), r AS (SELECT doc_id, CASE WHEN f = '' THEN 'empty_body' WHEN """ + " OR ".join(f"contains(lower(f), '{m}')" for m in X.BLOCK_MARKERS) + f""" THEN 'access_or_javascript_placeholder' WHEN length(f) < 200 THEN 'body_below_minimum_length'
WHEN length(f) > 1200 AND len(list_filter(regexp_split_to_array(t, '{X.LINE_ENDS}'), lambda x: length({E % "x"}) >= 30)) = 0 THEN 'no_substantive_paragraphs' ELSE 'ok' END AS reason FROM t)
SELECT doc_id, reason, CASE WHEN reason = 'ok' THEN 'usable' ELSE 'remote_reader_required' END AS status, CASE WHEN reason = 'ok' THEN 'usable' WHEN reason IN ('empty_body', 'body_below_minimum_length') THEN 'ocr_required' ELSE 'remote_reader_required' END AS as_scan FROM r""")
def _(spark, d):
    status, reason = X.quality_gate(F.col("text"), 200)
    return T(spark, d, "documents").select("doc_id", reason.alias("reason"), status.alias("status"), X.quality_gate(F.col("text"), 200, True)[0].alias("as_scan"))


@Q("f09_evidence_form", "F9", r"""SELECT DISTINCT result_id, md5(lower(regexp_replace(regexp_replace(snippet, '\^?\[\d+\]\^?', '', 'g'), '[^\p{L}\p{N}]', '', 'g'))) AS form FROM search_result WHERE snippet IS NOT NULL""")
def _(spark, d):
    return T(spark, d, "search_result").where("snippet is not null").select("result_id", F.md5(X.evidence_form(F.col("snippet"))).alias("form")).distinct()


@Q("f11_material_numbers", "F11", f"""SELECT doc_id, array_to_string(list_distinct_in_order, '|') AS numbers FROM (SELECT doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: CASE WHEN list_position(m, m[i]) = i THEN m[i] END), lambda x: x IS NOT NULL) AS list_distinct_in_order FROM (SELECT doc_id, regexp_extract_all(text, '{X.NUMBER}') AS m FROM documents WHERE text IS NOT NULL))""")
def _(spark, d):
    return T(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(X.material_numbers(F.col("text")), "|").alias("numbers"))


@Q("f13_clip_compact", "F13", """SELECT doc_id, md5(CASE WHEN length(text) <= 200 THEN text ELSE rtrim(substr(text, 1, 144)) || '…' || substr(text, length(text) - 55 + 1) END) AS clipped FROM documents WHERE text IS NOT NULL""")
def _(spark, d):
    return T(spark, d, "documents").where("text is not null").select("doc_id", F.md5(X.clipped(F.col("text"), 200)).alias("clipped"))


@Q("f16_expand_scope", "F16", f"""WITH r AS (SELECT plan_id, CASE WHEN list_contains(regions, '{X.COUNTRY}') OR len(regions) = 0 THEN ['{X.COUNTRY}', '""" + "', '".join(X.REGIONS) + """'] || regions ELSE regions END AS m FROM research_plan)
SELECT plan_id, array_to_string(list_filter(list_transform(range(1, len(m) + 1), lambda i: CASE WHEN list_position(m, m[i]) = i THEN m[i] END), lambda x: x IS NOT NULL), '|') AS scope FROM r""")
def _(spark, d):
    # a plan without regions is one for the whole country
    regions = F.when(F.size("regions") == 0, F.array(F.lit(X.COUNTRY))).otherwise(F.col("regions"))
    return T(spark, d, "research_plan").select("plan_id", F.array_join(X.expanded_scope(regions), "|").alias("scope"))


@Q("f22_tf_idf", "F22", r"""WITH w AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents), t AS (SELECT id, term, count(*) AS tf FROM w GROUP BY 1, 2), n AS (SELECT count(DISTINCT id) AS n FROM t), f AS (SELECT term, count(*) AS df FROM t GROUP BY 1)
SELECT id AS doc_id, term, round((1 + ln(tf)) * ln((n + 1) / (df + 1)), 6) AS weight FROM t JOIN f USING (term), n""")
def _(spark, d):
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    w = retrieval.tf_idf(T(spark, d, "documents").select(F.col("doc_id").alias("id"), words.alias("term")))
    return w.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@Q("f35_json_fallback", "F35", r"""WITH a AS (SELECT event_id, 'The answer: ' || props || ' - end' AS noisy FROM events WHERE props IS NOT NULL) SELECT event_id, CASE WHEN json_valid(regexp_extract(noisy, '(?s)(\{.*\})', 1)) THEN regexp_extract(noisy, '(?s)(\{.*\})', 1) END AS answer FROM a""")
def _(spark, d):
    noisy = F.concat(F.lit("The answer: "), "props", F.lit(" - end"))
    return T(spark, d, "events").where("props is not null").select("event_id", X.json_object(noisy).alias("answer"))


@Q("f18_company_forms", "F18", f"""SELECT result_id, lower(regexp_replace(regexp_replace(coalesce(media, ''), '{X.WIDE}+', '', 'g'), '{X.NAME_SIGNS}', '', 'g')) AS form, coalesce(""" + " + ".join(f"contains(snippet, '{p}')::INT" for p in X.REGISTER_PHRASES) + """ >= 3, false) AS boilerplate FROM (SELECT DISTINCT result_id, media, snippet FROM search_result)""")
def _(spark, d):
    r = T(spark, d, "search_result").select("result_id", "media", "snippet").distinct()
    return r.select("result_id", X.company_form(F.col("media")).alias("form"), X.is_register_profile(F.col("snippet")).alias("boilerplate"))


@Q("f23_weighted_terms", "F23 A15", """WITH t AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS term FROM part), df AS (SELECT term, count(DISTINCT p_partkey) AS df FROM t GROUP BY term), n AS (SELECT count(*) AS n FROM part) SELECT t.p_partkey, t.term, round((ln((n + 1.0) / (df + 1)) + 1) * 6, 4) AS weight FROM (SELECT DISTINCT * FROM t) t JOIN df USING (term), n""")
def _(spark, d):
    p = T(spark, d, "part")
    t = p.select("p_partkey", F.explode(F.split(F.lower("p_name"), " ")).alias("term")).distinct()
    df = t.groupBy("term").agg(F.count("*").alias("df"))
    n = p.agg(F.count("*").alias("n"))
    return t.join(df, "term").crossJoin(F.broadcast(n)).select("p_partkey", "term", F.round((F.log((F.col("n") + 1.0) / (F.col("df") + 1)) + 1) * 6, 4).alias("weight"))  # one row


@Q("f28_evidence_grade", "F28", """SELECT o_orderkey, CASE WHEN count(l_linenumber) >= 5 AND count(DISTINCT l_suppkey) >= 3 THEN 'A' WHEN count(l_linenumber) >= 3 THEN 'B' WHEN count(l_linenumber) >= 1 THEN 'C' ELSE 'D' END AS grade FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def _(spark, d):
    l = T(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("s"))
    o = T(spark, d, "orders").select("o_orderkey").join(l, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select("o_orderkey", F.when((F.col("n") >= 5) & (F.col("s") >= 3), "A").when(F.col("n") >= 3, "B").when(F.col("n") >= 1, "C").otherwise("D").alias("grade"))


@Q("f34_fingerprint", "F34", """SELECT c_custkey, sha256('{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '"}') AS fingerprint FROM customer WHERE c_mktsegment IS NOT NULL AND c_name IS NOT NULL""")
def _(spark, d):
    c = T(spark, d, "customer").where("c_mktsegment is not null and c_name is not null")
    return c.select("c_custkey", X.fingerprint(("c_name", F.col("c_name")), ("c_mktsegment", F.col("c_mktsegment"))).alias("fingerprint"))


@Q("g14_fixed_batches", "G14", """SELECT o_custkey, o_orderkey, cast((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS BIGINT) AS batch FROM orders""")
def _(spark, d):
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return T(spark, d, "orders").select("o_custkey", "o_orderkey", F.floor((r - 1) / 5).cast("bigint").alias("batch"))


@Q("g18_rule_curation", "G18", """WITH r(role, action) AS (VALUES ('maker', 'KEEP'), ('integrator', 'REDEFINE'), ('operator', 'DELETE')) SELECT t.track_id, coalesce(r.action, 'KEEP') AS action, CASE WHEN r.action = 'REDEFINE' THEN t.name || ' *' ELSE t.name END AS name FROM track t LEFT JOIN r ON r.role = t.supplier_role WHERE r.action IS DISTINCT FROM 'DELETE'""")
def _(spark, d):
    rules = spark.createDataFrame([("maker", "KEEP"), ("integrator", "REDEFINE"), ("operator", "DELETE")], "supplier_role string, action string")
    t = T(spark, d, "track").join(rules, "supplier_role", "left").where("action is distinct from 'DELETE'")
    return t.select("track_id", F.coalesce("action", F.lit("KEEP")).alias("action"), F.when(F.col("action") == "REDEFINE", F.concat("name", F.lit(" *"))).otherwise(F.col("name")).alias("name"))


@Q("g20_catalog_enrich", "G20", """SELECT u.track_id, u.topic_id, t.label IS NOT NULL AS known FROM (SELECT track_id, unnest(topic_ids) AS topic_id FROM track) u LEFT JOIN topic t ON t.topic_id = u.topic_id""")
def _(spark, d):
    u = T(spark, d, "track").select("track_id", F.explode("topic_ids").alias("topic_id"))
    return u.join(T(spark, d, "topic").select("topic_id", "label"), "topic_id", "left").select("track_id", "topic_id", F.col("label").isNotNull().alias("known"))


@Q("t03_lease_expiry", "T2 T3", """SELECT DISTINCT task_id, CASE WHEN status = 'running' AND (started_at IS NULL OR started_at < TIMESTAMP '2026-01-01') THEN CASE WHEN completion_reason IS NULL THEN 'failed_retryable' ELSE 'failed_terminal' END ELSE status END AS status FROM search_task""")
def _(spark, d):
    expired = (F.col("status") == "running") & (F.col("started_at").isNull() | (F.col("started_at") < F.lit("2026-01-01").cast("timestamp_ntz")))
    s = F.when(expired, F.when(F.col("completion_reason").isNull(), "failed_retryable").otherwise("failed_terminal")).otherwise(F.col("status"))
    return T(spark, d, "search_task").select("task_id", s.alias("status")).distinct()
