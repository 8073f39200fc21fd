"""Queries of the evidence pipeline's text rules, caches, lineage, sampling and read surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import evidence, relational as R
from ..sources.tables import table as T
from .registry import CORE

Q = CORE.add
IN_GENERIC = ", ".join(f"'{g}'" for g in X.GENERIC_TERMS)


@Q("s13_numbered_sources", "S13 W2", """SELECT task_id, url, 'ref_' || row_number() OVER (PARTITION BY task_id ORDER BY first_id) AS refer FROM (SELECT task_id, url, min(result_id) AS first_id FROM search_result WHERE task_id IS NOT NULL AND url IS NOT NULL GROUP BY 1, 2)""")
def _(spark: SparkSession, d: str) -> DataFrame:
    g = T(spark, d, "search_result").where("task_id is not null and url is not null").groupBy("task_id", "url").agg(F.min("result_id").alias("first_id"))
    return g.select("task_id", "url", F.concat(F.lit("ref_"), F.row_number().over(Window.partitionBy("task_id").orderBy("first_id"))).alias("refer"))


@Q("s14_import_once", "S14", """SELECT n.plan_id FROM research_plan n WHERE n.status = 'pending' AND NOT EXISTS (SELECT 1 FROM research_plan o WHERE o.status = 'completed' AND sha256(array_to_string(o.regions, '|')) = sha256(array_to_string(n.regions, '|')))""")
def _(spark, d):
    p = T(spark, d, "research_plan").withColumn("import_key", F.sha2(F.array_join("regions", "|"), 256))
    return R.insert_missing(p.where("status = 'completed'"), p.where("status = 'pending'"), ["import_key"]).select("plan_id")


@Q("s16_vector_cache_miss", "S16", """SELECT t.vec_id FROM topic_vectors t WHERE NOT EXISTS (SELECT 1 FROM topic_vectors c WHERE c.vec_id = t.vec_id AND len(c.vector) = 64 AND c.model_version = 'v2')""")
def _(spark, d):
    t = T(spark, d, "topic_vectors")
    return R.insert_missing(t.where("size(vector) = 64 and model_version = 'v2'").select("vec_id"), t.select("vec_id"), ["vec_id"])


@Q("s17_cache_validity", "S17 S7", """SELECT a.result_id, a.h IS NOT DISTINCT FROM b.h AS valid FROM (SELECT result_id, min(md5(snippet)) AS h FROM search_result GROUP BY 1) a JOIN (SELECT result_id, min(md5(extracted_text)) AS h FROM remote_page_result GROUP BY 1) b USING (result_id)""")
def _(spark, d):
    a = T(spark, d, "search_result").groupBy("result_id").agg(F.min(F.md5("snippet")).alias("h"))
    b = T(spark, d, "remote_page_result").groupBy("result_id").agg(F.min(F.md5("extracted_text")).alias("g"))
    return a.join(b, "result_id").select("result_id", F.col("h").eqNullSafe(F.col("g")).alias("valid"))


@Q("p12_event_support", "P12 F11", rf"""WITH e AS (SELECT DISTINCT s.result_id, s.title, s.snippet, lower(regexp_replace(s.snippet, '[^\p{{L}}\p{{N}}]', '', 'g')) AS q FROM search_result s WHERE s.title IS NOT NULL AND s.snippet IS NOT NULL)
SELECT result_id, length(q) >= 20 AND q <> lower(regexp_replace(title, '[^\p{{L}}\p{{N}}]', '', 'g')) AND list_has_all(regexp_extract_all(snippet, '{X.NUMBER}'), regexp_extract_all(title, '{X.NUMBER}')) AS supported FROM e""")
def _(spark, d):
    s = T(spark, d, "search_result").where("title is not null and snippet is not null").select("result_id", "title", "snippet").distinct()
    form = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    numbers = F.size(F.array_except(X.material_numbers(F.col("title")), X.material_numbers(F.col("snippet")))) == 0
    return s.select("result_id", ((F.length(form("snippet")) >= 20) & (form("snippet") != form("title")) & numbers).alias("supported"))


@Q("p20_generic_text", "P20", "SELECT topic_id FROM topic WHERE definition IS NULL OR (starts_with(definition, '据') AND contains(definition, '介绍'))")
def _(spark, d):
    c = F.col("definition")
    return T(spark, d, "topic").where(c.isNull() | (c.startswith("据") & c.contains("介绍"))).select("topic_id")


@Q("p21_index_clamp", "P21", "SELECT track_id, array_to_string(list_sort(list_distinct(list_filter([0, 1, 1, 2, 5], lambda x: x < len(coalesce(topic_ids, []))))), '|') AS kept FROM track")
def _(spark, d):
    size = F.coalesce(F.size("topic_ids"), F.lit(0))
    kept = F.array_sort(F.array_distinct(F.filter(F.array(*[F.lit(i) for i in (0, 1, 1, 2, 5)]), lambda x: x < size)))
    return T(spark, d, "track").select("track_id", F.array_join(kept.cast("array<string>"), "|").alias("kept"))


@Q("p23_misplaced_evidence", "P23", """WITH v AS (SELECT k.track_id, count(*) AS n, count(t.topic_id) AS ok FROM (SELECT track_id, unnest(topic_ids) AS m FROM track) k LEFT JOIN (SELECT topic_id FROM topic WHERE status = 'active') t ON t.topic_id = k.m GROUP BY 1) SELECT track_id, CASE WHEN ok > 0 THEN ok ELSE n END AS kept FROM v""")
def _(spark, d):
    k = T(spark, d, "track").select("track_id", F.explode("topic_ids").alias("topic_id"))
    ok = T(spark, d, "topic").where("status = 'active'").select("topic_id", F.lit(1).alias("there"))
    v = k.join(ok, "topic_id", "left").groupBy("track_id").agg(F.count("*").alias("n"), F.count("there").alias("ok"))
    return v.select("track_id", F.when(F.col("ok") > 0, F.col("ok")).otherwise(F.col("n")).alias("kept"))


@Q("p24_exclude_assigned", "P24", "SELECT topic_id FROM topic t WHERE status IS DISTINCT FROM 'active' AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(topic_ids) AS m FROM track) k WHERE k.m = t.topic_id)")
def _(spark, d):
    used = T(spark, d, "track").select(F.explode("topic_ids").alias("topic_id"))
    return T(spark, d, "topic").where("status is distinct from 'active'").join(used, "topic_id", "left_anti").select("topic_id")


@Q("j14_alias_prefix", "J14 F14", f"""WITH t AS (SELECT DISTINCT task_id, region, query FROM search_task WHERE region IS NOT NULL) SELECT region, count(*) AS tasks FROM t WHERE CASE WHEN region = '{X.COUNTRY}' THEN """ + " OR ".join(f"contains(query, '{w}')" for w in X.NATIONAL_WORDS) + f""" ELSE contains(query, regexp_replace(region, '(?:{'|'.join(X.REGION_ENDINGS)})$', '')) END GROUP BY region""")
def _(spark, d):
    s = T(spark, d, "search_task").where("region is not null").select("task_id", "region", "query").distinct()
    return s.where(X.is_regional(F.col("query"), F.col("region"))).groupBy("region").agg(F.count("*").alias("tasks"))


@Q("f15_date_scrub", "F15", f"""SELECT DISTINCT task_id, CASE WHEN region IS NULL OR contains(q, region) THEN q ELSE region || ' ' || q END AS scoped FROM (SELECT task_id, region, regexp_replace(regexp_replace(regexp_replace(query, '\\d{{4}}年(?:\\d{{1,2}}月)?(?:\\d{{1,2}}日)?|\\d{{4}}-\\d{{1,2}}(?:-\\d{{1,2}})?', ' ', 'g'), '{X.BLANKS}+', ' ', 'g'), '{X.EDGES}', '', 'g') AS q FROM search_task)""")
def _(spark, d):
    return T(spark, d, "search_task").select("task_id", X.scrubbed_query(F.col("query"), F.col("region")).alias("scoped")).distinct()


@Q("f17_normalise_term", "F17")
def _(spark, d):
    return T(spark, d, "topic").select("topic_id", X.normal_term(F.col("label")).alias("term"))


@Q("f21_script_bigrams", "F21", r"""SELECT topic_id, cast(len(list_distinct(flatten(list_transform(regexp_extract_all(lower(label), '\p{Han}{2,}|[a-z0-9]{2,}'), lambda r: list_transform(range(1, length(r)), lambda i: substr(r, i, 2)))))) AS BIGINT) AS grams FROM topic""")
def _(spark, d):
    runs = F.regexp_extract_all(F.lower("label"), F.lit(r"\p{IsHan}{2,}|[a-z0-9]{2,}"), F.lit(0))
    return T(spark, d, "topic").select("topic_id", F.size(F.array_distinct(F.flatten(F.transform(runs, lambda r: X.grams(r, 2))))).cast("bigint").alias("grams"))


@Q("f29_audit_labels", "F29", """SELECT track_id, array_to_string(list_filter([CASE WHEN regexp_matches(name, '租赁|服务') THEN 'service' END, CASE WHEN regexp_matches(name, '制造|装备') THEN 'product' END, CASE WHEN confidence < 0.8 THEN 'weak' END], lambda x: x IS NOT NULL), '|') AS labels FROM track""")
def _(spark, d):
    n = F.col("name")
    rules = F.array(F.when(n.rlike("租赁|服务"), "service"), F.when(n.rlike("制造|装备"), "product"), F.when(F.col("confidence") < 0.8, "weak"))
    return T(spark, d, "track").select("track_id", F.array_join(F.array_compact(rules), "|").alias("labels"))


@Q("f31_profile_contract", "F31", """SELECT plan_id, array_to_string(list_transform(regions[1:3], lambda r: substr(r, 1, 2)), '|') AS facts, CASE WHEN len(regions) = 0 THEN 'insufficient' ELSE 'sufficient' END AS information_status FROM research_plan""")
def _(spark, d):
    return T(spark, d, "research_plan").select("plan_id", F.array_join(F.transform(F.slice("regions", 1, 3), lambda r: F.substring(r, 1, 2)), "|").alias("facts"), F.when(F.size("regions") == 0, "insufficient").otherwise("sufficient").alias("information_status"))


@Q("f32_term_compiler", "F32 F33", """SELECT topic_id, cast(len(list_distinct(list_filter(string_split(lower(label), ' '), lambda t: length(t) BETWEEN 2 AND 40))) AS BIGINT) AS terms, coalesce(nullif(definition, ''), label) AS text FROM topic""")
def _(spark, d):
    terms = F.array_distinct(F.filter(F.split(F.lower("label"), " "), lambda t: F.length(t).between(2, 40)))
    return T(spark, d, "topic").select("topic_id", F.size(terms).cast("bigint").alias("terms"), F.coalesce(F.nullif("definition", F.lit("")), "label").alias("text"))


@Q("f36_iso_date", "F36 F6", r"""SELECT DISTINCT result_id, CASE WHEN regexp_matches(publish_date, '^\d{4}-\d{2}-\d{2}') THEN try_cast(substr(publish_date, 1, 10) AS DATE) END AS published FROM search_result""")
def _(spark, d):
    iso = F.when(F.col("publish_date").rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring("publish_date", 1, 10).try_cast("date"))
    return T(spark, d, "search_result").select("result_id", iso.alias("published")).distinct()


@Q("f37_support_anchor", "F37", f"""WITH p AS (SELECT k.track_id, t.topic_id, lower(t.label) AS label, lower(k.name) AS name, coalesce(lower(k.offering_family), '') AS family FROM (SELECT track_id, name, offering_family, unnest(topic_ids) AS m FROM track) k JOIN topic t ON t.topic_id = k.m), c AS (SELECT *, unnest(range(0, length(label) - 1)) AS cut FROM p WHERE label NOT IN ({IN_GENERIC})), s AS (SELECT *, unnest(range(1, cut + 2)) AS i FROM c), f AS (SELECT *, substr(label, i, length(label) - cut) AS part FROM s)
SELECT track_id, topic_id, arg_min(part, cut * 1000 + i) AS anchor FROM f WHERE (contains(name, part) OR contains(family, part)) AND part NOT IN ({IN_GENERIC}) GROUP BY 1, 2""")
def _(spark, d):
    k = T(spark, d, "track").select("track_id", "name", "offering_family", F.explode("topic_ids").alias("topic_id"))
    j = k.join(T(spark, d, "topic").select("topic_id", "label"), "topic_id")
    found = X.anchor(F.col("label"), [F.col("name"), F.col("offering_family")], X.GENERIC_TERMS)
    return j.select("track_id", "topic_id", found.alias("anchor")).where("anchor is not null").distinct()


@Q("f38_linkage", "F38", r"""SELECT DISTINCT result_id, regexp_matches(snippet, '(?:采购|交付|中标)[^。；\n]{0,60}\Q逆变器\E|\Q逆变器\E[^。；\n]{0,60}(?:采购|交付|中标)') AS linked FROM search_result WHERE snippet IS NOT NULL""")
def _(spark, d):
    return T(spark, d, "search_result").where("snippet is not null").select("result_id", X.linked(F.col("snippet"), "逆变器", ["采购", "交付", "中标"]).alias("linked")).distinct()


@Q("w07_representative_events", "W7", """WITH r AS (SELECT task_id, result_id, any_value(source_class) AS kind, any_value(title) AS title FROM search_result WHERE task_id IS NOT NULL GROUP BY task_id, result_id),
f AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY kind NULLS LAST, result_id) AS n FROM r), one AS (SELECT task_id, result_id, kind, title FROM f WHERE n = 1),
o AS (SELECT r.*, r.kind IS DISTINCT FROM one.kind AS fresh FROM r JOIN one USING (task_id) WHERE r.title IS DISTINCT FROM one.title),
two AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY NOT fresh, CASE WHEN fresh THEN kind IS NULL END, CASE WHEN fresh THEN kind END NULLS LAST, result_id) AS n FROM o)
SELECT task_id, result_id, 1 AS pick FROM one UNION ALL SELECT task_id, result_id, 2 FROM two WHERE n = 1""")
def _(spark, d):
    r = T(spark, d, "search_result").where("task_id is not null").select("task_id", "result_id", F.col("source_class").alias("kind"), "title").dropDuplicates(["task_id", "result_id"])
    return evidence.representatives(r, "task_id", "kind", "title", "result_id").select("task_id", "result_id", "pick")


@Q("f10_evidence_offsets", "F10 J13")
def _(spark, d):
    """Where shortened and marked quotes of snippets stand in the snippets."""
    texts = T(spark, d, "search_result").where("length(snippet) >= 60").select("result_id", F.col("snippet").alias("text")).dropDuplicates(["result_id"])
    quote = F.concat(F.substring("text", 1, 20), F.lit("^[1]^"), F.substring("text", 21, 5), F.lit(" … "), F.upper(F.substring("text", 35, 20)))
    return evidence.located(texts, texts.select(F.col("result_id").alias("quote_id"), "result_id", quote.alias("quote")), "result_id")


@Q("g17_lineage", "G17", """SELECT p.plan_id, count(DISTINCT t.task_id) AS tasks, count(DISTINCT s.result_id) AS results, count(DISTINCT r.page_id) AS pages FROM research_plan p LEFT JOIN search_task t ON t.plan_id = p.plan_id LEFT JOIN search_result s ON s.task_id = t.task_id LEFT JOIN remote_page_result r ON r.result_id = s.result_id GROUP BY p.plan_id""")
def _(spark, d):
    # counts are taken below each join, so no chain of rows is multiplied
    pages = T(spark, d, "remote_page_result").select("page_id", "result_id").distinct().groupBy("result_id").agg(F.count("*").alias("pages"))
    results = T(spark, d, "search_result").select("result_id", "task_id").distinct().join(pages, "result_id", "left").groupBy("task_id").agg(F.count("*").alias("results"), F.sum("pages").alias("pages"))
    tasks = T(spark, d, "search_task").select("task_id", "plan_id").distinct().join(results, "task_id", "left").groupBy("plan_id").agg(F.count("*").alias("tasks"), F.sum("results").alias("results"), F.sum("pages").alias("pages"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("tasks", "results", "pages")]
    return T(spark, d, "research_plan").select("plan_id").join(tasks, "plan_id", "left").select("plan_id", *zero)


@Q("g19_primary_group", "G19 J16", """WITH t AS (SELECT task_id, min(plan_id) AS plan_id FROM search_task GROUP BY task_id) SELECT coalesce(t.plan_id, 'unscoped') AS plan_id, count(DISTINCT s.result_id) AS results FROM search_result s LEFT JOIN t ON t.task_id = s.task_id GROUP BY 1""")
def _(spark, d):
    t = T(spark, d, "search_task").groupBy("task_id").agg(F.min("plan_id").alias("plan_id"))
    return T(spark, d, "search_result").join(t, "task_id", "left").groupBy(F.coalesce("plan_id", F.lit("unscoped")).alias("plan_id")).agg(F.count_distinct("result_id").alias("results"))


@Q("d01_decision_revocation", "K4 W1", """SELECT url, CASE min(CASE decision WHEN 'keep' THEN 1 WHEN 'maybe' THEN 2 ELSE 3 END) WHEN 1 THEN 'keep' WHEN 2 THEN 'maybe' ELSE 'drop' END AS decision FROM search_result WHERE url IS NOT NULL AND task_id IS NOT NULL GROUP BY url""")
def _(spark, d):
    r = T(spark, d, "search_result").where("url is not null and task_id is not null")
    rank = F.min(F.when(F.col("decision") == "keep", 1).when(F.col("decision") == "maybe", 2).otherwise(3))
    return r.groupBy("url").agg(rank.alias("r")).select("url", F.when(F.col("r") == 1, "keep").when(F.col("r") == 2, "maybe").otherwise("drop").alias("decision"))


@Q("d02_pivot_roles", "A7", """SELECT offering_family, string_agg(track_id, '|' ORDER BY track_id) FILTER (WHERE supplier_role = 'maker') AS makers, string_agg(track_id, '|' ORDER BY track_id) FILTER (WHERE supplier_role = 'integrator') AS integrators FROM track GROUP BY offering_family""")
def _(spark, d):
    ids = lambda role: F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(F.col("supplier_role") == role, F.col("track_id")))), "|"), F.lit(""))
    return T(spark, d, "track").groupBy("offering_family").agg(ids("maker").alias("makers"), ids("integrator").alias("integrators"))


@Q("d03_partition_jaccard", "U5", """WITH a AS (SELECT x.track_id AS i, y.track_id AS j FROM track x JOIN track y ON x.offering_family = y.offering_family AND x.track_id < y.track_id), b AS (SELECT x.track_id AS i, y.track_id AS j FROM track x JOIN track y ON x.supplier_role = y.supplier_role AND x.track_id < y.track_id)
SELECT round((SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) * 1.0 / (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)), 6) AS jaccard""")
def _(spark, d):
    # pairs are counted from group sizes, never formed
    t = T(spark, d, "track").where("offering_family is not null or supplier_role is not null")

    def pairs(keys: list[str]) -> DataFrame:
        g = t.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n"))
        return g.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0)).alias("_".join(keys)))

    a, b, both = pairs(["offering_family"]), pairs(["supplier_role"]), pairs(["offering_family", "supplier_role"])
    one = a.crossJoin(b).crossJoin(both)  # one row each
    c = F.col("offering_family_supplier_role")
    return one.select(F.round(c / (F.col("offering_family") + F.col("supplier_role") - c), 6).alias("jaccard"))


@Q("d05_ref_order", "L1", """SELECT task_id, string_agg(refer, '|' ORDER BY cast(regexp_extract(refer, '_(\\d+)$', 1) AS INTEGER), refer) AS refs FROM (SELECT DISTINCT task_id, refer FROM search_result WHERE task_id IS NOT NULL AND regexp_matches(refer, '_\\d+$')) GROUP BY task_id""")
def _(spark, d):
    r = T(spark, d, "search_result").where(F.col("task_id").isNotNull() & F.col("refer").rlike(r"_\d+$")).select("task_id", "refer").distinct()
    items = F.array_sort(F.collect_list(F.struct(F.regexp_extract("refer", r"_(\d+)$", 1).cast("int").alias("n"), "refer")))
    return r.groupBy("task_id").agg(F.array_join(F.transform(items, lambda x: x["refer"]), "|").alias("refs"))


@Q("c01_track_show", "P1", """SELECT k.track_id, k.name, k.status, cast(len(k.topic_ids) AS BIGINT) AS topics, string_agg(t.label, '|' ORDER BY t.label) AS labels FROM track k LEFT JOIN (SELECT track_id, unnest(topic_ids) AS m FROM track) u ON u.track_id = k.track_id LEFT JOIN topic t ON t.topic_id = u.m GROUP BY ALL""")
def _(spark, d):
    k = T(spark, d, "track").select("track_id", "name", "status", F.size("topic_ids").cast("bigint").alias("topics"), F.explode_outer("topic_ids").alias("topic_id"))
    j = k.join(T(spark, d, "topic").select("topic_id", "label"), "topic_id", "left")
    return j.groupBy("track_id", "name", "status", "topics").agg(F.nullif(F.array_join(F.array_sort(F.collect_list("label")), "|"), F.lit("")).alias("labels"))


@Q("c02_url_status", "A1 L1", """SELECT decision, url_type, count(*) AS rows, count(DISTINCT url) AS urls FROM search_result GROUP BY ALL""")
def _(spark, d):
    return T(spark, d, "search_result").groupBy("decision", "url_type").agg(F.count("*").alias("rows"), F.count_distinct("url").alias("urls"))


@Q("c03_run_list", "W1 A8", """SELECT plan_id, arg_max(task_id, struct_pack(a := coalesce(started_at, TIMESTAMP '1970-01-01'), b := task_id)) AS latest_task, count(*) AS rows FROM search_task GROUP BY plan_id""")
def _(spark, d):
    order = F.struct(F.coalesce(F.col("started_at"), F.lit("1970-01-01").cast("timestamp_ntz")), F.col("task_id"))
    return T(spark, d, "search_task").groupBy("plan_id").agg(F.max_by("task_id", order).alias("latest_task"), F.count("*").alias("rows"))
