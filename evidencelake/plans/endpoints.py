"""Queries that call the read service's endpoints on tables published from the driver's ones, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import table
from . import responses, serve

SQL = {}


def _case_id(key: str):
    return F.lpad(F.lower(F.hex(key)), 24, "0")


def published(spark, sf) -> serve.Published:
    """Orders as cases, their lines as items, quantities as priorities, method axes by part."""
    n, r, c, o = (table(spark, sf, t) for t in ("nation", "region", "customer", "orders"))
    places = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", F.col("n_name").alias("district"), F.col("r_name").alias("region"))
    homes = c.join(places, c["c_nationkey"] == places["n_nationkey"]).select("c_custkey", F.col("c_name").alias("school_name"), "district", "region")
    key = F.col("o_orderkey")
    cases = o.join(homes, o["o_custkey"] == homes["c_custkey"]).select(
        _case_id("o_orderkey").alias("case_id"), F.when(F.col("o_orderstatus") == "P", "source_detail_bundle_review").when(key % 11 == 0, "inferred").otherwise("source_detail").alias("title_basis"),
        F.element_at(F.array(F.lit("2015"), F.lit("2022"), F.lit("shared")), (key % 3 + 1).cast("int")).alias("curriculum"), F.col("o_orderpriority").alias("subject"), "region", "district", "school_name",
        F.concat_ws(" ", "o_orderpriority", "school_name").alias("title"), F.col("o_totalprice").alias("review_score"), F.array("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("action_tags"),
        F.when(key % 5 == 0, "0점").otherwise("10%").alias("weight"), F.when(key % 7 == 0, "other").otherwise("expected").alias("subject_alignment"), F.col("district").alias("excerpt"),
    )
    p, fields = table(spark, sf, "part"), ("l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct(*fields)).alias("l")).select("l_orderkey", "l_linenumber", "l.*")  # noqa: E741
    lines = l.join(p, l["l_partkey"] == p["p_partkey"]).withColumn("case_id", _case_id("l_orderkey")).withColumn("item_id", F.concat_ws("-", "case_id", "l_linenumber"))
    items = lines.select("case_id", "item_id", F.col("l_linenumber").alias("item_order"), F.when(F.col("l_returnflag") == "N", "bundle").otherwise("bounded").alias("extraction_status"), F.when(F.col("l_linestatus") == "F", "table").otherwise("inferred").alias("title_basis"), F.col("p_type").alias("title"), F.col("p_brand").alias("overview"))
    method = F.element_at(F.array(*map(F.lit, serve.METHODS)), (F.col("l_partkey") % 10 + 1).cast("int"))
    rankings = lines.select("item_id", F.col("l_quantity").alias("priority_score"), method.alias("category"))
    axes = lines.select("item_id", F.lit("method").alias("axis"), method.alias("value")).unionByName(lines.where("p_size <= 25").select("item_id", F.lit("topic").alias("axis"), F.lit("small").alias("value")))
    stats = cases.groupBy("curriculum", "subject").agg(F.count("*").alias("documents"), F.count_if(F.col("title_basis") == "source_detail").alias("coverage_found"), F.count_if(F.col("title_basis") != "source_detail").alias("coverage_other"))
    return serve.Published(cases, items, rankings, stats, axes)


#: The same tables in SQL.
_TABLES = f"""cases AS (SELECT lpad(lower(printf('%X', o_orderkey)), 24, '0') AS case_id, CASE WHEN o_orderstatus = 'P' THEN 'source_detail_bundle_review' WHEN o_orderkey % 11 = 0 THEN 'inferred' ELSE 'source_detail' END AS title_basis,
['2015', '2022', 'shared'][o_orderkey % 3 + 1] AS curriculum, o_orderpriority AS subject, r_name AS region, n_name AS district, c_name AS school_name, o_orderpriority || ' ' || c_name AS title, o_totalprice AS review_score,
[o_orderstatus, substr(o_orderpriority, 1, 1)] AS action_tags, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '10%' END AS weight, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE n_name END AS excerpt
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
lines AS (SELECT *, lpad(lower(printf('%X', l_orderkey)), 24, '0') AS case_id, lpad(lower(printf('%X', l_orderkey)), 24, '0') || '-' || l_linenumber AS item_id, {list(serve.METHODS)}[l_partkey % 10 + 1] AS category FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) = 1) JOIN part ON l_partkey = p_partkey),
bounded AS (SELECT case_id, item_id, l_linenumber AS item_order, p_type AS title, p_brand AS overview, l_quantity AS priority_score, category, p_size FROM lines WHERE l_returnflag <> 'N' AND l_linestatus = 'F'),
confirmed AS (SELECT * FROM cases WHERE title_basis = 'source_detail' AND case_id IN (SELECT case_id FROM bounded)),
ranked AS (SELECT b.*, curriculum, subject, region, district, school_name FROM bounded b JOIN cases USING (case_id) WHERE priority_score >= {serve.LEAST_SCORE}),
stats AS (SELECT curriculum, subject, count(*) AS documents, count(*) FILTER (title_basis = 'source_detail') AS coverage_found, count(*) FILTER (title_basis <> 'source_detail') AS coverage_other FROM cases GROUP BY ALL)"""


def _sql(query: str) -> str:
    return f"WITH {_TABLES}\n{query}"


_SHOWN = ["case_id", "subject", "region", "school_name", "excerpt", "weight", "review_score"]
_FOUND = "FROM confirmed c WHERE curriculum IN ('2015', 'shared') AND subject = '1-URGENT' AND list_contains(action_tags, 'F')"
_MATCH = " AND (contains(lower(c.title), 'promo') OR contains(lower(c.school_name), 'promo') OR contains(lower(c.subject), 'promo') OR EXISTS (SELECT 1 FROM bounded b WHERE b.case_id = c.case_id AND (contains(lower(b.title), 'promo') OR contains(lower(b.overview), 'promo'))))"


def endpoint_cases(spark, sf):
    """A page of cases of a subject, its curriculum or ambiguous, with a tag and a search word."""
    got = serve.cases(published(spark, sf), 20, 5, curriculum="2015", subject="1-URGENT", tag="F", query="PROMO!", include_ambiguous=True)
    return got["items"].select(*_SHOWN)


SQL["endpoint_cases"] = _sql(f"SELECT {', '.join(_SHOWN)} {_FOUND}{_MATCH} ORDER BY review_score DESC, case_id LIMIT 20 OFFSET 5")


def endpoint_cases_total(spark, sf):
    return serve.cases(published(spark, sf), curriculum="2015", subject="1-URGENT", tag="F", query="PROMO!", include_ambiguous=True)["total"]


SQL["endpoint_cases_total"] = _sql(f"SELECT count(*) AS total {_FOUND}{_MATCH}")


def endpoint_status(spark, sf):
    """Cases of each status."""
    p = published(spark, sf)
    made = None
    for status in ("confirmed", "review", "unconfirmed"):
        part = serve.with_status(p, status).agg(F.lit(status).alias("status"), F.count("*").alias("cases"))
        made = part if made is None else made.unionByName(part)
    return made


SQL["endpoint_status"] = _sql("SELECT 'confirmed' AS status, count(*) AS cases FROM confirmed UNION ALL SELECT 'review', count(*) FROM cases WHERE title_basis = 'source_detail_bundle_review' UNION ALL SELECT 'unconfirmed', count(*) FROM cases WHERE title_basis <> 'source_detail_bundle_review' AND case_id NOT IN (SELECT case_id FROM confirmed)")


def endpoint_curated(spark, sf):
    return serve.curated(published(spark, sf), 30, category="writing", region="ASIA").select("item_id", "priority_score", "category", "district")


SQL["endpoint_curated"] = _sql("SELECT item_id, priority_score, category, district FROM ranked WHERE category = 'writing' AND region = 'ASIA' ORDER BY priority_score DESC, item_id LIMIT 30")


def _kinds(parts: dict[str, DataFrame]) -> DataFrame:
    made = None
    for kind, part in parts.items():
        part = part.select(F.lit(kind).alias("kind"), "value", "count")
        made = part if made is None else made.unionByName(part)
    return made


def endpoint_references(spark, sf):
    got = serve.references(published(spark, sf), category="analysis", topic="small", region="EUROPE", limit=50, offset=10)
    return got["items"].select("item_id", "priority_score", "region")


SQL["endpoint_references"] = _sql("SELECT item_id, priority_score, region FROM ranked WHERE category = 'analysis' AND p_size <= 25 AND region = 'EUROPE' ORDER BY priority_score DESC, item_id LIMIT 50 OFFSET 10")


def endpoint_reference_facets(spark, sf):
    """Total of a topic in a region; facets ignore the topic, that of regions the region too."""
    got = serve.references(published(spark, sf), category="analysis", topic="small", region="EUROPE")
    total = got["total"].select(F.lit("all").alias("value"), F.col("total").alias("count"))
    return _kinds({"total": total, "regions": got["regions"], "districts": got["districts"]})


_WIDE = "FROM ranked WHERE category = 'analysis'"
SQL["endpoint_reference_facets"] = _sql(f"SELECT 'total' AS kind, 'all' AS value, count(*) AS count {_WIDE} AND p_size <= 25 AND region = 'EUROPE' UNION ALL SELECT 'regions', region, count(*) {_WIDE} GROUP BY region UNION ALL SELECT 'districts', district, count(*) {_WIDE} AND region = 'EUROPE' GROUP BY district")


def endpoint_facets(spark, sf):
    return _kinds(serve.facets(published(spark, sf), curriculum="2022", region="AFRICA"))


_NEAR = "FROM confirmed WHERE curriculum = '2022'"
SQL["endpoint_facets"] = _sql(f"SELECT 'regions' AS kind, region AS value, count(*) AS count {_NEAR} GROUP BY region UNION ALL SELECT 'districts', district, count(*) {_NEAR} AND region = 'AFRICA' GROUP BY district UNION ALL SELECT 'action_tags', tag, count(DISTINCT case_id) FROM (SELECT case_id, unnest(action_tags) AS tag {_NEAR} AND region = 'AFRICA') GROUP BY tag")


def endpoint_meta(spark, sf):
    return serve.meta(published(spark, sf))


SQL["endpoint_meta"] = _sql("SELECT (SELECT max(coverage_found + coverage_other) FROM stats) AS plans_checked, (SELECT count(*) FROM cases) AS cases, (SELECT count(DISTINCT (school_name, region, district)) FROM cases) AS schools, (SELECT count(DISTINCT case_id) FROM bounded) AS confirmed_cases, (SELECT count(*) FROM bounded) AS items")


def endpoint_trends(spark, sf):
    """Statistics of subjects with their tags, the most frequent first."""
    p = published(spark, sf)
    tags = p.cases.select("curriculum", "subject", F.explode("action_tags").alias("tag")).groupBy("curriculum", "subject", "tag").agg(F.count("*").alias("document_count"))
    return serve.trends(p, tags, curriculum="2015").select("curriculum", "subject", "documents", F.concat_ws(",", F.transform("action_tags", lambda t: F.concat_ws(":", t["tag"], t["document_count"]))).alias("tags"))


SQL["endpoint_trends"] = _sql("SELECT curriculum, subject, documents, tags FROM stats JOIN (SELECT curriculum, subject, string_agg(tag || ':' || n, ',' ORDER BY n DESC, tag) AS tags FROM (SELECT curriculum, subject, tag, count(*) AS n FROM (SELECT curriculum, subject, unnest(action_tags) AS tag FROM cases) GROUP BY ALL) GROUP BY ALL) USING (curriculum, subject) WHERE curriculum = '2015'")


def endpoint_subjects(spark, sf):
    return serve.subjects(published(spark, sf), order=("5-LOW", "2-HIGH")).select("curriculum", "subject", "documents", "coverage_found")


SQL["endpoint_subjects"] = _sql("SELECT curriculum, subject, documents, coverage_found FROM stats")


def endpoint_detail(spark, sf):
    """A case with its items."""
    p = published(spark, sf)
    key = f"{51:024x}"
    shown = serve.case(p, key).select("case_id", "subject", "excerpt", "weight")
    return serve.case_detail(p, key).select("case_id", "item_order", "title").join(shown, "case_id", "right")


SQL["endpoint_detail"] = _sql(f"SELECT c.case_id, item_order, b.title, c.subject, c.excerpt, c.weight FROM cases c LEFT JOIN bounded b USING (case_id) WHERE c.case_id = '{51:024x}' AND c.title_basis = 'source_detail'")


def endpoint_item(spark, sf):
    """Items by their ids, some of them known."""
    p = published(spark, sf)
    made = None
    for key in _KEYS:
        part = serve.assessment_item(p, key).select("item_id", "title", "curriculum", "subject")
        made = part if made is None else made.unionByName(part)
    return made


_KEYS = [f"{case:024x}-{line}" for case in (0, 2, 4, 8) for line in (2, 3, 6, 7)]
_IDS = ", ".join(f"'{k}'" for k in _KEYS)
SQL["endpoint_item"] = _sql(f"SELECT item_id, b.title, curriculum, subject FROM bounded b JOIN cases USING (case_id) WHERE item_id IN ({_IDS})")

def response_cases(spark, sf):
    """Confirmed cases as clients get them, nested groups flattened for the comparison."""
    p = published(spark, sf)
    marked = serve.confirmed(p).withColumn("title", F.concat(F.lit("<b>"), "title", F.lit("</b>"))).withColumn("academic_years", F.to_json(F.array(F.lit(2024), (F.length("district") + 2000))))
    marked = marked.withColumn("overview", F.when(F.length("district") > 6, F.col("district")).otherwise("12")).withColumn("standards", F.array("region")).withColumn("methods", F.array(F.concat(F.lit("□ 서술 ☑ "), "region"), F.lit("□ 서술 □ 발표")))
    marked = marked.withColumn("rubric_marker_count", F.length("region"))
    a = F.col("assessment_structure")
    shown = responses.case_rows(marked).select(
        "case_id", "curriculum_ambiguous", "primary_task_name", F.array_join(F.col("academic_years").cast("array<string>"), ",").alias("years"), "evidence_score", "evidence_excerpt", F.col("evidence_markers.rubric").alias("rubric"),
        a["overview"].alias("overview"), F.array_join(a["methods"], ",").alias("methods"), a["weight"].alias("weight"), F.array_join(a["standards"], ",").alias("standards"), F.size("task_names").alias("tasks"), "source_url",
    )
    return shown


SQL["response_cases"] = _sql("""SELECT case_id, curriculum = 'shared' AS curriculum_ambiguous, title AS primary_task_name, '2024,' || (2000 + len(district)) AS years, CAST(trunc(review_score) AS BIGINT) AS evidence_score, excerpt AS evidence_excerpt, CAST(len(region) AS BIGINT) AS rubric,
CASE WHEN other OR len(district) <= 6 THEN '' ELSE district END AS overview, region AS methods, weight, CASE WHEN other THEN '' ELSE region END AS standards, 0 AS tasks, '' AS source_url FROM (SELECT *, CAST('0x' || case_id[9:] AS BIGINT) % 7 = 0 AS other FROM confirmed)""")


def response_items(spark, sf):
    """Publishable items as clients get them."""
    items = serve.bounded(published(spark, sf).items).withColumn("method", F.concat_ws(" ", F.lit("☑ 실험 □"), "overview")).withColumn("rubric_html", F.when(F.length("overview") > 8, F.col("title")).otherwise("")).withColumn("standards", F.to_json(F.array("overview", "title")))
    return responses.item_rows(items).select("item_id", "order", "title", "method", F.array_join("standards", ",").alias("standards"), "has_rubric", "source_available")


SQL["response_items"] = _sql("SELECT item_id, CAST(item_order AS BIGINT) AS \"order\", title, '실험' AS method, overview || ',' || title AS standards, len(overview) > 8 AS has_rubric, true AS source_available FROM bounded")


def response_trends(spark, sf):
    """Statistics of subjects as clients get them; coverage that no table has is unknown."""
    p = published(spark, sf)
    tags = p.cases.select("curriculum", "subject", F.explode("action_tags").alias("tag")).groupBy("curriculum", "subject", "tag").agg(F.count("*").alias("document_count"))
    rows = responses.trend_rows(serve.trends(p, tags.where("subject <> '5-LOW'")))
    return rows.select("curriculum", "subject", "documents", "curriculum_ambiguous", F.col("coverage.found").alias("found"), F.col("coverage.extraction_failed").alias("failed"), F.col("grade_documents.1").alias("first_grade"), F.size("action_tags").alias("tags"))


SQL["response_trends"] = _sql("SELECT curriculum, subject, documents, curriculum = 'shared' AS curriculum_ambiguous, coverage_found AS found, NULL::BIGINT AS failed, 0::BIGINT AS first_grade, CAST(coalesce(n, 0) AS INTEGER) AS tags FROM stats LEFT JOIN (SELECT curriculum, subject, count(DISTINCT tag) AS n FROM (SELECT curriculum, subject, unnest(action_tags) AS tag FROM cases WHERE subject <> '5-LOW') GROUP BY ALL) USING (curriculum, subject)")


def metric_panel(spark, sf):
    """The numbers of the data snapshot as they are shown."""
    return responses.metric_panel(serve.meta(published(spark, sf)))


_PANEL = (("(SELECT max(coverage_found + coverage_other) FROM stats)", "곳"), ("(SELECT count(*) FROM cases)", "건"), ("(SELECT count(DISTINCT (school_name, region, district)) FROM cases)", "곳"), ("(SELECT count(DISTINCT case_id) FROM bounded)", "건"), ("(SELECT count(*) FROM bounded)", "건"))
SQL["metric_panel"] = _sql(" UNION ALL ".join(f"SELECT {k} AS pos, '{responses.SNAPSHOT[k][0]}' AS label, format('{{:,}}', {n}) || '{unit}' AS value" for k, (n, unit) in enumerate(_PANEL)))

NAMES = [*SQL]
