"""Queries of text and table operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup, taxonomy
from ..functions import text as T
from ..rules import DRIVER
from ..session import table

SQL = {}


def mask_pii(spark, sf):
    """Masked texts of documents and turns that held an address, with their digest."""
    d = table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    c = table(spark, sf, "conversations").select(F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("id"), "text")
    both = d.unionByName(c).withColumn("masked", T.mask_sensitive(F.col("text"), DRIVER))
    return both.where("masked <> text").select("id", F.sha1("masked").alias("masked"))


SQL["mask_pii"] = r"""SELECT id, sha1(m) AS masked FROM (SELECT id, text, regexp_replace(text, '[A-Za-z0-9_.+-]+@[A-Za-z0-9_.-]+\.[A-Za-z]{2,}', '[mail]', 'g') AS m FROM (
SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT concat_ws('-', 'c', conv_id, turn) AS id, text FROM conversations)) WHERE m <> text"""


def marker_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.marker_counts(F.col("text"), DRIVER).alias("m")).select("doc_id", *(F.col(f"m.{k}").cast("long").alias(k) for k in DRIVER.markers))


_COUNTS = {k: f"len(regexp_extract_all(text, '{p}'))" for k, p in DRIVER.markers.items()}
SQL["marker_counts"] = "SELECT doc_id, " + ", ".join(f"{v} AS {k}" for k, v in _COUNTS.items()) + " FROM documents"


def evidence_score(spark, sf):
    d = table(spark, sf, "documents").withColumn("m", T.marker_counts(F.col("text"), DRIVER))
    status = F.when(F.col("n_chars") < 200, "short").otherwise("ok")
    tags = F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.lit(k)) for k, p in DRIVER.action_tags.items())))
    return d.select("doc_id", F.concat_ws(",", tags).alias("tags"), T.evidence_score(F.col("m"), F.size(tags), status, DRIVER).cast("long").alias("score"))


_TAGS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in DRIVER.action_tags.items()) + "], lambda x: x IS NOT NULL)"
SQL["evidence_score"] = f"SELECT doc_id, array_to_string(t, ',') AS tags, CAST({' + '.join(f'least({_COUNTS[n]}, {cap}) * {w}' for n, cap, w in DRIVER.score_caps)} + least(len(t), 5) - CASE WHEN n_chars < 200 THEN 8 ELSE 0 END AS BIGINT) AS score FROM (SELECT *, {_TAGS} AS t FROM documents)"


def subject_hits(spark, sf):
    h = table(spark, sf, "documents").select("doc_id", F.explode(T.subject_hits(F.col("text"), DRIVER)).alias("h"))
    return h.select("doc_id", "h.subject", "h.curriculum_hint")


SQL["subject_hits"] = " UNION ALL ".join(f"SELECT doc_id, '{s}' AS subject, '{c}' AS curriculum_hint FROM documents WHERE regexp_matches(text, '(?i){p}')" for c, s, p in DRIVER.subject_patterns)


def case_id(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.case_id(F.concat_ws("/", "source", "doc_id"), F.col("lang")).alias("case_id"))


SQL["case_id"] = "SELECT doc_id, substr(sha1(source || '/' || doc_id || ':' || lang), 1, 24) AS case_id FROM documents"


def resolve_group(spark, sf):
    o = table(spark, sf, "orders")
    year = F.year("o_orderdate") + 30
    grade = F.when(F.col("o_orderkey") % 4 > 0, (F.col("o_orderkey") % 4).cast("int"))
    return o.select("o_orderkey", T.transition_curriculum(year, grade).alias("curriculum"))


SQL["resolve_group"] = """SELECT o_orderkey, CASE WHEN y <= 2024 THEN '2015' WHEN y >= 2027 THEN '2022' WHEN g = 0 THEN NULL WHEN y = 2025 THEN CASE WHEN g = 1 THEN '2022' ELSE '2015' END ELSE CASE WHEN g IN (1, 2) THEN '2022' ELSE '2015' END END AS curriculum
FROM (SELECT o_orderkey, year(o_orderdate) + 30 AS y, o_orderkey % 4 AS g FROM orders)"""

LEXICON = (("metal", ("bolt", "gear", "nut", "washer")), ("colour", ("red", "blue", "green", "black")), ("size", ("small", "large", "tiny")))


def taxonomy_axes(spark, sf):
    """Parts by lexicon: the categories tied on the longest word, then on the number of words."""
    p = table(spark, sf, "part").select("p_partkey", taxonomy.winners(F.lower("p_name"), LEXICON).alias("keys"))
    return p.select("p_partkey", F.concat_ws(",", "keys").alias("keys"))


_WORDS = ", ".join(f"('{k}', '{w}')" for k, ws in LEXICON for w in ws)
SQL["taxonomy_axes"] = f"""WITH x(k, w) AS (VALUES {_WORDS}), s AS (SELECT p_partkey, k, max(length(w)) AS l, count(*) AS n FROM part JOIN x ON contains(lower(p_name), w) GROUP BY ALL),
b AS (SELECT *, rank() OVER (PARTITION BY p_partkey ORDER BY l DESC, n DESC) AS r FROM s)
SELECT p_partkey, coalesce(string_agg(k, ',' ORDER BY k DESC) FILTER (r = 1), '') AS keys FROM part LEFT JOIN b USING (p_partkey) GROUP BY p_partkey"""


def link_extract(spark, sf):
    """Links of each page in order, with their texts."""
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">[^<]*</a>'), 1)
    texts = F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), 1)
    pairs = table(spark, sf, "pages").select("page_id", F.posexplode(F.arrays_zip(links.alias("href"), texts.alias("label"))).alias("pos", "p"))
    return pairs.select("page_id", F.col("pos").cast("long").alias("pos"), "p.href", "p.label")


_LINK = """'<a href="([^"]*)">([^<]*)</a>'"""
SQL["link_extract"] = f"SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS BIGINT) AS pos, unnest(h) AS href, unnest(t) AS label FROM (SELECT page_id, regexp_extract_all(html, {_LINK}, 1) AS h, regexp_extract_all(html, {_LINK}, 2) AS t FROM pages)"


def html_grid_roundtrip(spark, sf):
    """Regions and nations as an HTML table with spanned regions, read back as rows."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("n"))
    cells = F.array_join(F.transform("n", lambda x, i: F.concat(F.lit("<tr>"), F.when(i == 0, F.concat(F.lit('<td rowspan="'), F.size("n"), F.lit('">'), F.col("r_name"), F.lit("</td>"))).otherwise(F.lit("")), F.lit("<td>"), x, F.lit("</td></tr>"))), "")
    made = rows.select("r_name", F.concat(F.lit("<table>"), cells, F.lit("</table>")).alias("html"))
    g = markup.grid_rows(made, "r_name", "html")
    return g.groupBy("id", "row_no").agg(F.max(F.when(F.col("col_no") == 0, F.col("text"))).alias("r_name"), F.max(F.when(F.col("col_no") == 1, F.col("text"))).alias("n_name")).select("r_name", "n_name")


SQL["html_grid_roundtrip"] = "SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey"


def pipe_roundtrip(spark, sf):
    """Nations as a Markdown table, read back as cells."""
    listed = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n"))
    lines = F.array_join(F.transform("n", lambda x: F.concat(F.lit("| "), x["n_nationkey"], F.lit(" | "), x["n_name"], F.lit(" |"))), "\n")
    made = listed.select("n_regionkey", F.concat(F.lit("# Nations\n\n| key | name |\n|---|:--|\n"), lines, F.lit("\n\nend")).alias("md"))
    g = markup.grid_rows(made, "n_regionkey", "md", markdown=True).where("row_no > 0")
    return g.groupBy("id", "row_no").agg(F.max(F.when(F.col("col_no") == 0, F.col("text"))).alias("key"), F.max(F.when(F.col("col_no") == 1, F.col("text"))).alias("name")).select(F.col("key").cast("int").alias("n_nationkey"), F.col("name").alias("n_name"))


SQL["pipe_roundtrip"] = "SELECT n_nationkey, n_name FROM nation"


def page_text(spark, sf):
    """Size of each page's sanitised markup; no script is left."""
    clean = markup.text_udf(markup.sanitize)(F.col("html"))
    p = table(spark, sf, "pages").select("page_id", clean.alias("c"))
    return p.select("page_id", F.contains("c", F.lit("<script")).alias("has_script"), F.contains("c", F.lit("track(")).alias("has_code"), F.regexp_count("c", F.lit("<p>")).cast("long").alias("paragraphs"))


SQL["page_text"] = "SELECT page_id, false AS has_script, false AS has_code, CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS paragraphs FROM pages"

NAMES = list(SQL)
