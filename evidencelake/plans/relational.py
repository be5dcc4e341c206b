"""Queries of the relational operators over the driver's tables.

``orders`` stand for cases, ``lineitem`` for their items (return flag R for
publishable ones), customers' nations and regions for districts and regions,
``documents`` for evidence with ``lang`` as group and ``source`` as school.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates, client, dedupe, joins, search
from ..session import table

LANGS = ("de", "en", "es", "fr")
STATUSES = ("F", "O", "P")


def homes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their nation and region."""
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    places = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    return c.join(places, c["c_nationkey"] == places["n_nationkey"]).select("c_custkey", "n_name", "r_name")


def cases(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with nation and region of their customers."""
    o, h = table(spark, sf, "orders"), homes(spark, sf)
    return o.join(h, o["o_custkey"] == h["c_custkey"])


def counted_homes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with confirmed cases, their places and the number of these cases: orders are counted before places are looked up."""
    n = joins.having(table(spark, sf, "orders"), public(spark, sf), ["o_orderkey"]).groupBy("o_custkey").agg(F.count("*").alias("cases"))
    return n.join(homes(spark, sf), F.col("o_custkey") == F.col("c_custkey"))


def public(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))


def case_page(spark, sf):
    """Page of confirmed cases, best first."""
    found = joins.having(table(spark, sf, "orders"), public(spark, sf), ["o_orderkey"])
    # orders without a place are out before the page is cut; the places of its rows are looked up afterwards
    found = joins.having(found, homes(spark, sf).select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])
    best = aggregates.page(found.select("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice", "o_orderkey", 20)
    return best.join(homes(spark, sf), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "n_name", "r_name").orderBy(F.desc("o_totalprice"), "o_orderkey")


CASES_SQL = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
PUBLIC_SQL = "EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')"
SQL = {"case_page": f"SELECT o_orderkey, o_totalprice, n_name, r_name FROM {CASES_SQL} WHERE {PUBLIC_SQL} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"}


def case_page_offset(spark, sf):
    found = joins.having(search.equal(cases(spark, sf), r_name="ASIA"), public(spark, sf), ["o_orderkey"])
    return aggregates.page(found.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 30, 60)


SQL["case_page_offset"] = f"SELECT o_orderkey, o_totalprice FROM {CASES_SQL} WHERE r_name = 'ASIA' AND {PUBLIC_SQL} ORDER BY o_totalprice DESC, o_orderkey LIMIT 30 OFFSET 60"


def case_total(spark, sf):
    return joins.having(cases(spark, sf), public(spark, sf), ["o_orderkey"]).agg(F.count_distinct("o_orderkey").alias("total"))


SQL["case_total"] = f"SELECT count(DISTINCT o_orderkey) AS total FROM {CASES_SQL} WHERE {PUBLIC_SQL}"


def facet_region(spark, sf):
    return aggregates.facet(counted_homes(spark, sf), "r_name", rows="cases")


SQL["facet_region"] = f"SELECT r_name AS value, count(*) AS count FROM {CASES_SQL} WHERE {PUBLIC_SQL} GROUP BY r_name HAVING r_name <> ''"


def facet_district(spark, sf):
    return aggregates.facet(search.equal(counted_homes(spark, sf), r_name="EUROPE"), "n_name", rows="cases")


SQL["facet_district"] = f"SELECT n_name AS value, count(*) AS count FROM {CASES_SQL} WHERE r_name = 'EUROPE' AND {PUBLIC_SQL} GROUP BY n_name HAVING n_name <> ''"


def facet_tags(spark, sf):
    """Distinct orders for each flag of their items; tags unnested from arrays."""
    l = table(spark, sf, "lineitem").select("l_orderkey", F.explode(F.array("l_returnflag", "l_linestatus")).alias("tag"))  # noqa: E741
    return aggregates.facet(l, "tag", distinct="l_orderkey")


SQL["facet_tags"] = "SELECT value, count(DISTINCT l_orderkey) AS count FROM (SELECT l_orderkey, unnest([l_returnflag, l_linestatus]) AS value FROM lineitem) GROUP BY value HAVING value <> ''"


def tag_filter(spark, sf):
    tags = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("action_tags"))
    return search.tagged(tags, "A").select("l_orderkey", F.concat_ws(",", "action_tags").alias("tags"))


SQL["tag_filter"] = "SELECT l_orderkey, tags FROM (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS tags, bool_or(l_returnflag = 'A') AS has FROM lineitem GROUP BY l_orderkey) WHERE has"


def curated(spark, sf) -> DataFrame:
    """Items with their part and case: discount is the priority, the part's size class the axis."""
    l, o, p = table(spark, sf, "lineitem"), cases(spark, sf), table(spark, sf, "part")
    axis = p.where("p_size <= 10").select(F.col("p_partkey").alias("l_partkey"))
    bounded = l.where("l_discount >= 0.05 AND l_returnflag <> 'N'")
    return joins.having(bounded, axis, ["l_partkey"]).join(o, F.col("l_orderkey") == F.col("o_orderkey"))


CURATED_SQL = f"lineitem JOIN ({'SELECT * FROM ' + CASES_SQL}) ON l_orderkey = o_orderkey WHERE l_discount >= 0.05 AND l_returnflag <> 'N' AND EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 10)"


def curated_items(spark, sf):
    keyed = curated(spark, sf).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"), "l_discount", "r_name")
    return aggregates.page(keyed, "l_discount", "item_id", 30, 30)


SQL["curated_items"] = f"SELECT l_orderkey * 10 + l_linenumber AS item_id, l_discount, r_name FROM {CURATED_SQL} ORDER BY l_discount DESC, item_id LIMIT 30 OFFSET 30"


def curated_total(spark, sf):
    return curated(spark, sf).agg(F.count("*").alias("total"))


SQL["curated_total"] = f"SELECT count(*) AS total FROM {CURATED_SQL}"


def curated_facets(spark, sf):
    return aggregates.facet(curated(spark, sf), "r_name")


SQL["curated_facets"] = f"SELECT r_name AS value, count(*) AS count FROM {CURATED_SQL} GROUP BY r_name HAVING r_name <> ''"


def search_tokens(spark, sf):
    """Documents in which every word of the query occurs, in the text or in its labels' words."""
    found = search.matches(table(spark, sf, "documents"), "the MIT License!", ["text", "source"])
    return found.select("doc_id", "lang")


_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FOLD_SOURCE = _FOLD.replace("text", "source")
SQL["search_tokens"] = "SELECT doc_id, lang FROM documents WHERE " + " AND ".join(f"(contains({_FOLD}, '{t}') OR contains({_FOLD_SOURCE}, '{t}'))" for t in ("the", "mit", "license"))


def search_items(spark, sf):
    """Orders whose priority or one of whose parts' names holds each word."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("case_id"), "o_orderpriority")
    l, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    items = l.join(p, l["l_partkey"] == p["p_partkey"]).select(F.col("l_orderkey").alias("case_id"), "p_type")
    return search.matches(o, "URGENT promo", ["o_orderpriority"], items, "case_id", ["p_type"]).select("case_id")


_IN = "EXISTS (SELECT 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = o_orderkey AND contains(lower(p_type), '{0}'))"
SQL["search_items"] = "SELECT o_orderkey AS case_id FROM orders WHERE " + " AND ".join(f"(contains(lower(o_orderpriority), '{t}') OR {_IN.format(t)})" for t in ("urgent", "promo"))


def snapshot(spark, sf):
    """One row of counts over cases, customers and publishable items."""
    o, p = table(spark, sf, "orders"), table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    a = o.agg(F.count("*").alias("cases"), F.count_distinct("o_custkey").alias("schools"))
    b = p.agg(F.count_distinct("l_orderkey").alias("confirmed_cases"), F.count("*").alias("items"))
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k").drop("_k")


SQL["snapshot"] = "SELECT (SELECT count(*) FROM orders) AS cases, (SELECT count(DISTINCT o_custkey) FROM orders) AS schools, (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_returnflag = 'R') AS confirmed_cases, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS items"


def strict_dedupe(spark, sf):
    """One document for each text and language: the longest, which all are, so the earliest."""
    return dedupe.keep_best(table(spark, sf, "documents").withColumn("sha", F.sha2("text", 256)), ["sha", "lang"], "n_chars", "doc_id").select("doc_id", "sha", "lang")


SQL["strict_dedupe"] = "SELECT doc_id, sha, lang FROM (SELECT doc_id, sha256(text) AS sha, lang, row_number() OVER (PARTITION BY text, lang ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn = 1"


def first_wins(spark, sf):
    d = table(spark, sf, "documents").withColumn("key", F.when(F.col("n_chars") % 7 == 0, "").otherwise(F.col("text")))
    return dedupe.first_wins(d, "key", "doc_id").select("doc_id")


SQL["first_wins"] = "SELECT doc_id FROM (SELECT doc_id, key, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS rn FROM (SELECT *, CASE WHEN n_chars % 7 = 0 THEN '' ELSE text END AS key FROM documents)) WHERE key = '' OR rn = 1"


def upsert(spark, sf):
    """The latest event of each user."""
    return dedupe.last_wins(table(spark, sf, "events"), ["user_id"], "event_id").select("user_id", "event_id", "event_type")


SQL["upsert"] = "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"


def merge_log(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "event_id")
    keys = ["user_id", "event_type", "day"]
    old = dedupe.last_wins(e.where("event_id % 2 = 0"), keys, "event_id")
    new = dedupe.last_wins(e.where("event_id % 2 = 1"), keys, "event_id")
    return dedupe.merge_log(old, new, keys).select("user_id", "event_type", F.col("day").cast("string").alias("day"), "event_id")


SQL["merge_log"] = """SELECT user_id, event_type, CAST(day AS VARCHAR) AS day, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY event_id % 2 DESC, event_id DESC) AS rn
  FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id FROM events)) WHERE rn = 1"""


def replacement_override(spark, sf):
    """Orders of urgent priority replace another order of their customer if they rank higher."""
    o = table(spark, sf, "orders").withColumn("rank", F.when(F.col("o_orderstatus") == "F", 4).when(F.col("o_orderstatus") == "O", 3).otherwise(2)).withColumn("size", F.floor("o_totalprice"))
    part = o.select("o_custkey", "o_orderkey", "rank", "size", "o_orderpriority")
    base = dedupe.keep_best(part.where("o_orderpriority NOT LIKE '1%'"), ["o_custkey"], "size", "o_orderkey").drop("o_orderpriority")
    return dedupe.override(base, part.where("o_orderpriority LIKE '1%'").drop("o_orderpriority"), "o_custkey", "rank", "size", "o_orderkey")


SQL["replacement_override"] = """WITH p AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 3 ELSE 2 END AS rank, CAST(floor(o_totalprice) AS BIGINT) AS size, o_orderpriority LIKE '1%' AS retry FROM orders),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY size DESC, o_orderkey) AS rn FROM p WHERE NOT retry) WHERE rn = 1),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY rank DESC, size DESC, o_orderkey) AS rn FROM p WHERE retry) WHERE rn = 1),
j AS (SELECT b.*, r.o_orderkey AS rk, r.rank AS rr, r.size AS rs, r.o_orderkey IS NOT NULL AND (r.rank > b.rank OR r.rank = b.rank AND r.size > b.size) AS replaced FROM b LEFT JOIN r USING (o_custkey))
SELECT o_custkey, CASE WHEN replaced THEN rk ELSE o_orderkey END AS o_orderkey, CASE WHEN replaced THEN rr ELSE rank END AS rank, CASE WHEN replaced THEN rs ELSE size END AS size, replaced FROM j"""


def diverse_topn(spark, sf):
    d = table(spark, sf, "documents").withColumn("school", F.when(F.col("source") == "src0", "").otherwise(F.col("source")))
    return dedupe.diverse_top(d, ["lang"], "school", "n_chars", "doc_id", 12).select("lang", F.col("rank").cast("long").alias("rank"), "doc_id")


SQL["diverse_topn"] = """WITH d AS (SELECT doc_id, lang, n_chars, CASE WHEN source = 'src0' THEN '' ELSE source END AS school FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, school ORDER BY n_chars DESC, doc_id) AS k FROM d)
SELECT lang, rank, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM s WHERE school = '' OR k = 1) WHERE rank <= 12"""


def stratified_sample(spark, sf):
    return dedupe.stratified(table(spark, sf, "customer"), "c_nationkey", ["c_custkey"], 100).select("c_nationkey", "c_custkey", F.col("turn").cast("long").alias("turn"))


SQL["stratified_sample"] = "SELECT c_nationkey, c_custkey, turn FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS turn FROM customer) ORDER BY turn, c_nationkey LIMIT 100"


def narrowing(spark, sf):
    """Customers of a market segment and nation: rich ones if there are any, of them those with even keys if there are any."""
    c = table(spark, sf, "customer").withColumn("key", F.concat_ws("/", "c_mktsegment", "c_nationkey"))
    return dedupe.narrow(c, "key", F.col("c_acctbal") > 9000, F.col("c_custkey") % 2 == 0).select("key", "c_custkey", "ambiguous")


SQL["narrowing"] = """WITH a AS (SELECT c_mktsegment || '/' || c_nationkey AS key, * FROM customer),
b AS (SELECT *, count(*) OVER (PARTITION BY key) AS n, count(*) FILTER (c_acctbal > 9000) OVER (PARTITION BY key) AS k FROM a),
c AS (SELECT key, c_custkey FROM b WHERE n = 1 OR k = 0 OR c_acctbal > 9000),
d AS (SELECT *, count(*) OVER (PARTITION BY key) AS n, count(*) FILTER (c_custkey % 2 = 0) OVER (PARTITION BY key) AS k FROM c),
e AS (SELECT key, c_custkey FROM d WHERE n = 1 OR k = 0 OR c_custkey % 2 = 0)
SELECT key, c_custkey, count(*) OVER (PARTITION BY key) > 1 AS ambiguous FROM e"""


def coverage_matrix(spark, sf):
    """Every source with every language: documents found, documents with labels, and a status."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")  # noqa: E741
    found = d.groupBy("source", "lang").agg(F.count("*").alias("found"))
    labelled = joins.having(d, l, ["doc_id"]).groupBy("source", "lang").agg(F.count("*").alias("labelled"))
    matrix = joins.dense(d.select("source").distinct(), [(x,) for x in (*LANGS, "it")], ["lang"], [found, labelled], ["source", "lang"])
    status = F.when(F.col("labelled") > 0, "found").when(F.col("found") > 0, "found_unlabelled").otherwise("missing")
    return matrix.withColumn("status", status)


SQL["coverage_matrix"] = """WITH g AS (SELECT unnest(['de', 'en', 'es', 'fr', 'it']) AS lang), s AS (SELECT DISTINCT source FROM documents),
f AS (SELECT source, lang, count(*) AS found, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS labelled FROM documents GROUP BY ALL)
SELECT source, lang, coalesce(found, 0) AS found, coalesce(labelled, 0) AS labelled, CASE WHEN labelled > 0 THEN 'found' WHEN found > 0 THEN 'found_unlabelled' ELSE 'missing' END AS status FROM s CROSS JOIN g LEFT JOIN f USING (source, lang)"""


def coverage_crosstab(spark, sf):
    return aggregates.crosstab(coverage_matrix(spark, sf), ["lang"], "status", ["found", "found_unlabelled", "missing"])


SQL["coverage_crosstab"] = f"SELECT lang, count(*) FILTER (status = 'found') AS found, count(*) FILTER (status = 'found_unlabelled') AS found_unlabelled, count(*) FILTER (status = 'missing') AS missing FROM ({SQL['coverage_matrix']}) GROUP BY lang"


def status_crosstab(spark, sf):
    return aggregates.crosstab(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", STATUSES)


SQL["status_crosstab"] = "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1"


def trend_rollup(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").withColumn("score", F.col("n_chars").cast("double"))
    return aggregates.trend(d, ["lang"], "source", "score", ["quality", "toxic"])


SQL["trend_rollup"] = "SELECT lang, count(*) AS documents, count(DISTINCT nullif(source, '')) AS schools, median(CAST(n_chars AS DOUBLE)) AS median_score, count(*) FILTER (quality > 0) AS quality_documents, count(*) FILTER (toxic > 0) AS toxic_documents FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang"


def trend_expected(spark, sf):
    """Configured groups only, zero-filled."""
    expected = spark.createDataFrame([(x,) for x in (*LANGS[1:], "it")], "lang string")
    d = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("documents"))
    return joins.expected_groups(expected, d, ["lang"])


SQL["trend_expected"] = "SELECT lang, coalesce(documents, 0) AS documents FROM (SELECT unnest(['en', 'es', 'fr', 'it']) AS lang) LEFT JOIN (SELECT lang, count(*) AS documents FROM documents GROUP BY lang) USING (lang)"


def trend_tags(spark, sf):
    e = table(spark, sf, "lineitem").select("l_linestatus", F.col("l_suppkey").cast("string").alias("school"), F.array("l_returnflag", "l_linestatus", "l_returnflag").alias("tags"))
    return aggregates.tag_rollup(e, ["l_linestatus"], "tags", "school")


SQL["trend_tags"] = "SELECT l_linestatus, tag, count(*) AS documents, count(DISTINCT l_suppkey) AS schools FROM (SELECT l_linestatus, l_suppkey, unnest(list_distinct([l_returnflag, l_linestatus, l_returnflag])) AS tag FROM lineitem) GROUP BY ALL"


def top_names(spark, sf):
    p = table(spark, sf, "part")
    return aggregates.most_common(p, ["p_brand"], "p_size", "p_partkey", 5).withColumn("rank", F.col("rank").cast("long"))


SQL["top_names"] = "SELECT * FROM (SELECT p_brand, p_size, count, row_number() OVER (PARTITION BY p_brand ORDER BY count DESC, f) AS rank FROM (SELECT p_brand, p_size, count(*) AS count, min(p_partkey) AS f FROM part GROUP BY ALL)) WHERE rank <= 5"


def ordered_rank(spark, sf):
    """Configured order of groups, unknown ones last."""
    rank = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for x in ("fr", 0, "en", 1))), F.col("lang")), F.lit(9))
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("documents")).withColumn("rank", rank).orderBy("rank", "lang")


SQL["ordered_rank"] = "SELECT lang, count(*) AS documents, CASE lang WHEN 'fr' THEN 0 WHEN 'en' THEN 1 ELSE 9 END AS rank FROM documents GROUP BY lang"


def orphans(spark, sf):
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")  # noqa: E741
    return joins.orphans(d, l, d["doc_id"] == l["doc_id"]).agg(F.count("*").alias("orphans"))


SQL["orphans"] = "SELECT count(*) AS orphans FROM documents ANTI JOIN labels USING (doc_id)"


def dup_keys(spark, sf):
    return aggregates.duplicates(table(spark, sf, "events"), ["user_id", "event_type"])


SQL["dup_keys"] = "SELECT user_id, event_type, count(*) AS rows FROM events GROUP BY ALL HAVING count(*) > 1"


def null_stats(spark, sf):
    return aggregates.content_stats(table(spark, sf, "documents"), "n_chars")


SQL["null_stats"] = "SELECT count(*) AS rows, count(*) FILTER (coalesce(n_chars, 0) = 0) AS empty, count(*) FILTER (n_chars BETWEEN 1 AND 199) AS short FROM documents"


def status_histogram(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"))


SQL["status_histogram"] = "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY 1"


def full_outer_audit(spark, sf):
    """Counts of items stored with orders of even keys against all recomputed ones."""
    l = table(spark, sf, "lineitem")  # noqa: E741
    computed = l.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_distinct("l_partkey").alias("parts"))
    stored = computed.where("l_suppkey % 3 <> 0").withColumn("n", F.col("n") + F.col("l_suppkey") % 2)  # the same exchange again
    return joins.differences(stored, computed, ["l_suppkey"], ["n", "parts"])


SQL["full_outer_audit"] = """WITH c AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1), s AS (SELECT l_suppkey, n + l_suppkey % 2 AS n, parts FROM c WHERE l_suppkey % 3 <> 0),
j AS (SELECT coalesce(s.l_suppkey, c.l_suppkey) AS l_suppkey, s.n AS sn, c.n AS cn, s.parts AS sp, c.parts AS cp FROM s FULL OUTER JOIN c ON s.l_suppkey = c.l_suppkey)
SELECT l_suppkey, 'n' AS field, CAST(sn AS VARCHAR) AS stored, CAST(cn AS VARCHAR) AS computed FROM j WHERE sn IS DISTINCT FROM cn UNION ALL SELECT l_suppkey, 'parts', CAST(sp AS VARCHAR), CAST(cp AS VARCHAR) FROM j WHERE sp IS DISTINCT FROM cp"""


def case_rederive(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("overview", F.when(F.col("l_linestatus") == "O", F.lit(" ")).otherwise(F.concat_ws("-", "l_partkey", "l_suppkey")))  # noqa: E741
    return aggregates.rederive(l, "l_orderkey", "l_linenumber", "l_returnflag", "overview")


SQL["case_rederive"] = """SELECT l_orderkey, string_agg(f, '|' ORDER BY first, f) AS titles, coalesce(any_value(o), '') AS overview FROM (
  SELECT l_orderkey, l_returnflag AS f, min(l_linenumber) AS first FROM lineitem GROUP BY ALL) LEFT JOIN (
  SELECT l_orderkey, arg_min(l_partkey || '-' || l_suppkey, (l_linenumber, l_returnflag, l_partkey || '-' || l_suppkey)) AS o FROM lineitem WHERE l_linestatus <> 'O' GROUP BY 1) USING (l_orderkey) GROUP BY l_orderkey"""


def first_document(spark, sf):
    """Items with the text of the first document of their language and source."""
    c = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id").select("doc_id", "source")
    docs = table(spark, sf, "documents").select("source", "doc_id", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.sha1("text")).alias("text")).withColumnRenamed("doc_id", "seq")
    return joins.first_document(c, docs, "source", "text", "seq")


SQL["first_document"] = """WITH f AS (SELECT source, arg_min(CASE WHEN doc_id % 5 = 0 THEN '' ELSE sha1(text) END, doc_id) AS text FROM documents GROUP BY source)
SELECT doc_id, source, text FROM labels JOIN (SELECT doc_id, source FROM documents) USING (doc_id) JOIN f USING (source) WHERE text <> ''"""


def lookup_district(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("n_name")).alias("district"))
    return joins.lookup(s, n, "n_nationkey", "district").select("s_suppkey", "district")


SQL["lookup_district"] = "SELECT s_suppkey, CASE WHEN n_regionkey = 0 THEN '' ELSE coalesce(n_name, '') END AS district FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"


def reject_reasons(spark, sf):
    """Documents counted under the first reason they are rejected for."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    reason = search.first_reason(("unlabelled", F.col("quality").isNull()), ("low_quality", F.col("quality") == 0), ("toxic", F.col("toxic") == 1), ("short", F.col("n_chars") < 200))
    return d.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("documents"))


SQL["reject_reasons"] = "SELECT CASE WHEN quality IS NULL THEN 'unlabelled' WHEN quality = 0 THEN 'low_quality' WHEN toxic = 1 THEN 'toxic' WHEN n_chars < 200 THEN 'short' ELSE 'kept' END AS reason, count(*) AS documents FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1"


def gate_reasons(spark, sf):
    """All reasons a row fails the gate for, joined."""
    d = table(spark, sf, "documents")
    reasons = search.all_reasons(("short", F.col("n_chars") < 300), ("foreign", F.col("lang") != "en"), ("hot_source", F.col("source") == "src0"))
    return d.select("doc_id", reasons.alias("reasons")).where("reasons <> ''")


SQL["gate_reasons"] = "SELECT doc_id, concat_ws('|', CASE WHEN n_chars < 300 THEN 'short' END, CASE WHEN lang <> 'en' THEN 'foreign' END, CASE WHEN source = 'src0' THEN 'hot_source' END) AS reasons FROM documents WHERE n_chars < 300 OR lang <> 'en' OR source = 'src0'"


def visits(spark, sf):
    """First visit of a user ever, and of each day; daily and running totals."""
    daily = table(spark, sf, "events").select("user_id", T.korea_date(F.col("ts")).alias("day")).distinct()
    first = daily.groupBy("user_id").agg(F.min("day").alias("day")).groupBy("day").agg(F.count("*").alias("new_visitors"))
    days = daily.groupBy("day").agg(F.count("*").alias("visitors")).join(first, "day", "left").fillna(0, ["new_visitors"])
    # one row for each day: a running sum over them is small
    return days.withColumn("visitors_so_far", F.sum("new_visitors").over(Window.orderBy("day")))


SQL["visits"] = """WITH e AS (SELECT *, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS day FROM events), v AS (SELECT day, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS b FROM e),
g AS (SELECT day, count(*) FILTER (b = 1) AS visitors, count(*) FILTER (a = 1) AS new_visitors FROM v GROUP BY day)
SELECT day, visitors, new_visitors, CAST(sum(new_visitors) OVER (ORDER BY day) AS BIGINT) AS visitors_so_far FROM g"""


def compare_pivot(spark, sf):
    """Four parts as columns, their attributes as rows."""
    return client.comparison(table(spark, sf, "part"), "p_partkey", ["p_name", "p_brand", "p_type", "p_size"], [1, 2, 3, 4, 4, 5])


SQL["compare_pivot"] = """WITH u AS (SELECT p_partkey, unnest(['p_name', 'p_brand', 'p_type', 'p_size']) AS attribute, unnest([p_name, p_brand, p_type, CAST(p_size AS VARCHAR)]) AS value FROM part WHERE p_partkey <= 4)
SELECT attribute, max(value) FILTER (p_partkey = 1) AS item_1, max(value) FILTER (p_partkey = 2) AS item_2, max(value) FILTER (p_partkey = 3) AS item_3, max(value) FILTER (p_partkey = 4) AS item_4 FROM u GROUP BY attribute"""


def points_alloc(spark, sf):
    """Each customer's hundred points over three criteria weighing 50, 30 and 20: floors, then one more each from the first on."""
    total = F.pmod(F.col("c_custkey"), F.lit(97)) + 3
    c = table(spark, sf, "customer").select("c_custkey", total.alias("total"), F.posexplode(F.array(F.lit(50), F.lit(30), F.lit(20))).alias("idx", "weight"))
    return c.select("c_custkey", F.col("idx").cast("long").alias("idx"), client.allocate(F.col("total"), F.col("weight"), F.col("idx"), F.col("c_custkey")).alias("points"))


SQL["points_alloc"] = """WITH c AS (SELECT c_custkey, c_custkey % 97 + 3 AS total, unnest([0, 1, 2]) AS idx, unnest([50, 30, 20]) AS weight FROM customer), f AS (SELECT *, total * weight // 100 AS p FROM c)
SELECT c_custkey, CAST(idx AS BIGINT) AS idx, CAST(p + CASE WHEN idx < total - sum(p) OVER (PARTITION BY c_custkey) THEN 1 ELSE 0 END AS BIGINT) AS points FROM f"""


def json_list(spark, sf):
    """Arrays from JSON text; bad JSON and other values give none."""
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('["'), "event_type", F.lit('","x"]'))).otherwise(F.col("props")).alias("j"))
    return e.select("event_id", F.size(T.json_list(F.col("j"))).cast("long").alias("n"))


SQL["json_list"] = """WITH j AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '["' || event_type || '","x"]' ELSE props END AS j FROM events)
SELECT event_id, CASE WHEN json_valid(j) AND json_type(j) = 'ARRAY' THEN json_array_length(j) ELSE 0 END::BIGINT AS n FROM j"""


def extracted_years(spark, sf):
    """Distinct numbers of three digits in a text, sorted."""
    found = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all("url", F.lit(r"([0-9]{3})"), 1), lambda x: x.cast("int"))))
    return table(spark, sf, "pages").select("page_id", F.concat_ws(",", found).alias("numbers"))


SQL["extracted_years"] = "SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(url, '[0-9]{3}'), lambda x: CAST(x AS INTEGER)))), ',') AS numbers FROM pages"


def group_sum(spark, sf):
    """Orders by customer segment over all nations, with the share of all orders."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    g = aggregates.first_seen_sums(o.join(c, o["o_custkey"] == c["c_custkey"]), "c_mktsegment", "o_orderkey", orders=F.lit(1), done=(F.col("o_orderstatus") == "F").cast("int"))
    return g.withColumn("percent", aggregates.percentage(F.col("done"), F.col("orders")))


SQL["group_sum"] = "SELECT c_mktsegment, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS done, CAST(floor(count(*) FILTER (o_orderstatus = 'F') / count(*) * 100 + 0.5) AS BIGINT) AS percent, min(o_orderkey) AS first_seen FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"


def layered(spark, sf):
    """Nations grouped by region, listed in order."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy("r_name").agg(F.concat_ws("|", F.array_sort(F.collect_list("n_name"))).alias("nations"))


SQL["layered"] = "SELECT r_name, string_agg(n_name, '|' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1"


NAMES = [k for k in SQL]
