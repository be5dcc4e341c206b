"""Queries of small operators: rosters, set operations, ordered distinct values, client projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates, client, dedupe
from ..session import table

SQL = {}


def roster(spark, sf):
    """The first customer of each nation and segment."""
    c = table(spark, sf, "customer").withColumn("key", F.concat_ws("/", "c_nationkey", "c_mktsegment"))
    return dedupe.first_wins(c, "key", "c_custkey").select("key", "c_custkey")


SQL["roster"] = "SELECT c_nationkey || '/' || c_mktsegment AS key, min(c_custkey) AS c_custkey FROM customer GROUP BY 1"


def manifest_counts(spark, sf):
    """Documents and distinct sources of each language, and of all."""
    d = table(spark, sf, "documents")
    per = d.groupBy("lang").agg(F.count("*").alias("documents"), F.count_distinct("source").alias("sources"))
    return per.unionByName(d.agg(F.lit("all").alias("lang"), F.count("*").alias("documents"), F.count_distinct("source").alias("sources")))


SQL["manifest_counts"] = "SELECT lang, count(*) AS documents, count(DISTINCT source) AS sources FROM documents GROUP BY 1 UNION ALL SELECT 'all', count(*), count(DISTINCT source) FROM documents"


def run_counters(spark, sf):
    """Counts of event types, of days of the week and of keys in their properties, as one table."""
    e = table(spark, sf, "events")
    pairs = F.array(F.struct(F.lit("type").alias("counter"), F.col("event_type").alias("value")), F.struct(F.lit("day").alias("counter"), F.date_format("ts", "yyyy-MM").alias("value")), F.struct(F.lit("k").alias("counter"), (F.get_json_object("props", "$.k").cast("int") % 10).cast("string").alias("value")))
    return e.select(F.explode(pairs).alias("p")).groupBy("p.counter", "p.value").agg(F.count("*").alias("n"))


SQL["run_counters"] = """SELECT counter, value, count(*) AS n FROM (SELECT 'type' AS counter, event_type AS value FROM events UNION ALL SELECT 'day', strftime(ts, '%Y-%m') FROM events
UNION ALL SELECT 'k', CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR) FROM events) GROUP BY ALL"""


def keys_without_partner(spark, sf):
    """Customers without a pending order."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("key")).distinct().join(table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key")), "key", "left_anti")


SQL["keys_without_partner"] = "SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'"


def ordered_distinct(spark, sf):
    """Roles of each conversation in the order they first speak."""
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("l"))
    return c.select("conv_id", F.concat_ws(",", F.array_distinct(F.transform("l", lambda x: x["role"]))).alias("roles"))


SQL["ordered_distinct"] = "SELECT conv_id, string_agg(role, ',' ORDER BY t, role) AS roles FROM (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY ALL) GROUP BY conv_id"


def completeness(spark, sf):
    """How many of four words a document has."""
    marks = [F.regexp_count("text", F.lit(w)) for w in ("License", "@", r"\|", "!!")]
    return table(spark, sf, "documents").groupBy(client.completeness(*marks).cast("long").alias("marks")).agg(F.count("*").alias("documents"))


SQL["completeness"] = "SELECT CAST(contains(text, 'License') AS BIGINT) + CAST(contains(text, '@') AS BIGINT) + CAST(contains(text, '|') AS BIGINT) + CAST(contains(text, '!!') AS BIGINT) AS marks, count(*) AS documents FROM documents GROUP BY 1"


def reference_choice(spark, sf):
    """Three cheapest-numbered parts of each brand, one for each type."""
    p = table(spark, sf, "part").select(F.col("p_brand").alias("g"), F.col("p_partkey").cast("string").alias("case_id"), F.col("p_name").alias("title"), F.col("p_type").alias("sha256"), F.col("p_partkey").alias("seq"))
    return client.reference_cases(p, "g").select("g", "case_id")


SQL["reference_choice"] = """SELECT g, case_id FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k) AS n FROM (SELECT p_brand AS g, CAST(p_partkey AS VARCHAR) AS case_id, p_partkey AS k, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS r FROM part) WHERE r = 1) WHERE n <= 3"""


def flag_counts(spark, sf):
    """Documents under each of three flags, and the sources with most of them."""
    d = table(spark, sf, "documents").withColumn("flag", F.explode(F.array_compact(F.array(F.when(F.col("n_chars") < 300, F.lit("short")), F.when(F.col("text").contains("!!"), F.lit("shout")), F.when(F.col("text").contains("|"), F.lit("table"))))))
    return aggregates.most_common(d, ["flag"], "source", "doc_id", 3).select("flag", "source", "count", F.col("rank").cast("long").alias("rank"))


SQL["flag_counts"] = """WITH f AS (SELECT doc_id, source, 'short' AS flag FROM documents WHERE n_chars < 300 UNION ALL SELECT doc_id, source, 'shout' FROM documents WHERE contains(text, '!!') UNION ALL SELECT doc_id, source, 'table' FROM documents WHERE contains(text, '|')),
g AS (SELECT flag, source, count(*) AS count, min(doc_id) AS m FROM f GROUP BY ALL) SELECT flag, source, count, rank FROM (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY count DESC, m) AS rank FROM g) WHERE rank <= 3"""


def client_keys(spark, sf):
    """Client keys of events: the first forwarded address, else the real one, and the path."""
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" 10.0.0."), F.col("user_id") % 9, F.lit(", x"))).alias("fw"), F.when(F.col("event_id") % 3 == 0, F.lit("192.168.0.1")).alias("real"), F.concat(F.lit("/"), "event_type").alias("path"))
    return e.groupBy(T.client_key(F.col("fw"), F.col("real"), F.col("path")).alias("client")).agg(F.count("*").alias("hits"))


SQL["client_keys"] = "SELECT CASE WHEN event_id % 2 = 0 THEN '10.0.0.' || (user_id % 9) WHEN event_id % 3 = 0 THEN '192.168.0.1' ELSE 'unknown' END || ':/' || event_type AS client, count(*) AS hits FROM events GROUP BY 1"


def api_parameters(spark, sf):
    """Query strings of customers, empty values left out."""
    m = F.create_map(F.lit("region"), F.col("c_nationkey").cast("string"), F.lit("tag"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")), F.lit("q"), F.when(F.col("c_custkey") % 3 == 0, F.lit("a b&c")).otherwise(F.lit("")))
    return table(spark, sf, "customer").select("c_custkey", T.api_parameters(m).alias("query"))


SQL["api_parameters"] = "SELECT c_custkey, concat_ws('&', 'region=' || c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN 'tag=' || c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN 'q=a+b%26c' END) AS query FROM customer"

NAMES = list(SQL)
