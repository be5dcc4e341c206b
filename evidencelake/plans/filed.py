"""Queries that write a table with a sink and read it back with a source, and queries of what files and responses hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_path, table
from ..sources import files, sinks

SQL = {}


def json_lines(spark, sf):
    """Customers as JSON lines, read back with the check of all lines; what is no object is left out."""
    path = shared_path(spark, "lines")
    c = table(spark, sf, "customer")
    objects = c.select(F.to_json(F.struct("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("c_mktsegment"))).alias("value"))
    objects.unionByName(c.select(F.concat(F.lit("["), "c_custkey", F.lit("]")).alias("value"))).write.text(path)
    return files.objects(spark, path, "c_custkey long, c_name string, c_mktsegment string")


SQL["json_lines"] = "SELECT c_custkey::BIGINT AS c_custkey, c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS c_mktsegment FROM customer"


def bad_lines(spark, sf):
    """Suppliers as lines in one file, every seventh cut short: lines, malformed lines and the number of the first one."""
    path = shared_path(spark, "bad")
    line = F.concat(F.lit('{"s_suppkey":'), F.col("s_suppkey"), F.when(F.col("s_suppkey") % 7 == 6, "").otherwise("}"))
    table(spark, sf, "supplier").select("s_suppkey", line.alias("value")).repartitionByRange(1, "s_suppkey").sortWithinPartitions("s_suppkey").select("value").write.text(path)
    counts = files.jsonl_counts(spark, path, "s_suppkey long")
    return counts.crossJoin(files.first_bad_lines(spark, path).agg(F.min("line_no").alias("line_no"), F.count("*").alias("files")))  # one row each


SQL["bad_lines"] = "SELECT count(*) AS rows, count(*) FILTER (s_suppkey % 7 = 6) AS bad_json_rows, min(n) FILTER (s_suppkey % 7 = 6) AS line_no, 1::BIGINT AS files FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier)"


def marked_csv(spark, sf):
    """Parts as CSV with a byte order mark, quotes and line ends in values, read back; missing values are empty texts."""
    path = shared_path(spark, "csv")
    p = table(spark, sf, "part")
    name = F.concat(F.col("p_name"), F.lit(', "x"'), F.when(F.col("p_partkey") % 5 == 0, "\nnext").otherwise(""))
    rows = p.select(F.col("p_partkey").cast("string").alias("p_partkey"), name.alias("p_name"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("p_brand"))
    sinks.write_csv(rows, path, bom=True)
    return files.csv(spark, path, "p_partkey", "p_name", "p_brand")


SQL["marked_csv"] = """SELECT p_partkey::VARCHAR AS p_partkey, p_name || ', "x"' || CASE WHEN p_partkey % 5 = 0 THEN chr(10) || 'next' ELSE '' END AS p_name, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS p_brand FROM part"""


def replaced_table(spark, sf):
    """A table put in the place of another by the changes of some rows."""
    path = shared_path(spark, "replaced")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sinks.replace_table(o, path)
    changes = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.concat("o_orderstatus", F.lit("!")).alias("o_orderstatus"))
    after = sinks.with_column_if_missing(sinks.updated(spark.read.parquet(path), changes, ["o_orderkey"]), "note", F.lit(""))
    sinks.replace_table(after, path + "-next")
    return spark.read.parquet(path + "-next")


SQL["replaced_table"] = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || '!' ELSE o_orderstatus END AS o_orderstatus, '' AS note FROM orders"


def part_manifest(spark, sf):
    """Rows of the parts of a written table, added up, and whether a part holds more than allowed."""
    parts = sinks.manifest(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), shared_path(spark, "parts"), 500)
    return parts.agg(F.sum("rows").alias("rows"), F.coalesce(F.max("rows") > 500, F.lit(False)).alias("too_many"), (F.count_distinct("file") == F.count("*")).alias("once"))


SQL["part_manifest"] = "SELECT count(*) AS rows, false AS too_many, true AS once FROM lineitem"


def read_order(spark, sf):
    """Nations in the order of the file they were written to."""
    path = shared_path(spark, "ordered")
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("value"))
    n.repartitionByRange(1, "n_nationkey").sortWithinPartitions(F.desc("n_nationkey")).select("value").write.text(path)
    rows = files.ordered(spark.read.text(path))
    return rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "value"))), lambda x: x["value"]), ",").alias("names"))  # 25 rows


SQL["read_order"] = "SELECT string_agg(n_name, ',' ORDER BY n_nationkey DESC) AS names FROM nation"


def payload_kinds(spark, sf):
    """What payloads are by their first bytes."""
    heads = F.array(*(F.to_binary(F.lit(h), F.lit("hex")) for h in ("255044462D", "504B0304AA", "D0CF11E0", "20203C48544D4C3E", "3C21646F63747970652068", "00")))
    kind = files.payload_kind(F.element_at(heads, (F.col("o_orderkey") % 6 + 1).cast("int")))
    return table(spark, sf, "orders").select("o_orderkey", kind.alias("kind"))


SQL["payload_kinds"] = "SELECT o_orderkey, ['pdf', 'zip', 'ole', 'html', 'html', 'unknown'][o_orderkey % 6 + 1] AS kind FROM orders"


def response_states(spark, sf):
    """What responses say, by code and words; pages stand for their texts."""
    p = table(spark, sf, "pages")
    code = F.element_at(F.array(*map(F.lit, (200, 403, 500, 204))), (F.col("page_id") % 4 + 1).cast("int"))
    return p.select("page_id", files.response_status(code, F.coalesce("html", F.lit("")), ("track(0)",), ("</article>",)).alias("status"))


SQL["response_states"] = """SELECT page_id, CASE WHEN page_id % 4 = 1 OR contains(lower(coalesce(html, '')), 'track(0)') THEN 'blocked' WHEN page_id % 4 = 2 THEN 'failed' WHEN contains(lower(coalesce(html, '')), '</article>') THEN 'missing' ELSE 'ok' END AS status FROM pages"""


def stored_names(spark, sf):
    """Names under which files are stored: code, digest, safe name; equal contents once."""
    d = table(spark, sf, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    named = d.where("text IS NOT NULL").select("doc_id", F.concat(F.lit("K"), F.col("doc_id") % 10).alias("code"), F.concat(F.lit(" a/b: "), F.col("doc_id"), F.lit("?.hwp ")).alias("name"), "text")
    return sinks.content_addressed(named, "code", "name", "text").select("doc_id", "stored_name")


SQL["stored_names"] = "SELECT doc_id, 'K' || (doc_id % 10) || '_' || left(sha256(text), 12) || '_a_b_' || doc_id || '_.hwp' AS stored_name FROM (SELECT text, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text)"

NAMES = [*SQL]
