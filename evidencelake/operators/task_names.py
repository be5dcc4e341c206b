"""Names of tasks in the part of a plan that belongs to a subject, with the kind of place they come from.

The subject's part is cut by lines as a Column; tables are read once, in Arrow
batches; all else are DataFrame operations grouped by document and table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions import titles
from ..functions.text import compact
from ..session import spread

# What a label of a task holds, fields that end its values (both in compact form), headings of a course's plan.
TASK_MARKERS = ("수행평가명", "수행평가과제명", "수행평가영역", "수행평가과제", "평가과제명", "평가과제", "평가영역", "과제명", "수행평가")
STOPS = (
    "반영비율", "성취기준", "평가시기", "평가방법", "배점", "만점", "총점", "채점기준", "평가요소", "평가항목",
    "평가내용", "평가방식", "평가만점", "성취수준", "기준영역", "구분", "시기", "학기", "영역만점", "부여점수",
)
COURSE_PLAN = "교수학습.*평가.*(?:계획|운영)"
TABLE = r"(?is)<table\b.*?</table>"
#: Kinds of places; names from bare lines come last.
TABLES, CONTEXT, SECTION = "table", "context", "section"


def is_task_label(key: Column) -> Column:
    return key.rlike("|".join(TASK_MARKERS))


def is_stop(key: Column) -> Column:
    return key.isin(*STOPS)


def subject_lines(text: Column, subject: Column) -> Column:
    """The part of a text from the subject's course plan to the next one of another subject.

    What stands before the first course plan, if there are only others; all of
    it, if there is none. Headings within a plan cut nothing.
    """
    lines = F.split(text, "\n")
    key = compact(F.coalesce(subject, F.lit("")))
    headed = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), F.when(x.rlike(r"^[ \t]*#+[ \t]+\S"), compact(x)).otherwise("").alias("key"))), lambda h: h["key"].rlike(COURSE_PLAN))
    own = F.filter(headed, lambda h: (key != "") & F.contains(h["key"], key))
    start = F.get(own, F.lit(0))["i"]
    other = F.get(F.filter(headed, lambda h: (h["i"] > start) & ~F.contains(h["key"], key)), F.lit(0))["i"]
    stop = F.when(start.isNotNull(), F.coalesce(other, F.size(lines))).otherwise(F.coalesce(F.get(headed, F.lit(0))["i"], F.size(lines)))
    begin = F.coalesce(start, F.lit(0))
    return F.regexp_replace(F.array_join(F.slice(lines, begin + 1, stop - begin), "\n"), r"(?U)^\s+|\s+\z", "")


def _of_tables(rows: DataFrame) -> DataFrame:
    """(id, at, raw): values right of a label up to the next field; where none stands there, the only value of the column below."""
    cells = F.transform("cells", lambda c: F.struct(c["text"].alias("text"), compact(c["text"]).alias("key")))
    read = rows.withColumn("cells", cells)
    labels = read.select("*", F.posexplode("cells").alias("col_no", "label")).where(is_task_label(F.col("label.key")))
    right = F.filter(F.slice("cells", F.col("col_no") + 2, F.size("cells")), lambda c: F.trim(c["text"]) != "")
    labels = labels.select("id", "table_no", "row_no", "col_no", right.alias("right"))
    labels = labels.withColumn("beside", F.exists("right", lambda c: ~is_stop(c["key"])))
    ends = F.filter(F.transform("right", lambda c, i: F.when(is_stop(c["key"]) | is_task_label(c["key"]), i)), lambda i: i.isNotNull())
    values = F.slice("right", F.lit(1), F.coalesce(F.get(ends, F.lit(0)), F.size("right")))
    across = labels.where("beside").select("id", "table_no", "row_no", "col_no", F.posexplode(values).alias("k", "value")).select("id", F.struct(F.lit(0).alias("kind"), "table_no", "row_no", "col_no", "k").alias("at"), F.col("value.text").alias("raw"))
    below = read.select("id", "table_no", F.col("row_no").alias("low"), F.posexplode("cells").alias("col_no", "value")).where(F.trim("value.text") != "")
    down = labels.where("not beside").drop("right", "beside").join(below, ["id", "table_no", "col_no"]).where("low > row_no")
    down = down.groupBy("id", "table_no", "row_no", "col_no").agg(F.min_by("value.text", "low").alias("raw"), F.min("value.key").alias("a"), F.max("value.key").alias("z")).where("a = z")
    return across.unionByName(down.select("id", F.struct(F.lit(0).alias("kind"), "table_no", "row_no", "col_no", F.lit(0).alias("k")).alias("at"), "raw"))


def _of_lines(local: DataFrame) -> DataFrame:
    """(id, at, raw, source) of lines outside tables: the cell behind a label, or, in a text without tables, each bare line."""
    lines = F.transform(F.split(F.regexp_replace("local", TABLE, "\n"), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    rows = local.select("id", F.col("local").rlike(TABLE).alias("tabled"), F.posexplode(lines).alias("line_no", "line")).where("line <> ''")
    piped = F.contains("line", F.lit(" | "))
    cells = F.transform(F.split("line", r"\|"), lambda c: F.trim(c))
    found = F.filter(F.transform(cells, lambda c, i: F.struct(i.alias("i"), F.coalesce(F.get(cells, i + 1), F.lit("")).alias("next"), is_task_label(compact(c)).alias("label"))), lambda c: c["label"] & (c["next"] != ""))
    at = lambda k: F.struct(F.lit(1).alias("kind"), F.lit(0).alias("table_no"), F.col("line_no").alias("row_no"), k.alias("col_no"), F.lit(0).alias("k")).alias("at")
    context = rows.where(piped).select("id", "line_no", F.explode(found).alias("c")).select("id", at(F.col("c.i")), F.col("c.next").alias("raw"), F.lit(CONTEXT).alias("source"))
    bare = rows.where(~piped & ~F.col("tabled") & ~F.col("line").startswith("#")).select("id", at(F.lit(0)), F.col("line").alias("raw"), F.lit(SECTION).alias("source"))
    return context.unionByName(bare)


def derived_names(cases: DataFrame) -> DataFrame:
    """(id, rank, name, source) of (id, subject, text, seen): names that are new, not rejected and each once.

    ``seen`` holds names that are known already. Equal compact names keep their
    first place. Names from tables and labelled lines come before bare lines;
    within them the longer comes first, then the first in the text. Null texts
    have none; ids must differ.
    """
    local = spread(cases, "id").select("id", subject_lines(F.coalesce("text", F.lit("")), F.col("subject")).alias("local"))
    grid = M.grid_rows(local, "id", "local")
    rows = grid.groupBy("id", "table_no", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", "text"))).alias("cells"))
    raw = _of_tables(rows).withColumn("source", F.lit(TABLES)).unionByName(_of_lines(local))
    named = raw.select("id", "at", "source", titles.normalize_name(F.col("raw")).alias("name")).where((F.col("name") != "") & ~titles.is_rejected(F.col("name")))
    once = named.withColumn("key", compact(F.col("name"))).groupBy("id", "key").agg(F.min(F.struct("at", "name", "source")).alias("first"))
    known = cases.select("id", F.explode("seen").alias("name")).select("id", compact(titles.normalize_name(F.col("name"))).alias("key")).distinct()
    fresh = once.join(known, ["id", "key"], "left_anti")
    order = Window.partitionBy("id").orderBy(F.col("first.source") == SECTION, -F.length("key"), "first.at")
    return fresh.select("id", F.row_number().over(order).alias("rank"), "first.name", "first.source")
