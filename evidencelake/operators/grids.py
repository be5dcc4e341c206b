"""Relational operators over exploded grids (id, table_no, row_no, col_no, text)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import headings, titles
from ..functions.sections import LABELS
from ..functions.text import compact

CELL = ("id", "table_no", "row_no")


def field_of(text: Column) -> Column:
    """The field a cell's label names; null for a value."""
    short = compact(F.regexp_replace(text, r"\([^)]*\)", ""))
    chain = F.lit(None).cast("string")
    for name, words in reversed(LABELS.items()):
        chain = F.when(short.isin(*words), name).otherwise(chain)
    return chain


def labelled_values(grid: DataFrame) -> DataFrame:
    """(id, table_no, row_no, field, value): each label with the next cell of its row that differs and is no label; spanned repeats count once."""
    in_row = Window.partitionBy(*CELL).orderBy("col_no")
    once = grid.withColumn("_before", F.lag("text").over(in_row)).where(F.col("_before").isNull() | (F.col("_before") != F.col("text")))
    marked = once.withColumn("field", field_of(F.col("text"))).withColumn("value", F.lead("text").over(in_row)).withColumn("_next", F.lead("field").over(in_row))
    return marked.where(F.col("field").isNotNull() & F.col("_next").isNull() & (F.coalesce("value", F.lit("")) != "")).select(*CELL, "field", "value")


def column_values(grid: DataFrame) -> DataFrame:
    """(id, table_no, row_no, field, value) of tables whose first row is a header of two fields or more."""
    head = grid.where("row_no = 0").withColumn("field", field_of(F.col("text"))).where("field IS NOT NULL").select("id", "table_no", "col_no", "field")
    wide = head.groupBy("id", "table_no").agg(F.count_distinct("field").alias("n")).where("n >= 2").select("id", "table_no")
    return grid.where("row_no > 0 AND text <> ''").join(head.join(wide, ["id", "table_no"]), ["id", "table_no", "col_no"]).select(*CELL, "field", F.col("text").alias("value"))


def structure(grid: DataFrame) -> DataFrame:
    """One row for each id: the first overview, the last method and weight, unique standards in order."""
    values = labelled_values(grid).unionByName(column_values(grid)).withColumn("at", F.struct("table_no", "row_no", "value"))
    pick = lambda name, agg: agg(F.when(F.col("field") == name, F.col("at")))["value"]
    found = F.regexp_extract_all("text", F.lit(r"\[\s*(?:10|12)[^\[\]]{2,24}?-\s*\d{2}(?:-\d{2})?\s*\]"), 0)
    codes = grid.select("id", F.struct("table_no", "row_no", "col_no").alias("at"), F.posexplode(found).alias("k", "code")).groupBy("id", "code").agg(F.min(F.struct("at", "k")).alias("first"))
    listed = codes.groupBy("id").agg(F.concat_ws("|", F.transform(F.array_sort(F.collect_list(F.struct("first", "code"))), lambda c: c["code"])).alias("standards"))
    base = values.groupBy("id").agg(pick("overview", F.min).alias("overview"), pick("method", F.max).alias("method"), pick("weight", F.max).alias("weight"))
    return base.join(listed, "id", "full_outer").fillna("")


def task_names(grid: DataFrame) -> DataFrame:
    """(id, name): normalised values of title labels that are not rejected, each once."""
    values = labelled_values(grid).unionByName(column_values(grid)).where("field = 'title'")
    named = values.select("id", titles.normalize_name(F.col("value")).alias("name"))
    return named.where((F.col("name") != "") & ~titles.is_rejected(F.col("name"))).distinct()


def recovery_candidates(grid: DataFrame) -> DataFrame:
    """(id, candidate, confidence) of values beside a title label, of a name's length, graded; rejected ones left out."""
    values = labelled_values(grid).where("field = 'title'").select("id", F.regexp_replace(F.trim("value"), r"\s+", " ").alias("candidate"))
    short = F.length(compact(F.col("candidate")))
    graded = values.where((short >= 2) & (short <= 60)).withColumn("confidence", titles.confidence(F.col("candidate"), F.lit(True)))
    return graded.where("confidence <> 'reject'").distinct()


def legacy_curated(items: DataFrame, category: str, other_subjects: tuple[str, ...] = (), least: int = 38) -> DataFrame:
    """Items of a category by the older rules: one line, no window mark, no label, no number at the end, no other subject's name."""
    title = F.col("title")
    named = reduce(Column.__or__, (F.contains(title, F.lit(s)) for s in other_subjects), F.lit(False))
    return items.where((F.col("category") == category) & (F.col("priority_score") >= least) & ~F.contains(title, F.lit("\n")) & ~F.contains(title, F.lit("문맥 전환")) & ~title.startswith("평가 방법:") & ~title.rlike(r"(?s)^.* [0-9]\z") & ~named & (F.col("extraction_status") == "bounded"))


def title_flags(title: Column) -> Column:
    """Flags of a published title, over-flagging by design, joined by ``|``."""
    text, short = F.trim(title), compact(F.trim(title))
    flags = (
        ("empty_title", short == ""), ("structural_heading", headings.is_structural(text)), ("policy_prose", titles.is_policy_prose(text)), ("exam_name", text.rlike(r"(?U)^(?:제?\d*\s*[차회]?\s*)?(?:중간|기말|정기)?\s*(?:고사|시험)$")),
        ("field_label_as_title", field_of(text).isNotNull()), ("achievement_code_as_title", text.rlike(r"^\[?(?:10|12)[가-힣A-ZⅠ-Ⅹ]{1,6}\d")), ("score_only", text.rlike(r"(?U)^[\d\s.,()%점배분]+$")),
        ("sentence_length", F.length(short) > 60), ("bullet_prefix", text.rlike("^[·•▪∙ㆍ-]")),
    )
    return F.concat_ws("|", F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in flags))))
