"""Audits and release gates over published tables. Each returns rows; ``sinks.fail_if_any`` makes a gate of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import titles
from ..operators import aggregates, joins, search
from .serve import Published, bounded


def orphan_counts(p: Published, details: DataFrame) -> DataFrame:
    """(relation, orphans) of the keys that must have a partner."""
    pairs = (("items_without_case", p.items, p.cases, "case_id"), ("rankings_without_item", p.rankings, p.items, "item_id"), ("items_without_ranking", p.items, p.rankings, "item_id"), ("details_without_case", details, p.cases, "case_id"), ("cases_without_detail", p.cases, details, "case_id"))
    made = None
    for name, left, right, key in pairs:
        part = left.join(right.select(key), key, "left_anti").agg(F.count("*").alias("orphans")).select(F.lit(name).alias("relation"), "orphans")
        made = part if made is None else made.unionByName(part)
    return made


def gate_reasons(items: DataFrame, cases: DataFrame) -> DataFrame:
    """Bounded items that may not be published, with all reasons."""
    rows = bounded(items).join(cases.select("case_id", "source_url", "sha256"), "case_id")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    reasons = search.all_reasons(("missing_source_url", blank("source_url")), ("missing_sha256", blank("sha256")), ("boundary_not_trusted", T.boundary_grade(F.col("boundary_status")) != "trusted"), ("missing_source_html", blank("source_html")))
    return rows.withColumn("reasons", reasons).where("reasons <> ''").select("item_id", "reasons")


def structure_queue(details: DataFrame) -> DataFrame:
    """Cases with an untrusted boundary, or a section of under 500 characters."""
    grade = T.boundary_grade(F.col("boundary_status"))
    reasons = search.all_reasons(("untrusted_boundary", grade == "untrusted"), ("short_section", F.coalesce("section_char_count", F.lit(0)) < 500))
    return details.withColumn("grade", grade).withColumn("reasons", reasons).where("reasons <> ''")


def grade_crosstab(details: DataFrame, cases: DataFrame) -> DataFrame:
    """Boundary grades by source format."""
    rows = details.join(cases.select("case_id", "source_format"), "case_id").withColumn("grade", T.boundary_grade(F.col("boundary_status")))
    return aggregates.crosstab(rows, ["source_format"], "grade", ["trusted", "partial", "untrusted"])


def identity_leaks(items: DataFrame) -> DataFrame:
    """Bounded items whose markup holds a mobile or resident number."""
    return bounded(items).where(T.leaks_identity(F.col("source_html"))).select("item_id")


def recomputed_stats(cases: DataFrame, stored: DataFrame) -> DataFrame:
    """Differences between stored statistics and those of the cases."""
    place = F.concat_ws("|", "school_name", "region", "district")
    computed = cases.groupBy("curriculum", "subject").agg(F.count("*").alias("documents"), F.count_distinct(place).alias("schools"), F.percentile("review_score", F.lit(0.5)).alias("median_review_score"))
    return joins.differences(stored, computed, ["curriculum", "subject"], ["documents", "schools", "median_review_score"])


def title_grades(cases: DataFrame) -> DataFrame:
    """(case_id, title, source, confidence) of every candidate title."""
    labelled = F.coalesce("title_basis", F.lit("")).startswith("table")
    return cases.select("case_id", labelled.alias("labelled"), F.explode("task_names").alias("title")).select("case_id", "title", F.when(F.col("labelled"), "table").otherwise("derived").alias("source"), titles.confidence(F.col("title"), F.col("labelled")).alias("confidence"))


def confidence_counts(graded: DataFrame, items: DataFrame) -> DataFrame:
    """Titles of each confidence, for all cases (``all``) and by the extraction status of their items."""
    status = items.select("case_id", F.col("extraction_status").alias("status")).distinct()
    by = graded.join(status, "case_id", "left").withColumn("status", F.coalesce("status", F.lit("none")))
    return aggregates.crosstab(by.unionByName(graded.withColumn("status", F.lit("all"))), ["status"], "confidence", ("supported", "review", "reject"))


def review_queue(graded: DataFrame) -> DataFrame:
    """Titles that are not supported, in order, for a reviewer."""
    return graded.where("confidence <> 'supported'").orderBy("case_id", "title")


def unresolved(cases: DataFrame, graded: DataFrame) -> DataFrame:
    """Cases without a supported title."""
    return cases.join(graded.where("confidence = 'supported'").select("case_id"), "case_id", "left_anti")


def promotable(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recovered titles that may be used, and the counts of the others by the first reason against them."""
    reason = search.first_reason(
        ("not_high_confidence", F.col("confidence") != "high"), ("not_table_row", F.col("detection") != "table_row"), ("not_expected_subject", F.col("subject_alignment") != "expected"),
        ("no_explicit_label", ~F.col("explicit_name_label")), ("incomplete_title", ~F.col("title_looks_complete")), ("other_subject", F.col("other_subject_signal")),
    )
    rows = candidates.withColumn("reason", reason)
    return rows.where("reason IS NULL").dropDuplicates(["case_id", "candidate"]).drop("reason"), rows.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("candidates"))
