"""Rows as the read service's clients get them: names of the interface, typed lists, nested groups.

What a table does not have is empty (text), zero (count) or an empty list, and so is a
null, as clients never see one but for scores and coverage, where null means unknown.
Lists may be stored as arrays or as JSON texts; what is no number in a list of numbers
is left out. Other columns are not shown, whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import text as T
from ..functions import titles
from . import serve

# Names of the groups' fields and the columns they come from.
MARKERS = {"rubric": "rubric_marker_count", "achievement_standard": "achievement_standard_marker_count", "weight_or_points": "weight_or_points_marker_count", "assessment_method": "assessment_method_marker_count"}
MARKED_DOCUMENTS = {"rubric": "rubric_documents", "achievement_standard": "achievement_standard_documents", "weight_or_points": "weight_or_points_documents", "assessment_method": "assessment_method_documents"}
GRADE_DOCUMENTS = {"1": "grade1_documents", "2": "grade2_documents", "3": "grade3_documents"}
COVERAGE = {"found": "coverage_found", "found_curriculum_ambiguous": "coverage_ambiguous", "not_found_in_collected_plans": "coverage_not_found", "offering_unknown": "coverage_offering_unknown", "extraction_failed": "coverage_extraction_failed"}
# Labels and units of the metric panels, and what stands for an unknown number.
HERO = (("공개 확정 학교", "schools", ""), ("공개 수행평가", "items", ""), ("공개 확정 사례", "confirmed_cases", ""))
SNAPSHOT = (("공개계획 확인 대상", "plans_checked", "곳"), ("수집 정규화 사례", "cases", "건"), ("공개 확정 학교", "schools", "곳"), ("공개 확정 사례", "confirmed_cases", "건"), ("공개 수행평가", "items", "건"))
UNKNOWN = "—"


class Fields:
    """The columns of a table as typed values of a response."""

    def __init__(self, df: DataFrame):
        self.types = {f.name: f.dataType for f in df.schema.fields}

    def text(self, name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in self.types else F.lit("")

    def raw(self, name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in self.types else F.lit(None).cast(kind)

    def count(self, name: str) -> Column:
        return F.coalesce(self.raw(name, "long"), F.lit(0).cast("long"))

    def flag(self, name: str) -> Column:
        return F.coalesce(self.raw(name, "boolean"), F.lit(False))

    def texts(self, name: str) -> Column:
        if name not in self.types:
            return F.array().cast("array<string>")
        if isinstance(self.types[name], ArrayType):
            return F.coalesce(F.col(name).cast("array<string>"), F.array().cast("array<string>"))
        return T.json_list(F.col(name))

    def numbers(self, name: str) -> Column:
        return F.array_compact(F.transform(self.texts(name), lambda x: x.try_cast("int")))

    def group(self, fields: dict[str, str], kind: str | None = None) -> Column:
        return F.struct(*((self.raw(c, kind) if kind else self.count(c)).alias(n) for n, c in fields.items()))


def _subject(f: Fields) -> list[Column]:
    named = [f.text("curriculum").alias("curriculum"), f.text("subject").alias("subject"), f.count("documents").alias("documents"), f.count("schools").alias("schools")]
    return [*named, f.flag("small_sample").alias("small_sample"), (f.text("curriculum") == "shared").alias("curriculum_ambiguous")]


def subject_rows(stats: DataFrame) -> DataFrame:
    return stats.select(*_subject(Fields(stats)))


def trend_rows(trends: DataFrame) -> DataFrame:
    """Statistics with tags (see ``serve.trends``); a subject without tags has an empty list."""
    f = Fields(trends)
    tags = F.coalesce("action_tags", F.array().cast(trends.schema["action_tags"].dataType))
    return trends.select(
        *_subject(f), f.numbers("academic_years").alias("academic_years"), f.group(GRADE_DOCUMENTS).alias("grade_documents"), f.group(MARKED_DOCUMENTS).alias("evidence_documents"),
        f.raw("median_review_score", "double").alias("median_evidence_score"), f.count("task_name_candidates").alias("task_name_candidates"), tags.alias("action_tags"), f.group(COVERAGE, "long").alias("coverage"),
    )


def plain(text: Column) -> Column:
    """One line of what the markup says."""
    return T.collapse(T.plain_text(text))


def case_rows(cases: DataFrame) -> DataFrame:
    """Cases as responses; what may be shown of them is decided by ``serve.case_item``.

    Lists of a case of another subject are empty, as its texts are blank.
    """
    f = Fields(cases)
    other = f.text("subject_alignment") == "other"
    bundle = f.text("title_basis") == "source_detail_bundle_review"
    own = lambda c, empty: F.when(other, empty).otherwise(c)
    none, blank = F.array().cast("array<string>"), F.lit("")
    overview = plain(f.text("overview"))
    weight = f.text("weight")
    structure = F.struct(
        own(F.when(overview.rlike(f"(?U){serve.ROUGH_OVERVIEW}"), blank).otherwise(overview), blank).alias("overview"), titles.display_methods(f.texts("methods")).alias("methods"),
        F.when(weight.isin("0점", "0%"), "").otherwise(weight).alias("weight"), own(f.texts("standards"), none).alias("standards"), own(f.texts("criteria"), none).alias("criteria"), f.text("title_basis").alias("basis"),
    )
    return cases.select(
        f.text("case_id").alias("case_id"), f.text("curriculum").alias("curriculum"), f.text("subject").alias("subject"), (f.text("curriculum") == "shared").alias("curriculum_ambiguous"), f.text("curriculum_basis").alias("curriculum_basis"),
        f.text("school_name").alias("school_name"), f.text("region").alias("region"), f.text("district").alias("district"),
        *(f.numbers(c).alias(c) for c in ("academic_years", "grades", "semesters")),
        F.when(bundle, serve.BUNDLE_TITLE).otherwise(plain(f.text("title"))).alias("primary_task_name"), F.when(bundle, none).otherwise(F.transform(f.texts("task_names"), plain)).alias("task_names"), f.texts("action_tags").alias("action_tags"),
        f.group(MARKERS).alias("evidence_markers"), f.count("review_score").alias("evidence_score"), own(plain(f.text("excerpt")), blank).alias("evidence_excerpt"), structure.alias("assessment_structure"),
        f.text("category").alias("category"), f.count("priority_score").alias("priority_score"), f.texts("priority_signals").alias("priority_signals"),
        f.text("candidate_name").alias("source_name"), f.text("source_url").alias("source_url"), f.text("source_sha256").alias("source_sha256"),
    )


def item_rows(items: DataFrame) -> DataFrame:
    """Summaries of items: whether the source may be shown, and whether it has a rubric."""
    f = Fields(items)
    shown = f.text("extraction_status") == "bounded"
    length = F.length(f.text("rubric_html")) if "rubric_html" in items.columns else f.count("rubric_html_char_count")
    plain_fields = ("title", "title_raw", "title_basis", "extraction_status", "overview")
    return items.select(
        f.text("item_id").alias("item_id"), f.count("item_order").alias("order"), *(f.text(c).alias(c) for c in plain_fields), F.array_join(titles.display_methods(F.array(f.text("method"))), " · ").alias("method"),
        *(f.text(c).alias(c) for c in ("timing", "score", "weight")), f.texts("standards").alias("standards"), (shown & (length > 0)).alias("has_rubric"), shown.alias("source_available"),
    )


def metric_panel(meta: DataFrame, panel=SNAPSHOT) -> DataFrame:
    """(pos, label, value) of one row of counts: thousands apart, with a unit; a missing number is a dash."""
    cell = lambda name, unit: F.coalesce(F.concat(F.format_number(F.col(name).cast("long"), 0), F.lit(unit)), F.lit(UNKNOWN)) if name in meta.columns else F.lit(UNKNOWN)
    return meta.select(F.posexplode(F.array(*(F.struct(F.lit(label).alias("label"), cell(name, unit).alias("value")) for label, name, unit in panel))).alias("pos", "p")).select("pos", "p.*")
