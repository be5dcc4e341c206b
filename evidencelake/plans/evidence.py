"""The evidence pipeline: documents to evidence records, strict records, catalog, coverage and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import evidence as located
from ..functions import text as T
from ..operators import aggregates, dedupe, joins, search
from ..rules import PLANS_KO, RulePack


def manifest(log: DataFrame) -> DataFrame:
    """Downloaded attachments of the wanted item, the first of each file; with subject and curriculum of the name. ``seq`` orders the log."""
    wanted = log.where((F.col("result") == "downloaded") & (F.coalesce("item_no", F.lit("")).isin("", "4-가")) & (F.coalesce("record_type", F.lit("")).isin("", "attachment")))
    keyed = wanted.withColumn("_file", T.first_filled(F.col("saved_path"), F.col("final_url")))
    kept = dedupe.first_wins(keyed, "_file", "seq").drop("_file")
    found = T.classify(F.col("candidate_name"))
    return kept.withColumn("curriculum_candidate", T.curriculum_candidate(F.concat_ws(" ", "source_url", "final_url"), F.col("candidate_name"))).withColumn("_c", found).select("*", "_c.*").drop("_c").withColumn("needs_text_scan", F.col("match_type") == "needs_text_scan")


def evidence_records(documents: DataFrame, rules: RulePack = PLANS_KO) -> DataFrame:
    """Documents x subjects that occur in them (stored labels where none is found), with evidence around their place."""
    stored = F.coalesce("subject_hits", F.array().cast("array<struct<subject:string,curriculum_hint:string>>"))
    wanted = lambda found: F.filter(F.array_distinct(F.when(F.size(found) > 0, found).otherwise(stored)), lambda h: h["subject"] != "")
    # bound step by step and exploded: as columns of a filter, mask and patterns would be put into it at every place where they are used
    masked = F.array(T.mask_sensitive(F.coalesce("text", F.lit("")), rules))
    found = F.transform(masked, lambda t: F.struct(t.alias("text"), T.subject_hits(t, rules).alias("found")))
    hits = F.filter(F.transform(found, lambda d: F.struct(d["text"].alias("text"), wanted(d["found"]).alias("h"))), lambda d: F.size(d["h"]) > 0)
    listed = documents.select(*(F.col(c) for c in documents.columns if c != "text"), F.explode(hits).alias("_d")).select("*", F.col("_d.text").alias("text"), F.col("_d.h").alias("_h")).drop("_d")
    # a document is read once for all its subjects
    read = listed.withColumn("_e", located.evidence(F.col("text"), F.transform("_h", lambda h: h["subject"]), rules)).withColumn("_p", F.explode(F.arrays_zip("_h", "_e")))
    rows = read.where("_p._e IS NOT NULL").select("*", F.col("_p._h.subject").alias("subject"), F.col("_p._h.curriculum_hint").alias("curriculum_hint"), "_p._e.*").drop("_h", "_e", "_p", "subject_hits", "text")
    return rows.withColumn("evidence_score", T.evidence_score(F.col("marker_counts"), F.size("action_tags"), F.col("extract_status"), rules))


def strict_records(evidence: DataFrame, rules: RulePack = PLANS_KO) -> tuple[DataFrame, DataFrame]:
    """Records with strong subject evidence, the best of each source and subject; and the counts of those rejected."""
    found = T.evidence_strength(F.col("subject"), F.col("source.match_type"), F.col("source.subject_canonical"), F.col("evidence_text"), rules)
    graded = evidence.withColumn("_s", found).withColumn("subject_evidence_strength", F.col("_s.strength")).withColumn("subject_evidence_reasons", F.col("_s.reasons")).drop("_s")
    graded = graded.withColumn("review_score", F.col("evidence_score") + 3 * F.col("subject_evidence_strength"))
    graded = graded.withColumn("reject", search.first_reason(("weak_subject_evidence", F.col("subject_evidence_strength") < 4), ("no_performance_assessment_marker", F.col("marker_counts.performance_assessment") == 0)))
    key = T.first_filled(F.col("sha256"), F.col("source.saved_path"), F.col("source.source_url"))
    kept = dedupe.keep_best(graded.where("reject IS NULL").withColumn("_key", key), ["_key", "curriculum_hint", "subject"], "review_score", "seq")
    return kept.drop("_key", "reject"), graded.where("reject IS NOT NULL").groupBy("reject").agg(F.count("*").alias("records"))


def shortlist(strict: DataFrame, n: int = 25) -> DataFrame:
    """The best records of each subject, one for a school at most."""
    return dedupe.diverse_top(strict.withColumn("school", T.first_filled(F.col("source.school_code"), F.col("source.school_name"))), ["curriculum_hint", "subject"], "school", "review_score", "seq", n)


def catalog(strict: DataFrame, rules: RulePack = PLANS_KO) -> DataFrame:
    """Strict records with years, grades and semesters of the name (years else of the text's first 3,000 characters) and the resolved curriculum."""
    name = F.coalesce("source.candidate_name", F.lit(""))
    of_name = T.years(name)
    dated = strict.withColumn("academic_years", F.when(F.size(of_name) > 0, of_name).otherwise(T.years(F.left("evidence_text", F.lit(3000))))).withColumn("grades", T.grades(name)).withColumn("semesters", T.semesters(name))
    return dated.withColumn("_c", T.resolve_curriculum(F.col("subject"), F.col("curriculum_hint"), F.col("academic_years"), F.col("grades"), rules)).select("*", "_c.*").drop("_c")


def coverage(schools: DataFrame, found: DataFrame, explicit: DataFrame, statuses: DataFrame, rules: RulePack = PLANS_KO) -> DataFrame:
    """Every school with every subject and a coverage status.

    ``found`` is the catalog with ``school_code``; ``explicit`` has (school_code,
    subject, source_key) of files named after a subject; ``statuses`` has
    (school_code, source_key, status) of all extracted files.
    """
    direct = found.where("resolved_curriculum <> 'shared'").groupBy("school_code", F.col("resolved_curriculum").alias("curriculum"), "subject").agg(F.count("*").alias("found_documents"))
    ambiguous = found.where("resolved_curriculum = 'shared'").groupBy("school_code", "subject").agg(F.count("*").alias("ambiguous_curriculum_documents"))
    known = explicit.join(statuses.select("source_key", "status"), "source_key", "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    named = known.groupBy("school_code", "subject").agg(F.count("*").alias("explicit_subject_documents"), F.count_if(F.col("status").isin("failed", "short", "missing", "unknown")).alias("explicit_subject_incomplete"))
    by_school = statuses.groupBy("school_code").agg(*(F.count_if(F.col("status") == s).alias(f"school_extracted_{s}") for s in ("ok", "short", "failed")))
    shared = [s for _, s in rules.groups() if len(rules.buckets(s)) > 1]
    matrix = joins.dense(schools, rules.groups(), ["curriculum", "subject"], [direct], ["school_code", "curriculum", "subject"])
    for part, on in ((ambiguous, ["school_code", "subject"]), (named, ["school_code", "subject"]), (by_school, ["school_code"])):
        matrix = matrix.join(part, on, "left").fillna(0, [c for c in part.columns if c not in on])
    matrix = matrix.withColumn("ambiguous_curriculum_documents", F.when(F.col("subject").isin(*shared), F.col("ambiguous_curriculum_documents")).otherwise(0))
    status = (
        F.when(F.col("found_documents") > 0, "found").when(F.col("ambiguous_curriculum_documents") > 0, "found_curriculum_ambiguous").when(F.col("explicit_subject_incomplete") > 0, "extraction_failed")
        .when(F.col("school_extracted_ok") > 0, "not_found_in_collected_plans").otherwise("offering_unknown")
    )
    return matrix.withColumn("coverage_status", status)


def trends(catalog_rows: DataFrame, rules: RulePack = PLANS_KO) -> DataFrame:
    """Rollup of every configured (curriculum, subject), zero-filled."""
    rows = catalog_rows.withColumn("school", T.first_filled(F.col("source.school_code"), F.col("source.school_name"))).withColumn("curriculum", F.col("resolved_curriculum"))
    for name in rules.markers:
        rows = rows.withColumn(name, F.col(f"marker_counts.{name}"))
    group = ["curriculum", "subject"]
    base = aggregates.trend(rows, group, "school", "review_score", [m for m in rules.markers if m != "performance_assessment"])
    grades = rows.groupBy(*group).agg(*(F.count_if(F.array_contains("grades", g)).alias(f"grade{g}_documents") for g in (1, 2, 3)), F.array_sort(F.array_distinct(F.flatten(F.collect_set("academic_years")))).alias("academic_years"), F.sum(F.size("task_names")).alias("task_name_candidates"))
    expected = catalog_rows.sparkSession.createDataFrame(rules.groups(), "curriculum string, subject string")
    return joins.expected_groups(expected, base.join(grades, group), group)
