"""Text functions and the evidence pipeline on small inputs of our own."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidencelake.functions import text as T
from evidencelake.functions.evidence import Document, Patterns, action_tags, read, representatives, task_bounds, task_names, windows
from evidencelake.plans import evidence as E
from evidencelake.rules import DRIVER, JUMP, PLANS_KO


def one(spark, value, **columns):
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} string" for k in columns))
    return df.select(value.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("통합과학1 평가", {"통합과학1"}), ("통합과학 평가", {"통합과학"}), ("생명과학 1학기", {"생명과학"}), ("생명과학II 계획", {"생명과학Ⅱ"}), ("생명과학I 계획", {"생명과학Ⅰ"}),
        ("생명과학2", {"생명과학Ⅱ"}), ("고급 생명과학", {"고급생명과학"}), ("생명과학 실험", {"생명과학실험"}), ("과학탐구실험 1학기", {"과학탐구실험"}), ("물리학", set()),
    ],
)
def test_subject_hits(spark, text, expected):
    assert {h["subject"] for h in one(spark, T.subject_hits(F.col("t")), t=text)} == expected


@pytest.mark.parametrize("name, subject", [("2024 생명과학I 계획.hwp", "생명과학Ⅰ"), ("생명과학II.pdf", "생명과학Ⅱ"), ("통합과학2.pdf", "과학"), ("국어.pdf", "unknown"), ("고급생명과학.hwp", "고급생명과학")])
def test_classify(spark, name, subject):
    assert one(spark, T.classify(F.col("t")), t=name)["subject_canonical"] == subject


def test_mask(spark):
    masked = one(spark, T.mask_sensitive(F.col("t")), t="메일 kim.a@school.kr 전화 010-1234-5678 번호 900101-1234567 끝")
    assert masked == "메일 [이메일] 전화 [전화번호] 번호 [식별번호] 끝"
    assert one(spark, T.leaks_identity(F.col("t")), t="010-1234-5678") and not one(spark, T.leaks_identity(F.col("t")), t="02-123-4567")


def test_numbers(spark):
    v = one(spark, F.struct(T.years(F.col("t")), T.grades(F.col("t")), T.semesters(F.col("t"))), t="2025학년도 2학년 1학기 2024 학년도 고3 2019학년도")
    assert tuple(v) == ([2024, 2025], [2, 3], [1])


@pytest.mark.parametrize("subject, hint, years, grades, expected", [("생명과학Ⅰ", "", [], [], ("2015", "subject_unique_to_curriculum")), ("없음", "2015", [], [], ("shared", "curriculum_unresolved")), ("없음", "", [2025], [1], ("2022", "transition_year_and_grade")), ("없음", "", [2026], [1, 3], ("shared", "curriculum_unresolved")), ("없음", "", [2024], [], ("2015", "transition_year_and_grade"))])
def test_resolve(spark, subject, hint, years, grades, expected):
    df = spark.createDataFrame([(subject, hint, years, grades)], "s string, h string, y array<int>, g array<int>")
    assert tuple(df.select(T.resolve_curriculum(F.col("s"), F.col("h"), F.col("y"), F.col("g")).alias("v")).first()["v"]) == expected


def test_candidate(spark):
    assert one(spark, T.curriculum_candidate(F.col("u"), F.col("n")), u="x?JG_YEAR=2024&y=2026", n="계획.hwp") == "2015_candidate"
    assert one(spark, T.curriculum_candidate(F.col("u"), F.col("n")), u="x?JG_YEAR=2024", n="2025 계획.hwp") == "2022_candidate"
    assert one(spark, T.curriculum_candidate(F.col("u"), F.col("n")), u="", n="계획") == "unknown"


def test_windows():
    text = "".join(chr(97 + i % 26) for i in range(5000))
    at = lambda *places: np.array(places, np.int64)
    assert windows(text, at(100, 200), 50, 12000) == text[50:250]
    assert windows(text, at(100, 280), 50, 12000) == text[50:330] and windows(text, at(100, 281), 50, 12000) == text[50:150] + JUMP + text[231:331]
    assert windows(text, at(100, 2000), 50, 12000) == text[50:150] + JUMP + text[1950:2050]
    assert len(windows(text, at(2500), 2000, 100)) == 100 and windows(text, at(100, 2000, 4000), 50, 150) == text[50:150] + JUMP + text[1950:2000]
    assert windows(text, at()) == "" and windows("", at(0)) == ""
    assert representatives(np.arange(12)).tolist() == [0, 1, 4, 6, 8, 11] and representatives(np.arange(6)).tolist() == list(range(6))


def test_places():
    patterns = Patterns(PLANS_KO)
    far = "x" * 10_000
    place = lambda text, subject="생명과학": Document(text, patterns).place(subject)
    assert place("생명과학 하나 생명과학 둘") == 0 and place("물리학") is None and place("생명과학", "없음") is None
    assert place("생명과학 " + far + "\n생명과학 수행평가") == 10_006  # anchors near
    assert place("생명과학 수행평가 배점\n" + far + "\n  ## 생명과학") == len("생명과학 수행평가 배점\n" + far + "\n  ## ")  # a labelled line
    head = "2025학년도 교수·학습 및 평가 계획\n"
    document = Document(head + "생명과학\n" + head + "끝", patterns)
    assert document.section(document.place("생명과학")) == (0, len(head) + 5, "course_header")
    assert Document(far, patterns).section(9_000) == (5_500, 10_000, "bounded_window")
    section = "서문\n가. 수행평가 세부 계획\n내용\n3. 결시 처리\n뒤"
    assert section[slice(*task_bounds(section, patterns)[:2])] == "가. 수행평가 세부 계획\n내용\n"
    assert task_bounds("서문\n평가영역 및 반영비율\n표", patterns) == (0, 16, "assessment_table_heading") and task_bounds("a", patterns) == (0, 1, "full_subject_section")


def test_action_tags():
    patterns = Patterns(PLANS_KO)
    assert action_tags("수행평가 방법: □ 프로젝트 ☑ 발표", patterns, True) == ["발표"]
    assert action_tags("☑\n토론", patterns, False) == [] and action_tags("토론", patterns, True) == ["토론"]
    assert action_tags("토론 " + "x" * 310 + " 수행평가", patterns, False) == ["토론"] and action_tags("토론 " + "x" * 330 + " 수행평가", patterns, False) == []
    assert task_names("가. 세포 관찰\n나) 결시 처리\n다. 유전  탐구 #", patterns) == ["세포 관찰", "유전 탐구"]


def test_pipeline(spark):
    plan = "# 2025학년도 1학기 교수·학습 및 평가 계획\n과목명: 생명과학Ⅰ\n## 수행평가 세부 계획\n가. 세포 탐구 보고서\n평가 방법: ☑ 발표 □ 토론\n채점 기준 배점 성취기준 [12생과Ⅰ01-01]\n"
    source = "struct<saved_path:string,final_url:string,source_url:string,school_code:string,school_name:string,candidate_name:string,match_type:string,subject_canonical:string>"
    rows = [
        (1, ("a", "", "", "S1", "가고", "2025학년도 생명과학Ⅰ 1학년.hwp", "filename_alias", "생명과학Ⅰ"), "sha1", "ok", 100, plan, []),
        (2, ("b", "", "", "S1", "가고", "사본.hwp", "needs_text_scan", "unknown"), "sha1", "ok", 100, plan, []),
        (3, ("c", "", "", "S2", "나고", "x.hwp", "needs_text_scan", "unknown"), "sha3", "ok", 100, "통합과학 이야기", []),
        (4, ("d", "", "", "S3", "다고", "x.hwp", "needs_text_scan", "unknown"), "sha4", "short", 0, None, None),
    ]
    docs = spark.createDataFrame(rows, f"seq long, source {source}, sha256 string, extract_status string, char_count long, text string, subject_hits array<struct<subject:string,curriculum_hint:string>>")
    evidence = E.evidence_records(docs)
    assert {(r["seq"], r["subject"]) for r in evidence.collect()} == {(1, "생명과학Ⅰ"), (2, "생명과학Ⅰ"), (3, "통합과학")}
    first = evidence.where("seq = 1").first()
    assert first["section_method"] == "course_header" and first["task_method"] == "performance_detail_heading"
    assert first["task_names"] == ["세포 탐구 보고서"] and first["action_tags"] == ["탐구", "발표", "보고서"]
    strict, rejected = E.strict_records(evidence)
    assert [(r["seq"], r["subject_evidence_strength"]) for r in strict.collect()] == [(1, 14)]
    assert {r["reject"]: r["records"] for r in rejected.collect()} == {"weak_subject_evidence": 1}
    catalog = E.catalog(strict)
    row = catalog.first()
    assert (row["resolved_curriculum"], row["academic_years"], row["grades"]) == ("2015", [2025], [1])
    schools = spark.createDataFrame([("S1",), ("S2",), ("S3",), ("S4",)], "school_code string")
    statuses = spark.createDataFrame([("S1", "a", "ok"), ("S2", "c", "ok"), ("S3", "d", "short")], "school_code string, source_key string, status string")
    explicit = spark.createDataFrame([("S1", "생명과학Ⅰ", "a"), ("S3", "통합과학", "d")], "school_code string, subject string, source_key string")
    matrix = E.coverage(schools, catalog.withColumn("school_code", F.col("source.school_code")), explicit, statuses)
    assert matrix.count() == 4 * 9
    got = {(r["school_code"], r["subject"]): r["coverage_status"] for r in matrix.collect()}
    assert got["S1", "생명과학Ⅰ"] == "found" and got["S2", "통합과학"] == "not_found_in_collected_plans"
    assert got["S3", "통합과학"] == "extraction_failed" and got["S4", "생명과학"] == "offering_unknown"
    trends = {r["subject"]: r for r in E.trends(catalog).collect()}
    assert len(trends) == 9 and trends["생명과학Ⅰ"]["documents"] == 1 and trends["통합과학"]["documents"] == 0


def test_manifest(spark):
    rows = [(1, "downloaded", "", "", "p1", "u", "", "2025 생명과학.hwp"), (2, "downloaded", "4-가", "attachment", "p1", "u", "", "또.hwp"), (3, "failed", "", "", "p2", "u", "", "x"), (4, "downloaded", "1", "", "p3", "u", "", "x"), (5, "downloaded", None, None, "", "", "", "통합과학.pdf")]
    log = spark.createDataFrame(rows, "seq long, result string, item_no string, record_type string, saved_path string, final_url string, source_url string, candidate_name string")
    got = {r["seq"]: (r["subject_canonical"], r["curriculum_candidate"]) for r in E.manifest(log).collect()}
    assert got == {1: ("생명과학", "2022_candidate"), 5: ("통합과학", "unknown")}


def test_only_texts_with_a_sign_are_searched_for_its_mask(spark):
    texts = ["a.b@c.kr", "b@c", "@", "word 010-1234-5678", "x@y.kr9z@w.kr", "", None]
    for rules in (PLANS_KO, DRIVER):
        plain = replace(rules, mask_signs={})
        rows = spark.createDataFrame([(t,) for t in texts], "t string").select(T.mask_sensitive(F.col("t"), rules).alias("a"), T.mask_sensitive(F.col("t"), plain).alias("b")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows] and rows[0]["a"] == rules.masks[0][1] and rows[-1]["a"] is None
        plan = spark.range(1).select(T.mask_sensitive(F.col("id").cast("string"), rules).alias("m"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(rules.masks[0][1]) == 1 and "CASE WHEN Contains(" in plan


def test_a_label_counts_on_its_own_line():
    patterns = Patterns(PLANS_KO)
    place = lambda text, subject="생명과학": Document(text, patterns).place(subject)
    assert place("생명과학\n생명과학\n과목 생명과학 생명과학") == 13 and place("#\n생명과학 a\n \n ## 생명과학") == 15  # the first on a labelled line
    assert place("# 가\n생명\n과학 배점\n교과 생명과학\n") == 16 and place("# 생명\n과학\n교과 생명과학") == 2  # one that goes over two lines has both
    assert action_tags("☑\n발표 ☑ 토론", patterns, True) == ["발표", "토론"] and action_tags("수행평가 □\n발표 □ 토론", patterns, False) == ["발표"]


def test_few_places_and_tags_are_not_read_through_arrays(monkeypatch):
    """A call on an array of a few numbers costs more than the pattern that found them."""
    calls = []
    for name in ("unique", "lexsort", "searchsorted", "concatenate", "stack"):
        monkeypatch.setattr(np, name, lambda *a, name=name, f=getattr(np, name), **k: (calls.append(name), f(*a, **k))[1])
    found = read(Document("생명과학 수행평가 배점 발표 토론 □ 제작 ☑ 실험\n" * 3, Patterns(PLANS_KO)), "생명과학")
    assert not calls and found["action_tags"] == ["발표", "토론", "실험"] and found["marker_counts"]["performance_assessment"] == 3
