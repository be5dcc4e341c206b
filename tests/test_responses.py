"""Response rows: names, nesting, what is blank, what is unknown."""

from pyspark.sql import functions as F

from evidencelake.plans import responses as R
from evidencelake.plans import serve


def test_cases(spark):
    schema = "case_id string, curriculum string, title string, title_basis string, subject_alignment string, overview string, excerpt string, weight string, standards string, criteria array<string>, academic_years string, methods array<string>, task_names array<string>, review_score double, rubric_marker_count int"
    rows = [
        ("a", "shared", " <b>효소</b>  실험 ", "source_detail", "expected", "세포를 <i>본다</i>", "가\n나", "0%", '["s1"]', ["c"], '["2024", 2025, "x", null]', ["□ 서술 ☑ 실험"], ["<b>가</b>"], 7.9, 3),
        ("b", "2022", "이름", "source_detail_bundle_review", "other", "본다", "나", "20%", '["s1"]', ["c"], "broken", None, ["가"], None, None),
        ("c", None, None, None, None, "매우 미흡한 경우", None, None, None, None, None, None, None, 1.0, 0),
    ]
    got = {r["case_id"]: r.asDict(recursive=True) for r in R.case_rows(spark.createDataFrame(rows, schema)).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert a["primary_task_name"] == "효소 실험" and a["task_names"] == ["가"] and a["academic_years"] == [2024, 2025] and a["curriculum_ambiguous"]
    assert a["assessment_structure"] == {"overview": "세포를 본다", "methods": ["실험"], "weight": "", "standards": ["s1"], "criteria": ["c"], "basis": "source_detail"}
    assert a["evidence_markers"] == {"rubric": 3, "achievement_standard": 0, "weight_or_points": 0, "assessment_method": 0} and a["evidence_score"] == 7 and a["evidence_excerpt"] == "가 나"
    assert b["primary_task_name"] == serve.BUNDLE_TITLE and b["task_names"] == [] and b["evidence_excerpt"] == "" and b["academic_years"] == []
    assert b["assessment_structure"]["standards"] == [] and b["assessment_structure"]["criteria"] == [] and b["assessment_structure"]["overview"] == "" and b["assessment_structure"]["weight"] == "20%"
    assert c["assessment_structure"]["overview"] == "" and c["primary_task_name"] == "" and c["curriculum"] == "" and not c["curriculum_ambiguous"] and c["priority_signals"] == []


def test_items(spark):
    rows = [("c-1", 1, "bounded", "<p>x</p>", "☑ 실험 □ 서술 ☑ 발표", '["a"]'), ("c-2", 2, "bundle_review", "<p>x</p>", None, None), ("c-3", 3, "bounded", "", "□ 서술", "[]")]
    got = {r["item_id"]: r for r in R.item_rows(spark.createDataFrame(rows, "item_id string, item_order int, extraction_status string, rubric_html string, method string, standards string")).collect()}
    assert (got["c-1"]["method"], got["c-1"]["standards"], got["c-1"]["has_rubric"], got["c-1"]["order"]) == ("실험 · 발표", ["a"], True, 1)
    assert not got["c-2"]["has_rubric"] and not got["c-2"]["source_available"] and got["c-2"]["method"] == ""
    assert not got["c-3"]["has_rubric"] and got["c-3"]["source_available"] and got["c-3"]["method"] == ""


def test_trends_and_subjects(spark):
    stats = spark.createDataFrame([("2015", "a", 3, None, 5, "[2024]", None, 2), ("shared", "b", None, 1, 0, None, 1.5, None)], "curriculum string, subject string, documents int, schools int, grade2_documents int, academic_years string, median_review_score double, coverage_found int")
    kind = "array<struct<tag:string,document_count:bigint>>"
    rows = {r["subject"]: r.asDict(recursive=True) for r in R.trend_rows(stats.withColumn("action_tags", F.when(F.col("subject") == "a", F.array(F.struct(F.lit("t").alias("tag"), F.lit(4).cast("long").alias("document_count")))).otherwise(F.lit(None).cast(kind)))).collect()}
    assert rows["a"]["grade_documents"] == {"1": 0, "2": 5, "3": 0} and rows["a"]["action_tags"] == [{"tag": "t", "document_count": 4}] and rows["a"]["academic_years"] == [2024]
    assert rows["a"]["median_evidence_score"] is None and rows["b"]["median_evidence_score"] == 1.5 and rows["b"]["action_tags"] == []
    assert rows["a"]["coverage"]["found"] == 2 and rows["b"]["coverage"]["found"] is None and rows["a"]["coverage"]["extraction_failed"] is None
    plain = {r["subject"]: r for r in R.subject_rows(stats).collect()}
    assert plain["b"]["curriculum_ambiguous"] and plain["b"]["documents"] == 0 and plain["a"]["schools"] == 0 and R.subject_rows(stats.limit(0)).count() == 0


def test_panel(spark):
    meta = spark.createDataFrame([(1234567, None, 0)], "cases long, schools long, items long")
    got = [(r["label"], r["value"]) for r in R.metric_panel(meta).orderBy("pos").collect()]
    assert got == [("공개계획 확인 대상", "—"), ("수집 정규화 사례", "1,234,567건"), ("공개 확정 학교", "—"), ("공개 확정 사례", "—"), ("공개 수행평가", "0건")]
    assert [r["value"] for r in R.metric_panel(meta, R.HERO).orderBy("pos").collect()] == ["—", "0", "—"]


def test_plain_text(spark):
    from evidencelake.functions import text as T

    cases = {"효<b>소</b> 실험": "효소 실험", "가<br/>나<TD x='1'>다</TD>라": "가 나 다라", "a &lt; b": "a &lt; b", "a<p>&lt;b&gt; &amp;lt; &middot;": "a <b> &lt; ·", "1 < 2 <!-- x\n<b> -->둘<i>": "1 < 2 둘", "<thead>머리<tbody>몸": "머리몸", "": ""}
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "t string")
    assert {r["t"]: r["p"] for r in df.select("t", T.plain_text(F.col("t")).alias("p")).collect()} == cases | {None: None}
