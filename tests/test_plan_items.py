"""Headings, titles and items of plan tables on texts of our own."""

import pytest
from pyspark.sql import functions as F

from evidencelake import plan_words as W
from evidencelake.functions import headings as H
from evidencelake.functions import sections
from evidencelake.operators import plan_tables as P


def grid(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td{c[1] if isinstance(c, tuple) else ''}>{c[0] if isinstance(c, tuple) else c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


#: A heading that each structural pattern catches, and one like it that none does.
STRUCTURE = [
    ("평가 개요", "평가 개요 발표하기"), ("성취기준: [12생과Ⅰ01-01]", "성취기준을 담은 포스터 제작"), ("학기 단위 성취수준 설정 방법", "성취수준 알리기 캠페인"), ("기타 사항", "기타 줄의 진동 실험"),
    ("[12생과Ⅰ01-01] ~ 02", "12종 생물 관찰"), ("성취 기준 및 성취 수준", "성취 일지 쓰기"), ("신체 장애 학생 평가", "신체 모형 제작"), ("실시 시기 및 횟수", "실시간 관찰"), ("질병 결석", "질병 조사 보고서"),
    ("인공지능 도구의 활용 금지", "인공지능 모형 설계"), ("교과협의회 결정", "교과서 속 실험"), ("평소 수업 활동이 자연스럽게 평가로 이어지도록", "평소 수업 일지"), ("전입생이 온 때", "전해질 실험"), ("최하 3점부터", "최하층 토양 조사"),
    ("과제 제출 금지", "과제 연구 보고서"), ("탐구를 수행하였는가?", "탐구를 수행하다 만난 생물 관찰"), ("점수를 함께 부여할 수 있다", "점수판 제작"),
]


def test_each_structural_pattern(spark):
    assert len(STRUCTURE) == len(W.STRUCTURAL_PATTERNS)
    rows = spark.createDataFrame(STRUCTURE, "yes string, no string").select(*(H.is_structural(F.col(c), policy_prose=False).alias(c) for c in ("yes", "no"))).collect()
    assert [tuple(r) for r in rows] == [(True, False)] * len(STRUCTURE)
    for (kind, pattern), (yes, no) in zip(W.STRUCTURAL_PATTERNS, STRUCTURE, strict=True):
        if kind != "compact":
            one = spark.createDataFrame([(yes, no)], "yes string, no string").select(H.hits(F.col("yes"), kind, pattern), H.hits(F.col("no"), kind, pattern)).first()
            assert tuple(one) == (True, False), pattern


@pytest.mark.parametrize("heading, prose", [("평가는 교사가 공정하게 실시하여 채점한다.", True), ("탐구 일지 모음", False), ("성취수준에 미치지 못한 학생에게는 추가 과제를", True), ("학생의 논리적 의사소통 능력을 평가", True), ("Ⅰ. 생명의 역사 Ⅱ. 세포의 특성", True), ("Ⅰ. 과학의 본성 / 추적하기", False), ("이의 신청 기간", True), ("효모 탐구 (동점자 1순위)", False), ("수행평가 영역별 배점 및 채점 기준", True), ("세포 관찰", False), ("", False)])
def test_prose(spark, heading, prose):
    row = spark.createDataFrame([(heading,)], "t string").select(H.is_prose(F.col("t")).alias("p"), H.is_structural(F.col("t")).alias("s"), H.is_structural(F.col("t"), False).alias("off")).first()
    assert row["p"] == prose and (row["s"] or not prose) and not (row["off"] and heading in ("Ⅰ. 생명의 역사 Ⅱ. 세포의 특성", ""))


def test_fixed_names_are_structure(spark):
    df = spark.createDataFrame([(n,) for n in W.STRUCTURAL_NAMES], "t string").select(H.is_structural(F.col("t"), False).alias("s"))
    assert df.where("not s").count() == 0


CLEAN = [
    ("## 가. 세포 관찰 (20점)", "세포 관찰"), ("(3) 효소 실험 (15)", "효소 실험"), ("① 효소 (3)", "효소 (3)"), ("[과탐1]보고서 쓰기", "보고서 쓰기"), ("[세포 관찰]", "세포 관찰"), ("(세포 관찰)", "세포 관찰"), ("수행평가(2) - 유전", "유전"), ("유전 30 (점) (논술형)", "유전 (논술형)"),
    ("수행평가 세부 계획 가. 유전", "유전"), ("수행 평가 1: 유전", "유전"), ("평가영역 4 : 유전", "유전"), ("기준안 1) 수행평가명: 과제 연구", "과제 연구"), ("수행평가 세부기준 (1) 별의 진화", "별의 진화"), ("효모 (동점자 1순위)", "효모"), ("1순위 (반영 비율 20%): 유전", "유전"),
    ("[서·논술형] 유전", "유전"), ("유전 (평가 시기 5월)", "유전"), ("유전 (10점) : 설명한다", "유전"), ("유전 수행평가 기준", "유전"), ("유전 평가기준", "유전"), ("• 페임랩 발표하기", "페임랩 발표하기"), ("유전 1) 평가 요소: 참여", "유전"), ("평가 기준 수행평가 기준", "평가 기준"), ("- 유전 |", "유전"),
]


def test_cleaned_titles(spark):
    df = spark.createDataFrame(CLEAN, "raw string, want string").withColumn("c", H.cleaned(F.col("raw")))
    rows = df.select("raw", "want", "c.title", "c.title_raw", H.cleaned(F.col("c.title"))["title"].alias("again")).collect()
    for r in rows:
        assert (r["title"], r["title_raw"]) == (r["want"], r["raw"]) and r["again"] == r["title"], r
    assert spark.createDataFrame([(None,)], "t string").select(H.cleaned(F.col("t"))["title"]).first()[0] is None


@pytest.mark.parametrize("title, valid", [("세포 관찰 보고서", True), ("1차 고사", False), ("1차고사(30%)", False), ("서술형 평가", False), ("[12생과Ⅰ01-01] 설명", False), ("20 / 30점", False), ("미흡함", False), ("과학을 찾다", True), ("Ⅱ", False), ("반영 비율 20%", False), ("수행평가", False), ("가", False), ("단원 평가 결과 처리 상", False), ("세포를 관찰한다.", False)])
def test_plan_titles_valid(spark, title, valid):
    assert spark.createDataFrame([(title,)], "t string").select(H.is_plan_title(F.col("t"))).first()[0] == valid


def rows_of(spark, *texts, subject="생명과학Ⅰ"):
    return P.table_rows(spark.createDataFrame([(str(k), subject, t) for k, t in enumerate(texts)], "case_id string, subject string, text string"))


def test_answers_to_the_right(spark):
    """Spanned labels repeat over their columns; a header row answers nothing, an empty cell is passed over."""
    rows = rows_of(spark, grid(("과제명", "", "세포 관찰")), grid(("과제명", "반영비율"), ("세포 관찰", "20%")), grid((("과제명", ' rowspan="2"'), "세포 관찰"), ("성취기준",)), grid((("과제명", ' colspan="2"'), "세포 관찰")), grid(("평가내용", "과제명")))
    found = P.label_cells(rows).orderBy("case_id", "row_no", "col_no").collect()
    assert [(r["case_id"], r["row_no"], r["col_no"], r["answered"]) for r in found] == [("0", 0, 0, True), ("1", 0, 0, False), ("2", 0, 0, True), ("2", 1, 0, False), ("3", 0, 0, False), ("3", 0, 1, True), ("4", 0, 1, False)]


def test_titles_of_tables(spark):
    cases = {
        grid(("수행평가명", "세포 관찰 만점 20점")): "세포 관찰",
        grid(("평가영역", "수행평가"), ("수행과제", "유전 토론")): "유전 토론",
        grid(("채점", "과제명"), ("상", "효소 실험"), ("중", "효소  실험"), ("하", "평가방법")): "효소 실험",
        grid(("채점", "과제명"), ("상", "효소 실험"), ("중", "유전 조사")): None,
        grid(("영역(만점)", "평가요소", "채점기준"), ("", "x", "y"), ("광합성 탐구", "x", "y")): "광합성 탐구",
        grid(("영역(만점)", "평가요소", "비고"), ("광합성 탐구", "x", "y")): None,
        grid(("영역(만점)", "평가요소", "채점기준"), ("중간고사", "x", "y"), ("광합성 탐구", "x", "y")): None,
        grid(*[("x", "y")] * P.LABEL_ROWS, ("과제명", "세포 관찰")): None,
        "| 과제명 | 세포 관찰 |\n|---|---|\n| 성취기준 | x |": "세포 관찰",
    }
    got = {r["case_id"]: r["title"] for r in P.table_titles(rows_of(spark, *cases)).collect()}
    assert [got.get(str(k)) for k in range(len(cases))] == [*cases.values()]


@pytest.mark.parametrize("code, subject, alignment", [("[12생과Ⅰ01-01]", "생명과학Ⅰ", "expected"), ("[12생과Ⅰ01-01] [12생과Ⅱ01-01]", "생명과학Ⅰ", "other"), ("[12생과Ⅱ01-01]", "생명과학", "expected"), ("[12물리01-01]", "생명과학Ⅰ", "other"), ("[프로02-01]", "생명과학Ⅰ", "other"), ("[기본점수 - 4]", "생명과학Ⅰ", "unknown"), ("", "생명과학Ⅰ", "unknown"), ("[12생과Ⅰ01-01]", "물리", "unknown")])
def test_alignment_of_tables(spark, code, subject, alignment):
    assert P.table_facts(rows_of(spark, grid(("성취기준", code)), subject=subject)).first()["alignment"] == alignment


def test_local_tables_need_a_boundary_and_evidence(spark):
    table = grid(("수행과제", "세포 관찰"), ("평가방법", "발표", "☑ 실험", "반영비율", "20%"), ("평가시기", ""), ("배점", ""))
    plain = grid(("수행과제", "세포 관찰"), ("평가방법", "발표"))
    rows = rows_of(spark, "# 생명과학Ⅰ\n" + table, "생명과학Ⅰ 안내\n" + table, "# 생명과학Ⅰ\n" + plain, "# 생명과학Ⅰ\n" + grid(("수행과제", "세포 관찰"), ("성취기준", "[12물리01-01]"), ("배점", "3")), "# 생명과학Ⅰ\n글\n# 물리학\n" + table, "# 생명과학Ⅰ\n" + table + table, None)
    found = P.local_items(rows).orderBy("case_id").collect()
    assert [(r["case_id"], r["title"], r["method"], r["weight"]) for r in found] == [(k, "세포 관찰", "☑ 실험", "20%") for k in ("0", "4", "5")]
    assert P.local_items(rows.limit(0)).collect() == []


def test_hints(spark):
    rows = rows_of(spark, "# 생명과학Ⅰ\n" + grid(("활동", "배점", "평가요소"), ("• 세포 관찰 보고서 쓰기", "1", "2")), "활동\n" + grid(("활동", "배점", "평가요소"), ("세포 관찰", "1", "2")))
    hints = spark.createDataFrame([("0", "세포관찰 보고서"), ("0", "세포 관찰보고서"), ("0", "관찰"), ("0", "채점 기준"), ("1", "세포 관찰"), ("9", "세포"), ("0", None), (None, "세포 관찰")], "case_id string, hint string")
    assert [(r["case_id"], r["title"]) for r in P.hinted_items(rows, hints).collect()] == [("0", "세포 관찰 보고서 쓰기")]


def test_plan_titles_and_union(spark):
    rows = rows_of(spark, "# 생명과학Ⅰ\n" + grid(("평가영역", "배점"), ("세포 관찰", "1"), ("세포  관찰", "2"), ("유전 토론", "3")) + grid(("수행평가명", "효소 실험", "유전토론")))
    assert P.plan_titles(rows).first()["titles"] == ["세포 관찰", "유전 토론", "효소 실험"]
    item = lambda title, at: ("0", title, title, "", at, 0, 0, "", "", "", "", "", [])
    schema = "case_id string, title string, title_raw string, label string, table_no int, start int, stop int, overview string, method string, timing string, weight string, score string, standards array<string>"
    parts = {name: spark.createDataFrame([item(t, k) for k, t in enumerate(titles)], schema) for name, titles in {"code": ["가나", "다라"], "table": ["다 라", "마바"], "local": ["마바", "사아"]}.items()}
    assert [(r["title"], r["provenance"]) for r in P.item_union(parts).orderBy("item_order").collect()] == [("다 라", "table"), ("마바", "table"), ("사아", "local"), ("가나", "code")]


def test_items_of_plans(spark):
    """Headings of structure are no items, their titles are cleaned, and what no table bounds stays one bundle with the only planned title."""
    plan = "# 생명과학Ⅰ\n## 수행평가 세부 계획\n가. 채점 기준 (20점)\n채점 기준과 배점, 평가 방법\n나. 수행평가 1: 세포 관찰 (20점)\n평가 방법과 반영 비율, 배점\n"
    single = "생명과학Ⅰ 수행평가\n" + grid(("단원", "평가내용"), ("세포", "유전 토론"))
    cases = spark.createDataFrame([("a", "생명과학Ⅰ", plan), ("b", "생명과학Ⅰ", single), ("c", "생명과학Ⅰ", None), ("d", None, "x")], "case_id string, subject string, text string")
    found = P.plan_items(cases).orderBy("case_id", "item_order").collect()
    assert [(r["case_id"], r["title"], r["title_raw"], r["provenance"]) for r in found] == [("a", "세포 관찰", "수행평가 1: 세포 관찰", "heading"), ("b", "유전 토론", "유전 토론", "bundle")]


def test_archive_members():
    text = "[zip:1학년/고급생명과학 평가계획.hwp][ok]\n고급 본문\n[zip:2학년/생명과학 평가계획.hwp][ok]\n# 생명과학\n본문\n[zip:영어 평가계획.hwp][short]\nEnglish"
    start, stop, status = sections.subject_span(text, "생명과학")
    assert status == "zip_member_subject" and text[start:stop].startswith("[zip:2학년") and text[start:stop].rstrip().endswith("본문") and "English" not in text[start:stop]
    assert sections.subject_part(text, "고급생명과학")[0].rstrip().endswith("고급 본문")
    assert sections.member_span("[zip:생명과학.hwp][ok]\nx", "생명과학") is None and sections.member_span("", "") is None
