"""The section parser on plans of our own."""

import pytest

from evidencelake.functions import sections as S
from evidencelake.rules import JUMP

HEAD = "# 생명과학Ⅰ\n## 수행평가 세부 계획\n"
TABLE = "| 평가영역 | 평가방법 | 반영비율 | 배점 | 성취기준 |\n|---|---|---|---|---|\n| 세포 관찰 보고서 | 보고서 | 20% | 20점 | [12생과Ⅰ01-01] |\n| 유전 모형 제작 | 제작 | 30% | 30점 | [12생과Ⅰ03-02] |\n"


def test_summary_table():
    got = S.parse_section(HEAD + TABLE, "생명과학Ⅰ")
    assert got.boundary_status == "subject_heading_exact:assessment_anchor"
    assert [(i.title, i.extraction_status, i.title_basis, i.weight, i.score, i.standards) for i in got.items] == [("세포 관찰 보고서", "bounded", "table", "20%", "20점", ("[12생과Ⅰ01-01]",)), ("유전 모형 제작", "bounded", "table", "30%", "30점", ("[12생과Ⅰ03-02]",))]
    assert "유전" not in got.items[0].source_html  # rows stay apart


def test_rubric():
    rubric = "\n| 평가영역 | 채점기준 | 배점 |\n|---|---|---|\n| 세포 관찰 보고서 | 세 가지를 쓴다 | 10 |\n| 유전 모형 제작 | 구조가 맞다 | 10 |\n"
    got = S.parse_section(HEAD + TABLE + rubric, "생명과학Ⅰ")
    assert len(got.items) == 2 and "세 가지를 쓴다" in got.items[0].rubric_html and "구조가 맞다" not in got.items[0].rubric_html


def test_foreign_row_is_dropped():
    html = "<table><tr><th>과제명</th><th>평가방법</th><th>성취기준</th></tr><tr><td>세포 실험</td><td>실험</td><td>[12생과Ⅰ01-01]</td></tr><tr><td>시 감상문</td><td>서술</td><td>[12국어02-01]</td></tr></table>"
    assert [i.title for i in S.parse_section(HEAD + html, "생명과학Ⅰ").items] == ["세포 실험"]


def test_matrix():
    html = "<table><tr><td>구분</td><td>지필평가</td><td>수행평가</td><td>수행평가</td></tr><tr><td>영역명</td><td>1차</td><td>효소 탐구</td><td>생태 발표</td></tr><tr><td>반영비율</td><td>60%</td><td>20%</td><td>20%</td></tr><tr><td>평가방법</td><td>선택형</td><td>실험</td><td>발표</td></tr></table>"
    assert [(i.title, i.weight, i.method) for i in S.parse_section(HEAD + html, "생명과학Ⅰ").items] == [("효소 탐구", "20%", "실험"), ("생태 발표", "20%", "발표")]


def test_headings():
    text = HEAD + "가. 세포 탐구 보고서 (30점)\n| 평가방법 | 보고서 | 반영비율 | 30% |\n|---|---|---|---|\n| 평가내용 | 세포를 관찰한다 | 평가시기 | 5월 |\n나. 결시 처리\n내용\n"
    items = S.parse_section(text, "생명과학Ⅰ").items
    assert [(i.title, i.title_basis, i.score, i.method, i.timing) for i in items] == [("세포 탐구 보고서", "heading", "30점", "보고서", "5월")]


def test_bundle_and_errors():
    got = S.parse_section("생명과학Ⅰ 수업에서 수행평가를 한다", "생명과학Ⅰ")
    assert got.boundary_status == "subject_mention_only:assessment_anchor_not_found" and [i.extraction_status for i in got.items] == ["bundle_review"]
    assert S.parse_section("물리", "생명과학Ⅰ").items == ()
    with pytest.raises(ValueError):
        S.parse_section("a" + JUMP + "b", "생명과학Ⅰ")


def test_over_frames(spark):
    cases = spark.createDataFrame([("c1", "생명과학Ⅰ", HEAD + TABLE), ("c2", "생명과학Ⅰ", "a" + JUMP + "b"), ("c3", "생명과학Ⅰ", "생명과학Ⅰ 수행평가"), ("c4", None, None)], "case_id string, subject string, text string")
    items = S.parsed_items(cases)
    assert sorted(r["item_id"] for r in items.collect()) == ["c1-1", "c1-2", "c3-1"]
    out = S.published_tables(cases, items)
    assert {r["case_id"]: r["title_basis"] for r in out["cases"].collect()} == {"c1": "source_detail", "c2": "catalog_only", "c3": "source_detail_bundle_review", "c4": "catalog_only"}
