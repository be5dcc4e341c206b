"""Operators over exploded grids."""

from pyspark.sql import functions as F

from evidencelake.functions import markup as M
from evidencelake.operators import grids as G

HTML = "<table><tr><td>수행평가명</td><td colspan='2'>1. 세포 관찰 보고서</td></tr><tr><td>평가방법</td><td>보고서</td><td>반영비율</td><td>20%</td></tr><tr><td>평가내용</td><td>현미경 [12생과Ⅰ01-01]</td></tr></table><table><tr><th>과제명</th><th>평가방법</th></tr><tr><td>유전 모형 만들기</td><td>제작</td></tr><tr><td>합계</td><td></td></tr></table>"


def grid(spark):
    return M.grid_rows(spark.createDataFrame([("a", HTML), ("b", ""), ("c", None)], "id string, html string"), "id", "html")


def test_labelled(spark):
    g = grid(spark)
    got = {(r["field"], r["value"]) for r in G.labelled_values(g).collect()}
    assert {("title", "1. 세포 관찰 보고서"), ("method", "보고서"), ("weight", "20%"), ("overview", "현미경 [12생과Ⅰ01-01]")} <= got
    assert {(r["field"], r["value"]) for r in G.column_values(g).where("table_no = 1").collect()} == {("title", "유전 모형 만들기"), ("method", "제작"), ("title", "합계")}
    row = G.structure(g).first()
    assert (row["overview"], row["method"], row["weight"], row["standards"]) == ("현미경 [12생과Ⅰ01-01]", "제작", "20%", "[12생과Ⅰ01-01]")


def test_names(spark):
    g = grid(spark)
    assert {r["name"] for r in G.task_names(g).collect()} == {"세포 관찰 보고서", "유전 모형 만들기"}
    assert [(r["candidate"], r["confidence"]) for r in G.recovery_candidates(g).collect()] == [("1. 세포 관찰 보고서", "supported")]


def test_flags(spark):
    df = spark.createDataFrame([("세포 관찰하기",), ("",), ("평가방법",), ("· 탐구 활동하기",), ("중간고사",), ("30점",)], "t string")
    assert [r[0] for r in df.select(G.title_flags(F.col("t"))).collect()][:3] == ["", "empty_title", "structural_heading|policy_prose|field_label_as_title"]
    items = spark.createDataFrame([("세포 탐구", "inquiry", 40, "bounded"), ("세포 탐구 3", "inquiry", 40, "bounded"), ("물리 탐구", "inquiry", 40, "bounded"), ("a\nb", "inquiry", 40, "bounded"), ("낮음", "inquiry", 1, "bounded")], "title string, category string, priority_score int, extraction_status string")
    assert [r["title"] for r in G.legacy_curated(items, "inquiry", ("물리",)).collect()] == ["세포 탐구"]
