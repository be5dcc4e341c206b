"""Names of tasks by place, in the subject's part of a text."""

import pytest
from pyspark.sql import functions as F

from evidencelake.operators import task_names as N


@pytest.mark.parametrize(
    ("text", "subject", "part"),
    [
        ("앞\n# 물리학 교수학습 및 평가 계획\nb\n## 생명과학Ⅰ 교수 학습 평가 운영\nc\n# 1) 과제\nd\n# 화학 교수학습 평가 계획\ne", "생명과학Ⅰ", "## 생명과학Ⅰ 교수 학습 평가 운영\nc\n# 1) 과제\nd"),
        ("앞\n# 물리학 교수학습 및 평가 계획\nb", "생명과학Ⅰ", "앞"),
        ("앞\n# 과제 이름\nb \n", "생명과학Ⅰ", "앞\n# 과제 이름\nb"),
        ("# 물리학 교수학습 평가 계획\nb", "", ""),
        ("# 생명과학 교수학습 평가 계획\na\n# 생명과학 교수학습 평가 운영\nb", "생명과학", "# 생명과학 교수학습 평가 계획\na\n# 생명과학 교수학습 평가 운영\nb"),
        ("", None, ""),
    ],
)
def test_subject_lines(spark, text, subject, part):
    df = spark.createDataFrame([(text, subject)], "t string, s string")
    assert df.select(N.subject_lines(F.col("t"), F.col("s"))).first()[0] == part


def test_derived_names(spark):
    across = "<table><tr><td>과제명</td><td>세포 관찰하기</td><td></td><td>효소 실험 보고서 쓰기</td><td>배점</td><td>토론하기 긴 이름 하나</td></tr></table>"
    down = "<table><tr><td>평가영역</td><td>배점</td></tr><tr><td>유전 모형 만들기</td><td>10</td></tr><tr><td>유전  모형 만들기</td><td>5</td></tr></table>"
    two = "<table><tr><td>평가영역</td></tr><tr><td>진화 발표하기</td></tr><tr><td>생태 조사하기</td></tr></table>"
    lines = "앞줄 설명하기\n수행평가명 | 호흡 측정하기 | 배점 | 3\n과제명 |  | 20\n# 제목\n"
    rows = [("a", None, across + down + two + lines, ["1. 호흡 측정하기"]), ("b", "생명과학", lines + "식물 그림 그리기\n호흡  측정하기", []), ("c", None, None, None), ("d", "x", across + across, None)]
    got = N.derived_names(spark.createDataFrame(rows, "id string, subject string, text string, seen array<string>")).orderBy("id", "rank").collect()
    names = {k: [(r["name"], r["source"]) for r in got if r["id"] == k] for k in "abcd"}
    assert names["a"] == [("효소 실험 보고서 쓰기", "table"), ("유전 모형 만들기", "table"), ("세포 관찰하기", "table")]
    assert names["b"][0] == ("호흡 측정하기", "context") and [s for _, s in names["b"][1:]] == ["section", "section"] and names["b"][1][0] == "식물 그림 그리기"
    assert names["c"] == [] and [n for n, _ in names["d"]] == ["효소 실험 보고서 쓰기", "세포 관찰하기"]
