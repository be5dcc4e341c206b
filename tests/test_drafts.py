"""Drafts as structures and text; attachments of pages."""

from evidencelake.operators import client as C
from evidencelake.operators import drafts as D

PATTERNS = "pattern string, label string, product string, method_phrase string, phases array<struct<title:string,evidence:string>>, criteria array<struct<label:string,weight:int,focus:string>>"
DESIGNS = "design_id int, pattern string, topic string, subject string, curriculum string, grade int, semester int, lessons int, points int, collaboration string, ai_policy string"


def test_drafts(spark):
    patterns = spark.createDataFrame([("p", "탐구", "보고서", "탐구합니다", [("설계", "계획서"), ("수행", "기록")], [("가", 50, "f1"), ("나", 30, "f2"), ("다", 20, "f3")])], PATTERNS)
    rows = [(1, "p", " 효소 ", "생명과학", "2022", 2, 1, 5, 33, "모둠", D.NO_AI), (2, "p", None, "생명과학", "2022", 2, 1, 1, 10, "개별", "허용"), (3, "?", "x", "s", "c", 1, 1, 1, 1, "", "")]
    made = D.drafts(spark.createDataFrame(rows, DESIGNS), patterns)
    got = {r["design_id"]: r for r in made.collect()}
    assert sorted(got) == [1, 2] and got[1]["title"] == "효소 — 탐구" and got[2]["title"] == f"{D.NO_TOPIC} — 탐구"
    assert [(r["label"], r["points"]) for r in got[1]["rubric"]] == [("가", 17), ("나", 10), ("다", 6)] and sum(r["points"] for r in got[2]["rubric"]) == 10
    assert [p["lesson"] for p in got[1]["lesson_plan"]] == ["1–2차시", "3–5차시"] and [p["lesson"] for p in got[2]["lesson_plan"]] == ["1차시", "1차시"]
    assert got[1]["ai_guidance"] == D.GUIDANCE[D.NO_AI] and got[2]["ai_guidance"] == D.OTHER_GUIDANCE and "모둠 활동에서도" in got[1]["fairness_checklist"][1]
    text = {r["design_id"]: r["text"] for r in D.as_text(made).collect()}[1]
    assert text.startswith("효소 — 탐구\n\n[기본 조건]\n- 2022 개정 생명과학\n- 2학년 1학기 · 5차시 · 모둠\n- 총 33점\n\n[연결 성취기준]\n교사 확인 후 입력\n\n[공식 원문 확인]\n")
    assert "[과정과 증거]\n- 1–2차시 설계: 계획서\n- 3–5차시 수행: 기록\n\n[루브릭 초안]\n- 가 (17점): f1\n" in text and text.count("\n\n[") == len(D.SECTIONS)


FORM = """<form><INPUT type="hidden" name="YEAR" value="2024"><input name='Q' value='a&amp;b'><input name="Q" value="last">
<a class="btn file_name x" onclick="getEiFile2('7'); return" href="#">계획 <b>안</b>.hwp (1,024 KB)</a><a class="file_name" href="#">없음</a><a class='file_name' onclick="getEiFile1('8')"> (3KB)</a>
<a href="/s/EiFileDownLoad.do?FILE_SEQ=7&amp;YEAR=2025">seen</a><a href="/s/EiFileDownLoad.do?FILE_SEQ=9&amp;YEAR=2025&amp;YEAR=2026&amp;E=&amp;N=%EA%B0%80+b">둘 &amp; 셋</a><a href="/s/EiFileDownLoad.do?FILE_SEQ=9">again</a><a href="/s/EiFileDownLoad.do">no query</a>
<a href='/s/EiFileDownLoad.do?X=1'></a></form>"""


def test_attachments(spark):
    pages = spark.createDataFrame([(1, FORM), (2, None), (3, ""), (4, '<input name="FILE_SEQ" value="5"><a href="EiFileDownLoad.do">five</a>')], "page_id int, html string")
    rows = C.attachments(pages, "page_id", "html", {"YEAR": "2000", "CODE": "c"}).orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"], r["seq"], r["name"]) for r in rows] == [(1, 0, "7", "계획 안 .hwp"), (1, 1, "8", "attachment_8"), (1, 2, "9", "둘 & 셋"), (1, 3, "5", "attachment_5"), (4, 0, "5", "five")]
    assert rows[0]["params"] == {"YEAR": "2024", "CODE": "c", "Q": "last", "FILE_SEQ": "7"}
    assert rows[2]["params"] == {"YEAR": "2026", "CODE": "c", "Q": "last", "FILE_SEQ": "9", "N": "가 b"} and rows[3]["params"]["X"] == "1"
    assert C.attachments(pages.limit(0), "page_id", "html").count() == 0
