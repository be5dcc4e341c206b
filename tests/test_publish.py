"""Published tables from parsed items: fan-out, statuses and derived case fields."""

from evidencelake.functions import sections as S
from evidencelake.plans import publish as P
from evidencelake.plans import serve

TOPICS = (("cell", ("세포", "효소")), ("genetics", ("유전",)))
ITEMS = "case_id string, item_id string, item_order int, title string, overview string, method string, weight string, score string, standards array<string>, extraction_status string, title_basis string, boundary_status string, section_char_count int, rubric_html string"


def item(case, order, title, overview="", method="", weight="", score="", standards=(), status="bounded", basis="table", rubric=""):
    return (case, f"{case}-{order}", order, title, overview, method, weight, score, None if standards is None else list(standards), status, basis, "x:y", 10, rubric)


ROWS = [
    item("a", 1, "수행평가 묶음", status="bundle_review", basis="unbounded_bundle"),
    item("a", 2, "세포 실험", " ", "☑ 발표", "", "10점", ["s2", "s1"]),
    item("a", 3, "유전 보고서", "첫 개요", "", "20%", "", ["s1", "s3"], rubric="<p>"),
    item("a", 4, "세포 실험", "둘째", "토의", "30%", "", None, basis="heading"),
    item("b", 1, "수행평가 묶음", status="bundle_review", basis="unbounded_bundle"),
    item("c", 1, " ", "개요", "토의"),
    item("d", 1, None, None, None, None, None, None, None, None),
]


def test_derived_and_refreshed(spark):
    items = spark.createDataFrame(ROWS, ITEMS)
    cases = spark.createDataFrame([("a", "alt", "b1"), ("b", "alt", "b2"), ("c", "alt", "b3"), ("z", None, None)], "case_id string, title string, extra string")
    got = {r["case_id"]: r for r in P.refreshed(cases, items).collect()}
    a = got["a"]
    assert (a["title"], a["task_names"], a["methods"], a["standards"], a["overview"], a["weight"], a["extra"]) == ("세포 실험", ["세포 실험", "유전 보고서"], ["☑ 발표", "토의"], ["s2", "s1", "s3"], "첫 개요", "20%", "b1")
    assert [got[k]["title"] for k in "bcz"] == ["alt", "alt", None] and got["c"]["task_names"] is None and len(got) == 4
    assert P.refreshed(cases, items.limit(0)).count() == 4 and P.derived(items.where("item_order = 2")).first()["weight"] == "10점"


def test_fan_out(spark):
    items = spark.createDataFrame(ROWS, ITEMS)
    scores = spark.createDataFrame([("a", 7.5)], "case_id string, review_score double")
    ranked = {r["item_id"]: r for r in P.ranked(items, scores, TOPICS).collect()}
    assert len(ranked) == len(ROWS) and (ranked["a-2"]["category"], ranked["a-2"]["topic"], ranked["a-2"]["priority_score"], ranked["a-2"]["priority_signals"]) == ("experiment", "cell", 7, ["성취기준", "배점", "평가방법"])
    assert ranked["a-3"]["priority_signals"] == ["채점기준", "성취기준", "배점", "평가 개요"] and ranked["b-1"]["priority_score"] == 0 and ranked["d-1"]["priority_signals"] == [] and ranked["d-1"]["ambiguous"]
    axes = {(r["item_id"], r["axis"], r["value"]) for r in P.axes(P.ranked(items, scores, TOPICS)).collect()}
    assert {("a-2", "method", "experiment"), ("a-2", "topic", "cell"), ("a-3", "method", "writing"), ("a-3", "topic", "genetics")} <= axes and not any(i == "d-1" for i, _, _ in axes)


def test_statuses(spark):
    cases = spark.createDataFrame([("a", "x/y.HWP"), ("b", None), ("q", "x.pdf")], "case_id string, saved_path string")
    got = {r["case_id"]: (r["source_format"], r["title_basis"]) for r in P.statuses(spark.createDataFrame(ROWS, ITEMS), cases).collect()}
    assert got == {"a": ("hwp", "source_detail"), "b": ("unknown", "source_detail_bundle_review"), "c": ("unknown", "source_detail"), "d": ("unknown", "source_detail_bundle_review")}


def test_from_text_to_service(spark):
    """Texts are parsed, published, and what the service then confirms is what was bounded."""
    text = "# 생명과학Ⅰ\n## 수행평가 세부 계획\n| 평가영역 | 평가방법 | 반영비율 |\n|---|---|---|\n| 세포 관찰 실험 | 보고서 | 20% |\n| 유전 토론 | 토론 | 10% |\n"
    rows = [("1" * 24, "생명과학Ⅰ", text, "a.hwp", 50.0, "2015", "도", "시", "가고"), ("2" * 24, "생명과학Ⅰ", "생명과학Ⅰ 수업에서 수행평가를 한다", "b.pdf", 60.0, "2015", "도", "시", "나고"), ("3" * 24, "물리", "", "", 1.0, "2015", "도", "군", "다고")]
    cases = spark.createDataFrame(rows, "case_id string, subject string, text string, saved_path string, review_score double, curriculum string, region string, district string, school_name string")
    stats = cases.groupBy("curriculum", "subject").count()
    p = P.publish(cases.drop("text"), S.parsed_items(cases), stats, TOPICS)
    assert {r["case_id"][0]: r["title_basis"] for r in p.cases.collect()} == {"1": "source_detail", "2": "source_detail_bundle_review", "3": "catalog_only"}
    shown = serve.confirmed(p).collect()
    assert [(r["title"], r["task_names"], r["weight"]) for r in shown] == [("세포 관찰 실험", ["세포 관찰 실험", "유전 토론"], "20%")]
    assert [r["item_id"][-2:] for r in serve.curated(p, topic="genetics").collect()] == ["-2"] and [r["item_id"][-2:] for r in serve.curated(p, category="experiment").collect()] == ["-1"]
