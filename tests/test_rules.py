"""Small serving, audit and text rules on rows of our own."""

import pytest
from pyspark.sql import functions as F

from evidencelake.functions import repair, taxonomy, titles
from evidencelake.functions import text as T
from evidencelake.functions.sections import compact
from evidencelake.operators import aggregates
from evidencelake.plans import audits, serve


def values(spark, column, rows):
    return [r["v"] for r in spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, t string").orderBy("k").select(column.alias("v")).collect()]


def test_paths(spark):
    t = F.col("t")
    assert values(spark, T.source_format(t), ["a/b.HWP", "a.b/c", ".hidden", "x.tar.GZ", ""]) == ["hwp", "unknown", "unknown", "gz", "unknown"]
    assert values(spark, T.region_of_path(t), ["data/x/schoolinfo/y/서울/f", "data/x/other/y/서울", "data/x/schoolinfo/y"]) == ["서울", "", ""]
    assert values(spark, T.code_key(t), ["12생과Ⅱ01-02", "12생과Ⅱ 01", None]) == ["12생과Ⅱ0102", "12생과Ⅱ01", None]
    assert values(spark, titles.title_category(t), ["독서 발표", "발표 보고서", "실험", ""]) == ["reading", "presentation", "", ""]
    assert compact("ＡＢ１ ①가") == "AB11가"


def test_compatibility_forms(spark):
    """Decomposed and full-width texts are classified as their composed forms."""
    t = F.col("t")
    assert values(spark, taxonomy.content_free(t), ["\u1111\u1169\u1110\u1173\u1111\u1169\u11af\u1105\u1175\u110b\u1169", "포트폴리오", "세포 포트폴리오"]) == [True, True, False]
    assert values(spark, F.concat_ws(",", taxonomy.declared_methods(t)), ["☑ \u1110\u1169\u1105\u1169\u11ab □ 발표", "□ 발표"]) == ["discussion", "discussion"]


def test_case_item(spark):
    rows = [("a", "source_detail", "제목", ["x"], "매우 부족함", "0점"), ("b", "source_detail_bundle_review", "제목", ["x"], "세포를  관찰", "10%"), ("c", "source_detail", "제목", ["x"], " 12 ", "5%")]
    frame = spark.createDataFrame(rows, "case_id string, title_basis string, title string, task_names array<string>, overview string, weight string")
    got = {r["case_id"]: (r["title"], r["task_names"], r["overview"], r["weight"]) for r in serve.case_item(frame).collect()}
    assert got == {"a": ("제목", ["x"], "", ""), "b": (serve.BUNDLE_TITLE, [], "세포를 관찰", "10%"), "c": ("제목", ["x"], "", "5%")}
    for wrong in ({"curriculum": "1999"}, {"query": ""}, {"query": "x" * 101}, {"subject": "x" * 41}, {"tag": ""}):
        with pytest.raises(ValueError):
            serve.cases(None, **wrong)


def test_counts(spark):
    items = spark.createDataFrame([("a", "bounded", "<p>"), ("a", "bounded", ""), ("b", "bundle", "<p>"), ("b", "bundle", None)], "case_id string, extraction_status string, rubric_html string")
    assert [r["v"] for r in items.select(serve.has_rubric(items).alias("v")).collect()] == [True, False, False, False]
    graded = spark.createDataFrame([("a", "t", "supported"), ("a", "u", "reject"), ("b", "t", "review"), ("c", "t", "review")], "case_id string, title string, confidence string")
    assert {r["status"]: (r["supported"], r["review"], r["reject"]) for r in audits.confidence_counts(graded, items).collect()} == {"all": (1, 2, 1), "bounded": (1, 0, 1), "bundle": (0, 1, 0), "none": (0, 1, 0)}
    assert [r["title"] for r in audits.review_queue(graded).collect()] == ["u", "t", "t"]
    report = aggregates.duplicate_report(spark.createDataFrame([(k % 7, "x") for k in range(20)] + [(9, "x")], "k int, t string"), ["k", "t"], 3).first()
    assert tuple(report) == (7, ["0/x", "1/x", "2/x"])
    published = serve.Published(graded, items, items, graded.limit(2))
    assert tuple(serve.catalog_counts(published).first()) == (4, 2)


def test_suffix_tables():
    """The last words of cells behind a page break go back to their cells, with the headings between them; unclear cases stay."""
    html = lambda rows: "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    first = [["평가요소", "채점기준"], ["가", "모든 기준을"], ["나", "일부 기준을"], ["다", "기준을 충족하지"], ["라", "끝."]]
    rest = [["", ""], ["", "충족함"], ["", "만족함"], ["", "못함"]]
    fixed, n = repair.repair(html(first) + "<h3>나. 채점</h3>" + html(rest))
    assert n.reconstructed_cells == 3 and n.displaced_headings == 1 and fixed.count("<table>") == 1
    assert "모든 기준을 충족함" in fixed and "기준을 충족하지 못함" in fixed and "<span>나. 채점</span></aside>" in fixed
    for unclear in (html(first) + "<p>글</p>" + html(rest), html(first) + html(rest[:3]), html(first + first[1:4]) + html(rest), html(first) + html([["", "머리"], *rest[1:]])):
        fixed, n = repair.repair(unclear)
        assert n.reconstructed_cells == 0 and fixed.count("<table>") == 2
    wide, n = repair.repair(html([["A", "가"], ["B", "나"], ["C", "다"]]) + html([["D", "라", "마"], ["E", "바", "사"]]))
    assert n.joined_levels == 1 and "사" in wide and wide.count("<td>") == 15


@pytest.mark.parametrize("ends, size, place", [("xxx", 3, 0), ("..xx.xxx.", 3, 5), ("xxxx", 3, None), ("xx.xx", 2, None), ("x.xx", 3, None), ("xx.xxx.x", 3, 3), ("", 3, None)])
def test_words_go_back_to_one_place_only(ends, size, place):
    """Against a search over all places: exactly one stretch of rows that break off takes the words."""
    table = [["가", "모든 기준을" if c == "x" else "끝.", ""] for c in ends]
    words, n = [f"말{k}" for k in range(size)], repair.Counters()
    starts = [k for k in range(len(ends) - size + 1) if set(ends[k : k + size]) == {"x"}]
    assert (starts == [place]) == (place is not None)
    assert repair.put_back(table, words, n) == (place is not None) and n.reconstructed_cells == (size if place is not None else 0)
    assert [r[1] for r in table if "말" in r[1]] == ([f"모든 기준을 말{k}" for k in range(size)] if place is not None else [])


def test_displaced_headings_and_lone_standards():
    h = "<h4>가. 채점</h4>\n<h5>나. 배점</h5>"
    fixed, n = repair.repair(f"<p>글</p>{h}<p>[12생과Ⅰ01-01]</p><p>[12생과Ⅰ01-02] [12생과Ⅰ01-03]</p>")
    assert (n.displaced_headings, n.grouped_standards) == (1, 1) and fixed.count("<aside>") == 2 and "<span>나. 배점</span>" in fixed and fixed.startswith("<p>글</p><aside>")
    for alone in ("<h4>가. 채점</h4><p>글</p><h5>나. 배점</h5>", "<h4>가. 채점</h4> 글 <h5>나. 배점</h5>", "<h3>가</h3><h3>나</h3>", f"<h4>{'긴' * 33}</h4><h4>나</h4>"):
        assert repair.repair(alone) == (alone, repair.Counters())
    long = "<table><tr><th>[12생과Ⅰ01-01]" + "글" * 180 + "</th></tr></table>"
    assert repair.repair(long)[1].long_headers == 1 and repair.repair(long.replace("[12", "[1"))[1].long_headers == 0


def test_item_signals(spark):
    rows = [(1, "<p>", ["[12생과]"], "", "20%", None, " "), (2, None, None, None, None, None, None), (3, "", [], "5점", "", "발표", "글")]
    frame = spark.createDataFrame(rows, "k int, rubric string, standards array<string>, score string, weight string, method string, overview string")
    got = {r["k"]: r["s"] for r in frame.select("k", taxonomy.item_signals(*(F.col(c) for c in frame.columns[1:])).alias("s")).collect()}
    assert got == {1: ["채점기준", "성취기준", "배점"], 2: [], 3: ["배점", "평가방법", "평가 개요"]}
