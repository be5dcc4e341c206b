"""Client-side operators and table repair on small inputs of our own."""

from pyspark.sql import functions as F

from evidencelake.functions import repair as R
from evidencelake.operators import client as C


def test_choices(spark):
    rows = [("g", "a" * 24, "긴 제목", "s1", 1), ("g", "b" * 24, "다른", "s1", 2), ("g", "c" * 24, "", "", 3), ("g", "d" * 24, "셋", "", 4), ("h", "e" * 24, "", "", 5)]
    cases = spark.createDataFrame(rows, "g string, case_id string, title string, sha256 string, seq int")
    assert sorted(r["case_id"][0] for r in C.reference_cases(cases, "g").collect()) == ["a", "d", "e"]
    items = spark.createDataFrame([("c", "c-1", 1, False), ("c", "c-2", 2, True), ("c", "c-3", 3, True)], "case_id string, item_id string, item_order int, source_available boolean")
    assert C.readable_item(items).first()["item_id"] == "c-2" and C.readable_item(items, "c-3").first()["item_id"] == "c-3"
    found, missing = C.batch_lookup(items, ["c-1", "x", "c-1", ""], "item_id", 4)
    assert found.count() == 1 and [r[0] for r in missing.collect()] == ["x"]
    df = spark.createDataFrame([("수행평가 묶음", ["가", "", "가", "나"])], "p string, n array<string>")
    assert df.select(C.confirmed_names(F.col("p"), F.col("n"))).first()[0] == ["가", "나"]
    assert df.select(C.completeness(F.lit(1), F.lit(0), F.lit(None), F.lit(3))).first()[0] == 2 and df.select(C.needs_safety(F.lit("효소"), F.lit("해부"))).first()[0]


def test_queue(spark):
    rows = [("a" * 24, 1, {"x": "good", "y": "unreviewed"}, "n" * 3000), ("a" * 24, 2, {}, ""), ("bad", 3, {}, ""), ("b" * 24, 4, {"x": "unreviewed"}, "")]
    got = {r["case_id"][0]: (r["rated"], len(r["note"])) for r in C.reviewed(spark.createDataFrame(rows, "case_id string, seq int, ratings map<string,string>, note string")).collect()}
    assert got == {"a": (1, 2000), "b": (0, 0)}


def test_draft(spark):
    designs = spark.createDataFrame([(1, "p", 10, 7), (2, "p", 33, 7)], "design_id int, pattern string, points int, lessons int")
    patterns = spark.createDataFrame([("p", [("a", 50), ("b", 30), ("c", 20)])], "pattern string, criteria array<struct<name:string,weight:int>>")
    got = {}
    for r in C.draft(designs, patterns).collect():
        got.setdefault(r["design_id"], {})[r["criterion"]] = r["points"]
    assert got == {1: {"a": 5, "b": 3, "c": 2}, 2: {"a": 17, "b": 10, "c": 6}}
    first, last = C.lesson_range(F.lit(7), 3, F.col("id"))
    assert [tuple(r) for r in spark.range(3).select(first, last).collect()] == [(1, 2), (3, 4), (5, 7)]


def test_attachments_and_schools(spark):
    att = spark.createDataFrame([(1, 10, 0), (1, None, 1), (1, 12, 2)], "page_id int, seq int, pos int")
    links = spark.createDataFrame([(1, 12, 0, "c"), (1, 10, 1, "a")], "page_id int, seq int, pos int, name string")
    assert [r["name"] for r in C.attachment_names(att, links).orderBy("pos").collect()] == ["a", "a", "c"]
    rows = spark.createDataFrame([(1, "s", "o2"), (2, "s", ""), (3, "z", "")], "row_id int, school_code string, office_code string")
    schools = spark.createDataFrame([("s", "o1", "one", 1), ("s", "o2", "two", 2)], "school_code string, office_code string, school_name string, seq int")
    assert [r["school_name"] for r in C.matched_schools(rows, schools).orderBy("row_id").collect()] == ["two", "one", None]
    page = '<input type="hidden" name="a" value="1"><input type="hidden" name="b" value="2"><a href="/f?b=3&c=4">x</a><a href="/g">y</a>'
    got = C.form_links(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html").orderBy("pos").collect()
    assert [(r["href"], r["label"], r["params"]) for r in got] == [("/f?b=3&c=4", "x", {"a": "1", "b": "3", "c": "4"}), ("/g", "y", {"a": "1", "b": "2"})]


def table(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def test_repair(spark):
    html, n = R.repair('<p onclick="x()">a</p><script>bad</script><a href="javascript:y">z</a>')
    assert n.sanitized == 3 and "bad" not in html and "onclick" not in html and "javascript" not in html
    html, n = R.repair(table(("평가영역", "채점기준", "배점"), ("가", "1", "2")) + "\n" + table(("평가영역", "채점기준", "배점"), ("나", "3", "4")))
    assert n.merged_headers == 1 and html.count("<table>") == 1 and html.count("<tr>") == 3
    html, n = R.repair(table(("수준", "진술"), ("A", "x"), ("B", "y"), ("C", "z")) + table(("D", "u"), ("E", "v")))
    assert (n.joined_levels, n.continuation_rows) == (1, 2) and html.count("<table>") == 1
    html, n = R.repair(table(("평가개요", "a"), ("", "b"), ("성취기준", "c"), ("", "d"), ("평가방법", "e"), ("채점기준", "f")))
    assert n.split_sections == 1 and html.count("<table>") == 4 and html.count("<tr>") == 6
    html, n = R.repair(table(("세포", "", ""), ("[12생과Ⅰ01-01]", "", ""), ("[12생과Ⅰ01-02]", "", "")))
    assert n.grouped_standards == 2 and n.pruned_columns == 2 and html == "<table><tr><td>세포 [12생과Ⅰ01-01] [12생과Ⅰ01-02]</td></tr></table>"
    assert R.repair('<table><tr><td rowspan="9">a</td><td>b</td></tr></table>')[1].clamped_spans == 1
    row = spark.createDataFrame([(table(("a",)),), (None,)], "h string").select(R.repaired()("h").alias("r")).collect()
    assert row[0]["r"]["html"] == "<table><tr><td>a</td></tr></table>" and row[1]["r"]["html"] is None
