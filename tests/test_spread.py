"""Costly work is dealt over a shuffle's partitions, however few splits its rows come in, and nothing that grows is broadcast."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from evidencelake.functions import markup as M
from evidencelake.functions import taxonomy
from evidencelake.operators import client
from evidencelake.operators import plan_tables as P
from evidencelake.operators import task_names
from evidencelake.plans import evidence, items, publish

CASES = "case_id string, subject string, text string"


def _cases(spark, n=40):
    rows = [(str(k), "생명과학Ⅰ", f"# 생명과학Ⅰ\n<table><tr><td>과제명</td><td>물 {k} 실험</td></tr><tr><td>평가방법</td><td>발표</td></tr><tr><td>반영비율</td><td>20%</td></tr></table>") for k in range(n)]
    return spark.createDataFrame(rows, CASES).coalesce(1)


def _plan(frame) -> list[str]:
    return frame._jdf.queryExecution().sparkPlan().toString().splitlines()


def _parts(frame) -> int:
    return frame.selectExpr("spark_partition_id() AS p").distinct().count()


def test_table_rows_of_one_split_are_read_by_many_tasks(spark):
    assert _parts(P.table_rows(_cases(spark))) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_shared_rows_are_grouped_by_table_without_another_shuffle(spark):
    facts = P.table_facts(P.shared_rows(_cases(spark)))
    facts.collect()
    plan = facts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "InMemoryTableScan" in plan and "Exchange" not in plan.split("InMemoryTableScan")[0]


def test_hints_are_not_broadcast(spark):
    hints = spark.createDataFrame([("1", "물 1  실험")], "case_id string, hint string")
    rows = P.shared_rows(_cases(spark))
    found = P.hinted_items(rows, hints)
    assert any("Join" in x and "hint_key" in x for x in _plan(found)) and not any("BroadcastHashJoin" in x and "hint_key" in x for x in _plan(found))
    assert [(r["case_id"], r["title"]) for r in found.collect()] == [("1", "물 1 실험")]


def test_of_equal_hints_one_that_names_a_task_counts(spark):
    rows = P.shared_rows(spark.createDataFrame([("1", "생명과학Ⅰ", "# 생명과학Ⅰ\n<table><tr><td>배점</td><td>평가요소</td></tr><tr><td>세포 관찰</td><td>1</td></tr></table>")], CASES))
    hints = spark.createDataFrame([("1", "세포 관찰."), ("1", "세포 관찰")], "case_id string, hint string")  # a full stop makes a sentence of it
    assert [(r["title"], r["label"]) for r in P.hinted_items(rows, hints).collect()] == [("세포 관찰", "세포 관찰")]


@pytest.mark.parametrize("markup", ["<table><tr><td> a </td><td></td></tr>\n<tr><td>x > y\n</td></tr></table>", "<table></table>", "<table><tr></tr></table>", "<table><tr><td>a&amp;b</td></tr></table>", "<table><tr><td colspan=2>a</td></tr></table>", "<table><tr><td>a<br>b</td></tr></table>"])
def test_plain_tables_are_read_as_the_parser_reads_them(markup):
    assert M.any_grid(markup) == M.grids(markup)[-1]
    assert (M.plain_grid(markup) is None) == any(x in markup for x in ("&", "colspan", "<br>"))


def test_only_signs_beyond_ascii_are_folded_by_python(spark):
    texts = ["A b\tC\x1fd", "ﬁ Ａ b", "", None, "가 나", "a\x85B"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", taxonomy.folded(F.col("t")).alias("f"), taxonomy._other(F.col("t")).alias("o")).collect()
    assert [r["f"] for r in rows] == [None if t is None else taxonomy.fold(t) for t in texts]
    assert [r["o"] for r in rows] == [t if t and not t.isascii() else None for t in texts]


def test_the_best_categories_are_found_once_for_a_name(spark):
    plan = spark.range(1).select(taxonomy.winners(F.col("id").cast("string"), (("a", ("1", "12")), ("b", ("2",)))).alias("k"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("array_max") <= 3  # one for each category, one for the best
    lexicon = (("a", ("x", "yy")), ("b", ("yy", "x")), ("c", ("yy",)))
    got = spark.createDataFrame([("xyy",), ("yy",), ("",), ("x",)], "n string").select("n", taxonomy.winners(F.col("n"), lexicon).alias("k")).collect()
    assert [r["k"] for r in got] == [["b", "a"], ["c", "b", "a"], [], ["b", "a"]]


def test_names_and_headings_of_one_split_are_read_by_many_tasks(spark):
    cases = spark.createDataFrame([(k, "생명과학Ⅰ", f"수행평가명 | 물 {k} 토론하기 | 배점", None) for k in range(40)], "id long, subject string, text string, seen array<string>").coalesce(1)
    found = task_names.derived_names(cases)
    assert found.count() == 40 and "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    if os.path.isdir("/root/testdata/sf0.001"):
        assert _parts(items.heading_structure(spark, "/root/testdata/sf0.001")) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_text_is_masked_and_searched_once(spark):
    docs = spark.createDataFrame([(1, "통합 과학 a@b.kr 수행평가"), (2, "글"), (3, None)], "seq long, text string").select("seq", "text", F.lit("ok").alias("extract_status"), F.array(F.struct(F.lit("s").alias("subject"), F.lit("c").alias("curriculum_hint"))).alias("subject_hits"))
    found = evidence.evidence_records(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("이메일") == 1 and plan.count("고급\\s*생명") == 1  # in a filter each place of use would repeat them
    assert [(r["seq"], r["subject"], r["evidence_text"]) for r in found.collect()] == [(1, "통합과학", "통합 과학 [이메일] 수행평가")]


def test_a_worker_holds_few_texts_at_once(spark):
    rows = spark.createDataFrame([(" a",), (None,)], "t string").select(M.text_udf(str.strip)(F.col("t")).alias("t"))
    assert "ArrowEvalPython" not in rows._jdf.queryExecution().executedPlan().toString()  # its batches hold ten thousand rows
    assert [r["t"] for r in rows.collect()] == ["a", None]


def test_items_are_dealt_by_case_once(spark):
    rows = [("a", k, t, "o", "m", "", "9점", ["[1]"], "bounded", "table", "x:y") for k, t in ((2, "T"), (1, "S"), (3, "T"))]
    items_ = spark.createDataFrame(rows, "case_id string, item_order int, title string, overview string, method string, weight string, score string, standards array<string>, extraction_status string, title_basis string, boundary_status string").coalesce(1)
    found = publish.derived(items_)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1 and "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["case_id"], r["task_names"], r["weight"], r["title"]) for r in found.collect()] == [("a", ["S", "T"], "9점", "S")]


def test_inputs_of_a_form_are_read_once(spark):
    page = """<input name="A" value="1"><input name="B" value="x&amp;y"><input name="A" value="2"><a href="EiFileDownLoad.do?FILE_SEQ=7&amp;B=&amp;C=a=b"> n <b>m</b></a>"""
    got = client.attachments(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html", {"A": "0", "Y": "3"})
    assert got._jdf.queryExecution().optimizedPlan().toString().count("<input") == 1
    assert [(r["seq"], r["name"], r["params"]) for r in got.collect()] == [("7", "n m", {"A": "2", "B": "x&y", "Y": "3", "FILE_SEQ": "7", "C": "a=b"})]
