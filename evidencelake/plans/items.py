"""Queries of the plan-table and heading operators: plans made of the driver's rows, read back, against SQL over the rows themselves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import plan_words as W
from ..functions import headings as H
from ..functions import markup as M
from ..operators import plan_tables as P
from ..operators import task_names as N
from ..session import spread, table
from . import publish

SQL = {}


def _markup(*rows: Column) -> Column:
    """A table of the given rows; a null row is left out."""
    return F.concat(F.lit("<table>"), F.concat_ws("", *rows), F.lit("</table>"))


def _row(*cells) -> Column:
    shown = [c if isinstance(c, Column) else F.lit(c) for c in cells]
    return F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), c.cast("string"), F.lit("</td>")) for c in shown), F.lit("</tr>"))


def _picked(options: list[str], at: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in options)), (at % len(options) + 1).cast("int"))


def _listed(options: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in options) + "]"


COURSES = ["생명과학Ⅰ", "생명과학", "통합과학1", "생명과학Ⅱ"]
CODES = ["12생과Ⅰ01-02", "12생과03-01", "10통과102-01", "12물리01-04", "12생과Ⅱ02-03"]


def code_tables(spark, sf):
    """Tables without any heading: those whose codes all belong to the case's subject give an item."""
    p = table(spark, sf, "part")
    second = F.floor(p["p_partkey"] / 7) + p["p_size"]
    text = _markup(_row("과제명", F.concat("p_name", F.lit(" 탐구"))), _row("성취기준", F.concat(F.lit("["), _picked(CODES, F.col("p_size")), F.lit("] and ["), _picked(CODES, second), F.lit("]"))), _row("평가시기", F.concat("p_size", F.lit("주"))))
    cases = p.select(F.col("p_partkey").alias("case_id"), _picked(COURSES, F.col("p_partkey")).alias("subject"), text.alias("text"))
    return P.code_items(P.shared_rows(cases)).select(F.col("case_id").cast("long").alias("case_id"), "title", "timing", F.array_join("standards", ",").alias("standards"))


_PREFIXES = ", ".join(f"('{s}', '{p}')" for s, p in W.CODE_PREFIXES.items())
SQL["code_tables"] = f"""WITH made AS (SELECT p_partkey, p_name, p_size, {_listed(COURSES)}[p_partkey % 4 + 1] AS subject, {_listed(CODES)}[p_size % 5 + 1] AS a, {_listed(CODES)}[(p_partkey // 7 + p_size) % 5 + 1] AS b FROM part)
SELECT p_partkey AS case_id, p_name || ' 탐구' AS title, p_size || '주' AS timing, CASE WHEN a = b THEN '[' || a || ']' ELSE '[' || a || '],[' || b || ']' END AS standards
FROM made JOIN (VALUES {_PREFIXES}) AS o(subject, prefix) USING (subject) WHERE starts_with(a, prefix) AND starts_with(b, prefix)"""


def local_tables(spark, sf):
    """Labelled tables of orders: an item where the part is reliably bounded and at least two other labels bear it out."""
    o = table(spark, sf, "orders")
    head = F.when(F.col("o_orderkey") % 3 != 0, "# 생명과학Ⅰ\n").otherwise("생명과학Ⅰ 안내\n")
    rows = [_row("수행평가명", F.concat(F.lit("order "), F.col("o_orderkey"), F.lit(" 조사"))), F.when(F.col("o_orderstatus") == "F", _row("평가방법", "발표", "토론")), F.when(F.col("o_custkey") % 2 == 0, _row("반영비율", F.concat(F.col("o_custkey") % 50, F.lit("%")))), F.when(F.startswith("o_orderpriority", F.lit("1")), _row("채점기준", "정확"))]
    cases = o.select(F.col("o_orderkey").alias("case_id"), F.lit("생명과학Ⅰ").alias("subject"), F.concat(head, _markup(*rows)).alias("text"))
    return P.local_items(P.shared_rows(cases)).select(F.col("case_id").cast("long").alias("case_id"), "title", "method", "weight")


SQL["local_tables"] = """SELECT o_orderkey AS case_id, 'order ' || o_orderkey || ' 조사' AS title, CASE WHEN o_orderstatus = 'F' THEN '발표 · 토론' ELSE '' END AS method, CASE WHEN o_custkey % 2 = 0 THEN (o_custkey % 50) || '%' ELSE '' END AS weight
FROM orders WHERE o_orderkey % 3 <> 0 AND CAST(o_orderstatus = 'F' AS INT) + CAST(o_custkey % 2 = 0 AS INT) + CAST(starts_with(o_orderpriority, '1') AS INT) >= 2"""


def horizontal_answers(spark, sf):
    """Title labels in three layouts: answered to the right, heading a column, alone above their values."""
    c = table(spark, sf, "customer")
    name = F.concat("c_name", F.lit(" 실험"))
    text = F.when(F.col("c_custkey") % 3 == 0, _markup(_row("과제명", "", name), _row("성취기준", "x"))).when(F.col("c_custkey") % 3 == 1, _markup(_row("과제명", "반영비율"), _row(name, "10%"))).otherwise(_markup(_row("과제명", ""), _row(name, "")))
    cases = c.select(F.col("c_custkey").alias("case_id"), F.lit("생명과학Ⅰ").alias("subject"), text.alias("text"))
    rows = P.shared_rows(cases)
    labels = P.label_cells(rows).select("case_id", "table_no", "answered", F.col("answer.text").alias("answer"))
    return labels.join(P.table_titles(rows).select("case_id", "table_no", "title"), ["case_id", "table_no"], "left").select(F.col("case_id").cast("long").alias("case_id"), "answered", "answer", "title")


SQL["horizontal_answers"] = """SELECT c_custkey AS case_id, c_custkey % 3 = 0 AS answered, CASE c_custkey % 3 WHEN 0 THEN c_name || ' 실험' WHEN 1 THEN '반영비율' END AS answer, CASE WHEN c_custkey % 3 <> 1 THEN c_name || ' 실험' END AS title FROM customer"""


def vertical_titles(spark, sf):
    """Three customers' tasks below a title's label: the table names a task only if all of them are one."""
    c = table(spark, sf, "customer").groupBy(F.floor(F.col("c_custkey") / 3).alias("trio")).agg(F.array_sort(F.collect_list(F.col("c_nationkey") % 2)).alias("kinds"))
    rows = F.array_join(F.transform("kinds", lambda k: _row(F.lit("정확"), F.concat(F.lit("Task "), k, F.lit(" 조사")))), "")
    text = F.concat(F.lit("<table>"), _row("평가요소", "수행과제"), rows, F.lit("</table>"))
    cases = c.select(F.col("trio").alias("case_id"), F.lit("생명과학Ⅰ").alias("subject"), text.alias("text"))
    return P.table_titles(P.shared_rows(cases)).select(F.col("case_id").cast("long").alias("case_id"), "title", "label")


SQL["vertical_titles"] = """SELECT c_custkey // 3 AS case_id, 'Task ' || min(c_nationkey % 2) || ' 조사' AS title, '수행과제' AS label FROM customer GROUP BY c_custkey // 3 HAVING count(DISTINCT c_nationkey % 2) = 1"""


def hinted_tables(spark, sf):
    """Expected titles that a cell of the part's table bears out, as it stands there."""
    p = table(spark, sf, "part")
    cell = F.concat("p_name", F.lit(" 보고서"), F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" "), "p_type")))
    text = F.concat(F.lit("# 생명과학Ⅰ\n"), _markup(_row("활동", "배점", "평가요소"), _row(cell, "10", "정확")))
    cases = p.select(F.col("p_partkey").alias("case_id"), F.lit("생명과학Ⅰ").alias("subject"), text.alias("text"))
    hints = p.select(F.col("p_partkey").alias("case_id"), F.when(F.col("p_partkey") % 4 == 0, F.lit("a task of another plan")).otherwise(F.concat("p_name", F.lit("  보고서"))).alias("hint"))
    return P.hinted_items(P.shared_rows(cases), hints).select(F.col("case_id").cast("long").alias("case_id"), "title", F.trim("label").alias("hint"))


_SHORT = "regexp_replace({}, '[^0-9A-Za-z가-힣ⅠⅡⅢⅣⅤ]', '', 'g')"
SQL["hinted_tables"] = f"""WITH m AS (SELECT p_partkey, p_name || ' 보고서' || CASE WHEN p_size % 2 = 0 THEN '' ELSE ' ' || p_brand || ' ' || p_type END AS cell, p_name || '  보고서' AS hint FROM part WHERE p_partkey % 4 <> 0)
SELECT p_partkey AS case_id, cell AS title, hint FROM m WHERE contains({_SHORT.format("cell")}, {_SHORT.format("hint")}) AND length({_SHORT.format("cell")}) - length({_SHORT.format("hint")}) <= 16"""


def plan_names(spark, sf):
    """All tasks that a nation's plan names, in order and once."""
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_acctbal"))).alias("all"))
    rows = F.array_join(F.transform("all", lambda x: _row(F.concat(F.lit("Task "), x["s_suppkey"] % 40, F.lit(" 탐구")), x["s_acctbal"])), "")
    text = F.concat(F.lit("# 생명과학Ⅰ\n<table>"), _row("평가영역", "평가만점"), rows, F.lit("</table>"))
    cases = s.select(F.col("s_nationkey").alias("case_id"), F.lit("생명과학Ⅰ").alias("subject"), text.alias("text"))
    return P.plan_titles(P.shared_rows(cases)).select(F.col("case_id").cast("long").alias("case_id"), F.posexplode("titles").alias("place", "title")).select("case_id", F.col("place").cast("long").alias("place"), "title")


SQL["plan_names"] = """SELECT s_nationkey::BIGINT AS case_id, row_number() OVER (PARTITION BY s_nationkey ORDER BY first) - 1 AS place, 'Task ' || k || ' 탐구' AS title FROM (SELECT s_nationkey, s_suppkey % 40 AS k, min(s_suppkey) AS first FROM supplier GROUP BY ALL)"""


def split_tables(spark, sf):
    """A table of each region's nations, cut by page breaks behind some of them, as it is shown."""
    n = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("all"))
    row = lambda x: F.concat(_row(x["n_name"], "1"), F.when(x["n_nationkey"] % 3 == 0, F.lit("</table>\n\n<table>")).when(x["n_nationkey"] % 3 == 1, F.lit("</table>\n글\n<table>")).otherwise(""))
    text = F.concat(F.lit("<table>"), F.array_join(F.transform("all", row), ""), _row("", ""), F.lit("</table>"))
    shown = n.select("n_regionkey", F.pandas_udf(lambda v: v.map(M.to_html), "string")(text).alias("html"))
    return shown.select("n_regionkey", F.regexp_count("html", F.lit("<table>")).cast("long").alias("tables"), F.regexp_count("html", F.lit("<tr>")).cast("long").alias("rows"))


SQL["split_tables"] = "SELECT n_regionkey, 1 + count_if(n_nationkey % 3 = 1)::BIGINT AS tables, count(*) + 1 AS rows FROM nation GROUP BY n_regionkey"


def item_union(spark, sf):
    """Titles of three sources: of equal ones the first source counts, numbers go by source and place."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("case_id"), F.concat(F.lit("Task-"), F.col("o_orderkey") % 5).alias("title"), F.col("o_orderkey").cast("int").alias("table_no"), F.lit(0).alias("start"), F.substring("o_orderpriority", 1, 1).alias("p"))
    parts = {"table": o.where("p in ('1', '2')").drop("p"), "local": o.where("p = '3'").withColumn("title", F.translate("title", "-", " ")).drop("p"), "code": o.where("p >= '4'").drop("p")}
    return P.item_union(parts).select(F.col("case_id").cast("long").alias("case_id"), F.col("item_order").cast("long").alias("item_order"), "title", "provenance")


SQL["item_union"] = """WITH e AS (SELECT o_custkey AS case_id, 'Task' || CASE WHEN p = '3' THEN ' ' ELSE '-' END || o_orderkey % 5 AS title, o_orderkey % 5 AS k, o_orderkey, CASE WHEN p <= '2' THEN 1 WHEN p = '3' THEN 2 ELSE 4 END AS rank FROM (SELECT *, left(o_orderpriority, 1) AS p FROM orders)),
u AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY case_id, k ORDER BY rank, o_orderkey) = 1)
SELECT case_id, row_number() OVER (PARTITION BY case_id ORDER BY rank, o_orderkey) AS item_order, title, CASE rank WHEN 1 THEN 'table' WHEN 2 THEN 'local' ELSE 'code' END AS provenance FROM u"""


def plan_items(spark, sf):
    """Plans of four shapes: a plan table, a labelled table, a table known by its code, a bundle with the only title that its plan names."""
    n = table(spark, sf, "nation")
    name = F.concat("n_name", F.lit(" 관찰"))
    shape = F.col("n_nationkey") % 4
    plan = F.concat(F.lit("# 생명과학Ⅰ\n## 수행평가 세부 계획\n| 평가영역 | 평가방법 | 반영비율 |\n|---|---|---|\n| "), name, F.lit(" | 발표 | 20% |"))
    local = F.concat(F.lit("# 생명과학Ⅰ\n"), _markup(_row("수행과제", name), _row("평가방법", "토론"), _row("반영비율", "20%")))
    coded = F.concat(F.lit("표지\n"), _markup(_row("과제명", name), _row("성취기준", "[12생과Ⅰ01-01]")))
    single = F.concat(F.lit("생명과학Ⅰ 수행평가\n"), _markup(_row("단원", "평가내용"), _row("세포", name)))
    text = F.when(shape == 0, plan).when(shape == 1, local).when(shape == 2, coded).otherwise(single)
    cases = n.select(F.col("n_nationkey").alias("case_id"), F.lit("생명과학Ⅰ").alias("subject"), text.alias("text"))
    return P.plan_items(cases).select(F.col("case_id").cast("long").alias("case_id"), F.col("item_order").cast("long").alias("item_order"), "title", "provenance", "extraction_status", "method")


SQL["plan_items"] = """SELECT n_nationkey::BIGINT AS case_id, 1::BIGINT AS item_order, n_name || ' 관찰' AS title, ['table', 'local', 'code', 'bundle'][n_nationkey % 4 + 1] AS provenance, CASE n_nationkey % 4 WHEN 3 THEN 'bundle_review' ELSE 'bounded' END AS extraction_status, CASE n_nationkey % 4 WHEN 0 THEN '발표' WHEN 1 THEN '토론' ELSE '' END AS method FROM nation"""


#: What stands before and behind a part's name; a form without "%s" is a heading of its own.
FORMS = [
    "1. %s (20점)", "가. %s", "%s", "[과탐]%s 보고서", "수행평가(2) - %s", "수행평가 세부 계획 가. %s", "B영역: %s", "항목 1) 수행평가명: %s", "• %s 1) 평가 요소: 참여", "%s (동점자 1순위)", "%s 수행평가 기준", "평가 기준 수행평가 기준",
    "%s 30 (점)", "[%s]", "(%s)", "(3) %s (15)", "2순위 (반영비율 10%%): %s", "[서술형] %s", "%s (평가 시기: 5월)", "%s (10점) : 설명", "수행평가 영역 2 : %s", "수행평가 세부 기준 (1) %s", "12. 학기 단위 성취수준 설정,", "성취기준 [12생과01-01] %s",
    "%s에 관하여 평가는 공정하게 실시하여 채점한다.", "AI 도구의 %s 사용 금지", "Ⅰ. %s Ⅱ. %s", "결시자 %s", "채점 기준 및 배점", "수행평가 결시자의 %s", "최하 3점부터 %s", "%s 해당 없음", "교과협의회 %s", "평가 요소 및 배점 합계", "신체 장애 학생 %s", "%s 수행하였는가?",
    "[10통과01-01] ~ %s", "기타 사항", "%s 능력을 서술하여 종합적으로 평가", "평가하지 않는 성취기준 %s",
]


def _headings(spark, sf):
    p = spread(table(spark, sf, "part"), "p_partkey")
    return p.select("p_partkey", F.replace(_picked([f.replace("%%", "％") for f in FORMS], F.col("p_partkey")), F.lit("%s"), F.col("p_name")).alias("heading"))


def heading_structure(spark, sf):
    """Headings made of parts' names: which are structure, with and without the test of prose, and which may be titles."""
    at = F.col("heading")
    return _headings(spark, sf).select("p_partkey", "heading", H.is_structural(at).alias("structural"), H.is_structural(at, policy_prose=False).alias("by_form"), H.is_plan_title(at).alias("plan_title"))


def heading_titles(spark, sf):
    """Headings and the titles that are left of them."""
    return _headings(spark, sf).select("p_partkey", H.cleaned(F.col("heading")).alias("c")).select("p_partkey", "c.title", "c.title_raw")


_quoted = lambda s: "'" + s.replace("'", "''") + "'"
_ANCHORED = {"whole": "^(?:%s)$", "start": "^(?:%s)", "part": "%s", "compact": "%s"}


def _matches(x: str, kind: str, pattern: str) -> str:
    flag, bare = ("(?i)", pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
    return f"regexp_matches({x}, {_quoted(flag + _ANCHORED[kind] % bare)})"


def _rewritten(x: str, rewrites) -> str:
    for pattern, new in rewrites:
        x = f"regexp_replace({x}, {_quoted(pattern)}, {_quoted(new.replace('$1', chr(92) + '1'))}, 'g')"
    return x


_LINE = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_MADE = f"made AS (SELECT p_partkey, replace({_listed([f.replace('%%', '％') for f in FORMS])}[p_partkey % {len(FORMS)} + 1], '%s', p_name) AS heading FROM part)"


def _title_sql(source: str, x: str) -> str:
    """CTEs that lead from ``source`` (p_partkey, and ``x``) to ``titles`` (p_partkey, title)."""
    named = [f"t0 AS (SELECT p_partkey, {_rewritten(f'trim({x})', W.TITLE_REWRITES)} AS t FROM {source})"]
    for k, tail in enumerate(W.TITLE_TAILS):
        name = f"regexp_extract(t, {_quoted(tail)}, 1)"
        named.append(f"t{k + 1} AS (SELECT p_partkey, CASE WHEN length({_SHORT.format(name)}) >= 2 AND NOT list_contains({_listed([*W.STRUCTURAL_NAMES])}, {_SHORT.format(name)}) THEN {name} ELSE t END AS t FROM t{k})")
    return ", ".join([*named, f"titles AS (SELECT p_partkey, {_LINE.format(_rewritten('t', W.DECORATION))} AS title FROM t{len(W.TITLE_TAILS)})"])


def _prose_sql(text: str, short: str) -> str:
    sentence = " OR ".join(f"(length({short}) >= {n} AND regexp_matches({text}, {_quoted(p)}))" for n, p in W.PROSE_PATTERNS)
    policy = f"regexp_matches({text}, {_quoted(W.POLICY_WORDS)}) OR ({short} <> '' AND regexp_replace({short}, {_quoted(W.ADMIN_WORDS)}, '', 'g') = '')"
    return f"({sentence} OR (NOT regexp_matches({text}, {_quoted(W.ACTIVITY)}) AND ({policy})))"


def _structure_sql() -> str:
    number, edges = r"'^(?:\d+|[가-하])\s*[.)]\s*'", r"'^[\s,，:：;；.-]+|[\s,，:：;；.-]+$'"
    prose_edges = r"'^[\s,，:：;；]+|[\s,，:：;；]+$'"
    bare = f"regexp_replace(regexp_replace(regexp_replace({_LINE.format('heading')}, {number}, ''), '\\s*\\(※[^)]*\\)\\s*$', ''), {edges}, '', 'g')"
    clean = lambda x: f"regexp_replace(regexp_replace({_LINE.format(x)}, {prose_edges}, '', 'g'), '^(?:\\d+|[가-하]|[①-⑳])\\s*[.)]\\s*', '')"
    forms = [f"list_contains({_listed([*W.STRUCTURAL_NAMES])}, s)"] + [f"(length(s) >= 10 AND {_matches('s', k, p)})" if k == "compact" else _matches("b", k, p) for k, p in W.STRUCTURAL_PATTERNS]
    no_title = " OR ".join(_matches("h", k, p) for k, p in W.NO_TITLES)
    no_plan = " OR ".join([f"list_contains({_listed([*W.NO_PLAN_NAMES])}, hs)", "length(hs) > 60", *(_matches("h", k, p) for k, p in W.NO_PLAN_TITLES), _matches("title", *W.EXAMS), _prose_sql("hc", "hcs"), f"(regexp_matches(h, {_quoted(W.RUBRIC_END)}) AND (length(hs) > 12 OR regexp_matches(h, {_quoted(W.RUBRIC_WORDS)})))"])
    return f"""WITH {_MADE}, {_title_sql("made", "heading")},
b AS (SELECT p_partkey, heading, trim(heading) AS h, {bare} AS b, {clean("trim(heading)")} AS hc FROM made),
c AS (SELECT *, {_SHORT.format("b")} AS s, {clean("b")} AS bc, {_SHORT.format("h")} AS hs, {_SHORT.format("hc")} AS hcs FROM b),
d AS (SELECT *, {_SHORT.format("bc")} AS bcs, ({" OR ".join(forms)}) AS by_form FROM c)
SELECT p_partkey, heading, by_form OR {_prose_sql("bc", "bcs")} AS structural, by_form,
length(hs) BETWEEN 2 AND 100 AND NOT ({no_title}) AND NOT (length(hs) > 4 AND regexp_matches(h, '(?:상|중|하)\\s*$')) AND NOT ({no_plan}) AS plan_title FROM d JOIN titles USING (p_partkey)"""


SQL["heading_structure"] = _structure_sql()
SQL["heading_titles"] = f"""WITH {_MADE}, {_title_sql("made", "heading")} SELECT p_partkey, title, heading AS title_raw FROM titles JOIN made USING (p_partkey)"""


TOPICS = (("size", ("small", "large", "medium")), ("tone", ("red", "blue", "green", "cold")), ("offer", ("promo", "economy")))
WAYS = (("inquiry", ("widget", "wid")), ("fixing", ("bolt", "nut", "rod")), ("heat", ("cold", "hot")))


def _parsed(spark, sf):
    """Lines of orders as parsed items: named after their parts, with a method and a weight here and there."""
    l, p = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"), table(spark, sf, "part")  # noqa: E741
    once = spread(l, "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")).alias("l")).select("l_orderkey", "l_linenumber", "l.*")
    n = F.col("l_partkey")
    return once.join(p, once["l_partkey"] == p["p_partkey"]).select(
        F.col("l_orderkey").alias("case_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("item_id"), F.col("l_linenumber").alias("item_order"), F.col("p_name").alias("title"), F.when(n % 3 == 0, " ").otherwise(F.lower("p_type")).alias("overview"),
        F.when(n % 2 == 0, "").otherwise(F.col("p_brand")).alias("method"), F.when(n % 5 == 0, F.concat(F.col("p_size"), F.lit("%"))).alias("weight"), F.concat(F.col("p_size"), F.lit("점")).alias("score"), F.array(F.concat(F.lit("["), n % 4, F.lit("]")), F.concat(F.lit("["), F.col("p_size") % 4, F.lit("]"))).alias("standards"),
        F.when(F.col("l_returnflag") == "N", "bundle_review").otherwise("bounded").alias("extraction_status"), F.when(F.col("l_linestatus") == "F", "table").otherwise("unbounded_bundle").alias("title_basis"), F.lit("a:b").alias("boundary_status"), F.col("l_linenumber").alias("section_char_count"), F.when(n % 7 == 0, "<p>").otherwise("").alias("rubric_html"),
    )


_PARSED = """l AS (SELECT l_orderkey AS case_id, l_orderkey || '-' || l_linenumber AS item_id, l_linenumber AS item_order, l_partkey AS k, p_name AS title, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE lower(p_type) END AS overview, CASE WHEN l_partkey % 2 = 0 THEN '' ELSE p_brand END AS method,
CASE WHEN l_partkey % 5 = 0 THEN p_size || '%' ELSE '' END AS weight, p_size || '점' AS score, ['[' || l_partkey % 4 || ']', '[' || p_size % 4 || ']'] AS standards, l_returnflag <> 'N' AND l_linestatus = 'F' AS bounded
FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) = 1) JOIN part ON l_partkey = p_partkey)"""


def publish_axes(spark, sf):
    """Every topic and method of every item, by title, else by overview."""
    cases = table(spark, sf, "orders").select(F.col("o_orderkey").alias("case_id"), F.col("o_totalprice").alias("review_score"))
    return publish.axes(publish.ranked(_parsed(spark, sf), cases, TOPICS, WAYS))


def _lexicon(name: str, lexicon) -> str:
    return f"{name}(k, w) AS (VALUES " + ", ".join(f"('{k}', '{w}')" for k, ws in lexicon for w in ws) + ")"


_WON = ",\n".join(f"{axis}_won AS (SELECT item_id, f, k FROM (SELECT item_id, f, k, max(len(w)) AS longest, count(*) AS hits FROM texts JOIN {axis}s ON contains(v, w) GROUP BY ALL) QUALIFY rank() OVER (PARTITION BY item_id, f ORDER BY longest DESC, hits DESC) = 1 AND f = min(f) OVER (PARTITION BY item_id))" for axis in ("topic", "way"))
_AXES = f"""{_PARSED}, {_lexicon('topics', TOPICS)}, {_lexicon('ways', WAYS)}, texts AS (SELECT item_id, 0 AS f, replace(lower(title), ' ', '') AS v FROM l UNION ALL SELECT item_id, 1, replace(overview, ' ', '') FROM l),
{_WON},
axes AS (SELECT item_id, 'topic' AS axis, k AS value FROM topic_won UNION ALL SELECT item_id, 'method', k FROM way_won QUALIFY k <> 'inquiry' OR count(*) OVER (PARTITION BY item_id) = 1)"""
SQL["publish_axes"] = f"WITH {_AXES} SELECT item_id, axis, value FROM axes"


def publish_rankings(spark, sf):
    """Items with their case's score, category, topic, and the kinds of evidence they have."""
    cases = table(spark, sf, "orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("case_id"), F.floor("o_totalprice").alias("review_score"))
    return publish.ranked(_parsed(spark, sf), cases, TOPICS, WAYS).select("item_id", "category", "topic", "ambiguous", "priority_score", F.array_join("priority_signals", ",").alias("signals"))


SQL["publish_rankings"] = f"""WITH {_AXES}, a AS (SELECT item_id, coalesce(max(value) FILTER (axis = 'method'), '') AS category, coalesce(max(value) FILTER (axis = 'topic'), '') AS topic, count(*) FILTER (axis = 'method') <> 1 OR count(*) FILTER (axis = 'topic') <> 1 AS ambiguous FROM axes GROUP BY item_id)
SELECT item_id, coalesce(category, '') AS category, coalesce(topic, '') AS topic, coalesce(ambiguous, true) AS ambiguous, CASE WHEN case_id % 3 > 0 THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS priority_score,
concat_ws(',', CASE WHEN k % 7 = 0 THEN '채점기준' END, '성취기준', '배점', CASE WHEN method <> '' THEN '평가방법' END, CASE WHEN overview <> '' THEN '평가 개요' END) AS signals FROM l JOIN orders ON case_id = o_orderkey LEFT JOIN a USING (item_id)"""


def publish_statuses(spark, sf):
    """Title basis of every case that was read."""
    cases = table(spark, sf, "orders").select(F.col("o_orderkey").alias("case_id"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("a/b."), F.col("o_orderstatus"))).alias("saved_path"))
    return publish.statuses(_parsed(spark, sf), cases)


SQL["publish_statuses"] = f"WITH {_PARSED} SELECT case_id, CASE WHEN case_id % 2 = 0 THEN lower(any_value(o_orderstatus)) ELSE 'unknown' END AS source_format, 'a:b' AS boundary_status, max(item_order) AS section_char_count, CASE WHEN bool_or(bounded) THEN 'source_detail' ELSE 'source_detail_bundle_review' END AS title_basis FROM l JOIN orders ON case_id = o_orderkey GROUP BY case_id"


def publish_refresh(spark, sf):
    """Cases with titles, methods, standards, overview and weight of their bounded items; others keep theirs."""
    cases = table(spark, sf, "orders").select(F.col("o_orderkey").alias("case_id"), F.col("o_orderpriority").alias("title"), F.lit("old").alias("overview"))
    rows = publish.refreshed(cases, _parsed(spark, sf))
    return rows.select("case_id", "title", "overview", "weight", *(F.array_join(c, "|").alias(c) for c in ("task_names", "methods", "standards")))


def _distinct(value: str, source: str = "l", at: str = "item_order") -> str:
    return f"(SELECT case_id, string_agg(v, '|' ORDER BY o) AS s, arg_min(v, o) AS f FROM (SELECT case_id, {value} AS v, min({at}) AS o FROM {source} WHERE bounded AND trim({value}) <> '' GROUP BY ALL) GROUP BY case_id)"


SQL["publish_refresh"] = f"""WITH {_PARSED}, c AS (SELECT case_id, bounded, unnest(standards) AS code, item_order * 10 + generate_subscripts(standards, 1) AS place FROM l)
SELECT o_orderkey AS case_id, coalesce(t.f, o_orderpriority) AS title, CASE WHEN t.f IS NULL THEN 'old' ELSE coalesce(v.f, '') END AS overview, CASE WHEN t.f IS NOT NULL THEN coalesce(w.f, s.f, '') END AS weight, t.s AS task_names, CASE WHEN t.f IS NOT NULL THEN coalesce(m.s, '') END AS methods, c2.s AS standards
FROM orders LEFT JOIN {_distinct('title')} t ON t.case_id = o_orderkey LEFT JOIN {_distinct('overview')} v ON v.case_id = o_orderkey LEFT JOIN {_distinct('weight')} w ON w.case_id = o_orderkey LEFT JOIN {_distinct('score')} s ON s.case_id = o_orderkey
LEFT JOIN {_distinct('method')} m ON m.case_id = o_orderkey LEFT JOIN {_distinct('code', 'c', 'place')} c2 ON c2.case_id = o_orderkey"""


def task_names(spark, sf):
    """Plans of parts in a subject's section: names right of a label, below one, behind one in a line, and in bare lines; the known ones left out."""
    k, name, kind = F.col("p_partkey"), F.col("p_name"), F.lower("p_type")
    head, foreign = F.lit("앞의 글 실험하기\n# 생명과학Ⅰ 교수학습 및 평가 계획\n"), F.concat(F.lit("\n# 물리학 교수학습 평가 운영\n"), name, F.lit(" 실험하기\n"))
    across = _markup(_row("과제명", F.concat(name, F.lit(" 관찰하기")), F.concat(kind, F.lit(" 조사하기")), "배점", "반영하지 않기"))
    below = _markup(_row("평가영역", "배점"), _row(F.concat(kind, F.lit(" 제작하기")), k))
    line = F.concat(F.lit("\n수행평가명 | "), name, F.lit(" 토론하기 | 배점\n"), kind, F.lit(" 자세히 설명하기\n"))
    text = F.concat(head, F.when(k % 2 == 0, F.concat(across, below)).otherwise(""), line, foreign)
    cases = table(spark, sf, "part").select(k.alias("id"), F.lit("생명과학Ⅰ").alias("subject"), text.alias("text"), F.when(k % 4 == 0, F.array(F.concat(F.lit("1. "), name, F.lit("  관찰하기")))).alias("seen"))
    return N.derived_names(cases).select(F.col("id").cast("long").alias("p_partkey"), F.col("rank").cast("long").alias("rank"), "name", "source")


SQL["task_names"] = """WITH p AS (SELECT p_partkey, p_name AS n, lower(p_type) AS t FROM part), c AS (
SELECT p_partkey, n || ' 관찰하기' AS name, 'table' AS source, 0 AS o FROM p WHERE p_partkey % 2 = 0 AND p_partkey % 4 <> 0 UNION ALL SELECT p_partkey, t || ' 조사하기', 'table', 1 FROM p WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, t || ' 제작하기', 'table', 2 FROM p WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, n || ' 토론하기', 'context', 3 FROM p UNION ALL SELECT p_partkey, t || ' 자세히 설명하기', 'section', 4 FROM p WHERE p_partkey % 2 = 1)
SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY source = 'section', -len(replace(name, ' ', '')), o) AS rank, name, source FROM c"""

NAMES = (*SQL,)
