"""Queries of operators with state, documents or markup over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import repair, sections
from ..functions import text as T
from ..operators import client, drafts
from ..sources import staged
from ..rules import DRIVER
from ..session import spread, table
from ..streaming import limiter
from . import evidence

SQL = {}


def rate_limit(spark, sf):
    """Hits of each user that a limit of 3 an hour accepts and rejects, with feedback of decisions."""
    return limiter.limited(table(spark, sf, "events"), "user_id", "ts", "event_id", 3, 3600.0)


# the third last accepted time decides, so a list of at most three is the state of a user
SQL["rate_limit"] = """WITH RECURSIVE h AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
w AS (SELECT user_id, event_id, k, true AS accepted, [t] AS held FROM h WHERE k = 1 UNION ALL
SELECT user_id, event_id, k, ok, CASE WHEN ok THEN list_append(held, t)[-3:] ELSE held END FROM (SELECT h.*, w.held, len(w.held) < 3 OR w.held[1] <= h.t - 3600 AS ok FROM w JOIN h ON h.user_id = w.user_id AND h.k = w.k + 1))
SELECT user_id, event_id, accepted FROM w"""


def _places(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy("r_name").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n"))


def parse_section(spark, sf):
    """A plan for each region, its nations as tasks, parsed back into items."""
    head = "# 생명과학Ⅰ\n## 수행평가 세부 계획\n| 평가영역 | 평가방법 | 반영비율 |\n|---|---|---|\n"
    rows = F.array_join(F.transform("n", lambda x: F.concat(F.lit("| "), x["n_name"], F.lit(" report | 보고서 | "), x["n_nationkey"] + 10, F.lit("% |"))), "\n")
    cases = _places(spark, sf).select(F.col("r_name").alias("case_id"), F.lit("생명과학Ⅰ").alias("subject"), F.concat(F.lit(head), rows).alias("text"))
    return sections.parsed_items(cases).select("case_id", F.col("item_order").cast("long").alias("item_order"), "title", "method", "weight", "extraction_status", "boundary_status")


SQL["parse_section"] = """SELECT r_name AS case_id, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS item_order, n_name || ' report' AS title, '보고서' AS method, (n_nationkey + 10) || '%' AS weight, 'bounded' AS extraction_status, 'subject_heading_exact:assessment_anchor' AS boundary_status
FROM nation JOIN region ON n_regionkey = r_regionkey"""


def repair_html(spark, sf):
    """Each region's nations in tables of one row under the same header, joined again."""
    one = lambda x: F.concat(F.lit("<table><tr><th>평가영역</th><th>배점</th></tr><tr><td>"), x["n_name"], F.lit("</td><td>1</td></tr></table>"))
    made = _places(spark, sf).select("r_name", F.array_join(F.transform("n", one), "\n").alias("html"))
    fixed = made.select("r_name", repair.repaired()("html").alias("r"))
    return fixed.select("r_name", F.regexp_count("r.html", F.lit("<table>")).cast("long").alias("tables"), F.regexp_count("r.html", F.lit("<tr>")).cast("long").alias("rows"), F.col("r.merged_headers").cast("long").alias("merged"))


SQL["repair_html"] = "SELECT r_name, 1::BIGINT AS tables, count(*) + 1 AS rows, count(*) - 1 AS merged FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"


def staged_stream(spark, sf):
    """Customers as lines of one compressed stream in parts of 4 kB, unpacked again; parts that their manifest knows."""
    c = table(spark, sf, "customer").select("c_custkey", F.to_json(F.struct("c_custkey", "c_name", "c_mktsegment")).alias("line"))
    parts = staged.parts_of(c, "line", ["c_custkey"], part_bytes=4096, member_bytes=8192)
    faults = staged.broken(parts, staged.manifest_of(parts)).select("chunk", "part")
    return staged.lines_of(parts.join(faults, ["chunk", "part"], "left_anti")).select(F.get_json_object("line", "$.c_custkey").cast("long").alias("c_custkey"), "line")


SQL["staged_stream"] = """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS line FROM customer"""


def page_safety(spark, sf):
    """Whether scripts are left in repaired pages."""
    p = table(spark, sf, "pages").select("page_id", F.contains("html", F.lit("<script")).alias("had_script"), repair.safe_markup("html").alias("c"))
    return p.select("page_id", "had_script", F.contains("c", F.lit("<script")).alias("has_script"))


SQL["page_safety"] = r"SELECT page_id, contains(html, '<script') AS had_script, contains(regexp_replace(html, '(?is)<(?:script|iframe|object|embed)\b.*?(?:</(?:script|iframe|object|embed)\s*>|/>|\z)', '', 'g'), '<script') AS has_script FROM pages"


def page_links(spark, sf):
    """Links of pages with their parameters."""
    got = client.form_links(table(spark, sf, "pages"), "page_id", "html")
    return got.select(F.col("id").alias("page_id"), F.col("pos").cast("long").alias("pos"), "href", "label", F.size("params").cast("long").alias("n_params"))


_LINK = """'<a href="([^"]*)"[^>]*>([^<]*)</a>'"""
SQL["page_links"] = f"SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS BIGINT) AS pos, unnest(h) AS href, unnest(t) AS label, 0::BIGINT AS n_params FROM (SELECT page_id, regexp_extract_all(html, {_LINK}, 1) AS h, regexp_extract_all(html, {_LINK}, 2) AS t FROM pages)"


def _documents(spark, sf):
    d = table(spark, sf, "documents")
    source = F.struct(*(F.lit("").alias(c) if c not in ("school_code", "saved_path") else F.col("source" if c == "school_code" else "doc_id").cast("string").alias(c) for c in ("saved_path", "final_url", "source_url", "school_code", "school_name", "candidate_name", "match_type", "subject_canonical")))
    return d.select(F.col("doc_id").alias("seq"), source.alias("source"), F.sha2("text", 256).alias("sha256"), F.when(F.col("n_chars") < 200, "short").otherwise("ok").alias("extract_status"), F.col("n_chars").alias("char_count"), "text", F.lit(None).cast("array<struct<subject:string,curriculum_hint:string>>").alias("subject_hits"))


def evidence_index(spark, sf):
    """Evidence records of all documents with the driver's vocabulary."""
    return evidence.evidence_records(_documents(spark, sf), DRIVER).select("seq", "subject", "curriculum_hint", "section_method", "section_chars", F.concat_ws(",", "action_tags").alias("tags"), "evidence_score", F.sha2("evidence_text", 256).alias("evidence_sha256"))


def _offsets(name: str, rows: str, text: str, word: str, key: str) -> str:
    """A table of the offsets (from 0) of a word in a text, by splitting at it."""
    return f"{name} AS (SELECT {key}, CAST(sum(len(part) + {len(word)}) OVER (PARTITION BY {key} ORDER BY i) - {len(word)} AS BIGINT) AS pos, i, n FROM (SELECT {key}, unnest(parts) AS part, generate_subscripts(parts, 1) AS i, len(parts) AS n FROM (SELECT {key}, string_split({text}, '{word}') AS parts FROM {rows})) QUALIFY i < n)"


def _evidence_sql() -> str:
    """Places, sections, windows, tags and scores in SQL, for a pack without course headers, boxes and headings of tasks."""
    hit = " UNION ALL ".join(f"SELECT seq, '{c}' AS curriculum_hint, '{s}' AS subject, pos, {len(p)} AS size FROM at_{s}" for c, s, p in DRIVER.subject_patterns)
    places = ",\n".join(_offsets(f"at_{s}", "d", "lower(t)", p, "seq") for _, s, p in DRIVER.subject_patterns)
    words = {"license": ("replace(local, 'License', 'license')", "license"), "table": ("local", "|"), "shout": ("local", "!!")}
    tag_places = ",\n".join(_offsets(f"tag_{k}", "e", text, word, "id") for k, (text, word) in words.items())
    near = "bool_or(contains(lower(substr(local, greatest(pos - 320, 0) + 1, pos + {n} + 320 - greatest(pos - 320, 0))), 'the'))"
    tags = " UNION ALL ".join(f"SELECT id, '{k}' AS tag, {i} AS o FROM tag_{k} JOIN e USING (id) GROUP BY id HAVING {near.format(n=len(words[k][1]))}" for i, k in enumerate(DRIVER.action_tags))
    score = " + ".join(f"least(len(regexp_extract_all(local, '{DRIVER.markers[m]}')), {cap}) * {w}" for m, cap, w in DRIVER.score_caps)
    mask, to = DRIVER.masks[0]
    return f"""WITH d AS (SELECT doc_id AS seq, regexp_replace(coalesce(text, ''), '{mask}', '{to}', 'g') AS t, n_chars FROM documents),
{places},
c AS ({hit}),
{_offsets("anchor", "d", "lower(t)", DRIVER.anchors, "seq")},
r AS (SELECT c.*, regexp_matches(regexp_extract(substr(t, 1, c.pos), '[^\n]*$') || regexp_extract(substr(t, c.pos + 1), '^[^\n]*'), '^\\s*#{{1,6}}|과목|교과') AS labelled, (SELECT count(*) FROM anchor a WHERE a.seq = c.seq AND abs(a.pos - c.pos) <= 4500) AS near FROM c JOIN d USING (seq)),
b AS (SELECT seq, subject, curriculum_hint, pos FROM r QUALIFY row_number() OVER (PARTITION BY seq, subject ORDER BY labelled DESC, near DESC, pos) = 1),
e AS (SELECT seq || '/' || subject AS id, seq, subject, curriculum_hint, n_chars, pos - greatest(pos - 3500, 0) AS place, substr(t, greatest(pos - 3500, 0) + 1, pos + 12000 - greatest(pos - 3500, 0)) AS local FROM b JOIN d USING (seq)),
{tag_places},
g AS (SELECT id, string_agg(tag, ',' ORDER BY o) AS tags, count(*) AS n_tags FROM ({tags}) GROUP BY id)
SELECT seq, subject, curriculum_hint, 'bounded_window' AS section_method, CAST(len(local) AS INTEGER) AS section_chars, coalesce(tags, '') AS tags, CAST({score} + least(coalesce(n_tags, 0), 5) - CASE WHEN n_chars < 200 THEN 8 ELSE 0 END AS INTEGER) AS evidence_score,
sha256(regexp_replace(substr(local, greatest(place - 650, 0) + 1, place + 650 - greatest(place - 650, 0)), '^\\s+|\\s+$', '', 'g')) AS evidence_sha256 FROM e LEFT JOIN g USING (id)"""


SQL["evidence_index"] = _evidence_sql()


def section_counts(spark, sf):
    """Records of each subject and bucket; SQL counts pattern hits."""
    return evidence.evidence_records(_documents(spark, sf), DRIVER).groupBy("curriculum_hint", "subject").agg(F.count("*").alias("records"))


SQL["section_counts"] = "SELECT curriculum_hint, subject, count(*) AS records FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS curriculum_hint, '{s}' AS subject FROM documents WHERE regexp_matches(text, '(?i){p}')" for c, s, p in DRIVER.subject_patterns) + ") GROUP BY ALL"


def boundary_grades(spark, sf):
    """Grades of made-up boundary statuses of orders."""
    status = F.concat_ws(":", F.when(F.col("o_orderkey") % 3 == 0, "subject_heading_not_found").otherwise("subject_heading"), F.when(F.col("o_orderkey") % 2 == 0, "assessment_anchor_not_found").otherwise("assessment_anchor"))
    return table(spark, sf, "orders").groupBy(T.boundary_grade(status).alias("grade")).agg(F.count("*").alias("orders"))


SQL["boundary_grades"] = "SELECT CASE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) WHEN 0 THEN 'trusted' WHEN 1 THEN 'partial' ELSE 'untrusted' END AS grade, count(*) AS orders FROM orders GROUP BY 1"


def draft_points(spark, sf):
    """Points of drafts (customers) over a pattern's criteria."""
    designs = table(spark, sf, "customer").select(F.col("c_custkey").alias("design_id"), F.lit("p").alias("pattern"), (F.col("c_custkey") % 89 + 5).alias("points"), F.lit(7).alias("lessons"))
    patterns = spark.createDataFrame([("p", [("a", 45), ("b", 35), ("c", 20)])], "pattern string, criteria array<struct<name:string,weight:int>>")
    return client.draft(designs, patterns).select("design_id", "criterion", "points")


SQL["draft_points"] = """WITH c AS (SELECT c_custkey AS design_id, c_custkey % 89 + 5 AS total, unnest([0, 1, 2]) AS idx, unnest(['a', 'b', 'c']) AS criterion, unnest([45, 35, 20]) AS weight FROM customer), f AS (SELECT *, total * weight // 100 AS p FROM c)
SELECT design_id, criterion, CAST(p + CASE WHEN idx < total - sum(p) OVER (PARTITION BY design_id) THEN 1 ELSE 0 END AS BIGINT) AS points FROM f"""


def attachments(spark, sf):
    """Forms made of orders: odd lines as numbered file links, even ones as links to the servlet, of which numbers seen before are left out."""
    l = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))  # noqa: E741
    lines = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    n, part = (lambda x: x["l_linenumber"]), (lambda x: x["l_partkey"].cast("string"))
    numbered = lambda x: F.concat(F.lit("<a class='file_name' onclick=\"getEiFile1('"), n(x), F.lit("')\">"), part(x), F.lit(".hwp (1,024 KB)</a>"))
    linked = lambda x: F.concat(F.lit('<a href="/EiFileDownLoad.do?FILE_SEQ='), n(x) - n(x) % 3, F.lit("&amp;P="), part(x), F.lit('">n&amp;'), part(x), F.lit("</a>"))
    html = F.concat(F.lit('<input type="hidden" name="K" value="'), F.col("l_orderkey"), F.lit('"><input type="hidden" name="P" value="none">'), F.array_join(F.transform("l", lambda x: F.when(n(x) % 2 == 1, numbered(x)).otherwise(linked(x))), " "))
    found = client.attachments(lines.select("l_orderkey", html.alias("html")), "l_orderkey", "html", {"Y": "2024", "K": "0"})
    of = lambda k: F.col("params").getItem(k)
    return found.select(F.col("id").alias("l_orderkey"), F.col("pos").cast("long").alias("pos"), "seq", "name", of("K").alias("k"), of("P").alias("p"), of("Y").alias("y"), of("FILE_SEQ").alias("file_seq"))


SQL["attachments"] = """WITH l AS (SELECT l_orderkey, l_linenumber AS n, min(l_partkey) AS part FROM lineitem GROUP BY ALL),
a AS (SELECT l_orderkey, 0 AS kind, n AS o, n AS seq, part || '.hwp' AS name, 'none' AS p FROM l WHERE n % 2 = 1
UNION ALL SELECT l_orderkey, 1, n, n - n % 3, 'n&' || part, part::VARCHAR FROM l WHERE n % 2 = 0 AND NOT EXISTS (SELECT 1 FROM l m WHERE m.l_orderkey = l.l_orderkey AND m.n % 2 = 1 AND m.n = l.n - l.n % 3) QUALIFY row_number() OVER (PARTITION BY l_orderkey, n - n % 3 ORDER BY n) = 1)
SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY kind, o) - 1 AS pos, seq::VARCHAR AS seq, name, l_orderkey::VARCHAR AS k, p, '2024' AS y, seq::VARCHAR AS file_seq FROM a"""


def draft_text(spark, sf):
    """Drafts of customers' designs as text."""
    key = F.col("c_custkey")
    designs = table(spark, sf, "customer").select(
        key.alias("design_id"), F.lit("p").alias("pattern"), F.when(key % 3 > 0, F.col("c_mktsegment")).alias("topic"), F.col("c_name").alias("subject"), F.lit("2022").alias("curriculum"), (key % 3 + 1).alias("grade"), (key % 2 + 1).alias("semester"),
        (key % 9 + 1).alias("lessons"), (key % 89 + 5).alias("points"), F.lit("모둠").alias("collaboration"), F.when(key % 2 == 0, drafts.NO_AI).otherwise("허용").alias("ai_policy"),
    )
    kind = "pattern string, label string, product string, method_phrase string, phases array<struct<title:string,evidence:string>>, criteria array<struct<label:string,weight:int,focus:string>>"
    patterns = spark.createDataFrame([("p", "탐구", "보고서", "탐구합니다", [("설계", "계획"), ("수행", "기록")], [("가", 45, "하나"), ("나", 35, "둘"), ("다", 20, "셋")])], kind)
    return drafts.as_text(drafts.drafts(designs, F.broadcast(patterns)))


def _draft_sql() -> str:
    points = [f"total * {w} // 100" for w in (45, 35, 20)]
    left = "total - (" + " + ".join(points) + ")"
    shown = [f"({p} + CASE WHEN {i} < {left} THEN 1 ELSE 0 END)" for i, p in enumerate(points)]
    lesson = lambda a, b: f"(CASE WHEN {a} >= {b} THEN {a} || '차시' ELSE {a} || '–' || {b} || '차시' END)"
    half = "(lessons // 2)"
    brief = drafts.BRIEF.replace("'", "''").split("%s")
    fair = "- " + "\n- ".join(drafts.FAIRNESS).replace("%s", "모둠")
    bodies = (
        "'- 2022 개정 ' || c_name || '\n- ' || grade || '학년 ' || (c_custkey % 2 + 1) || '학기 · ' || lessons || '차시 · 모둠\n- 총 ' || total || '점'", f"'{drafts.NO_STANDARDS}'", f"'{drafts.SOURCE_CHECK}'",
        f"'{brief[0]}' || grade || '{brief[1]}' || c_name || '{brief[2]}' || topic || '{brief[3]}탐구합니다{brief[4]}모둠{brief[5]}'", "'보고서'",
        f"'- ' || {lesson('1', f'greatest(1, {half})')} || ' 설계: 계획\n- ' || {lesson(f'({half} + 1)', 'lessons')} || ' 수행: 기록'",
        " || '\n' || ".join(f"'- {n} (' || {p} || '점): {f}'" for n, p, f in zip("가나다", shown, ("하나", "둘", "셋"), strict=True)),
        f"CASE WHEN c_custkey % 2 = 0 THEN '{drafts.GUIDANCE[drafts.NO_AI]}' ELSE '{drafts.OTHER_GUIDANCE}' END", f"'{fair}'",
    )
    text = " || ".join(["topic || ' — 탐구'", *(f"'\n\n[{name}]\n' || ({body})" for name, body in zip(drafts.SECTIONS, bodies, strict=True))])
    return f"SELECT c_custkey AS design_id, {text} AS text FROM (SELECT *, c_custkey % 3 + 1 AS grade, c_custkey % 9 + 1 AS lessons, c_custkey % 89 + 5 AS total, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '{drafts.NO_TOPIC}' END AS topic FROM customer)"


SQL["draft_text"] = _draft_sql()

NAMES = [*SQL]
