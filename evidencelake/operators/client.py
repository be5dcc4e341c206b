"""Data operators of the client: choices, queues, drafts, attachments."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import unescaped

# Rating dimensions' neutral value, placeholder title, badge words.
UNREVIEWED = "unreviewed"
PLACEHOLDER = "수행평가 묶음"
SAFETY = r"실험|해부|약품|가열|칼|불꽃|산성|염기성|미생물"


def confirmed_names(primary: Column, names: Column) -> Column:
    """Distinct names, the primary first, without empty ones and the placeholder."""
    return F.filter(F.array_distinct(F.concat(F.array(primary), names)), lambda n: n.isNotNull() & (n != "") & (n != PLACEHOLDER))


def completeness(*counts: Column) -> Column:
    """How many of the markers occur."""
    return sum((F.when(F.coalesce(c, F.lit(0)) > 0, 1).otherwise(0) for c in counts), F.lit(0))


def needs_safety(*texts: Column) -> Column:
    return F.concat_ws(" ", *texts).rlike(SAFETY)


def reference_cases(cases: DataFrame, group: str, n: int = 3) -> DataFrame:
    """The first ``n`` cases of each group: titled ones if there are any (short and without bullets), one for each source."""
    titled = (F.length("title") <= 100) & (F.regexp_count("title", F.lit("[·•▪]")) < 3) & (F.col("title") != "")
    any_titled = F.max(titled.cast("int")).over(Window.partitionBy(group))
    fit = cases.withColumn("_any", any_titled).where((F.col("_any") == 0) | titled)
    source = F.when(F.coalesce("sha256", F.lit("")) != "", F.col("sha256")).otherwise(F.col("case_id"))
    once = fit.withColumn("_n", F.row_number().over(Window.partitionBy(group, source).orderBy("seq"))).where("_n = 1")
    return once.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy("seq"))).where(F.col("_n") <= n).drop("_n", "_any")


def readable_item(items: DataFrame, requested: str | None = None) -> DataFrame:
    """One item of each case: the requested one, else the first with a source, else the first."""
    rank = F.when(F.col("item_id") == (requested or ""), 0).when(F.col("source_available"), 1).otherwise(2)
    return items.withColumn("_n", F.row_number().over(Window.partitionBy("case_id").orderBy(rank, "item_order"))).where("_n = 1").drop("_n")


def batch_lookup(table: DataFrame, ids: Sequence[str], key: str, most: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted ids (distinct, valid, at most so many) and the ids that are missing."""
    wanted = list(dict.fromkeys(i for i in ids if i))[:most]
    if not wanted:
        return table.limit(0), table.select(key).limit(0)
    frame = table.sparkSession.createDataFrame([(i,) for i in wanted], f"{key} string")
    return table.where(F.col(key).isin(*wanted)), frame.join(table, key, "left_anti")


def comparison(items: DataFrame, key: str, attributes: Sequence[str], ids: Sequence) -> DataFrame:
    """Attributes as rows, at most four items as columns."""
    ids = list(dict.fromkeys(ids))[:4]
    long = items.where(F.col(key).isin(*ids)).select(key, *(F.col(a).cast("string").alias(a) for a in attributes)).unpivot([key], list(attributes), "attribute", "value")
    wide = long.groupBy("attribute").pivot(key, ids).agg(F.first("value"))
    return wide.select("attribute", *(F.col(f"`{i}`").alias(f"item_{k}") for k, i in enumerate(ids, 1)))


def reviewed(queue: DataFrame, most: int = 25) -> DataFrame:
    """A review queue of at most so many valid, distinct ids, with the number of rated dimensions; notes cut to 2,000 characters."""
    valid = queue.where(F.col("case_id").rlike(r"^[0-9a-f]{24}\z"))
    once = valid.withColumn("_n", F.row_number().over(Window.partitionBy("case_id").orderBy("seq"))).where("_n = 1")
    kept = once.drop("_n").orderBy("seq").limit(most)
    return kept.withColumn("note", F.left("note", F.lit(2000))).withColumn("rated", F.size(F.map_filter("ratings", lambda _, v: v != UNREVIEWED)))


def allocate(total: Column, weight: Column, index: Column, group: Column) -> Column:
    """Points of a criterion: the floor of its share, and one more for the first ones until the total is reached."""
    floors = F.floor(total * weight / 100)
    left = total - F.sum(floors).over(Window.partitionBy(group))
    return floors + F.when(index < left, 1).otherwise(0)


def lesson_range(lessons: Column, phases: int, index: Column) -> tuple[Column, Column]:
    """First and last lesson of a phase when lessons are shared out evenly, earlier phases first."""
    start = F.floor(lessons * index / phases)
    end = F.floor(lessons * (index + 1) / phases)
    return start + 1, F.greatest(start + 1, end)


def draft(designs: DataFrame, patterns: DataFrame) -> DataFrame:
    """Criteria of design drafts: pattern (with criteria: array of (name, weight)) by key, points shared out."""
    rows = designs.join(patterns, "pattern").select("design_id", "pattern", "points", "lessons", F.posexplode("criteria").alias("idx", "c"))
    return rows.select("design_id", "pattern", "idx", F.col("c.name").alias("criterion"), allocate(F.col("points"), F.col("c.weight"), F.col("idx"), F.col("design_id")).alias("points"))


def attachment_names(attachments: DataFrame, links: DataFrame) -> DataFrame:
    """Names of attachments (page_id, seq, pos) from links (page_id, seq, pos, name): by sequence, else by position."""
    by_seq = links.where("seq IS NOT NULL").groupBy("page_id", "seq").agg(F.min_by("name", "pos").alias("by_seq"))
    by_pos = links.select("page_id", "pos", F.col("name").alias("by_pos"))
    return attachments.join(by_seq, ["page_id", "seq"], "left").join(by_pos, ["page_id", "pos"], "left").withColumn("name", F.coalesce("by_seq", "by_pos", F.lit(""))).drop("by_seq", "by_pos")


def matched_schools(rows: DataFrame, schools: DataFrame) -> DataFrame:
    """The first school of the row's code whose office agrees, where the row names one."""
    s = schools.select(F.col("school_code").alias("_code"), F.col("office_code").alias("_office"), "school_name", F.col("seq").alias("_seq"))
    office = F.coalesce("office_code", F.lit(""))
    both = rows.join(s, (F.col("school_code") == F.col("_code")) & ((office == "") | (office == F.col("_office"))), "left")
    return both.withColumn("_n", F.row_number().over(Window.partitionBy("row_id").orderBy("_seq"))).where("_n = 1").drop("_n", "_code", "_office", "_seq")


def form_links(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, pos, href, label, params) of a page's links: parameters are hidden inputs, overridden by those of the link."""
    pick = lambda pattern, g: F.regexp_extract_all(html_col, F.lit(pattern), g)
    hidden = r'<input[^>]*type="hidden"[^>]*name="([^"]*)"[^>]*value="([^"]*)"[^>]*>'
    link = r'<a href="([^"]*)"[^>]*>([^<]*)</a>'
    base = F.aggregate(F.arrays_zip(pick(hidden, 1).alias("k"), pick(hidden, 2).alias("v")), F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != x["k"]), F.create_map(x["k"], x["v"])))
    rows = pages.select(F.col(id_col).alias("id"), base.alias("hidden"), F.posexplode(F.arrays_zip(pick(link, 1).alias("href"), pick(link, 2).alias("label"))).alias("pos", "l"))
    query = F.when(F.contains("l.href", F.lit("?")), F.str_to_map(F.split_part("l.href", F.lit("?"), F.lit(2)), F.lit("&"), F.lit("="))).otherwise(F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter("hidden", lambda k, _: ~F.map_contains_key(query, k)), query)
    return rows.select("id", "pos", F.col("l.href").alias("href"), F.col("l.label").alias("label"), merged.alias("params"))


# The download servlet, the class and call of file links, the parameter of a file's number, the size behind a name.
SERVLET, FILE_SEQ = "EiFileDownLoad.do", "FILE_SEQ"
FILE_LINK = r"""(?is)<a\b[^>]*class=["'][^"']*\bfile_name\b[^"']*["'][^>]*>.*?</a>"""
SEQ_CALL = r"getEiFile\d+\('([^']+)'\)"
SIZE_SUFFIX = r"\([0-9,]+\s*KB\)\s*\z"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, at however many places ``use`` has it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merged(*maps: Column) -> Column:
    """One map; of a key that several maps have the last map's value counts."""
    return reduce(lambda a, b: bound(b, lambda m: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(m, k)), m)), maps)


def last_wins(entries: Column) -> Column:
    """A map of (key, value) structs in which a repeated key has its last value."""
    return bound(entries, lambda all_: F.map_from_entries(F.filter(all_, lambda e, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda later: later["key"] == e["key"]))))


def decoded(text: Column) -> Column:
    """Without entities; they are sought in a text with an ampersand only."""
    return bound(text, lambda t: F.when(F.contains(t, F.lit("&")), unescaped(t)).otherwise(t))


def hidden_inputs(html: Column) -> Column:
    """Names and values of a form's inputs."""
    tags = F.regexp_extract_all(html, F.lit(r"""(?i)<input[^>]+name=["'][^"']+["'][^>]*value=["'][^"']*["']"""), 0)
    value = lambda tag, name: F.regexp_extract(tag, rf"""(?i).*\b{name}=["']([^"']*)["']""", 1)
    return last_wins(F.transform(tags, lambda t: F.struct(F.regexp_extract(t, r"""(?i)name=["']([^"']+)["']""", 1).alias("key"), decoded(value(t, "value")).alias("value"))))


def query_of(url: Column) -> Column:
    """Parameters of a url that have a value, decoded; of a repeated one the last."""
    text = F.split_part(F.split_part(url, F.lit("#"), F.lit(1)), F.lit("?"), F.lit(2))
    pairs = F.filter(F.split(text, "&"), lambda p: p.rlike("^[^=]*=."))
    unquoted = lambda c: bound(c, lambda x: F.coalesce(F.try_url_decode(x), x))
    return last_wins(F.transform(pairs, lambda p: F.struct(unquoted(F.substring_index(p, "=", 1)).alias("key"), unquoted(F.substr(p, F.instr(p, "=") + 1)).alias("value"))))


def attachments(pages: DataFrame, id_col: str, html_col: str, defaults: dict[str, str] | None = None, unnamed: str = "attachment_") -> DataFrame:
    """(id, pos, seq, name, params) of the files that a page offers, in order.

    First file links that call for a number; their name is their text without its
    size. Then links to the download servlet whose number has not been seen,
    named by the text of the link of the same place. Parameters are the defaults,
    overridden by the form's inputs, overridden by those of the link. A link
    without query is left out unless the form names a file. A null page has none.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    base = F.create_map(*(F.lit(x) for kv in (defaults or {}).items() for x in kv)).cast("map<string,string>") if defaults else F.create_map().cast("map<string,string>")
    text = lambda c: F.trim(F.regexp_replace(decoded(F.regexp_replace(c, "<[^>]+>", " ")), r"(?U)\s+", " "))
    servlet = SERVLET.replace(".", r"\.")
    hrefs = F.regexp_extract_all(html, F.lit(rf"""(?i)(?:href|action)=["']([^"']*{servlet}[^"']*)["']"""), 1)
    texts = F.transform(F.regexp_extract_all(html, F.lit(rf"""(?is)<a[^>]+(?:href|onclick)=["'][^"']*{servlet}[^"']*["'][^>]*>(.*?)</a>"""), 1), text)
    read = pages.select(F.col(id_col).alias("id"), merged(base, hidden_inputs(html)).alias("hidden"), F.regexp_extract_all(html, F.lit(FILE_LINK), 0).alias("anchors"), hrefs.alias("hrefs"), texts.alias("texts"))
    numbered = F.filter(F.transform("anchors", lambda a: F.struct(F.regexp_extract(a, SEQ_CALL, 1).alias("seq"), F.trim(F.regexp_replace(text(a), SIZE_SUFFIX, "")).alias("name"))), lambda a: a["seq"] != "")
    own = F.transform(numbered, lambda a: F.struct(a["seq"].alias("seq"), a["name"].alias("name"), merged(F.col("hidden"), F.create_map(F.lit(FILE_SEQ), a["seq"])).alias("params")))
    queried = F.transform(F.transform("hrefs", decoded), lambda u, i: F.struct(query_of(u).alias("query"), F.contains(u, F.lit("?")).alias("asked"), i.alias("i")))
    linked = F.transform(queried, lambda q: F.struct(q["asked"].alias("asked"), q["i"].alias("i"), merged(F.col("hidden"), q["query"]).alias("params")))
    named = F.transform(linked, lambda q: F.struct(F.coalesce(F.nullif(F.try_element_at(q["params"], F.lit(FILE_SEQ)), F.lit("")), (q["i"] + 1).cast("string")).alias("seq"), F.coalesce(F.get("texts", q["i"]), F.lit("")).alias("name"), q["params"].alias("params"), (q["asked"] | (F.coalesce(F.try_element_at(q["params"], F.lit(FILE_SEQ)), F.lit("")) != "")).alias("usable")))
    rows = read.select("id", own.alias("own"), F.filter(named, lambda q: q["usable"]).alias("named"))
    fresh = bound(F.transform("named", lambda x: x["seq"]), lambda seqs: F.filter("named", lambda q, i: ~F.exists("own", lambda o: o["seq"] == q["seq"]) & (F.array_position(seqs, q["seq"]) == i + 1)))
    every = F.concat("own", F.transform(fresh, lambda q: F.struct(q["seq"].alias("seq"), q["name"].alias("name"), q["params"].alias("params"))))
    out = rows.select("id", F.posexplode(every).alias("pos", "a")).select("id", "pos", "a.*")
    return out.withColumn("name", F.when(F.col("name") == "", F.concat(F.lit(unnamed), "seq")).otherwise(F.col("name")))
