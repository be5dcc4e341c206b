"""Assessment items from the tables of plans, as joins and groupings of table rows.

``table_rows`` reads the tables of all texts once, in Arrow batches; all rules
work on its rows (case, table, row and the row's cells) with DataFrame
operations, grouped by case and table, so one plan's tables are spread like any
others. Several rules read the same rows: a caller that uses them takes them from
``shared_rows`` (Spark spills them to disk and makes lost ones again). What differs between domains is a ``PlanWords``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import headings as H
from ..functions import markup as M
from ..functions import sections
from ..plan_words import CODE_SHAPE, CODE_SIGNS, GRADED, PLANS, RELIABLE, PlanWords
from ..rules import PLANS_KO, RulePack
from ..session import spread

ROWS = "case_id string, subject string, status string, inside boolean, table_no int, start int, stop int, row_no int, cells array<struct<text: string, key: string>>"
#: The columns of ``ROWS`` before the cells.
HEAD = {"case_id": pa.string(), "subject": pa.string(), "status": pa.string(), "inside": pa.bool_(), "table_no": pa.int32(), "start": pa.int32(), "stop": pa.int32(), "row_no": pa.int32()}
#: Texts whose rows are held at once.
TEXTS = 500
TABLE = ("case_id", "table_no")
#: Rows of a table in which a title's label may stand.
LABEL_ROWS = 8
FIELDS = ("overview", "method", "timing", "weight", "score")
#: Longest joined value of a field, in compact signs.
CAPS = {"timing": 40, "method": 120, "overview": 600}
ITEM = ("case_id", "title", "title_raw", "label", "table_no", "start", "stop", *FIELDS, "standards")
#: Where items come from, in the order in which equal titles count.
PROVENANCE = ("heading", "table", "local", "hinted", "code", "bundle")


def table_rows(cases: DataFrame, rules: RulePack = PLANS_KO) -> DataFrame:
    """The rows of all tables of (case_id, subject, text), with the status of the subject's part and whether a table stands in it. Null texts have none."""

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        heads, ends, texts, keys = [], [0], [], []
        for case_id, subject, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            spans = M.table_spans(text or "")
            if not spans:
                continue
            begin, end, status = sections.subject_span(text, subject or "", rules)
            for number, (start, stop, fragment) in enumerate(spans):
                for k, row in enumerate(M.any_grid(fragment)):
                    shown = [M.visible_text(c) for c in row]
                    texts += shown
                    keys += map(sections.compact, shown)
                    ends.append(len(texts))
                    heads.append((case_id, subject, status, begin <= start < end, number, start, stop, k))
        cells = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(keys, pa.string())], ["text", "key"])
        columns = zip(*heads, strict=True) if heads else [()] * len(HEAD)
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, HEAD.values(), strict=True)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)], [*HEAD, "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (read(batch.slice(at, TEXTS)) for at in range(0, batch.num_rows, TEXTS))

    texts = cases.select(F.col("case_id").cast("string"), F.col("subject").cast("string"), F.col("text").cast("string"))
    return spread(texts, "case_id").mapInArrow(run, ROWS)


def shared_rows(cases: DataFrame, rules: RulePack = PLANS_KO) -> DataFrame:
    """``table_rows`` for several rules: read once, dealt by table, so that what is grouped by table is not shuffled again, and persisted.

    Stages that ask for persisted rows at the same time would each make them; behind a shuffle they are made by one.
    """
    return spread(table_rows(cases, rules), *TABLE).persist()


def is_label(key: Column, words: PlanWords = PLANS) -> Column:
    """Whether a cell names a field, a column or a title and holds no value."""
    return key.isin(*words.labels(), *words.column_labels) | H.hits(key, "whole", words.stop_label) | H.hits(key, "whole", words.title_label)


def label_cells(rows: DataFrame, words: PlanWords = PLANS) -> DataFrame:
    """Every cell that names a title, with the next filled cell of its row (``answer``, null if there is none) and whether that answers it.

    The same words head columns and name single values. A row whose next filled
    cell is no label has answered itself; one whose next cell is a label, or
    that has none, is a header or leaves the value to the cells below.
    """
    at = rows.select("*", F.posexplode("cells").alias("col_no", "cell")).where(H.hits(F.col("cell.key"), "whole", words.title_label))
    after = F.filter(F.slice("cells", F.col("col_no") + 2, F.greatest(F.size("cells"), F.lit(1))), lambda c: c["key"] != "")
    answer = F.get(after, F.lit(0))
    return at.select(*rows.columns, "col_no", F.col("cell.key").alias("label"), answer.alias("answer"), F.coalesce(~is_label(answer["key"], words), F.lit(False)).alias("answered"))


def value_of(text: Column, words: PlanWords = PLANS) -> Column:
    """A cell's text up to a score or term that is glued to it."""
    return F.regexp_replace(F.get(F.split(text, f"(?U){words.value_tail}", 2), F.lit(0)), r"^[ |]+|[ |]+$", "")


def usable(text: Column, words: PlanWords = PLANS) -> Column:
    """Whether a cell may name a task."""
    key = H.compact(text)
    return F.length(key).between(2, 120) & ~key.rlike(r"^(?:10|12)[0-9A-Za-z가-힣ⅠⅡ]") & ~H.hits(key, "whole", words.stop_label) & ~H.hits(key, "whole", words.title_label) & ~H.is_structural(text) & H.is_plan_title(text)


def table_titles(rows: DataFrame, words: PlanWords = PLANS) -> DataFrame:
    """(case_id, table_no, title, label): the task that a table names, at most one for each table.

    In the first rows, from the left: a label's answer to its right; or, if
    nothing stands right of the label, the only usable value of its column
    below. Else the first value below an area header whose row also names
    criteria and points.
    """
    labels = label_cells(rows.where(F.col("row_no") < LABEL_ROWS), words).select(*TABLE, "row_no", "col_no", "label", "answer")
    across = labels.where("answer is not null").select(*TABLE, F.struct(F.lit(0).alias("kind"), "row_no", "col_no").alias("rank"), value_of(F.col("answer.text"), words).alias("title"), "label", F.col("answer.key").alias("key"))
    across = across.where(~H.hits(F.col("key"), "whole", words.stop_label) & ~H.hits(F.col("key"), "whole", words.title_label)).drop("key")
    cells = rows.select(*TABLE, F.col("row_no").alias("below"), F.posexplode("cells").alias("col_no", "cell")).select(*TABLE, "below", "col_no", value_of(F.col("cell.text"), words).alias("title"))
    down = labels.where("answer is null").drop("answer").join(cells, [*TABLE, "col_no"]).where("below > row_no").where(usable(F.col("title"), words))
    down = down.groupBy(*TABLE, "row_no", "col_no", "label").agg(F.min_by("title", "below").alias("title"), F.count_distinct(H.compact(F.col("title"))).alias("n")).where("n = 1")
    down = down.select(*TABLE, F.struct(F.lit(0).alias("kind"), "row_no", "col_no").alias("rank"), "title", "label")
    first, rest = F.get("cells", F.lit(0)), F.slice("cells", 2, F.greatest(F.size("cells"), F.lit(1)))
    support = F.size(F.filter(rest, lambda c: H.any_of([F.contains(c["key"], F.lit(w)) for w in words.area_support])))
    areas = rows.where(first["key"].isin(*words.area_labels) & (support >= 2)).select(*TABLE, F.col("row_no").alias("head"), first["key"].alias("label"))
    under = areas.join(rows.select(*TABLE, "row_no", value_of(first["text"], words).alias("title")), [*TABLE]).where("row_no > head and title <> ''")
    under = under.groupBy(*TABLE, "head", "label").agg(F.min_by("title", "row_no").alias("title"))
    under = under.select(*TABLE, F.struct(F.lit(1).alias("kind"), F.col("head").alias("row_no"), F.lit(0).alias("col_no")).alias("rank"), "title", "label")
    found = across.where(usable(F.col("title"), words)).unionByName(down).unionByName(under.where(usable(F.col("title"), words)))
    return found.groupBy(*TABLE).agg(F.min_by(F.struct("title", "label"), "rank").alias("best")).select(*TABLE, "best.title", "best.label")


def table_facts(rows: DataFrame, words: PlanWords = PLANS) -> DataFrame:
    """One row for each table: its places, how its codes stand to the subject (``alignment``), its labels as evidence, and its standards.

    ``expected``: it has codes and all are the subject's; ``other``: a code of
    another subject, or codes that do not confirm this one; ``unknown``: none.
    """
    text = F.array_join(F.transform("cells", lambda c: c["text"]), " ")
    whole = rows.groupBy(*TABLE).agg(F.first("subject").alias("subject"), F.first("status").alias("status"), F.first("inside").alias("inside"), F.first("start").alias("start"), F.first("stop").alias("stop"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", text.alias("t")))), lambda r: r["t"]), " ").alias("shown"))
    key = lambda c: F.regexp_replace(c, CODE_SIGNS, "")
    core = lambda c: F.regexp_replace(c, "[^가-힣A-Za-z]", "")
    cores = sorted({"".join(x for x in p if not x.isdigit() and x not in "ⅠⅡ") for p in words.code_prefixes.values()})
    codes = F.array_distinct(F.transform(F.regexp_extract_all("shown", F.lit(CODE_SHAPE)), key))
    named = F.filter(codes, lambda c: c.rlike("[가-힣A-Za-z]") & c.rlike(r"\d{2}"))
    known = lambda c: H.any_of([F.startswith(core(c), F.lit(k)) | F.startswith(F.lit(k), core(c)) for k in cores])
    prefix = F.try_element_at(F.create_map(*(F.lit(x) for pair in words.code_prefixes.items() for x in pair)), F.col("subject"))
    graded = F.filter(codes, lambda c: c.rlike(GRADED))
    mine = F.forall(graded, lambda c: F.startswith(c, prefix))
    alignment = F.when(prefix.isNull(), "unknown").when(F.exists(named, lambda c: ~known(c)), "other").when(F.size(graded) == 0, "unknown").when(mine, "expected").otherwise("other")
    short = H.compact(F.col("shown"))
    strong = H.any_of([F.contains(short, F.lit(w)) for w in words.strong_labels])
    markers = sum((F.contains(short, F.lit(w)).cast("int") for w in words.evidence_labels), F.lit(0))
    full = F.filter(F.regexp_extract_all("shown", F.lit(r"(\[[^\[\]]{2,24}-\s*\d{2}[^\[\]]{0,4}\])")), lambda c: c.rlike(r"\d{2}\s*-\s*\d{2}") & known(key(c)))
    return whole.select(*TABLE, "subject", "status", "inside", "start", "stop", alignment.alias("alignment"), strong.alias("strong"), markers.alias("markers"), F.slice(F.array_distinct(F.transform(full, lambda c: F.regexp_replace(c, r"\s+", ""))), 1, 24).alias("standards"))


def table_fields(rows: DataFrame, words: PlanWords = PLANS) -> DataFrame:
    """(case_id, table_no, overview, method, timing, weight, score): what stands behind a field's label up to the next label, else the first value below it.

    Ticked methods count alone; up to four distinct values are joined; a score
    or weight without a digit, and a join that has grown into a whole row, is none.
    """
    label = lambda c: c["key"].isin(*words.labels())
    kinds = F.create_map(*(F.lit(x) for name, keys in words.fields.items() for k in keys for x in (k, name)))
    at = rows.select(*TABLE, "row_no", "cells", F.posexplode("cells").alias("col_no", "cell")).withColumn("field", F.try_element_at(kinds, F.col("cell.key"))).where("field is not null")
    after = F.slice("cells", F.col("col_no") + 2, F.greatest(F.size("cells"), F.lit(1)))
    until = F.array_position(F.transform(after, label), True)
    behind = F.filter(F.slice(after, F.lit(1), F.when(until > 0, (until - 1).cast("int")).otherwise(F.size(after))), lambda c: c["key"] != "")
    behind = F.transform(behind, lambda c: c["text"])
    ticked = F.filter(behind, lambda t: F.contains(t, F.lit("☑")))
    found = at.select(*TABLE, "row_no", "col_no", "field", F.when((F.col("field") == "method") & (F.size(ticked) > 0), ticked).otherwise(behind).alias("values"))
    cells = rows.select(*TABLE, F.col("row_no").alias("below"), F.posexplode("cells").alias("col_no", "cell")).where((F.col("cell.key") != "") & ~F.col("cell.key").isin(*words.labels()))
    under = found.where(F.size("values") == 0).drop("values").join(cells, [*TABLE, "col_no"]).where("below > row_no").groupBy(*TABLE, "row_no", "col_no", "field").agg(F.array(F.min_by("cell.text", "below")).alias("values"))
    every = found.where(F.size("values") > 0).unionByName(under).select(*TABLE, "field", "row_no", "col_no", F.posexplode("values").alias("k", "value"))
    every = every.where(~F.col("field").isin("score", "weight") | F.col("value").rlike(r"\d"))
    every = every.groupBy(*TABLE, "field", H.compact(F.col("value")).alias("key")).agg(F.min(F.struct("row_no", "col_no", "k", "value")).alias("v"))
    joined = every.groupBy(*TABLE, "field").agg(F.array_join(F.slice(F.transform(F.array_sort(F.collect_list("v")), lambda v: v["value"]), 1, 4), " · ").alias("value"))
    fits = ~H.any_of([(F.col("field") == k) & (F.length(H.compact(F.col("value"))) > n) for k, n in CAPS.items()])
    wide = joined.where(fits).groupBy(*TABLE).agg(*(F.first(F.when(F.col("field") == f, F.col("value")), ignorenulls=True).alias(f) for f in FIELDS))
    return wide.na.fill("", list(FIELDS))


def _items(titles: DataFrame, facts: DataFrame, fields: DataFrame, order: tuple[str, ...] = ("table_no",)) -> DataFrame:
    """Items of titles (case_id, table_no, title, label), cleaned; of equal titles of a case the first stays."""
    made = titles.join(facts.select(*TABLE, "start", "stop", "standards"), [*TABLE]).join(fields, [*TABLE], "left").na.fill("", list(FIELDS))
    made = made.withColumn("c", H.cleaned(F.col("title"))).withColumn("__key", H.compact(F.col("c.title"))).where("__key <> ''")
    first = F.row_number().over(Window.partitionBy("case_id", "__key").orderBy(*order))
    return made.withColumn("__n", first).where("__n = 1").select("case_id", F.col("c.title").alias("title"), F.col("c.title_raw").alias("title_raw"), "label", "table_no", "start", "stop", *FIELDS, "standards")


def _of(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """The rows of the tables that ``facts`` keeps, made once: titles and fields, which cost most, are sought in these only."""
    return spread(rows.join(facts.select(*TABLE), [*TABLE], "left_semi"), *TABLE).persist()


def code_items(rows: DataFrame, words: PlanWords = PLANS) -> DataFrame:
    """Items of tables anywhere in a text whose codes all belong to the subject; the title still needs its label."""
    facts = table_facts(rows, words).where("alignment = 'expected'")
    kept = _of(rows, facts)
    return _items(table_titles(kept, words), facts, table_fields(kept, words))


def local_facts(rows: DataFrame, words: PlanWords = PLANS, least: int = 2) -> DataFrame:
    """Tables of a reliably bounded part that bear a title's label, enough labels of fields, and no code of another subject."""
    return table_facts(rows, words).where(F.col("inside") & F.col("status").isin(*RELIABLE) & (F.col("alignment") != "other") & F.col("strong") & (F.col("markers") >= least))


def local_items(rows: DataFrame, words: PlanWords = PLANS, least: int = 2) -> DataFrame:
    """Items of labelled tables in the subject's part, without headings."""
    facts = local_facts(rows, words, least)
    kept = _of(rows, facts)
    return _items(table_titles(kept, words), facts, table_fields(kept, words))


def hinted_items(rows: DataFrame, hints: DataFrame, words: PlanWords = PLANS, least: int = 2) -> DataFrame:
    """Items that a caller expects, (case_id, hint), where a cell of the subject's tables bears them out.

    A cell does if its compact text is the hint's, or holds one of six signs or
    more with at most sixteen others. The first cell of the first table counts.
    """
    # tested behind the grouping: a plain filter would move below it, into the few splits that the hints come from
    fit = F.filter("hints", lambda h: ~H.is_structural(h) & H.is_plan_title(h))
    named = hints.select(F.col("case_id").cast("string"), F.trim("hint").alias("hint")).withColumn("hint_key", H.compact(F.col("hint"))).where("hint_key <> ''")
    known = spread(named, "case_id").groupBy("case_id", "hint_key").agg(F.array_sort(F.collect_set("hint")).alias("hints")).select("case_id", "hint_key", F.explode(F.slice(fit, 1, 1)).alias("hint"))
    facts = table_facts(rows, words).where(F.col("inside") & (F.col("markers") >= least) & ((F.col("alignment") == "expected") | ((F.col("alignment") == "unknown") & F.col("status").isin(*RELIABLE))))
    kept = _of(rows, facts)
    cells = kept.select(*TABLE, "row_no", F.posexplode("cells").alias("col_no", "cell"))
    key = F.col("cell.key")
    near = (F.length("hint_key") >= 6) & F.contains(key, F.col("hint_key")) & (F.length(key) - F.length("hint_key") <= 16)
    met = cells.join(known.hint("merge"), "case_id").where((key == F.col("hint_key")) | near)
    met = met.groupBy("case_id", "hint_key").agg(F.min(F.struct("table_no", "row_no", "col_no", "cell.text", "hint")).alias("m"))
    titles = met.select("case_id", "m.table_no", "m.row_no", "m.col_no", F.col("m.text").alias("title"), F.col("m.hint").alias("label"))
    return _items(titles, facts, table_fields(kept, words), ("table_no", "row_no", "col_no")).withColumn("title", H.undecorated(F.col("title_raw")))


def plan_titles(rows: DataFrame, words: PlanWords = PLANS) -> DataFrame:
    """(case_id, titles): all task names of the plan tables in the subject's part, distinct, in the order of the text.

    Below a column's label all its values, right of a name's label all of its row.
    """
    own = rows.where("inside")
    at = own.select(*TABLE, "row_no", "cells", F.posexplode("cells").alias("col_no", "cell"))
    columns = at.where(F.col("cell.key").isin(*words.plan_columns)).select(*TABLE, F.col("row_no").alias("head"), "col_no")
    below = columns.join(at.select(*TABLE, "row_no", "col_no", F.col("cell.text").alias("title")), [*TABLE, "col_no"]).where("row_no > head").select(*TABLE, "head", F.lit(0).alias("kind"), "col_no", "row_no", "title")
    right = at.where(F.col("cell.key").isin(*words.plan_labels)).select(*TABLE, F.col("row_no").alias("head"), F.lit(1).alias("kind"), "col_no", F.posexplode(F.slice("cells", F.col("col_no") + 2, F.greatest(F.size("cells"), F.lit(1)))).alias("row_no", "c")).select(*TABLE, "head", "kind", "col_no", "row_no", F.col("c.text").alias("title"))
    found = below.unionByName(right).where(H.is_plan_title(F.col("title")))
    first = found.groupBy("case_id", H.compact(F.col("title")).alias("key")).agg(F.min(F.struct("table_no", "head", "kind", "col_no", "row_no", "title")).alias("t"))
    return first.groupBy("case_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["title"]).alias("titles"))


def item_union(parts: dict[str, DataFrame]) -> DataFrame:
    """All items, numbered by case: in the order of their provenance, then of the text; of equal compact titles the first provenance counts."""
    every = None
    for name, items in parts.items():
        part = items.withColumn("provenance", F.lit(name)).withColumn("__rank", F.lit(PROVENANCE.index(name)))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    order = ("__rank", "table_no", "start", "title")
    once = every.withColumn("__n", F.row_number().over(Window.partitionBy("case_id", H.compact(F.col("title"))).orderBy(*order))).where("__n = 1")
    return once.withColumn("item_order", F.row_number().over(Window.partitionBy("case_id").orderBy(*order))).drop("__n", "__rank")


def plan_items(cases: DataFrame, hints: DataFrame | None = None, words: PlanWords = PLANS, rules: RulePack = PLANS_KO) -> DataFrame:
    """Items of all cases (case_id, subject, text) from headings, plan tables, labelled tables and hints.

    A case without a bounded one falls back to tables recognised by their codes,
    and then to one bundle, which bears the plan's title if the plan names only one.
    """
    cases = cases.select(F.col("case_id").cast("string"), F.col("subject").cast("string"), F.col("text").cast("string"))
    rows = shared_rows(cases, rules)
    parsed = sections.parsed_items(cases, rules)
    clean = parsed.where(F.col("extraction_status") == "bounded").withColumn("c", H.cleaned(F.col("title"))).where((F.col("title_basis") != "heading") | ~H.is_structural(F.col("c.title")))
    clean = clean.select("case_id", F.col("c.title").alias("title"), F.col("c.title_raw").alias("title_raw"), F.lit("").alias("label"), F.col("item_order").alias("table_no"), F.lit(0).alias("start"), F.lit(0).alias("stop"), *FIELDS, "standards", "title_basis")
    parts = {"heading": clean.where("title_basis = 'heading'").drop("title_basis"), "table": clean.where("title_basis = 'table'").drop("title_basis"), "local": local_items(rows, words)}
    if hints is not None:
        parts["hinted"] = hinted_items(rows, hints, words)
    bounded = item_union(parts)
    coded = code_items(rows, words).join(bounded.select("case_id"), "case_id", "left_anti")
    review = parsed.where("extraction_status <> 'bounded' and item_order = 1").join(bounded.select("case_id"), "case_id", "left_anti").join(coded.select("case_id"), "case_id", "left_anti")
    single = plan_titles(rows, words).where(F.size("titles") == 1).select("case_id", F.get("titles", F.lit(0)).alias("only"))
    bundle = review.join(single, "case_id", "left").select("case_id", F.coalesce("only", "title").alias("title"), F.coalesce("only", "title").alias("title_raw"), F.lit("").alias("label"), F.lit(0).alias("table_no"), F.lit(0).alias("start"), F.lit(0).alias("stop"), *FIELDS, "standards")
    return item_union(parts | {"code": coded, "bundle": bundle}).withColumn("extraction_status", F.when(F.col("provenance") == "bundle", "bundle_review").otherwise("bounded"))
