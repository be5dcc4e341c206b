"""A plan's section about one subject, and the assessment items in it.

``parse_section`` reads a Markdown and HTML mix: it finds the subject's part,
within it the block about performance assessment, and in that block items from
plan tables (one row, one item), from exam and performance matrices (one column,
one item) and from scored headings. What cannot be bounded becomes one honest
bundle. ``parsed_items`` runs it over a DataFrame, one pass and no shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame

from ..rules import JUMP, PLANS_KO, RulePack
from . import markup as M

# Labels of a plan's fields, in compact form.
LABELS = {
    "title": ("수행평가명", "수행평가과제명", "수행평가영역", "수행평가과제", "평가과제명", "평가과제", "평가영역", "과제명", "영역명", "수행과제"),
    "overview": ("평가내용", "과제내용", "활동내용", "평가요소", "수행내용"),
    "method": ("평가방법", "평가방식", "평가유형"),
    "timing": ("평가시기", "시기", "실시시기"),
    "weight": ("반영비율", "비율"),
    "score": ("배점", "만점", "영역만점", "총점"),
    "standards": ("성취기준", "관련성취기준", "교육과정성취기준"),
}
RUBRIC_LABELS = ("채점기준", "평가기준", "성취수준", "수행수준", "척도")
PLACEHOLDER = "수행평가 묶음"
CAPS = {"weight": 40, "score": 40, "timing": 120, "method": 120, "overview": 600}
CODE = r"\[\s*(?:10|12)[^\[\]]{2,24}?-\s*\d{2}(?:-\d{2})?\s*\]"
MOST_HEADINGS = 12


@dataclass(frozen=True)
class Item:
    title: str
    title_basis: str
    extraction_status: str
    overview: str = ""
    method: str = ""
    timing: str = ""
    weight: str = ""
    score: str = ""
    standards: tuple[str, ...] = ()
    source_html: str = ""
    rubric_html: str = ""


@dataclass(frozen=True)
class Section:
    boundary_status: str
    text: str
    items: tuple[Item, ...] = field(default=())


_SIGNS = re.compile("[^0-9A-Za-z가-힣ⅠⅡ]")


def compact(value: str) -> str:
    """Letters and digits after compatibility forms are folded."""
    return _SIGNS.sub("", unicodedata.normalize("NFKC", value))


def label_of(cell: str) -> str | None:
    """The field a header cell names."""
    short = compact(re.sub(r"\([^)]*\)", "", cell))
    return next((name for name, words in LABELS.items() if short in words), None)


def is_rubric(grid: list[list[str]]) -> bool:
    """Whether the header speaks of criteria or levels and not of a plan's fields."""
    head = [compact(c) for c in grid[0]] if grid else []
    fields = {label_of(c) for c in (grid[0] if grid else [])} - {None, "title", "score"}
    return any(any(w in h for w in RUBRIC_LABELS) for h in head) and not fields


# The line before a member of an archive in a concatenated text, and what a plan's file name holds.
MEMBER = re.compile(r"(?im)^\[zip:(.+?)\]\[[^\]]+\][ \t]*$")
MEMBER_NAME = "평가"


def member_span(text: str, subject: str) -> tuple[int, int] | None:
    """The archive member whose file name holds the subject and little else; the first of equals."""
    if "][" not in text:
        return None
    heads = [(m.start(), compact(re.sub(r"\.[^./]*$", "", m.group(1).rsplit("/", 1)[-1])), compact(m.group(1))) for m in MEMBER.finditer(text)]
    stops = [at for at, _, _ in heads[1:]] + [len(text)]
    key = compact(subject)
    fits = [(len(stem) - len(key), at, stop) for (at, stem, name), stop in zip(heads, stops, strict=False) if key and key in name and MEMBER_NAME in name]
    return min(fits)[1:] if fits else None


def subject_span(text: str, subject: str, rules: RulePack = PLANS_KO) -> tuple[int, int, str]:
    """Where the part about the subject stands and how it was found: its archive member, its exact heading, a heading or label that names it, a mention, or nothing."""
    member = member_span(text, subject)
    if member:
        return *member, "zip_member_subject"
    pattern = next((p for _, s, p in rules.subject_patterns if s == subject), re.escape(subject))
    heads = [(m.start(), len(m.group(1)), m.group(2).strip()) for m in re.finditer(r"(?m)^(#{1,6})\s*(.+)$", text)]
    names = [p for _, s, p in rules.subject_patterns if s != subject]

    def stop(start: int, level: int) -> int:
        # the next heading that is as high, or names another subject, ends the part
        ends = (at for at, depth, title in heads if at > start and (depth < level or depth == level and not re.search(pattern, title) and any(re.search(n, title) for n in names)))
        return next(ends, len(text))

    for at, level, title in heads:
        if re.fullmatch(rf"(?i)[<\[(]?\s*(?:{pattern})\s*[>\])]?", title):
            return at, stop(at, level), "subject_heading_exact"
    for at, level, title in heads:
        if re.search(rf"(?i){pattern}", title):
            return at, stop(at, level), "subject_heading"
    label = re.search(rf"(?im)^.*(?:과목\s*명?|교과\s*목?)\s*[:：|]?\s*(?:{pattern}).*$", text)
    if label:
        return label.start(), len(text), "subject_heading"
    return 0, len(text), "subject_mention_only" if re.search(rf"(?i){pattern}", text) else "subject_heading_not_found"


def subject_part(text: str, subject: str, rules: RulePack = PLANS_KO) -> tuple[str, str]:
    """The part about the subject and how it was found."""
    start, stop, status = subject_span(text, subject, rules)
    return text[start:stop], status


def assessment_block(part: str, rules: RulePack = PLANS_KO) -> tuple[str, str]:
    """From the best anchor on (a detail heading before one of a table, the first of equals) to the next policy heading."""
    anchors = [(2, -m.start()) for m in re.finditer(rules.task_section, part)] + [(1, -m.start()) for m in re.finditer(rules.table_section, part)]
    if not anchors:
        return part, "assessment_anchor_not_found"
    start = -max(anchors)[1]
    rest = part[start:]
    end = re.search(rules.other_section, rest[1:])
    return rest[: end.start() + 1] if end else rest, "assessment_anchor"


def standards(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(re.sub(r"\s+", "", c) for c in re.findall(CODE, text)))


def foreign(text: str, subject: str, rules: RulePack) -> bool:
    """Whether a code of another subject stands in the text."""
    cores = {re.sub("[^가-힣]", "", k) for k in rules.code_keys.values()}
    mine = re.sub("[^가-힣ⅠⅡ]", "", rules.code_keys.get(subject, ""))
    found = [re.sub("[^가-힣ⅠⅡ]", "", c) for c in standards(text)]
    return any(re.sub("[ⅠⅡ]", "", f) not in cores or (re.search("[ⅠⅡ]", mine + f) and f != mine) for f in found)


def _value(name: str, *texts: str) -> str:
    """Distinct values joined; nothing if they say nothing or are too long for the field."""
    kept = list(dict.fromkeys(t for t in (M.visible_text(x) for x in texts) if t and t not in ("-", "0점", "0%")))[:4]
    joined = " · ".join(kept)
    return joined if len(joined) <= CAPS.get(name, 120) else ""


def _row_html(head: list[str], row: list[str]) -> str:
    cells = lambda r, tag: "<tr>" + "".join(f"<{tag}>{M.html.escape(M.visible_text(c), quote=False)}</{tag}>" for c in r) + "</tr>"
    return f"<table><thead>{cells(head, 'th')}</thead><tbody>{cells(row, 'td')}</tbody></table>"


def _valid(title: str) -> bool:
    short = compact(title)
    return 2 <= len(short) <= 100 and not re.fullmatch(r"[0-9점%./~\s]+", title) and label_of(title) is None and not re.fullmatch("합계|계|총계|소계|지필평가|정기시험|중간고사|기말고사|구분", short)


def plan_rows(grid: list[list[str]], subject: str, rules: RulePack) -> list[Item]:
    """Items of a plan table: a header with a title column and another field, one item for each row below."""
    at = next((k for k, row in enumerate(grid[:3]) if "title" in (names := [label_of(c) for c in row]) and len(set(names) - {None}) >= 2), None)
    if at is None or is_rubric(grid[at:]):
        return []
    columns = [label_of(c) for c in grid[at]]
    items = []
    for row in grid[at + 1 :]:
        of = lambda name: [c for c, n in zip(row, columns, strict=False) if n == name]
        title = M.visible_text((of("title") or [""])[0])
        if not _valid(title) or foreign(" ".join(row), subject, rules):
            continue
        items.append(Item(title, "table", "bounded", **{n: _value(n, *of(n)) for n in ("overview", "method", "timing", "weight", "score")}, standards=standards(" ".join(row)), source_html=_row_html(grid[at], row)))
    return items


def matrix_columns(grid: list[list[str]], subject: str, rules: RulePack) -> list[Item]:
    """Items of an exam and performance matrix: labels in the first column, one item for each performance column."""
    if len(grid) < 3 or len({label_of(r[0]) for r in grid if r} - {None}) < 2:
        return []
    items = []
    for col in range(1, len(grid[0])):
        cells = [(label_of(r[0]), M.visible_text(r[col])) for r in grid if len(r) > col]
        if not any("수행" in compact(r[col]) for r in grid if len(r) > col):
            continue
        of = lambda name: [v for n, v in cells if n == name]
        title = next((t for t in of("title") if _valid(t) and compact(t) != "수행평가"), "")
        if title and sum(bool(v) for n, v in cells if n) >= 3 and not foreign(" ".join(v for _, v in cells), subject, rules):
            items.append(Item(title, "table", "bounded", **{n: _value(n, *of(n)) for n in ("overview", "method", "timing", "weight", "score")}, standards=standards(" ".join(v for _, v in cells)), source_html=_row_html([r[0] for r in grid], [r[col] for r in grid])))
    return items


def heading_items(block: str, subject: str, rules: RulePack) -> list[Item]:
    """Items under numbered headings that carry a score, or under which a plan's fields stand."""
    spans = [(a, b) for a, b, _ in M.table_spans(block)]
    heads = [m for m in re.finditer(r"(?m)^\s*(?:#{1,6}\s*)?(?:[가나다라마바사아자차카타파하]|\d{1,2})[.)]\s*([^\n<|]{2,100})$", block) if not any(a <= m.start() < b for a, b in spans)]
    items = []
    for k, m in enumerate(heads):
        body = block[m.end() : heads[k + 1].start() if k + 1 < len(heads) else len(block)]
        scored = re.search(r"[(（]\s*(\d{1,3})\s*점?\s*[)）]\s*$", m.group(1))
        title = M.visible_text(re.sub(r"\s*[(（]\s*\d{1,3}\s*점?\s*[)）]\s*$", "", m.group(1)))
        marked = sum(bool(re.search(p, body)) for p in rules.markers.values()) >= 2
        if not _valid(title) or re.search(rules.no_task, title) or not (marked or scored and int(scored.group(1)) >= 5) or foreign(body, subject, rules):
            continue
        values = {n: "" for n in ("overview", "method", "timing", "weight", "score")}
        for _, _, fragment in M.table_spans(body):
            for row in M.any_grid(fragment):
                for cell, after in zip(row, row[1:], strict=False):
                    if (n := label_of(cell)) in values and not values[n] and label_of(after) is None:
                        values[n] = _value(n, after)
        if scored and not values["score"]:
            values["score"] = f"{scored.group(1)}점"
        items.append(Item(title, "heading", "bounded", **values, standards=standards(body), source_html=M.to_html(block[m.start() : m.start() + len(m.group()) + len(body)])))
    return items


def rubric_of(title: str, grids: list[list[list[str]]]) -> str:
    """Rows of rubric tables in which a cell is the title, or holds it if it is long enough."""
    key = compact(title)
    parts = []
    for grid in grids:
        rows = [r for r in grid[1:] if any(compact(c) == key or (len(key) >= 6 and key in compact(c)) for c in r)]
        if rows:
            cells = lambda r, tag: "<tr>" + "".join(f"<{tag}>{M.html.escape(M.visible_text(c), quote=False)}</{tag}>" for c in r) + "</tr>"
            parts.append(f"<table><thead>{cells(grid[0], 'th')}</thead><tbody>{''.join(cells(r, 'td') for r in rows)}</tbody></table>")
    return "".join(parts)


def parse_section(text: str, subject: str, rules: RulePack = PLANS_KO) -> Section:
    """The section of a subject with its items; raises on a text that was pieced together from windows."""
    if JUMP.strip() in text:
        raise ValueError("the text is not continuous")
    part, found = subject_part(text, subject, rules)
    block, anchor = assessment_block(part, rules)
    status = f"{found}:{anchor}"
    grids = [M.any_grid(f) for _, _, f in M.table_spans(block)]
    rubrics = [g for g in grids if g and is_rubric(g)]
    headed = heading_items(block, subject, rules)
    bundle = Item(PLACEHOLDER, "unbounded_bundle", "bundle_review", standards=standards(block), source_html=M.to_html(block))
    if len(headed) > MOST_HEADINGS:
        return Section(status, block, (replace(bundle, title_basis="table_bundle"),))
    items: dict[str, Item] = {}
    tabled = [i for g in grids if g and g not in rubrics for i in (plan_rows(g, subject, rules) or matrix_columns(g, subject, rules))]
    for item in [*headed, *tabled] if headed and not tabled else [*tabled, *headed]:
        items.setdefault(compact(item.title), item)
    if not items:
        mismatch = foreign(block, subject, rules)
        return Section(status, block, (replace(bundle, extraction_status="source_mismatch_review"),) if mismatch else (bundle,) if re.search(rules.markers["performance_assessment"], block) else ())
    return Section(status, block, tuple(replace(i, rubric_html=rubric_of(i.title, rubrics)) for i in items.values()))


SCHEMA = "case_id string, item_id string, item_order int, boundary_status string, section_char_count int, title string, title_basis string, extraction_status string, overview string, method string, timing string, weight string, score string, standards array<string>, source_html string, rubric_html string"


def parsed_items(cases: DataFrame, rules: RulePack = PLANS_KO) -> DataFrame:
    """Items of all cases (case_id, subject, text), numbered from 1; a case that cannot be read has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for case_id, subject, text in zip(batch["case_id"], batch["subject"], batch["text"], strict=True):
                try:
                    section = parse_section(text or "", subject or "", rules)
                except ValueError:
                    continue
                for k, item in enumerate(section.items, 1):
                    values = asdict(item) | {"standards": list(item.standards)}
                    rows.append({"case_id": case_id, "item_id": f"{case_id}-{k}", "item_order": k, "boundary_status": section.boundary_status, "section_char_count": len(section.text)} | values)
            yield pd.DataFrame(rows, columns=names)

    return cases.select("case_id", "subject", "text").mapInPandas(run, SCHEMA)


def published_tables(cases: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """Status and title basis of each case from its items: any bounded one confirms it, a bundle only asks for review."""
    from pyspark.sql import functions as F

    bounded = F.count_if((F.col("extraction_status") == "bounded") & F.col("title_basis").isin("table", "heading"))
    status = items.groupBy("case_id").agg(F.first("boundary_status").alias("boundary_status"), F.max("section_char_count").alias("section_char_count"), bounded.alias("bounded_items"), F.count("*").alias("items"))
    basis = F.when(F.col("bounded_items") > 0, "source_detail").when(F.col("items") > 0, "source_detail_bundle_review").otherwise("catalog_only")
    return {"case_detail_status": status, "cases": cases.join(status.select("case_id", "bounded_items", "items"), "case_id", "left").withColumn("title_basis", F.coalesce(basis, F.lit("catalog_only"))).drop("bounded_items", "items")}
