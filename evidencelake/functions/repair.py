"""Repair of source tables for reading: dangerous markup out, split tables joined, displaced rows grouped, long tables cut.

One Arrow-batched UDF from markup to markup and counters.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from html import escape
from itertools import groupby

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import markup as M

# Headers that tell which tables belong together, labels of sections in their order, level names.
SECTIONS = ("평가개요", "성취기준", "평가방법", "채점기준", "유의사항")
UPPER_LEVELS, LOWER_LEVELS = ("A", "B", "C"), ("D", "E")
# How cells end that go on behind a page break, the longest piece of text that may be left over, and the rows of a table of such pieces.
UNFINISHED = re.compile(r"(?:기준을|충족하지|수준을|이상을|미만)$")
SHORT_TEXT = 32
LEAST_ROWS, MOST_ROWS = 4, 24
LONG_HEADER = 180
# Lone codes of standards, and the captions of notes.
ORPHAN_CODES = re.compile(r"(?:\[\s*12[A-Za-z가-힣ⅠⅡ]{1,16}\s*\d{2}\s*[-‐‑‒–—]\s*\d{2}\s*\]\s*)+")
CAPTIONS = {"headings": "원문 변환 중 표 밖에 남은 문구", "standards": "원문에 별도 표기된 성취기준"}
ELEMENT = re.compile(r"(?is)<(h[1-6]|p|div|li|ul|ol|span|aside)\b[^>]*>(.*?)</\1>")
HEADING = re.compile(r"(?is)<h([2-6])\b[^>]*>(.*?)</h\1>")
KNOWN_HEADERS = ("평가영역", "평가요소", "채점기준", "배점", "성취기준", "성취수준")


@dataclass
class Counters:
    sanitized: int = 0
    merged_headers: int = 0
    joined_levels: int = 0
    continuation_rows: int = 0
    grouped_standards: int = 0
    clamped_spans: int = 0
    pruned_columns: int = 0
    split_sections: int = 0
    reconstructed_cells: int = 0
    displaced_headings: int = 0
    long_headers: int = 0


def _compact(text: str) -> str:
    return re.sub(r"\s+", "", text)


def strip_dangerous(markup: str, n: Counters) -> str:
    """Without scripts and frames, event attributes and script urls."""
    for pattern, new in ((r"(?is)<(script|iframe|object|embed)\b.*?(?:</\1\s*>|\Z|/>)", ""), (r"""(?is)\son\w+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", ""), (r"""(?is)(href|src)\s*=\s*(["']?)\s*javascript:[^"'\s>]*\2""", r"\1=\2#\2")):
        markup, k = re.subn(pattern, new, markup)
        n.sanitized += k
    return markup


def clamp(rows: list[list[M.Cell]], n: Counters) -> list[list[M.Cell]]:
    """No cell reaches beyond the last row."""
    out = []
    for k, row in enumerate(rows):
        fits = [c._replace(rowspan=min(c.rowspan, len(rows) - k)) for c in row]
        n.clamped_spans += sum(a != b for a, b in zip(row, fits, strict=True))
        out.append(fits)
    return out


def header_of(grid: list[list[str]]) -> tuple[str, ...]:
    """The header's signature, if it is a known one."""
    head = tuple(_compact(c) for c in grid[0]) if grid else ()
    return head if sum(h in KNOWN_HEADERS for h in head) >= 2 else ()


def levels(grid: list[list[str]]) -> set[str]:
    return {_compact(r[0]) for r in grid if r} & {*UPPER_LEVELS, *LOWER_LEVELS}


def join_tables(grids: list[list[list[str]]], n: Counters) -> list[list[list[str]]]:
    """Neighbours with the same known header as one; a table that goes on with levels D and E behind A to C. The narrower rows are filled up, no cell is cut."""
    out: list[list[list[str]]] = []
    for grid in grids:
        before = out[-1] if out else None
        if before and header_of(grid) and header_of(grid) == header_of(before):
            before += grid[1:]
            n.merged_headers += 1
        elif before and grid and levels(grid) and levels(grid) <= {*LOWER_LEVELS} and levels(before) >= {"C"} and not levels(before) & {*LOWER_LEVELS}:
            width = max(map(len, [*before, *grid]))
            before[:] = [r + [""] * (width - len(r)) for r in [*before, *grid]]
            n.joined_levels += 1
            n.continuation_rows += len(grid)
        else:
            out.append([list(r) for r in grid])
    return out


def islands(marks: Iterable[bool]) -> list[tuple[int, int]]:
    """(start, length) of each unbroken stretch of true marks."""
    found, at = [], 0
    for mark, group in groupby(marks):
        length = sum(1 for _ in group)
        if mark:
            found.append((at, length))
        at += length
    return found


def filled(row: list[str]) -> list[int]:
    return [k for k, c in enumerate(row) if _compact(c)]


def leftovers(grid: list[list[str]]) -> list[str]:
    """The last words that a page break cut off, a row each below a blank one; none if the table is anything else."""
    if not grid or not LEAST_ROWS <= len(grid) <= MOST_ROWS or [len(filled(r)) for r in grid] != [0] + [1] * (len(grid) - 1):
        return []
    words = [row[filled(row)[0]] for row in grid[1:]]
    return words if max(len(_compact(w)) for w in words) <= SHORT_TEXT else []


def put_back(before: list[list[str]], words: list[str], n: Counters) -> bool:
    """Give each word to a row of ``before`` that breaks off, if one place only can have lost them all.

    Rows that break off form islands; an island of k rows offers k - size + 1
    places, so exactly one place means one island of the very size and no larger one.
    """
    ends = [row[k[-1]] if (k := filled(row)) else "" for row in before]
    places = [(start, length - len(words) + 1) for start, length in islands(bool(UNFINISHED.search(_compact(e))) for e in ends) if length >= len(words)]
    if not words or [count for _, count in places] != [1]:
        return False
    start = places[0][0]
    for k, word in enumerate(words, start):
        before[k][filled(before[k])[-1]] += f" {word}"
    n.reconstructed_cells += len(words)
    return True


def kind_of(name: str, body: str) -> str | None:
    """Whether an element between tables is a displaced heading or holds codes of standards only."""
    text = M.visible_text(body)
    if ORPHAN_CODES.fullmatch(text):
        return "standards"
    return "headings" if re.fullmatch("h[4-6]", name.lower()) and 0 < len(_compact(text)) <= SHORT_TEXT else None


def gathered(between: str, n: Counters) -> str:
    """Markup between tables, in which two or more displaced headings (or lone standards) in a row are one note under a caption."""
    found = [(m, kind_of(m.group(1), m.group(2))) for m in ELEMENT.finditer(between)]
    apart = [bool(between[a.end() : b.start()].strip()) for (a, _), (b, _) in zip(found, found[1:], strict=False)]
    # an element starts a new stretch if it is of another kind or text stands before it
    starts = [k == 0 or found[k][1] != found[k - 1][1] or apart[k - 1] for k in range(len(found))]
    edges = [k for k, s in enumerate(starts) if s] + [len(found)]
    out, at = [], 0
    for first, last in zip(edges, edges[1:], strict=False):
        kind = found[first][1] if found else None
        if kind and last - first >= 2:
            out += [between[at : found[first][0].start()], note(CAPTIONS[kind], [M.visible_text(m.group(2)) for m, _ in found[first:last]])]
            at = found[last - 1][0].end()
            n.displaced_headings += kind == "headings"
            n.grouped_standards += kind == "standards"
    return "".join(out) + between[at:]


def note(caption: str, texts: list[str]) -> str:
    return f"<aside><strong>{caption}</strong>" + "".join(f"<span>{escape(t, quote=False)}</span>" for t in texts) + "</aside>"


def is_long_header(cell: str) -> bool:
    """Whether a header cell has swallowed text: very long, with a code or several lines."""
    return len(_compact(M.visible_text(cell))) >= LONG_HEADER and bool(re.search(r"\[(?:10|12)[A-Za-z가-힣ⅠⅡ]", cell) or len(re.findall(r"(?i)<br\b", cell)) >= 3)


def gap_headings(between: str) -> list[str] | None:
    """The texts of short headings, if the markup holds nothing else."""
    found = [M.visible_text(m.group(2)) for m in HEADING.finditer(between)]
    return found if not HEADING.sub("", between).strip() and all(len(_compact(t)) <= SHORT_TEXT for t in found) else None


def group_orphans(grid: list[list[str]], n: Counters) -> list[list[str]]:
    """Runs of two or more rows that hold nothing but a standard's code go to the row above them."""
    out: list[list[str]] = []
    k = 0
    while k < len(grid):
        run = k
        while run < len(grid) and sum(bool(c) for c in grid[run]) == 1 and re.match(r"\[?(?:10|12)", next(c for c in grid[run] if c)):
            run += 1
        if run - k >= 2 and out:
            at = next(i for i, c in enumerate(grid[k]) if c)
            out[-1][at] = " ".join(filter(None, [out[-1][at], *(next(c for c in r if c) for r in grid[k:run])]))
            n.grouped_standards += run - k
            k = run
        else:
            out.append(list(grid[k]))
            k += 1
    return out


def prune(grid: list[list[str]], n: Counters) -> list[list[str]]:
    """Without two or more blank columns at the right."""
    blank = 0
    while grid and blank < len(grid[0]) and not any(r[len(r) - 1 - blank] for r in grid):
        blank += 1
    if blank < 2:
        return grid
    n.pruned_columns += blank
    return [r[: len(r) - blank] for r in grid]


def split_sections(grid: list[list[str]], n: Counters) -> list[list[list[str]]]:
    """A table of five rows or more with two or more section labels in rising order, cut before each of them."""
    ranks = [(k, SECTIONS.index(s)) for k, r in enumerate(grid) if r and (s := next((x for x in SECTIONS if _compact(r[0]).startswith(x)), None))]
    starts = [k for i, (k, rank) in enumerate(ranks) if i == 0 or rank > ranks[i - 1][1]]
    if len(grid) < 5 or len(starts) < 2:
        return [grid]
    n.split_sections += 1
    cuts = [0, *starts[1:], len(grid)]
    return [grid[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def render(grid: list[list[str]]) -> str:
    return "<table>" + "".join("<tr>" + "".join(f"<td>{escape(c, quote=False)}</td>" for c in r) + "</tr>" for r in grid) + "</table>"


def repair(markup: str) -> tuple[str, Counters]:
    """The markup with its top-level tables repaired; text between tables keeps them apart."""
    n = Counters()
    markup = strip_dangerous(markup, n)
    out, held, lost, at = [], [], [], 0

    def flush() -> None:
        for grid in join_tables(held, n):
            out.extend(render(p) for p in split_sections(prune(group_orphans(grid, n), n), n))
        held.clear()
        if lost:  # headings that stood between the pieces of a table
            out.append(note(CAPTIONS["headings"], lost))
            n.displaced_headings += 1
            lost.clear()

    for m in re.finditer(r"(?is)<table\b.*?</table>", markup):
        between = markup[at : m.start()]
        at = m.end()
        tables = M.spanned_tables(m.group())
        grid = M.dense(clamp([list(r) for r in tables[-1]], n)) if tables else []
        gap = gap_headings(between)
        if held and gap is not None and put_back(held[-1], leftovers(grid), n):
            lost.extend(gap)
            continue
        if between.strip():
            flush()
            out.append(gathered(between, n))
        if grid:
            n.long_headers += sum(is_long_header(c) for c in re.findall(r"(?is)<th\b[^>]*>(.*?)</th>", m.group()))
            held.append(grid)
    flush()
    return "".join(out) + gathered(markup[at:], n), n


COUNTERS = ", ".join(f"{k} int" for k in asdict(Counters()))


def repaired():
    """UDF: struct of html and the counters; null stays null."""

    @F.pandas_udf(f"html string, {COUNTERS}")
    def run(values: pd.Series) -> pd.DataFrame:
        rows = [repair(v) if v is not None else (None, Counters()) for v in values]
        return pd.DataFrame([{"html": h} | asdict(c) for h, c in rows], columns=["html", *asdict(Counters())])

    return run


@F.pandas_udf(StringType())
def safe_markup(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else strip_dangerous(v, Counters()))
