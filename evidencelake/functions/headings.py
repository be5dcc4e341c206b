"""Titles and headings of plans as Columns: which headings are structure, which titles name a task, and how a title is cleaned.

All of it is native. A step that later steps mention more than once is bound to a
variable, so that it is evaluated once and expressions stay small. A null gives null.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import plan_words as W
from .text import compact

#: How a kind of pattern is anchored; white space and digits of any script count.
ANCHOR = {"whole": r"(?U)^(?:%s)\z", "start": r"(?U)^(?:%s)", "part": "(?U)%s", "compact": "(?U)%s"}


def hits(text: Column, kind: str, pattern: str) -> Column:
    return text.rlike(ANCHOR[kind] % pattern)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def any_of(tests: list[Column]) -> Column:
    return reduce(or_, tests)


def _replaced(text: Column, rewrites) -> Column:
    return reduce(lambda t, r: F.regexp_replace(t, f"(?U){r[0]}", r[1]), rewrites, text)


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def undecorated(text: Column) -> Column:
    """Without a list sign, a glued label and signs at the ends."""
    return one_line(_replaced(text, W.DECORATION))


def _without(tail: str) -> Callable[[Column], Column]:
    """The first group of ``tail``, unless that is no name of its own."""

    def chosen(c: Column) -> Column:
        short = c["short"]
        return F.when((F.length(short) >= 2) & ~short.isin(*W.STRUCTURAL_NAMES), c["text"])

    return lambda whole: F.coalesce(_with_compact(F.regexp_extract(whole, f"(?U){tail}", 1), chosen), whole)


def cleaned(raw: Column) -> Column:
    """struct(title, title_raw): the heading without numbering, brackets, scores and labels, and as it stands in the source."""
    title = _replaced(F.trim(raw), W.TITLE_REWRITES)
    for tail in W.TITLE_TAILS:
        title = bound(title, _without(tail))
    return F.struct(undecorated(title).alias("title"), raw.alias("title_raw"))


def is_prose(title: Column) -> Column:
    """Whether a heading is a sentence of policy or rubric, or nothing but words of administration."""
    clean = F.regexp_replace(F.regexp_replace(one_line(title), r"^[\s,，:：;；]+|[\s,，:：;；]+$", ""), r"(?U)^(?:\d+|[가-하]|[①-⑳])\s*[.)]\s*", "")

    def judged(c: Column) -> Column:
        text, short = c["text"], c["short"]
        sentence = any_of([(F.length(short) >= least) & text.rlike(f"(?U){p}") for least, p in W.PROSE_PATTERNS])
        policy = text.rlike(f"(?U){W.POLICY_WORDS}") | ((short != "") & (F.regexp_replace(short, W.ADMIN_WORDS, "") == ""))
        return sentence | (~text.rlike(W.ACTIVITY) & policy)

    return _with_compact(clean, judged)


def _with_compact(text: Column, use: Callable[[Column], Column]) -> Column:
    return bound(bound(text, lambda t: F.struct(t.alias("text"), compact(t).alias("short"))), use)


def bare(heading: Column) -> Column:
    """A heading without its number, a note at its end and signs around it."""
    text = F.regexp_replace(one_line(heading), r"(?U)^(?:\d+|[가-하])\s*[.)]\s*", "")
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s*\(※[^)]*\)\s*$", ""), r"^[\s,，:：;；.-]+|[\s,，:：;；.-]+$", "")


def is_structural(heading: Column, policy_prose: bool = True) -> Column:
    """Whether a heading tells a plan's structure: a fixed name, one of the structural patterns, or (unless switched off) prose."""

    def judged(c: Column) -> Column:
        text, short = c["text"], c["short"]
        tests = [short.isin(*W.STRUCTURAL_NAMES)]
        tests += [(F.length(short) >= 10) & hits(short, k, p) if k == "compact" else hits(text, k, p) for k, p in W.STRUCTURAL_PATTERNS]
        return any_of([*tests, is_prose(text)] if policy_prose else tests)

    return _with_compact(bare(heading), judged)


def is_title(title: Column) -> Column:
    """Two to a hundred signs that are no general word and no bare number or level."""

    def judged(c: Column) -> Column:
        text, size = c["text"], F.length(c["short"])
        return size.between(2, 100) & ~any_of([hits(text, k, p) for k, p in W.NO_TITLES]) & ~((size > 4) & text.rlike(r"(?U)(?:상|중|하)\s*$"))

    return _with_compact(title, judged)


def is_rubric_line(title: Column) -> Column:
    """Whether a line ends as a level's description does, and is long or speaks of grading."""
    return _with_compact(F.trim(title), lambda c: c["text"].rlike(W.RUBRIC_END) & ((F.length(c["short"]) > 12) | c["text"].rlike(W.RUBRIC_WORDS)))


def is_plan_title(title: Column) -> Column:
    """A title that a plan's table may give: a task's name and no label, sentence, exam, code or score. Exams are also known by their cleaned names."""

    def judged(c: Column) -> Column:
        text, short = c["text"], c["short"]
        no = [short.isin(*W.NO_PLAN_NAMES), F.length(short) > 60, *(hits(text, k, p) for k, p in W.NO_PLAN_TITLES), text.rlike(W.EXAM_SIGNS) & hits(cleaned(text)["title"], *W.EXAMS), is_prose(text), is_rubric_line(text)]
        return is_title(text) & ~any_of(no)

    return _with_compact(F.trim(title), judged)
