"""Scalar text functions as Columns. ``(?U)`` gives the classes of ``\\w``, ``\\b`` and ``\\s`` their Unicode meaning."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..rules import PLANS_KO, STATUS_RANK, RulePack


def unicode(pattern: str) -> str:
    """The pattern with Unicode classes, leading flags kept."""
    return f"(?U){pattern}"


def mask_sensitive(text: Column, rules: RulePack = PLANS_KO) -> Column:
    """All masks in order. A pattern tries a word again at each of its letters, so a text without the pattern's sign is not searched."""

    def masked(c: Column, pattern: str, to: str) -> Column:
        replaced = lambda t: F.regexp_replace(t, unicode(pattern), to)
        sign = rules.mask_signs.get(pattern)
        # bound as an array's element, since the text is used three times
        return F.element_at(F.transform(F.array(c), lambda t: F.when(F.contains(t, F.lit(sign)), replaced(t)).otherwise(t)), 1) if sign else replaced(c)

    return reduce(lambda c, rule: masked(c, *rule), rules.masks, text)


# What may not be published at all, a mobile number or a resident number with a valid birth date.
GATE_PATTERNS = (r"(?<!\d)01[016789][-.\s]?\d{3,4}[-.\s]?\d{4}(?!\d)", r"(?<!\d)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])[-\s]?[1-4]\d{6}(?!\d)")


def leaks_identity(html: Column) -> Column:
    return reduce(Column.__or__, (html.rlike(p) for p in GATE_PATTERNS))


def compact(text: Column) -> Column:
    """Digits, Latin and Hangul letters and the Roman numerals Ⅰ to Ⅴ only."""
    return F.regexp_replace(text, "[^0-9A-Za-z가-힣ⅠⅡⅢⅣⅤ]", "")


def collapse(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"^ | $", "")


# Tags that part words; entities of texts taken from pages, the ampersand last.
BLOCK_TAGS = ("br", "tr", "td", "th", "table", "p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6")
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "·"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&hellip;", "…"), ("&amp;", "&"))


def unescaped(text: Column) -> Column:
    """Without the entities listed; others stay."""
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)


def plain_text(value: Column) -> Column:
    """What a fragment of markup says: block tags as a space, other tags and comments as nothing, so that words neither run together nor break.

    A text without ``<`` is no markup and stays as it is, and so does ``<`` that begins no tag.
    """
    spaced = F.regexp_replace(value, rf"(?i)<(?:{'|'.join(BLOCK_TAGS)})(?![a-z0-9])[^>]*>", " ")
    bare = F.regexp_replace(spaced, "(?s)<!--.*?-->|</?[A-Za-z][^>]*>", "")
    return F.when(F.contains(value, F.lit("<")), unescaped(bare)).otherwise(value)


def marker_counts(text: Column, rules: RulePack = PLANS_KO) -> Column:
    return F.struct(*(F.regexp_count(text, F.lit(unicode(p))).alias(name) for name, p in rules.markers.items()))


def evidence_score(markers: Column, n_tags: Column, status: Column, rules: RulePack = PLANS_KO) -> Column:
    """Capped weighted sum of the marker counts and tags; eight less if the text was not extracted well."""
    points = (F.least(markers[name], F.lit(cap)) * weight for name, cap, weight in rules.score_caps)
    return reduce(Column.__add__, points) + F.least(n_tags, F.lit(5)) - F.when(status.eqNullSafe("ok"), 0).otherwise(8)


def subject_hits(text: Column, rules: RulePack = PLANS_KO) -> Column:
    """Array of (subject, curriculum_hint) for each subject whose pattern occurs."""
    found = (F.when(text.rlike("(?iuU)" + p), F.struct(F.lit(s).alias("subject"), F.lit(c).alias("curriculum_hint"))) for c, s, p in rules.subject_patterns)
    return F.array_compact(F.array(*found))


def classify(name: Column, rules: RulePack = PLANS_KO) -> Column:
    """(subject_canonical, match_type) of a file name by the first alias that matches."""
    chain = F.struct(F.lit("unknown").alias("subject_canonical"), F.lit("needs_text_scan").alias("match_type"))
    for subject, pattern in reversed(rules.aliases):
        chain = F.when(name.rlike("(?iuU)" + pattern), F.struct(F.lit(subject).alias("subject_canonical"), F.lit("filename_alias").alias("match_type"))).otherwise(chain)
    return chain


def _numbers(text: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda x: x.cast("int"))


def curriculum_candidate(urls: Column, name: Column) -> Column:
    """The curriculum that the years suggest: those of the name, else the JG_YEAR ones of the urls, else any of the urls."""
    of_name, marked, any_year = _numbers(name, r"(20\d{2})"), _numbers(urls, r"(?i)JG_YEAR(?:=|%3D)(20\d{2})"), _numbers(urls, r"(20\d{2})")
    years = F.when(F.size(of_name) > 0, of_name).when(F.size(marked) > 0, marked).otherwise(any_year)
    return F.when(F.exists(years, lambda y: y >= 2025), "2022_candidate").when(F.exists(years, lambda y: (y >= 2015) & (y <= 2024)), "2015_candidate").otherwise("unknown")


def _sorted(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def years(text: Column) -> Column:
    return _sorted(_numbers(text, r"(?U)(?<!\d)(20(?:2[2-9]|3\d))\s*학년도"))


def grades(text: Column) -> Column:
    return _sorted(F.concat(_numbers(text, r"(?U)(?<!\d)([123])\s*학년"), _numbers(text, r"(?U)(?:고등학교|고)\s*([123])(?!\d)")))


def semesters(text: Column) -> Column:
    return _sorted(_numbers(text, r"(?U)(?<!\d)([12])\s*학기"))


def transition_curriculum(year: Column, grade: Column) -> Column:
    """The bucket of an academic year; in 2025 and 2026 the grade decides, and without one nothing does."""
    return (
        F.when(year <= 2024, "2015").when(year >= 2027, "2022").when(grade.isNull(), F.lit(None).cast("string"))
        .when(year == 2025, F.when(grade == 1, "2022").otherwise("2015")).when(year == 2026, F.when(grade.isin(1, 2), "2022").otherwise("2015"))
    )


def resolve_curriculum(subject: Column, hint: Column, years_: Column, grades_: Column, rules: RulePack = PLANS_KO) -> Column:
    """(curriculum, basis): the only bucket of the subject, else a fitting hint, else what the only year and the grades agree on."""
    names = {s for _, s in rules.groups()}
    only = {s: b[0] for s in names if len(b := rules.buckets(s)) == 1}
    fits = reduce(Column.__or__, (hint.eqNullSafe(c) & subject.isin(*n) for c, n in rules.subjects.items()))
    candidates = F.when(F.size(grades_) > 0, grades_).otherwise(F.array(F.lit(None).cast("int")))
    inferred = F.array_distinct(F.array_compact(F.transform(candidates, lambda g: transition_curriculum(years_[0], g))))
    pair = lambda value, basis: F.struct(value.alias("resolved_curriculum"), F.lit(basis).alias("curriculum_resolution_basis"))
    unique = F.element_at(F.create_map(*(F.lit(x) for kv in sorted(only.items()) for x in kv)), subject) if only else F.lit(None).cast("string")
    return (
        F.when(unique.isNotNull(), pair(unique, "subject_unique_to_curriculum")).when(fits, pair(hint, "detector_curriculum_hint"))
        .when((F.size(years_) == 1) & (F.size(inferred) == 1), pair(F.try_element_at(inferred, F.lit(1)), "transition_year_and_grade"))
        .otherwise(pair(F.lit("shared"), "curriculum_unresolved"))
    )


def evidence_strength(subject: Column, match_type: Column, canonical: Column, text: Column, rules: RulePack = PLANS_KO) -> Column:
    """(strength, reasons): file name alias 5, achievement code 5, subject label 4, course context 2."""
    def per_subject(condition) -> Column:
        chain = F.lit(False)
        for _, name, pattern in rules.subject_patterns:
            chain = F.when(subject == name, condition(name, pattern)).otherwise(chain)
        return F.coalesce(chain, F.lit(False))

    def labelled(_: str, p: str) -> Column:
        forms = (
            rf"(?:과목\s*명?|교과\s*목?)\s*[:：|]?\s*(?:<|\[)?\s*{p}\s*(?:>|\])?",
            rf"(?m)^\s*(?:#+\s*)?(?:<|\[)?\s*{p}\s*(?:>|\])?\s*$",
            rf"\|\s*(?:과목\s*명?|교과\s*목?)\s*\|\s*{p}\s*\|",
            rf"(?m)^\s*#+\s*\d{{4}}\s*학년도[^\n]{{0,180}}[<(\[]\s*{p}\s*[>)\]][^\n]{{0,120}}평가\s*계획[^\n]*$",
        )
        return reduce(Column.__or__, (text.rlike("(?iuU)" + f) for f in forms))

    known = subject.isin(*(s for _, s, _ in rules.subject_patterns))
    alias = known & match_type.eqNullSafe("filename_alias") & canonical.eqNullSafe(subject)
    code = per_subject(lambda s, _: text.rlike(rf"\[(?:10|12){rules.code_keys[s]}-?\d{{2}}-\d{{2}}\]") if s in rules.code_keys else F.lit(False))
    label = per_subject(labelled)
    context = per_subject(lambda _, p: text.rlike(rf"(?iuU)(?:선택\s*과목|교과)\s*[:：]?\s*{p}"))
    parts = (("filename_alias", alias, 5), ("achievement_code", code, 5), ("subject_label", label, 4), ("course_context", context, 2))
    strength = reduce(Column.__add__, (F.when(c, n).otherwise(0) for _, c, n in parts))
    return F.struct(strength.alias("strength"), F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c, _ in parts))).alias("reasons"))


def status_rank(status: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in STATUS_RANK.items() for x in kv)), status), F.lit(0))


def case_id(source_key: Column, subject: Column) -> Column:
    return F.left(F.sha1(F.concat_ws(":", source_key, subject)), F.lit(24))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty; else the empty text."""
    return F.coalesce(*(F.when(c != "", c) for c in columns), F.lit(""))


def boundary_grade(status: Column) -> Column:
    """trusted, partial or untrusted, by how many parts were not found."""
    missing = F.size(F.filter(F.split(status, ":"), lambda p: p.endswith("_not_found")))
    return F.when(missing == 0, "trusted").when(missing == 1, "partial").otherwise("untrusted")


def json_list(text: Column) -> Column:
    """The array of texts in JSON text; none for bad JSON or another value."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def korea_date(ts: Column) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, "Asia/Seoul"), "yyyy-MM-dd")


def api_parameters(parameters: Column) -> Column:
    """A map as a query string, null and empty values left out."""
    kept = F.map_filter(parameters, lambda _, v: v.isNotNull() & (v != ""))
    return F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat_ws("=", F.url_encode(e["key"]), F.url_encode(e["value"]))), "&")


def client_key(forwarded: Column, real: Column, path: Column) -> Column:
    first = F.trim(F.split_part(F.coalesce(forwarded, F.lit("")), F.lit(","), F.lit(1)))
    return F.concat_ws(":", F.when(first != "", first).otherwise(first_filled(real, F.lit("unknown"))), path)


def valid_case_id(value: Column) -> Column:
    return value.rlike(r"^[0-9a-f]{24}\z")


def valid_item_id(value: Column) -> Column:
    return value.rlike(r"^[0-9a-f]{24}-[0-9]+\z")


def normalize_glyphs(text: Column) -> Column:
    """Check boxes that extraction turned into letters."""
    return F.regexp_replace(F.regexp_replace(text, "gfedcb", "☑"), "gfedc(?!b)", "□")


def source_format(path: Column) -> Column:
    """The suffix of a file's name in lower case; ``unknown`` if it has none."""
    return F.coalesce(F.lower(F.nullif(F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)$", 1), F.lit(""))), F.lit("unknown"))


def region_of_path(path: Column) -> Column:
    """The fifth part of a path of the form data/*/schoolinfo/*/region; else empty."""
    parts = F.split(path, "/")
    fits = (F.size(parts) >= 5) & (F.get(parts, F.lit(0)) == "data") & (F.get(parts, F.lit(2)) == "schoolinfo")
    return F.when(fits, F.get(parts, F.lit(4))).otherwise("")


@F.pandas_udf(StringType())
def code_key(codes: pd.Series) -> pd.Series:
    """A code's letters, digits and Roman numerals Ⅰ to Ⅹ, composed but not folded, so that Ⅱ stays apart from Ⅰ."""
    return codes.map(lambda c: None if c is None else re.sub("[^0-9A-Za-z가-힣ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]", "", unicodedata.normalize("NFC", c)))
