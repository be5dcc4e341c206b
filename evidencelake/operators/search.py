"""Filters of the case search. Predicates are Columns, so Catalyst can push and reorder them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokens(query: str | None, most: int = 8) -> list[str]:
    """Search words; fixed pattern of the characters that make up one."""
    return re.findall("[0-9A-Za-z가-힣ⅠⅡ]+", query or "")[:most]


def folded(column: Column) -> Column:
    """ASCII letters in lower case; others, Roman numerals among them, unchanged."""
    return F.translate(column, UPPER, LOWER)


def contains_token(column: Column, token: str) -> Column:
    """Whether a search word occurs, ASCII letters in either case; the text is not rewritten for it."""
    return column.rlike("(?i)" + re.escape(token))


def matches(df: DataFrame, query: str, columns: list[str], items: DataFrame | None = None, key: str = "case_id", item_columns: list[str] | None = None) -> DataFrame:
    """Rows in which every token occurs in one of the columns, or in a column of one of the row's items."""
    for token in tokens(query):
        own = reduce(Column.__or__, (F.coalesce(contains_token(F.col(c), token), F.lit(False)) for c in columns))
        if items is None:
            df = df.where(own)
            continue
        found = items.where(reduce(Column.__or__, (contains_token(F.col(c), token) for c in item_columns or []))).select(F.col(key).alias("_k"), F.lit(True).alias("_hit")).distinct()
        df = df.join(found, F.col(key) == F.col("_k"), "left").where(own | F.coalesce(F.col("_hit"), F.lit(False))).drop("_k", "_hit")
    return df


def equal(df: DataFrame, **values: str | None) -> DataFrame:
    """Optional equality filters; a district needs its region."""
    if values.get("district") and not values.get("region"):
        raise ValueError("district needs region")
    for column, value in values.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def curriculum_is(value: str, subject: str | None, include_ambiguous: bool) -> Column:
    return F.col("curriculum").isin(value, "shared") if include_ambiguous and subject else F.col("curriculum") == value


def tagged(df: DataFrame, tag: str | None, column: str = "action_tags") -> DataFrame:
    return df.where(F.array_contains(column, tag)) if tag else df


def suppressed(column: str, alignment: str = "subject_alignment") -> Column:
    """Blank where the row belongs to another subject; an unknown alignment shows the text."""
    return F.when(F.coalesce(F.col(alignment), F.lit("")) == "other", F.lit("")).otherwise(F.col(column))


def first_reason(*reasons: tuple[str, Column]) -> Column:
    """The first reason whose condition holds."""
    chain = F.lit(None).cast("string")
    for name, condition in reversed(reasons):
        chain = F.when(condition, F.lit(name)).otherwise(chain)
    return chain


def all_reasons(*reasons: tuple[str, Column]) -> Column:
    """Every reason whose condition holds, joined by ``|``; empty if none does."""
    return F.concat_ws("|", F.array_compact(F.array(*(F.when(condition, F.lit(name)) for name, condition in reasons))))
