"""Rollups, facets and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filled(name: str) -> Column:
    """The text, or null if it is empty."""
    return F.when(F.col(name) != "", F.col(name))


def trend(df: DataFrame, group: Sequence[str], school: str, score: str, markers: Sequence[str] = ()) -> DataFrame:
    """Documents, distinct schools, exact median score and documents per marker of each group."""
    return df.groupBy(*group).agg(
        F.count("*").alias("documents"),
        F.count_distinct(filled(school)).alias("schools"),
        F.percentile(score, F.lit(0.5)).alias("median_score"),
        *(F.count_if(F.col(m) > 0).alias(f"{m}_documents") for m in markers),
    )


def tag_rollup(df: DataFrame, group: Sequence[str], tags: str, school: str) -> DataFrame:
    """Documents and schools of each tag, a tag counted once for a document."""
    return df.select(*group, school, F.explode(F.array_distinct(tags)).alias("tag")).groupBy(*group, "tag").agg(F.count("*").alias("documents"), F.count_distinct(filled(school)).alias("schools"))


def most_common(df: DataFrame, group: Sequence[str], value: str, seq: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of each group; of equals the one seen first."""
    counted = df.groupBy(*group, value).agg(F.count("*").alias("count"), F.min(seq).alias("_first"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("count").desc(), F.col("_first").asc()))
    return counted.withColumn("rank", rank).where(F.col("rank") <= n).drop("_first")


def facet(df: DataFrame, value: str, distinct: str | None = None, rows: str | None = None) -> DataFrame:
    """(value, count) without empty values, most frequent first; ``rows`` tells how many rows each one stands for."""
    counted = df.groupBy(F.col(value).alias("value")).agg((F.count_distinct(distinct) if distinct else F.sum(rows) if rows else F.count("*")).alias("count"))
    return counted.where(F.coalesce(F.col("value"), F.lit("")) != "").orderBy(F.col("count").desc(), F.col("value").asc())


def crosstab(df: DataFrame, group: Sequence[str], status: str, statuses: Sequence[str]) -> DataFrame:
    """A column for each status, 0 where none."""
    return df.groupBy(*group).pivot(status, list(statuses)).count().fillna(0)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def duplicate_report(df: DataFrame, keys: Sequence[str], samples: int = 5) -> DataFrame:
    """One row: how many keys occur more than once, and the first few of them as texts."""
    repeated = duplicates(df, keys).select(F.concat_ws("/", *keys).alias("key"))
    few = repeated.orderBy("key").limit(samples).agg(F.array_sort(F.collect_list("key")).alias("samples"))
    return repeated.agg(F.count("*").alias("keys")).join(F.broadcast(few), F.lit(True))


def content_stats(df: DataFrame, size: str, short: int = 200) -> DataFrame:
    """Rows, empty ones (null counts as 0) and short ones."""
    n = F.coalesce(F.col(size), F.lit(0))
    return df.agg(F.count("*").alias("rows"), F.count_if(n == 0).alias("empty"), F.count_if((n >= 1) & (n < short)).alias("short"))


def rederive(items: DataFrame, key: str, order: str, titles: str, overview: str) -> DataFrame:
    """One row for each key: unique titles in order, joined by ``|``, and the first overview that is not blank."""
    o, t, v = F.col(order).alias("o"), F.col(titles).alias("t"), F.col(overview).alias("v")
    # each title is reduced to its first place before the titles of a key meet
    each = items.groupBy(F.col(key), t).agg(F.min(o).alias("o"), F.min(F.when(F.trim(v) != "", F.struct(o, v))).alias("first"))
    rows = each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("o", "t"))).alias("l"), F.min(F.struct(F.col("first.o").isNull().alias("none"), "first.o", "t", "first.v")).alias("best"))
    return rows.select(key, F.concat_ws("|", F.transform("l", lambda x: x["t"])).alias("titles"), F.coalesce("best.v", F.lit("")).alias("overview"))


def percentage(part: Column, whole: Column) -> Column:
    """Rounded half up; 0 where the whole is 0."""
    return F.coalesce(F.floor(F.try_divide(part, whole) * 100 + 0.5), F.lit(0))


def page(df: DataFrame, score: str, key: str, limit: int = 20, offset: int = 0, most: int = 30) -> DataFrame:
    """Best first, ties by key."""
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"limit must be 1 to {most} and offset not negative")
    return df.orderBy(F.col(score).desc(), F.col(key).asc()).offset(offset).limit(limit)


def first_seen_sums(df: DataFrame, key: str, seq: str, **sums: Column) -> DataFrame:
    """Sums for each key, with ``first_seen``, the first place of the key in the input; in that order."""
    return df.groupBy(key).agg(*(F.sum(c).alias(n) for n, c in sums.items()), F.min(seq).alias("first_seen")).orderBy("first_seen", key)
