"""Join shapes of the evidence pipeline and the serving layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def having(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with a partner (EXISTS)."""
    return df.join(other.select(*on), list(on), "left_semi")


def orphans(df: DataFrame, other: DataFrame, on: Column) -> DataFrame:
    """Rows without a partner."""
    return df.join(other, on, "left_anti")


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, seq: str | None = None) -> DataFrame:
    """Add ``value``; missing is the empty text. Of rows with the same key the last with a non-empty value counts."""
    filled = table.where(F.coalesce(F.col(value), F.lit("")) != "")
    picked = filled.groupBy(key).agg((F.max_by(value, seq) if seq else F.max(value)).alias(value))
    return df.join(picked, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit("")))


def first_document(cases: DataFrame, documents: DataFrame, key: str, text: str, seq: str) -> DataFrame:
    """Cases with the text of the first document of their key; cases whose first document is empty get nothing."""
    first = documents.groupBy(key).agg(F.min_by(text, seq).alias(text)).where(F.coalesce(F.col(text), F.lit("")) != "")
    return cases.join(first, key)


def dense(rows: DataFrame, groups: Sequence[tuple], names: Sequence[str], counts: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Every row with every configured group, and the counts of both (0 where none).

    ``groups`` is configuration, a handful of literal tuples: exploding them
    needs no join and no shuffle.
    """
    listed = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, g, strict=True))) for g in groups))
    made = rows.select("*", F.explode(listed).alias("_g")).select(*rows.columns, "_g.*")
    for part in counts:
        values = [c for c in part.columns if c not in on]
        made = made.join(part, list(on), "left").fillna(0, values)
    return made


def expected_groups(expected: DataFrame, aggregated: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every configured group, zero-filled; groups that nobody expects are dropped."""
    values = [c for c, kind in aggregated.dtypes if c not in on and kind in ("bigint", "int", "double")]
    return expected.join(aggregated, list(on), "left").fillna(0, values)


def differences(stored: DataFrame, computed: DataFrame, on: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, field, stored, computed) wherever the two sides differ, rows missing on a side included."""
    s, c = stored.select(*on, *(F.col(f).cast("string").alias(f"s_{f}") for f in fields)), computed.select(*on, *(F.col(f).cast("string").alias(f"c_{f}") for f in fields))
    both = s.join(c, list(on), "full_outer")
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"s_{f}").alias("stored"), F.col(f"c_{f}").alias("computed")) for f in fields))
    return both.select(*on, F.explode(pairs).alias("d")).select(*on, "d.*").where(~F.col("stored").eqNullSafe(F.col("computed")))


def suppressed_spans(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """Spans of ``inner`` that lie in no span of ``outer`` of the same document."""
    return inner.alias("a").join(outer.alias("b"), (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("b.start") <= F.col("a.start")) & (F.col("a.end") <= F.col("b.end")), "left_anti")
