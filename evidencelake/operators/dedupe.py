"""Duplicate elimination and keep-best choices. Every choice ends in an explicit order, for Spark has no input order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The earliest row of each non-empty key; rows whose key is empty or null all stay."""
    blank = F.coalesce(F.col(key), F.lit("")) == ""
    keyed = _ranked(df.where(~blank), [key], [F.col(seq).asc()], "_rn").where("_rn = 1").drop("_rn")
    return keyed.unionByName(df.where(blank))


def keep_best(df: DataFrame, keys: Sequence[str], score: str, seq: str) -> DataFrame:
    """The row of the highest score for each key; the earliest of equals."""
    return _ranked(df, keys, [F.col(score).desc(), F.col(seq).asc()], "_rn").where("_rn = 1").drop("_rn")


def last_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Upsert semantics: the latest row of each key."""
    return _ranked(df, keys, [F.col(seq).desc()], "_rn").where("_rn = 1").drop("_rn")


def merge_log(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace old ones of the same key."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return _ranked(both, keys, [F.col("_new").desc()], "_rn").where("_rn = 1").drop("_rn", "_new")


def diverse_top(df: DataFrame, group: Sequence[str], member: str, score: str, seq: str, n: int) -> DataFrame:
    """The best ``n`` rows of each group with one row of a member at most; rows without a member are never merged."""
    alone = F.coalesce(F.col(member), F.lit("")) == ""
    order = [F.col(score).desc(), F.col(seq).asc()]
    best = _ranked(df.where(~alone), [*group, member], order, "_rn").where("_rn = 1").drop("_rn").unionByName(df.where(alone))
    return _ranked(best, group, order, "rank").where(F.col("rank") <= n)


def stratified(df: DataFrame, stratum: str, order: Sequence[str], limit: int) -> DataFrame:
    """Round robin: row i of every stratum before row i + 1 of any."""
    return _ranked(df, [stratum], [F.col(c) for c in order], "turn").orderBy("turn", stratum).limit(limit)


def override(base: DataFrame, retry: DataFrame, key: str, rank: str, size: str, seq: str) -> DataFrame:
    """A retry row replaces its base row only if (rank, size) is strictly greater; the best retry row counts, the first of equals."""
    best = _ranked(retry, [key], [F.col(rank).desc(), F.col(size).desc(), F.col(seq).asc()], "_rn").where("_rn = 1").drop("_rn")
    b, r = base.alias("b"), best.alias("r")
    wins = F.col(f"r.{key}").isNotNull() & ((F.col(f"r.{rank}") > F.col(f"b.{rank}")) | ((F.col(f"r.{rank}") == F.col(f"b.{rank}")) & (F.col(f"r.{size}") > F.col(f"b.{size}"))))
    columns = [F.when(wins, F.col(f"r.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in base.columns]
    return b.join(r, F.col(f"b.{key}") == F.col(f"r.{key}"), "left").select(*columns, wins.alias("replaced"))


def narrow(df: DataFrame, key: str, *conditions: Column) -> DataFrame:
    """Narrowing cascade: while a key has several rows, keep those that meet the next condition, if any do; ``ambiguous`` tells if several are left."""
    for condition in conditions:
        per_key = Window.partitionBy(key)
        df = df.withColumn("_n", F.count("*").over(per_key)).withColumn("_met", F.coalesce(condition, F.lit(False))).withColumn("_k", F.count_if("_met").over(per_key))
        df = df.where((F.col("_n") == 1) | (F.col("_k") == 0) | F.col("_met")).drop("_n", "_met", "_k")
    return df.withColumn("ambiguous", F.count("*").over(Window.partitionBy(key)) > 1)
