"""Published tables of parsed cases: items fan out to rankings, axes and statuses, and cases are derived anew from their items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy
from ..functions import text as T
from ..session import spread
from . import serve

BLANK = r"(?U)^\s*\z"
LISTS = {"title": "task_names", "method": "methods", "standard": "standards"}


def ranked(items: DataFrame, scores: DataFrame, topics, methods=taxonomy.METHODS) -> DataFrame:
    """Items with category, topic, all values of both axes, the ambiguity and names of the evidence at hand.

    ``scores`` has (case_id, review_score), once for each case; an item without
    one has score 0. ``topics`` and ``methods`` are lexicons: (key, words).
    """
    signals = taxonomy.item_signals(F.col("rubric_html"), F.col("standards"), F.col("score"), F.col("weight"), F.col("method"), F.col("overview"))
    kept = items.select("case_id", "item_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("overview", F.lit("")).alias("overview"), F.coalesce("method", F.lit("")).alias("_declared"), signals.alias("priority_signals"))
    found = taxonomy.classify(kept, "title", "overview", "_declared", topics, methods).withColumnRenamed("method", "category")
    score = scores.select("case_id", F.col("review_score").cast("long").alias("priority_score"))
    return found.join(score, "case_id", "left").select("item_id", "category", "topic", "methods", "topics", "ambiguous", F.coalesce("priority_score", F.lit(0).cast("long")).alias("priority_score"), "priority_signals")


def axes(rankings: DataFrame) -> DataFrame:
    """(item_id, axis, value): every value of every item, as membership filters need them."""
    values = lambda axis, column: F.transform(column, lambda v: F.struct(F.lit(axis).alias("axis"), v.alias("value")))
    return rankings.select("item_id", F.explode(F.concat(values("method", "methods"), values("topic", "topics"))).alias("a")).select("item_id", "a.*")


def statuses(items: DataFrame, cases: DataFrame) -> DataFrame:
    """One row for each case that was read: format of its source, boundary status, length of its section, title basis.

    Any bounded item from a table or heading confirms a case, whatever its place.
    """
    bounded = (F.col("extraction_status") == "bounded") & F.col("title_basis").isin(*serve.BASES)
    of_case = items.groupBy("case_id").agg(F.min("boundary_status").alias("boundary_status"), F.max("section_char_count").alias("section_char_count"), F.coalesce(F.bool_or(bounded), F.lit(False)).alias("confirmed"))
    named = of_case.join(cases.select("case_id", T.source_format(F.coalesce("saved_path", F.lit(""))).alias("source_format")), "case_id", "left")
    return named.select("case_id", F.coalesce("source_format", F.lit("unknown")).alias("source_format"), "boundary_status", "section_char_count", F.when(F.col("confirmed"), "source_detail").otherwise("source_detail_bundle_review").alias("title_basis"))


def derived(items: DataFrame) -> DataFrame:
    """What bounded items say of their case: distinct titles, methods and standards in order; the first overview; the first weight, else the first score.

    Values are reduced to their first place before those of a case meet, so a
    case's row holds distinct values only. A case whose titles are all blank has
    no row.
    """
    bounded = items.where((F.col("extraction_status") == "bounded") & F.col("title_basis").isin(*serve.BASES))
    one = lambda name: F.array(F.struct(F.lit(name).alias("field"), F.coalesce(F.col(name), F.lit("")).alias("value")))
    codes = F.transform(F.coalesce("standards", F.array().cast("array<string>")), lambda s: F.struct(F.lit("standard").alias("field"), F.coalesce(s, F.lit("")).alias("value")))
    # dealt by case before values are unfolded: small tasks, and both groupings stay where they are
    long = spread(bounded, "case_id").select("case_id", "item_order", F.posexplode(F.concat(*(one(c) for c in ("title", "method", "overview", "weight", "score")), codes)).alias("pos", "v"))
    first = long.where(~F.col("v.value").rlike(BLANK)).groupBy("case_id", F.col("v.field").alias("field"), F.col("v.value").alias("value")).agg(F.min(F.struct("item_order", "pos")).alias("at"))
    of = lambda name: F.when(F.col("field") == name, F.struct("at", "value"))
    listed = [F.transform(F.array_sort(F.collect_list(of(f))), lambda x: x["value"]).alias(c) for f, c in LISTS.items()]
    earliest = {f: F.min(of(f))["value"] for f in ("overview", "weight", "score")}
    rows = first.groupBy("case_id").agg(*listed, F.coalesce(earliest["overview"], F.lit("")).alias("overview"), F.coalesce(earliest["weight"], earliest["score"], F.lit("")).alias("weight"))
    return rows.where(F.size("task_names") > 0).withColumn("title", F.element_at("task_names", 1))


def refreshed(cases: DataFrame, items: DataFrame) -> DataFrame:
    """Cases with the fields that their bounded items give; others keep what they have. A field that ``cases`` lacks is added, null where no item gives it."""
    new = derived(items)
    fields = [c for c in new.columns if c != "case_id"]
    both = cases.join(new.select("case_id", F.lit(True).alias("_known"), *(F.col(c).alias(f"_new_{c}") for c in fields)), "case_id", "left")

    def value(c: str) -> Column:
        return F.when(F.col("_known"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in cases.columns else F.col(f"_new_{c}")

    return both.select(*(value(c).alias(c) if c in fields else F.col(c) for c in cases.columns), *(value(c).alias(c) for c in fields if c not in cases.columns))


def publish(cases: DataFrame, items: DataFrame, subject_stats: DataFrame, topics, methods=taxonomy.METHODS) -> serve.Published:
    """The tables that the read service works on, from catalog cases (case_id, saved_path, review_score, ...) and their parsed items."""
    status = statuses(items, cases).select("case_id", "title_basis")
    based = cases.drop("title_basis").join(status, "case_id", "left").withColumn("title_basis", F.coalesce("title_basis", F.lit("catalog_only")))
    rankings = ranked(items, cases, topics, methods)
    return serve.Published(refreshed(based, items), items, rankings.drop("methods", "topics"), subject_stats, axes(rankings))
