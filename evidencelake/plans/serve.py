"""The read service as functions over published tables: the endpoints' names, DataFrames instead of responses."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates, joins, search

# Least score and bases of a curated item, orders of curricula and subjects.
LEAST_SCORE, BASES = 38, ("table", "heading")
CURRICULA = {"2015": 0, "2022": 1, "shared": 2}
METHODS = ("reasoning", "measurement", "experiment", "problem", "analysis", "discussion", "writing", "production", "process", "inquiry")


@dataclass(frozen=True)
class Published:
    """cases, items, rankings and subject statistics; axes (item_id, axis, value) may be missing."""

    cases: DataFrame
    items: DataFrame
    rankings: DataFrame
    subject_stats: DataFrame
    axes: DataFrame | None = None


# Overviews that are rubric text, and the title of a bundle.
ROUGH_OVERVIEW = r"매우\s*(?:부족|미흡)|현저히|보이지\s*않음|평가\(채점\)\s*기준|^\s*\d+\s*$"
BUNDLE_TITLE = "수행평가명 미확정 · 원문 묶음"


def _valid(curriculum=None, query=None, **texts) -> None:
    """Parameters are checked before anything is read."""
    if curriculum not in (None, "2015", "2022"):
        raise ValueError("curriculum must be 2015 or 2022")
    for name, value, most in (("query", query, 100), *((n, v, 40) for n, v in texts.items())):
        if value is not None and not 1 <= len(value) <= most:
            raise ValueError(f"{name} must have 1 to {most} characters")


def _checked(limit: int, offset: int, most: int) -> None:
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"limit must be 1 to {most} and offset not negative")


def bounded(items: DataFrame) -> DataFrame:
    return items.where((F.col("extraction_status") == "bounded") & F.col("title_basis").isin(*BASES))


def confirmed(p: Published) -> DataFrame:
    """Cases with a source detail and a publishable item."""
    return joins.having(p.cases.where("title_basis = 'source_detail'"), bounded(p.items), ["case_id"])


def with_status(p: Published, status: str) -> DataFrame:
    """Cases that are confirmed, in review (a bundle), or unconfirmed."""
    if status == "confirmed":
        return confirmed(p)
    if status == "review":
        return p.cases.where("title_basis = 'source_detail_bundle_review'")
    if status == "unconfirmed":
        return p.cases.join(confirmed(p).select("case_id"), "case_id", "left_anti").where("title_basis <> 'source_detail_bundle_review'")
    raise ValueError(f"unknown status {status}")


def meta(p: Published) -> DataFrame:
    """One row of counts."""
    place = F.concat_ws("|", "school_name", "region", "district")
    one = lambda df, *a: df.agg(*a).withColumn("_k", F.lit(1))
    b = bounded(p.items)
    coverage = [c for c in p.subject_stats.columns if c.startswith("coverage_")]
    stats = one(p.subject_stats, F.max(reduce(Column.__add__, (F.col(c) for c in coverage)) if coverage else F.lit(None).cast("long")).alias("plans_checked"))
    return stats.join(one(p.cases, F.count("*").alias("cases"), F.count_distinct(place).alias("schools")), "_k").join(one(b, F.count_distinct("case_id").alias("confirmed_cases"), F.count("*").alias("items")), "_k").drop("_k")


def subjects(p: Published, curriculum: str | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """Statistics in the configured order; unknown curricula and subjects last."""
    rank = lambda names, c, rest: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col(c)), F.lit(rest)) if names else F.coalesce(F.lit(rest))
    rows = search.equal(p.subject_stats, curriculum=curriculum)
    return rows.orderBy(rank(CURRICULA, "curriculum", 9), rank({s: i for i, s in enumerate(order)}, "subject", 99), "subject")


def trends(p: Published, tags: DataFrame, curriculum: str | None = None, subject: str | None = None) -> DataFrame:
    """Statistics with their tags, the most frequent first."""
    listed = tags.groupBy("curriculum", "subject").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("document_count")).alias("n"), "tag"))), lambda t: F.struct(t["tag"].alias("tag"), (-t["n"]).alias("document_count"))).alias("action_tags"))
    return search.equal(p.subject_stats, curriculum=curriculum, subject=subject).join(listed, ["curriculum", "subject"], "left")


def _cases(p: Published, curriculum=None, subject=None, tag=None, region=None, district=None, query=None, include_ambiguous=False) -> DataFrame:
    rows = search.equal(confirmed(p), subject=subject, region=region, district=district)
    if curriculum:
        rows = rows.where(search.curriculum_is(curriculum, subject, include_ambiguous))
    rows = search.tagged(rows, tag)
    columns = [c for c in ("title", "school_name", "subject", "excerpt") if c in rows.columns]
    return search.matches(rows, query, columns, bounded(p.items), "case_id", ["title", "overview"]) if query else rows


def cases(p: Published, limit: int = 20, offset: int = 0, **filters) -> dict[str, DataFrame]:
    """A page of confirmed cases, and their number."""
    _checked(limit, offset, 30)
    _valid(**{k: v for k, v in filters.items() if k != "include_ambiguous"})
    found = _cases(p, **filters)
    return {"items": aggregates.page(case_item(found), "review_score", "case_id", limit, offset), "total": found.agg(F.count_distinct("case_id").alias("total"))}


def case_item(rows: DataFrame) -> DataFrame:
    """What is shown of a case: texts of another subject are blank, so are weights of nothing and rough overviews."""
    out = rows
    if "subject_alignment" in rows.columns:
        for c in ("excerpt", "overview", "standards", "criteria"):
            if c in rows.columns:
                out = out.withColumn(c, search.suppressed(c))
    if "weight" in rows.columns:
        out = out.withColumn("weight", F.when(F.col("weight").isin("0점", "0%"), "").otherwise(F.col("weight")))
    if "overview" in rows.columns:
        clean = T.collapse("overview")
        out = out.withColumn("overview", F.when(clean.rlike(f"(?U){ROUGH_OVERVIEW}"), "").otherwise(clean))
    bundle = F.col("title_basis") == "source_detail_bundle_review"
    if "title" in rows.columns:
        out = out.withColumn("title", F.when(bundle, BUNDLE_TITLE).otherwise(F.col("title")))
    if "task_names" in rows.columns:
        out = out.withColumn("task_names", F.when(bundle, F.array().cast("array<string>")).otherwise(F.col("task_names")))
    return out


def has_rubric(items: DataFrame) -> Column:
    """Whether a bounded item has rubric markup."""
    return (F.col("extraction_status") == "bounded") & (F.coalesce(F.length("rubric_html"), F.lit(0)) > 0)


def catalog_counts(p: Published) -> DataFrame:
    """One row: cases and subject statistics."""
    rows = p.cases.select(F.lit(1).alias("c"), F.lit(0).alias("s")).unionAll(p.subject_stats.select(F.lit(0), F.lit(1)))
    return rows.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("cases"), F.coalesce(F.sum("s"), F.lit(0)).alias("subjects"))


def _curated(p: Published, category=None, topic=None, **places) -> DataFrame:
    ranked = p.rankings.where(F.col("priority_score") >= LEAST_SCORE)
    items = bounded(p.items)
    if category:
        if category not in METHODS:
            raise ValueError(f"unknown category {category}")
        if p.axes is not None and not p.axes.isEmpty():
            items = joins.having(items, p.axes.where((F.col("axis") == "method") & (F.col("value") == category)), ["item_id"])
        else:
            ranked = ranked.where(F.col("category") == category)
    if topic and p.axes is not None:
        items = joins.having(items, p.axes.where((F.col("axis") == "topic") & (F.col("value") == topic)), ["item_id"])
    of_case = search.equal(p.cases.select("case_id", "curriculum", "subject", "region", "district", "school_name"), **places)
    return items.join(ranked.select("item_id", "priority_score", "category"), "item_id").join(of_case, "case_id")


def curated(p: Published, limit: int = 30, **filters) -> DataFrame:
    _checked(limit, 0, 30)
    return aggregates.page(_curated(p, **filters), "priority_score", "item_id", limit)


def references(p: Published, category=None, topic=None, region=None, district=None, limit: int = 30, offset: int = 0, **places) -> dict[str, DataFrame]:
    """Page, total and facets of curated items. Facets ignore the topic, and that of regions the region too."""
    _checked(limit, offset, 50)
    chosen = _curated(p, category=category, topic=topic, region=region, district=district, **places)
    wide = _curated(p, category=category, **places)
    return {
        "items": aggregates.page(chosen, "priority_score", "item_id", limit, offset, 50), "total": chosen.agg(F.count("*").alias("total")),
        "regions": aggregates.facet(wide, "region"), "districts": aggregates.facet(search.equal(wide, region=region), "district"), "subjects": subjects(p),
    }


def facets(p: Published, curriculum=None, subject=None, region=None) -> dict[str, DataFrame]:
    """Regions (whatever region is chosen), districts and tags of confirmed cases."""
    wide = search.equal(confirmed(p), curriculum=curriculum, subject=subject)
    near = search.equal(wide, region=region)
    tags = near.select("case_id", F.explode("action_tags").alias("tag"))
    return {"regions": aggregates.facet(wide, "region"), "districts": aggregates.facet(near, "district"), "action_tags": aggregates.facet(tags, "tag", distinct="case_id")}


def case(p: Published, case_id: str) -> DataFrame:
    if not re.fullmatch(r"[0-9a-f]{24}", case_id):
        raise ValueError("case_id must be 24 hex digits")
    return case_item(p.cases.where((F.col("case_id") == case_id) & (F.col("title_basis") == "source_detail")))


def case_detail(p: Published, case_id: str) -> DataFrame:
    """The publishable items of a case, in order; none means not found."""
    return joins.having(bounded(p.items).where(F.col("case_id") == case_id), case(p, case_id), ["case_id"]).orderBy("item_order")


def assessment_item(p: Published, item_id: str) -> DataFrame:
    if not re.fullmatch(r"[0-9a-f]{24}-[0-9]+", item_id):
        raise ValueError("item_id must be a case_id and an ordinal")
    return bounded(p.items).where(F.col("item_id") == item_id).join(p.cases.select("case_id", "curriculum", "subject"), "case_id")


def sources(registry: DataFrame) -> DataFrame:
    """Sources of a registry document grouped by their layer, in the registry's order."""
    layers = registry.select(F.posexplode("layers").alias("n", "layer")).select("n", "layer.*")
    listed = registry.select(F.posexplode("sources").alias("k", "s")).groupBy(F.col("s.layer").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "s"))), lambda x: x["s"]).alias("sources"))
    return layers.join(listed, "id", "left").orderBy("n").drop("n")
