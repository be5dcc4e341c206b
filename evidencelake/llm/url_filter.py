"""URL verdicts: rules first, then a path-template tree with labelled purity.

Only DataFrame functions. URLs are first counted by host and lexical template
(digits, hex runs and long mixed tokens become ``*``), so later steps see few
rows. The tree is walked from branching to branching: what all paths of a node
share is passed in one step, so the number of steps is that of branchings on a
path and not of its segments. The labelled branches of a node are sorted by
their smoothed share of bad labels, and neighbours whose shares do not differ
significantly become one template: ``*`` if that is the whole node, else
``*~`` and its first branch. Branches without labels have nothing to be alike
by; those of a node are one template that keeps the prior. A branch that is
alone in its template keeps its name. A node with one path, or without a label
below it, is not walked further. A template is blocked if its smoothed share of
bad labels reaches ``threshold``; without labels it is allowed.

Branches with equal counts are one row before neighbours are compared, so a node
with very many branches puts few rows into a window.

Defined results: a null url, or one without ``://``, has an empty host and path,
no rule, and is allowed. Rows that repeat stay rows and count each. An id whose
labels are evenly good and bad is bad; a purity of exactly ``threshold`` blocks.
Very long paths are taken whole. Empty tables of urls give no rows, empty labels
leave all to the prior. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, materialize

#: Fixed values: (verdict, host and path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def parsed(urls: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path)."""
    rest = F.when(F.instr(urls[url_col], "://") > 0, F.expr(f"substr(`{url_col}`, instr(`{url_col}`, '://') + 3)"))
    return urls.select(
        urls[id_col].alias("page_id"),
        F.coalesce(lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
    )


def rule_column(rules: Sequence[tuple[str, str]], value: int) -> Column:
    """The longest fitting rule (value 1) or its verdict (value 0); null if none fits. Rules are a parameter of the plan."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        host, _, path = rule[1].partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        found = F.when(fits, F.lit(rule[value])).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """Segments of a path with variable ones as ``*``; empty ones dropped."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    variable = r"^[0-9]+(\.[A-Za-z]+)?$|^[0-9a-fA-F-]{16,}$|^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_.-]{12,}$"
    return F.transform(parts, lambda s: F.when(s.rlike(variable), F.lit("*")).otherwise(s))


def differ(labelled: tuple[Column, Column], bad: tuple[Column, Column], prior: float, weight: float, z: float) -> Column:
    """Whether the smoothed shares of two branches are apart by more than ``z`` standard errors."""
    a, b = (n + weight for n in labelled)
    p, q = (bad[0] + weight * prior) / a, (bad[1] + weight * prior) / b
    pooled = (p * a + q * b) / (a + b)
    return F.abs(p - q) > z * F.sqrt(pooled * (1 - pooled) * (1 / a + 1 / b))


def branch_names(children: DataFrame, prior: float, weight: float, z: float) -> DataFrame:
    """(host, prefix, seg, name) of branches (host, prefix, seg, labelled, bad): one name for each cluster of alike siblings. The end of a path is no branch."""
    node = ["host", "prefix"]
    kinds = children.where("seg <> ''").groupBy(*node, "labelled", "bad").agg(F.min("seg").alias("first"), F.count("*").alias("n"))
    upward = Window.partitionBy(*node).orderBy((F.col("bad") + weight * prior) / (F.col("labelled") + weight), "labelled", "bad")
    labelled, bad = ((F.lag(c).over(upward), F.col(c)) for c in ("labelled", "bad"))
    told = kinds.where("labelled > 0").withColumn("cut", F.coalesce(differ(labelled, bad, prior, weight, z), F.lit(True)).cast("int")).withColumn("cluster", F.sum("cut").over(upward)).drop("cut")
    every = told.unionByName(kinds.where("labelled = 0").withColumn("cluster", F.lit(0).cast("long")))
    own, all_of = Window.partitionBy(*node, "cluster"), Window.partitionBy(*node)
    sized = every.select(*node, "labelled", "bad", F.sum("n").over(own).alias("members"), F.min("first").over(own).alias("first"), F.sum("n").over(all_of).alias("branches"))
    name = F.when(F.col("members") == F.col("branches"), "*").otherwise(F.concat(F.lit("*~"), "first"))
    alike = sized.select(*node, "labelled", "bad", F.when(F.col("members") == 1, F.col("first")).otherwise(name).alias("name"))
    return children.join(alike, [*node, "labelled", "bad"], "left").select(*node, "seg", F.when(F.col("seg") == "", "").otherwise(F.col("name")).alias("name"))


def templates(counts: DataFrame, prior: float, weight: float, z: float) -> DataFrame:
    """(host, segments, labelled, bad, template) of rows (host, segments, labelled, bad): each path's template after merging."""
    own = ["host", "segments", "labelled", "bad"]
    state, done = counts.select(*own, F.lit("").alias("prefix"), F.col("segments").alias("rest")), None
    behind = lambda n: F.slice("rest", n + 1, F.greatest(F.size("rest") - n, F.lit(0)))
    while True:
        node = state.groupBy("host", "prefix").agg(F.count("*").alias("paths"), F.sum("labelled").alias("evidence"), F.min("rest").alias("low"), F.max("rest").alias("high"))
        # the least and the greatest path share what all paths share
        parts = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), False)
        node = node.select("host", "prefix", "paths", "evidence", F.when(parts > 0, parts - 1).otherwise(F.size("low")).cast("int").alias("shared"))
        at = state.join(node, ["host", "prefix"])
        ends = at.where("paths = 1 or evidence = 0").select(*own, F.concat_ws("/", F.array("prefix"), F.when(F.col("paths") == 1, F.col("rest")).otherwise(F.array(F.lit("**")))).alias("prefix"), F.lit(None).cast("array<string>").alias("rest"))
        walked = at.where("paths > 1 and evidence > 0").select(*own, F.concat_ws("/", F.array("prefix"), F.slice("rest", F.lit(1), F.col("shared"))).alias("prefix"), F.coalesce(F.get("rest", F.col("shared")), F.lit("")).alias("seg"), behind(F.col("shared") + 1).alias("rest"))
        children = walked.groupBy("host", "prefix", "seg").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        named = walked.join(branch_names(children, prior, weight, z), ["host", "prefix", "seg"])
        on = named.select(*own, F.when(F.col("seg") == "", F.col("prefix")).otherwise(F.concat_ws("/", "prefix", "name")).alias("prefix"), F.when(F.col("seg") != "", F.col("rest")).alias("rest"))
        # written at each branching: it is read several times
        step = materialize(ends.unionByName(on))
        ended = step.where("rest is null").select(*own, F.col("prefix").alias("template"))
        done = ended if done is None else done.unionByName(ended)
        state = step.where("rest is not null")
        if state.isEmpty():
            return done


def judge(urls: DataFrame, labels: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", prior: float = 0.1, weight: float = 8.0, z: float = 1.96, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), one row for each row of ``urls``.

    ``labels`` (the id column, bad 0/1) teach the tree; without them the rules'
    own verdicts do.
    """
    rows = parsed(urls, id_col, url_col).withColumn("rule", rule_column(rules, 1)).withColumn("by_rule", rule_column(rules, 0)).withColumn("segments", segments(F.col("path")))
    if labels is None:
        known = rows.withColumn("bad", F.when(F.col("by_rule") == "block", 1).when(F.col("by_rule") == "allow", 0))
    else:
        told = labels.groupBy(labels[id_col].alias("page_id")).agg((F.avg("bad") >= 0.5).cast("int").alias("bad"))
        known = rows.join(told, "page_id", "left")
    counts = known.where("host <> ''").groupBy("host", "segments").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    # read at each level and by the verdicts
    tree = templates(materialize(counts), prior, weight, z)
    purity = tree.groupBy("host", "template").agg(((F.sum("bad") + prior * weight) / (F.sum("labelled") + weight)).alias("purity"))
    named = tree.select("host", "segments", "template").join(purity, ["host", "template"])
    found = rows.join(named, ["host", "segments"], "left")
    verdict = F.coalesce("by_rule", F.when(F.col("purity") >= threshold, F.lit("block")).otherwise(F.lit("allow")))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
