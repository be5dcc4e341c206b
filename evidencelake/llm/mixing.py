"""Mixing sources to target weights by pivotal (dependent) rounding.

Every document of a source starts with the same fractional number of copies,
``target / source_size``. Two documents with fractional parts meet and hand
size-weighted mass to each other at random until one part is 0 or 1; the words
of the pair stay the same and each part keeps its expectation. A source is cut
by hash of the id into groups of bounded size; each group leaves at most one
fractional document, and these residuals meet in the next level of a reduction
tree until one is left for a source, which is rounded. So a source's taken
words differ from its target by at most half the size of one document.

Equal rows (id, source and text; ``mixed`` also wants all other columns equal)
are counted into a unit before anything else is shuffled. Of a unit of n rows
whose parts are p each, floor(n * p) rows get one more copy outright, and one
row with what is left of n * p takes part in the rounding. So a row that a third
of all rows repeat is one unit, and moves a source by no more than its size.

Defined results: a null text has size 0; a text of size 0 is copied as often as
the whole part of its source's ratio says. Rows with the same id, source and text
get numbers of copies that differ by one at most. Draws are hashes of ids, so
runs agree whatever the partitioning. The last part of a source rounds to the
nearer number, exactly 0.5 up. Null sources are one source, the last;
sources with equal names as text are one. Texts of any length count whole. Empty
tables give no rows. ``mix`` ignores other columns of the input and ``mixed``
keeps them, whatever their names.
The targets need all sources in order: one task sorts a row for each source.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, tune

#: Rows of a unit that one row stands for while they are dealt out.
PORTION = 10_000

UNIT = "doc_id {id}, source string, size long, mark long, rows long, part double, copies long, extra long, draw long, settled boolean"


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that tells nulls from each other's places."""
    own = [F.map_entries(docs[f.name]) if f.dataType.typeName() == "map" else docs[f.name] for f in docs.schema]
    return F.xxhash64(*own, *(docs[f.name].isNull() for f in docs.schema))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", mark: Column | None = None) -> DataFrame:
    words = F.coalesce(F.regexp_count(docs[text_col], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"), words.alias("size"), (F.xxhash64(docs[text_col]) if mark is None else mark).alias("mark"))


def units_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", mark: Column | None = None) -> DataFrame:
    """(doc_id, source, size, mark, rows): rows of one id, source and mark as one unit; without another ``mark`` it is the text's hash."""
    return sized(docs, id_col, text_col, source_col, mark).groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("rows"))


def targets(units: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) of (doc_id, source, size, rows): one row for each source, ``n`` its units.

    ``share`` times all words go to the sources by weight, none above ``most``
    times its size; sorted by cap over weight, the capped sources come first, so
    one running sum finds the water level.
    """
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n"))
    named = sources.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = named.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("k") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * float(most))
    upward = Window.orderBy(F.col("cap") / F.col("weight"), "k")
    everything = Window.partitionBy()
    run = weighed.withColumn("total", F.sum("source_size").over(everything) * float(share)).withColumn("capped_before", F.coalesce(F.sum("cap").over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn("weight_left", F.sum("weight").over(upward.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    run = run.withColumn("full", F.col("cap") * F.col("weight_left") <= F.col("weight") * (F.col("total") - F.col("capped_before")))
    run = run.withColumn("left", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))).withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything))
    return run.select("source", "source_size", "n", F.when(F.col("full"), F.col("cap")).otherwise(F.col("left") * F.col("weight") / F.col("open")).alias("target"))


def pivot_round(part: np.ndarray, weight: np.ndarray, draw: np.ndarray) -> int | None:
    """Round ``part`` in place, one after the other; the index that stays fractional, if any."""
    parts, weights, draws = part.tolist(), weight.tolist(), draw.tolist()
    held = None
    for i, p in enumerate(parts):
        if p <= 0 or p >= 1:
            continue
        if held is None:
            held = i
            continue
        a, b = weights[held], weights[i]
        q = parts[held]
        up, down = min(a * (1 - q), b * p), min(a * q, b * (1 - p))
        if draws[i] * (up + down) < down:  # held gains `up` with probability down / (up + down)
            if a * (1 - q) <= b * p:
                parts[held], parts[i] = 1.0, max(0.0, p - up / b)
            else:
                parts[held], parts[i] = q + up / a, 0.0
        elif a * q <= b * (1 - p):
            parts[held], parts[i] = 0.0, min(1.0, p + down / b)
        else:
            parts[held], parts[i] = q - down / a, 1.0
        rest = [k for k in (held, i) if 0 < parts[k] < 1]
        held = rest[0] if rest else None
    part[:] = parts
    return held


def _round_group(pdf: pd.DataFrame, tries: int = 1) -> pd.DataFrame:
    """Settle all units of a group but one. Of several draws the one counts that leaves the least to be rounded."""
    # larger units first, so that what is left is rather a small one
    pdf = pdf.sort_values(["size", "draw", "mark"], ascending=[False, True, True], ignore_index=True)
    weight = pdf["size"].to_numpy(np.float64)
    draw = pdf["draw"].to_numpy(np.int64).astype(np.uint64)
    best = None
    for k in range(tries):
        draw = draw * np.uint64(6364136223846793005) + np.uint64(2 * k + 1)
        rounded = pdf["part"].to_numpy(np.float64, copy=True)
        left = pivot_round(rounded, weight, (draw >> np.uint64(12)).astype(np.float64) / float(1 << 52))
        gap = 0.0 if left is None else min(rounded[left], 1 - rounded[left]) * weight[left]
        if best is None or gap < best[0]:
            best = gap, rounded, left
    _, part, held = best
    pdf["part"], pdf["settled"] = part, True
    if held is not None:
        pdf.loc[held, "settled"] = False
    full = pdf["settled"] & (pdf["part"] >= 1)
    pdf.loc[full, "extra"] += 1
    pdf.loc[pdf["settled"], "part"] = 0.0
    return pdf[["doc_id", "source", "size", "mark", "rows", "part", "copies", "extra", "draw", "settled"]]


def _rounder(tries: int):
    return lambda pdf: _round_group(pdf, tries)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", mark: Column | None = None, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, group_rows: int = 4096, tries: int = 16, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, mark, rows, copies, extra), one row for each unit, ``extra`` of its rows with one copy more, and the targets of the sources."""
    tune(docs.sparkSession)
    units = materialize(units_of(docs, id_col, text_col, source_col, mark))
    goal = materialize(targets(units, weights, share, most))
    kind = docs.schema[id_col].dataType.simpleString()
    plan = goal.select(F.col("source").alias("__source"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"), F.ceil(F.col("n") / group_rows).alias("groups"))
    mass = F.when(F.col("size") > 0, F.col("rows") * (F.col("ratio") - F.floor("ratio"))).otherwise(0.0)
    state = units.join(plan, F.col("source").eqNullSafe(F.col("__source"))).select("doc_id", "source", "size", "mark", "rows", (mass - F.floor(mass)).alias("part"), F.floor("ratio").alias("copies"), F.floor(mass).alias("extra"), F.xxhash64("doc_id", "source", "mark", F.lit(seed)).alias("draw"), F.pmod(F.xxhash64("doc_id", "mark", F.lit(f"{seed} group")), "groups").alias("group"))
    width = goal.agg(F.max(F.ceil(F.col("n") / group_rows))).first()[0] or 0
    settled = None
    while True:
        rounded = materialize(state.groupBy("source", "group").applyInPandas(_rounder(tries if width <= 1 else 1), UNIT.format(id=kind)))
        done = rounded.where("settled")
        settled = done if settled is None else settled.unionByName(done)
        left = rounded.where("not settled")
        if width <= 1:
            break
        width = -(-width // group_rows)
        state = left.drop("settled").withColumn("group", F.pmod(F.xxhash64("doc_id", "mark", F.lit(f"{seed} {width}")), F.lit(width)))
    # one residual for each source at most: the nearer whole number
    last = left.withColumn("extra", F.col("extra") + F.when(F.col("part") >= 0.5, 1).otherwise(0))
    return settled.unionByName(last).select("doc_id", "source", "size", "mark", "rows", "copies", "extra"), goal


def dealt(rows: DataFrame, number: str, keys: Sequence[str]) -> DataFrame:
    """Each row as often as its column ``number`` says, with the running number in ``__row``; what is repeated very often is first dealt out to many tasks."""
    few, many = rows.where(F.col(number) <= PORTION), rows.where(F.col(number) > PORTION)
    begins = many.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1, F.lit(PORTION).cast("long")))).repartition(*keys, "__at")
    portions = few.where(F.col(number) > 0).withColumn("__at", F.lit(0).cast("long")).unionByName(begins)
    return portions.withColumn("__row", F.explode(F.sequence(F.col("__at") + 1, F.least(F.col("__at") + PORTION, F.col(number))))).drop("__at")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row for each row of ``docs``."""
    units, goal = copies(docs, id_col, text_col, source_col, **options)
    goal = goal.select(F.col("source").alias("__source"), "source_size", "target")
    rows = dealt(units.join(goal, F.col("source").eqNullSafe(F.col("__source"))), "rows", ("doc_id", "size"))
    return rows.select("doc_id", "size", "source_size", "target", ((F.col("copies") + (F.col("__row") <= F.col("extra")).cast("long")) * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all columns stay."""
    mark = row_hash(docs)
    units, _ = copies(docs, id_col, text_col, source_col, mark=mark, **options)
    times = (F.col("rows") * F.col("copies") + F.col("extra")).alias("__times")
    take = units.select(F.col("doc_id").alias("__u_id"), F.col("source").alias("__u_source"), F.col("mark").alias("__u_mark"), times).where("__times > 0")
    # rows of a unit are equal: one of them stands for all
    once = docs.groupBy(docs[id_col].alias("__id"), docs[source_col].cast("string").alias("__source"), mark.alias("__mark")).agg(F.first(F.struct(*(docs[c] for c in docs.columns))).alias("__doc"))
    picked = once.join(take, F.col("__id").eqNullSafe(F.col("__u_id")) & F.col("__source").eqNullSafe(F.col("__u_source")) & (F.col("__mark") == F.col("__u_mark")))
    return dealt(picked.select("__doc", "__times", "__mark"), "__times", ("__mark",)).select("__doc.*")
