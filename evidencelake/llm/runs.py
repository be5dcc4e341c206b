"""Periodic runs of words by Main-Lorentz divide and conquer.

The texts of a batch are interned to word numbers and laid out one after the
other, each closed by a number of its own, so that no run crosses two texts.
The sequence is cut into halves again and again; a run lies inside some part
and crosses its midpoint. At each midpoint the Z-function of the right half
(how far the half agrees with itself q words later) finds the squares that
start there, and that of the reversed left half the squares that end there.
A run of at least four periods has two of them on one side, so nothing is
missed. The run of a square is extended in both directions as far as words one
period apart agree; equal stretches are one run, with the smallest period.

All midpoints of a level are looked at together: places that agree with the
midpoint for ``STEPS`` words remain, which in prose are next to none. A midpoint
where many remain gets its whole Z-function, word by word, which is linear; one
where few remain has them compared in blocks that grow. What lies inside a
square's stretch is a multiple of its period and is skipped.

Defined results: null and empty texts have no words and no runs. A null id has
no hash, so its words stay as they are. Rows that repeat stay rows: each row is
judged on its own, in one pass without a shuffle. Texts of any length are taken
whole; memory holds the words of a batch of rows (one row at least). Extra
columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Words a place must agree with its midpoint before it is looked at alone, and places of a midpoint from which the whole Z-function is made.
STEPS, MANY = 6, 48
#: The shortest run in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

Run = tuple[int, int, int]  # start, length, period


def z_function(s: list[int]) -> list[int]:
    """How many words from each place on agree with the beginning."""
    n = len(s)
    z, left, right = [n] + [0] * (n - 1), 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading items of two arrays of one length agree, in blocks that grow."""
    at, size = 0, 16
    while at < len(a):
        differ = a[at : at + size] != b[at : at + size]
        if differ.any():
            return at + int(differ.argmax())
        at, size = at + size, 4 * size
    return len(a)


def squares(half: np.ndarray, places: np.ndarray) -> list[int]:
    """The periods q of squares at the beginning of ``half``, multiples of one in its stretch left out; ``places`` has all q that may be one."""
    found, beyond = [], 0
    z = z_function(half.tolist()) if len(places) > MANY else None
    for q in places.tolist():
        if 2 * q > beyond:
            k = z[q] if z else agreeing(half[q:], half[: len(half) - q])
            if k >= q:
                found.append(q)
                beyond = q + k
    return found


def crossing(parts: np.ndarray, longest: int) -> Iterator[tuple[int, int]]:
    """(place, period) of squares that start or end at the midpoints of ``parts``, one part in each row."""
    width = parts.shape[1]
    half, reach = width // 2, min(width // 2, longest)
    for rows, ends in ((parts[:, half : half + reach], False), (parts[:, half - reach : half][:, ::-1], True)):
        row, q = np.nonzero(rows[:, 1 : reach // 2 + 1] == rows[:, :1])
        q += 1
        for step in range(1, min(STEPS, reach)):
            stays = (q <= step) | (rows[row, step] == rows[row, np.minimum(q + step, reach - 1)])
            row, q = row[stays], q[stays]
        if len(row):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            for k, places in zip(row[first].tolist(), np.split(q, first[1:]), strict=True):
                middle = k * width + half
                for period in squares(np.ascontiguousarray(rows[k]), places):
                    yield (middle - 2 * period if ends else middle), period


def runs_of(words: np.ndarray, longest: int | None = None) -> list[Run]:
    """All runs of a sequence in which none is longer than ``longest`` words, by start, then period; negative numbers agree with nothing."""
    n = len(words)
    longest = n if longest is None else longest
    size = 1 << max(3, (n - 1).bit_length() if n else 0)
    padded = np.concatenate([words, -n - 1 - np.arange(size - n)])
    stretches: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by period; two of one period share less than it
    best: dict[tuple[int, int], int] = {}
    width = size
    while width > LEAST_WORDS:
        for at, q in crossing(padded[: -(-n // width) * width].reshape(-1, width), longest):
            known = stretches[q]
            k = bisect_right(known, (at, size))
            if k and at + 2 * q <= known[k - 1][1]:
                continue
            start = at - agreeing(words[:at][::-1], words[q : at + q][::-1])
            stop = at + q + agreeing(words[at + q :], words[at : n - q])
            insort(known, (start, stop))
            if stop - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                best[start, stop] = min(q, best.get((start, stop), q))
        width //= 2
    return sorted((start, stop - start, q) for (start, stop), q in best.items())


def batch_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text, given as words."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    laid = np.empty(int(sizes.sum()) + len(texts), np.int64)
    closers = begins + sizes
    inner = np.ones(len(laid), bool)
    inner[closers] = False
    laid[inner] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    laid[closers] = -1 - np.arange(len(texts))
    found: list[list[Run]] = [[] for _ in texts]
    runs = runs_of(laid, int(sizes.max(initial=0)))
    for (start, length, period), k in zip(runs, (np.searchsorted(begins, [r[0] for r in runs], "right") - 1).tolist(), strict=True):
        found[k].append((start - int(begins[k]), length, period))
    return found


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that stand in no run after that run's first period."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(stays).tolist()]


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed): the runs of each text by start, then period, and its words without their repetitions, joined by one space."""

    def run(texts: list[bytes]) -> dict[str, pa.Array]:
        words = [t.split() for t in texts]
        runs = batch_runs(words)
        flat = [r for own in runs for r in own]
        fields = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
        return {
            "n_words": pa.array([len(w) for w in words], pa.int64()),
            "runs": pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
            "collapsed": pa.array([b" ".join(kept_words(w, r)) for w, r in zip(words, runs, strict=True)], pa.binary()),
        }

    found = map_texts(docs, id_col, text_col, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): of ids whose crc32 h is a multiple of ten, the words from a = g % n on repeat the p words there, g = h div 10, p = 1 + (n - a) div (3 + g % 8)."""
    text = docs[text_col].cast("string")
    h = F.crc32(docs[id_col].cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        loop = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(loop, F.lit(1), n - a)), " ")

    # a list of one binds the words, which would else be extracted at each mention
    words = F.array(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)")))
    return docs.select(docs[id_col].alias("doc_id"), F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.get(F.transform(words, repeated), F.lit(0))).otherwise(text).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the run of most periods (the first of equals) and digests of ``collapse``'s result."""
    first = F.get("runs", F.lit(0))
    best = F.aggregate("runs", first, lambda held, r: F.when(r["length"] * held["period"] > held["length"] * r["period"], r).otherwise(held))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), F.col("best.period")
    return told.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
