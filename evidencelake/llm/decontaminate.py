"""Benchmark decontamination with one Aho-Corasick automaton.

Patterns are windows of consecutive benchmark words, normalised as the documents
are. The automaton runs over numbers of words, so a window of ten words has ten
nodes at most; a text is scanned once and hits are mapped back to words and to
character offsets of the original.

A worker process builds an automaton once and keeps it for its later tasks. A
benchmark of more than ``max_nodes`` nodes (about 50 bytes each) is cut into
shares below that bound, long items into pieces; texts are then scanned once for
each share and hits of all shares united, with the same result.

Defined results: null and empty texts have no words and no hits; an item
without words has no window; windows that several items share count for each of
them, an item without an id as one more item that is not named. Repeated items
and texts of one id count once. Rows that repeat stay rows. Texts of any length
are scanned whole. An empty benchmark hits nothing, an empty table of documents
gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, materialize, texts_of, tune, word_bytes

#: Words of an item that one row holds when shares are dealt.
PIECE = 10_000
MAX_NODES = 4_000_000

Item = tuple[str | None, bytes]


def by_name(item: str | None) -> tuple[bool, str]:
    return item is None, item or ""


class Scanner:
    """The automaton of some items' windows."""

    def __init__(self, items: list[Item], size: int) -> None:
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], list[str | None]] = {}
        for item, text in items:
            coded = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in word_bytes(text)]
            for k in range(max(1, len(coded) - size + 1) if coded else 0):
                names = windows.setdefault(tuple(coded[k : k + size]), [])
                if not names or names[-1] != item:
                    names.append(item)
        self.machine = None
        if windows:
            self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for window, names in windows.items():
                self.machine.add_word(window, (len(window), names))
            self.machine.make_automaton()
            self.shortest = min(map(len, windows))

    def scan(self, text: bytes) -> tuple[int, list[str | None], list[dict]]:
        """Words of one text, items hit, and runs of words hit: first, behind, and their characters in the original."""
        spaced = text.translate(WORD_BYTES)
        words = spaced.split()
        if not words or self.machine is None:
            return len(words), [], []
        numbers = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        # no window holds a word that the benchmark has not: only runs of known words go through the automaton
        known = np.diff(np.r_[0, numbers != 0, 0].astype(np.int8))
        begins, ends = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
        long = np.flatnonzero(ends - begins >= self.shortest)
        step = np.zeros(len(words) + 1, np.int64)
        items: set[str | None] = set()
        for a, b in zip(begins[long].tolist(), ends[long].tolist(), strict=True):
            for last, (n, names) in self.machine.iter(tuple(numbers[a:b].tolist())):
                step[a + last + 1 - n] += 1
                step[a + last + 1] -= 1
                items.update(names)
        if not items:
            return len(words), [], []
        edge = np.diff(np.r_[0, np.cumsum(step[:-1]) > 0, 0])
        first, behind = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        letter = np.diff(np.r_[0, np.frombuffer(spaced, np.uint8) != 32, 0].astype(np.int8))
        starts, ends = np.flatnonzero(letter == 1), np.flatnonzero(letter == -1)
        chars = np.r_[0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)]
        runs = zip(first.tolist(), behind.tolist(), chars[starts[first]].tolist(), chars[ends[behind - 1]].tolist(), strict=True)
        return len(words), sorted(items, key=by_name), [dict(zip(("first", "behind", "start", "end"), r, strict=True)) for r in runs]


_kept: dict[str, Scanner] = {}


def _scanner(name: str, shared: Broadcast, size: int) -> Scanner:
    """The scanner of a share; a worker process keeps the last one."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = Scanner(pickle.loads(shared.value), size)
    return _kept[name]


def _shares(benchmark: DataFrame, item_col: str, text_col: str, size: int, max_nodes: int) -> list[tuple[str, Broadcast]]:
    """Broadcast items, in as many shares as keep each below about ``max_nodes`` nodes."""
    spark = benchmark.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_bytes(text)
                rows += [(item, b" ".join(words[k : k + PIECE + size - 1]), min(PIECE, len(words) - k)) for k in range(0, max(1, len(words) - size + 1), PIECE) if words]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.binary(), pa.int64()), strict=True)], names=["item", "words", "n"])

    tune(spark)
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[text_col].cast("string").cast("binary").alias("text")).where("text is not null")
    pieces = materialize(items.mapInArrow(cut, "item string, words binary, n long").distinct())
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shares = -(-total * size // max_nodes) or 1
    found = []
    for k in range(shares):
        part = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(shares)) == k).select("item", "words").collect()  # bounded by max_nodes
        data = sorted(((r["item"], bytes(r["words"])) for r in part), key=lambda r: (by_name(r[0]), r[1]))
        found.append((uuid.uuid4().hex, spark.sparkContext.broadcast(pickle.dumps(data))))
    return found


RUNS = "array<struct<first:long,behind:long,start:long,end:long>>"
_runs = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "behind", "start", "end")]))


def _scanned(docs: DataFrame, share: tuple[str, Broadcast], id_col: str, text_col: str, size: int, hits_only: bool = False) -> DataFrame:
    """(doc_id, mark, n_words, items, runs) of every row, or of those with hits; ``mark`` is the hash of the text."""
    name, shared = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scan = _scanner(name, shared, size).scan
            found = [scan(t) for t in texts_of(batch, "__text")]
            at = [k for k, f in enumerate(found) if f[1] or not hits_only]
            n, items, runs = zip(*(found[k] for k in at), strict=True) if at else ((), (), ())
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(runs, _runs)], names=["doc_id", "mark", "n_words", "items", "runs"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col]).alias("mark"), docs[text_col].cast("string").cast("binary").alias("__text"))
    return rows.mapInArrow(run, f"doc_id {kind}, mark long, n_words long, items array<string>, runs {RUNS}")


def _merged(runs):
    """Runs of several shares, sorted, as runs without overlap; those that touch are one."""
    def add(done, run):
        last = F.element_at(done, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["behind"], run["behind"]).alias("behind"), last["start"].alias("start"), F.greatest(last["end"], run["end"]).alias("end"))
        touches = (F.size(done) > 0) & (run["first"] <= F.try_element_at(done, F.lit(-1))["behind"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.array_sort(runs), F.array().cast(RUNS), add)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, max_nodes: int = MAX_NODES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) for each row of ``docs``; spans are characters of the original."""
    tune(docs.sparkSession)
    shares = _shares(benchmark, item_col, item_text_col, size, max_nodes)
    rows = _scanned(docs, shares[0], id_col, text_col, size)
    if len(shares) > 1:
        # equal rows have equal hits; only those with hits are shuffled with more than their key
        parts = [rows.where(F.size("items") > 0), *(_scanned(docs, s, id_col, text_col, size, hits_only=True) for s in shares[1:])]
        hits = parts[0].select("doc_id", "mark", "items", "runs")
        for part in parts[1:]:
            hits = hits.unionByName(part.select("doc_id", "mark", "items", "runs"))
        hits = hits.distinct().groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), _merged(F.flatten(F.collect_list("runs"))).alias("runs"))
        base = rows.select("doc_id", "mark", "n_words")
        none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
        rows = base.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left").select("doc_id", "n_words", none("items", "array<string>"), none("runs", RUNS))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["behind"] - r["first"])
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: counts, and the SHA-256 of the item ids."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, max_nodes: int = MAX_NODES) -> DataFrame:
    """The rows of ``docs`` that hold no window; all columns stay and no text is shuffled."""
    tune(docs.sparkSession)
    for k, share in enumerate(_shares(benchmark, item_col, item_text_col, size, max_nodes)):
        docs = _clean_share(docs if k == 0 else materialize(docs), share, text_col, size)  # one automaton at a time in a worker
    return docs


def _clean_share(docs: DataFrame, share: tuple[str, Broadcast], text_col: str, size: int) -> DataFrame:
    name, shared = share
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scan = _scanner(name, shared, size).scan
            yield batch.filter(pa.array([not scan((t or "").encode())[1] for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
