"""SimHash fingerprints, Hamming links and their components.

Fingerprints are searched with a Gray-order hierarchical index. The upper nodes
are masked bit patterns: four masks of 16 bits each, and two fingerprints that
differ in at most three bits share the pattern of at least one mask. All
fingerprints of a node are sorted by Gray rank, runs of neighbours become nodes
that keep the bits their members share (mask and pattern), and a dual descent
adds up the differences of shared bits to prune whole groups. A node with too
many members is divided by masks over its remaining bits; the same pigeonhole
argument keeps that exact. Each task hands on a spanning forest of the links it
found, never all pairs, and components come from alternating star contraction.

Defined results: a null or empty text, or one of white space only, has
fingerprint zero and is linked like any other. Rows that repeat stay rows, and
rows of one id need not be in one component. A null doc_id never is a
component's id unless all its ids are null. A bit set in exactly half the hashes
is 0. Texts of any length count whole. Empty tables give no rows. Other columns
of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, fresh, key_filter, map_texts, materialize, passing, texts_of, tune

SEED = 42
FAN = 8
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    cuts = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(cuts[: len(words) - width] + 1).tolist()]
    ends = [*cuts[width - 1 :].tolist(), len(joined)]
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends)), repeat(SEED)), np.uint64, len(starts))


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of ``sizes`` hashes: the bits set in over half of them."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    pieces = -(-n // 255)  # a byte lane counts to 255
    first = np.cumsum(pieces) - pieces
    base = np.cumsum(n) - n
    inner = np.arange(pieces.sum()) - np.repeat(first, pieces)
    cuts = np.repeat(base, pieces) + 255 * inner
    bits = np.zeros(len(full), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANES, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        ones = (2 * counts > n[:, None]).astype(np.uint8)
        bits |= ones.view(np.uint64).reshape(-1) << np.uint64(k)
    out[full] = bits
    return out


def _fingerprint_batch(texts: list[bytes], width: int) -> np.ndarray:
    out, todo, held = [], [], 0
    for text in texts:
        todo.append(shingle_hashes(text, width))
        held += len(todo[-1])
        if held > 400_000:  # bounds the lanes of one sum
            out.append(majority(np.concatenate(todo), np.array([len(x) for x in todo])))
            todo, held = [], 0
    if todo:
        out.append(majority(np.concatenate(todo), np.array([len(x) for x in todo])))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row of ``docs``; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, id_col, text_col, lambda texts: {"fp": pa.array(_fingerprint_batch(texts, width).view(np.int64))}, f"doc_id {kind}, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The rank of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Union of array indices; keeps the smallest index of each set as its root."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                return
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up


def group_links(key: np.ndarray, codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among distinct codes that have the same key and differ in at most ``distance`` bits."""
    order = np.lexsort((gray_rank(codes), key))
    key, codes = key[order], codes[order]
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    # levels[k]: AND and OR of each node's members, the group it is in, its first child; level 0 are the codes
    group = np.repeat(np.arange(len(edge)), np.diff(np.r_[edge, len(key)]))
    levels = [(codes, codes, group, np.arange(len(codes) + 1))]
    while True:
        low, high, group, _ = levels[-1]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        within = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
        if len(within) == 0 or within.max() == 0:
            break
        starts = np.flatnonzero(within % FAN == 0)
        levels.append((np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts), group[starts], np.r_[starts, len(group)]))
    forest = Forest(len(codes))
    # every group has one root, at the top level
    tops = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, tops, tops)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > 100_000:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        if level == 0:
            forest.link(a, b)
            continue
        first = levels[level][3]
        na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
        total = na * nb
        pair = np.repeat(np.arange(len(a)), total)
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
        i, j = first[a][pair] + inner // nb[pair], first[b][pair] + inner % nb[pair]
        keep = i <= j if level > 1 else i < j
        i, j = i[keep], j[keep]
        low, high = levels[level - 1][:2]
        shared = ~(low[i] ^ high[i]) & ~(low[j] ^ high[j])
        close = np.bitwise_count((low[i] ^ low[j]) & shared) <= distance
        stack.append((level - 1, i[close], j[close]))
    leaf = np.flatnonzero(forest.root != np.arange(len(codes)))
    return codes[leaf], codes[forest.root[leaf]]


#: Shift and width of the four masks of each step, over the bits that the steps before left: 16, 12 and 9 bits wide.
def _rest(fixed: list[int]) -> list[int]:
    return [b for b in range(64) if b not in fixed]


def masks(depth: int) -> list[list[int]]:
    """The bit positions that each upper node of this depth fixes; paths of the depths before, each with four masks over its rest."""
    paths: list[list[int]] = [[]]
    for _ in range(depth):
        paths = [fixed + part for fixed in paths for part in (p.tolist() for p in np.array_split(np.array(_rest(fixed)), 4))]
    return paths


def _runs(bits: list[int]) -> list[tuple[int, int]]:
    """(first bit, length) of runs of neighbouring positions."""
    runs: list[tuple[int, int]] = []
    for b in sorted(bits):
        if runs and runs[-1][0] + runs[-1][1] == b:
            runs[-1] = (runs[-1][0], runs[-1][1] + 1)
        else:
            runs.append((b, 1))
    return runs


def _mask_value(bits: list[int]):
    mask = sum(1 << b for b in bits)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _at(depth: int, codes: DataFrame) -> DataFrame:
    """(path, pattern, fp): each code under the nodes of this depth; of deeper nodes only those below its own path."""
    if depth == 1:
        choices = enumerate(masks(1))
        return codes.select("fp", F.explode(F.array(*(F.struct(F.lit(k).alias("path"), _mask_value(bits).alias("pattern")) for k, bits in choices))).alias("n")).select("n.path", "n.pattern", "fp")
    deeper = masks(depth)
    made = None
    for k in range(4):
        part = codes.select("fp", (F.col("path") * 4 + k).alias("path"))
        made = part if made is None else made.unionByName(part)
    value = F.coalesce(*(F.when(F.col("path") == k, _mask_value(bits)) for k, bits in enumerate(deeper)))
    return made.select("path", value.alias("pattern"), "fp")


def links(codes: DataFrame, distance: int = 3, node_rows: int = 200_000, max_depth: int = 3) -> DataFrame:
    """(u, v): links that join all ``codes`` (distinct longs in ``fp``) within ``distance`` of each other, as forests.

    Nodes of more than ``node_rows`` codes are divided by masks over their other
    bits, up to ``max_depth`` times; what is still larger then is searched whole.
    """
    if distance > 3:
        raise ValueError("four masks are exact up to three differing bits")
    tune(codes.sparkSession)
    parts, level = [], _at(1, codes)
    for depth in range(1, max_depth + 1):
        large = level.groupBy("path", "pattern").count().where(F.col("count") > node_rows).select("path", "pattern")
        if depth == max_depth or large.isEmpty():
            parts.append(level.withColumn("depth", F.lit(depth)))
            break
        large = checkpoint(large)
        parts.append(level.join(large, ["path", "pattern"], "left_anti").withColumn("depth", F.lit(depth)))
        level = _at(depth + 1, level.join(large, ["path", "pattern"], "left_semi"))
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            u, v = group_links(key, fp.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            part = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], axis=1)  # depth * 64 + path, pattern, fp
            held.append(part)
            if sum(map(len, held)) < 100_000:
                continue
            rows = np.concatenate(held)
            same = (rows[:, :2] == rows[-1, :2]).all(axis=1)
            start = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [rows[start:]]
            if start:
                yield found(_ids(rows[:start]), np.ascontiguousarray(rows[:start, 2]))
        if held and len(rows := np.concatenate(held)):
            yield found(_ids(rows), np.ascontiguousarray(rows[:, 2]))

    def _ids(rows: np.ndarray) -> np.ndarray:
        return np.cumsum(np.r_[False, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])

    keyed = nodes.select((F.col("depth") * 256 + F.col("path")).cast("long").alias("node"), "pattern", "fp")
    return keyed.repartition("node", "pattern").sortWithinPartitions("node", "pattern").mapInArrow(search, "u long, v long")


#: Edges that one task joins at a time, about 100 MB of memory.
PORTION = 1_000_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of a portion of edges, as stars around the least node of each tree."""
    held = [np.stack([np.asarray(b.column(0)), np.asarray(b.column(1))], axis=1) for b in batches if b.num_rows]
    if held:
        names, ends = np.unique(np.concatenate(held), return_inverse=True)
        ends = ends.reshape(-1, 2)
        local = Forest(len(names))
        local.link(ends[:, 0], ends[:, 1])
        leaf = np.flatnonzero(local.root != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[leaf]), pa.array(names[local.root[leaf]])], names=["u", "v"])


def components(edges: DataFrame, portion: int = PORTION) -> DataFrame:
    """(node, root): the smallest node that can be reached, for each node that has an edge; columns ``u``, ``v`` in.

    Portions of edges become forests, as long as that makes them fewer; a single
    portion is then done. Else alternating large and small stars join what is
    left. The edges are checkpointed after each round, so a lost executor costs a
    round at most.
    """
    e = checkpoint(edges.select("u", "v").where("u <> v"))
    n = e.count()
    while n:
        parts = -(-n // portion)
        e = checkpoint(e.repartition(parts).mapInArrow(_stars, "u long, v long"))
        if parts == 1:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, n = n, e.count()
        if n > before // 2:
            break
    e = checkpoint(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while state[0]:
        both = e.union(e.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = checkpoint(small.select(F.col("u"), F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3, node_rows: int = 200_000) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``."""
    marked = materialize(fingerprints(docs, id_col, text_col, width))
    codes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    stars = components(links(codes.select("fp"), distance, node_rows))
    rooted = codes.join(stars, codes["fp"] == stars["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # written, so that Spark can split the members of a large component when it joins them
    named = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Wide fingerprints: near-duplicates of a given similarity of their shingle sets.

WIDE = 4
#: Bits of each mask, number of masks, and the distance in 256 bits up to which fingerprints are candidates: of two
#: texts of similarity 0.8 a bit differs with probability 0.15 (38 bits), one of the masks agrees with probability 0.999.
MASK_BITS, N_MASKS, WIDE_DISTANCE = 16, 96, 64
_SALTS = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _wide_batch(sets: list[np.ndarray]) -> np.ndarray:
    """(n, 4) words: the SimHash of each set of shingles under four mixes of their hashes."""
    out, todo, held = [], [], 0

    def flush() -> None:
        hashes, sizes = np.concatenate(todo), np.array([len(x) for x in todo])
        words = []
        for salt in _SALTS:
            h = hashes ^ salt
            if salt:
                h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                h ^= h >> np.uint64(31)
            words.append(majority(h, sizes))
        out.append(np.stack(words, axis=1))
        todo.clear()

    for hashes in sets:
        todo.append(hashes)
        held += len(hashes)
        if held > 400_000:
            flush()
            held = 0
    if todo:
        flush()
    return np.concatenate(out) if out else np.empty((0, WIDE), np.uint64)


def _sets(texts: list[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The sorted shingle hashes of each text, and a name for each set."""
    sets = [np.unique(shingle_hashes(t, width)) for t in texts]
    return sets, np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64).view(np.int64)


def _code_names(words: np.ndarray) -> np.ndarray:
    """A long for each code of four words; should two codes share one, their texts are only compared in vain."""
    h = np.zeros(len(words), np.uint64)
    for k in range(WIDE):
        h = (h ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def wide_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """(doc_id, text_hash, w0..w3, code, fp) of every row; code names the words, fp the set of shingles. No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(texts: list[bytes]) -> dict[str, pa.Array]:
        sets, names = _sets(texts, width)
        words = _wide_batch(sets)
        return {f"w{k}": pa.array(np.ascontiguousarray(words[:, k]).view(np.int64)) for k in range(WIDE)} | {"code": pa.array(_code_names(words)), "fp": pa.array(names)}

    keep = {"doc_id": docs[id_col], "text_hash": F.xxhash64(docs[text_col])}
    return map_texts(docs, id_col, text_col, run, f"doc_id {kind}, text_hash long, w0 long, w1 long, w2 long, w3 long, code long, fp long", keep)


def shingle_sets(docs: DataFrame, text_col: str = "text", width: int = 5) -> DataFrame:
    """(fp, shingles) with the hashes of each set as bytes, each set once."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, names = _sets(texts_of(batch, "__text"), width)
            names, first = np.unique(names, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([sets[k].tobytes() for k in first], pa.binary())], names=["fp", "shingles"])

    sets = docs.select(docs[text_col].cast("string").cast("binary").alias("__text")).mapInArrow(run, "fp long, shingles binary")
    return sets.groupBy("fp").agg(F.first("shingles").alias("shingles"))


def _mask_bits() -> np.ndarray:
    """The bit positions of each mask."""
    rng = np.random.default_rng(17)
    return np.stack([rng.permutation(64 * WIDE)[:MASK_BITS] for _ in range(N_MASKS)])


def _patterns(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    value = np.zeros(len(words), np.int64)
    for k, b in enumerate(bits.tolist()):
        value |= ((words[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)).astype(np.int64) << k
    return value


def wide_group_links(key: np.ndarray, words: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of spanning links among rows of the same key whose words differ in at most ``distance`` bits.

    As ``group_links``: Gray order (of the first word), nodes of shared bits, dual descent.
    Nodes whose members are all linked already are not compared again, so that many
    copies of one text do not take all their pairs.
    """
    order = np.lexsort((words[:, 1], gray_rank(words[:, 0]), key))
    key, words = key[order], words[order]
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    group = np.repeat(np.arange(len(edge)), np.diff(np.r_[edge, len(key)]))
    levels = [(words, words, group, np.arange(len(words) + 1))]
    while True:
        low, high, group, _ = levels[-1]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[first, len(group)])
        if len(sizes) == 0 or sizes.max() == 1:
            break
        starts = np.flatnonzero((np.arange(len(group)) - np.repeat(first, sizes)) % FAN == 0)
        levels.append((np.bitwise_and.reduceat(low, starts, axis=0), np.bitwise_or.reduceat(high, starts, axis=0), group[starts], np.r_[starts, len(group)]))
    forest = Forest(len(words))
    each = np.arange(len(words))
    for other in (np.maximum(each - 1, edge[levels[0][2]]), edge[levels[0][2]]):  # the neighbour and the first of the group
        close = np.bitwise_count(words ^ words[other]).sum(axis=1, dtype=np.int64) <= distance
        forest.link(each[close], other[close])
    tops = np.arange(len(levels[-1][0]))
    stack, spans = [(len(levels) - 1, tops, tops)], []
    while stack:
        level, a, b = stack.pop()
        if len(a) > 50_000:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        if level == 0:
            forest.link(a, b)
            spans = []
            continue
        if not spans:  # least and greatest root below each node
            spans = [(forest.root, forest.root)]
            for _, _, _, starts in levels[1:]:
                spans.append((np.minimum.reduceat(spans[-1][0], starts[:-1]), np.maximum.reduceat(spans[-1][1], starts[:-1])))
        least, most = spans[level]
        apart = np.minimum(least[a], least[b]) != np.maximum(most[a], most[b])
        a, b = a[apart], b[apart]
        if not len(a):
            continue
        first = levels[level][3]
        na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
        total = na * nb
        pair = np.repeat(np.arange(len(a)), total)
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
        i, j = first[a][pair] + inner // nb[pair], first[b][pair] + inner % nb[pair]
        keep = i <= j if level > 1 else i < j
        i, j = i[keep], j[keep]
        low, high = levels[level - 1][:2]
        shared = ~(low[i] ^ high[i]) & ~(low[j] ^ high[j])
        close = np.bitwise_count((low[i] ^ low[j]) & shared).sum(axis=1, dtype=np.int64) <= distance
        stack.append((level - 1, i[close], j[close]))
    leaf = np.flatnonzero(forest.root != np.arange(len(words)))
    return order[leaf], order[forest.root[leaf]]


def wide_links(codes: DataFrame, distance: int = WIDE_DISTANCE, node_rows: int = 200_000) -> DataFrame:
    """(u, v) links between the codes (w0..w3, in rows of ``codes``), each named as ``_code_names`` does.

    A node holds the codes that agree on one mask. Nodes of more than about
    ``node_rows`` codes, as a sample of them tells, are cut into blocks of half
    as many by hash, and each two blocks are searched together in a task: every
    pair of a node is compared, whatever its size.
    """
    tune(codes.sparkSession)
    names = [f"w{k}" for k in range(WIDE)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _mask_bits()
        for batch in batches:
            words = np.stack([np.asarray(c) for c in batch.columns], axis=1).view(np.uint64)
            for mask in range(N_MASKS):
                yield pa.RecordBatch.from_arrays([pa.array(_patterns(words, bits[mask]) * N_MASKS + mask), *batch.columns], names=["key", *names])

    schema = "key long, w0 long, w1 long, w2 long, w3 long"
    codes = codes.select(*names)
    level = codes.mapInArrow(spread, schema)
    mark = F.xxhash64(*names)
    share = max(1, min(64, node_rows // 2000))
    counted = codes.where(F.pmod(F.shiftright(mark, 20), F.lit(share)) == 0).mapInArrow(spread, schema).groupBy("key").agg((F.count("*") * share).alias("n"))
    large = checkpoint(counted.where(F.col("n") > node_rows * 0.75).select("key", (F.ceil(F.col("n") * 2 / node_rows) + 1).alias("blocks")))
    nodes = level
    if not large.isEmpty():
        cut = level.join(large, "key").select("*", F.pmod(mark, F.col("blocks")).alias("block"))
        cut = cut.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).where("block <> other")
        # the pair of blocks stands above the bits of the key
        pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other") + 1
        nodes = level.join(large, "key", "left_anti").unionByName(cut.select((pair * F.lit(N_MASKS << MASK_BITS) + F.col("key")).alias("key"), *names))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(rows: np.ndarray) -> pa.RecordBatch:
            words = np.ascontiguousarray(rows[:, 1:]).view(np.uint64)
            u, v = wide_group_links(rows[:, 0], words, distance)
            codes_of = _code_names(words)
            ends = np.unique(np.stack([codes_of[u], codes_of[v]], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

        for batch in batches:
            held.append(np.stack([np.asarray(c) for c in batch.columns], axis=1))
            if sum(map(len, held)) < 100_000:
                continue
            rows = np.concatenate(held)
            differ = np.flatnonzero(rows[:, 0] != rows[-1, 0])
            start = differ[-1] + 1 if len(differ) else 0
            held = [rows[start:]]
            if start:
                yield found(rows[:start])
        if held:
            yield found(np.concatenate(held))

    return nodes.repartition("key").sortWithinPartitions("key").mapInArrow(search, "u long, v long")


def set_links(sets: list[np.ndarray], linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of spanning links among sets with a Jaccard similarity of at least 0.8; sets of equal ``linked`` are linked already."""
    n = len(sets)
    forest = Forest(n)
    _, first, inverse = np.unique(linked, return_index=True, return_inverse=True)
    forest.link(np.arange(n), first[inverse])
    given = forest.root.copy()
    sizes = np.array([len(x) for x in sets])
    tokens, at = np.unique(np.concatenate(sets), return_inverse=True) if n else (np.empty(0), np.empty(0, int))
    ends = np.cumsum(sizes)
    total = np.zeros(len(at) + 1, np.int64)
    mark = np.zeros(len(tokens), np.int64)
    for i in range(n):
        others = np.flatnonzero(forest.root != forest.root[i])
        if not len(others):
            break
        others = others[others > i]
        if not len(others):
            continue
        own = at[ends[i] - sizes[i] : ends[i]]
        mark[own] = 1
        np.cumsum(mark[at], out=total[1:])
        mark[own] = 0
        shared = total[ends[others]] - total[ends[others] - sizes[others]]
        close = others[9 * shared >= 4 * (sizes[i] + sizes[others])]  # shared >= 0.8 (a + b - shared)
        if len(close):
            forest.link(np.full(len(close), i), close)
    leaf = np.flatnonzero((forest.root != np.arange(n)) & (forest.root != given))
    return leaf, forest.root[leaf]


def _set_search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): links of sets that have the same task; input (task, fp, class, shingles) is sorted by task."""
    held: list[tuple[int, int, bytes]] = []
    task = None

    def found() -> pa.RecordBatch:
        rows = list({fp: (fp, c, x) for fp, c, x in held}.values())
        names = np.array([r[0] for r in rows], np.int64)
        u, v = set_links([np.frombuffer(r[2], np.uint64) for r in rows], np.array([r[1] for r in rows], np.int64))
        return pa.RecordBatch.from_arrays([pa.array(names[u]), pa.array(names[v])], names=["u", "v"])

    for batch in batches:
        for now, *row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if now != task and held:
                yield found()
                held.clear()
            task = now
            held.append(tuple(row))
    if held:
        yield found()


def _searched(rows: DataFrame, *task: str) -> DataFrame:
    keyed = rows.select(F.struct(*task).alias("task"), "fp", "class", "shingles")
    return keyed.repartition("task").sortWithinPartitions("task").mapInArrow(_set_search, "u long, v long")


def similar_sets(members: DataFrame, sets: DataFrame, block_rows: int = 1000, pivots: int = 16) -> DataFrame:
    """(node, root): components of the links of Jaccard similarity 0.8 or more inside each group of ``members`` (fp, root, n; n rows in the group).

    All pairs of a group are compared. A group of more than ``block_rows`` sets is
    cut into blocks; each is searched by itself together with a few sets that all
    blocks of the group get. What that leaves apart is searched in pairs of blocks,
    but for blocks that belong to one component already.
    """
    members = members.select("fp", "root", F.ceil(F.col("n") / block_rows).alias("blocks"))
    held = materialize(sets.join(members, "fp"))
    own = held.withColumn("block", F.pmod(F.xxhash64("fp"), "blocks")).withColumn("class", F.col("fp"))
    # about as many in each group; any choice gives the same result
    picked = held.where("blocks > 1").where(F.pmod(F.xxhash64("fp", F.lit("pivot")), F.col("blocks") * block_rows) < pivots)
    given = picked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("class", F.col("fp"))
    edges = checkpoint(_searched(own.unionByName(given.select(*own.columns)), "root", "block"))
    classes = components(edges)
    if members.where("blocks > 1").isEmpty():
        return classes
    large = members.where("blocks > 1").join(classes, members["fp"] == classes["node"], "left").select("fp", members["root"], F.coalesce(classes["root"], "fp").alias("class"))
    counts = checkpoint(large.groupBy("root", "class").agg(F.count("*").alias("n")))
    small = counts.where(F.col("n") < block_rows).groupBy("root").agg(F.sum("n").alias("small"))
    # blocks of a large class hold nothing else; small classes are dealt out whole
    mine = F.when(F.col("n") >= block_rows, F.struct(F.col("class").alias("of"), F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / block_rows)).alias("no")))
    rest = F.struct(F.lit(None).cast("long").alias("of"), F.pmod(F.xxhash64("class"), F.ceil(F.col("small") / block_rows)).alias("no"))
    placed = materialize(large.join(counts, ["root", "class"]).join(small, "root", "left").select("fp", "root", "class", F.coalesce(mine, rest).alias("block")))
    each = checkpoint(placed.select("root", "block").distinct())
    left, right = each.withColumnRenamed("block", "a"), each.withColumnRenamed("block", "b")
    pairs = left.join(right, "root").where("a <= b AND NOT (a.of <=> b.of AND a.of IS NOT NULL)")
    ways = checkpoint(pairs.select("root", "a", "b", F.col("a").alias("block")).union(pairs.where("a <> b").select("root", "a", "b", F.col("b").alias("block"))))
    if ways.isEmpty():
        return classes
    apart = placed.join(ways, ["root", "block"]).join(held.select("fp", "shingles"), "fp")
    return components(edges.union(_searched(apart, "root", "a", "b")))


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, distance: int = WIDE_DISTANCE, block_rows: int = 1000) -> DataFrame:
    """(doc_id, component_id, root, text_hash): components, named by ``root``, of texts whose sets of shingles have a Jaccard similarity of at least 0.8.

    Wide fingerprints find groups of candidates; inside each group the sets
    themselves decide. Only the sets of groups of two or more are shuffled.
    Texts without words have the empty set and are one component.
    ``component_id`` is the least id of a component, null if all are null.
    """
    marked = materialize(wide_fingerprints(docs, id_col, text_col, width))
    codes = materialize(marked.groupBy("fp", "code", "w0", "w1", "w2", "w3").agg(F.min("doc_id").alias("least"), F.min("text_hash").alias("text_hash")))
    near = components(wide_links(codes.dropDuplicates(["code"]), distance))
    grouped = materialize(codes.join(near, codes["code"] == near["node"], "left").select("fp", "text_hash", F.coalesce("root", "code").alias("root")))
    sizes = grouped.groupBy("root").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(grouped.join(sizes, "root").select("fp", "text_hash", "root", "n"))
    some = passing(docs.select(docs[text_col].alias("text")), F.xxhash64("text"), key_filter(members, "text_hash"))
    stars = similar_sets(members, shingle_sets(some, "text", width), block_rows)
    rooted = codes.join(stars, codes["fp"] == stars["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # written, so that Spark can split the members of a large component when it joins them
    named = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = rooted.select("fp", "root").join(named, "root").select("fp", "root", "component_id")
    return marked.select("doc_id", "fp", "text_hash").join(classes, "fp").select("doc_id", "component_id", "root", "text_hash")


def one_of_each(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of ``groups`` (from ``similar``): the one with the least id, null ids last, and of these the least hash of the text.

    Ids need not be unique or known: rows of different components stay whatever
    their ids are. Of rows with the same id and text any one stays.
    """
    groups = materialize(groups.select("doc_id", "root", "text_hash"))
    least = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("of"), F.count("*").alias("n"))
    root, rank = fresh(docs, "__root"), fresh(docs, "__rank")
    kept = materialize(least.select(F.col("root").alias(root), F.col("of.doc_id").alias("__kept"), F.col("of.text_hash").alias("__hash"), "n"))
    shared = groups.join(kept.where("n > 1"), F.col("root") == F.col(root), "left_semi").select("text_hash").distinct()
    bitmap = key_filter(shared, "text_hash")
    # most rows are alone in their component: they stay where they lie, only the others are shuffled
    alone = passing(docs, F.xxhash64(docs[text_col]), bitmap, wanted=False)
    others = passing(docs, F.xxhash64(docs[text_col]), bitmap)
    stay = others.join(kept, others[id_col].eqNullSafe(kept["__kept"]) & (F.xxhash64(others[text_col]) == kept["__hash"])).select(*(others[c] for c in docs.columns), root)
    once = stay.withColumn(rank, F.row_number().over(Window.partitionBy(root).orderBy(F.lit(0)))).where(F.col(rank) == 1).drop(rank, root)
    return alone.unionByName(once)
