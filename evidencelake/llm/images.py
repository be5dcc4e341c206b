"""Local image descriptors: cropped, turned, halved or relit copies of images.

Corners are found at two scales (Harris response, largest of their
surroundings); each gets the direction of its patch's intensity centroid and
128 comparisons of smoothed pixels, turned by that direction. Descriptors meet
in Hamming tables: each stands under the six pairs of its four 32-bit words,
so two of them are compared if at most two words differ (always so up to two
differing bits). 64 bits make chance meetings rare enough that joined rows grow
with the copies there are, not with queries times images. Pairs of images with
enough matches then vote for a common rotation, scale and shift.

Identical images are one class, described and matched once: results are pairs
of classes, and ``members`` tells which images are in them. A query's corners
are all used; of an indexed image those strongest in each cell of ``CELL``
pixels, so that any part of it holds its share whatever its size.

Images are binary PGM (``P5``, 8 bits). No table has images, so ``page_images``
draws one from each page's words, and ``edit`` makes copies to search for.

Defined results: a null or malformed image, or one too small for a patch, has no
descriptors and no pairs; a null image has no class. Repeated rows and ids are
members of one class each. Of equally good votes the smallest turn wins, then
the first grid. Empty tables give no rows. Other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, materialize, texts_of, tune

RADIUS = 6
BITS = 128
_rng = np.random.default_rng(11)
_pairs = np.clip(_rng.normal(0, RADIUS / 2.2, (BITS, 4)), -RADIUS + 1, RADIUS - 1)
CELL = 16
#: Directions are rounded to this many steps, a multiple of four: quarter turns shift them exactly.
STEPS = 32
_disc = np.array([(y, x) for y in range(-RADIUS, RADIUS + 1) for x in range(-RADIUS, RADIUS + 1) if x * x + y * y <= RADIUS * RADIUS])


def read_pgm(data: bytes | None) -> np.ndarray | None:
    """The pixels of a binary PGM; None if it is malformed."""
    if not data:
        return None
    head = data[:64].split(None, 4)
    try:
        if head[0] != b"P5" or int(head[3]) > 255:
            return None
        width, height = int(head[1]), int(head[2])
        start = data.index(head[3], data.index(head[2], data.index(head[1], 2) + len(head[1])) + len(head[2])) + len(head[3]) + 1
        return np.frombuffer(data, np.uint8, width * height, start).reshape(height, width)
    except (IndexError, ValueError):
        return None


def write_pgm(pixels: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def draw(text: bytes, tiles: int = 10) -> np.ndarray:
    """A picture of a text: each tile of 8 by 8 pixels, in 16 cells, mixes the words that fall on it, all words of the text in turn."""
    words = text.translate(WORD_BYTES).split()
    marks = np.zeros(tiles * tiles, np.uint32)
    if words:
        codes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        np.add.at(marks, np.arange(len(codes)) % len(marks), codes * (np.arange(len(codes), dtype=np.uint32) | np.uint32(1)))
    mixed = np.stack([(marks ^ (marks >> np.uint32(15))) * np.uint32(m) for m in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)], axis=1)
    cells = (mixed ^ (mixed >> np.uint32(13))).view(np.uint8).reshape(tiles, tiles, 4, 4).transpose(0, 2, 1, 3).reshape(4 * tiles, 4 * tiles)
    return np.kron(cells, np.ones((2, 2), np.uint8))


def edit(pixels: np.ndarray, number: int) -> np.ndarray:
    """A crop of about half the area, relit, turned by quarters: which ones depends on ``number``."""
    h, w = pixels.shape[0] * 7 // 10, pixels.shape[1] * 7 // 10
    y, x = number * 7 % (pixels.shape[0] - h + 1), number * 5 % (pixels.shape[1] - w + 1)
    part = pixels[y : y + h, x : x + w].astype(np.float64) * 0.8 + 20
    return np.rot90(np.rint(part).astype(np.uint8), number % 4)


def _slid(a: np.ndarray, r: int, both) -> np.ndarray:
    """``both`` (add or maximum) over squares of side 2r + 1, zero beyond the border."""
    for axis in (1, 2):
        n = a.shape[axis]
        out = a.copy()
        for d in range(1, r + 1):
            low, high = [slice(None)] * 3, [slice(None)] * 3
            low[axis], high[axis] = slice(0, n - d), slice(d, n)
            both(out[tuple(low)], a[tuple(high)], out=out[tuple(low)])
            both(out[tuple(high)], a[tuple(low)], out=out[tuple(high)])
        a = out
    return a


def _box(a: np.ndarray, r: int) -> np.ndarray:
    return _slid(a, r, np.add)


def _turned_pairs() -> np.ndarray:
    """(STEPS, 2, BITS, 2): both points (y, x) of each test under each direction."""
    points = _pairs.reshape(BITS, 2, 2).transpose(1, 0, 2)
    out = np.empty((STEPS, 2, BITS, 2), np.int64)
    quarter = STEPS // 4
    for k in range(quarter):
        c, s = np.cos(2 * np.pi * k / STEPS), np.sin(2 * np.pi * k / STEPS)
        turned = np.stack([s * points[..., 1] + c * points[..., 0], c * points[..., 1] - s * points[..., 0]], axis=-1)
        out[k] = np.clip(np.rint(turned), -RADIUS - 2, RADIUS + 2)
    for k in range(quarter, STEPS):
        out[k] = np.stack([out[k - quarter][..., 1], -out[k - quarter][..., 0]], axis=-1)
    return out


_TURNED = _turned_pairs()


def corners(stack: np.ndarray, per_cell: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, y, x) of the corners of each image of a stack of equal size: all, or the ``per_cell`` strongest of each cell."""
    gy, gx = np.zeros_like(stack), np.zeros_like(stack)
    gy[:, 1:-1] = stack[:, 2:] - stack[:, :-2]
    gx[:, :, 1:-1] = stack[:, :, 2:] - stack[:, :, :-2]
    a, b, c = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
    strength = a * b - c * c - np.float32(0.05) * (a + b) ** 2
    edge = RADIUS + 2
    strength[:, :edge] = strength[:, -edge:] = 0
    strength[:, :, :edge] = strength[:, :, -edge:] = 0
    image, y, x = np.nonzero((strength > 0) & (strength >= _slid(strength, 2, np.maximum)))
    if per_cell is None:
        return image, y, x
    across = -(-stack.shape[2] // CELL)
    cell = (image * (-(-stack.shape[1] // CELL)) + y // CELL) * across + x // CELL
    order = np.lexsort((x, y, -strength[image, y, x], cell))
    cell = cell[order]
    keep = order[np.arange(len(cell)) - np.searchsorted(cell, cell, side="left") < per_cell]
    return image[keep], y[keep], x[keep]


def describe_stack(stack: np.ndarray, per_cell: int | None) -> dict[str, np.ndarray]:
    """Image, place (in full-size pixels), scale, direction and four 32-bit words of each descriptor."""
    names = ("image", "y", "x", "octave", "angle", "words")
    found: list[tuple[np.ndarray, ...]] = [(np.empty(0, int), np.empty(0), np.empty(0), np.empty(0, int), np.empty(0), np.empty((0, 4), np.int64))]
    level = stack.astype(np.float32)
    for octave in range(2):
        if min(level.shape[1:]) < 2 * (RADIUS + 2) + 5:
            break
        smooth = _box(level, 1) / np.float32(9)
        image, y, x = corners(smooth, per_cell)
        width = level.shape[2]
        flat = smooth.reshape(-1)
        at = (image * level.shape[1] + y) * width + x
        patch = flat[at[:, None] + (_disc[:, 0] * width + _disc[:, 1])]
        angle = np.arctan2(patch @ _disc[:, 0].astype(np.float32), patch @ _disc[:, 1].astype(np.float32))
        step = np.rint(angle * (STEPS / (2 * np.pi))).astype(np.int64) % STEPS
        p, q = (flat[at[:, None] + (_TURNED[:, j, :, 0] * width + _TURNED[:, j, :, 1])[step]] for j in (0, 1))
        words = np.packbits(p < q - np.float32(0.01), axis=1).view(">u4").astype(np.int64)
        found.append((image, y * 2**octave, x * 2**octave, np.full(len(image), octave), angle, words))
        h, w = (n // 2 * 2 for n in level.shape[1:])
        level = level[:, :h, :w].reshape(len(level), h // 2, 2, w // 2, 2).mean(axis=(2, 4))
    return {k: np.concatenate([f[i] for f in found]) for i, k in enumerate(names)}


#: The pairs of words under which a descriptor stands.
PAIRS = tuple((a, b) for a in range(4) for b in range(a + 1, 4))
DESCRIPTOR = "digest string, y float, x float, octave int, angle float, w0 long, w1 long, w2 long, w3 long"
_NAMES = ["digest", "y", "x", "octave", "angle", "w0", "w1", "w2", "w3"]


def _described(digests: list[str], images: list[bytes | None], per_cell: int | None) -> Iterator[pa.RecordBatch]:
    """Descriptors of the distinct images, stack by stack."""
    by_shape: dict[tuple, dict[str, np.ndarray]] = {}
    for digest, data in dict(zip(digests, images, strict=True)).items():
        pixels = read_pgm(data)
        if pixels is not None and pixels.size:
            by_shape.setdefault(pixels.shape, {})[digest] = pixels
    for shape, group in by_shape.items():
        names, pixels = np.array(list(group)), list(group.values())
        step = max(1, 130_000 // (shape[0] * shape[1]))
        for k in range(0, len(names), step):
            d = describe_stack(np.stack(pixels[k : k + step]), per_cell)
            yield pa.RecordBatch.from_arrays([pa.array(names[k : k + step][d["image"]], pa.string()), *(pa.array(d[c].astype(np.float32)) for c in ("y", "x")), pa.array(d["octave"].astype(np.int32)), pa.array(d["angle"].astype(np.float32)), *(pa.array(np.ascontiguousarray(d["words"][:, j])) for j in range(4))], names=_NAMES)


def _hashed(media: DataFrame, id_col: str, image_col: str) -> DataFrame:
    return media.select(media[id_col].alias("media_id"), F.left(F.sha2(media[image_col], 256), F.lit(32)).alias("digest"), media[image_col].alias("image")).where("image is not null")


def members(media: DataFrame, id_col: str = "media_id", image_col: str = "image") -> DataFrame:
    """(media_id, digest): which class of identical images each one is in."""
    return _hashed(media, id_col, image_col).select("media_id", "digest")


def descriptors(media: DataFrame, id_col: str = "media_id", image_col: str = "image", per_cell: int | None = None) -> DataFrame:
    """(digest, y, x, octave, angle, w0..w3) of the images; identical ones of a batch are described once."""
    tune(media.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _described(batch.column(0).to_pylist(), batch.column(1).to_pylist(), per_cell)

    return _hashed(media, id_col, image_col).select("digest", "image").mapInArrow(run, DESCRIPTOR)


#: Bits of the filter that index words must pass; what it lets through in vain is sorted out by the join.
FILTER_BITS = 27


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _keyed(batch: pa.RecordBatch, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The descriptors of a batch under each pair of words; with a filter only those that pass it."""
    words = [np.asarray(batch.column(_NAMES.index(f"w{k}"))).astype(np.uint64) for k in range(4)]
    for k, (a, b) in enumerate(PAIRS):
        hashed = _mixed(((words[a] << np.uint64(32)) | words[b]) ^ _mixed(np.array([k + 1], np.uint64)))
        slots = hashed >> np.uint64(64 - FILTER_BITS)
        rows = batch
        if bits is not None:
            kept = np.flatnonzero((bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1)
            rows, hashed, slots = batch.take(pa.array(kept)), hashed[kept], slots[kept]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashed), k, np.int32)), pa.array(hashed.view(np.int64)), pa.array(slots.astype(np.int64) + 1), *rows.columns], names=["pair", "key", "slot", *_NAMES])


_KEYED = f"pair int, key long, slot long, {DESCRIPTOR}"


def _tables(d: DataFrame, passing: np.ndarray | None = None) -> DataFrame:
    """Descriptors under their keys."""
    tune(d.sparkSession)
    shared = None if passing is None else d.sparkSession.sparkContext.broadcast(passing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _keyed(batch, None if shared is None else shared.value)

    return d.select(*_NAMES).mapInArrow(run, _KEYED)


def _image_tables(media: DataFrame, passing: np.ndarray, id_col: str, image_col: str, per_cell: int | None) -> DataFrame:
    """As ``_tables`` of ``descriptors``, in one step: what the filter drops never leaves Python."""
    tune(media.sparkSession)
    shared = media.sparkSession.sparkContext.broadcast(passing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _described(batch.column(0).to_pylist(), batch.column(1).to_pylist(), per_cell):
                yield from _keyed(found, shared.value)

    return _hashed(media, id_col, image_col).select("digest", "image").mapInArrow(run, _KEYED)


def _filter_of(tables: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** FILTER_BITS bits, 16 MB, of the slots that occur: put together by Spark in pieces of 4 KB."""
    pieces = tables.groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("m"))
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in pieces.toLocalIterator():
        at = (row["b"] - 1) * 4096
        bits[at : at + 4096] |= np.frombuffer(bytes(row["m"]), np.uint8)[: len(bits) - at]
    return bits


def _whole(tables: DataFrame, mark: str) -> DataFrame:
    """One row for each key and descriptor, whichever batches its image was in."""
    return tables.select("pair", "key", F.struct(*_NAMES).alias(mark)).distinct()


def _geometry(asked: DataFrame, known: DataFrame, differing: int, agreeing: int, turn: float, shift: float) -> DataFrame:
    near = _whole(asked, "q").join(_whole(known, "i"), ["pair", "key"])
    bits = sum(F.bit_count(F.col(f"q.w{k}").bitwiseXOR(F.col(f"i.w{k}"))) for k in range(4))
    agree = [(F.col(f"q.w{a}") == F.col(f"i.w{a}")) & (F.col(f"q.w{b}") == F.col(f"i.w{b}")) for a, b in PAIRS]
    first = F.coalesce(*(F.when(x, F.lit(k)) for k, x in enumerate(agree)))  # of the pairs of words that agree
    scale = F.pow(F.lit(2.0), F.col("q.octave") - F.col("i.octave"))
    turned = F.pmod(F.degrees(F.col("q.angle") - F.col("i.angle")), F.lit(360.0))
    theta = F.radians(F.round(turned / turn) * turn)
    dy = F.col("q.y") - scale * (F.cos(theta) * F.col("i.y") + F.sin(theta) * F.col("i.x"))
    dx = F.col("q.x") - scale * (F.cos(theta) * F.col("i.x") - F.sin(theta) * F.col("i.y"))
    matched = materialize(near.where((bits <= differing) & (first == F.col("pair"))).select(F.col("q.digest").alias("asked"), F.col("i.digest").alias("found"), F.struct("i.y", "i.x", "i.octave").alias("spot"), (F.round(turned / turn) % int(360 / turn) * turn).alias("rotation"), scale.alias("scale"), dy.alias("dy"), dx.alias("dx")))
    # a bin cannot hold more spots than the pair has: lone chance hits never get as far as the bins
    pairs = matched.groupBy("asked", "found").agg(F.count_distinct("spot").alias("matches")).where(F.col("matches") >= agreeing)
    bins = F.array(*(F.struct(F.lit(a * 2 + b).alias("grid"), F.floor(F.col("dy") / shift + a * 0.5).alias("by"), F.floor(F.col("dx") / shift + b * 0.5).alias("bx")) for a in (0, 1) for b in (0, 1)))
    votes = matched.join(pairs, ["asked", "found"]).select("*", F.explode(bins).alias("bin")).groupBy("asked", "found", "matches", "rotation", "scale", "bin").agg(F.count_distinct("spot").alias("inliers"), F.avg("dy").alias("dy"), F.avg("dx").alias("dx"))
    best = votes.groupBy("asked", "found", "matches").agg(F.max(F.struct("inliers", (-F.col("rotation")).alias("back"), -F.col("bin.grid"), "scale", "dy", "dx")).alias("b"))
    return best.where(F.col("b.inliers") >= agreeing).select("asked", "found", "matches", F.col("b.inliers").alias("inliers"), (-F.col("b.back")).alias("rotation"), F.col("b.scale").alias("scale"), F.round("b.dy", 1).alias("dy"), F.round("b.dx", 1).alias("dx"))


def match(queries: DataFrame, index: DataFrame, differing: int = 24, agreeing: int = 3, turn: float = 30.0, shift: float = 8.0) -> DataFrame:
    """(asked, found, matches, inliers, rotation, scale, dy, dx): digests of images that share a geometry; both sides are descriptors.

    ``inliers`` places of ``found`` agree, out of ``matches``, within a bin of
    ``turn`` degrees and ``shift`` pixels; bins are laid out twice with half a
    bin between.
    """
    asked = materialize(_tables(queries))
    return _geometry(asked, _tables(index, _filter_of(asked)), differing, agreeing, turn, shift)


def search(queries: DataFrame, index: DataFrame, id_col: str = "media_id", image_col: str = "image", per_cell: int = 3, differing: int = 24, agreeing: int = 3, turn: float = 30.0, shift: float = 8.0) -> DataFrame:
    """As ``match``, from images: all corners of the queries, the ``per_cell`` strongest of each cell of the index.

    Words of the index that no query has are left out before the shuffle, by a
    filter of fixed size.
    """
    asked = materialize(_tables(descriptors(queries, id_col, image_col)))
    return _geometry(asked, _image_tables(index, _filter_of(asked), id_col, image_col, per_cell), differing, agreeing, turn, shift)


def copies(queries: DataFrame, index: DataFrame, id_col: str = "media_id", image_col: str = "image", **options) -> DataFrame:
    """(kind, media_id, class_id, of_class, matches, inliers, rotation, scale, dy, dx).

    ``indexed`` and ``query`` rows: the class (least id of identical images) of each image.
    ``copy`` rows: query class ``class_id`` shows a copy of a part of index class ``of_class``.
    """
    found = search(queries, index, id_col, image_col, **options)
    parts, named = [], {}
    for kind, media in (("indexed", index), ("query", queries)):
        mine = materialize(members(media, id_col, image_col))
        least = mine.groupBy("digest").agg(F.min("media_id").alias("class_id"))
        named[kind] = least
        parts.append(mine.join(least, "digest").select(F.lit(kind).alias("kind"), "media_id", "class_id"))
    asked = named["query"].select(F.col("digest").alias("asked"), "class_id")
    of = named["indexed"].select(F.col("digest").alias("found"), F.col("class_id").alias("of_class"))
    pairs = found.join(asked, "asked").join(of, "found").drop("asked", "found").withColumn("kind", F.lit("copy"))
    return parts[0].unionByName(parts[1]).unionByName(pairs, allowMissingColumns=True)


def page_images(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", copies: bool = False) -> DataFrame:
    """(media_id, image): a picture of each page, or the edited copy of it; a null page has none."""
    tune(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            made = []
            for number, text in zip(ids, texts_of(batch, "__text"), strict=True):
                pixels = draw(text)
                made.append(write_pgm(edit(pixels, (number or 0) // 50) if copies else pixels))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["media_id", "image"])

    return pages.where(pages[html_col].isNotNull()).select(pages[id_col].alias("media_id"), pages[html_col].cast("string").cast("binary").alias("__text")).mapInArrow(run, f"media_id {kind}, image binary")
