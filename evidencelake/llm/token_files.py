"""Token ids in Huffman-coded block files.

Texts are tokenized once and their ids written to the shared folder. A pass over
them counts all ids; the counts give one length-limited canonical Huffman code
for the corpus (package-merge). Ids are then dealt into ranges of ascending
document ids and encoded there. A file row is one independent block: some
documents, their numbers of ids, the coded words, and a checkpoint (bit offset)
every ``STEP`` ids, from which a table-driven decoder can start. The code
lengths are written beside the blocks, so the files stand alone.

A tokenizer whose normaliser and splitter are the known ones, which drop white
space, gets texts cut at ASCII white space, in portions of bounded size, and the
ids of pieces already seen are kept in a bounded memo of the worker process; any
other tokenizer gets whole texts.

Defined results: a null or empty text has the end id alone. Rows with equal ids
stand in the order of a hash of their token ids, then of these; null ids come
last. Rows that repeat stay rows. Texts of any length are encoded whole, their
working memory bounded by portions. Other columns of the input are ignored,
whatever their names. An empty table makes an empty file.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, run_dir, texts_of, tune

STEP = 512
MAX_BITS = 16
BLOCK_IDS = 1 << 16
MEMO_PIECES = 400_000
MEMO_RUNS = 150_000
MEMO_BYTES = 40
#: Bytes of text that are tokenized at once, ids that are coded at once, bytes of ids of one file.
PORTION, CHUNK, PART_BYTES = 2 << 20, STEP << 9, 16 << 20

# The configuration of tokenizers that may get texts piece by piece.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_encoders: dict[str, "_Encoder"] = {}


#: Letters of ASCII and Latin-1, then ASCII punctuation without the apostrophe: the tokenizer cuts between the two runs.
_SIMPLE = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)")
#: What may be hidden in such a piece.
_INSIDE = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*[!-&(-/:-@\[-`{-~]*")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACE = re.compile(rb"[\t-\r ]")
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(MEMO_BYTES, 0x9E3779B97F4A7C15, np.uint64)])


class _Encoder:
    """The tokenizer of a worker process, with a bounded memo of pieces: sorted 64-bit hashes, the pieces' bytes, and the ids behind each.

    A hash only finds a piece; its bytes are compared before its ids are taken.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        # the bytes of all pieces, and where those of each key stand
        self.letters, self.written = np.zeros(1 << 16, np.uint8), 0
        self.spelled, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.runs: dict[str, list[int]] = {}
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: spell.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        config = json.loads(self.tokenizer.to_str())
        added = [t["content"] for t in config["added_tokens"]]
        known = config["normalizer"] == NORMALIZER and config["pre_tokenizer"] == PRE_TOKENIZER and config["post_processor"] is None and not config["model"].get("dropout")
        #: Whether white space parts texts for this tokenizer, and whether simple pieces are cut as ``_cut`` does.
        self.parted = known and not any(re.search(r"\s", t) for t in added) and not any(t["lstrip"] or t["rstrip"] for t in config["added_tokens"])
        self.simple = self.parted and not any(_INSIDE.fullmatch(t) for t in added)

    def _run(self, text: str) -> list[int]:
        """Ids of a new run of letters in lower case, or of punctuation, straight from the BPE model."""
        ids = [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.bytes_of))]
        if len(self.runs) < MEMO_RUNS:
            self.runs[text] = ids
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int] | None] = []
        hard = []
        seen, run, simple, cut = self.runs.get, self._run, self.simple, _SIMPLE.fullmatch
        for k, piece in enumerate(pieces):
            if simple and piece.isalpha():
                text = piece.lower().decode()
                out.append(seen(text) or run(text))
                continue
            match = cut(piece.decode()) if simple and len(piece) <= MEMO_BYTES else None
            if match is None:
                out.append(None)
                hard.append(k)
                continue
            text, stops = match.groups()
            text = text.lower()
            ids = seen(text) or run(text)
            out.append(ids + (seen(stops) or run(stops)) if stops else ids)
        for k, got in zip(hard, self.tokenizer.encode_batch_fast([pieces[k].decode() for k in hard], add_special_tokens=False), strict=True):
            out[k] = got.ids
        return out

    def _remember(self, keys: np.ndarray, pieces: list[bytes], ids: list[list[int]]) -> None:
        """Add sorted new keys while there is room."""
        room = max(0, MEMO_PIECES - len(self.keys))
        keys, pieces, ids = keys[:room], pieces[:room], ids[:room]
        if not len(keys):
            return
        count, sizes = np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(map(len, pieces), np.int64, len(pieces))
        new, letters = np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum())), np.frombuffer(b"".join(pieces), np.uint8)
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while self.written + len(letters) > len(self.letters):
            self.letters = np.concatenate([self.letters, np.zeros(len(self.letters), np.uint8)])
        self.flat[self.used : self.used + len(new)] = new
        self.letters[self.written : self.written + len(letters)] = letters
        at = np.searchsorted(self.keys, keys)
        for name, values in (("keys", keys), ("first", self.used + np.cumsum(count) - count), ("count", count), ("spelled", self.written + np.cumsum(sizes) - sizes), ("sizes", sizes)):
            setattr(self, name, np.insert(getattr(self, name), at, values))
        self.used += len(new)
        self.written += len(letters)

    def encode(self, texts: list[bytes], end_id: int | None, closed: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and how many each has; ``end_id`` stands behind each, or behind those of ``closed``."""
        closed = np.ones(len(texts), bool) if closed is None else np.array(closed, bool)
        if not self.parted:
            made = [got.ids + ([end_id] if end and end_id is not None else []) for got, end in zip(self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False), closed.tolist(), strict=True)]
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            return np.fromiter(chain.from_iterable(made), np.uint32, int(sizes.sum())), sizes
        data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(data, np.uint8)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        space = _IS_SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        edge = edge if space[0] else np.r_[0, edge]
        starts, ends = edge[0 : len(edge) // 2 * 2 : 2], edge[1::2]  # the last byte is a space
        sizes = ends - starts
        short = sizes <= MEMO_BYTES
        letters = np.flatnonzero(~space)
        inside = letters - np.repeat(starts, sizes)
        terms = (raw[letters].astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(inside, MEMO_BYTES)]
        before = np.cumsum(sizes) - sizes
        hashes = (np.add.reduceat(terms, before) if len(starts) else np.zeros(0, np.uint64)) ^ (sizes.astype(np.uint64) << np.uint64(56))
        long = np.flatnonzero(~short)
        hashes[long] = np.arange(len(long), dtype=np.uint64)  # long pieces stand for themselves
        keys, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        # pieces that share a hash are compared byte by byte; one that differs from its sample stands for itself
        like = sample[which]
        other = np.minimum(np.repeat(starts[like], sizes) + inside, len(raw) - 1)
        differ = raw[letters] != raw[other]
        odd = sizes != sizes[like]
        if differ.any() or odd.any():
            odd |= np.add.reduceat(differ, before) > 0
            bad = np.flatnonzero(odd)
            which[bad] = len(keys) + np.arange(len(bad))
            keys, sample = np.r_[keys, np.zeros(len(bad), np.uint64)], np.r_[sample, bad]
        own = ~short[sample]
        own[len(keys) - int(odd.sum()) :] = True
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = (self.keys[at] == keys) & ~own if len(self.keys) else np.zeros(len(keys), bool)
        hit = np.flatnonzero(known)
        long_as = sizes[sample[hit]]
        same = long_as == self.sizes[at[hit]]
        step = np.arange(int(long_as.sum())) - np.repeat(np.cumsum(long_as) - long_as, long_as)
        theirs = self.letters[np.minimum(np.repeat(self.spelled[at[hit]], long_as) + step, len(self.letters) - 1)]
        differ = raw[np.repeat(starts[sample[hit]], long_as) + step] != theirs
        if differ.any():
            same &= np.add.reduceat(differ, np.cumsum(long_as) - long_as) == 0
        known[hit[~same]] = False
        own[hit[~same]] = True  # its key is taken
        count = np.zeros(len(keys) + 2, np.int64)
        first = np.zeros(len(keys) + 2, np.int64)
        count[:-2][known], first[:-2][known] = self.count[at[known]], self.first[at[known]]
        new = np.flatnonzero(~known)
        spelling = [data[a:b] for a, b in zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)]
        made = self.encode_pieces(spelling)
        made.append([] if end_id is None else [end_id])
        places = np.r_[new, len(keys)]
        count[places] = np.fromiter(map(len, made), np.int64, len(made))
        first[places] = self.used + np.cumsum(count[places]) - count[places]
        source = np.concatenate([self.flat[: self.used], np.fromiter(chain.from_iterable(made), np.uint32)])
        # the words of each text, then its end, or nothing
        words = np.searchsorted(starts, text_ends)
        order = np.insert(which, words, np.where(closed, len(keys), len(keys) + 1))
        n = count[order]
        total = np.cumsum(n)
        ids = source[np.repeat(first[order] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        last = words + np.arange(len(words))  # where the ends stand in `order`
        fresh = np.flatnonzero(~own[new])
        self._remember(keys[new[fresh]], [spelling[k] for k in fresh.tolist()], [made[k] for k in fresh.tolist()])
        return ids, np.diff(np.r_[0, total[last]])


def _encoder(path: str) -> _Encoder:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def encode_texts(texts: list[bytes], path: str, end_id: int | None) -> list[np.ndarray]:
    """The ids of whole texts, each with ``end_id`` behind them."""
    ids, sizes = _encoder(path).encode(texts, end_id)
    return np.split(ids, np.cumsum(sizes)[:-1]) if texts else []


def _portions(texts: list[bytes], parted: bool, size: int | None = None) -> Iterator[tuple[list[bytes], list[bool]]]:
    """Some texts at a time, and whether each ends there; if ``parted``, a long text is cut at white space."""
    size = size or PORTION
    held: list[bytes] = []
    ends: list[bool] = []
    n = 0
    for text in texts:
        at = 0
        while at < len(text) or not text:
            cut = len(text)
            if parted and len(text) - at > size:
                space = _SPACE.search(text, at + size)
                cut = space.start() if space else len(text)
            held.append(text[at:cut])
            ends.append(cut == len(text))
            n += cut - at
            at = cut
            if n >= size:  # a text that goes on always ends its portion
                yield held, ends
                held, ends, n = [], [], 0
            if not text:
                break
    if held:
        yield held, ends


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need more than {limit} bits")
    weights = counts[used].astype(np.int64)
    order = np.argsort(weights, kind="stable")
    weights = weights[order]
    # each level merges the leaves with packages of two of the level below
    merged, kinds = weights, [np.zeros(len(weights), bool)]
    for _ in range(limit - 1):
        packages = merged[0 : len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        by = np.argsort(both, kind="stable")
        merged = both[by]
        kinds.append(by >= len(weights))
    take = 2 * len(weights) - 2
    bits = np.zeros(len(weights), np.int64)
    for kind in reversed(kinds):
        packages = int(kind[:take].sum())
        bits[: take - packages] += 1
        take = 2 * packages
    lengths[used[order]] = bits
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: shorter ones first, equal lengths by id."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    steps = np.int64(1) << (MAX_BITS - lengths[used].astype(np.int64))
    codes[used] = ((np.cumsum(steps) - steps) >> (MAX_BITS - lengths[used].astype(np.int64))).astype(np.uint32)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next MAX_BITS bits: the id and its code's length."""
    codes = canonical(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    span = np.int64(1) << (MAX_BITS - lengths[used].astype(np.int64))
    ids, bits = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.uint8)
    total = int(span.sum())
    ids[:total], bits[:total] = np.repeat(used, span), np.repeat(lengths[used], span)
    assert not len(used) or codes[used[0]] == 0
    return ids, bits


def pack_long(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """As ``pack``, of one document of any size: chunks begin at whole words, and every one of them at a checkpoint."""
    streams, marks, words = [], [], 0
    for at in range(0, len(ids), CHUNK):
        part = ids[at : at + CHUNK]
        (stream,), (mark,) = pack(part, np.array([len(part)]), lengths, codes)
        streams.append(stream)
        marks.append(mark + 32 * words)
        words += len(stream) // 4
    return b"".join(streams), np.concatenate(marks)


def pack(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
    """Coded 32-bit words of each document, and its checkpoints; ``sizes`` are the documents' numbers of ids, none of them 0."""
    bits = lengths[ids].astype(np.int64)
    first = np.cumsum(sizes) - sizes
    ends = np.cumsum(bits)
    base = ends[first] - bits[first]  # every document has its end id at least
    used = np.add.reduceat(bits, first)
    words = -(-used // 32)
    start = np.cumsum(words) - words
    local = ends - bits - np.repeat(base, sizes)  # in bits from the document's start
    at = local + np.repeat(start * 32, sizes)
    word, shift = at >> 5, 64 - (at & 31) - bits
    value = codes[ids].astype(np.uint64) << shift.astype(np.uint64)
    n = int(words.sum()) + 1
    high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n)
    low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)[:n]
    stream = (high + low).astype(np.uint64).astype(">u4").tobytes()
    coded = [stream[4 * a : 4 * (a + w)] for a, w in zip(start.tolist(), words.tolist(), strict=True)]
    marks = [local[f : f + s : STEP].astype(np.int64) for f, s in zip(first.tolist(), sizes.tolist(), strict=True)]
    return coded, marks


def unpack(stream: bytes, offsets: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids behind each checkpoint, one after the other: all checkpoints are decoded in step."""
    ids, bits = table
    words = np.frombuffer(stream, ">u4").astype(np.uint64)
    pairs = (words << np.uint64(32)) | np.r_[words[1:], np.zeros(1, np.uint64)] if len(words) else words
    order = np.argsort(-counts, kind="stable")
    place = (np.cumsum(counts) - counts)[order]
    at = offsets[order].astype(np.int64)
    live = np.searchsorted(-counts[order], -np.arange(int(counts.max(initial=0))), side="left")
    out = np.zeros(int(counts.sum()), "<u4")
    drop = np.uint64(64 - MAX_BITS)
    for k, n in enumerate(live.tolist()):
        a = at[:n]
        peek = (pairs[a >> 5] << (a & 31).astype(np.uint64)) >> drop
        out[place[:n] + k] = ids[peek]
        a += bits[peek]
    return out


def encoded(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, ids binary) of all texts, written to the shared folder: texts are tokenized once. Two bytes for each id if all fit."""
    tune(docs.sparkSession)
    kind = id_type(tokenizer, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            done, begun = 0, b""
            for texts, ends in _portions(texts_of(batch, "__text"), encoder.parted):
                ids, sizes = encoder.encode(texts, end_id, ends)
                data = ids.astype(kind)
                last = np.cumsum(sizes)
                rows = [data[a:b].tobytes() for a, b in zip((last - sizes).tolist(), last.tolist(), strict=True)]
                rows[0] = begun + rows[0]
                begun = b"" if ends[-1] else rows.pop()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(rows)), pa.array(rows, pa.binary())], names=["doc_id", "ids"])
                done += len(rows)

    return materialize(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("__text")).mapInArrow(run, "doc_id long, ids binary"))


def id_type(tokenizer: str, end_id: int | None) -> str:
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id or 0) <= 1 << 16 else "<u4"


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and how many each row has."""
    rows = column.to_pylist()
    ids = np.frombuffer(b"".join(rows), kind)
    return ids, np.fromiter(map(len, rows), np.int64, len(rows)) // ids.itemsize


def id_counts(ids: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            got = np.bincount(_flat(batch.column(0), kind)[0])
            if len(got) < len(total):
                got.resize(len(total))
            got[: len(total)] += total
            total = got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)  # at most the vocabulary's size
    counts[rows["id"]] = rows["n"]
    return counts


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> None:
    """Write the ids of all texts, in ascending order of ``id_col`` (an integer), as coded blocks under ``path``."""
    spark = docs.sparkSession
    kind = id_type(tokenizer, end_id)
    tokens = encoded(docs, tokenizer, end_id, id_col, text_col)
    lengths = code_lengths(id_counts(tokens, kind))
    codes = canonical(lengths)
    width = np.dtype(kind).itemsize
    spark.createDataFrame([(lengths.tobytes(), MAX_BITS, STEP)], "lengths binary, max_bits int, step int").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast((lengths, codes))
    if parts is None:  # by size, so that a part stays a part at any scale
        parts = -(-(tokens.agg(F.coalesce(F.sum(F.length("ids")), F.lit(0))).first()[0] or 0) // PART_BYTES) or 1

    def coded(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, bytes, bytes]]:
        """(doc_id, number of ids, checkpoints, coded words) of each row."""
        lens, words = shared.value
        names, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        held: list[int] = []
        size = 0
        for k, row in enumerate(rows):
            n = len(row) // width
            if n > CHUNK:
                stream, marks = pack_long(np.frombuffer(row, kind), lens, words)
                yield from packed(held, names, rows, lens, words)
                held, size = [], 0
                yield names[k], n, marks.astype("<i8").tobytes(), stream
                continue
            held.append(k)
            size += n
            if size > CHUNK:
                yield from packed(held, names, rows, lens, words)
                held, size = [], 0
        yield from packed(held, names, rows, lens, words)

    def packed(held: list[int], names: list, rows: list[bytes], lens: np.ndarray, words: np.ndarray) -> Iterator[tuple]:
        full = [k for k in held if rows[k]]  # without an end id a text may have no ids
        sizes = np.array([len(rows[k]) // width for k in full], np.int64)
        made = zip(*pack(np.frombuffer(b"".join(rows[k] for k in full), kind), sizes, lens, words), strict=True) if full else iter(())
        for k in held:
            stream, marks = next(made) if rows[k] else (b"", np.empty(0, np.int64))
            yield names[k], len(rows[k]) // width, marks.astype("<i8").tobytes(), stream

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        ids = number = before = 0
        part = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            row = {"part": part, "block": number, "ids_before": before, "doc_ids": [h[0] for h in held], "n_ids": [h[1] for h in held], "marks": b"".join(h[2] for h in held), "words": [len(h[3]) // 4 for h in held], "stream": b"".join(h[3] for h in held)}
            return pa.RecordBatch.from_pylist([row], schema=out)

        out = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("ids_before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.list_(pa.int64())), ("marks", pa.binary()), ("words", pa.list_(pa.int64())), ("stream", pa.binary())])
        for batch in batches:
            for doc, n, marks, stream in coded(batch):
                if held and ids + n > BLOCK_IDS:
                    yield flush()
                    number, before, held, ids = number + 1, before + ids, [], 0
                held.append((doc, n, marks, stream))
                ids += n
        if held:
            yield flush()

    # the hash parts rows that share an id, or have none
    keys = (F.col("doc_id").asc_nulls_last(), F.col("mark"))
    ordered = tokens.select("doc_id", F.xxhash64("ids").alias("mark"), "ids").repartitionByRange(parts, *keys).sortWithinPartitions(*keys, "ids").select("doc_id", "ids")
    ordered.mapInArrow(blocks, "part int, block long, ids_before long, doc_ids array<long>, n_ids array<long>, marks binary, words array<long>, stream binary").write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files; with their ids if asked for."""
    tune(spark)
    code = spark.read.parquet(f"{path}/code").first()
    lengths = np.frombuffer(bytes(code["lengths"]), np.uint8)
    step = code["step"]
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    sums = blocks.groupBy("part").agg(F.max(F.col("ids_before") + F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    # one row for each range of ids, as many as partitions were asked for
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ids_of_parts"))

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(shared.value)
        for batch in batches:
            held: list[dict] = []
            for row in batch.to_pylist():
                held.append(row)
                if sum(len(r["stream"]) for r in held) > 4 << 20:  # bounds memory, and is enough to decode in step
                    yield several(held, table)
                    held = []
            if held:
                yield several(held, table)

    def several(rows: list[dict], table: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        """The documents of some blocks: all their checkpoints are decoded in step."""
        n = np.array(list(chain.from_iterable(r["n_ids"] for r in rows)), np.int64)
        words = np.array(list(chain.from_iterable(r["words"] for r in rows)), np.int64)
        segments = -(-n // step)
        counts = np.full(int(segments.sum()), step, np.int64)
        counts[(np.cumsum(segments) - 1)[n > 0]] = (n - (segments - 1) * step)[n > 0]
        offsets = np.frombuffer(b"".join(r["marks"] for r in rows), "<i8") + np.repeat(32 * (np.cumsum(words) - words), segments)
        ids = unpack(b"".join(r["stream"] for r in rows), offsets, counts, table)
        ends = np.cumsum(n)
        view = memoryview(ids).cast("B")
        spans = list(zip((ends - n).tolist(), ends.tolist(), strict=True))
        docs_of = [len(r["n_ids"]) for r in rows]
        first = np.cumsum(docs_of) - docs_of
        before = np.array([r["ids_of_parts"] + r["ids_before"] for r in rows], np.int64) - (ends - n)[first]
        made = [pa.array(list(chain.from_iterable(r["doc_ids"] for r in rows)), pa.int64()), pa.array(np.repeat(before, docs_of) + ends - n), pa.array(n), pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in spans], pa.int64())]
        if with_ids:
            made.append(pa.array([ids[a:b].tolist() for a, b in spans], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(made, names=names)

    # `before` has a row for each part; Spark broadcasts it if it is small by its own measure
    return blocks.join(before, "part").drop("part", "block").mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))


def token_ids(docs: DataFrame, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the files (into the shared folder unless ``path`` is given) and read them back."""
    path = path or f"{run_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, end_id, id_col, text_col)
    return read_tokens(docs.sparkSession, path)
