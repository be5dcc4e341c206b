"""Byte-level BPE as a monoid: encoded halves are joined, decoded halves are concatenated.

A text is cut into halves until they are short, and so is each long piece of it.
Neighbours are joined by doing the boundary again in a window that grows until
what lies outside provably stays:

* Pieces (matches of the pattern): a match of the left half stays if at least
  ``LOOK`` characters follow it there, because the pattern never looks further
  than that past a match. From the last such match on the window is matched
  again; the rest of the right half stays as soon as a match ends where one of
  its own does, because the pattern never looks back.
* Tokens (of one piece): merges take the least rank first, the leftmost of
  equals. Merges inside one token do not depend on its neighbours until a merge
  crosses a boundary, and the first merge that crosses one would also happen if
  the two tokens stood alone. So a sequence of tokens is the encoding of its
  bytes if and only if each two neighbours are the encoding of theirs. The
  window is encoded anew and grows on the side where it does not yet fit.

Merges of bytes are plain at the leaves and inside windows. Pieces already seen
are kept in a bounded memo of the worker process.

Defined results: null and empty texts have no ids; the digest of no ids is that
of the empty string. Rows that repeat, null ids and ties stay rows: each row is
encoded on its own, in one pass without a shuffle. Long texts go in portions of
``PORTION`` characters, so working memory is bounded by a portion, its ids and
the longest piece; ``encode`` returns a text's ids in one value, which ends at
2^29 ids. Bytes that are no UTF-8 become U+FFFD first. Extra columns are
ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, tune

# The pattern that splits texts before merges, and how far it looks past the end of a match.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOOK = 2
#: Characters of a text and bytes of a piece below which halves are not cut further, characters that are encoded at once, and ids that are decoded at once.
LEAF_CHARS, LEAF_BYTES, PORTION, LEAF_IDS = 1 << 16, 16, 1 << 20, 1 << 16
#: Up to this length a window's pairs are searched in a list; the rank of a pair that is no token.
SHORT_BYTES, NEVER = 64, 1 << 62
#: Pieces and pairs of tokens that a worker remembers; a full memo of pairs starts anew. Longer pieces are not remembered.
MEMO_PIECES, MEMO_PAIRS, MEMO_CHARS = 400_000, 200_000, 64


def ascii_form(pattern: str) -> re.Pattern | None:
    """The pattern for texts of ASCII only, in the faster of the two matchers; None if it names other classes than letters and numbers."""
    found = "".join(p.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9") if p.startswith("[") else p.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]") for p in re.split(r"(\[[^\]]*\])", pattern))
    return None if re.search(r"\\[pPXRNhH]", found) else re.compile(found, re.ASCII)


def halves(whole, leaf: Callable, join: Callable, size: int):
    """``leaf`` of parts of at most ``size``, joined up the tree. Cuts are at powers of two, which suits repetitive input."""
    if len(whole) <= size:
        return leaf(whole)
    cut = 1 << (len(whole) - 1).bit_length() - 1
    return join(halves(whole[:cut], leaf, join, size), halves(whole[cut:], leaf, join, size))


class _Memo(dict):
    """What ``make`` gives for a piece; two generations of at most ``MEMO_PIECES`` pieces, so that frequent ones stay."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make, self.older = make, {}

    def __missing__(self, piece: str) -> bytes:
        made = self.older.get(piece)
        if made is None:
            made = self.make(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = made
        return made


class Bpe:
    """A vocabulary of byte sequences by rank; the rank of a token is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        import regex

        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.decimals = {r: b"%d" % r for r in self.tokens}
        self.general, self.ascii = regex.compile(pattern), ascii_form(pattern)
        self.memo = _Memo(lambda piece: struct.pack(f"<{len(ids := self.encode_piece(piece.encode()))}I", *ids))
        self.pairs: dict[tuple[int, int], bool] = {}

    # tokens of one piece

    def merged(self, data: bytes) -> list[int]:
        """The tokens that plain merging leaves of ``data``; long windows keep their pairs in a heap."""
        n, ranks = len(data), self.ranks
        if n <= SHORT_BYTES:
            get, ends = ranks.get, [*range(n + 1)]
            pairs = [get(data[i : i + 2], NEVER) for i in range(n - 1)]
            while pairs and (least := min(pairs)) != NEVER:
                k = pairs.index(least)
                del pairs[k], ends[k + 1]
                if k < len(pairs):
                    pairs[k] = get(data[ends[k] : ends[k + 2]], NEVER)
                if k:
                    pairs[k - 1] = get(data[ends[k - 1] : ends[k + 1]], NEVER)
            return [ranks[data[a:b]] for a, b in zip(ends, ends[1:])]
        end, back = [*range(1, n + 1)], [*range(-1, n)]  # a part's end by its start (0: no part starts here), its start by its end
        todo = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(todo)
        while todo:
            _, i, stop = heapq.heappop(todo)
            middle = end[i]
            if not 0 < middle < n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                back[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(todo, (r, i, end[stop]))
            else:
                back[n] = i
            if i and (r := ranks.get(data[back[i] : stop])) is not None:
                heapq.heappush(todo, (r, back[i], stop))
        found, i = [], 0
        while i < n:
            found.append(ranks[data[i : end[i]]])
            i = end[i]
        return found

    def stands(self, a: int, b: int) -> bool:
        """Whether the tokens ``a`` and ``b`` are the encoding of their bytes, so that the boundary between them stays."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def join_tokens(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of the bytes of ``a`` and ``b``, which are encodings."""
        if not a or not b or self.stands(a[-1], b[0]):
            return a + b
        left = right = 1
        while True:
            i, j = max(0, len(a) - left), min(len(b), right)
            window = self.merged(self.decode(a[i:]) + self.decode(b[:j]))
            fits_left, fits_right = i == 0 or self.stands(a[i - 1], window[0]), j == len(b) or self.stands(window[-1], b[j])
            if fits_left and fits_right:
                return a[:i] + window + b[j:]
            left, right = left if fits_left else 2 * left, right if fits_right else 2 * right

    def encode_piece(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern; a piece that is a token is that token."""
        known = self.ranks.get(data)
        return [known] if known is not None else halves(data, self.merged, self.join_tokens, LEAF_BYTES)

    # pieces of one text

    def match(self, text: str) -> list[str]:
        return (self.ascii if self.ascii and text.isascii() else self.general).findall(text)

    @staticmethod
    def settled(pieces: list[str]) -> int:
        """How many of the pieces stay whatever follows."""
        k, held = len(pieces), 0
        while k and held < LOOK:
            k -= 1
            held += len(pieces[k])
        return k

    def join_pieces(self, a: list[str], b: list[str]) -> list[str]:
        """The matches of the text of ``a`` and ``b``, which are the matches of theirs."""
        keep, width = self.settled(a), 2
        rest = "".join(a[keep:])
        while True:
            j = min(len(b), width)
            window = self.match(rest + "".join(b[:j]))
            if j == len(b):
                return a[:keep] + window
            ends, at = {len(rest): 0}, len(rest)
            for k in range(j):
                at += len(b[k])
                ends[at] = k + 1
            at = 0
            for k in range(self.settled(window)):
                at += len(window[k])
                if at in ends:
                    return a[:keep] + window[: k + 1] + b[ends[at] :]
            width *= 2

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The matches of the text, portion by portion; what a portion may still change is carried into the next one."""
        held = ""
        for k in range(0, len(text), PORTION):
            found = halves(held + text[k : k + PORTION], self.match, self.join_pieces, LEAF_CHARS)
            keep = self.settled(found) if k + PORTION < len(text) else len(found)
            held = "".join(found[keep:])
            yield found[:keep]

    # whole texts

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """The ids of the text, portion by portion."""
        for found in self.pieces(text):
            yield np.frombuffer(b"".join(map(self.memo.__getitem__, found)), "<u4")

    def decode(self, ids) -> bytes:
        return halves(ids, lambda part: b"".join(map(self.tokens.__getitem__, part)), bytes.__add__, LEAF_IDS)


_known: dict[tuple[str, str], Bpe] = {}


def read(path: str, pattern: str = PATTERN) -> Bpe:
    """The vocabulary of a rank file (base64 token and rank on each line), read once by each process."""
    if (path, pattern) not in _known:
        _known[path, pattern] = Bpe({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())}, pattern)
    return _known[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of each document."""

    def run(texts: list[bytes]) -> dict[str, pa.Array]:
        bpe = read(path, pattern)
        ids = [[*bpe.encode(t.decode(errors="replace"))] for t in texts]
        sizes = np.array([sum(map(len, x)) for x in ids], np.int64)
        flat = np.concatenate([np.empty(0, "<u4"), *(y for x in ids for y in x)]).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))}

    return map_texts(docs, id_col, text_col, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, data binary): the bytes of each row's ids; null ids have none."""
    tune(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = read(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "data"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, f"doc_id {encoded.schema[id_col].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text is encoded and its ids are decoded, portion by portion."""

    def digests(bpe: Bpe, text: bytes) -> tuple[int, str, str]:
        n, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
        for ids in bpe.encode(text.decode(errors="replace")):
            if len(ids):
                listed = ids.tolist()
                ids_hash.update((b" " if n else b"") + b" ".join(map(bpe.decimals.__getitem__, listed)))
                bytes_hash.update(bpe.decode(listed))
                n += len(listed)
        return n, ids_hash.hexdigest(), bytes_hash.hexdigest()

    def run(texts: list[bytes]) -> dict[str, pa.Array]:
        bpe = read(path, pattern)
        n, ids_hash, bytes_hash = zip(*(digests(bpe, t) for t in texts), strict=True)
        return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_hash), "decoded_sha256": pa.array(bytes_hash)}

    return map_texts(docs, id_col, text_col, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
