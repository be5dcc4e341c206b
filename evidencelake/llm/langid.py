"""Language identification by interpolated Kneser-Ney character models.

A text is composed (NFC), lower-cased and reduced to its letters and their marks, with one space between runs.
For each language a Kneser-Ney model of ``ORDER`` characters is estimated; all
models live in one set of sorted hash arrays, with a vector of log
probabilities (one entry for each language) behind each hash, so a text is
scored for all languages by one search for each character. Runs of characters
no language has seen back off to shorter ones. The language of the lowest
cross-entropy for each character wins; its score is the posterior of a
temperature fitted on the training rows, where a floor for ``accepted`` is
also taken.

The models are fitted on at most about ``rows_per_language`` labelled rows of
each language (a documented bound, drawn by hash), on their whole texts;
prediction covers every row and whole texts, without a shuffle of them.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if no row can be learned from. Of languages of equal
cross-entropy the first by name wins. A text of any length is scored whole, in
pieces. Rows that repeat stay rows and score alike; a null id is in the fold of
the empty text and never learned from. Empty tables give no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, map_texts, materialize, tune

ORDER = 4
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
# combining marks belong to the letter before them: vowel signs are no end of a word
_IS_MARK = np.array([unicodedata.category(chr(c)) in ("Mn", "Mc") for c in range(0x110000)])
_NOT_LETTERS_OR_MARKS = regex.compile(r"[\W\d\p{Pc}]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def letters(text: bytes) -> str:
    """Letters with their marks, composed and in lower case, single spaces between and around them; empty if there is no letter."""
    shown, apart = text.decode(), _NOT_LETTERS
    if shown.isascii():
        shown = shown.lower()
    else:
        shown = unicodedata.normalize("NFC", shown).lower()
        if _IS_MARK[np.frombuffer(shown.encode("utf-32-le", "surrogatepass"), "<u4")].any():
            apart = _NOT_LETTERS_OR_MARKS  # whose words hold marks
    kept = apart.sub(" ", shown).strip()
    if not kept.replace(" ", "").isalpha() and not any(map(str.isalpha, kept)):
        return ""
    return f" {kept} "


def gram_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """For n = 1..ORDER the hash of the n characters that end at each position (those from n - 1 on are whole)."""
    found = [codes.astype(np.uint64) + np.uint64(1)]
    for n in range(1, ORDER):
        longer = np.zeros(len(codes), np.uint64)
        longer[n:] = found[-1][n - 1 : -1] * BASE + found[0][n:]
        found.append(longer)
    return [_mixed(h) for h in found]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _join(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all pieces, one after the other, and where each starts."""
    return np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32), np.cumsum([0, *map(len, pieces)])


def _pieces(texts: list[str], size: int = 300_000) -> Iterator[tuple[list[int], list[str]]]:
    """Portions of about ``size`` characters: numbers of texts, and pieces of them that begin with ORDER - 1 characters of context.

    The first piece of a text begins with spaces; a text longer than ``size`` is cut into several.
    """
    owners: list[int] = []
    pieces: list[str] = []
    held = 0
    lead = " " * (ORDER - 2)
    for k, text in enumerate(texts):
        for a in range(1, len(text), size):
            pieces.append(lead + text[: size + 1] if a == 1 else text[a - ORDER + 1 : a + size])
            owners.append(k)
            held += len(pieces[-1])
            if held > size:
                yield owners, pieces
                owners, pieces, held = [], [], 0
    if pieces:
        yield owners, pieces


class Sparse:
    """Values of the languages that have a run, run after run: for models whose full table would be large."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, data: np.ndarray) -> None:
        self.starts, self.columns, self.data = starts, columns, data

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each value of the given runs: the number of the run among them, the language, the value."""
        lengths = self.starts[rows + 1] - self.starts[rows]
        owner = np.repeat(np.arange(len(rows)), lengths)
        flat = np.arange(len(owner)) + np.repeat(self.starts[rows] - (np.cumsum(lengths) - lengths), lengths)
        return owner, self.columns[flat], self.data[flat]


def gathered(per_language: list[tuple[np.ndarray, np.ndarray]], width: int, empty: float, dense_cells: int) -> tuple[np.ndarray, np.ndarray | Sparse]:
    """Sorted distinct keys of all languages with their values: a full table if it has at most ``dense_cells`` entries."""
    keys = np.unique(np.concatenate([k for k, _ in per_language]))
    if len(keys) * width <= dense_cells:
        values = np.full((len(keys), width), empty, np.float32)
        for j, (k, v) in enumerate(per_language):
            values[np.searchsorted(keys, k), j] = v
        return keys, values
    every = np.concatenate([k for k, _ in per_language])
    order = np.argsort(every, kind="stable")
    columns = np.repeat(np.arange(len(per_language), dtype=np.int32), [len(k) for k, _ in per_language])[order]
    starts = np.append(np.searchsorted(every[order], keys), len(every))
    return keys, Sparse(starts, columns, np.concatenate([v for _, v in per_language]).astype(np.float32)[order])


class Model:
    """Sorted hash arrays: ``grams[n]`` with log probabilities, ``contexts[n]`` with log back-off weights.

    In a full table a language without a run has its backed-off value; in a
    sparse one that is summed up where it is needed, to the same numbers.
    """

    def __init__(self, languages: list[str], grams: list, contexts: list, floor: np.ndarray) -> None:
        self.languages, self.grams, self.contexts, self.floor = languages, grams, contexts, floor
        self.temperature, self.least = 1.0, 0.0

    def _level(self, n: int, hashes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Log probabilities at the positions ``at``, from runs of ``n`` characters down."""
        if n == 0:
            return np.broadcast_to(self.floor, (len(at), len(self.languages)))
        keys, values = self.grams[n - 1]
        wanted = hashes[n - 1][at]
        place = np.searchsorted(keys, wanted)
        place[place == len(keys)] = 0
        hit = keys[place] == wanted
        if isinstance(values, Sparse):
            out = self._backed_off(n, hashes, at)
            spots = np.flatnonzero(hit)
            owner, language, found = values.of(place[spots])
            out[spots[owner], language] = found
            return out
        out = values[place]
        miss = np.flatnonzero(~hit)
        if len(miss):
            out[miss] = self._backed_off(n, hashes, at[miss])
        return out

    def _backed_off(self, n: int, hashes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """What runs of ``n`` characters that end at ``at`` have if no model knows them."""
        lower = np.array(self._level(n - 1, hashes, at))
        if n > 1:
            known, weights = self.contexts[n - 2]
            before = hashes[n - 2][at - 1]
            spot = np.searchsorted(known, before)
            spot[spot == len(known)] = 0
            same = known[spot] == before
            if isinstance(weights, Sparse):
                spots = np.flatnonzero(same)
                owner, language, found = weights.of(spot[spots])
                lower[spots[owner], language] += found
            else:
                lower += np.where(same[:, None], weights[spot], 0.0)
        return lower

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Mean negative log probability of a character, for each text (none may be empty) and language; any length in pieces."""
        sums = np.zeros((len(texts), len(self.languages)))
        for owners, pieces in _pieces(texts):
            codes, starts = _join(pieces)
            hashes = gram_hashes(codes)
            skip = ORDER - 1
            lengths = np.diff(starts) - skip
            at = np.arange(len(codes))
            at = at[at - np.repeat(starts[:-1], np.diff(starts)) >= skip]
            found = np.add.reduceat(self._level(ORDER, hashes, at).astype(np.float64), np.cumsum(lengths) - lengths, axis=0)
            np.add.at(sums, owners, -found)
        return sums / np.array([[len(t) - 1] for t in texts])

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and acceptance of each text."""
        names, scores, sure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if not self.languages:
            return names, scores, sure
        kept = [letters(t) for t in texts]
        full = [i for i, t in enumerate(kept) if t]
        if full:
            costs = self.entropies([kept[i] for i in full])
            best = costs.argmin(axis=1)
            for i, k, p, c in zip(full, best.tolist(), self.posterior(costs).max(axis=1).tolist(), costs.min(axis=1).tolist(), strict=True):
                names[i], scores[i], sure[i] = self.languages[k], p, c <= self.least
        return names, scores, sure

    def posterior(self, costs: np.ndarray) -> np.ndarray:
        z = -(costs - costs.min(axis=1, keepdims=True)) / self.temperature
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)


def estimate(languages: list[str], tables: list[tuple[np.ndarray, np.ndarray]], discount: float = 0.75, dense_cells: int = 1 << 26) -> Model:
    """Kneser-Ney models from each language's distinct runs (rows of ORDER code points) and their counts.

    ``dense_cells`` only chooses how a level is stored.
    """
    L = len(languages)
    logs: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER)]
    backs: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER - 1)]
    alphabet = max(1, len(np.unique(np.concatenate([np.unique(t[0]) for t in tables]))))
    uniform = 1.0 / (4.0 * alphabet)
    floor = np.full(L, np.log(uniform), np.float32)
    for j, (grams, counts) in enumerate(tables):
        # counts of each order: the runs themselves, then how many characters precede each shorter run
        by_order: list[tuple[np.ndarray, np.ndarray]] = [(grams, counts.astype(np.float64))]
        for _ in range(ORDER - 1):
            rest, n = np.unique(by_order[0][0][:, 1:], axis=0, return_counts=True)
            by_order.insert(0, (rest, n.astype(np.float64)))
        below: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0))  # sorted hashes of the runs one shorter, their probabilities
        for n, (runs, c) in enumerate(by_order, 1):
            if n == 1:
                total, kinds = c.sum(), len(c)
                p = np.maximum(c - discount, 0) / total + discount * kinds / total * uniform
                floor[j] = np.log(discount * kinds / total * uniform)  # of characters it has not seen
            else:
                heads, owner = np.unique(runs[:, :-1], axis=0, return_inverse=True)
                owner = owner.ravel()
                total, kinds = np.bincount(owner, c), np.bincount(owner)
                gamma = discount * kinds / total
                lower = below[1][np.searchsorted(below[0], _hash_rows(runs[:, 1:]))]
                p = np.maximum(c - discount, 0) / total[owner] + gamma[owner] * lower
                backs[n - 2].append((_hash_rows(heads), np.log(gamma)))
            keys = _hash_rows(runs)
            order = np.argsort(keys)
            below = (keys[order], p[order])
            logs[n - 1].append((keys, np.log(p)))
    contexts = [gathered(per_language, L, 0.0, dense_cells) for per_language in backs]
    model = Model(languages, [], contexts, floor)
    for n, per_language in enumerate(logs, 1):
        keys, values = gathered(per_language, L, np.nan, dense_cells)
        if not isinstance(values, Sparse) and (gap := np.isnan(values)).any():
            # languages without a run get their backed-off value; the runs' characters are needed for it
            runs = np.unique(np.concatenate([_shorter(t[0], n) for t in tables]), axis=0)
            runs = runs[np.argsort(_hash_rows(runs))]  # in the order of the keys, one after the other
            shown = runs.astype(np.uint32).ravel()
            hashes = gram_hashes(shown)
            values[gap] = model._backed_off(n, hashes, np.arange(n - 1, len(shown), n))[gap]
        model.grams.append((keys, values))
    return model


def _shorter(grams: np.ndarray, n: int) -> np.ndarray:
    return np.unique(grams[:, ORDER - n :], axis=0)


def _hash_rows(runs: np.ndarray) -> np.ndarray:
    h = runs[:, 0].astype(np.uint64) + np.uint64(1)
    for j in range(1, runs.shape[1]):
        h = h * BASE + runs[:, j].astype(np.uint64) + np.uint64(1)
    return _mixed(h)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out: int = 2, rows_per_language: int = 1500, dense_cells: int = 1 << 26, reject: float = 0.01) -> Model:
    """Models of the languages of rows outside the held-out fold.

    ``rows_per_language`` bounds the rows learned from; those that repeat id and
    text count once. All their runs are kept, whatever the number of languages
    and letters; a level of more than ``dense_cells`` runs times languages is
    stored sparsely, which changes no result.
    """
    tune(docs.sparkSession)
    usable = docs.where(docs[lang_col].isNotNull() & docs[id_col].isNotNull() & (crc_fold(docs[id_col], folds) != held_out))
    sizes = {r[0]: r[1] for r in usable.groupBy(usable[lang_col].cast("string")).count().collect()}  # a row for each language
    if not sizes:
        return Model([], [], [], np.empty(0))
    languages = sorted(sizes)
    share = F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, rows_per_language / sizes[k])))))
    rank = F.pmod(F.xxhash64(usable[id_col], usable[text_col], F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.where(rank < F.element_at(share, usable[lang_col].cast("string")))
    # bounded, and written: the corpus is read for it once
    rows = materialize(drawn.select(drawn[id_col].alias("id"), drawn[lang_col].cast("string").alias("lang"), drawn[text_col].cast("string").cast("binary").alias("__text")).distinct()).select("lang", "__text")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if kept := letters(text or b""):
                    held.setdefault(lang, []).append(kept)
            for lang, texts in held.items():
                for _, pieces in _pieces(texts):
                    yield _counted(lang, pieces)

    counted = materialize(rows.mapInArrow(runs, "lang string, a long, b long, n long").groupBy("lang", "a", "b").agg(F.sum("n").alias("n")))
    counts = counted.toPandas()  # of the bounded rows
    tables, learned = [], []
    for lang in languages:
        part = counts[counts["lang"] == lang].sort_values(["a", "b"])
        if len(part):
            a, b = part["a"].to_numpy(np.int64), part["b"].to_numpy(np.int64)
            tables.append((np.stack([a >> 21, a & 0x1FFFFF, b >> 21, b & 0x1FFFFF], axis=1).astype(np.int64), part["n"].to_numpy()))
            learned.append(lang)
    if not learned:
        return Model([], [], [], np.empty(0))
    model = estimate(learned, tables, dense_cells=dense_cells)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(lang, t) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if lang in known and (t := letters(text or b""))]
            if kept:
                found = shared.value.entropies([t for _, t in kept])
                yield pa.RecordBatch.from_arrays([pa.array([lang for lang, _ in kept]), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["lang", "costs"])

    known = set(learned)
    some = rows.mapInArrow(costs, "lang string, costs array<double>").toPandas()  # rows_per_language for each language
    right = np.array([learned.index(x) for x in some["lang"]])
    found = np.array(some["costs"].tolist())
    losses = []
    for t in (0.02, 0.05, 0.1, 0.2, 0.4):
        model.temperature = t
        losses.append((-np.log(np.maximum(model.posterior(found)[np.arange(len(right)), right], 1e-12)).mean(), -t))
    model.temperature = -min(losses)[1]
    model.least = float(np.quantile(found.min(axis=1), 1 - reject))
    return model


def _counted(lang: str, pieces: list[str]) -> pa.RecordBatch:
    """Distinct runs of ORDER characters, packed 21 bits each into two longs, with counts."""
    codes, starts = _join(pieces)
    at = np.arange(len(codes))
    at = at[at - np.repeat(starts[:-1], np.diff(starts)) >= ORDER - 1]
    c = codes.astype(np.int64)
    packed = np.stack([(c[at - 3] << 21) | c[at - 2], (c[at - 1] << 21) | c[at]], axis=1)
    order = np.lexsort((packed[:, 1], packed[:, 0]))
    packed = packed[order]
    first = np.flatnonzero(np.r_[True, (packed[1:] != packed[:-1]).any(axis=1)])
    n = np.diff(np.r_[first, len(packed)])
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(first)), pa.array(packed[first, 0]), pa.array(packed[first, 1]), pa.array(n)], names=["lang", "a", "b", "n"])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(texts: list[bytes]) -> dict[str, pa.Array]:
        names, scores, sure = shared.value.predict(texts)
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores), "accepted": pa.array(sure)}

    return map_texts(docs, id_col, text_col, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean", {"doc_id": docs[id_col], "held_out": crc_fold(docs[id_col], folds) == held_out})
