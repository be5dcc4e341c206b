"""op11: the joins of halves against the library, over every code point, random texts and every cut."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from evidencelake.llm import bpe
from evidencelake.llm.queries import ranks_path

SCHEMA = "doc_id long, text string, ids string, n_tokens string"


@pytest.fixture(scope="module")
def own():
    return bpe.read(ranks_path())


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def ids(own, text):
    return [i for part in own.encode(text) for i in part.tolist()]


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == P.PATTERN
    assert bpe.ascii_form(r"\p{Lu}") is None


def test_each_token_merges_to_itself(own):
    assert all(own.merged(t) == [r] for t, r in own.ranks.items())


def test_code_points(own, library):
    rng = random.Random(2)
    for c in [*range(0x3000), *rng.sample(range(0x3000, 0x110000), 4000)]:
        if not 0xD800 <= c < 0xE000:
            text = "a{0}b 1{0}2 {0}!{0}  {0} x'{0}".format(chr(c))
            assert ids(own, text) == library.encode_ordinary(text), hex(c)


@pytest.mark.parametrize("alphabet", ["a", " ", "ab", "aA 1'", "é日本 \n'srevt", "xyz0123456789", "\U0001f600a ", "=-", "\t \n\r  x", "'sdmtlrev "])
def test_joins_at_every_size(own, library, monkeypatch, alphabet):
    rng = random.Random(alphabet)
    for n in (1, 2, 5, 17, 40, 100, 900):
        for chars, portion, leaf in ((1, 1 << 20, 1), (2, 4, 2), (7, 33, 5), (1 << 16, 9, 16)):
            monkeypatch.setattr(bpe, "LEAF_CHARS", chars)
            monkeypatch.setattr(bpe, "PORTION", portion)
            monkeypatch.setattr(bpe, "LEAF_BYTES", leaf)
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert ids(own, text) == library.encode_ordinary(text)
            assert own.encode_piece(text.encode()) == library._encode_single_piece(text.encode())


def test_every_cut_joins(own, library):
    data = ("aaaaabaaab" * 7 + "internationalisation" + "====----" * 5).encode()
    whole = library._encode_single_piece(data)
    for k in range(len(data) + 1):
        assert own.join_tokens(own.merged(data[:k]), own.merged(data[k:])) == whole
    text = "it's  we'll\n\n  x1 2é  'tis''s   "
    for k in range(len(text) + 1):
        assert own.join_pieces(own.match(text[:k]), own.match(text[k:])) == own.match(text)


def test_long_windows_and_memos(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 10)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 3)
    fresh = bpe.Bpe(own.ranks)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    for text in (" ".join(words), "a" * 70_001, "-" * 30_001, " " * 20_000 + "x", "ab" * 20_000):
        assert ids(fresh, text) == library.encode_ordinary(text)
    assert len(fresh.memo) <= 10 and len(fresh.memo.older) <= 10 and len(fresh.pairs) <= 3


def test_contract(spark, own, library):
    made = ["plain text, it's 'tis  #1,000", "", None, "  \n\t ", "é ü ß 日本語 \U0001f600 <|endoftext|>", "a" * 5000, "word " * 40_000, "null\x00byte"]
    rows = [(k, t, "clash", None) for k, t in enumerate(made)] + [(None, "no id", None, None), (0, made[0], None, None), (0, made[0], None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)

    def want(text):
        found = library.encode_ordinary(text or "")
        return len(found), hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    key = lambda r: (r[0] is not None, *map(str, r))
    got = [tuple(r) for r in bpe.round_trip(docs, ranks_path()).collect()]
    assert sorted(got, key=key) == sorted(((i, *want(t)) for i, t, *_ in rows), key=key)
    coded = bpe.encode(docs, ranks_path())
    assert sorted(((r[0], r[1]) for r in coded.collect()), key=key) == sorted(((i, library.encode_ordinary(t or "")) for i, t, *_ in rows), key=key)
    back = [(r[0], bytes(r[1]).decode()) for r in bpe.decode(coded, ranks_path()).collect()]
    assert sorted(back, key=key) == sorted(((i, t or "") for i, t, *_ in rows), key=key)
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.round_trip(empty, ranks_path()).collect() == [] == bpe.encode(empty, ranks_path()).collect()
    assert [bytes(r["data"]) for r in bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), ranks_path()).collect()] == [b""]
