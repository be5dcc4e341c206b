"""op13: divide and conquer against a search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np

from evidencelake.llm import runs

SCHEMA = "doc_id long, text string, runs string, n_words string"


def brute(words):
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                best.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def repetitive(rng):
    kinds, n = rng.choice((1, 2, 2, 3, 5)), rng.randint(0, 120)
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        at, block = rng.randint(0, n), [rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
        words[at:at] = block * rng.randint(1, 9)
    return [b"%d" % w for w in words]


def test_all_runs_of_random_texts(monkeypatch):
    rng = random.Random(3)
    for k in range(600):
        if k % 3 == 0:
            steps, many = rng.choice(((1, 0), (1, 1000), (6, 48), (3, 2)))
            monkeypatch.setattr(runs, "STEPS", steps)
            monkeypatch.setattr(runs, "MANY", many)
        texts = [repetitive(rng) for _ in range(rng.randint(0, 5))]
        assert runs.batch_runs(texts) == [brute(t) for t in texts]


def test_all_binary_texts():
    texts = [[b"ab"[int(b) : int(b) + 1] for b in f"{k:012b}"] for k in range(1 << 12)]
    assert runs.batch_runs(texts) == [brute(t) for t in texts]


def test_long_repetitive_texts_are_linear():
    assert runs.batch_runs([[b"a"] * 100_000])[0] == [(0, 100_000, 1)]
    assert runs.batch_runs([[b"a", b"b"] * 50_000, [b"a"]])[0] == [(0, 100_000, 2)]
    nested = ([b"a"] * 99 + [b"b"]) * 300
    assert runs.batch_runs([nested])[0] == sorted([(0, 30_000, 100), *((k, 99, 1) for k in range(0, 30_000, 100))], key=lambda r: (r[0], r[2]))


def test_z_function():
    rng = random.Random(4)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        assert runs.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        q = rng.randrange(len(s))
        assert runs.agreeing(np.array(s[q:]), np.array(s[: len(s) - q])) == runs.z_function(s)[q]


def contract(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    stays = [w for i, w in enumerate(words) if not any(s + q <= i < s + k for s, k, q in found)]
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if found else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(stays)))


def test_contract(spark):
    rng = random.Random(6)
    vocabulary = ["é", "日本", "a", "b", "the", "x y", "word", "#!"]
    made = [rng.choice((" ", "\n", " \t "))[: 1 + k % 2].join(rng.choice(vocabulary) for _ in range(rng.randint(0, 150))) for k in range(260)]
    made += ["", None, "  \n\t ", "one", "go " * 5, "go " * 6, "a b " * 4, "a b c " * 400 + "d", "x\x1cy " * 9]
    rows = [(k, t, "clash", None) for k, t in enumerate(made)]
    rows += [(None, "a " * 50, None, None), (5, made[5], None, None), (5, made[5], None, None), (-7, made[8], None, None)]
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(len(made))) > 10
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    key = lambda r: (r[0] is not None, *map(str, r))
    got = [tuple(r) for r in runs.digest(runs.collapse(runs.looped(docs))).collect()]
    assert sorted(got, key=key) == sorted((contract(i, t) for i, t, *_ in rows), key=key)


def test_collapse(spark):
    found = runs.collapse(spark.createDataFrame([(1, "go go go  go\ngo go on", "clash", "clash"), (2, None, None, None)], SCHEMA)).orderBy("doc_id").collect()
    assert found[0]["collapsed"] == "go on" and [tuple(r) for r in found[0]["runs"]] == [(0, 6, 1)] and found[0]["n_words"] == 7
    assert found[1]["collapsed"] == "" and found[1]["runs"] == [] and found[1]["n_words"] == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert runs.collapse(empty).collect() == [] == runs.digest(runs.collapse(runs.looped(empty))).collect()
