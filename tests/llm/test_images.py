"""Image search: edited copies are found, others are not; the whole search against all pairs."""

import hashlib
import itertools

import numpy as np
import pytest

from evidencelake.llm import images


def test_pgm():
    pixels = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert np.array_equal(images.read_pgm(images.write_pgm(pixels)), pixels)
    assert images.read_pgm(None) is None and images.read_pgm(b"P5\n4 4\n255\nxx") is None and images.read_pgm(b"junk") is None


def digest(data):
    return hashlib.sha256(data).hexdigest()[:32]


def all_pairs(queries, index, per_cell=3, differing=24, agreeing=3, turn=30.0, shift=8.0):
    """{(asked, found): (matches, inliers)} by comparing every descriptor with every other one."""
    out = {}
    describe = lambda data, most: images.describe_stack(images.read_pgm(data)[None], most)
    known = {digest(d): describe(d, per_cell) for d in index}
    for data in queries:
        q = describe(data, None)
        for name, i in known.items():
            spots, votes = set(), {}
            for a, b in itertools.product(range(len(q["y"])), range(len(i["y"]))):
                x = q["words"][a] ^ i["words"][b]
                if sum(int(v).bit_count() for v in x) > differing or (x == 0).sum() < 2:
                    continue
                spot = (i["y"][b], i["x"][b], i["octave"][b])
                spots.add(spot)
                steps = round((np.degrees(np.float32(q["angle"][a]).astype(float) - np.float32(i["angle"][b]).astype(float)) % 360) / turn)
                theta, scale = np.radians(steps * turn), 2.0 ** (q["octave"][a] - i["octave"][b])
                dy = q["y"][a] - scale * (np.cos(theta) * i["y"][b] + np.sin(theta) * i["x"][b])
                dx = q["x"][a] - scale * (np.cos(theta) * i["x"][b] - np.sin(theta) * i["y"][b])
                for u, v in itertools.product((0, 1), (0, 1)):
                    votes.setdefault((steps % int(360 / turn), scale, u, v, np.floor(dy / shift + u * 0.5), np.floor(dx / shift + v * 0.5)), set()).add(spot)
            if best := max(map(len, votes.values()), default=0):
                if best >= agreeing:
                    out[digest(data), name] = (len(spots), best)
    return out


def pictures(n):
    rng = np.random.default_rng(1)
    return [images.draw(" ".join(str(x) for x in rng.integers(0, 10**6, 200)).encode()) for _ in range(n)]


def test_search_equals_all_pairs(spark):
    drawn = pictures(60)
    edits = [images.edit(p, k) for k, p in enumerate(drawn[:12])]
    edits += [drawn[3].reshape(40, 2, 40, 2).mean(axis=(1, 3)).round().astype(np.uint8), np.rot90(drawn[4], 3), np.full((80, 80), 7, np.uint8), drawn[5][:10, :10]]
    index = [images.write_pgm(p) for p in drawn] + [images.write_pgm(drawn[0]), b"junk", None]
    queries = [images.write_pgm(p) for p in edits]
    frame = lambda rows: spark.createDataFrame([(k, d, "clash", "x") for k, d in enumerate(rows)], "media_id long, image binary, digest string, key string").repartition(3)
    got = {(r["asked"], r["found"]): (r["matches"], r["inliers"]) for r in images.search(frame(queries), frame(index)).collect()}
    expected = all_pairs(queries, [d for d in index[:60]])
    assert got == expected
    own = {(digest(queries[k]), digest(index[k])) for k in range(12)} | {(digest(queries[12]), digest(index[3])), (digest(queries[13]), digest(index[4]))}
    assert own == set(got)


def test_classes(spark):
    """Identical images and rows without images: pairs of classes, members beside them."""
    a, b = map(images.write_pgm, pictures(2))
    schema = "media_id long, image binary"
    index = spark.createDataFrame([(7, a), (3, a), (3, a), (None, a), (5, b), (6, None), (8, b"junk")], schema)
    queries = spark.createDataFrame([(100, images.write_pgm(images.edit(images.read_pgm(a), 1))), (101, images.write_pgm(images.edit(images.read_pgm(a), 1)))], schema)
    got = images.copies(queries, index).collect()
    rows = lambda kind: sorted([(r["media_id"], r["class_id"], r["of_class"]) for r in got if r["kind"] == kind], key=str)
    assert rows("indexed") == sorted([(7, 3, None), (3, 3, None), (3, 3, None), (None, 3, None), (5, 5, None), (8, 8, None)], key=str)
    assert rows("query") == [(100, 100, None), (101, 100, None)]
    assert rows("copy") == [(None, 100, 3)]
    empty = spark.createDataFrame([], schema)
    for q, i in ((empty, index), (queries, empty), (empty, empty)):
        assert images.search(q, i).count() == 0 and not [r for r in images.copies(q, i).collect() if r["kind"] == "copy"]


def test_pages(spark):
    rng = np.random.default_rng(1)
    html = [" ".join(str(x) for x in rng.integers(0, 10**6, 200)) for _ in range(120)]
    pages = spark.createDataFrame([(i, h, "clash") for i, h in enumerate(html)] + [(500, None, ""), (501, "", "")], "page_id long, html string, image string")
    found = images.copies(images.page_images(pages.where("page_id % 5 = 0"), copies=True), images.page_images(pages)).where("kind = 'copy'").collect()
    right = {r["class_id"] for r in found if r["class_id"] == r["of_class"]}
    assert right >= {i for i in range(120) if i % 5 == 0} and len(found) == len(right)


@pytest.mark.parametrize("bits", [1, 2])
def test_hamming_tables_miss_nothing(spark, bits):
    """All pairs within two bits meet, however they are spread over the words."""
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**32, (40, 4))
    near = words.copy()
    for i in range(40):
        for b in rng.choice(128, bits, replace=False):
            near[i, b // 32] ^= 1 << (b % 32)
    frame = lambda w: spark.createDataFrame([(str(i), 0.0, 0.0, 0, 0.0, *map(int, r)) for i, r in enumerate(w)], images.DESCRIPTOR)
    got = images.match(frame(near), frame(words), differing=bits, agreeing=1)
    assert {(r["asked"], r["found"]) for r in got.collect()} == {(str(i), str(i)) for i in range(40)}
