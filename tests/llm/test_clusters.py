"""op12: bounds against plain Lloyd rounds in exact integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from evidencelake.llm import clusters, queries

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string"


def brute(rows, k=8, rounds=10, width=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e, *_ in rows if e is not None and len(e) == width and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [e for _, e in order[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda e: min(range(len(centroids)), key=lambda c: (apart(e, centroids[c]), c))
    for _ in range(rounds):
        own = [nearest(e) for _, e in kept]
        for c in range(len(centroids)):
            members = [e for (_, e), o in zip(kept, own, strict=True) if o == c]
            if members:
                centroids[c] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    own = [nearest(e) for _, e in kept]
    far = [apart(e, centroids[o]) for (_, e), o in zip(kept, own, strict=True)]
    inertia = {c: sum(d for d, o in zip(far, own, strict=True) if o == c) for c in set(own)}
    return [(i, o, d, inertia[o], sum(far), hashlib.sha256(",".join(map(str, centroids[o])).encode()).hexdigest()) for (i, _), o, d in zip(kept, own, far, strict=True)]


def same(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    key = lambda r: (r[0] is not None, *map(str, r))
    got = [tuple(r) for r in clusters.assignments(df, **options).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, **options), key=key)


def vectors(rng, n, centres=5, spread=0.3):
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(centres)]
    return [(i, [m + rng.gauss(0, spread) for m in rng.choice(middles)], "clash", None) for i in range(n)]


def test_groups_and_awkward_rows(spark):
    rng = random.Random(1)
    rows = vectors(rng, 150)
    one = rows[3][1]
    rows += [(None, one, None, None), (3, one, None, None), (500, None, None, None), (501, [1.0] * 63, None, None), (502, [1.0] * 65, None, None), (503, [], None, None), (504, [None] + [1.0] * 63, None, None), (505, [math.nan] + [1.0] * 63, None, None), (506, [math.inf] + [1.0] * 63, None, None), (507, [-0.0005] * 64, None, None)]
    same(spark, rows)


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = random.Random(2)
    rows = vectors(rng, 80, centres=1, spread=1.0)
    same(spark, [*rows, *((i, rows[0][1], None, None) for i in range(1000, 1040))])
    same(spark, [(i, rows[0][1], None, None) for i in range(30)])  # all centroids are equal


def test_ties_go_to_the_smaller_number(spark):
    grid = [(i, [float((i >> b) & 1) for b in range(4)] + [0.0] * 60, None, None) for i in range(16)]
    same(spark, grid * 3)


def test_few_vectors_and_none(spark):
    rng = random.Random(3)
    same(spark, vectors(rng, 3))
    same(spark, [(None, [0.5] * 64, None, None)])
    assert clusters.assignments(spark.createDataFrame([], SCHEMA)).collect() == []
    assert clusters.assignments(spark.createDataFrame([(1, None, None, None)], SCHEMA)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bounds_spare_scans(spark):
    found = clusters.cluster(spark.createDataFrame(vectors(random.Random(4), 400, centres=8, spread=0.05), SCHEMA))
    assert found.scanned[0] == 400 and sum(found.scanned[1:]) < 0.3 * 400 * len(found.scanned[1:])
    assert found.moved[0] == 400 and found.moved[-1] == 0


def test_components_too_large_for_exact_distances(spark):
    with pytest.raises(Exception, match="beyond"):
        clusters.assignments(spark.createDataFrame([(1, [1e30] * 64, None, None)], SCHEMA)).collect()


def test_rounding_is_covered_by_the_margin():
    rng = np.random.default_rng(5)
    vecs = rng.integers(-clusters.LARGEST, clusters.LARGEST, (200, 64))
    cents = rng.integers(-clusters.LARGEST, clusters.LARGEST, (8, 64))
    exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(v, c, strict=True)) for c in cents] for v in vecs[:20]]
    assert clusters.distances(vecs[:20], cents).tolist() == exact
    cluster, upper, lower = clusters.scan(vecs, cents)
    for _ in range(10):
        moved = cents + rng.integers(-1000, 1000, cents.shape)
        cluster, upper, lower, _ = clusters.rescan(vecs, cluster, upper, lower, cents, moved)
        cents = moved
        assert (cluster == clusters.distances(vecs, cents).argmin(axis=1)).all()


def test_sql_is_registered():
    assert "op12_centroids" in queries.oracle_sql()
