"""Lloyd's k-means on integer vectors with Hamerly's bounds.

Every vector carries its cluster, an upper bound of its distance to that
centroid and a lower bound of its distance to the second-nearest one. When
centroids move, the upper bound grows by the drift of the own centroid and the
lower one shrinks by the largest drift of the others. A vector whose upper
bound is below its lower bound (or below half the distance of its centroid to
the nearest other one) keeps its cluster unseen; then the upper bound is made
exact; what is still ambiguous is scanned against all centroids in exact
integers. Bounds are floats with a margin far above their rounding, and only
strict inequalities count, so ties always reach the exact scan.

A round is one pass without a shuffle: it reads the vectors with their bounds,
writes them again into the shared folder and adds the sums of what has moved,
one row for each part and cluster; the driver gets the totals of the clusters
only. The table before the last is removed after each round. When no vector
has moved, centroids stay, and so do all later rounds.

Defined results: kept are vectors with exactly ``width`` components, none null
or not finite; others give no row. The first centroids are the vectors with the
least digests of ``salt:id``, equal digests by the vector, null ids last; with
fewer vectors than clusters there are as many clusters as vectors, and two equal
first centroids leave the later one empty. Null ids and rows that repeat are
vectors of their own. An integer component beyond 2^26 raises an error, since
distances would leave 64 bits. An empty table gives no rows. Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import run_dir, tune

#: Above the relative rounding error of bounds; integer components stay within ``LARGEST``.
MARGIN, LARGEST = 1e-9, 1 << 26


@dataclass
class Clustering:
    """The vectors with their last cluster and distance, the centroids, and how many vectors each round scanned and moved."""

    vectors: DataFrame
    centroids: np.ndarray
    inertia: list[int]
    scanned: list[int] = field(default_factory=list)
    moved: list[int] = field(default_factory=list)


def integers(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", width: int = 64, scale: int = 1024) -> DataFrame:
    """(vec_id, vec array<int>) of the vectors that are kept: floor(scale * x) of each component."""
    wide = df.select(df[id_col].alias("vec_id"), df[vec_col].cast("array<double>").alias("vec"))
    kept = wide.where((F.size("vec") == width) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    near = F.forall("vec", lambda x: F.abs(x * scale) <= LARGEST)
    return kept.select("vec_id", F.when(near, F.transform("vec", lambda x: F.floor(x * scale).cast("int"))).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST}"))).alias("vec"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the least digests of ``salt:id``."""
    drawn = vectors.select("vec", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("digest"))
    return np.array([r["vec"] for r in drawn.orderBy(F.col("digest").asc_nulls_last(), "vec").limit(k).collect()], np.int64)


def distances(vecs: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors to all centroids, as exact integers."""
    found = np.empty((len(vecs), len(centroids)), np.int64)
    for k, c in enumerate(centroids):
        apart = vecs - c
        found[:, k] = np.einsum("ij,ij->i", apart, apart)
    return found


def own_distances(vecs: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    apart = vecs - centroids[cluster]
    return np.einsum("ij,ij->i", apart, apart)


def above(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + MARGIN)


def below(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 - MARGIN)


def scan(vecs: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid (the first of equals) and both bounds."""
    squared = distances(vecs, centroids)
    cluster = squared.argmin(axis=1)
    second = below(np.partition(squared, 1, axis=1)[:, 1]) if len(centroids) > 1 else np.full(len(vecs), np.inf)
    return cluster, above(squared.min(axis=1)), second


def rescan(vecs: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, before: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds after the centroids moved from ``before``, and how many vectors were scanned."""
    k = len(centroids)
    drift = above(((centroids - before) ** 2).sum(axis=1))
    others = np.array([np.delete(drift, c).max(initial=0.0) for c in range(k)])
    between = distances(centroids, centroids)
    np.fill_diagonal(between, np.iinfo(np.int64).max)
    half = below(between.min(axis=1)) / 2
    cluster = cluster.copy()
    upper = (upper + drift[cluster]) * (1 + MARGIN)
    lower = np.maximum(lower - others[cluster], 0.0) * (1 - MARGIN)
    sure = np.maximum(lower, half[cluster])
    open_ = np.flatnonzero(~(upper < sure))
    upper[open_] = above(own_distances(vecs[open_], centroids, cluster[open_]))
    open_ = open_[~(upper[open_] < sure[open_])]
    if len(open_):
        cluster[open_], upper[open_], lower[open_] = scan(vecs[open_], centroids)
    return cluster, upper, lower, len(open_)


STATE = "vec_id {id}, vec array<int>, cluster int, upper double, lower double, distance long, sums array<long>, n long, scanned long, moved long"
_OWN = {"upper": pa.float64(), "lower": pa.float64(), "distance": pa.int64()}
_TOTALS = {"sums": pa.list_(pa.int64()), "n": pa.int64(), "scanned": pa.int64(), "moved": pa.int64()}


def _round(centroids: np.ndarray, before: np.ndarray | None, last: bool):
    """One pass: vectors with new clusters and bounds, then one row for each cluster with the sums of what came less what left (in the last pass: of squared distances)."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n, scanned, moved, id_type = np.zeros((k, width), np.int64), np.zeros(k, np.int64), 0, 0, None
        inertia = np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.column(0).type
            vecs = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)
            held = None
            if before is None:
                cluster, upper, lower = scan(vecs, centroids)
                some, went = np.arange(len(vecs)), len(vecs)
            else:
                held = batch.column(2).to_numpy().astype(np.int64)
                cluster, upper, lower, went = rescan(vecs, held, batch.column(3).to_numpy(), batch.column(4).to_numpy(), before, centroids)
                some = np.flatnonzero(cluster != held)
            scanned, moved = scanned + went, moved + len(some)
            np.add.at(sums, cluster[some], vecs[some])
            n += np.bincount(cluster[some], minlength=k)
            if held is not None:
                np.subtract.at(sums, held[some], vecs[some])
                n -= np.bincount(held[some], minlength=k)
            distance = own_distances(vecs, centroids, cluster) if last else None
            if last:
                inertia += [int(distance[cluster == c].sum()) for c in range(k)]
            own = [pa.array(upper), pa.array(lower), pa.array(distance) if last else pa.nulls(len(vecs), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)), *own, *(pa.nulls(len(vecs), t) for t in _TOTALS.values())], names=["vec_id", "vec", "cluster", *_OWN, *_TOTALS])
        if id_type is not None:
            made = [pa.nulls(k, id_type), pa.nulls(k, pa.list_(pa.int32())), pa.array(range(k), pa.int32()), *(pa.nulls(k, t) for t in _OWN.values())]
            totals = [pa.array((inertia[:, None] if last else sums).tolist(), pa.list_(pa.int64())), pa.array(n), pa.array([scanned] + [0] * (k - 1), pa.int64()), pa.array([moved] + [0] * (k - 1), pa.int64())]
            yield pa.RecordBatch.from_arrays([*made, *totals], names=["vec_id", "vec", "cluster", *_OWN, *_TOTALS])

    return run


def _write(df: DataFrame) -> str:
    path = f"{run_dir(df.sparkSession)}/clusters-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _totals(state: DataFrame, k: int) -> tuple[np.ndarray, list[int], int, int]:
    """Sums by cluster and component, counts, vectors scanned and moved: at most clusters x components rows."""
    rows = state.where("n is not null")
    sums = rows.select("cluster", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("col").alias("total")).collect()
    told = rows.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("scanned").alias("scanned"), F.sum("moved").alias("moved")).collect()
    found = [[0] * (1 + max((r["pos"] for r in sums), default=0)) for _ in range(k)]
    for r in sums:
        found[r["cluster"]][r["pos"]] = r["total"]
    counts = [0] * k
    for r in told:
        counts[r["cluster"]] = r["n"]
    return np.array(found, object), counts, sum(r["scanned"] for r in told), sum(r["moved"] for r in told)


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, salt: str = "3", id_col: str = "vec_id", vec_col: str = "embedding", width: int = 64, scale: int = 1024) -> Clustering:
    """Clusters of all kept vectors after ``rounds`` rounds and a last assignment: (vec_id, vec, cluster, distance)."""
    spark = df.sparkSession
    tune(spark)
    vectors = integers(df, id_col, vec_col, width, scale)
    centroids = first_centroids(vectors, k, salt)
    k = len(centroids)
    if not k:
        return Clustering(vectors.where("false").select("vec_id", "vec", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids.reshape(0, width), [])
    schema = STATE.format(id=df.schema[id_col].dataType.simpleString())
    sums, counts = np.zeros((k, width), object), [0] * k
    before, path, older, done = None, None, None, Clustering(vectors, centroids, [])
    left = rounds
    while True:
        last = left == 0
        rows = vectors if path is None else spark.read.schema(schema).parquet(path).where("n is null").select("vec_id", "vec", "cluster", "upper", "lower")
        older, path = path, _write(rows.mapInArrow(_round(centroids, before, last), schema))
        state = spark.read.schema(schema).parquet(path)
        if older:
            _remove(spark, older)
        change, came, scanned, moved = _totals(state, k)
        done.scanned.append(scanned)
        done.moved.append(moved)
        if last:
            done.inertia = [row[0] for row in change.tolist()]
            done.vectors, done.centroids = state.where("n is null").select("vec_id", "vec", "cluster", "distance"), centroids
            return done
        sums, counts = sums + change, [a + b for a, b in zip(counts, came, strict=True)]
        before = centroids
        centroids = np.array([[s // n for s in row] if n else old.tolist() for row, n, old in zip(sums.tolist(), counts, centroids, strict=True)], np.int64)
        left = left - 1 if moved and (centroids != before).any() else 0


def assignments(df: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector."""
    found = cluster(df, **options)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    of_cluster = lambda values, kind: F.get(F.array(*(F.lit(v) for v in values)).cast(f"array<{kind}>"), F.col("cluster"))
    return found.vectors.select("vec_id", "cluster", "distance", of_cluster(found.inertia, "long").alias("cluster_inertia"), F.lit(sum(found.inertia)).cast("long").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"))
