"""One stream of lines as compressed parts of bounded size, each with its digest, and a reader that refuses broken ones.

Lines are range-partitioned by their order; each task packs its range into
parts of whole gzip members, so the parts behind one another are one gzip
stream. The manifest (a row for each part) is what a reader trusts: digests are
compared where the parts stand, and no bytes are shuffled to check them.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the largest part, in compressed bytes.
PART_BYTES = 40 << 20
#: Bytes of lines in one gzip member; memory holds a part and one member's lines.
MEMBER_BYTES = 1 << 20
PART = "chunk int, part int, data binary, bytes long, rows long, sha256 string"


def parts_of(df: DataFrame, value: str, order: Sequence[str], part_bytes: int = PART_BYTES, member_bytes: int = MEMBER_BYTES) -> DataFrame:
    """(chunk, part, data, bytes, rows, sha256): the lines of ``value`` in the given order. A member that alone is larger than ``part_bytes`` is a part of its own; null lines are empty."""

    def packed(lines: Iterator[bytes]) -> Iterator[tuple[bytes, int]]:
        held, size = [], 0
        for line in lines:
            held.append(line)
            size += len(line) + 1
            if size >= member_bytes:
                yield zlib.compress(b"".join(x + b"\n" for x in held), wbits=31), len(held)
                held, size = [], 0
        if held:
            yield zlib.compress(b"".join(x + b"\n" for x in held), wbits=31), len(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, number, data, rows = TaskContext.get().partitionId(), 0, bytearray(), 0

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "part": pa.array([number], pa.int32()), "data": pa.array([bytes(data)], pa.binary()), "bytes": pa.array([len(data)], pa.int64()), "rows": pa.array([rows], pa.int64()), "sha256": [hashlib.sha256(data).hexdigest()]})

        for member, n in packed(line or b"" for batch in batches for line in batch.column(0).to_pylist()):
            if data and len(data) + len(member) > part_bytes:
                yield part()
                number, data, rows = number + 1, bytearray(), 0
            data += member
            rows += n
        if data:
            yield part()

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select(F.col(value).cast("string").cast("binary").alias("line")).mapInArrow(run, PART)


def manifest_of(parts: DataFrame) -> DataFrame:
    return parts.select("chunk", "part", "bytes", "rows", "sha256")


def write_parts(df: DataFrame, path: str, value: str, order: Sequence[str], **options) -> DataFrame:
    """Write the parts, then their manifest; returns the manifest."""
    parts_of(df, value, order, **options).write.mode("errorifexists").option("compression", "none").parquet(f"{path}/parts")
    manifest_of(df.sparkSession.read.parquet(f"{path}/parts")).write.mode("errorifexists").parquet(f"{path}/manifest")
    return df.sparkSession.read.parquet(f"{path}/manifest")


def broken(parts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(chunk, part, fault) of parts that are missing, unknown, repeated, or not what the manifest says."""
    there = parts.groupBy("chunk", "part", F.sha2("data", 256).alias("found"), F.length("data").alias("size")).agg(F.count("*").alias("n"))
    met = manifest.join(there, ["chunk", "part"], "full_outer")
    fault = F.when(F.col("found").isNull(), "missing").when(F.col("sha256").isNull(), "unknown").when(F.col("n") > 1, "repeated").when((F.col("found") != F.col("sha256")) | (F.col("size") != F.col("bytes")), "changed")
    return met.select("chunk", "part", fault.alias("fault")).where("fault is not null")


def lines_of(parts: DataFrame) -> DataFrame:
    """(chunk, part, line_no, line) of all parts; the stream's order is that of the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = gzip.decompress(data).split(b"\n")[:-1]
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * len(lines), pa.int32()), "part": pa.array([part] * len(lines), pa.int32()), "line_no": pa.array(range(len(lines)), pa.int64()), "line": pa.array(lines, pa.binary())})

    found = parts.select("chunk", "part", "data").mapInArrow(run, "chunk int, part int, line_no long, line binary")
    return found.withColumn("line", F.col("line").cast("string"))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The lines of staged parts; raises if any part is not what the manifest says."""
    parts, manifest = spark.read.parquet(f"{path}/parts"), spark.read.parquet(f"{path}/manifest")
    found = [f"{r['chunk']}/{r['part']} {r['fault']}" for r in broken(parts, manifest).orderBy("chunk", "part").limit(5).collect()]
    if found:
        raise ValueError(f"broken parts: {', '.join(found)}")
    return lines_of(parts)
