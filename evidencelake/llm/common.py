"""Helpers shared by the corpus operators.

Texts travel to Python as Arrow binary columns, so a worker sees the UTF-8
bytes themselves: ``bytes.lower`` folds A-Z only and ``bytes.split`` cuts at
exactly ``\\x20\\x09-\\x0D``, which is what the contracts ask for.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z, and every ASCII byte that is neither a digit nor a letter to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: Rows and bytes of one Arrow batch; the first holds for ordinary texts, the second for very long ones.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": (None, str(16 << 20))}


def tune(spark: SparkSession) -> None:
    """Make Arrow batches small unless the user has set their size; texts are long rows."""
    for key, (default, value) in BATCH.items():
        if default is None or spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session (driver and executors on one machine) may go without
    it and gets a temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="corpus-shared-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def run_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder: all intermediate tables stand there, for ``clear_tables``."""
    return f"{shared_dir(spark)}/tables-{spark.sparkContext.applicationId}"


def clear_tables(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; results that still read them must have been written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: later steps survive lost executors."""
    path = f"{run_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def hash_share(id_col: Column, salt: str, share: float) -> Column:
    """True for about ``share`` of all ids, the same ones in each run."""
    if share >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64(id_col, F.lit(salt)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_bytes(text: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text after A-Z is lower-cased."""
    return text.translate(WORD_BYTES).split()


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a batch as bytes; null gives b''."""
    return [t or b"" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def map_texts(df: DataFrame, id_col: str, text_col: str, fn: Callable[[list[bytes]], dict[str, pa.Array]], schema: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """One output row for each input row: the columns of ``keep`` (the id, if none are named) and what ``fn`` makes of the texts.

    ``schema`` describes all output columns. No shuffle; memory holds one Arrow batch.
    """
    tune(df.sparkSession)
    keep = {"doc_id": df[id_col]} if keep is None else keep
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = fn(texts_of(batch, "__text"))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), *made.values()], names=[*names, *made])

    return df.select(*(c.alias(n) for n, c in keep.items()), df[text_col].cast("string").cast("binary").alias("__text")).mapInArrow(run, schema)


def blobs(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]]) -> list[dict[str, bytes]]:
    """``fn`` sums up each partition into a few arrays; the driver gets their bytes. The caller bounds partitions and arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = fn(b for b in batches if b.num_rows)
        yield pa.RecordBatch.from_pylist([{"name": k, "data": v.tobytes()} for k, v in made.items()], schema=pa.schema([("name", pa.string()), ("data", pa.binary())]))

    found: dict[str, list[bytes]] = {}
    for row in df.mapInArrow(run, "name string, data binary").collect():
        found.setdefault(row["name"], []).append(bytes(row["data"]))
    return [dict(zip(found, parts, strict=True)) for parts in zip(*found.values(), strict=True)] if found else []


#: Slots of a key filter: 16 MB of bits whatever the number of keys. A full filter lets more rows through, never fewer.
FILTER_SLOTS = 1 << 27


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_SLOTS)) + 1


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """(__bucket, __bits): a bitmap of the slots of all keys, 4,096 rows of 4 KB at most, written to the shared folder."""
    slots = keys.select(_slot(F.col(key)).alias("s"))
    return materialize(slots.groupBy(F.bitmap_bucket_number("s").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("__bits")))


def passing(df: DataFrame, key: Column, bitmap: DataFrame, wanted: bool = True) -> DataFrame:
    """The rows of ``df`` whose key is in the filter (or only seems to be); with ``wanted`` false all other rows. No shuffle."""
    slot, bucket, bits = fresh(df, "__slot"), fresh(df, "__bucket"), fresh(df, "__bits")
    pieces = F.broadcast(bitmap.select(F.col("__bucket").alias(bucket), F.col("__bits").alias(bits)))
    marked = df.withColumn(slot, _slot(key))
    found = marked.join(pieces, F.bitmap_bucket_number(slot) == pieces[bucket], "left")
    octet = f"cast(conv(hex(substring(`{bits}`, cast(floor(bitmap_bit_position(`{slot}`) / 8) + 1 as int), 1)), 16, 10) as int)"
    hit = F.coalesce(F.expr(f"({octet} & shiftleft(1, cast(bitmap_bit_position(`{slot}`) % 8 as int))) <> 0"), F.lit(False))
    return found.where(hit if wanted else ~hit).select(*(marked[c] for c in df.columns))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, folds: int, held_out: int, max_rows: int, salt: str, rows_per_id: int = 16) -> DataFrame:
    """(__id, y double, __text binary) of about ``max_rows`` labelled rows outside the held-out fold.

    Ids are drawn by hash with probability ``max_rows / labelled ids``; labels of
    one id are averaged and rounded, null labels and ids ignored. The drawn ids
    are at most a few per cent more than ``max_rows`` (a binomial draw), which
    bounds the broadcast. Of an id with more than ``rows_per_id`` rows about as
    many are drawn by hash of the text. Texts are never shuffled; callers keep
    one of the rows that repeat both id and text.
    """
    usable = labels.where(labels[label].isNotNull() & labels[id_col].isNotNull() & (crc_fold(labels[id_col], folds) != held_out))
    n = usable.select(usable[id_col]).distinct().count()
    drawn = usable.where(hash_share(usable[id_col], salt, max_rows / max(1, n))).groupBy(usable[id_col].alias("__id")).agg((F.avg(label) >= 0.5).cast("double").alias("y"))
    drawn = F.broadcast(materialize(drawn))
    often = docs.select(docs[id_col].alias("__id")).join(drawn, "__id").groupBy("__id").agg(F.count("*").alias("__rows")).where(F.col("__rows") > rows_per_id)
    often = F.broadcast(materialize(often.select("__id", (rows_per_id / F.col("__rows")).alias("__share"))))  # some of the drawn ids
    rows = docs.select(docs[id_col].alias("__id"), docs[text_col].cast("string").cast("binary").alias("__text")).join(drawn, "__id").join(often, "__id", "left")
    return rows.where(F.col("__share").isNull() | (F.pmod(F.xxhash64("__text", F.lit(salt)), F.lit(1 << 30)) < F.col("__share") * (1 << 30))).select("__id", "y", "__text")
