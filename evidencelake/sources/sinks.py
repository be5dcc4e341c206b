"""Sinks. Every write refuses to overwrite unless told to; a job's commit is atomic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header, quotes in values doubled; a byte order mark, if wanted, stands before it in every file (``sources.files.csv`` drops it again)."""
    if bom and df.columns:
        first, *rest = df.columns
        df = df.toDF("\ufeff" + first, *rest)
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Put a table in the place of another. The new one is written whole beside it first, so a job that fails leaves the old one.

    Names change at the end, the old table's first; its files are removed after that.
    """
    jvm = df.sparkSession.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    new, old = (jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{x}") for x in ("partial", "before"))
    df.write.mode("overwrite").parquet(new.toString())
    if fs.exists(old):
        fs.delete(old, True)
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"{path} cannot be moved")
    if not fs.rename(new, at):
        raise OSError(f"{path} cannot be put in place")
    fs.delete(old, True)


def summary(counts: dict[str, DataFrame]) -> DataFrame:
    """One row with a map of counts for each (value, count) table; for small group tables."""
    made = None
    for name, table in counts.items():
        key, n = table.columns[:2]
        part = table.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), F.col(n).cast("long")))).alias(name)).withColumn("_k", F.lit(1))
        made = part if made is None else made.join(part, "_k")
    return made.drop("_k")


def updated(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Copy on write: the changes' columns replace the table's where the key is known."""
    columns = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_known"))
    return table.join(new, list(keys), "left").select(*(F.when(F.col("_known"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns))


def with_column_if_missing(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def content_addressed(files: DataFrame, code: str, name: str, content: str) -> DataFrame:
    """Store name of each file: code, twelve digits of its digest, a safe name; one row for each content."""
    safe = F.regexp_replace(F.trim(F.regexp_replace(name, r'[\\/:*?"<>|\s]+', "_")), r"^_+|_+$", "")
    hashed = files.withColumn("sha256", F.sha2(content, 256))
    return hashed.dropDuplicates(["sha256"]).withColumn("stored_name", F.concat_ws("_", F.col(code), F.left("sha256", F.lit(12)), safe))


#: On a local disk Hadoop starts a process for every file, and another for its checksum file, to set their permissions: most of
#: what a small part costs. Pages of Parquet files hold checksums of their own. Paths of other stores know no such files.
NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def manifest(df: DataFrame, path: str, rows_per_part: int) -> DataFrame:
    """Write in parts of at most so many rows; returns (file, rows, sha256 of its rows' digests)."""
    df.write.mode("errorifexists").options(**NO_CHECKSUM_FILES).option("maxRecordsPerFile", rows_per_part).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    digest = F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in back.columns)), 256)
    # a split holds some thirty small files, whatever their size; a task takes many splits, so that tasks do not grow with the parts
    parts = back.select(F.col("_metadata.file_name").alias("file"), digest.alias("d")).coalesce(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return parts.groupBy("file").agg(F.count("*").alias("rows"), F.sha2(F.hex(F.bit_xor(F.xxhash64("d"))), 256).alias("sha256"))


def fail_if_any(bad: DataFrame, message: str, key: str) -> None:
    """A release gate: raises with at most five keys if there is a row."""
    found = [r[key] for r in bad.select(key).limit(5).collect()]
    if found:
        raise ValueError(f"{message}: {', '.join(map(str, found))}")
