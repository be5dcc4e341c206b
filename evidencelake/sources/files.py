"""File sources. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def jsonl(spark: SparkSession, paths: str | list[str], schema: str | StructType, strict: bool = True) -> DataFrame:
    """JSON lines. Strict: a malformed line is an error. Permissive: it becomes a row with ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    full = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(StructType([*full.fields, StructField(CORRUPT, StringType())])).option("columnNameOfCorruptRecord", CORRUPT).json(paths)


def is_json(line: Column) -> Column:
    """Whether a line is one JSON value and nothing else; a blank line is none. In brackets, what follows a value is no longer passed over."""
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1, F.lit(False))


def first_bad_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line_no, value) of the first malformed line of each file, lines counted from 1.

    One scan leaves a row for each block of a file: its lines, and its first bad
    one. The blocks before it are then counted, so a file may be split.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    bad = F.min(F.when(~is_json(F.col("value")), F.struct("id", "value"))).alias("bad")
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"), bad)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = blocks.withColumn("line_no", before + F.col("bad.id") - F.col("first") + 1).where("bad IS NOT NULL")
    return found.groupBy("file").agg(F.min(F.struct("line_no", "bad.value")).alias("l")).select("file", "l.*")


def objects(spark: SparkSession, paths: str | list[str], schema: str | StructType) -> DataFrame:
    """JSON lines, checked as a whole first: the first malformed line is an error that names its file and number; what is no object is left out.

    A value that does not fit its column is null. Of keys that an object repeats the last one counts.
    """
    bad = first_bad_lines(spark, paths).orderBy("file").limit(1).collect()
    if bad:
        raise ValueError(f"malformed JSON line {bad[0]['file']}:{bad[0]['line_no']}: {(bad[0]['value'] or '')[:160]}")
    lines = spark.read.text(paths).where(F.ltrim("value").startswith("{"))
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def lexicon(spark: SparkSession, path: str) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """A lexicon document: JSON lines of key and words, in the file's order; empty words are left out, a repeated key is an error.

    A lexicon is a parameter of the size of a word list, so it is read by the driver.
    """
    rows = objects(spark, path, "key string, words array<string>").collect()
    found = tuple((r["key"], tuple(w for w in r["words"] or () if w and w.strip())) for r in rows)
    if any(not k for k, _ in found) or len({k for k, _ in found}) < len(found):
        raise ValueError("a lexicon needs a key for each line, and each key once")
    return found


def jsonl_counts(spark: SparkSession, paths: str | list[str], schema: str | StructType) -> DataFrame:
    """One row: lines that are not blank, and malformed ones."""
    full = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = F.from_json("value", StructType([*full.fields, StructField(CORRUPT, StringType())]), {"columnNameOfCorruptRecord": CORRUPT})
    lines = spark.read.text(paths).where(F.trim("value") != "").select(parsed.alias("r"))
    return lines.agg(F.count("*").alias("rows"), F.count(f"r.{CORRUPT}").alias("bad_json_rows"))


def csv(spark: SparkSession, paths: str | list[str], *names: str) -> DataFrame:
    """CSV with a header, all texts; Spark drops a byte order mark itself. Missing values are empty texts."""
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    rows = read.schema(strings(*names)).csv(paths) if names else read.csv(paths)
    return rows.fillna("")


def log(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """A source log: JSON lines or CSV, by its suffix."""
    return jsonl(spark, path, strings(*names)) if path.endswith((".jsonl", ".json")) else csv(spark, path, *names)


def document(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One JSON document."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def ordered(rows: DataFrame) -> DataFrame:
    """Add ``seq``, an input order: file, then block, then row within the block, as Spark's file metadata tell them."""
    return rows.select("*", F.concat_ws("/", F.col("_metadata.file_path"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")).alias("seq"))


def payload_kind(content: Column) -> Column:
    """html, pdf, zip, ole or unknown, by the first bytes."""
    head = F.lower(F.ltrim(F.decode(F.substring(content, 1, 64), "ISO-8859-1")))
    magic = F.hex(F.substring(content, 1, 4))
    return F.when(head.startswith("<!doctype") | head.startswith("<html"), "html").when(magic == "25504446", "pdf").when(magic == "504B0304", "zip").when(magic == "D0CF11E0", "ole").otherwise("unknown")


def response_status(code: Column, text: Column, blocked: tuple[str, ...] = ("captcha", "access denied"), absent: tuple[str, ...] = ("no data",)) -> Column:
    """blocked, failed, missing or ok; the first that fits. The words are parameters."""
    lower = F.lower(text)
    says = lambda words: F.coalesce(*[F.when(F.contains(lower, F.lit(w)), True) for w in words], F.lit(False))
    return F.when(code.isin(403, 429) | says(blocked), "blocked").when((code < 200) | (code >= 400), "failed").when(says(absent), "missing").otherwise("ok")


def roster(rows: DataFrame, year: str, region: str | None = None, names: list[str] | None = None) -> DataFrame:
    """Schools of one year (region, list of names), trimmed and in order; an empty result is an error."""
    trimmed = rows.select(*(F.trim(c).alias(c) for c in rows.columns)).where(F.col("year") == year)
    if region:
        trimmed = trimmed.where(F.col("region_sido") == region)
    if names:
        trimmed = trimmed.where(F.col("school_name").isin(names))
    if trimmed.isEmpty():
        raise ValueError("no school is left")
    return trimmed.orderBy("region_sido", "region_sgg", "school_name", "school_code")


def district_of(address: Column) -> Column:
    """The second word of a road address; empty if there is none."""
    words = F.split(F.trim(address), r"\s+")
    return F.when(F.size(words) >= 2, F.element_at(words, 2)).otherwise("")


def text_matches(spark: SparkSession, path: str, patterns: dict[str, str], skip: str = r"/(node_modules|\.git)/") -> DataFrame:
    """(file, line, rule) of lines of text files that match a pattern; 160 characters of a line at most."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    rules = F.array_compact(F.array(*(F.when(F.col("value").rlike(p), F.lit(k)) for k, p in patterns.items())))
    return lines.where(~F.col("file").rlike(skip)).select("file", F.left("value", F.lit(160)).alias("line"), F.explode(rules).alias("rule"))
