"""A corpus pipeline of five stages, each one operator of ``evidencelake.llm``.

``STAGES`` are (name, function) with function(spark, docs, sf_dir) -> DataFrame.
All stages but the last return the columns of ``documents``; each decides on
what its predecessor kept. ``run`` writes every stage's result as Parquet into
the shared folder and reads it again.

Defined results, for all stages: ids may be null or repeat; every row is judged
by its text. Null and empty texts are texts without words: the classifier scores
them like any other, all of them are one near-duplicate group, no benchmark item
is in them, the mix gives them size 0, and they have the end id alone as tokens.
Rows of equal id, source and text get the same number of copies. Texts of any
length are taken whole. An empty table of documents gives an empty table at each
stage; without usable labels the classifier keeps everything, with an empty
benchmark nothing is contaminated. Extra columns go through the first four
stages unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidencelake.llm import decontaminate, mixing, quality, simhash, token_files
from evidencelake.llm.common import materialize
from evidencelake.llm.queries import END_ID, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.5) go; a score of exactly 0.5 stays."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a Jaccard similarity of 0.8 or more of their sets of five-word shingles, one stays: the least id, null ids last, and of one id the least hash of the text."""
    return simhash.one_of_each(docs, simhash.similar(docs, width=5))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as its source's target asks for: up to twice, or not at all."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files written from what is left."""
    return token_files.token_ids(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]

#: Fitted models, connected components, random rounding and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
