"""A corpus pipeline from the operators of ``shelfcast.llm``: each stage's rows are written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import decontaminate, mixing, quality_rules, similar, token_files
from shelfcast.llm.workers import with_package
from shelfcast.shared import written_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null, empty or blank text has no words and goes; repeated rows share one verdict; a document of a language without
    a reference is judged by the base rules only; very long texts are measured whole; other columns pass through.
    """
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words a shingle, similarity 0.8), that of the smallest number.

    Of repeated rows one stays, and of all texts without a word; a row without a number comes after those with one.
    """
    with_package(spark)
    return similar.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a telling share of benchmark words; a text without words hits nothing and stays."""
    with_package(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to their sources' targets, some twice, in shuffled shards; a null source is one of its own."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix in the order of its files, and from them a row per document with its place, length and checksum.

    A document that the mix holds twice has two rows.  Rows that come from no files stand in order of their numbers.
    """
    with_package(spark)
    return token_files.TokenFiles.write(docs, order=mixing.written_order(docs)).read()


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_output", token_output),
]

#: SQL has no seeded 64-bit hash, so it can't express the near-duplicate stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return docs
