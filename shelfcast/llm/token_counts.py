"""Token counts through a cache keyed by the digests of a text and of the tokenizer's version."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.token_units import encoder, vocabulary_path
from shelfcast.operators.joins import attach
from shelfcast.shared import fresh_path

BROADCAST_BYTES = 32 * 1024 * 1024
CACHE = "content binary, version string, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library's version: counts under another one are never reused."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


def normalised(text: str):
    """The content that counts: the text itself, null as empty.  Anything further would change the counts."""
    return F.coalesce(F.col(text), F.lit(""))


def _count_batches(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    units = encoder(vocabulary_path(name))
    for batch, _, counts in units.encode_batches(batches, ids=False):
        yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts)], names=["content", "n_tokens"])


class CountCache:
    """A growing Parquet table of counts in a folder; every call appends one complete set of files."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or fresh_path(spark, "token-counts")
        if folder is None:
            spark.createDataFrame([], CACHE).write.mode("ignore").parquet(self.folder)

    def read(self, version: str) -> DataFrame:
        stored = self.spark.read.schema(CACHE).parquet(self.folder)
        # a batch that was appended twice (two callers at once) leaves equal rows; one of each is enough
        return stored.filter(F.col("version") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        counts.select("content", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(self.folder)


def count_tokens(
    docs: DataFrame, cache: CountCache, name: str = "byte_bpe_50k.json", text: str = "text", limit: int = 512
) -> DataFrame:
    """The rows of ``docs`` as struct ``_row`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Only texts whose digest the cache lacks are encoded, each once, however often it occurs; their counts are
    then in the cache.  A null text is an empty one, with no tokens.  Repeated rows keep their number, very long texts
    are counted whole, other columns pass through, whatever their names, and an empty table gives no rows.
    Counts come back by broadcast while they are few, else by a shuffle in which a text of very many copies is cut.
    """
    version = tokenizer_version(vocabulary_path(name))
    body = normalised("_text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    digest = F.unhex(F.sha2(body.cast("binary"), 256))
    contents = rows.select(digest.alias("content"), body.alias("text"))
    missing = attach(contents, cache.read(version), ["content"], "left_anti", BROADCAST_BYTES)
    distinct = missing.groupBy("content").agg(F.first("text").alias("text"))  # copies meet before the shuffle
    counted = distinct.mapInArrow(lambda batches: _count_batches(batches, name), "content binary, n_tokens bigint")
    cache.append(counted, version)
    keyed = rows.select("_row", digest.alias("content"), F.octet_length(body).cast("long").alias("n_bytes"))
    found = attach(keyed, cache.read(version), ["content"], "inner", BROADCAST_BYTES)
    return found.select("_row", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
