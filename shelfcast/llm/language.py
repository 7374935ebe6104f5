"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums the n-grams of all labelled documents per language; the matrix of log-probabilities, languages by
buckets, is broadcast, and documents are scored in batches by gathering its entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.workers import pieces
from shelfcast.operators.ordering import dense_position
from shelfcast.shared import written_table

BUCKETS = 1 << 14
#: Languages whose log-probabilities are broadcast together (64 MB).
BLOCK_LANGUAGES = 1024
SMOOTHING = 0.5
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass
class LanguageModel:
    languages: list[str]
    log_probabilities: np.ndarray  # language by bucket
    priors: np.ndarray


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 3-grams of lower-cased texts (each between blanks), and where each text's begin."""
    padded = [f" {t.lower()} " for t in texts]
    sizes = np.array([len(t) for t in padded], np.int64)
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    mixed = points[:-2] * np.uint32(0x9E3779B1) ^ points[1:-1] * np.uint32(0x85EBCA77) ^ points[2:] * np.uint32(0xC2B2AE3D)
    buckets = ((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(18)).astype(np.int64)
    inside = np.ones(len(points), bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = inside[ends - 2] = False  # would reach into the next text
    return buckets[inside[:-2]], np.cumsum(sizes - 2) - (sizes - 2)


def _chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``most`` characters together; a longer text stands alone."""
    first = size = 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > most:
            yield first, k
            first = k
            size = 0
        size += len(text)
    if texts:
        yield first, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of a task: n-grams by language and bucket, and documents (bucket -1)."""
    totals: dict[str, np.ndarray] = {}
    for batch in pieces(batches, "text", 8 << 20):
        by_language: dict[str, list[str]] = {}
        for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_language.setdefault(language, []).append(text)
        for language, texts in by_language.items():
            sums = totals.setdefault(language, np.zeros(BUCKETS + 1, np.int64))
            for a, b in _chunks(texts):
                sums[:-1] += np.bincount(ngrams(texts[a:b])[0], minlength=BUCKETS)
            sums[-1] += len(texts)
    for language, sums in totals.items():
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(used)), pa.array(np.where(used == BUCKETS, -1, used)), pa.array(sums[used])],
            names=["lang", "bucket", "n"],
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per language: its log-probabilities as 32-bit numbers, and its documents."""
    for batch in batches:
        for language, pairs in zip(batch.column("lang").to_pylist(), batch.column("pairs")):
            bucket, n = (pairs.values.field(k).to_numpy(zero_copy_only=False) for k in ("bucket", "n"))
            grams = np.full(BUCKETS, SMOOTHING)
            grams[bucket[bucket >= 0]] += n[bucket >= 0]
            row = np.log(grams / grams.sum()).astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([language]), pa.array([row], pa.binary()), pa.array([int(n[bucket < 0].sum())], pa.int64())],
                names=["lang", "row", "documents"],
            )


class Trained:
    """The learned table, a row per language, taken to the driver in blocks of bounded size."""

    def __init__(self, table: DataFrame, block: int = BLOCK_LANGUAGES):
        self.table, self.block = table, block
        self.documents, self.size = table.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.count(F.lit(1))).first()

    def blocks(self) -> Iterator[LanguageModel]:
        """The languages by name, ``block`` of them at a time; one empty block if there are none."""
        placed = self.table if self.size <= self.block else written_table(dense_position(self.table, ["lang"], "_place"), "languages")
        for at in range(0, max(self.size, 1), self.block):
            part = placed if self.size <= self.block else placed.filter(F.col("_place").between(at, at + self.block - 1))
            rows = sorted(part.select("lang", "row", "documents").collect(), key=lambda r: r["lang"])
            matrix = np.array([np.frombuffer(r["row"], np.float32) for r in rows], np.float32).reshape(len(rows), BUCKETS)
            yield LanguageModel([r["lang"] for r in rows], matrix, np.log([r["documents"] / self.documents for r in rows]))


def train(labelled: DataFrame) -> Trained:
    """Learn from ``lang`` and ``text``; rows that lack either are left out.

    The texts are read once.  A task sums its rows per language, Spark sums the tasks, and each language's sums become one
    packed row; any number of languages.  Repeated rows count as often as they stand.
    """
    rows = labelled.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    listed = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("pairs"))  # one number per bucket at most
    return Trained(written_table(listed.mapInArrow(_packed, "lang string, row binary, documents bigint"), "language-model"))


def sums_of(texts: list[str], model: LanguageModel) -> Iterator[tuple[int, np.ndarray]]:
    """Logarithms of text and language together: a matrix, texts by languages, for each stretch of texts and where it begins."""
    for a, b in _chunks(texts):
        buckets, starts = ngrams(texts[a:b])
        sums = np.stack([np.add.reduceat(row[buckets], starts, dtype=np.float64) for row in model.log_probabilities], axis=1)
        yield a, sums + model.priors


def score(texts: list[str | None], model: LanguageModel) -> tuple[list[str], list[float]]:
    """The likeliest language of each text and its posterior probability; ``und`` and 0 without a letter."""
    names, best, total = scored(texts, model, [None] * len(texts), np.full(len(texts), -np.inf), np.full(len(texts), -np.inf))
    known = [n is not None for n in names]
    return [n or UNKNOWN for n in names], np.where(known, np.exp(best - np.where(known, total, 0)), 0.0).tolist()


def scored(
    texts: list[str | None], model: LanguageModel, names: list[str | None], best: np.ndarray, total: np.ndarray
) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """The likeliest language so far, its logarithm, and that of the sum over all languages, after a further block of them."""
    names, best, total = list(names), best.copy(), total.copy()
    good = [k for k, t in enumerate(texts) if t and _LETTER.search(t)] if model.languages else []
    for a, sums in sums_of([texts[k] for k in good], model):
        at = np.array(good[a : a + len(sums)])
        place = sums.argmax(axis=1)
        high = sums[np.arange(len(sums)), place]
        total[at] = np.logaddexp(total[at], high + np.log(np.exp(sums - high[:, None]).sum(axis=1)))
        for k, p, value in zip(at.tolist(), place.tolist(), high.tolist()):
            if value > best[k]:
                names[k], best[k] = model.languages[p], value
    return names, best, total


def predict(docs: DataFrame, model: Trained | LanguageModel, text: str = "text") -> DataFrame:
    """Rows of ``docs`` as struct ``_row`` with ``lang_pred`` and ``score``.

    Null, empty and letterless texts are ``und`` with score 0, and so is every text if nothing could be
    learned.  Of equally likely languages the first by name wins.  Very long texts are scored whole.  Other columns are
    passed through, whatever their names; an empty table gives no rows.  More languages than a block holds are scored
    block by block, each in a pass of its own, so that one block's matrix is held at a time.
    """
    step = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"),
        F.lit(None).cast("string").alias("_name"), F.lit(float("-inf")).alias("_best"), F.lit(float("-inf")).alias("_total"),
    )
    schema, context = step.schema, docs.sparkSession.sparkContext

    def run(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            best, total = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_best", "_total"))
            names, best, total = scored(batch.column("_text").to_pylist(), sent.value, batch.column("_name").to_pylist(), best, total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_text"), pa.array(names, pa.string()), pa.array(best), pa.array(total)],
                names=["_row", "_text", "_name", "_best", "_total"],
            )

    sent = None
    for block in model.blocks() if isinstance(model, Trained) else [model]:
        if sent is not None:
            step = written_table(step, "language-scores")
            sent.destroy()
        sent = context.broadcast(block)
        step = step.mapInArrow(lambda b, s=sent: run(b, s), schema)
    known = F.col("_name").isNotNull()
    return step.select(
        "_row", F.coalesce("_name", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(known, F.exp(F.col("_best") - F.col("_total"))).otherwise(F.lit(0.0)).alias("score"),
    )
