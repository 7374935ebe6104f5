"""A quality classifier by Bradley-Terry ranking of preference pairs.

A document's score is a linear function of features of its text.  It is learned from pairs of a good and a bad
document: the chance that the good one is preferred is the logistic function of the difference of their scores,
so the loss depends on feature differences alone.  A quantile of the scores, the share of bad documents among
the labelled ones, becomes the threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.workers import pieces

#: Byte classes: lower case, upper case, digits, sentence marks, brackets and signs, white space, beyond ASCII.
CLASSES = np.full(256, 4, np.int64)
CLASSES[0x61:0x7B], CLASSES[0x41:0x5B], CLASSES[0x30:0x3A], CLASSES[0x80:] = 0, 1, 2, 6
CLASSES[[*b".,;:!?'\"-"]], CLASSES[[*b" \t\n\v\f\r"]] = 3, 5
FEATURES = 16


@dataclass(frozen=True)
class Training:
    """``rows`` labelled documents of each label at most are read, those with the smallest hash of their number."""

    rows: int = 10_000
    pairs: int = 200_000
    penalty: float = 1e-3
    rounds: int = 30
    seed: int = 17
    cut: float = 0.3


@dataclass
class QualityModel:
    weights: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    threshold: float
    cut: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """0 to 1; exactly ``cut`` at the threshold."""
        margin = (features - self.center) / self.scale @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(margin + np.log(self.cut / (1 - self.cut)), -35, 35)))


def features(texts: list[str | None]) -> np.ndarray:
    """A row of numbers per text, all but the last two of them shares of it."""
    out = np.zeros((len(texts), FEATURES))
    for k, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        if not words:
            continue
        n = len(words)
        sizes = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=7) / len(raw)
        counts = Counter(words)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        twins = sum(a == b for a, b in zip(words, words[1:])) / n
        out[k] = [
            *sizes, np.sqrt(sizes[1]), np.sqrt(sizes[4]), np.sqrt(raw.count(b"!") / len(raw)), np.sqrt(twins), twins,
            1 - len(counts) / n, max(counts.values()) / n, 1 - len(set(lines)) / len(lines), np.log1p(n),
        ]
    return out


def train(good: np.ndarray, bad: np.ndarray, bad_share: float, how: Training) -> QualityModel:
    """Newton's method on the pairs' logistic loss; without pairs every score is the cut."""
    both = np.concatenate([good, bad])
    if not len(good) or not len(bad):
        return QualityModel(np.zeros(FEATURES), np.zeros(FEATURES), np.ones(FEATURES), 0.0, how.cut)
    center, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6)
    good, bad = (good - center) / scale, (bad - center) / scale
    draw = np.random.default_rng(how.seed)
    differences = good[draw.integers(len(good), size=how.pairs)] - bad[draw.integers(len(bad), size=how.pairs)]
    weights = np.zeros(FEATURES)
    for _ in range(how.rounds):
        chance = 1 / (1 + np.exp(-np.clip(differences @ weights, -35, 35)))
        slope = differences.T @ (1 - chance) / how.pairs - how.penalty * weights
        bend = (differences * (chance * (1 - chance))[:, None]).T @ differences / how.pairs + how.penalty * np.eye(FEATURES)
        step = np.linalg.solve(bend, slope)
        weights += step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    scores = np.concatenate([good @ weights, bad @ weights])
    mass = np.concatenate([np.full(len(good), (1 - bad_share) / len(good)), np.full(len(bad), bad_share / len(bad))])
    order = np.argsort(scores, kind="stable")
    reached = np.searchsorted(np.cumsum(mass[order]), bad_share, side="right")
    at = min(int(reached), len(order) - 1)
    threshold = (scores[order[at]] + scores[order[max(at - 1, 0)]]) / 2
    return QualityModel(weights, center, scale, float(threshold), how.cut)


def in_fold(doc_id: str, folds: int) -> Column:
    """The remainder of a document number's checksum that tells its fold; null without a number."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def learn(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> QualityModel:
    """Learn from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality``).

    Labels that are null, or whose document is missing, say nothing.  The rows read are bounded by
    ``how.rows``, whatever the size of the table; the share of bad documents is counted over all labels.
    """
    how = how or Training()
    known = labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    totals = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [
        known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.rows) for q in (0, 1)
    ]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # two numbers a row, twice ``how.rows`` rows
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = features(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(found.tolist(), pa.list_(pa.float64()))],
                names=["doc_id", "quality", "features"],
            )

    found = rows.mapInArrow(run, "doc_id bigint, quality int, features array<double>").toPandas()
    found = found.sort_values("doc_id", kind="stable")
    by = [np.array(found["features"][found["quality"] == q].tolist()).reshape(-1, FEATURES) for q in (1, 0)]
    return train(*by, totals.get(0, 0) / max(sum(totals.values()), 1), how)


def predict(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Rows of ``docs`` as struct ``_row`` with ``score`` and ``predicted``; a null text scores like an empty one."""
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            scores = sent.value.score(features(batch.column("_text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(scores), pa.array((scores >= sent.value.cut).astype(np.int32))],
                names=["_row", "score", "predicted"],
            )

    kind = step.schema["_row"].dataType.simpleString()
    return step.mapInArrow(run, f"_row {kind}, score double, predicted int")
