"""Removal of repeated byte strings by suffix arrays, sorted in two stages.

Windows of bytes are routed to shards by content (``anchors``).  In a shard, only the suffixes that are smaller than
their successors are sorted directly; one scan over the buckets of first bytes puts every other suffix in its place,
right before its successor's turn.  Adjacent suffixes whose common prefix is a window long are repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import anchors
from shelfcast.llm.workers import pieces

WINDOW = 400
SHINGLE = 32
_NO_NUMBER = -(1 << 63)


def smaller_than_next(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; a stretch's end is smaller than any byte.

    That is told by the next byte that differs from its neighbour, wherever it lies.
    """
    change = np.zeros(len(text), np.int8)
    change[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    change[ends - 1] = -1
    known = np.where(change != 0, np.arange(len(text)), len(text))
    return change[np.minimum.accumulate(known[::-1])[::-1]] > 0


def two_stage_order(text: bytes, ends: np.ndarray, wanted: np.ndarray, depth: int) -> list[int]:
    """The suffixes at positions up to ``wanted`` of each stretch, in order of their first ``depth`` bytes.

    ``ends`` are the stretches' ends and ``wanted`` the last position of each that has to be sorted.  Beyond it
    only the run of suffixes up to the next directly sorted one is needed.
    """
    codes = np.frombuffer(text, np.uint8)
    starts = np.append(0, ends[:-1])
    small = smaller_than_next(codes, ends)
    direct = np.flatnonzero(small)
    following = np.append(direct, len(codes))[np.searchsorted(direct, wanted)]
    stop = np.minimum(following, ends - 1)
    part = np.zeros(len(codes) + 1, np.int32)
    np.add.at(part, starts, 1)
    np.add.at(part, stop + 1, -1)
    needed = np.cumsum(part[:-1]) > 0
    limit = np.minimum(np.arange(len(codes)) + depth, np.repeat(ends, ends - starts))

    # first stage: directly, a group of equal first two bytes at a time
    chosen = np.flatnonzero(needed & small)
    second = codes[np.minimum(chosen + 1, len(codes) - 1)]  # a directly sorted suffix has two bytes at least
    pair = codes[chosen].astype(np.int32) * 256 + second
    chosen = chosen[np.argsort(pair, kind="stable")]
    cuts = np.flatnonzero(np.diff(np.sort(pair))) + 1
    placed: list[int] = []
    for group in np.split(chosen, cuts):
        rows = group.tolist()
        if len(rows) > 1:
            keys = [text[a:b] for a, b in zip(rows, limit[group].tolist())]
            placed += [rows[k] for k in sorted(range(len(rows)), key=keys.__getitem__)]
        else:
            placed += rows

    # second stage: the others fill the heads of their buckets while the buckets are scanned
    large = needed & ~small
    counts = np.bincount(codes[needed], minlength=256)
    large_counts = np.bincount(codes[large], minlength=256)
    head = np.cumsum(counts) - counts
    order = np.full(int(counts.sum()), -1, np.int64)
    if placed:
        sorted_codes = codes[placed]
        rank = np.arange(len(placed)) - np.searchsorted(sorted_codes, sorted_codes)
        order[head[sorted_codes] + large_counts[sorted_codes] + rank] = placed
    order, heads, induced = order.tolist(), head.tolist(), large.tobytes()
    for end in (ends - 1).tolist():  # the empty suffixes behind the stretches come first of all
        if induced[end]:
            order[heads[text[end]]] = end
            heads[text[end]] += 1
    first_of = np.zeros(len(codes), bool)
    first_of[starts] = True
    first_of = first_of.tobytes()
    for at in order:
        before = at - 1
        if at > 0 and induced[before] and not first_of[at]:
            code = text[before]
            order[heads[code]] = before
            heads[code] += 1
    return order


def repeated_windows(stretches: list[bytes], counts: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For each stretch, which of its windows start elsewhere too, in another stretch or in a copy of its own.

    A stretch of count two or more stands for equal suffixes, whose common prefix is all of it.
    """
    text = b"".join(stretches)
    sizes = np.array([len(s) for s in stretches], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    last = ends - window
    order = np.array(two_stage_order(text, ends, last, window), np.int64)
    stretch = np.repeat(np.arange(len(stretches)), sizes)
    rows = order[order <= last[stretch[order]]].tolist()
    heads = [text[p : p + window] for p in rows[:1]]
    same = []
    for place in rows[1:]:
        here = text[place : place + window]
        same.append(here == heads[0])
        heads[0] = here
    equal = np.array(same, bool)
    flagged = np.zeros(len(text), bool)
    rows = np.array(rows, np.int64)
    flagged[rows[1:][equal]] = True
    flagged[rows[:-1][equal]] = True
    return [flagged[a : b + 1] | (n > 1) for a, b, n in zip(starts.tolist(), last.tolist(), counts)]


def judge_shard(counts: list[int], stretches: list[bytes], window: int = WINDOW) -> list[bytes]:
    """Runs (first window, last) of repeated windows of each stretch, packed."""
    return [packed(flags) for flags in repeated_windows(stretches, counts, window)]


def packed(flags: np.ndarray) -> bytes:
    """Runs of set flags: (first, last)."""
    runs = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).reshape(-1, 2)
    runs[:, 1] -= 1
    return runs.astype(np.int64).tobytes()


def _windows(stretch: bytes, window: int) -> list[bytes]:
    return [stretch[i : i + window] for i in range(len(stretch) - window + 1)]


def elements(text: bytes) -> tuple[np.ndarray, Callable[[int, int], bytes]]:
    return np.frombuffer(text, np.uint8), lambda a, b: text[a:b]


def stretch_of(text: bytes) -> Callable[[int, int], bytes]:
    return lambda a, b: text[a:b]


def _spans(window: int) -> Callable:
    def spans(docs: np.ndarray, first: np.ndarray, verdicts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tables = [np.frombuffer(v, np.int64).reshape(-1, 2) for v in verdicts]
        row = np.repeat(np.arange(len(tables)), [len(t) for t in tables])
        table = np.concatenate(tables) if tables else np.zeros((0, 2), np.int64)
        return row, first[row] + table[:, 0], first[row] + table[:, 1] + window

    return spans


def byte_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Byte spans to remove from ``docs`` (``doc_id``, ``text_key``, ``text``), a packed list per text."""
    runs = anchors.runs_of(docs, elements, window, SHINGLE)
    candidates = anchors.shared_runs(runs, F.count(F.lit(1)) > 1)
    contexts = candidates.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("value"), F.min(F.struct("doc_id", "text_key", "first", "last")).alias("run")
    )
    found = anchors.stretches(docs, contexts, "occurrences", stretch_of, window)
    verdicts = anchors.verdicts_of(
        found, contexts, lambda n, s: judge_shard(n, s, window), "occurrences", lambda s: _windows(s, window), F.sum("value"),
        lambda n: packed(n > 1),
    )
    return anchors.spans_by_text(candidates, verdicts, _spans(window))


def without_repeated_bytes(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id n_bytes n_removed n_spans kept_sha256 kept spans``.

    ``kept`` holds the bytes that stay, ``spans`` the maximal runs of removed ones.  A null text is empty.
    Every other row counts as elsewhere, also one of equal number and text, and so does the same text farther on.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    number = F.col(f"`{doc_id}`").cast("long")
    rows = docs.select(
        number.alias("number"), F.coalesce(number, F.lit(_NO_NUMBER)).alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_key")
    )
    spans = byte_spans(rows.drop("number"), window)
    joined = rows.join(anchors.small(spans), ["doc_id", "text_key"], "left").select("number", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sizes, removed, counts, digests, kept, ranges = [], [], [], [], [], []
            for text_, packed in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text_.encode("utf-8", "surrogatepass")
                cut = np.frombuffer(packed or b"", np.int64).reshape(-1, 2).tolist()
                left = b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in cut]], [*[s for s, _ in cut], len(raw)]))
                sizes.append(len(raw))
                removed.append(len(raw) - len(left))
                counts.append(len(cut))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
                ranges.append(cut)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("number"), *[pa.array(c, pa.int64()) for c in (sizes, removed, counts)], pa.array(digests),
                    pa.array(kept, pa.binary()), pa.array(ranges, pa.list_(pa.list_(pa.int64()))),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"],
            )

    return joined.mapInArrow(run, (
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<array<bigint>>"
    ))
