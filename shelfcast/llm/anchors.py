"""Routing of windows by content: equal windows meet in one shard, and each window of a text goes to one shard only.

Of the shingles inside a window the one with the smallest hash, the leftmost if equal, is its anchor; equal windows
have equal anchors at equal places.  Neighbouring windows mostly share an anchor, so a text falls into runs of
windows, each described by the anchor's hash and a digest of the stretch of text that its windows cover.  Runs whose
anchor occurs once can have no equal window anywhere and drop out before any text is moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import BROADCAST_BYTES, fits_broadcast
from shelfcast.llm.workers import pieces
from shelfcast.shared import written_table

PLACE_BITS = 28
PIECE = 1 << 20
SHARD_BYTES = 1 << 19
CROWDED = 20_000

RUNS = "anchor bigint, digest bigint, doc_id bigint, text_key bigint, first bigint, last bigint"


def shingle_hashes(elements: np.ndarray, shingle: int) -> np.ndarray:
    """Hashes of all runs of ``shingle`` (a power of two) elements."""
    hashes, size = elements.astype(np.uint64), 1
    while size < shingle:
        hashes = hashes[:-size] * np.uint64(0x9E3779B97F4A7C15) + hashes[size:] * np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(29)
        size *= 2
    return hashes * np.uint64(0xBF58476D1CE4E5B9)


def window_runs(elements: np.ndarray, window: int, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window of each run of windows of one text or piece of it."""
    n = len(elements) - window + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = shingle_hashes(elements, shingle)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = hashes & ~mask | np.arange(len(hashes), dtype=np.uint64)
    reach, size = window - shingle + 1, 1
    while 2 * size <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if reach > size:
        least = np.minimum(least[: -(reach - size)], least[reach - size :])
    place = (least & mask).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return hashes[place[first]].view(np.int64), first, np.append(first[1:], n) - 1


def runs_of(
    docs: DataFrame, elements: Callable[[bytes], tuple[np.ndarray, Callable[[int, int], bytes]]], window: int, shingle: int
) -> DataFrame:
    """All runs of ``docs`` (``doc_id``, ``text_key``, ``text``), written once.

    ``elements`` gives the elements of a text as numbers, and a function for the bytes of a range of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for doc, key, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text")]):
                values, stretch = elements((text or "").encode("utf-8", "surrogatepass"))
                for at in range(0, max(len(values) - window + 1, 0), PIECE):
                    anchor, first, last = window_runs(values[at : at + PIECE + window - 1], window, shingle)
                    first, last = first + at, last + at
                    digests = [xxhash.xxh3_64_intdigest(stretch(a, b)) for a, b in zip(first.tolist(), (last + window).tolist())]
                    digest = np.array(digests, np.uint64).view(np.int64)
                    for column, values_ in zip(out, (anchor, digest, np.full(len(first), doc), np.full(len(first), key), first, last)):
                        column.append(values_)
            if out[0]:
                arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in out]
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "digest", "doc_id", "text_key", "first", "last"])

    return written_table(docs.select("doc_id", "text_key", "text").mapInArrow(run, RUNS), "runs")


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast once its bytes have been measured and found few; else joined by shuffle."""
    return F.broadcast(df) if fits_broadcast(df, BROADCAST_BYTES) else df


def shared_runs(runs: DataFrame, shared) -> DataFrame:
    """Runs whose anchor satisfies ``shared``, a condition on aggregates over its runs.  Copies combine before the shuffle."""
    anchors = written_table(runs.groupBy("anchor").agg(shared.alias("_shared")).filter("_shared").select("anchor"), "anchors")
    return written_table(runs.join(small(anchors), "anchor", "left_semi"), "shared-runs")


def stretches(docs: DataFrame, contexts: DataFrame, extra: str, cut: Callable[[bytes], Callable[[int, int], bytes]], window: int) -> DataFrame:
    """The bytes of each distinct context, from the text of its first run.

    ``contexts`` has ``anchor digest value run``, with ``value`` a number to pass on; a text's contexts are gathered in
    one row, which is bounded by the text itself.
    """
    wanted = contexts.groupBy(F.col("run.doc_id").alias("doc_id"), F.col("run.text_key").alias("text_key")).agg(
        F.collect_list(F.struct("anchor", "digest", "value", "run.first", "run.last")).alias("list")
    )
    packed = wanted.mapInArrow(_packed, "doc_id bigint, text_key bigint, packed binary")
    packed = written_table(packed, "wanted")
    joined = docs.join(small(packed), ["doc_id", "text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            for text, packed_ in zip(batch.column("text").to_pylist(), batch.column("packed").to_pylist()):
                table = np.frombuffer(packed_, np.int64).reshape(-1, 5)
                stretch = cut((text or "").encode("utf-8", "surrogatepass"))
                found = [stretch(a, b + window) for a, b in table[:, 3:].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(table[:, k]) for k in range(3)] + [pa.array(found, pa.binary())],
                    names=["anchor", "digest", extra, "stretch"],
                )

    return joined.select("text", "packed").mapInArrow(run, f"anchor bigint, digest bigint, {extra} bigint, stretch binary")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("list")
        flat = np.stack([lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(5)], axis=1).astype(np.int64) if batch.num_rows else np.zeros((0, 5), np.int64)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) if batch.num_rows else []
        begin, out = 0, []
        for end in ends:
            out.append(np.ascontiguousarray(flat[begin:end]).tobytes())
            begin = int(end)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(out, pa.binary())], names=["doc_id", "text_key", "packed"]
        )


def verdicts_of(
    found: DataFrame, contexts: DataFrame, judge: Callable, value: str, windows: Callable[[bytes], list[bytes]],
    combined: Column, pack: Callable[[np.ndarray], bytes],
) -> DataFrame:
    """``anchor``, ``digest`` and packed ``verdict`` of every context.

    Anchors with more than ``CROWDED`` distinct contexts, which would crowd one task, are taken apart: their
    windows meet one by one, by a 128-bit digest, and copies combine before the shuffle.  ``combined`` is the
    aggregate of ``value`` over equal windows, and ``pack`` makes a verdict of a context's aggregates.
    """
    counts = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    crowded = written_table(counts.filter(F.col("n") > CROWDED).select("anchor"), "crowded")
    if crowded.isEmpty():
        return in_shards(found, judge, value)
    found, crowded = written_table(found, "stretches"), small(crowded)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "stretch"):
            parts = [[xxhash.xxh3_128_digest(w) for w in windows(s)] for s in batch.column("stretch").to_pylist()]
            numbers = np.array([len(p) for p in parts], np.int64)
            repeated = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), numbers) for c in ("anchor", "digest", value)]
            place = np.concatenate([np.arange(n) for n in numbers]) if len(numbers) else numbers
            arrays = [pa.array(x) for x in (*repeated, place)] + [pa.array([w for p in parts for w in p], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "digest", "value", "place", "window"])

    once = found.join(crowded, "anchor").dropDuplicates(["anchor", "digest"])  # rows of equal number and text give two
    alone = written_table(once.mapInArrow(
        apart, "anchor bigint, digest bigint, value bigint, place bigint, window binary"
    ), "windows")
    sums = alone.groupBy("window").agg(combined.cast("long").alias("all"))
    lists = alone.join(sums, "window").groupBy("anchor", "digest").agg(F.sort_array(F.collect_list(F.struct("place", "all"))).alias("list"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [pack(np.array([x["all"] for x in row], np.int64)) for row in batch.column("list").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("digest"), pa.array(out, pa.binary())], names=["anchor", "digest", "verdict"]
            )

    hard = lists.mapInArrow(packed, "anchor bigint, digest bigint, verdict binary")
    return in_shards(found.join(crowded, "anchor", "left_anti"), judge, value).unionByName(hard)


def in_shards(found: DataFrame, judge: Callable, value: str) -> DataFrame:
    """``anchor``, ``digest`` and packed ``verdict`` of every context.

    Contexts are dealt by anchor; a task takes them in order of the anchor and hands whole anchors to ``judge``, as
    many at a time as have ``SHARD_BYTES`` together.  ``judge`` gets lists of values and stretches.
    """
    ordered = found.repartition("anchor").sortWithinPartitions("anchor", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            verdicts = judge([h[2] for h in held], [h[3] for h in held])
            arrays = [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()), pa.array(verdicts, pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["anchor", "digest", "verdict"])

        size, seen = 0, None
        for batch in pieces(batches, "stretch"):
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "digest", value, "stretch")]):
                if row[:2] == seen:
                    continue  # rows of equal number and text give a context twice
                if held and row[0] != held[-1][0] and size >= SHARD_BYTES:
                    yield flush()
                    size = 0
                seen = row[:2]
                held.append(row)
                size += len(row[3])
        if held:
            yield flush()

    return ordered.mapInArrow(run, "anchor bigint, digest bigint, verdict binary")


def spans_by_text(candidates: DataFrame, verdicts: DataFrame, spans: Callable) -> DataFrame:
    """``doc_id``, ``text_key`` and packed ``spans`` (begin, end; sorted, merged) of each text that has any.

    ``spans`` turns (doc numbers, first windows, verdicts) into arrays (row, begin, end) of elements to remove.
    """
    joined = candidates.join(written_table(verdicts, "verdicts"), ["anchor", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "first"))
            row, begin, end = spans(docs, first, batch.column("verdict").to_pylist())
            keys = batch.column("text_key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (docs[row], keys[row], begin, end)], names=["doc_id", "text_key", "begin", "end"]
            )

    rows = joined.select("doc_id", "text_key", "first", "verdict").mapInArrow(
        run, "doc_id bigint, text_key bigint, begin bigint, end bigint"
    )
    listed = rows.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("list"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans_ in batch.column("list"):
                table = np.array([(s["begin"].as_py(), s["end"].as_py()) for s in spans_.values], np.int64)
                table = table[np.argsort(table[:, 0], kind="stable")]
                reach = np.maximum.accumulate(table[:, 1])
                start = np.append(True, table[1:, 0] > reach[:-1])
                begins = table[start, 0]
                ends = reach[np.append(np.flatnonzero(start)[1:] - 1, len(table) - 1)]
                out.append(np.stack([begins, ends], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(out, pa.binary())], names=["doc_id", "text_key", "spans"]
            )

    return written_table(listed.mapInArrow(merge, "doc_id bigint, text_key bigint, spans binary"), "spans")
