"""Substring deduplication with suffix automata of reference shards.

Windows of words are routed to shards by content (``anchors``).  A shard's reference text is kept as a suffix
automaton whose states know the first document that has their strings.  The shard's documents stream through it:
the matching statistics give, for every window, the first document in which it starts, and a window is removed
from every later one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import anchors
from shelfcast.llm.workers import pieces

WINDOW = 50
SHINGLE = 8


class SuffixAutomaton:
    """All substrings of several sequences; each state has the smallest document among its occurrences."""

    def __init__(self):
        self.length, self.link, self.step, self.first = [0], [-1], [{}], [1 << 62]

    def _state(self, length: int, link: int, step: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self.first.append(1 << 62)
        return len(self.length) - 1

    def _split(self, at: int, symbol, target: int) -> int:
        """A copy of ``target`` for the shorter strings that reach it from ``at``."""
        length, link, step = self.length, self.link, self.step
        clone = self._state(length[at] + 1, link[target], dict(step[target]))
        link[target] = clone
        while at >= 0 and step[at].get(symbol) == target:
            step[at][symbol] = clone
            at = link[at]
        return clone

    def add(self, sequence: list, document: int) -> None:
        length, link, step, first = self.length, self.link, self.step, self.first
        last = 0
        for symbol in sequence:
            target = step[last].get(symbol)
            if target is not None:  # an earlier sequence has been here
                last = target if length[target] == length[last] + 1 else self._split(last, symbol, target)
            else:
                new = self._state(length[last] + 1, 0, {})
                at = last
                while at >= 0 and symbol not in step[at]:
                    step[at][symbol] = new
                    at = link[at]
                if at >= 0:
                    target = step[at][symbol]
                    link[new] = target if length[target] == length[at] + 1 else self._split(at, symbol, target)
                last = new
            if document < first[last]:
                first[last] = document

    def finish(self) -> None:
        """Hand first documents down the suffix links, longest strings first."""
        link, first = self.link, self.first
        for state in sorted(range(1, len(first)), key=self.length.__getitem__, reverse=True):
            if first[state] < first[link[state]]:
                first[link[state]] = first[state]

    def first_documents(self, sequence: list, window: int) -> list[int]:
        """For each window of a sequence, the first document with it; no document (a huge number) if none has it."""
        length, link, step, first = self.length, self.link, self.step, self.first
        state = matched = 0
        out = []
        for at, symbol in enumerate(sequence):
            while state and symbol not in step[state]:
                state = link[state]
                matched = length[state]
            following = step[state].get(symbol)
            if following is not None:
                state, matched = following, matched + 1
            while state and length[link[state]] >= window:  # the state of the last ``window`` symbols alone
                state = link[state]
                matched = length[state]
            if at >= window - 1:
                out.append(first[state] if matched >= window else 1 << 62)
        return out


def stretch_of(text: bytes) -> Callable[[int, int], bytes]:
    words = text.split()
    return lambda a, b: b" ".join(words[a:b])


def elements(text: bytes) -> tuple[np.ndarray, Callable[[int, int], bytes]]:
    words = text.split()
    return np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64), lambda a, b: b" ".join(words[a:b])


def judge_shard(documents: list[int], stretches: list[bytes], window: int = WINDOW) -> list[bytes]:
    """For each stretch of a shard, runs of windows with an equal first document: (first window, last, document)."""
    automaton, numbers = SuffixAutomaton(), {}
    sequences = [[numbers.setdefault(w, len(numbers)) for w in s.split(b" ")] for s in stretches]
    for sequence, document in zip(sequences, documents):
        automaton.add(sequence, document)
    automaton.finish()
    out = []
    for sequence in sequences:
        out.append(packed(np.array(automaton.first_documents(sequence, window), np.int64)))
    return out


def packed(found: np.ndarray) -> bytes:
    """Runs of windows with an equal first document: (first window, last, document)."""
    start = np.flatnonzero(np.diff(found, prepend=found[:1] - 1))
    return np.stack([start, np.append(start[1:], len(found)) - 1, found[start]], axis=1).astype(np.int64).tobytes()


def _windows(stretch: bytes, window: int) -> list[bytes]:
    words = stretch.split(b" ")
    return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]


def _spans(window: int) -> Callable:
    def spans(docs: np.ndarray, first: np.ndarray, verdicts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tables = [np.frombuffer(v, np.int64).reshape(-1, 3) for v in verdicts]
        row = np.repeat(np.arange(len(tables)), [len(t) for t in tables])
        table = np.concatenate(tables) if tables else np.zeros((0, 3), np.int64)
        earlier = table[:, 2] < docs[row]
        row, table = row[earlier], table[earlier]
        return row, first[row] + table[:, 0], first[row] + table[:, 1] + window

    return spans


def substring_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Word spans to remove from ``docs`` (``doc_id``, ``text_key``, ``text``), a packed list per text."""
    runs = anchors.runs_of(docs.filter("doc_id IS NOT NULL"), elements, window, SHINGLE)
    candidates = anchors.shared_runs(runs, F.min("doc_id") < F.max("doc_id"))
    contexts = candidates.groupBy("anchor", "digest").agg(
        F.min("doc_id").alias("value"), F.min(F.struct("doc_id", "text_key", "first", "last")).alias("run")
    )
    found = anchors.stretches(docs, contexts, "document", stretch_of, window)
    verdicts = anchors.verdicts_of(
        found, contexts, lambda d, s: judge_shard(d, s, window), "document", lambda s: _windows(s, window), F.min("value"), packed
    )
    return anchors.spans_by_text(candidates, verdicts, _spans(window))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``text`` and ``text_key``; rows equal in number and text are the same to every step."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_key"))


def without_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id n_words n_removed kept_sha256 kept spans``.

    ``kept`` is the text of the words that stay, one blank between; ``spans`` are merged ranges of removed words.
    A null or empty text has no words.  Rows without a number are neither cut nor a reference; rows with equal
    numbers are not earlier than each other, and equal ones are cut alike.
    """
    rows = keyed(docs, doc_id, text)
    spans = substring_spans(rows, window)
    joined = rows.join(anchors.small(spans), ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts, removed, digests, kept, ranges = [], [], [], [], []
            for text_, packed in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text_.encode("utf-8", "surrogatepass").split()
                cut = np.frombuffer(packed or b"", np.int64).reshape(-1, 2).tolist()
                counts.append(len(words))
                removed.append(sum(b - a for a, b in cut))
                for a, b in reversed(cut):
                    del words[a:b]
                line = b" ".join(words)
                digests.append(hashlib.sha256(line).hexdigest())
                kept.append(line.decode("utf-8", "surrogatepass"))
                ranges.append(cut)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests),
                    pa.array(kept, pa.string()), pa.array(ranges, pa.list_(pa.list_(pa.int64()))),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"],
            )

    return joined.mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string, spans array<array<bigint>>"
    )
