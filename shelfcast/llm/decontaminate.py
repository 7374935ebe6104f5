"""Benchmark decontamination with an FM-index for each shard of the training text.

Tasks read the documents in shards of bounded size.  A shard's words become symbols (a word that no benchmark
item has is a separator, and runs too short for any window are left out, as nothing can match there); their
suffixes are sorted, and the text is kept as its Burrows-Wheeler transform in a wavelet matrix.  All benchmark
windows are looked up at once by backward search, their occurrences located by walking back to sampled suffix
positions, and overlapping occurrences merged to spans.  Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.workers import release_memory
from shelfcast.shared import written_table

WINDOW = 13
SHARD_WORDS = 2_000_000
BLOCK_BYTES = 8 << 20  # of benchmark text in one broadcast
SAMPLED = 8
#: Bytes of a word, A-Z lower-cased; every other ASCII byte is a blank.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the sorted length; the end of the text counts as smallest."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    length = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - length, 0)] = rank[length:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(steps)])
        if n == 0 or steps.all():
            return order
        length *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbol per level; all methods take arrays."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        current = symbols
        for bit in reversed(range(max(1, int(largest).bit_length()))):
            ones = (current >> bit & 1).astype(bool)
            before = np.zeros(len(current) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(current) - int(before[-1])))
            current = np.concatenate([current[~ones], current[ones]])
        self.first = self._down(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for bit, before, zeros in self.levels:
            ones = before[places].astype(np.int64)
            places = np.where(symbols >> bit & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbols, places) - self.first[symbols]

    def symbol_and_rank(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its occurrences before it."""
        symbols = np.zeros(len(places), np.int64)
        for bit, before, zeros in self.levels:
            ones = before[places].astype(np.int64)
            here = before[places + 1] > ones
            symbols |= here.astype(np.int64) << bit
            places = np.where(here, zeros + ones, places - ones)
        return symbols, places - self.first[symbols]


class FMIndex:
    """Search and locate in a text of symbols from 1 upwards; symbol 0 is the end."""

    def __init__(self, text: np.ndarray, largest: int):
        text = np.append(text, 0).astype(np.int64)
        suffixes = suffix_array(text)
        self.columns = WaveletMatrix(text[suffixes - 1], largest)
        counts = np.bincount(text, minlength=largest + 1)
        self.before = np.cumsum(counts) - counts
        self.sampled = suffixes % SAMPLED == 0
        self.sample_at = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]
        self.size = len(text)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each pattern; ``patterns`` is padded at its right."""
        first, end = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for at in reversed(range(patterns.shape[1])):
            live = np.flatnonzero((lengths > at) & (first < end))
            if len(live):
                symbols = patterns[live, at]
                first[live] = self.before[symbols] + self.columns.rank(symbols, first[live])
                end[live] = self.before[symbols] + self.columns.rank(symbols, end[live])
        return first, end

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by steps back to the next sampled one."""
        rows, steps, found = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            known = self.sampled[at]
            found[open_[known]] = self.samples[self.sample_at[at[known]]] + steps[open_[known]]
            open_ = open_[~known]
            symbols, ranks = self.columns.symbol_and_rank(rows[open_])
            rows[open_], steps[open_] = self.before[symbols] + ranks, steps[open_] + 1
        return found


@dataclass
class Phrases:
    """The distinct windows of a block of benchmark items, as symbols from 2 upwards."""

    vocabulary: dict[bytes, int]
    patterns: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[object, str | None]], window: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            symbols = [vocabulary.setdefault(w, len(vocabulary) + 2) for w in words_of(text)]
            for at in range(max(1, len(symbols) - window + 1) if symbols else 0):
                owners.setdefault(tuple(symbols[at : at + window]), set()).add(str(item))
        patterns = np.zeros((len(owners), window), np.int64)
        for k, symbols in enumerate(owners):
            patterns[k, : len(symbols)] = symbols
        lengths = np.array([len(s) for s in owners], np.int64)
        return cls(vocabulary, patterns, lengths, [sorted(o) for o in owners.values()])


def _runs(texts: list[str | None], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the runs that can hold a window, each followed by symbol 1; their documents and word places; word counts."""
    shortest = int(phrases.lengths.min(initial=1 << 30))
    kept, docs, places, counts = [], [], [], np.zeros(len(texts), np.int64)
    known = phrases.vocabulary.get
    for k, text in enumerate(texts):
        words = words_of(text)
        counts[k] = len(words)
        if len(words) < shortest:
            continue
        symbols = np.array([known(w, 1) for w in words] + [1], np.int64)
        breaks = np.flatnonzero(symbols == 1)
        size = np.diff(breaks, prepend=-1) - 1
        long = size >= shortest
        if not long.any():
            continue
        inside = np.repeat(long, size + 1)
        at = np.flatnonzero(inside)
        kept.append(symbols[at])
        docs.append(np.full(len(at), k))
        places.append(at)
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (kept, docs, places)]
    return (*joined, counts)


def find(texts: list[str | None], phrases: Phrases) -> tuple[np.ndarray, list[list[list[int]]], list[set[str]]]:
    """For each text of a shard: number of words, spans of hit words ``[first, end]``, items that occur."""
    symbols, docs, places, counts = _runs(texts, phrases)
    spans: list[list[list[int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if len(symbols):
        index = FMIndex(symbols, int(phrases.patterns.max(initial=1)))
        first, end = index.search(phrases.patterns, phrases.lengths)
        number = np.maximum(end - first, 0)
        pattern = np.repeat(np.arange(len(number)), number)
        rows = np.arange(len(pattern)) - np.repeat(np.cumsum(number) - number, number) + first[pattern]
        starts = index.locate(rows)
        edge = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + phrases.lengths[pattern], -1)
        # a run ends with a separator, which no occurrence covers, so spans of two runs never touch
        hit = np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]).astype(np.int8)
        begins, ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
        for a, b in zip(begins.tolist(), ends.tolist()):
            spans[docs[a]].append([int(places[a]), int(places[b - 1]) + 1])
        pairs = np.unique(docs[starts] * len(number) + pattern)
        for pair in pairs.tolist():
            items[pair // len(number)].update(phrases.items[pair % len(number)])
    return counts, spans, items


def _merged(a: list, b: list) -> list:
    out: list[list[int]] = []
    for first, end in sorted([*map(list, a), *map(list, b)]):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


SPANS, ITEMS = pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())


def _scan(batches: Iterator[pa.RecordBatch], phrases: Phrases, shard_words: int) -> Iterator[pa.RecordBatch]:
    """Fill ``_n_words``, ``_spans`` and ``_items`` of each row; a shard is a few batches or a part of one."""
    for batch in batches:
        sizes = np.cumsum(batch.column("_size").to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros(0)
        at = 0
        while at < batch.num_rows:
            base = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, base + 6 * shard_words, side="right")))
            part = batch.slice(at, end - at)
            counts, spans, items = find(part.column("_text").to_pylist(), phrases)
            old_spans, old_items = part.column("_spans").to_pylist(), part.column("_items").to_pylist()
            made = {
                "_n_words": pa.array(counts, pa.int64()),
                "_spans": pa.array([_merged(a, b) for a, b in zip(old_spans, spans)], SPANS),
                "_items": pa.array([sorted(set(a) | b) for a, b in zip(old_items, items)], ITEMS),
            }
            arrays = [made.get(n, part.column(i)) for i, n in enumerate(part.schema.names)]
            yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names)
            at = end
    release_memory()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, items = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
        hits = [sum(b - a for a, b in s) for s in spans]
        digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
        made = [
            batch.column("_row"), batch.column("_n_words"), pa.array(hits, pa.int64()), pa.array(map(len, items), pa.int64()),
            pa.array(digests, pa.string()), batch.column("_spans"), batch.column("_items"),
        ]
        names = ["_row", "n_words", "n_hit", "n_items", "items_sha256", "spans", "items"]
        yield pa.RecordBatch.from_arrays(made, names=names)


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """Benchmark items in blocks of about ``block_bytes`` of text, dealt by hash; only one block is at the driver at a time."""
    rows = benchmark.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").alias("text"))
    size, items = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, min(items, -(-size // block_bytes)))
    for k in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r["item"], r["text"]) for r in part.collect()]


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of ``docs`` as struct ``_row`` with ``n_words n_hit n_items items_sha256 spans items contaminated``.

    ``spans`` are merged runs ``[first word, end]`` to remove; ``items`` are the ids with an occurring window,
    sorted as strings.  A null or empty text, in a document or an item, has no words: it hits nothing.  Items
    with equal windows are all named; without items nothing is hit.  Repeated rows are scanned alike, very long texts
    whole, and other columns passed through, whatever their names.  A benchmark of several blocks is searched block by
    block; what has been found is written in between, so that one block's phrases are held at a time.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    step = docs.select(
        row, F.col(f"`{text}`").alias("_text"), F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("_size"),
        F.lit(0).cast("long").alias("_n_words"), F.array().cast("array<array<bigint>>").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
    )
    schema, spark, phrases = step.schema, docs.sparkSession, None
    for items in item_blocks(benchmark, item_id, item_text, block_bytes):
        if phrases is not None:
            step = written_table(step, "contamination")
            phrases.destroy()
        phrases = spark.sparkContext.broadcast(Phrases.of(items, window))  # of about ``block_bytes`` of text
        step = step.mapInArrow(lambda b, p=phrases: _scan(b, p.value, shard_words), schema)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name == "_row")
    kinds = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, spans array<array<bigint>>, items array<string>"
    found = step.mapInArrow(_digested, f"{fields}, {kinds}")
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    return contamination(docs, benchmark).filter("NOT contaminated").select("_row.*")
