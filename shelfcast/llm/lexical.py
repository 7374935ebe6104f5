"""Ranked lexical search by pipelined term partitioning.

The documents are packed into blocks, each an inverted list of the terms that the items ask for.  The terms are dealt
among owners, rare ones first.  Items travel in bundles: a bundle's accumulators, the scores so far of (item, document)
pairs that have any, pass from owner to owner.  At each stage they are cogrouped, block by block, with the owner's
lists, whose integer contributions are added; only then are the best documents of each item chosen, in every block and
then among all blocks.  A block bounds what one task holds, however frequent a term or an item's matches are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.llm.workers import pieces
from shelfcast.operators.joins import attach
from shelfcast.shared import written_table

BEST = 50
#: A block is full at so many documents, or so many occurrences of asked terms, of which its last document may have more.
BLOCK_DOCS = 2048
BLOCK_WORDS = 1 << 20
BUNDLE_ITEMS = 256
#: Bytes of the terms and of the pairs of item and term that are searched for in one pass over the documents.
LOAD_BYTES = 32 * 1024 * 1024
#: An owner holds the terms that occur in at most this share of the documents and are not an earlier owner's.
OWNERS = (1 / 30, 1 / 10, 1.0)
#: A to Z to lower case, digits, letters and all bytes of other characters as they are, anything else to a blank.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256)
)

BLOCK = (
    "block bigint, doc_ids array<bigint>, lengths binary, n_docs bigint, n_terms bigint, terms binary, starts binary,"
    " docs binary, tfs binary"
)
LISTS = "block bigint, bundle int, doc_ids array<bigint>, lengths binary, terms binary, starts binary, docs binary, tfs binary"
SCORES = "block bigint, bundle int, items binary, docs binary, scores binary"
CHOSEN = "item bigint, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split() if text else []


def _term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        sets = [sorted(set(terms_of(t))) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(sets, pa.list_(pa.binary()))], names=["item_id", "terms"])


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item`` (a number), ``item_id``, ``terms``: a row per distinct item id, with its distinct terms."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    found = rows.mapInArrow(_term_sets, f"item_id {kind}, terms array<binary>")
    whole = found.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
    return written_table(whole.withColumn("item", F.monotonically_increasing_id()), "search-items")


class Load:
    """Items searched for together: their vocabulary, and the pairs of item and term by bundle."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["item"])
        self.items = [r["item"] for r in rows]
        self.terms = sorted({bytes(t) for r in rows for t in r["terms"]})
        self.number = {t: k for k, t in enumerate(self.terms)}
        own = [np.array([self.number[bytes(t)] for t in r["terms"]], np.int64) for r in rows]
        #: For each bundle its pairs in order of the term: term numbers, and places of items in the bundle.
        self.bundles: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(rows), BUNDLE_ITEMS):
            part = own[at : at + BUNDLE_ITEMS]
            terms = np.concatenate(part) if part else np.empty(0, np.int64)
            places = np.repeat(np.arange(len(part)), [len(x) for x in part])
            order = np.argsort(terms, kind="stable")
            self.bundles.append((terms[order], places[order]))


def _block(number: int, ids: list, lengths: list[int], found: list[np.ndarray], size: int) -> pa.RecordBatch:
    """Inverted lists of one block: terms ascend, a list's documents ascend."""
    pairs = np.concatenate([doc * size + terms for doc, terms in enumerate(found)]) if found else np.empty(0, np.int64)
    pairs, tfs = np.unique(pairs, return_counts=True)
    docs, terms = np.divmod(pairs, size)
    order = np.argsort(terms, kind="stable")
    distinct, starts = np.unique(terms[order], return_index=True)
    ends = np.append(starts, len(order)).astype("<i4")
    row = [
        [number], [ids], [np.array(lengths, "<i8").tobytes()], [sum(n > 0 for n in lengths)], [sum(lengths)],
        [distinct.astype("<i4").tobytes()], [ends.tobytes()], [docs[order].astype("<u2").tobytes()], [tfs[order].astype("<i4").tobytes()],
    ]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    names = ["block", "doc_ids", "lengths", "n_docs", "n_terms", "terms", "starts", "docs", "tfs"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)


def _index(batches: Iterator[pa.RecordBatch], number: dict[bytes, int], block_docs: int) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive documents of this task."""
    first, size = TaskContext.get().partitionId() << 32, max(1, len(number))
    ids, lengths, found, held = [], [], [], 0
    for batch in pieces(batches, "text"):
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = terms_of(text)
            ids.append(doc)
            lengths.append(len(words))
            found.append(np.fromiter((k for k in map(number.get, words) if k is not None), np.int64))
            held += len(found[-1])
            if len(ids) == block_docs or held >= BLOCK_WORDS:
                yield _block(first, ids, lengths, found, size)
                first, ids, lengths, found, held = first + 1, [], [], [], 0
    if ids:
        yield _block(first, ids, lengths, found, size)


def _frequencies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """In how many documents of this task's blocks each term occurs."""
    totals = np.zeros(size, np.int64)
    for batch in batches:
        for terms, starts in zip(batch.column("terms").to_pylist(), batch.column("starts").to_pylist()):
            totals[np.frombuffer(terms, "<i4")] += np.diff(np.frombuffer(starts, "<i4"))
    terms = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(totals[terms])], names=["term", "df"])


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """Integer weight of each term; a term in no document has none to give."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) if n else 0 for n in df], np.int64)


def owners(n_docs: int, df: np.ndarray, shares: tuple[float, ...]) -> np.ndarray:
    """The owner of each term, by the share of the documents that it occurs in."""
    return np.searchsorted(np.array(shares[:-1]) * n_docs, df, side="left")


def _owned(batches: Iterator[pa.RecordBatch], mine: np.ndarray, bundles: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
    """One owner's lists of each block, for each bundle those of the terms it asks for; the last has the ids too."""
    for batch in batches:
        for row in batch.to_pylist():
            terms, starts = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["starts"], "<i4")
            docs, tfs = np.frombuffer(row["docs"], "<u2"), np.frombuffer(row["tfs"], "<i4")
            for bundle, asked in enumerate(bundles):
                use = np.flatnonzero(mine[terms] & asked[terms])
                sizes = starts[use + 1] - starts[use]
                ends = np.append(0, np.cumsum(sizes))
                at = np.arange(ends[-1]) + np.repeat(starts[use] - ends[:-1], sizes)
                out = [
                    [row["block"]], [bundle], [row["doc_ids"] if last else []], [row["lengths"]], [terms[use].tobytes()],
                    [ends.astype("<i4").tobytes()], [docs[at].tobytes()], [tfs[at].tobytes()],
                ]
                kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 5]
                names = ["block", "bundle", "doc_ids", "lengths", "terms", "starts", "docs", "tfs"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)


class Scorer:
    """The integer scores of a collection of ``n_docs`` documents and ``n_terms`` terms."""

    def __init__(self, n_docs: int, n_terms: int, weight: np.ndarray):
        self.n_docs, self.n_terms, self.weight = n_docs, n_terms, weight

    def impact(self, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        size = 50 + (50 * lengths * self.n_docs) // max(self.n_terms, 1)
        return (1_000_000_000 * tfs) // (1000 * tfs + 20 * size)

    def add(self, held: pa.Table, lists: pa.Table, pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, dict]:
        """Accumulators of one block (items by documents) after an owner's lists; the lists' row."""
        row = lists.to_pylist()[0]
        lengths = np.frombuffer(row["lengths"], "<i8")
        items = int(pairs[1].max()) + 1 if len(pairs[1]) else 1
        total = np.zeros((items, len(lengths)), np.int64)
        for old in held.to_pylist():
            total[np.frombuffer(old["items"], "<u2"), np.frombuffer(old["docs"], "<u2")] = np.frombuffer(old["scores"], "<i8")
        terms, starts = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["starts"], "<i4")
        docs, tfs = np.frombuffer(row["docs"], "<u2"), np.frombuffer(row["tfs"], "<i4").astype(np.int64)
        given = np.repeat(self.weight[terms], np.diff(starts)) * self.impact(tfs, lengths[docs])
        low, high = (np.searchsorted(pairs[0], terms, side=s) for s in ("left", "right"))
        for k in range(len(terms)):  # a document stands in a list once, an item asks for a term once
            part = slice(starts[k], starts[k + 1])
            total[pairs[1][low[k] : high[k]][:, None], docs[part]] += given[part]
        return total, row


def _best(total: np.ndarray, ids: list, names: list[int], best: int) -> pa.RecordBatch:
    """Of each item the highest scores of a block; equal ones by ascending document, null last."""
    known = np.array([i is not None for i in ids], bool)
    number = np.array([0 if i is None else i for i in ids], np.int64)
    found: list[tuple[int, np.ndarray]] = []
    for item in range(len(total)):
        hit = np.flatnonzero(total[item])
        if len(hit) > best:
            mark = np.partition(total[item][hit], len(hit) - best)[len(hit) - best]
            hit = hit[total[item][hit] >= mark]
        order = np.lexsort((number[hit], ~known[hit], -total[item][hit]))[:best]
        found.append((item, hit[order]))
    docs = np.concatenate([x for _, x in found])
    items = np.repeat([names[i] for i, _ in found], [len(x) for _, x in found])
    scores = np.concatenate([total[i][x] for i, x in found])
    return pa.RecordBatch.from_arrays(
        [pa.array(items, pa.int64()), pa.array([ids[d] for d in docs.tolist()], pa.int64()), pa.array(scores, pa.int64())],
        names=["item", "doc_id", "score"],
    )


def _search(docs: DataFrame, load: Load, best: int, block_docs: int, shares: tuple[float, ...]) -> DataFrame:
    """``item doc_id score``: the best documents of every block for each item of one load."""
    number, size = load.number, max(1, len(load.terms))
    blocks = written_table(docs.mapInArrow(lambda b: _index(b, number, block_docs), BLOCK), "search-blocks")
    all_of = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    counts = blocks.select("terms", "starts").mapInArrow(lambda b: _frequencies(b, size), "term bigint, df bigint")
    df = np.zeros(size, np.int64)
    for row in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():  # as many as the load has terms at most
        df[row["term"]] = row["df"]
    scorer, owner, bundles = Scorer(*all_of, weights(all_of[0], df)), owners(all_of[0], df, shares), load.bundles
    asked = [np.isin(np.arange(size), terms) for terms, _ in bundles]
    items = [load.items[at : at + BUNDLE_ITEMS] for at in range(0, len(load.items), BUNDLE_ITEMS)]
    held = docs.sparkSession.createDataFrame([], SCORES)
    last = len(shares) - 1

    def step(own: int):
        def advance(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            bundle = key[1].as_py()
            total, row = scorer.add(left, right, bundles[bundle])
            if own == last:
                return pa.Table.from_batches([_best(total, row["doc_ids"], items[bundle], best)])
            at, places = np.nonzero(total)
            out = [[row["block"]], [bundle], [at.astype("<u2").tobytes()], [places.astype("<u2").tobytes()], [total[at, places].astype("<i8").tobytes()]]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 3]
            return pa.table({n: pa.array(v, k) for n, v, k in zip(("block", "bundle", "items", "docs", "scores"), out, kinds)})

        return advance

    for own in range(len(shares)):
        mine, final = owner == own, own == last
        lists = blocks.mapInArrow(lambda b, mine=mine, final=final: _owned(b, mine, asked, final), LISTS)
        joined = held.groupBy("block", "bundle").cogroup(lists.groupBy("block", "bundle"))
        held = joined.applyInArrow(step(own), CHOSEN if final else SCORES)
    return held


def search(
    docs: DataFrame, items: DataFrame, best: int = BEST, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_docs: int = BLOCK_DOCS, shares: tuple[float, ...] = OWNERS, load_bytes: int = LOAD_BYTES,
) -> DataFrame:
    """``item_id rank doc_id score``: for each item its ``best`` highest-scoring documents with a score above 0.

    Every row of ``docs`` is a document, repeated ones too; equal scores rank by ascending number, null last.  Rows of
    ``items`` with one id are one item with the terms of all of them; a null id is an id like any other.  A null, empty or
    very long text has the terms it has, perhaps none; an item that finds nothing has no row, and empty tables give none.
    Only the named columns are read, so others may have any name.  The terms of ``load_bytes`` of items are broadcast at
    a time; further items are searched for in further passes.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    asked = item_terms(items, item_id, item_text)
    weight = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 64)
    loads = max(1, -(-(asked.agg(F.sum(weight)).first()[0] or 0) // load_bytes))
    found = []
    for k in range(loads):
        own = asked.filter(F.pmod(F.xxhash64("item"), F.lit(loads)) == k).select("item", "terms").collect()  # about load_bytes
        found.append(written_table(_search(rows, Load(own), best, block_docs, shares), "search-best"))
    chosen = found[0]
    for more in found[1:]:
        chosen = chosen.unionByName(more)
    place = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = chosen.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= best)
    named = attach(ranked, asked.select("item", "item_id"), ["item"], "inner")
    return named.select("item_id", "rank", "doc_id", "score")
