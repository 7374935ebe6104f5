"""SimHash near-duplicates by BK-trees.

Documents with equal fingerprints are one node.  Fingerprints that differ in few bits agree in some of the blocks
that their bits are cut into, so each goes to the shards named by its choices of blocks, and a shard's fingerprints
form a BK-tree: children hang on their parent by their Hamming distance to it, and a query follows only the edges
within the radius of its own distance.  A shard gives a star of links for each of its connected groups, never all
pairs.  The links of all shards are joined to components by rounds of minima over the shared folder.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.workers import pieces
from shelfcast.operators.joins import attach, fits_broadcast
from shelfcast.shared import scratch, written_table

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Blocks that the bits are cut into: 15 choices of two of six have 21 bits each, enough for some billion prints.
BLOCKS = 6
FRONTIER = 2_000_000
BROADCAST_BYTES = 32 * 1024 * 1024
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit majority over the hashes of all word shingles, repeats included; zero without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    first = [0, *ends[:-1]]
    spans = zip(first, ends[shingle - 1 :]) if len(words) >= shingle else [(0, len(line) + 1)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a : b - 1], SEED) for a, b in spans], dtype=np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` as struct ``_row`` with ``_print``, the fingerprint as a signed number."""
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            prints = np.array([fingerprint(t) for t in batch.column("_text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(prints.view(np.int64))], names=["_row", "_print"])

    return step.mapInArrow(run, f"_row {step.schema['_row'].dataType.simpleString()}, _print bigint")


class BKForest:
    """One BK-tree per shard, in arrays; shards and prints are parallel arrays, prints distinct in a shard."""

    def __init__(self, shards: np.ndarray, prints: np.ndarray):
        n = len(prints)
        self.prints = prints
        self.parent = np.full(n, -1, np.int64)
        self.distance = np.full(n, -1, np.int64)
        order = np.argsort(shards, kind="stable")
        starts = np.flatnonzero(np.diff(shards[order], prepend=shards[order][:1] - 1)) if n else order
        self.root = np.empty(n, np.int64)
        self.root[order] = np.repeat(order[starts], np.diff(np.append(starts, n)))
        # level by level: the rows still below a node go down its edges, and the first on an edge becomes its child
        rows = np.setdiff1d(np.arange(n), order[starts], assume_unique=True)
        above = self.root[rows]
        while len(rows):
            apart = np.bitwise_count(prints[rows] ^ prints[above]).astype(np.int64)
            edge = above * (BITS + 1) + apart
            _, first, which = np.unique(edge, return_index=True, return_inverse=True)
            child = rows[first]
            self.parent[child], self.distance[child] = above[first], apart[first]
            below = np.ones(len(rows), bool)
            below[first] = False
            above, rows = child[which][below], rows[below]
        children = np.flatnonzero(self.parent >= 0)
        keys = self.parent[children] * (BITS + 1) + self.distance[children]
        order = np.argsort(keys, kind="stable")
        self.keys, self.children = keys[order], children[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query row, tree row) at most ``radius`` apart, the tree row being the smaller; a part at a time."""
        stack = [(queries, self.root[queries])]
        while stack:
            asked, node = stack.pop()
            if len(asked) > FRONTIER:
                half = len(asked) // 2
                stack += [(asked[:half], node[:half]), (asked[half:], node[half:])]
                continue
            apart = np.bitwise_count(self.prints[asked] ^ self.prints[node]).astype(np.int64)
            near = (apart <= radius) & (node < asked)
            yield asked[near], node[near]
            low = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(apart - radius, 0))
            high = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(apart + radius, BITS), side="right")
            number = high - low
            total = int(number.sum())
            if total:
                at = np.arange(total) - np.repeat(np.cumsum(number) - number, number) + np.repeat(low, number)
                stack.append((np.repeat(asked, number), self.children[at]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of linked rows; a label is the smallest row of its group."""
    while True:
        one, two = label[a], label[b]
        differ = one != two
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(label, np.maximum(one, two)[differ], np.minimum(one, two)[differ])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def shard_links(shards: np.ndarray, prints: np.ndarray, nodes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A star of links for each group of a shard: each node with the smallest one of its group."""
    order = np.lexsort((nodes, shards))
    shards, prints, nodes = shards[order], prints[order], nodes[order]
    forest = BKForest(shards, prints.view(np.uint64))
    label = np.arange(len(prints))
    for a, b in forest.within(np.arange(len(prints)), radius):
        _merge(label, a, b)
    linked = label != np.arange(len(prints))
    return nodes[linked], nodes[label[linked]]


def block_choices(blocks: int, radius: int) -> list[list[tuple[int, int]]]:
    """Choices of bit ranges (shift, width), one of which any two prints within the radius agree in."""
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    ranges = [(a, b - a) for a, b in zip(edges, edges[1:])]
    return [list(c) for c in itertools.combinations(ranges, blocks - radius)]


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a``, ``b`` (``b`` the smaller) that connect the nodes of ``prints`` (``_print``, ``node``).

    Any number of blocks above the radius gives the same components; more of them make more, smaller shards.
    """
    keys = []
    for choice, ranges in enumerate(block_choices(blocks, radius)):
        mask = sum(((1 << width) - 1) << shift for shift, width in ranges)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(choice), F.col("_print").bitwiseAND(F.lit(signed).cast("long"))))
    dealt = prints.select("_print", "node", F.explode(F.array(*keys)).alias("shard")).repartition("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All shards of a partition as one forest; a fingerprint takes 24 bytes."""
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if held:
            prints_, nodes, shards = (np.concatenate([h[k] for h in held]) for k in range(3))
            a, b = shard_links(shards, prints_, nodes, radius)
            pairs = np.unique(np.stack([a, b], axis=1), axis=0)
            for at in range(0, len(pairs), 100_000):
                part = pairs[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected to, for all nodes that have a link.

    Each round lets a node take the smallest label among its neighbours and itself, then the label of that
    label; both are joins and minima that combine before the shuffle.  Rounds are written, not kept in lineage.
    """
    edges = written_table(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written_table(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        offered = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("offer"))
        lower = labels.join(offered.withColumnRenamed("a", "node"), "node").select("node", F.least("label", "offer").alias("label"))
        lower = written_table(lower, "labels")
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = written_table(lower.join(up, "label").select("node", F.col("up").alias("label")), "labels")
        changed = jumped.join(labels.withColumnRenamed("label", "old"), "node").filter("label <> old")
        done = changed.limit(1).count() == 0
        labels = jumped
        if done:
            return labels.withColumnRenamed("label", "component")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    A component's id is its smallest document number.  Texts that are null, empty or blank have fingerprint
    zero and link like any other.  Rows without a number stand in the component of their fingerprint, and
    in a null one if no row of it has a number; rows with equal numbers but different texts are separate.
    An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = written_table(with_fingerprints(rows).select(F.col("_row.doc_id").alias("doc_id"), "_print"), "fingerprints")
    found = written_table(component_of(prints, radius), "print-components")
    return attach(prints, found, ["_print"], "inner", BROADCAST_BYTES).select(
        "doc_id", F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def component_of(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``_print``, ``_group`` (its component as a number) and ``component_id`` of each print of ``prints``."""
    # the node of a fingerprint is itself, so that it exists whatever its documents' numbers are
    nodes = written_table(prints.groupBy("_print").agg(F.min("doc_id").alias("least")), "nodes")
    linked = components(near_links(nodes.select("_print", F.col("_print").alias("node")), radius))
    placed = nodes.join(linked.withColumnRenamed("node", "_print"), "_print", "left")
    placed = placed.select("_print", "least", F.coalesce("component", "_print").alias("_group"))
    least = placed.groupBy("_group").agg(F.min("least").alias("component_id"))
    return placed.join(least, "_group").select("_print", "_group", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, unchanged, one for each component: that of its smallest number.

    Rows without a number come after all others; of rows with equal numbers that of the smallest text digest
    stays, and of rows equal in number and text, one.
    """
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    with scratch(docs.sparkSession):
        prints = written_table(with_fingerprints(named).select(
            F.col("_row.doc_id").alias("doc_id"), "_print", F.xxhash64("_row.text").alias("digest")
        ), "fingerprints")
        found = written_table(component_of(prints, radius).select("_print", "_group"), "print-groups")
        grouped = attach(prints, found, ["_print"], "inner", BROADCAST_BYTES)
        return keep_one(docs, grouped.select("doc_id", "digest", "_group"), doc_id, text)


def keep_one(docs: DataFrame, grouped: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one for each group of ``grouped`` (``doc_id``, ``digest`` of the text, ``_group``), as :func:`one_of_each` says.

    Called inside a :func:`scratch`, which the result outlasts.
    """
    number, digest = F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.col(f"`{text}`"))
    counted = written_table(grouped.groupBy("_group", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n")), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    first = counted.groupBy("_group").agg(F.min(place).alias("first"))
    chosen = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.digest") == F.col("digest"))
    marks = counted.join(first, "_group").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.when(chosen, F.lit("once")).otherwise(F.lit("drop")).alias("mark"), "n"
    ).filter("mark = 'drop' OR n > 1").select("_id", "_digest", "mark")
    marks = written_table(marks, "marks", lasting=True)
    marks = F.broadcast(marks) if fits_broadcast(marks, BROADCAST_BYTES) else marks
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), number.alias("id"), digest.alias("digest"))
    marked = rows.join(marks, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    again = marked.filter("mark = 'once'").dropDuplicates(["id", "digest"])
    return marked.filter("mark IS NULL").select("_row").unionByName(again.select("_row")).select("_row.*")
