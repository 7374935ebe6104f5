"""Near-duplicate texts: five words a shingle, a Jaccard similarity of 0.8 or more, checked exactly.

Texts with equal sets of shingles are one node.  Candidates come from two searches.  The BK-trees of the SimHash
operator link each node to the nearest earlier one within the radius of its fingerprint, which finds close copies.
Min-hash bands find the others: nodes that agree in a band meet in a bucket, where each is compared by its signature
with the bucket's leaders, linked to the likeliest ones, and becomes a leader itself unless one is almost sure to be
similar.  A bucket thus gives a few links per node, never all pairs, and large buckets are taken in pieces whose leaders
meet again.  Every candidate is then checked on the shingle sets themselves, and only true links join components.
What these few links leave out is searched for afterwards: all pairs of a shard or bucket whose nodes are still in
different components are checked too, so that in the end each such pair is connected or has been compared.  They are
compared where their shard or bucket lies, each pair in one of those it shares, and no row is made for a pair: nodes that
have a candidate go there with their sets, and what comes back is links that join components.

A pair of similarity s shares one of ``BANDS`` bands of ``ROWS`` values with probability 1 - (1 - s ** ROWS) ** BANDS:
0.995 at 0.8.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.simhash import BLOCKS, FRONTIER, LOWER, RADIUS, BKForest, block_choices, components, fingerprint, keep_one
from shelfcast.llm.workers import pieces, release_memory
from shelfcast.operators.joins import attach
from shelfcast.shared import scratch, written_table

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
SEED = 42
#: Signatures that agree in this share are candidates; from ``SURE`` on the later one is no leader of its own.
LIKELY, SURE = 0.6, 0.95
#: Leaders that a node is linked to in a bucket, the likeliest ones.
LINKS = 4
PIECE_NODES = 20_000
#: Nodes of a piece whose shingle sets are held together.
PIECE_SETS = 2_000
#: Hashes that are looked up in a set at once.
SET_HASHES = 1 << 20
#: Signatures and sets are broadcast up to this size, measured.
BROADCAST_BYTES = 16 * 1024 * 1024
_PRIME = (1 << 61) - 1


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of fewer words the whole sequence, of none nothing."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    spans = zip([0, *ends], ends[size - 1 :]) if len(words) >= size else [(0, len(line) + 1)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a : b - 1], SEED) for a, b in spans], np.uint64))


def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, count, dtype=np.uint64)


_TIMES, _PLUS = _factors(BANDS * ROWS)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest of all hashes under each of the mixings, 32 bits each."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 4096):
        mixed = hashes[at : at + 4096, None] * _TIMES + _PLUS
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        least = np.minimum(least, (mixed >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return least


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        texts = batch.column("text").to_pylist()
        sets = [shingles(t) for t in texts]
        content = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        prints = np.array([fingerprint(t, SHINGLE) for t in texts], np.uint64).view(np.int64)
        signatures = [signature(s).tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(content, pa.binary()), pa.array(prints), pa.array(signatures, pa.binary())],
            names=["doc_id", "digest", "content", "print", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        sets = [shingles(t).tobytes() for t in batch.column("text").to_pylist()]
        content = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(content, pa.binary()), pa.array(sets, pa.binary())], names=["content", "hashes"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key per node and band."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = _band_keys(np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32)).reshape(-1)
        node = batch.column("node").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(node, BANDS)), pa.array(keys)], names=["node", "band"])


def led(nodes: np.ndarray, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (node, leader) of one bucket, ``LINKS`` a node at most, and its leaders; nodes are taken in ascending order."""
    order = np.argsort(nodes)
    nodes, signatures = nodes[order], signatures[order]
    leaders: list[int] = []
    rest = np.arange(len(nodes))
    best, by = np.zeros((len(nodes), LINKS)), np.full((len(nodes), LINKS), -1)
    while len(rest):  # the first that is left leads; those it is sure of are done
        first, rest = rest[0], rest[1:]
        leaders.append(int(first))
        alike = (signatures[rest] == signatures[first]).mean(axis=1) if len(rest) else np.empty(0)
        least = best[rest].argmin(axis=1) if len(rest) else np.empty(0, np.int64)
        better = alike > best[rest, least]
        best[rest[better], least[better]], by[rest[better], least[better]] = alike[better], first
        rest = rest[alike < SURE]
    at, which = np.nonzero(best >= LIKELY)
    return nodes[at], nodes[by[at, which]], nodes[leaders]


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All buckets of a partition, whose rows come in order of their bucket; leaders are linked to themselves."""
    held: list[tuple[int, bytes]] = []
    bucket, many = None, None

    def flush() -> pa.RecordBatch:
        nodes = np.array([n for n, _ in held], np.int64)
        a, b, leaders = led(nodes, np.frombuffer(b"".join(s for _, s in held), np.uint32).reshape(len(held), -1))
        again = leaders if many > 1 else leaders[:0]  # only those of a bucket in pieces meet again
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a) + len(again), bucket[0])), pa.array(np.append(a, again)), pa.array(np.append(b, again))],
            names=["band", "a", "b"],
        )

    for batch in batches:
        for band, piece, count, node, signed in zip(*[batch.column(c).to_pylist() for c in ("band", "piece", "pieces", "node", "signature")]):
            if (band, piece) != bucket:
                if len(held) > 1 or held and many > 1:
                    yield flush()
                bucket, many = (band, piece), count
                held.clear()
            held.append((node, signed))
    if len(held) > 1 or held and many > 1:
        yield flush()
    release_memory()


def _within_bands(dealt: DataFrame) -> DataFrame:
    """``band a b`` from rows ``band piece pieces node signature``."""
    ordered = dealt.repartition("band", "piece").sortWithinPartitions("band", "piece", "node")
    return ordered.mapInArrow(_led, "band bigint, a bigint, b bigint")


def band_links(nodes: DataFrame, piece_nodes: int = PIECE_NODES) -> DataFrame:
    """Candidate links ``a``, ``b`` of nodes (``node``, ``signature``) that agree in a band."""
    keyed = written_table(nodes.select("node", "signature").mapInArrow(_bands, "node bigint, band bigint"), "bands")
    shared = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written_table(shared.select("band", F.ceil(F.col("n") / piece_nodes).cast("int").alias("pieces")), "shared-bands")
    met = attach(keyed, shared, ["band"], "inner").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    signed = written_table(attach(met, nodes.select("node", "signature"), ["node"], "inner", BROADCAST_BYTES, hot_rows=None), "band-members")
    links = [written_table(_within_bands(signed), "band-links")]
    left = links[0].filter("a = b")
    while not left.isEmpty():  # leaders of a bucket's pieces meet, again in pieces if there are very many
        counts = left.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / piece_nodes).cast("int").alias("pieces"))
        counts = written_table(counts, "leader-counts")
        again = attach(left.select("band", F.col("a").alias("node")), counts, ["band"], "inner")
        again = again.withColumn("piece", F.pmod(F.xxhash64(F.lit(len(links)), "node"), F.col("pieces")).cast("int"))
        met = attach(again, nodes.select("node", "signature"), ["node"], "inner", BROADCAST_BYTES, hot_rows=None)
        links.append(written_table(_within_bands(met), "band-links"))
        fewer = links[-1].filter("a = b")
        left = fewer if fewer.count() < left.count() else fewer.limit(0)  # pieces whose leaders are all unlike stay apart
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found.filter("a <> b").select("a", "b").distinct()


def _masks(radius: int, blocks: int) -> list[int]:
    return [sum(((1 << width) - 1) << shift for shift, width in ranges) for ranges in block_choices(blocks, radius)]


def _shard_keys(radius: int, blocks: int) -> list[Column]:
    """The shards of a print: any two prints within the radius share one."""
    keys = []
    for choice, mask in enumerate(_masks(radius, blocks)):
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(choice), F.col("print").bitwiseAND(F.lit(signed).cast("long"))))
    return keys


def _first_shard(one: np.ndarray, two: np.ndarray, masks: list[int]) -> np.ndarray:
    """The first choice of blocks in which prints agree, -1 for none."""
    first, apart = np.full(len(one), -1), one ^ two
    for choice, mask in enumerate(masks):
        first[(first < 0) & (apart & np.uint64(mask) == 0)] = choice
    return first


def _band_keys(values: np.ndarray) -> np.ndarray:
    """A key per signature and band."""
    keys = [xxhash.xxh64_intdigest(v.tobytes(), band) for row in values.reshape(-1, BANDS, ROWS) for band, v in enumerate(row)]
    return np.array(keys, np.uint64).view(np.int64).reshape(-1, BANDS)


def print_links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Candidate links from the BK-trees: each node with the nearest earlier print within the radius, one per shard."""
    first = written_table(nodes.groupBy("print").agg(F.min("node").alias("node")), "prints")
    same = attach(nodes.select("print", F.col("node").alias("a")), first.withColumnRenamed("node", "b"), ["print"], "inner").filter("a <> b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not held:
            return
        prints, rows, shards = (np.concatenate([h[k] for h in held]) for k in range(3))
        order = np.lexsort((rows, shards))
        prints, rows, shards = prints[order].view(np.uint64), rows[order], shards[order]
        forest, count = BKForest(shards, prints), len(rows)
        nearest = np.full(count, (1 << 62), np.int64)
        for a, b in forest.within(np.arange(count), radius):
            apart = np.bitwise_count(prints[a] ^ prints[b]).astype(np.int64)
            np.minimum.at(nearest, a, apart * count + b)
        hit = np.flatnonzero(nearest < 1 << 62)
        yield pa.RecordBatch.from_arrays([pa.array(rows[hit]), pa.array(rows[nearest[hit] % count])], names=["a", "b"])
        release_memory()

    dealt = first.select("print", "node", F.explode(F.array(*_shard_keys(radius, blocks))).alias("shard")).repartition("shard")
    return dealt.mapInArrow(run, "a bigint, b bigint").unionByName(same.select("a", "b")).distinct()


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one run after another."""
    return np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def _products(a: np.ndarray, b: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a row of run ``a`` and a row of run ``b``, some million at a time."""
    for at in range(0, len(a), 10_000):
        one, two = a[at : at + 10_000], b[at : at + 10_000]
        left, right = _runs(starts[one], counts[one]), np.repeat(two, counts[one])
        ends, done = np.cumsum(counts[right]), 0
        while done < len(left):
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + FRONTIER, side="right")))
            part = right[done:upto]
            yield np.repeat(left[done:upto], counts[part]), _runs(starts[part], counts[part])
            done = upto


def _several_groups(keyed: DataFrame, key: str) -> DataFrame:
    """Rows ``key node`` and others of those keys whose nodes are in more than one component, with the count ``n`` of nodes."""
    mixed = keyed.groupBy(key).agg(F.min("_group").alias("low"), F.max("_group").alias("high"), F.count(F.lit(1)).alias("n"))
    return attach(keyed, written_table(mixed.filter("low < high").select(key, "n"), "mixed-keys"), [key], "inner")


def print_pairs(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, members: bool = False) -> DataFrame:
    """All pairs ``a``, ``b`` of nodes (``node print _group``) of different components whose prints are within the radius.

    With ``members`` the nodes of such pairs instead: ``key choice node``, for the first shard that a pair shares.
    """
    masks = _masks(radius, blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not held:
            return
        choices, shards, prints, rows, groups_ = (np.concatenate([h[k] for h in held]) for k in range(5))
        order = np.lexsort((rows, prints, shards))
        choices, shards, prints, rows, groups_ = choices[order], shards[order], prints[order].view(np.uint64), rows[order], groups_[order]
        asked = np.zeros(len(rows), bool)
        fresh = np.append(True, (shards[1:] != shards[:-1]) | (prints[1:] != prints[:-1]))
        starts = np.flatnonzero(fresh)
        counts = np.diff(np.append(starts, len(rows)))
        same = np.flatnonzero(counts > 1)
        near = BKForest(shards[starts], prints[starts]).within(np.arange(len(starts)), radius)
        for one, two in itertools.chain([(same, same)], near):
            for a, b in _products(one, two, starts, counts):
                apart = (groups_[a] != groups_[b]) & (rows[a] != rows[b])
                if members:
                    a, b = a[apart], b[apart]
                    here = _first_shard(prints[a], prints[b], masks) == choices[a]
                    asked[a[here]] = asked[b[here]] = True
                    continue
                a, b = rows[a[apart]], rows[b[apart]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        if members:
            yield pa.RecordBatch.from_arrays([pa.array(shards[asked]), pa.array(choices[asked], pa.int32()), pa.array(rows[asked])], names=["key", "choice", "node"])
        release_memory()

    keyed = nodes.select(F.posexplode(F.array(*_shard_keys(radius, blocks))).alias("choice", "shard"), "print", "node", "_group")
    dealt = _several_groups(keyed, "shard").select("choice", "shard", "print", "node", "_group").repartition("shard")
    return dealt.mapInArrow(run, "key bigint, choice int, node bigint" if members else "a bigint, b bigint").distinct()


def band_pairs(nodes: DataFrame, piece_nodes: int = PIECE_NODES, members: bool = False) -> DataFrame:
    """All pairs of nodes (``node signature _group``) of different components that agree in a band and whose signatures
    are alike; the pieces of a large bucket meet two by two.

    With ``members`` the nodes of such pairs instead: ``key choice node``, for the first band that a pair shares; choice is -1.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def pairs() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            rows, groups_ = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
            signed = np.frombuffer(b"".join(h[2] for h in held), np.uint32).reshape(len(held), -1)
            asked, keys = np.zeros(len(held), bool), _band_keys(signed) if members else None
            for k in range(len(held) - 1):
                rest = k + 1 + np.flatnonzero(groups_[k + 1 :] != groups_[k])
                rest = rest[(signed[rest] == signed[k]).mean(axis=1) >= LIKELY] if len(rest) else rest
                if members:
                    rest = rest[_first_band(signed[rest], signed[k], keys[k]) == bucket[0]]
                    asked[rest] = True
                    asked[k] |= len(rest) > 0
                elif len(rest):
                    a, b = np.minimum(rows[k], rows[rest]), np.maximum(rows[k], rows[rest])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            if members:
                count = int(asked.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, bucket[0])), pa.array(np.full(count, -1, np.int32)), pa.array(rows[asked])], names=["key", "choice", "node"]
                )

        for batch in batches:
            for *place, node, group, signed in zip(*[batch.column(c).to_pylist() for c in ("band", "low", "high", "node", "_group", "signature")]):
                if place != bucket:
                    yield from pairs()
                    bucket, held = place, []
                held.append((node, group, signed))
        yield from pairs()
        release_memory()

    keyed = nodes.select("node", "signature").mapInArrow(_bands, "node bigint, band bigint")
    keyed = written_table(attach(keyed, nodes.select("node", "_group"), ["node"], "inner", BROADCAST_BYTES, hot_rows=None), "bands")
    cut = F.ceil(F.col("n") / piece_nodes).cast("int")
    met = _several_groups(keyed, "band").withColumn("piece", F.pmod(F.xxhash64("node"), cut).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), cut - 1)))
    met = met.select("band", "node", "_group", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"))
    signed = attach(met, nodes.select("node", "signature"), ["node"], "inner", BROADCAST_BYTES, hot_rows=None)
    order = ["band", "low", "high"]
    kinds = "key bigint, choice int, node bigint" if members else "a bigint, b bigint"
    return signed.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(run, kinds).distinct()


def _first_band(signatures: np.ndarray, one: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The key of the first band in which each signature agrees with ``one``, whose keys are given; they agree in some."""
    return keys[(signatures == one).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)]


def _alike(one: np.ndarray, others: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which of the sets, none empty, are similar enough to ``one``."""
    sizes = np.array([len(s) for s in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    both = np.add.reduceat(one[at] == flat, np.cumsum(sizes) - sizes, dtype=np.int64)
    return both >= similarity * (len(one) + sizes - both) - 1e-9


def _joining(held: list[tuple], key: int, choice: int, apart: bool, masks: list[int], similarity: float) -> list[tuple[int, int]]:
    """Links between components, from all candidate pairs of one bucket; pairs that earlier ones connect are passed over.

    ``held`` has ``node _group piece print signature hashes`` of each node; ``apart`` asks for pairs of different pieces.
    """
    groups_, pieces_, prints = (np.array([h[k] for h in held], np.int64) for k in (1, 2, 3))
    prints = prints.view(np.uint64)
    signed = np.frombuffer(b"".join(h[4] for h in held), np.uint32).reshape(len(held), -1)
    sets = [np.frombuffer(h[5], np.uint64) for h in held]
    sizes = np.array([len(s) for s in sets])
    keys = _band_keys(signed) if choice < 0 else None
    above: dict[int, int] = {}
    links = []

    def top(group: int) -> int:
        while (up := above.get(group, group)) != group:
            above[group] = above.get(up, up)
            group = up
        return group

    for k in range(len(held) - 1):
        rest = k + 1 + np.flatnonzero(groups_[k + 1 :] != groups_[k])
        rest = rest[pieces_[rest] != pieces_[k]] if apart else rest
        near = np.bitwise_count(prints[rest] ^ prints[k]) <= RADIUS
        if choice < 0:  # close prints meet in a shard
            rest = rest[~near]
            rest = rest[(signed[rest] == signed[k]).mean(axis=1) >= LIKELY] if len(rest) else rest
            rest = rest[_first_band(signed[rest], signed[k], keys[k]) == key]
        else:
            rest = rest[near]
            rest = rest[_first_shard(prints[rest], np.broadcast_to(prints[k], len(rest)), masks) == choice]
        least, most = np.minimum(sizes[rest], sizes[k]), np.maximum(sizes[rest], sizes[k])
        rest = rest[least >= similarity * most - 1e-9]
        while len(rest):
            rest = rest[[top(g) != top(groups_[k]) for g in groups_[rest].tolist()]]
            upto = max(1, int(np.searchsorted(np.cumsum(sizes[rest]), SET_HASHES, side="right")))
            part, rest = rest[:upto], rest[upto:]
            for r in part[_alike(sets[k], [sets[r] for r in part], similarity)].tolist() if len(part) else []:
                one, two = sorted((top(int(groups_[k])), top(int(groups_[r]))))
                if one != two:
                    above[two] = one
                    links.append((one, two))
    return links


def group_links(
    docs: DataFrame, nodes: DataFrame, grouped: DataFrame, similarity: float = SIMILARITY, piece_nodes: int = PIECE_SETS
) -> DataFrame:
    """Links ``a``, ``b`` of components that have similar nodes which share a shard or a band, as far as they join some.

    ``grouped`` has ``node print signature _group``.  The members of a large shard or band meet in pieces, two by two.
    """
    masks = _masks(RADIUS, BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []

        def found() -> pa.RecordBatch:
            links = _joining(held, place[0], place[1], place[2] != place[3], masks, similarity) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        names = ["key", "choice", "low", "high", "node", "_group", "piece", "print", "signature", "hashes"]
        for batch in pieces(batches, "hashes"):
            for row in zip(*[batch.column(c).to_pylist() for c in names]):
                if row[:4] != place:
                    yield found()
                    place, held = row[:4], []
                held.append(row[4:])
        yield found()

    members = band_pairs(grouped, members=True).unionByName(print_pairs(grouped, members=True))
    members = written_table(members, "members-left")
    sets = sets_of(docs, nodes, members.select("node"))
    cut = members.groupBy("key", "choice").agg(F.ceil(F.count(F.lit(1)) / piece_nodes).cast("int").alias("pieces"))
    met = attach(members, written_table(cut, "member-pieces"), ["key", "choice"], "inner", hot_rows=None)
    met = met.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    met = met.select("key", "choice", "node", "piece", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"))
    met = attach(met, grouped.select("node", "_group", "print", "signature"), ["node"], "inner", BROADCAST_BYTES, hot_rows=None)
    met = attach(met, sets, ["node"], "inner", BROADCAST_BYTES, hot_rows=None)
    order = ["key", "choice", "low", "high"]
    return met.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(run, "a bigint, b bigint").distinct()


def _similar(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "first"):
        keep = []
        for one, two in zip(batch.column("first").to_pylist(), batch.column("second").to_pylist()):
            a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
        chosen = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])


def sets_of(docs: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """``node hashes`` of the nodes asked for, stored; sets are made again, of one text per node."""
    asked = written_table(asked.distinct(), "asked")
    wanted = written_table(attach(nodes.select("node", "content", "digest"), asked, ["node"], "left_semi", hot_rows=None), "wanted")
    texts = docs.select(F.col("text"), F.xxhash64("text").alias("digest"))
    chosen = attach(texts, wanted.select("digest").distinct(), ["digest"], "left_semi").select("text")
    sets = chosen.mapInArrow(_sets, "content binary, hashes binary").groupBy("content").agg(F.first("hashes").alias("hashes"))
    return written_table(wanted.select("node", "content").join(sets, "content").select("node", "hashes"), "sets")


def checked_links(docs: DataFrame, nodes: DataFrame, candidates: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The candidates whose shingle sets are similar enough."""
    candidates = written_table(candidates, "candidates")
    sets = sets_of(docs, nodes, candidates.select(F.col("a").alias("node")).union(candidates.select("b")))
    pairs = attach(candidates, sets.select(F.col("node").alias("a"), F.col("hashes").alias("first")), ["a"], "inner", BROADCAST_BYTES)
    pairs = attach(pairs, sets.select(F.col("node").alias("b"), F.col("hashes").alias("second")), ["b"], "inner", BROADCAST_BYTES)
    return pairs.mapInArrow(lambda b: _similar(b, similarity), "a bigint, b bigint")


def groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id digest _group`` of every row of ``docs`` (``doc_id``, ``text``): rows of one group are near-duplicates."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    kinds = "doc_id bigint, digest bigint, content binary, print bigint, signature binary"
    signed = written_table(rows.mapInArrow(_signed, kinds), "signed")
    distinct = signed.groupBy("content").agg(F.first("print").alias("print"), F.first("signature").alias("signature"), F.min("digest").alias("digest"))
    nodes = written_table(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    nothing = hashlib.blake2b(b"", digest_size=16).digest()
    full = nodes.filter(F.col("content") != F.lit(nothing))  # no words: one node, with no other like it
    candidates = written_table(band_links(full).union(print_links(full)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    links = written_table(checked_links(docs, nodes, candidates, similarity), "links")
    linked = components(links)
    grouped = full.join(linked, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    grouped = written_table(grouped.select("node", "print", "signature", "_group"), "groups-so-far")
    more = written_table(group_links(docs, nodes, grouped, similarity), "group-links")
    if not more.isEmpty():
        joined = components(more).withColumnRenamed("node", "_group")
        grouped = attach(grouped.select("node", "_group"), joined, ["_group"]).select("node", F.coalesce("component", "_group").alias("_group"))
    placed = nodes.select("node", "content").join(grouped.select("node", "_group"), "node", "left")
    placed = written_table(placed.select("content", F.coalesce("_group", "node").alias("_group")), "node-groups")
    return attach(signed.select("doc_id", "digest", "content"), placed, ["content"], "inner").select("doc_id", "digest", "_group")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, unchanged, one for each group of near-duplicates: that of its smallest number.

    Rows without a number come after all others; of rows with equal numbers that of the smallest text digest stays, and
    of rows equal in number and text, one.  Null, empty and blank texts have no shingles and are one group.  Texts of
    fewer than five words are compared as wholes, very long ones with all their shingles.  Other columns pass through,
    whatever their names; an empty table gives no rows.
    """
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    with scratch(docs.sparkSession):
        return keep_one(docs, groups(named, similarity), doc_id, text)
