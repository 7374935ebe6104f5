"""Near-duplicate texts at a similarity of 0.8: against all pairs."""

from __future__ import annotations

import itertools
import random

import numpy as np

import corpus_pipeline
from shelfcast.llm import similar
from shelfcast.llm.workers import with_package


def sets_of(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    size = similar.SHINGLE
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def alike(a, b):
    return a == b or (bool(a | b) and 10 * len(a & b) >= 8 * len(a | b))


def all_pairs(texts):
    """Pairs of places whose texts are similar, by every pair that shares a shingle."""
    sets = [sets_of(t) for t in texts]
    by: dict = {}
    for k, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    pairs = {p for ks in by.values() for p in itertools.combinations(ks, 2)}
    empty = [k for k, s in enumerate(sets) if not s]
    return {(i, j) for i, j in pairs if alike(sets[i], sets[j])} | set(itertools.combinations(empty, 2))


def closed(count, pairs):
    """The smallest place that each is linked to."""
    label = list(range(count))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, j in pairs:
        a, b = top(i), top(j)
        label[max(a, b)] = min(a, b)
    return [top(k) for k in range(count)]


def grouped(frame):
    """``doc_id`` to group, for distinct numbers."""
    return {r["doc_id"]: r["_group"] for r in similar.groups(frame.select("doc_id", "text")).collect()}


def corpus():
    random.seed(11)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(60):
        base = random.choices(words, k=random.randrange(30, 300))
        texts.append(" ".join(base))
        for _ in range(random.randrange(6)):
            other = list(base)
            for _ in range(max(1, round(len(base) * random.choice([0.004, 0.01, 0.02, 0.03])))):
                other[random.randrange(len(other))] = random.choice(words)
            texts.append(" ".join(other))
    return texts + ["", " \n", "one two", "One TWO", "one three", None]


def test_groups_against_all_pairs(spark):
    with_package(spark)
    texts = corpus()
    found = grouped(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5))
    pairs = all_pairs(texts)
    met = sum(found[i] == found[j] for i, j in pairs)
    assert len(pairs) > 60 and met >= 0.97 * len(pairs)
    true = closed(len(texts), pairs)
    assert all(true[i] == true[j] for i, j in itertools.combinations(range(len(texts)), 2) if found[i] == found[j])


def test_a_large_bucket_is_taken_in_pieces(spark):
    with_package(spark)
    random.seed(3)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in range(0, 200, 2)] + ["other " * 40, "quite another text of a few words"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    signed = [(k, similar.signature(similar.shingles(t)).tobytes()) for k, t in enumerate(texts)]
    nodes = spark.createDataFrame([(k, bytearray(s)) for k, s in signed], "node bigint, signature binary")
    for piece in (7, 1000):
        links = [(r["a"], r["b"]) for r in similar.band_links(nodes, piece).collect()]
        assert set(closed(len(texts), links)[:100]) == {0}
        assert len(links) < 10 * len(texts) * similar.BANDS  # not all pairs of a bucket in every band
    found = grouped(frame)
    assert len({found[k] for k in range(100)}) == 1 and len(set(found.values())) == 3


def test_one_of_each_of_odd_rows(odd, odd_rows, none):
    kept = similar.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect()]
    texts = [r[1] for r in odd_rows]
    label = closed(len(texts), all_pairs(texts))
    expected = []
    for group in set(label):
        members = [odd_rows[k] for k in range(len(texts)) if label[k] == group]
        best = min((r[0] is None, r[0] or 0) for r in members)
        expected.append(None if best[0] else best[1])
    assert sorted(rows, key=repr) == sorted(rows, key=repr) and sorted((d for d, _ in rows), key=repr) == sorted(expected, key=repr)
    assert similar.one_of_each(none).count() == 0


def test_leaders_link_the_likeliest():
    one = np.arange(40, dtype=np.uint32)
    near, far = one.copy(), one + 1000
    near[:10] += 500
    a, b, leaders = similar.led(np.array([5, 7, 9, 11]), np.stack([one, near, far, near]))
    assert set(zip(a.tolist(), b.tolist())) == {(7, 5), (11, 5), (11, 7)} and leaders.tolist() == [5, 7, 9]


def test_stage_recall_on_the_documents(spark, small):
    with_package(spark)
    docs = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    texts = [r["text"] for r in rows]
    found = grouped(docs)
    pairs = all_pairs(texts)
    met = sum(found[rows[i]["doc_id"]] == found[rows[j]["doc_id"]] for i, j in pairs)
    assert met >= 0.95 * len(pairs)
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert len(kept) == len(set(found.values()))


def test_a_partner_behind_nearer_prints_is_a_candidate(spark):
    """Each node is linked to one print of a shard; the pairs left out are candidates unless they are connected already."""
    with_package(spark)
    signed = bytearray(np.arange(40, dtype=np.uint32).tobytes())
    prints = {0: 0b0, 1: 0b11, 2: 0b1, 3: 0b1, 4: 1 << 40 | 1 << 30 | 1 << 20 | 1 << 10 | 1}
    nodes = spark.createDataFrame([(n, p, signed) for n, p in prints.items()], "node bigint, print bigint, signature binary")
    first = {(min(r), max(r)) for r in similar.print_links(nodes).collect()}
    assert (0, 1) in first and (1, 2) not in first and (1, 3) not in first

    def left(groups):
        grouped = nodes.join(spark.createDataFrame(list(groups.items()), "node bigint, _group bigint"), "node")
        by_print = sorted(tuple(r) for r in similar.print_pairs(grouped).collect())
        for piece in (2, 1000):
            alike = sorted(tuple(r) for r in similar.band_pairs(grouped, piece).collect())
            assert alike == [p for p in itertools.combinations(range(5), 2) if groups[p[0]] != groups[p[1]]]
        return by_print

    near = [(a, b) for a, b in itertools.combinations(range(5), 2) if (prints[a] ^ prints[b]).bit_count() <= similar.RADIUS]
    assert left({n: n for n in prints}) == near
    assert left({0: 0, 1: 0, 2: 0, 3: 3, 4: 4}) == [p for p in near if p[1] > 2]
    assert left(dict.fromkeys(prints, 0)) == []


def test_pairs_left_are_compared_in_place(spark):
    """All candidate pairs of different components are checked, without a row for each."""
    with_package(spark)
    random.seed(5)
    words = [f"w{i}" for i in range(500)]
    base, texts = random.choices(words, k=120), []
    for k in range(40):  # close prints, some of them similar enough
        other = list(base)
        for at in random.sample(range(120), 1 + k % 9):
            other[at] = f"x{random.randrange(9)}"
        texts.append(" ".join(other))
    texts += [" ".join(random.choices(words, k=60)) for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kinds = "node bigint, content binary, print bigint, signature binary, _group bigint"
    made = []
    for k, text in enumerate(texts):
        found = similar.shingles(text)
        mark = np.uint64(similar.fingerprint(text, similar.SHINGLE)).view(np.int64)
        made.append((k, bytearray(similar.hashlib.blake2b(found.tobytes(), digest_size=16).digest()), int(mark), bytearray(similar.signature(found).tobytes()), k - k % 3))
    nodes = spark.createDataFrame(made, kinds).join(docs.selectExpr("doc_id AS node", "xxhash64(text) AS digest"), "node")
    grouped = nodes.select("node", "print", "signature", "_group")
    pairs = similar.band_pairs(grouped).union(similar.print_pairs(grouped)).distinct()
    true = [(r["a"], r["b"]) for r in similar.checked_links(docs, nodes, pairs).collect()]
    assert pairs.count() > 2 * len(texts) and len(true) > 10
    own = [(k, k - k % 3) for k in range(len(texts))]
    for piece in (3, 1000):
        links = [(r["a"], r["b"]) for r in similar.group_links(docs, nodes, grouped, piece_nodes=piece).collect()]
        assert closed(len(texts), own + links) == closed(len(texts), own + true)
    assert len(links) < pairs.count() / 2
    members = similar.print_pairs(grouped, members=True).collect()
    near = {k for r in similar.print_pairs(grouped).collect() for k in (r["a"], r["b"])}
    assert {r["node"] for r in members} == near


def test_only_what_the_result_reads_is_left(spark, odd):
    import os

    from shelfcast.shared import shared_folder
    from shelfcast.llm import token_files

    root = f"{shared_folder(spark)}/shelfcast/{spark.sparkContext.applicationId}".removeprefix("file:")
    before = set(os.listdir(root)) if os.path.exists(root) else set()
    kept = similar.one_of_each(odd)
    assert {x.split("-")[0] for x in set(os.listdir(root)) - before} == {"marks"} and kept.count() > 0
    files = token_files.TokenFiles.write(odd)
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before} == {"marks", "token-files"} and files.read().count() == odd.count()
