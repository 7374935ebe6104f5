"""Ranked lexical search and the Merkle manifest, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import lexical, manifest
from shelfcast.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def searched(docs, items, best=50):
    """Every item against every document."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for doc, c in counts:
            size = 50 + 50 * sum(c.values()) * n_docs // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * size))
                for t in wanted if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if empty else doc, -s) for k, (s, empty, doc) in enumerate(sorted(found)[:best])]
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_search_is_brute_force(spark, odd, odd_rows):
    items = [(1, "word3 of2 THE1"), (2, "text number other"), (2, "ÄÖ École"), (None, "tail b a"), (3, None), (4, "zzz"), (5, "  ,;"), (6, "the0 " * 500)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(r[0], r[1]) for r in odd_rows]
    for options in ({}, {"block_docs": 2}, {"shares": (0.2, 1.0)}, {"load_bytes": 100, "block_docs": 3}):
        assert rows_of(lexical.search(odd, benchmark, **options)) == searched(docs, items)
    few = rows_of(lexical.search(odd, benchmark, best=2, block_docs=1))
    assert few == searched(docs, items, 2)


def test_search_with_ties_many_items_and_copies(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(random.choices(words, k=random.randrange(12)))) for i in range(300)] + [(1000 + i, "w1 w2 w3") for i in range(120)]
    items = [(f"q{i}", " ".join(random.sample(words, 5))) for i in range(300)]
    found = lexical.search(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id string, text string"), block_docs=64
    )
    assert rows_of(found) == searched(docs, items)


def test_search_of_empty_tables(spark, odd, none):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "word")], "item_id bigint, text string")
    assert lexical.search(odd, empty).count() == 0
    assert lexical.search(none, one).count() == 0


def test_owners_take_rare_terms_first():
    import numpy as np

    assert lexical.owners(300, np.array([0, 1, 10, 11, 30, 31, 300]), (1 / 30, 1 / 10, 1.0)).tolist() == [0, 0, 0, 1, 1, 2, 2]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enter(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def proven(rows):
    """The manifest row by row; ``rows`` are doc_id, source, lang, n_chars, text."""
    def climb(nodes, place):
        way = []
        while len(nodes) > 1:
            run = place // 3 * 3
            way.append((nodes[run:place], nodes[place + 1 : run + 3]))
            nodes, place = [digest(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)], place // 3
        return way, nodes[0]

    trees: dict = {}
    for row in rows:
        text = row[4]
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        trees.setdefault(row[1], []).append((row[0], digest(*map(enter, row)), digest(*map(enter, (*row[:4], text)))))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for tree in trees.values():
        tree.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    subroots = [climb([r[1] for r in trees[s]], 0)[1] for s in order]
    out = []
    for k, source in enumerate(order):
        for place, (doc, leaf, altered) in enumerate(trees[source]):
            way = climb([r[1] for r in trees[source]], place)[0] + climb(subroots, k)[0]
            root = climb(subroots, 0)[1]
            proof = digest(*[h for before, after in way for h in before + after])
            at = altered
            for before, after in way:
                at = digest(*before, at, *after)
            out.append((doc, leaf, subroots[k], root, proof, at, at == root))
    return Counter(out)


def with_sizes(frame):
    return frame.withColumn("n_chars", F.length("text").cast("long"))


def test_manifest_of_odd_rows(odd, odd_rows):
    rows = [(r[0], r[3], r[2], None if r[1] is None else len(r[1]), r[1]) for r in odd_rows]
    found = manifest.verify(with_sizes(odd))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows_of(found) == proven(rows)


@pytest.mark.parametrize("sizes", [(1,), (3,), (4, 1), (9, 10, 27, 28), (243, 244), (730,)])
def test_manifest_of_many_shapes(spark, sizes):
    rows = [
        (k * 10_000 + i, None if k == 1 else f"s{k}", "en", i, f"line {i}\nend" if i % 3 else None)
        for k, n in enumerate(sizes) for i in range(n)
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    assert rows_of(manifest.verify(frame)) == proven(rows)


def test_manifest_nodes_are_nested_intervals(spark):
    rows = [(i, "a" if i < 300 else "b", "en", 1, "x") for i in range(301)]
    built = manifest.build(spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string"))
    nodes = built.nodes().collect()
    by_level = Counter((r["tree"], r["level"]) for r in nodes)
    assert [by_level["sa", k] for k in range(7)] == [300, 100, 34, 12, 4, 2, 1]
    assert by_level["sb", 0] == 1 and by_level["sb", 1] == 0 and by_level[None, 0] == 2 and by_level[None, 1] == 1
    parts = sorted((r["lo"], r["hi"]) for r in nodes if r["tree"] == "sa" and r["level"] == 5)
    assert parts == [(0, 243), (243, 300)]
    assert [r["digest"] for r in nodes if r["tree"] is None and r["level"] == 1] == [built.root]


def test_manifest_of_an_empty_table(none):
    assert manifest.verify(with_sizes(none)).count() == 0
    assert manifest.build(with_sizes(none)).root is None


def test_queries_run_over_all_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    found = QUERIES["op11_pipelined_lexical_search"](spark, small)
    assert rows_of(found) == searched([(r["doc_id"], r["text"]) for r in docs], [(r["item_id"], r["text"]) for r in items])
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs]
    assert rows_of(QUERIES["op12_interval_manifest"](spark, small)) == proven(rows)
