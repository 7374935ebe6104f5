"""Near and exact repeats and contamination, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from check import rows_of
from shelfcast.llm import anchors, automata, decontaminate, simhash, suffixes
from shelfcast.llm.queries import ORACLES, QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, name):
    oracle = duckdb.connect()
    for table in ("documents", "benchmark"):
        oracle.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')")
    frame, result = QUERIES[name](spark, small), oracle.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of([tuple(r) for r in frame.collect()], frame.columns) == rows_of(result.fetchall(), names)


# SimHash


def bits_of(text):
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints):
    parent = list(range(len(prints)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return [top(k) for k in range(len(prints))]


def test_near_duplicates_of_documents(spark, small):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    prints = [bits_of(t) for _, t in docs]
    wanted = [(d, f"{p:016x}", docs[c][0]) for (d, _), p, c in zip(docs, prints, components_of(prints))]
    assert sorted(map(tuple, QUERIES["op6_bk_tree_simhash"](spark, small).collect())) == wanted


def test_near_duplicates_of_odd_rows(odd, odd_rows, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert {r.component_id for r in rows if r.fingerprint == f"{bits_of(odd_rows[4][1]):016x}"} == {5}
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert len({r.component_id for r in rows}) == kept.count()
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000))
def test_forest_finds_all_within_the_radius(seed):
    draw = random.Random(seed)
    seeds = [draw.getrandbits(64) for _ in range(8)]
    prints = list({s ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(7))) & (1 << 64) - 1 for s in seeds for _ in range(9)})
    shards = np.array([p % 3 for p in prints])
    forest = simhash.BKForest(shards, np.array(prints, np.uint64))
    got = {(int(a), int(b)) for x, y in forest.within(np.arange(len(prints)), 4) for a, b in zip(x, y)}
    wanted = {
        (a, b) for a in range(len(prints)) for b in range(a) if shards[a] == shards[b] and (prints[a] ^ prints[b]).bit_count() <= 4
    }
    assert got == wanted


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_links_across_shards_connect_everything(spark, blocks):
    draw = random.Random(blocks)
    prints = []
    for _ in range(30):
        one = draw.getrandbits(64)
        for _ in range(6):
            prints.append(one)
            one ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 4, 4, 5])))
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p, k) for k, p in enumerate(prints)]
    frame = spark.createDataFrame(signed, "_print bigint, node bigint")
    found = dict(map(tuple, simhash.components(simhash.near_links(frame, blocks=blocks)).collect()))
    assert [found.get(k, k) for k in range(len(prints))] == components_of(prints)


# substring windows of words


def removed_words(docs, window=50):
    first = {}
    lists = [(d, WORD.findall((t or "").encode())) for d, t in docs]
    for d, words in lists:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, words in lists:
        hit = set()
        for i in range(len(words) - window + 1):
            if d is not None and first[tuple(words[i : i + window])] < d:
                hit.update(range(i, i + window))
        line = b" ".join(w for k, w in enumerate(words) if k not in hit)
        out.append((d, len(words), len(hit), hashlib.sha256(line).hexdigest()))
    return out


def by_number(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_word_windows_of_odd_rows(odd, odd_rows, none):
    got = automata.without_repeats(odd)
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()]
    assert by_number(rows) == by_number(removed_words([r[:2] for r in odd_rows]))
    assert automata.without_repeats(none).count() == 0


def planted(seed, unit, n=60):
    """Documents with passages that repeat, whole and in part, beside each other and within one document."""
    draw = random.Random(seed)
    fresh = lambda k: [f"{unit}{draw.randrange(10**6)}" for _ in range(k)]
    passages = [fresh(draw.randrange(30, 140)) for _ in range(6)]
    docs = []
    for d in range(n):
        words = []
        for _ in range(draw.randrange(1, 4)):
            p = draw.choice(passages)
            a = draw.randrange(len(p) // 2)
            words += fresh(draw.randrange(40)) + p[a : draw.randrange(a, len(p)) + 1]
        docs.append((d, " ".join(words)))
    return docs + [(n, docs[3][1]), (n + 1, docs[4][1] + " more"), (n + 2, "same " * 300), (n + 3, "same " * 120), docs[5]]


@pytest.mark.parametrize(("seed", "crowded"), [(1, 20_000), (2, 2)])
def test_planted_word_windows(spark, seed, crowded, monkeypatch):
    monkeypatch.setattr(anchors, "CROWDED", crowded)
    docs = planted(seed, "w")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in automata.without_repeats(frame).collect()]
    assert sorted(rows) == sorted(removed_words(docs))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=30), min_size=1, max_size=6))
def test_automaton_knows_the_first_document(texts):
    machine = automata.SuffixAutomaton()
    for d, t in enumerate(texts):
        machine.add(list(t), 10 + d)
    machine.finish()
    for t in [*texts, "abcabc", "cab" * 5]:
        got = machine.first_documents(list(t), 3)
        wanted = [next((10 + d for d, x in enumerate(texts) if t[i : i + 3] in x), 1 << 62) for i in range(len(t) - 2)]
        assert got == wanted


# byte strings


def removed_bytes(texts, window):
    counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        cut = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if counts[t[i : i + window]] > 1:
                cut[i : i + window] = b"\1" * window
        left = bytes(b for b, c in zip(t, cut) if not c)
        out.append((len(t), sum(cut), len(re.findall(rb"\x01+", bytes(cut))), hashlib.sha256(left).hexdigest()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=5, max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6))
def test_two_stages_sort_all_windows(stretches):
    window = 5
    text, ends = b"".join(stretches), np.cumsum([len(s) for s in stretches])
    order = suffixes.two_stage_order(text, ends, ends - window, window)
    keys = [text[p : min(p + window, ends[np.searchsorted(ends, p, side="right")])] for p in order]
    assert keys == sorted(keys) and len(set(order)) == len(order)
    counts = Counter(s[i : i + window] for s in stretches for i in range(len(s) - window + 1))
    got = [x.tolist() for x in suffixes.repeated_windows(stretches, [1] * len(stretches), window)]
    assert got == [[counts[s[i : i + window]] > 1 for i in range(len(s) - window + 1)] for s in stretches]


def test_bytes_of_odd_rows(odd, odd_rows, none):
    rows = [tuple(r)[1:5] for r in suffixes.without_repeated_bytes(odd).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(rows) == sorted(removed_bytes([(r[1] or "").encode() for r in odd_rows], 400))
    assert suffixes.without_repeated_bytes(none).count() == 0


@pytest.mark.parametrize(("seed", "crowded"), [(3, 20_000), (4, 2)])
def test_planted_bytes(spark, seed, crowded, monkeypatch):
    monkeypatch.setattr(anchors, "CROWDED", crowded)
    docs = [(d, t[: random.Random(d).randrange(4000)]) for d, t in planted(seed, "é")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.without_repeated_bytes(frame).collect()}
    assert [rows[d] for d, _ in docs] == removed_bytes([t.encode() for _, t in docs], 400)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=80), st.integers(0, 5))
def test_equal_windows_have_equal_anchors(values, shift):
    base = np.array(values, np.uint64)
    other = np.concatenate([np.full(shift, 7, np.uint64), base])
    seen = defaultdict(set)
    for elements in (base, other):
        anchor, first, last = anchors.window_runs(elements, 11, 4)
        windows = [w for a, b in zip(first.tolist(), last.tolist()) for w in range(a, b + 1)]
        assert windows == list(range(max(0, len(elements) - 10)))
        for h, a, b in zip(anchor.tolist(), first.tolist(), last.tolist()):
            for w in range(a, b + 1):
                seen[elements[w : w + 11].tobytes()].add(h)
    assert all(len(s) == 1 for s in seen.values())


# contamination


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdx"), max_size=25), max_size=5), st.lists(st.lists(st.sampled_from("abcd"), max_size=6), max_size=4))
def test_index_finds_every_window(texts, items):
    phrases = decontaminate.Phrases.of([(k, " ".join(i)) for k, i in enumerate(items)], 4)
    counts, spans, found = decontaminate.find([" ".join(t) for t in texts], phrases)
    for t, n, s, f in zip(texts, counts, spans, found):
        hit, named = set(), set()
        for k, item in enumerate(items):
            size = min(4, len(item))
            for i in range(len(item) - size + 1 if item else 0):
                for j in range(len(t) - size + 1):
                    if t[j : j + size] == item[i : i + size]:
                        hit.update(range(j, j + size))
                        named.add(str(k))
        assert n == len(t) and named == f and {x for a, b in s for x in range(a, b)} == hit


def test_contamination_of_odd_rows(spark, odd, odd_rows, none):
    items = [(1, "WORD1 of1 the1"), (2, None), (3, ""), (10, "Word5 Of5 The5 word6 of6 the6 word7 of7 the0 word8 of8 the1 word9 of9 the2"), (None, "b")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    whole = decontaminate.contamination(odd, benchmark).select("_row.doc_id", "_row.text", "n_words", "n_hit", "items").collect()
    parts = decontaminate.contamination(odd, benchmark, block_bytes=1).select("_row.doc_id", "_row.text", "n_words", "n_hit", "items").collect()
    assert by_number([(r[0], r[1], r[2], r[3], str(r[4])) for r in whole]) == by_number([(r[0], r[1], r[2], r[3], str(r[4])) for r in parts])
    named = {(r.doc_id, r.text): r["items"] for r in whole}
    assert len(whole) == len(odd_rows) and named[(5, odd_rows[4][1])] == ["1", "10"] and named[(1, None)] == []
    assert decontaminate.contamination(odd, benchmark.limit(0)).filter("n_hit > 0 OR contaminated").count() == 0
    assert decontaminate.decontaminated(odd, benchmark).columns == odd.columns
    assert decontaminate.contamination(none, benchmark).count() == 0
