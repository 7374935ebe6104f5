"""Personal data: base spans and learning, against brute force."""

from __future__ import annotations

import hashlib
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import personal as P
from shelfcast.llm.queries import QUERIES

#: The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD = "4539 1488 0343 6467"


def check_digit(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    return {
        "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in span.split(".")),
        "card": 14 <= len(digits) <= 19 and check_digit(digits), "phone": 10 <= len(digits) <= 15,
    }[kind]


def plain(text):
    # without an at sign the first pattern finds nothing, but in a long word it would try every place against the rest
    return {
        k: [m.span() for m in re.finditer(p, text) if passes(k, m.group())] if k != "email" or "@" in text else []
        for k, p in PATTERNS.items()
    }


def digest(text):
    spans = sorted((a, k, b) for k, kind in enumerate(P.KINDS) for a, b in plain(text)[kind])
    return hashlib.sha256(",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.@+-() aé\n%_", max_size=60))
def test_base_spans_are_the_patterns(text):
    assert P.base_spans(text) == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([CARD, "10.0.0.1", "300.1.1.1", "a.b@c.de", "+1 (528) 555-3435", " ", "-", ".", "+", "4", "@", "x y"]), max_size=12))
def test_base_spans_of_joined_parts(parts):
    assert P.base_spans("".join(parts)) == plain("".join(parts))


def test_candidates_overlap_no_base_span():
    base, more = P.candidates("write to ann (at) mail (dot) com or call (030) 123 45 67, not +49 30 1234567 or 10.0.0.1")
    assert {k for k, _, _ in more} == {"email", "phone"} and base["phone"] and base["ip"]
    taken = [s for spans in base.values() for s in spans]
    assert all(b <= c or d <= a for _, a, b in more for c, d in taken)


def slow_em(patterns, rounds=50, prior=0.3):
    """The same estimate, candidate by candidate."""
    tables = [[list(lab.if_other), list(lab.if_personal)] for lab in P.LABELERS]
    votes = [[int(lab.vote(np.array([p]))[0]) for lab in P.LABELERS] for p in patterns]
    share, likely = prior, []
    for _ in range(rounds):
        likely = []
        for v in votes:
            odds = [1 - share, share]
            for k, x in enumerate(v):
                odds = [odds[c] * max(tables[k][c][x], 1e-9) for c in (0, 1)]
            likely.append(odds[1] / sum(odds))
        for k, lab in enumerate(P.LABELERS):
            for c in (0, 1):
                mass = [0.0] * 3
                for v, y in zip(votes, likely):
                    mass[v[k]] += y if c else 1 - y
                believed = (lab.if_other, lab.if_personal)[c]
                tables[k][c] = [(m + lab.weight * b) / (sum(mass) + lab.weight) for m, b in zip(mass, believed)]
        share = (sum(likely) + 10 * prior) / (len(likely) + 10)
    return share, likely


def test_reliabilities_are_those_of_single_candidates():
    patterns = [0b0011000110001011] * 30 + [0b0011000110010100] * 20 + [0b0011000110101011] * 4 + [0b0101000001000100] * 7
    distinct, counts = np.unique(patterns, return_counts=True)
    share, _, likely = P.reliabilities(distinct, counts.astype(float))
    slow_share, slow = slow_em(patterns)
    by = dict(zip(distinct.tolist(), likely))
    assert share == pytest.approx(slow_share, abs=1e-9)
    assert [by[p] for p in patterns] == pytest.approx(slow, abs=1e-9)


def test_logistic_fit_has_no_slope_left():
    rng = np.random.default_rng(1)
    patterns = np.unique(rng.integers(0, 1 << 16, 200))
    counts, likely = rng.integers(1, 50, len(patterns)).astype(float), rng.random(len(patterns))
    w = P.logistic(patterns, counts, likely)
    x = np.array([[p >> k & 1 for k in range(16)] + [1] for p in patterns], float)
    slope = x.T @ (counts * (likely - 1 / (1 + np.exp(-x @ w)))) - w
    assert np.abs(slope).max() < 1e-6


def corpus():
    texts = [f"prose {i} then {4539148803436467} and 16 digits {1000000000000001 + i} stand, tel. +1 (528) 555-{i:04}" for i in range(60)]
    return texts + ["two cards 4539148803436467 4539148803436467 here", "call (030) 123 45 678 now", "mail ann (at) mail (dot) com"]


def test_added_spans_are_likely_ones_and_masked(spark):
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id bigint, text string").repartition(4)
    model = P.learn(docs)
    found = {r["_row"]["doc_id"]: r for r in P.find(docs, model, mask=True).collect()}
    assert found[60]["n_card"] == 0 and found[60]["spans"] == "card:10:26,card:27:43"
    assert found[60]["masked"] == "two cards <CARD> <CARD> here"
    assert found[62]["spans"] == "email:5:28"
    # a number whose check digit is wrong stays as it is
    assert all("card" not in found[i]["spans"].split(",")[1] for i in range(60) if found[i]["n_card"] == 1)
    expected = P.fit({k: tuple(map(np.array, zip(*[(p, n) for (kind, p), n in sum((P.pattern_counts(t) for t in corpus()), Counter()).items() if kind == k]))) or
                      (np.empty(0, int), np.empty(0)) for k in P.KINDS})
    for kind in P.KINDS:
        assert model.weights[kind] == pytest.approx(expected.weights[kind], abs=1e-8)


def test_odd_rows(odd, odd_rows):
    found = P.find(odd, P.learn(odd))
    rows = [(r["_row"]["doc_id"], r["base_sha256"], r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]) for r in found.collect()]
    expected = [(r[0], digest(r[1] or ""), sum(map(len, plain(r[1] or "").values()))) for r in odd_rows]
    assert Counter(rows) == Counter(expected)


def test_empty_table(none):
    model = P.learn(none)
    assert P.find(none, model).count() == 0
    assert all(np.isfinite(model.weights[k]).all() for k in P.KINDS)


def test_long_texts_take_time_in_proportion():
    model = P.fit({})
    for part in ("x", "1", "1 ", "+1", "@", "a@", "1.", "(at) ", "12-", "a:", "+1 ", "0.0.0.0 ", "ann at b dot c "):
        start = time.time()
        P.all_spans(part * (200_000 // len(part)), model)
        assert time.time() - start < 5, part


def test_query_covers_all_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    found = QUERIES["op13_weakly_supervised_pii"](spark, small).collect()
    assert Counter((r["doc_id"], r["base_sha256"]) for r in found) == Counter((r["doc_id"], digest(r["text"] or "")) for r in docs)
    for r in found:
        assert sum(r[f"n_{k}"] for k in P.KINDS) <= len([s for s in r["spans"].split(",") if s])
