"""Token counts and token files against the library itself."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import token_counts, token_files, token_units
from shelfcast.llm.token_units import WordEncoder, vocabulary_path

ENCODER = WordEncoder(vocabulary_path())


def library(text):
    return ENCODER.library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab 'st\n\t\x1c\x85　éĠ1.<|endoftext|>", max_size=40), max_size=5))
def test_units_equal_the_library(texts):
    assert [x.tolist() for x in ENCODER.encode(texts)] == [library(t) for t in texts]


def test_a_full_cache_changes_nothing():
    small = WordEncoder(vocabulary_path(), cached=3)
    texts = [f"one w{i} w{i + 1} two <|endoftext|> x" if i % 5 == 0 else f"one w{i} two" for i in range(50)]
    small.words.most_waiting = 20
    for _ in range(3):
        assert [x.tolist() for x in small.encode(texts)] == [library(t) for t in texts]
        counts = small.encode_flat(pa.array(texts), ids=False)[1]
        assert counts.tolist() == [len(library(t)) for t in texts]
    assert len(small.words.kept) <= 3 and len(small.words.waiting) <= 20


def test_a_word_is_kept_at_its_second_sight():
    own = WordEncoder(vocabulary_path())
    own.encode(["a one two"])
    assert not own.words.kept
    own.encode(["a two. three"])
    assert set(own.words.kept) == {"two", "\x01a"}


def test_a_word_is_encoded_once(monkeypatch):
    own, asked = WordEncoder(vocabulary_path()), []
    encode = own._encode_words
    monkeypatch.setattr(own, "_encode_words", lambda words: asked.extend(words) or encode(words))
    for text in ("a one two", "a two. three", "one a two"):
        assert own.encode([text])[0].tolist() == library(text)
    assert sorted(asked) == sorted(set(asked))


def test_parts_are_looked_up_together(monkeypatch):
    own, looked_up = WordEncoder(vocabulary_path()), []
    look_up = own.words.look_up
    monkeypatch.setattr(own.words, "look_up", lambda words: looked_up.append(len(words)) or look_up(words))
    texts = [None, "", "one two", "two. Ünd ñandú", "two <|endoftext|> x", "a\t", "3 one's", None, "\x01 one", "日本 two"]
    parts = [pa.RecordBatch.from_pydict({"text": pa.array(texts[a : a + 2], pa.string())}) for a in range(0, len(texts), 2)]
    parts += [pa.RecordBatch.from_pydict({"text": pa.array(t, pa.string())}) for t in ([], [None], ["<|endoftext|>"])]
    found = list(own.encode_batches(iter(parts)))
    assert len(looked_up) == 1
    assert [b.column("text").to_pylist() for b, _, _ in found] == [p.column("text").to_pylist() for p in parts if p.num_rows]
    for batch, ids, counts in found:
        each = [library(t) for t in batch.column("text").to_pylist()]
        assert ids.tolist() == [i for one in each for i in one] and counts.tolist() == [len(one) for one in each]
    monkeypatch.setattr(token_units, "LOOKED_UP_TOGETHER", 1)
    again = [(ids.tolist(), counts.tolist()) for _, ids, counts in own.encode_batches(iter(parts))]
    assert again == [(ids.tolist(), counts.tolist()) for _, ids, counts in found]
    assert [c.tolist() for _, _, c in own.encode_batches(iter(parts), ids=False)] == [c for _, c in again]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abÉéßÿĀŉſƻɏ×÷ªºµıİʼn'7-Ġ日", min_size=1, max_size=8), max_size=6))
def test_words_of_letters_are_one_piece(words):
    texts = [*words, " ".join(words), ". ".join(words)]
    ENCODER.words.clear()
    assert [x.tolist() for x in ENCODER.encode(texts)] == [library(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["word", "Ünd", "3", ".", ",", ". ", ", ", "\n", " ", "'s", '"', "-", "\x01", "\xa0", "日", "\u2028", "x.y", "!"]), max_size=14), max_size=4))
def test_cuts_are_the_library_s(parts):
    texts = ["".join(p) for p in parts]
    assert [x.tolist() for x in ENCODER.encode(texts)] == [library(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), max_size=6))
def test_byte_codes_round_trip(rows):
    counts = np.array([len(r) for r in rows], np.int64)
    values = np.array([v for r in rows for v in r], np.uint32)
    controls, data = token_files.pack(values, counts)
    assert token_files.unpack(b"".join(controls), b"".join(data), counts).tolist() == values.tolist()
    assert [len(c) for c in controls] == [-(-len(r) // 4) for r in rows]


def check_files(rows, texts_by_doc):
    start = 0
    for r in rows:
        ids = library(texts_by_doc.pop(0)) + [token_files.END]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_files_of_odd_rows(odd, odd_rows, none):
    files = token_files.TokenFiles.write(odd, block_tokens=1000, rows_per_part=4)
    rows = sorted(files.read().collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in odd_rows), key=lambda d: (d is not None, d or 0))
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, len(library(r[1]))))
    check_files(rows, [r[1] for r in ordered])
    ids = {r.start: r.ids for r in files.read_ids().collect()}
    assert all(zlib.crc32(np.array(ids[r.start], "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert token_files.TokenFiles.write(none).read().count() == 0


def test_cache_is_filled_once(spark, odd, odd_rows, none):
    cache = token_counts.CountCache(spark)
    version = token_counts.tokenizer_version(vocabulary_path())
    for _ in range(2):
        rows = token_counts.count_tokens(odd, cache).select("_row.text", "n_bytes", "n_tokens", "over_limit").collect()
        assert len(rows) == len(odd_rows)
        for r in rows:
            n = len(library(r.text))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)
        assert cache.read(version).count() == spark.read.parquet(cache.folder).count() == len({r[1] or "" for r in odd_rows})
    assert cache.read("another version").count() == 0
    assert token_counts.count_tokens(none, cache).count() == 0


@pytest.mark.parametrize("name", ["op3_ranked_byte_codes", "op8_digest_cache_counts"])
def test_queries(spark, small, name):
    from shelfcast.llm.queries import QUERIES

    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    rows = sorted(QUERIES[name](spark, small).collect())
    if name.startswith("op3"):
        check_files(rows, [t for _, t in docs])
    else:
        assert [(r.doc_id, r.n_tokens) for r in rows] == [(d, len(library(t))) for d, t in docs]
