"""Language and quality models: held-out accuracy, and odd rows."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import language, quality_model
from shelfcast.llm.queries import QUERIES


def test_language_held_out(spark, small):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op5_ngram_language"](spark, small).collect()
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_of_odd_rows(spark, odd, odd_rows, none):
    model = language.train(odd)
    rows = language.predict(odd, model).select("_row.text", "lang_pred", "score").collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    empty = language.train(none)
    assert {r.lang_pred for r in language.predict(odd, empty).collect()} == {"und"}
    assert language.predict(none, model).count() == 0


def test_batches_do_not_change_scores():
    texts = ["Das ist der Text", "a", "", "z" * 50, "the quick brown fox"] * 30
    model = language.LanguageModel(["a", "b"], np.log(np.random.default_rng(1).random((2, language.BUCKETS))).astype(np.float32), np.zeros(2))
    together = language.score(texts, model)
    alone = [language.score([t], model) for t in texts]
    assert together[0] == [a[0][0] for a in alone] and np.allclose(together[1], [a[1][0] for a in alone])


def test_quality_held_out(spark, small):
    small = small.replace("sf0.001", "sf0.01")  # the smallest table has 19 held-out labels only
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = QUERIES["op4_pairwise_quality"](spark, small).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def test_quality_of_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(5, 1), (9, 0), (4, 0), (6, 1), (None, 1), (99, 0), (7, None), (5, 1)], "doc_id bigint, quality int")
    model = quality_model.learn(odd, labels)
    rows = quality_model.predict(odd, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    without = quality_model.learn(none, labels)
    assert {round(r.score, 9) for r in quality_model.predict(odd, without).collect()} == {0.3}
    assert quality_model.predict(none, model).count() == 0
    assert quality_model.learn(odd, labels.filter(F.lit(False))).weights.tolist() == [0.0] * quality_model.FEATURES


def test_pairs_order_the_scores():
    draw = np.random.default_rng(5)
    good, bad = draw.normal(1, 1, (300, quality_model.FEATURES)), draw.normal(0, 1, (60, quality_model.FEATURES))
    model = quality_model.train(good, bad, 1 / 6, quality_model.Training())
    scores = np.concatenate([model.score(good), model.score(bad)])
    assert abs((scores < model.cut).mean() - 1 / 6) < 0.02
    assert model.score(good).mean() > model.score(bad).mean() + 0.3


def plain_bayes(labelled, texts, smoothing=language.SMOOTHING):
    """Multinomial naive Bayes over the same hashed 3-grams, text by text."""
    def grams(text):
        buckets = np.zeros(language.BUCKETS)
        for b in language.ngrams([text])[0].tolist():
            buckets[b] += 1
        return buckets

    sums, documents = {}, {}
    for lang, text in labelled:
        if lang is not None and text is not None:
            sums[lang] = sums.get(lang, 0) + grams(text)
            documents[lang] = documents.get(lang, 0) + 1
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        counts = grams(text)
        joint = {}
        for lang, n in sums.items():
            chance = np.log((n + smoothing) / (n + smoothing).sum()).astype(np.float32)
            joint[lang] = float((counts * chance).sum()) + np.log(documents[lang] / sum(documents.values()))
        best = max(sorted(joint), key=lambda x: joint[x])
        out.append((best, 1 / sum(np.exp(v - joint[best]) for v in joint.values())))
    return out


def test_language_is_plain_naive_bayes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").limit(80)
    rows = docs.collect()
    expected = plain_bayes([(r["lang"], r["text"]) for r in rows[:50]], [r["text"] for r in rows])
    labelled = spark.createDataFrame(rows[:50], docs.schema)
    model = language.train(labelled)
    for block in (1024, 2):
        model.block = block
        found = {r["_row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(spark.createDataFrame(rows, docs.schema), model).collect()}
        for r, (lang, score) in zip(rows, expected):
            assert found[r["doc_id"]][0] == lang and abs(found[r["doc_id"]][1] - score) < 1e-3


def test_more_languages_than_a_block_holds(spark):
    texts = [(i, f"l{i:04}", f"{chr(0x4E00 + i)}{chr(0x5E00 + i)}{chr(0x6E00 + i)} " * 5) for i in range(40)]
    frame = spark.createDataFrame(texts, "doc_id bigint, lang string, text string")
    model = language.train(frame)
    model.block = 7
    assert sum(len(b.languages) for b in model.blocks()) == 40
    assert all(r["_row"]["lang"] == r["lang_pred"] for r in language.predict(frame, model).collect())


def test_quality_is_the_minimum_of_the_pairs_loss(spark, odd):
    """The weights against plain gradient descent over the same pairs."""
    draw = np.random.default_rng(2)
    good, bad = draw.normal(0.5, 1, (80, quality_model.FEATURES)), draw.normal(0, 1, (50, quality_model.FEATURES))
    how = quality_model.Training(pairs=2000, penalty=0.05)
    model = quality_model.train(good, bad, 0.4, how)
    both = np.concatenate([good, bad])
    center, scale = both.mean(axis=0), both.std(axis=0)
    pick = np.random.default_rng(how.seed)
    first = pick.integers(len(good), size=how.pairs)
    pairs = ((good - center) / scale)[first] - ((bad - center) / scale)[pick.integers(len(bad), size=how.pairs)]
    weights = np.zeros(quality_model.FEATURES)
    for _ in range(4000):
        weights += 0.5 * (pairs.T @ (1 / (1 + np.exp(pairs @ weights))) / len(pairs) - how.penalty * weights)
    assert np.allclose(weights, model.weights, atol=1e-4)
    scores = np.concatenate([(x - center) / scale @ weights for x in (good, bad)])
    assert np.allclose(model.score(both), 1 / (1 + np.exp(-(scores - model.threshold + np.log(0.3 / 0.7)))), atol=1e-3)
