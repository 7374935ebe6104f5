"""Quality rules and mixing: against plain Python, on odd rows, and in the shape of their plans."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from shelfcast.llm import mixing, quality_rules
from shelfcast.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    hit = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    failed = n < 20 or 100 * len(hit) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def test_counts_on_odd_rows(odd, odd_rows):
    got = quality_rules.judge(odd).select("_row.doc_id", "_row.text", "_row.key", "_rules.*").collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)
        assert r.key == "C" and not (r.base_failed and r.kept)
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_counts_on_documents(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    frame = QUERIES["op9_distribution_rules"](spark, small)
    assert not re.search("Python|Arrow|Pandas", plan_of(frame))
    for r in frame.collect():
        assert tuple(r)[1:7] == base(texts[r.doc_id])


def test_verdict_keeps_good_and_drops_bad(spark, small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = defaultdict(list)
    for r in QUERIES["op9_distribution_rules"](spark, small).filter("NOT base_failed").collect():
        kept[labels.get(r.doc_id)].append(r.kept)
    assert all(kept[1]) and sum(kept[0]) < len(kept[0])


def plain_russian(seed: int, n: int = 220) -> str:
    rng = random.Random(seed)
    common = ["и", "в", "не", "на", "что", "он"]
    other = ["".join(rng.choice("абвгдежзиклмнопрстуфхцчшыэюя") for _ in range(rng.randint(4, 9))) for _ in range(n)]
    words = [rng.choice(common) if rng.random() < 0.3 else w for w in other]
    return ". ".join(" ".join(words[i : i + 11]).capitalize() for i in range(0, n, 11)) + "."


def test_clean_documents_of_other_languages_stay(spark, small):
    """Languages without fixed words, other codes of the four, and no language at all."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    russian = [(10**6 + i, plain_russian(i), "ru") for i in range(12)]
    marks = (2 * 10**6, " ".join("#" * (3 + i % 7) + "=" * (i % 5) for i in range(99)) + " " + " ".join(f"@{i}+" for i in range(99)), "ru")
    unknown = (3 * 10**6, plain_russian(99), None)
    frame = spark.createDataFrame([*map(tuple, docs), *russian, marks, unknown], "doc_id bigint, text string, lang string")
    kept = {r[0]: r[1] for r in quality_rules.judge(frame).select("_row.doc_id", "_rules.kept").collect()}
    assert all(kept[r[0]] for r in [*russian, unknown]) and not kept[marks[0]]
    before = {r.doc_id: r.kept for r in QUERIES["op9_distribution_rules"](spark, small).collect()}
    assert {i: kept[i] for i in before} == before
    assert quality_rules.keep_good(frame).count() == sum(kept.values())
    # the same documents under codes that the rules do not know: each language is its own reference
    coded = spark.createDataFrame([(r.doc_id, r.text, r.lang + "-X") for r in docs], "doc_id bigint, text string, lang string")
    again = {r[0]: r[1] for r in quality_rules.judge(coded).select("_row.doc_id", "_rules.kept").collect()}
    assert all(again[i] for i in before if before[i]) and not all(again.values())


def test_distance_is_jensen_shannon(spark):
    frame = spark.createDataFrame([([1, 0, 3],), ([0, 0, 0],), ([2, 1, 1],)], "c array<bigint>")
    from pyspark.sql import functions as F

    column = quality_rules.jensen_shannon(F.col("c"), F.aggregate("c", F.lit(0).cast("long"), lambda a, n: a + n), [2, 1, 1])
    got = [r[0] for r in frame.select(column).collect()]
    p, q = [0.25, 0.0, 0.75], [0.5, 0.25, 0.25]
    kl = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    assert got[0] == pytest.approx(math.sqrt((kl(p, q) + kl(q, p)) / 2))
    assert got[1] == 1.0 and got[2] == pytest.approx(0.0, abs=1e-7)


def test_rules_on_nothing(none):
    assert quality_rules.judge(none).count() == 0
    assert quality_rules.keep_good(none).columns == none.columns


def wanted(sizes: dict) -> dict:
    """Targets by source as the contract says, excess handed on until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, held = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in held]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return held | share
        held |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)


def check_mix(rows, sources):
    sizes, taken = Counter(), Counter()
    for r, s in zip(rows, sources):
        sizes[s] += r.size
        taken[s] += r.taken
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size
    targets = wanted(dict(sizes))
    for r, s in zip(rows, sources):
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
    return sizes, taken, targets


def test_mix_of_documents(spark, small):
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    frame = QUERIES["op10_hypergeometric_mix"](spark, small)
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan_of(frame))
    rows = sorted(frame.collect())
    assert rows == sorted(QUERIES["op10_hypergeometric_mix"](spark, small).collect())
    sizes, taken, targets = check_mix(rows, [source[r.doc_id] for r in rows])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(r.size for r in rows if source[r.doc_id] == s)


def test_mix_on_odd_rows(odd, odd_rows, none):
    docs = odd.select("doc_id", "text", "source", "key")
    rows = mixing.mixed_sizes(docs).collect()
    assert len(rows) == len(odd_rows)
    assert sum(r.size for r in rows) == sum(len(WORD.findall(t or "")) for _, t, _, _ in odd_rows)
    assert mixing.mixed_sizes(none).count() == 0 and mixing.mixed(none).columns == none.columns
    assert mixing.mixed(odd).columns == odd.columns
    drawn = sum(len(WORD.findall(r.text or "")) for r in mixing.mixed(odd).collect())
    assert drawn == sum(r.taken for r in rows)


def test_shards_take_exact_quotas(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 10), (None, 333)], "source string, draws bigint")
    mix = mixing.Mix(shards=6)
    rows = mixing.split_quotas(quotas, mix).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        by_source[r.source] += r.draws
        by_shard[r.shard] += r.draws
    assert by_source == {"a": 1000, "b": 10, None: 333} and len(by_shard) == 6
    assert max(by_shard.values()) - min(by_shard.values()) <= 3


@pytest.mark.parametrize(("total", "good", "drawn"), [(50, 20, 10), (1000, 3, 500), (10, 10, 4), (400_000, 120_000, 90_000)])
def test_hypergeometric_law(spark, total, good, drawn):
    from pyspark.sql import functions as F

    args = [F.lit(v).cast("long") for v in (total, good, drawn)]
    draws = [r[0] for r in spark.range(1, 400).select(mixing.hypergeometric(*args, F.col("id") / 400)).collect()]
    mean, var = drawn * good / total, drawn * good / total * (1 - good / total) * (total - drawn) / (total - 1)
    assert draws == sorted(draws) and abs(sum(draws) / len(draws) - mean) <= 0.06 * math.sqrt(var) + 0.01
    assert all(max(0, drawn + good - total) <= d <= min(good, drawn) for d in draws)
