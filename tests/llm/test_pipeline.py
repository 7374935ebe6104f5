"""The pipeline: what each stage does to its input, and the whole."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entries
import corpus_pipeline
from shelfcast.llm import mixing
from shelfcast.llm.workers import with_package
from shelfcast.shared import written_table


def test_stages_take_effect(spark, small):
    with_package(spark)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {tuple(r) for r in docs.collect()}
        docs = stage(spark, docs, small)
        rows = [tuple(r) for r in docs.collect()]
        assert docs.columns == columns and set(rows) <= before
        docs = spark.createDataFrame(rows, docs.schema)
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert sorted(r.doc_id for r in last) == sorted(r[0] for r in rows)


def test_whole_run(spark, small):
    rows = entries.queries()["pipeline"](spark, small).collect()
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_token_files_follow_the_mix(spark, small):
    with_package(spark)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    mixed = written_table(corpus_pipeline.mix(spark, docs, small), "mix")
    place = F.struct(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int"), "_metadata.row_index")
    order = [r["doc_id"] for r in mixed.select("doc_id", place.alias("at")).orderBy("at").collect()]
    rows = sorted(corpus_pipeline.token_output(spark, mixed, small).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == order != sorted(order)


def test_shards_grow_with_the_words():
    assert mixing.shards_for(1000, mixing.Mix()) == 32
    assert mixing.shards_for(400 * mixing.SHARD_WORDS, mixing.Mix()) == 600


def test_odd_rows_pass_all_stages(spark, odd, small):
    docs = odd.select("doc_id", "text", "lang", "source", "_row", "_text", "key", "kept", "n_words")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written_table(stage(spark, docs, small), name)
        if name != "token_output":
            assert docs.columns == before.columns
            assert docs.exceptAll(before.union(before) if name == "mixing" else before).count() == 0
        if name == "quality_rules":  # those without words and those of one word over and over go
            assert {r[0] for r in docs.select("doc_id").collect()} == {5, 6, 8, None}
        if name == "near_duplicates":  # the copies and near copies of one text are one
            assert [r[0] for r in docs.select("doc_id").collect()] == [5]
    assert docs.columns[:3] == ["doc_id", "start", "n_tokens"]


def test_stages_on_nothing(none, small, spark):
    docs = none.select("doc_id", "text", "lang", "source")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, none.select("doc_id", "text", "lang", "source"), small)
        assert docs.count() == 0
