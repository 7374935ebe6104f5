from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import joins
from shelfcast.operators.joins import (
    attach, drop_existing, fits_broadcast, hot_keys, measured_bytes, referenced_rows, stack_rows, update_columns,
)
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under key 7, copies among them, and some null keys."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") % 5).alias("v"),
    )


@pytest.fixture(scope="module")
def dimension(spark):
    values = [(k, f"name {k}") for k in range(30)] + [(7, "second seven"), (None, "nobody")]
    return spark.createDataFrame(values, "k bigint, name string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("limits", [{"hot_rows": 20}, {"hot_rows": 1_000_000}, {"hot_rows": None}])
def test_every_strategy_gives_the_plain_join(skewed, dimension, how, limits):
    plain = skewed.join(dimension, "k", how)
    assert rows(attach(skewed, dimension, ["k"], how, broadcast_bytes=0, **limits), *plain.columns) == rows(plain)
    assert rows(attach(skewed, dimension, ["k"], how), *plain.columns) == rows(plain)


def test_hot_keys_are_found_and_cut(skewed):
    hot, nulls_hot = hot_keys(skewed, ["k"], 500)
    assert rows(hot) == [(7, 3)] and not nulls_hot
    assert hot_keys(skewed, ["k"], 10_000) == (None, False)
    assert hot_keys(skewed, ["k"], 10)[1]


def test_hot_keys_are_spread_over_tasks(skewed, dimension):
    spark = skewed.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach(skewed, dimension, ["k"], broadcast_bytes=0, hot_rows=100)
        places = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(places) > 2 and max(r["count"] for r in places) < sum(r["count"] for r in places) * 0.7


def test_extra_condition_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, place string")
    right = spark.createDataFrame([(1, "a", 10), (2, "z", 20)], "k int, where string, n int")
    for limits in ({}, {"broadcast_bytes": 0, "hot_rows": 1}):
        found = attach(left, right, ["k"], also=F.col("place") == F.col("where"), **limits)
        assert rows(found, "k", "place", "n") == [(1, "a", 10), (1, "b", None), (2, "a", None)]


def test_other_joins_are_refused(skewed, dimension):
    with pytest.raises(ValueError):
        attach(skewed, dimension, ["k"], "full")


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int")
    assert measured_bytes(df) == 2 * (16 + 4) + 3
    assert measured_bytes(df.filter("n > 5")) == 0
    assert fits_broadcast(df, 43) and not fits_broadcast(df, 42)
    assert not fits_broadcast(df.select(F.array("n").alias("a")))


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_drop_existing(skewed, dimension, limit):
    expected = skewed.join(dimension, skewed["k"].eqNullSafe(dimension["k"]), "left_anti")  # a null key is a key
    assert rows(drop_existing(skewed, dimension, ["k"], broadcast_bytes=limit)) == rows(expected)


def test_referenced_rows_per_column_or_combination(spark):
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3)], "a int, b int")
    facts = spark.createDataFrame([(1, 2), (2, 1), (1, 2)], "x int, y int")
    assert rows(referenced_rows(pairs, facts, {"a": "x", "b": "y"})) == [(1, 1), (1, 2), (2, 1)]
    assert rows(referenced_rows(pairs, facts, {"a": "x", "b": "y"}, tuple_match=True)) == [(1, 2), (2, 1)]


def test_update_sets_nulls_and_never_inserts(spark):
    target = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, "z", None)], "a int, b string, v double")
    values = spark.createDataFrame([(1, "x", None), (3, "z", 9.0), (4, "q", 4.0)], "a int, b string, v double")
    assert rows(update_columns(target, values, ["a", "b"], ["v"])) == [(1, "x", None), (2, "y", 2.0), (3, "z", 9.0)]
    with pytest.raises(ValueError):
        update_columns(target, stack_rows(values, values), ["a", "b"], ["v"])


def test_limits_are_sane():
    assert joins.BROADCAST_BYTES <= 1 << 27 and joins.HOT_ROWS >= 1_000_000


def test_a_large_batch_meets_stored_keys_by_keys_alone(spark, monkeypatch):
    from shelfcast.operators import joins

    made = {}
    own = joins.written_table
    monkeypatch.setattr(joins, "written_table", lambda df, label: made.setdefault(label, own(df, label)))
    stored = spark.createDataFrame([(k // 2, k) for k in range(40)] + [(None, 1)], "k bigint, v bigint")
    batch = spark.createDataFrame([(k, "x" * k) for k in (3, 5, 19, 20, 21, 21)] + [(None, "y")], "k bigint, t string")
    found = drop_existing(batch, stored, ["k"], broadcast_bytes=0)
    assert rows(found) == rows(batch.filter("k > 19"))
    assert made["keys-missing"].columns == ["k"] and rows(made["keys-missing"]) == [(20,), (21,)]
    assert rows(drop_existing(batch, stored, ["k"])) == rows(found)
