from __future__ import annotations

import datetime
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.operators import ordering
from shelfcast.operators.fill import fill_along, fill_by_calendar, fill_with_flag
from shelfcast.operators.lags import (
    calendar_lags, filled_lags, lag_columns, lead_time_lags, rolling_window, series_ends, supervised_frame,
)
from shelfcast.operators.ordering import dense_position, first_rows, grouped_in_order, last_rows, row_slice, running_total
from shelfcast.plans import features
from shelfcast.shared import written_table
from tests.conftest import rows


@pytest.fixture(scope="module")
def shuffled(spark):
    """600 rows in random order; a third of them share the first order key."""
    values = [(1 if i % 3 == 0 else i % 17, i) for i in range(600)]
    random.Random(1).shuffle(values)
    return spark.createDataFrame(values, "k int, i int").repartition(5)


def test_dense_position(shuffled):
    placed = dense_position(shuffled, ["k", F.col("i").desc()])
    window = W.orderBy("k", F.col("i").desc())
    assert rows(placed) == rows(shuffled.withColumn("position", (F.row_number().over(window) - 1).cast("long")))


def test_dense_position_overwrites_its_column(spark):
    gaps = spark.createDataFrame([(10, "a"), (40, "b"), (41, "c")], "day int, x string")
    assert rows(dense_position(gaps, ["x"], "day"), "day", "x") == [(0, "a"), (1, "b"), (2, "c")]


def test_running_total(shuffled):
    got = running_total(shuffled, ["k", "i"], "i", "upto")
    assert rows(got) == rows(shuffled.withColumn("upto", F.sum("i").over(W.orderBy("k", "i"))))


def test_no_rows(shuffled):
    empty = shuffled.filter("i < 0")
    assert dense_position(empty, ["i"]).count() == 0
    assert running_total(empty, ["i"], "i", "t").count() == 0


def test_slices_and_ends(shuffled, monkeypatch):
    ordered = sorted(rows(shuffled))
    assert sorted(rows(row_slice(shuffled, ["k", "i"], 100, 150))) == ordered[100:150]
    assert rows(first_rows(shuffled, ["k", "i"], 30)) == ordered[:30]
    assert [tuple(r) for r in last_rows(shuffled, ["k", "i"], 4).collect()] == ordered[-4:]
    monkeypatch.setattr(ordering, "TOP_ROWS", 10)
    assert rows(first_rows(shuffled, ["k", "i"], 30)) == ordered[:30]


def series(spark, n: int, seed: int, groups: int):
    """Rows in position order whose groups are runs; one group is a third of all rows."""
    rng = random.Random(seed)
    keys = sorted(0 if rng.random() < 0.33 else rng.randrange(groups) for _ in range(n))
    values = [
        (i, g, None if rng.random() < 0.6 else rng.randrange(100), None if rng.random() < 0.9 else f"t{i}")
        for i, g in enumerate(keys)
    ]
    return spark.createDataFrame(values, "p bigint, g int, v int, t string").repartition(4)


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("group", [(), ("g",)])
@pytest.mark.parametrize("bucket_rows", [7, 1000])
def test_fill_equals_the_plain_window(spark, backward, group, bucket_rows):
    df = series(spark, 300, 3, 12)
    step = F.col("p").desc() if backward else F.col("p")
    window = W.partitionBy(*group).orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    plain = df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in ("v", "t")})
    assert rows(fill_along(df, ["v", "t"], "p", backward, group, bucket_rows)) == rows(plain)


def test_fill_with_null_group(spark):
    df = spark.createDataFrame([(0, None, 1), (1, None, None), (2, "a", None), (3, "a", 5)], "p bigint, g string, v int")
    assert rows(fill_along(df, ["v"], "p", group=["g"], bucket_rows=1)) == [
        (0, None, 1), (1, None, 1), (2, "a", None), (3, "a", 5),
    ]


@pytest.mark.parametrize("group", [(), ("g",)])
@pytest.mark.parametrize("bucket_rows", [5, 64, 1000])
def test_lag_equals_the_plain_window(spark, group, bucket_rows):
    df = series(spark, 200, 5, 9)
    window = W.partitionBy(*group).orderBy("p")
    plain = df.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(window) for k in (1, 2, 5) for c in ("v", "t")})
    got = lag_columns(df, ["v", "t"], [1, 2, 5], "p", group, bucket_rows=bucket_rows)
    assert rows(got, *plain.columns) == rows(plain)


def test_lag_longer_than_a_bucket(spark):
    frame = spark.range(40).select(F.col("id").alias("position"), (F.col("id") * 3).alias("v"))
    lagged = rows(lag_columns(frame, ["v"], [7, 12], "position", bucket_rows=5), "position", "v_lag_7", "v_lag_12")
    assert lagged == [(i, (i - 7) * 3 if i >= 7 else None, (i - 12) * 3 if i >= 12 else None) for i in range(40)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(0, 9)), min_size=1, max_size=25), size=st.integers(2, 4))
def test_rolling_window_equals_shift_and_backfill(spark, values, size):
    frame = pd.DataFrame({"v": pd.array(values, dtype="Int64")})
    expected = {k: frame["v"].shift(k).bfill() for k in range(1, size)}
    df = spark.createDataFrame(list(enumerate(values)), "p bigint, v bigint")
    got = rolling_window(df, size, "p", bucket_rows=4).orderBy("p").collect()
    for k, column in expected.items():
        assert [r[f"v_lag_{k}"] for r in got] == [None if pd.isna(x) else int(x) for x in column]
    assert [r["row_was_lagg_backfilled"] for r in got] == [i < size for i in range(len(values))]


@pytest.mark.parametrize("bucket_rows", [3, 1000])
def test_rolling_window_per_group_equals_shift_and_backfill(spark, bucket_rows):
    df = series(spark, 60, 8, 25).withColumn("w", F.col("p") * 3)
    frame = df.orderBy("p").toPandas().astype({"v": "Int64"})
    got = rolling_window(df, 4, "p", ["v", "w"], ["g"], bucket_rows).orderBy("p").toPandas().astype("Int64", errors="ignore")
    for c in ("v", "w"):
        for k in (1, 2, 3):
            expected = frame.groupby("g")[c].transform(lambda s, k=k: s.shift(k).bfill())
            assert got[f"{c}_lag_{k}"].astype("Int64").tolist() == expected.astype("Int64").tolist()


def test_window_of_two(spark):
    df = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "p bigint, s int")
    assert rows(rolling_window(df, 2, "p"), "p", "s", "s_lag_1") == [(0, 1, 1), (1, 2, 1), (2, 3, 2)]


def test_lead_time_and_supervised_frame(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(5)], "p bigint, s int")
    assert rows(lead_time_lags(df, "s", 2, 3, "p"), "p", "s_lag_3", "s_lag_4") == [
        (0, None, None), (1, None, None), (2, None, None), (3, 0, None), (4, 10, 0),
    ]
    assert supervised_frame(df, "s", 2, "p").columns == ["p", "s_lag_2", "s_lag_1", "s"]


def test_calendar_lags(spark):
    df = spark.sql("""SELECT * FROM VALUES (DATE'2020-02-29', 1, 5), (DATE'2020-03-31', 1, 7), (DATE'2020-03-30', 1, 6),
        (DATE'2021-02-28', 1, 8), (DATE'2020-03-30', 2, 9) AS t(date, store, sales)""")
    got = calendar_lags(df, "sales", {"d": (1, "day"), "m": (1, "month"), "y": (1, "year")}, ["store"])
    found = {(str(r["date"]), r["store"]): (r["d"], r["m"], r["y"]) for r in got.collect()}
    assert found[("2020-03-31", 1)] == (6, 5, None)
    assert found[("2020-03-30", 2)] == (None, None, None)
    assert found[("2021-02-28", 1)] == (None, None, None)


def test_fill_by_calendar_reaches_leading_gaps(spark):
    facts = spark.sql("SELECT DATE'2020-01-01' + i AS date, i FROM (SELECT explode(sequence(0, 5)) i)")
    oil = spark.sql("SELECT * FROM VALUES (DATE'2020-01-02', 5.0D), (DATE'2020-01-04', NULL), (DATE'2020-01-05', 7.0D) t(date, p)")
    assert rows(fill_by_calendar(facts, oil, "p"), "i", "p") == [(0, 5.0), (1, 5.0), (2, 5.0), (3, 5.0), (4, 7.0), (5, 7.0)]


def test_fill_with_flag(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "i int, n int")
    assert rows(fill_with_flag(df, "n", "was"), "i", "n", "was") == [(1, 0, True), (2, 3, False)]


def test_groups_are_numbered_in_one_shuffle(spark):
    rows = spark.createDataFrame([(k % 7 if k % 11 else None, f"{k % 3}", float(k)) for k in range(500)], "a int, b string, x double")
    made = grouped_in_order(rows, ["a", "b"], [F.sum("x").alias("x")], "place")
    grouped = rows.repartitionByRange("a", "b").groupBy("a", "b").agg(F.sum("x")).sortWithinPartitions("a", "b")
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    wanted = dense_position(rows.groupBy("a", "b").agg(F.sum("x").alias("x")), ["a", "b"], "place")
    assert sorted(made.collect(), key=lambda r: r["place"]) == sorted(wanted.collect(), key=lambda r: r["place"])
    assert [r["place"] for r in made.orderBy(F.col("a").asc_nulls_first(), "b").collect()] == list(range(made.count()))


def test_unread_lags_leave_the_plan(spark):
    rows = spark.range(100).select(F.col("id").alias("p"), F.col("id").cast("string").alias("unread"), (F.col("id") * 2).alias("x"))
    lagged = lag_columns(rows, ["x", "unread"], [1], "p", head_from_first=True, bucket_rows=30)
    plan = lagged.select("p", "x_lag_1")._jdf.queryExecution().optimizedPlan().toString()
    assert "unread" not in plan
    found = lagged.orderBy("p").collect()
    assert [r["x_lag_1"] for r in found] == [0, *range(0, 198, 2)]
    assert [r["unread_lag_1"] for r in found] == ["0", *map(str, range(99))]


def test_oil_is_filled_from_one_stored_series(spark, monkeypatch):
    held = [("2020-01-01", None), ("2020-01-02", 5.0), ("2020-01-02", 4.0), ("2020-01-03", None), (None, 9.0), ("2020-01-05", 7.0), ("2020-01-06", None)]
    df = spark.createDataFrame(held, "d string, oil_price double").select(F.to_date("d").alias("date"), "oil_price")
    stored = []
    monkeypatch.setattr(features, "written_table", lambda df, label: stored.append(label) or written_table(df, label))
    found = rows(features.fill_oil(df).select(F.col("date").cast("string"), "oil_price"))
    assert found == [(None, None), ("2020-01-01", 5.0), ("2020-01-02", 5.0), ("2020-01-02", 5.0), ("2020-01-03", 5.0), ("2020-01-05", 7.0), ("2020-01-06", 7.0)]
    assert stored == ["daily-prices"]


@pytest.mark.parametrize("bucket_rows", [2, 4, 50])
def test_filled_lags_are_those_of_the_rolling_window_by_one_shuffle(spark, bucket_rows):
    days = [(p, None if p in (0, 3, 4, 5, 9) else float(p), None if p % 4 == 1 else f"t{p}", datetime.date(2020, 1, p + 1), p * 2) for p in range(10)]
    frame = spark.createDataFrame(days, "p bigint, v double, t string, d date, w int").withColumn("a", F.array("w"))
    columns = ["v", "t", "d", "w", "a"]
    ends = series_ends(frame, columns, "p")
    assert (ends.last, ends.holed, ends.known) == (9, ["v", "t"], {"v": (1.0, 1), "t": ("t0", 0)})
    made = filled_lags(frame, columns, [1, 3], "p", ends, bucket_rows)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(_bucket") == 1
    plain = rolling_window(frame, 4, "p", columns, bucket_rows=bucket_rows)
    assert rows(made) == rows(plain, *made.columns)
    short = frame.filter("p < 2")
    assert rows(filled_lags(short, columns, [1, 3], "p", series_ends(short, columns, "p")), "p", "w_lag_1", "w_lag_3") == [(0, 0, None), (1, 0, None)]
