from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.influence import (
    influence_by_variable, influence_table, key_influencers, mean_by_category, stacked_influence, strongest_category,
)
from shelfcast.operators.profile import (
    column_range, describe_basics, describe_categoricals, describe_numericals, describe_table, percentiles, summarize,
    value_counts,
)
from tests.conftest import rows


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    values = [
        (i, None if i % 11 == 0 else (0.5 if i % 3 == 0 else round(rng.uniform(-5, 5), 3)), rng.choice("abc"), i % 4 == 0)
        for i in range(157)
    ]
    return spark.createDataFrame(values, "i bigint, x double, s string, f boolean")


def test_percentiles_equal_numpy(mixed):
    fractions = (0, 0.1, 0.5, 0.77, 1)
    frame = mixed.toPandas()
    for accuracy in (4, 20, 10_000):  # coarse sketches have wide brackets, some of which miss
        got = {(r["variable"], r["fraction"]): r["value"] for r in percentiles(mixed, ["i", "x"], fractions, accuracy).collect()}
        for c in ("i", "x"):
            for f in fractions:
                assert got[(c, f)] == pytest.approx(np.nanquantile(frame[c].astype(float), f), abs=1e-12)


def test_only_values_inside_a_bracket_are_moved(spark, monkeypatch):
    from shelfcast.operators import profile

    moved = []
    own = profile.running_total
    monkeypatch.setattr(profile, "running_total", lambda df, *a: moved.append(df.count()) or own(df, *a))
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"), F.lit(3.0).alias("y"))
    got = {(r["variable"], r["fraction"]): r["value"] for r in percentiles(df, ["x", "y"], (0.5,), 1000).collect()}
    values = np.sort([i * 7919 % 200_003 for i in range(200_000)])
    assert got == {("x", 0.5): np.quantile(values, 0.5), ("y", 0.5): 3.0}
    assert len(moved) == 1 and moved[0] < 200_000 / 100


def test_a_bracket_that_misses_its_rank_becomes_the_column(spark, monkeypatch):
    from shelfcast.operators import profile

    own = F.percentile_approx
    monkeypatch.setattr(profile.F, "percentile_approx", lambda c, marks, n: own(c, [0.0 for _ in marks], n))
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    assert [r["value"] for r in percentiles(df, ["x"], (0.5,)).collect()] == [50.0]


def test_percentiles_of_one_value(spark):
    df = spark.createDataFrame([(7,)], "x int")
    assert {r["value"] for r in percentiles(df, ["x"]).collect()} == {7.0}


def test_nan_counts_as_null_and_zero_has_one_sign(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.0,), (-0.0,)], "x double")
    row = describe_basics(df).first()
    assert (row["nulls"], row["unique"], row["total_rows"]) == (2, 1, 4)
    estimate = describe_basics(df, approximate=True).first()
    assert (estimate["nulls"], estimate["total_rows"]) == (2, 4)


def test_examples(mixed):
    shown = {r["variable"]: r for r in describe_basics(mixed, 2, ["i"]).collect()}
    assert (shown["i"]["example_0"], shown["i"]["example_1"]) == ("0", "1")
    assert shown["x"]["example_0"] is None and shown["f"]["example_0"] == "true"
    assert shown["s"]["type"] == "string"


def test_categoricals_prefer_the_first_of_equals(spark):
    df = spark.createDataFrame([("b", True), ("a", None), ("b", True), ("a", False), (None, True)], "s string, f boolean")
    got = {r["variable"]: r for r in describe_categoricals(df).collect()}
    assert (got["s"]["most_common"], got["s"]["freq_of_most_common"], got["s"]["nulls"]) == ("a", 2, 1)
    assert (got["f"]["most_common"], got["f"]["unique"]) == ("true", 2)


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "s string, x double")
    row = describe_categoricals(df).first()
    assert row["most_common"] is None and row["unique"] == 0
    numbers = describe_numericals(df, include_percentiles=True).first()
    assert numbers["50%"] is None and numbers["mean"] is None and numbers["nulls"] == 2


def test_numericals_equal_pandas(mixed):
    frame = mixed.toPandas()
    got = {r["variable"]: r for r in describe_numericals(mixed, decimals=4, include_additional_examples=True, order="i").collect()}
    assert set(got) == {"i", "x"}
    assert got["x"]["mean"] == pytest.approx(round(frame["x"].mean(), 4))
    assert got["x"]["std"] == pytest.approx(round(frame["x"].std(), 4))
    assert (got["i"]["first_value"], got["i"]["last_value"], got["x"]["first_value"]) == (0, 156, None)
    with pytest.raises(ValueError):
        describe_numericals(mixed, include_additional_examples=True)


def test_summary_and_range(mixed):
    frame = mixed.toPandas()
    row = {r["variable"]: r for r in summarize(mixed).collect()}["x"]
    for name in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
        assert row[name] == pytest.approx(frame["x"].describe()[name])
    assert column_range(mixed, "i").first().asDict() == {"min_i": 0, "mean_i": 78.0, "max_i": 156}
    assert set(describe_table(mixed)) == {"categorical", "numerical"}


def brute_force(frame: pd.DataFrame, category: str, measure: str) -> dict[str, tuple[float, float]]:
    means = frame.groupby(frame[category].astype(str))[measure].mean()
    return {c: (means[c], means.drop(c).mean()) for c in means.index}


def test_influence_equals_brute_force(mixed):
    frame = mixed.toPandas()
    table = key_influencers(mixed, ["s", "f"], "x")
    got = {(r["influencer_variable"], r["category"]): r for r in table.collect()}
    for c in ("s", "f"):
        for category, (own, others) in brute_force(frame, c, "x").items():
            row = got[(c, category)]
            assert row["mean_x"] == pytest.approx(own) and row["mean_x_of_others"] == pytest.approx(others)
            assert row["abs_diff_with_mean_x_of_others"] == pytest.approx(abs(own - others))
            assert row["influencer"] == f"{c} = {category}"
    gaps = [r["diff_with_mean_x_of_others"] for r in table.collect()]
    assert gaps == sorted(gaps, reverse=True)
    stacked = stacked_influence([influence_table(mixed, c, "x") for c in ("s", "f")], "x")
    assert [r["influencer"] for r in stacked.collect()] == [r["influencer"] for r in table.collect()]
    best = strongest_category(table, "x").collect()
    assert len(best) == 2 and influence_by_variable(table, "x").count() == 2


def test_one_category_has_no_others(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 9.0)], "s string, x double")
    row = influence_table(df, "s", "x").first()
    assert (row["category"], row["mean_x"], row["mean_x_of_others"]) == ("a", 2.0, None)


def test_aggregate_without_value_is_left_out_of_the_others(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("c", 1.0), ("c", 5.0)], "s string, x double")
    got = {r["category"]: r["std_x_of_others"] for r in influence_table(df, "s", "x", "std").collect()}
    assert got["a"] == pytest.approx(np.std([1, 5], ddof=1)) and got["b"] == pytest.approx((2**0.5 + 8**0.5) / 2)


def test_labels_sort_by_their_order(spark):
    df = spark.createDataFrame([("Mon", 0, 1.0), ("Fri", 4, 2.0), ("Fri", 4, 4.0), ("Sun", 6, None)], "d string, n int, x double")
    assert [tuple(r) for r in mean_by_category(df, ("d", "n"), "x", reference_line=True).collect()] == [
        ("Mon", 1.0, 2.0), ("Fri", 3.0, 2.0), ("Sun", None, 2.0),
    ]
    assert [r["d"] for r in mean_by_category(df, "d", "x").collect()] == ["Fri", "Mon", "Sun"]


def test_value_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "s string, n int")
    assert rows(value_counts(df, ["s", "n"]), "variable", "text", "number", "n") == [
        ("n", None, None, 1), ("n", None, 1.0, 1), ("s", "a", None, 2),
    ]
