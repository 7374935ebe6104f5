from __future__ import annotations

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfcast.functions.columns import (
    as_text, choose_columns, first_of_vector, for_display, in_order, nan_as_null, rename, rename_back, round_floating,
)
from shelfcast.functions.dates import circular, date_parts, is_month_end, replace_date, weekday_name
from shelfcast.functions.texts import canonical_reason, day_offset
from tests.conftest import rows


def test_month_ends(spark):
    days = ["2013-01-31", "2013-02-28", "2012-02-28", "2012-02-29", "2013-03-30", "2013-12-31"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    assert [r[0] for r in df.orderBy("d").select(is_month_end(F.col("d"))).collect()] == [0, 1, 1, 1, 0, 1]


def test_date_parts(spark):
    row = spark.sql("SELECT DATE'2024-01-15' AS d").select(*[c.alias(n) for n, c in date_parts(F.col("d")).items()]).first()
    assert row.asDict() == {
        "day_of_year": 15, "day_of_month": 15, "day_of_week": 0, "is_15th": 1, "is_last_day_of_month": 0,
    }
    assert spark.sql("SELECT DATE'2024-01-14' AS d").select(weekday_name(F.col("d"))).first()[0] == "Sunday"


def test_replace_date_uses_the_given_origin(spark):
    df = spark.sql("SELECT DATE'2020-01-11' AS date, 1 AS x")
    row = replace_date(df, F.lit("2020-01-01").cast("date")).first()
    assert row["days_since_start"] == 10 and "date" not in row.asDict()


def test_circular(spark):
    sine, cosine = circular(F.lit(3.5), 7)
    row = spark.range(1).select(sine, cosine).first()
    assert math.isclose(row[0], 0, abs_tol=1e-12) and math.isclose(row[1], -1)


@pytest.mark.parametrize(
    ("reason", "offset", "canonical"),
    [
        ("Fundacion de Quito", 0, "Fundacion"),
        ("Fundacion de Quito-1", -1, "Fundacion"),
        ("Terremoto Manabi+10", 10, "Terremoto Manabi"),
        ("Navidad-4", -4, "Navidad"),
        ("A+1 then B+1", 1, "A then B"),
        ("A+1 then B-2", -2, "A+1 then B"),
        ("Mundial de futbol Brasil: Ecuador", 0, "Mundial de futbol Brasil"),
        ("Copa, Mundial de futbol Brasil", 0, "Mundial de futbol Brasil"),
        ("Translado de fiesta", 0, "Translado"),
        ("Traslado de fiesta", 0, "Traslado de fiesta"),
        ("Black Friday", 0, "Black Friday"),
        ("", 0, ""),
        (None, 0, None),
    ],
)
def test_special_day_reasons(spark, reason, offset, canonical):
    df = spark.createDataFrame([(reason,)], "r string")
    assert tuple(df.select(day_offset(F.col("r")), canonical_reason(F.col("r"))).first()) == (offset, canonical)


def test_an_offset_too_long_for_an_integer_is_no_offset(spark):
    df = spark.createDataFrame([("x+99999999999",)], "r string")
    assert df.select(day_offset(F.col("r"))).first()[0] == 0


def test_choose_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert choose_columns(df, ["c"]).columns == ["c"]
    assert choose_columns(df, ["c"], "pass").columns == ["c", "a", "b"]
    with pytest.raises(ValueError, match="a.*b"):
        choose_columns(df, ["c"], "refuse")
    assert choose_columns(df, ["c", "a", "b"], "refuse").columns == ["c", "a", "b"]
    with pytest.raises(ValueError, match="missing"):
        in_order(df, ["a", "z"])


def test_rename_round_trip(spark):
    df = spark.createDataFrame([(1, 2)], "id int, city int")
    names = {"id": "store_nbr", "city": "city", "absent": "x"}
    assert rename(df, names).columns == ["store_nbr", "city"]
    assert rename_back(rename(df, names), names).columns == df.columns


def test_rounding_is_half_up_and_only_for_floats(spark):
    df = spark.createDataFrame([(0.125, 7)], "x double, n int")
    assert tuple(round_floating(df, 2).first()) == (0.13, 7)
    assert for_display(df.toDF("x_of_y", "n"), 1).columns == ["x of y", "n"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert rows(nan_as_null(df), "i", "x") == [(1, None), (2, 2.0)]


def test_first_of_vector_keeps_types_apart(spark):
    df = spark.createDataFrame([(1, 2.5, 3.7), (2, None, 4.0)], "i int, a double, b double")
    for c in ("a", "b"):
        df = VectorAssembler(inputCols=[c], outputCol=f"{c}_v", handleInvalid="keep").transform(df)
    got = df.select("i", first_of_vector(F.col("a_v"), "float"), first_of_vector(F.col("b_v"), "int"))
    assert rows(got) == [(1, 2.5, 3), (2, None, 4)]
    assert [k for _, k in got.dtypes] == ["int", "float", "int"]


def test_flags_read_capitalised(spark):
    df = spark.createDataFrame([(True, 1)], "f boolean, n int")
    assert tuple(df.select(as_text(df, "f"), as_text(df, "n")).first()) == ("True", "1")
