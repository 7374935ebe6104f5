"""Fills, lags and dense positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.fill import fill_along, fill_by_calendar
from shelfcast.operators.joins import attach
from shelfcast.operators.lags import calendar_lags, lag_columns, lead_time_lags, rolling_window, supervised_frame
from shelfcast.operators.ordering import dense_position
from shelfcast.plans.models import daily_totals
from shelfcast.queries import query
from shelfcast.queries.views import OIL, SALES, given, sql, table

PRICED = """priced AS (
  SELECT s.id, s.date, s.store_nbr, s.family, s.sales, o.dcoilwtico AS price FROM sales s LEFT JOIN oil o ON s.date = o.date)"""


def _priced(spark: SparkSession, folder: str) -> DataFrame:
    """Sales with the day's oil price, which is often missing; ``id`` is their dense position."""
    merged = attach(table(spark, folder, "sales"), table(spark, folder, "oil"), ["date"])
    return merged.select("id", "date", "store_nbr", "family", "sales", F.col("dcoilwtico").alias("price"))


@query("f01_forward_fill", sql(SALES, OIL, PRICED, """
  SELECT id, LAST_VALUE(price IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
  FROM priced"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fill_along(_priced(spark, folder), ["price"], "id").select("id", "price")


@query("f02_backward_fill", sql(SALES, OIL, PRICED, """
  SELECT id, FIRST_VALUE(price IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price
  FROM priced"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fill_along(_priced(spark, folder), ["price"], "id", backward=True).select("id", "price")


@query("f01_forward_fill_per_store", sql(SALES, OIL, PRICED, """
  SELECT id, LAST_VALUE(price IGNORE NULLS) OVER (
    PARTITION BY store_nbr ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM priced"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    placed = dense_position(_priced(spark, folder), ["store_nbr", "id"])
    return fill_along(placed, ["price"], "position", group=["store_nbr"]).select("id", "price")


@query("f03_oil_fill", sql(SALES, OIL, PRICED, """
  SELECT id, date, store_nbr, family, sales, COALESCE(
    LAST_VALUE(price IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    FIRST_VALUE(price IGNORE NULLS) OVER (ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS dcoilwtico
  FROM priced"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    sales = table(spark, folder, "sales").drop("onpromotion")
    return fill_by_calendar(sales, table(spark, folder, "oil"), "dcoilwtico")


def _shifted_sql(columns: list[str], over: str = "") -> str:
    return "shifted AS (SELECT *, " + ", ".join(
        f"LAG({c}, {k}) OVER ({over} ORDER BY id) AS {c}_{k}" for k in (1, 2) for c in columns
    ) + " FROM priced)"


def _filled_sql(columns: list[str], over: str = "") -> str:
    return ", ".join(
        f"FIRST_VALUE({c}_{k} IGNORE NULLS) OVER ({over} ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) "
        f"AS {c}_lag_{k}" for k in (1, 2) for c in columns
    )


WINDOWED = ["date", "store_nbr", "family", "sales", "price"]


@query("f04_rolling_window", sql(
    SALES, OIL, PRICED, _shifted_sql(WINDOWED),
    f"SELECT id, date, store_nbr, family, sales, price, id < 3 AS row_was_lagg_backfilled, {_filled_sql(WINDOWED)} FROM shifted"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rolling_window(_priced(spark, folder), 3, "id")


BY_SERIES = "PARTITION BY store_nbr, family"


@query("f04_rolling_window_per_series", sql(
    SALES, OIL, PRICED, _shifted_sql(["sales", "price"], BY_SERIES),
    f"SELECT id, store_nbr, family, {_filled_sql(['sales', 'price'], BY_SERIES)} FROM shifted"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    placed = dense_position(_priced(spark, folder), ["store_nbr", "family", "id"])
    window = rolling_window(placed, 3, "position", ["sales", "price"], ["store_nbr", "family"])
    lags = [f"{c}_lag_{k}" for k in (1, 2) for c in ("sales", "price")]
    return window.select("id", "store_nbr", "family", *lags)


@query("f05_backfilled_rows", sql(SALES, "SELECT id, id < 4 AS row_was_lagg_backfilled FROM sales"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sales").select("id", "onpromotion")
    return rolling_window(rows, 4, "id").select("id", "row_was_lagg_backfilled")


@query("f06_dense_day_number", sql(SALES, """
  SELECT row_number() OVER (ORDER BY date) - 1 AS days_since_start, ROUND(SUM(sales), 2) AS sales FROM sales GROUP BY date"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    numbered = dense_position(daily_totals(table(spark, folder, "sales")), ["date"], "days_since_start")
    return numbered.select("days_since_start", F.round("sales", 2).alias("sales"))


@query("f06_dense_position_of_facts", sql("""
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = given(spark, folder, "events").select("event_id", "ts")
    return dense_position(events, ["ts", "event_id"]).select("event_id", "position")


@query("f07_supervised_frame", sql(SALES, """
  SELECT id, LAG(sales, 2) OVER (ORDER BY id) AS sales_lag_2, LAG(sales, 1) OVER (ORDER BY id) AS sales_lag_1, sales
  FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return supervised_frame(table(spark, folder, "sales"), "sales", 2, "id")


@query("f08_lags_with_lead_time", sql(SALES, """
  SELECT id, sales, LAG(sales, 7) OVER (ORDER BY id) AS sales_lag_7, LAG(sales, 8) OVER (ORDER BY id) AS sales_lag_8,
    LAG(sales, 9) OVER (ORDER BY id) AS sales_lag_9 FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return lead_time_lags(table(spark, folder, "sales").select("id", "sales"), "sales", 3, 7, "id")


@query("f08_lags_of_one_store", sql(SALES, """
  SELECT id, LAG(sales, 1) OVER (PARTITION BY store_nbr ORDER BY id) AS sales_lag_1 FROM sales"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    placed = dense_position(table(spark, folder, "sales").select("id", "store_nbr", "sales"), ["store_nbr", "id"])
    return lag_columns(placed, ["sales"], [1], "position", ["store_nbr"]).select("id", "sales_lag_1")


@query("f09_calendar_lags", sql(SALES, """
  SELECT s.id, d.sales AS yesterday, w.sales AS last_week, m.sales AS last_month, y.sales AS last_year
  FROM sales s
  LEFT JOIN sales d ON d.store_nbr = s.store_nbr AND d.family = s.family AND d.date = s.date - INTERVAL 1 DAY
  LEFT JOIN sales w ON w.store_nbr = s.store_nbr AND w.family = s.family AND w.date = s.date - INTERVAL 7 DAY
  LEFT JOIN sales m ON m.store_nbr = s.store_nbr AND m.family = s.family AND m.date = s.date - INTERVAL 1 MONTH
  LEFT JOIN sales y ON y.store_nbr = s.store_nbr AND y.family = s.family AND y.date = s.date - INTERVAL 1 YEAR"""))
def _(spark: SparkSession, folder: str) -> DataFrame:
    shifts = {
        "yesterday": (1, "day"), "last_week": (1, "week"), "last_month": (1, "month"), "last_year": (1, "year"),
    }
    lagged = calendar_lags(table(spark, folder, "sales"), "sales", shifts, ["store_nbr", "family"])
    return lagged.select("id", *shifts)
