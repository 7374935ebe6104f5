"""Every registered query: its result against SQL, and the shape of its plan."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entries
from check import TABLES, rows_of
from shelfcast.queries import ORACLES as QUERY_TEXTS
from shelfcast.queries import load_queries
from shelfcast.queries.views import ALL, FILLED, MERGED, sql, star, table

QUERIES, ORACLES = load_queries(), QUERY_TEXTS
# windows without a partition clause may run over these only: one row per shuffle partition
UNPARTITIONED = {"_chunk"}


@pytest.fixture(scope="module")
def oracle(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return connection


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, oracle, name):
    frame = QUERIES[name](spark, small)
    plan = plan_of(frame)
    for operator in ("PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    leading = re.findall(r"windowspecdefinition\((\w+)#\d+L? (?:ASC|DESC)", plan)
    assert set(leading) <= UNPARTITIONED
    mine = rows_of([tuple(r) for r in frame.collect()], frame.columns)
    if name not in ORACLES:
        assert mine
        return
    result = oracle.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert mine == rows_of(result.fetchall(), names)


def test_names_and_texts_belong_together():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"k11_boosted_trees", "k17_search", "k18_prepared_features_model"}


def test_entry(spark):
    frame = entries.entry(spark)
    assert frame.count() == 6011 and "oil_price" in frame.columns


def test_side_tables_are_broadcast_and_columns_pruned(spark, small):
    plan = plan_of(entries.queries()["d05_all_sources_filled"](spark, small).select("id", "oil_price"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    scanned = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert scanned and not any("family" in s or "sales" in s or "city" in s for s in scanned)


def test_outer_validation_covers_all_rows(spark, small, monkeypatch):
    from shelfcast.queries import modelling

    sides = []

    def noted(model, inner, outer, target):
        sides.extend([inner.count(), outer.count()])
        return inner.limit(1).selectExpr("1D AS r2", "1D AS rmse", "1D AS neg_mean_squared_error")

    monkeypatch.setattr(modelling, "validate_outside", noted)
    QUERIES["k09_outer_validation_of_all_rows"](spark, small)
    size = table(spark, small, "sales").count()
    assert sum(sides) == size and sides[1] == -(-size // 5)


def test_month_filter_prunes_partitions(spark, small):
    plan = plan_of(entries.queries()["a15_month_partition"](spark, small))
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan)


def test_high_water_mark_reaches_the_scan(spark, small):
    plan = plan_of(entries.queries()["c03_high_water_mark"](spark, small))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(id", plan)


def test_tables_match_their_sql(spark, small, oracle):
    for name, view in star(spark, small).items():
        names = sorted(view.columns)
        expected = oracle.execute(sql(*ALL, f"SELECT {', '.join(names)} FROM {name}")).fetchall()
        assert rows_of([tuple(r) for r in view.select(*names).collect()], names) == rows_of(expected, names)
    assert table(spark, small, "sales") is table(spark, small, "sales")
    assert oracle.execute(sql(*ALL, MERGED, FILLED, "SELECT COUNT(*) FROM filled")).fetchone() == (6011,)
