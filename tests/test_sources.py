from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.shared import fresh_path, shared_folder, written_table
from shelfcast.sources.delimited import (
    lines_after, numbered_lines, numbered_lines_after, parse_lines, read_delimited, read_rows_after,
)
from shelfcast.sources.ingest import above_high_water, load_all, load_new_rows, new_rows, newer_rows, newer_than
from shelfcast.sources.registry import DATASETS, LOAD_ORDER, borrowed_schema
from shelfcast.sources.warehouse import Warehouse, read_external, with_missing_columns
from shelfcast.streaming.load import arriving_rows, land_stream, load_stream
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
OIL = DATASETS["oil_price_by_date"]
TRADE = DATASETS["transactions_agg_by_date_store"]


@pytest.fixture
def files(tmp_path):
    """Two files with headers; data lines repeat, one even repeats the header's neighbour."""
    lines = [f"{i},n{i % 3}" for i in range(50)]
    (tmp_path / "part-0.csv").write_text("\n".join(["id,name", *lines[:30], lines[29]]) + "\n")
    (tmp_path / "part-1.csv").write_text("\n".join(["id,name", *lines[30:]]) + "\n")
    return str(tmp_path), [*range(30), 29, *range(30, 50)]


@pytest.fixture(params=[None, "64"])
def block_size(spark, request):
    """Once with whole files as blocks, once with blocks of a few lines."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", "4194304")


def test_lines_are_numbered_in_file_order(spark, files, block_size):
    path, ids = files
    got = numbered_lines(spark, path).orderBy("line_number").collect()
    assert [r["line_number"] for r in got] == list(range(53))
    assert [r["value"].split(",")[0] for r in got] == ["id", *map(str, ids[:31]), "id", *map(str, ids[31:])]


def test_numbers_survive_another_cut_into_blocks(spark, files):
    path, ids = files
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    numbered = numbered_lines(spark, path, skip_headers=True)
    try:
        for values in (("64", "1", "40"), ("134217728", "4194304", "1"), ("200", "1", "3")):
            for name, value in zip(names, values):
                spark.conf.set(name, value)
            again = numbered.filter("line_number >= 0")  # planned anew
            assert [int(v.split(",")[0]) for _, v in rows(again)] == ids
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_rows_with_null_keys_are_loaded_once(spark, tmp_path):
    events = DATASETS["events_by_date"] if "events_by_date" in DATASETS else None
    dataset = events or next(d for d in DATASETS.values() if len(d.keys) > 2)
    warehouse = Warehouse(spark)
    warehouse.create(dataset)
    kinds = {f.name: f.dataType.simpleString() for f in dataset.schema.fields}
    last = dataset.keys[-1]
    values = {c: "2020-01-01" if kinds[c] == "date" else "1" if kinds[c] in ("int", "bigint", "double") else "true" if kinds[c] == "boolean" else "x" for c in kinds}
    header = [dataset.to_file_names.get(c, c) if hasattr(dataset.to_file_names, "get") else c for c in kinds]
    path = tmp_path / "rows.csv"
    line = lambda **own: ",".join("" if (own | values)[c] is None else (values | own)[c] for c in kinds)
    path.write_text("\n".join([",".join(header), line(), line(**{last: ""})]) + "\n")
    for _ in range(2):
        load_new_rows(warehouse, dataset, str(path))
        assert warehouse.current(dataset.name).count() == 2


def test_queries_see_stored_tables_only(spark):
    warehouse = Warehouse(spark)
    warehouse.save(oil_rows(spark, ("2020-01-01", 1.0)), "prices")
    spark.range(1).createOrReplaceTempView("passing_view")
    try:
        assert warehouse.query("SELECT count(*) AS n FROM {prices}").first()["n"] == 1
        with pytest.raises(KeyError):
            warehouse.query("SELECT * FROM {passing_view}")
    finally:
        spark.catalog.dropTempView("passing_view")


@pytest.mark.parametrize("skip", [0, 1, 30, 31, 32, 51, 99])
def test_rows_are_skipped_by_position(spark, files, block_size, skip):
    path, ids = files
    got = read_rows_after(spark, path, SCHEMA, skip, number="n").orderBy("n").collect()
    assert [(r["n"], r["id"]) for r in got] == list(enumerate(ids))[skip:]


def test_numbers_go_in_front(spark, files):
    path, _ = files
    schema = T.StructType.fromDDL("n bigint, id string, name string")
    got = parse_lines(numbered_lines_after(spark, path, 51), schema)
    assert rows(got) == [(51, "48", "n0"), (52, "49", "n1")]
    assert lines_after(spark, path, 0).count() == 53 and lines_after(spark, path, 50).count() == 3


def test_filtered_scan(spark, files):
    path, _ = files
    got = read_delimited(spark, path, SCHEMA, "id >= 48")
    assert rows(got) == [(48, "n0"), (49, "n1")]
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,48)]" in got._sc._jvm.PythonSQLUtils.explainString(
        got._jdf.queryExecution(), "formatted"
    )


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark)).rstrip("/")
    df = spark.range(5)
    assert rows(written_table(df, "t")) == rows(df) and fresh_path(spark, "t") != fresh_path(spark, "t")


def test_newer_than_is_lexicographic(spark):
    df = spark.createDataFrame([(1, 5), (2, 1), (2, 3), (3, 0)], "a int, b int")
    assert rows(df.filter(newer_than({"a": 2, "b": 1}, ["a", "b"]))) == [(2, 3), (3, 0)]
    assert rows(df.filter(newer_than({"a": 1, "b": 1}, ["a", "b"], every_key=True))) == [(2, 3)]
    assert rows(newer_rows(df, df.filter("a < 0"), ["a", "b"])) == rows(df)
    assert rows(above_high_water(df, df.filter("a < 3"), "a")) == [(3, 0)]
    assert above_high_water(df, df.filter("a < 0"), "a").count() == 4


def oil_rows(spark, *values):
    return spark.createDataFrame(list(values), "date string, price double").selectExpr("to_date(date) AS date", "price AS oil_price")


def test_declared_tables(spark):
    warehouse = Warehouse(spark)
    for dataset in DATASETS.values():
        warehouse.create(dataset)
        warehouse.create(dataset)
        assert warehouse.current(dataset.name).count() == 0
        assert [(f.name, f.dataType) for f in warehouse.current(dataset.name).schema] == [
            (f.name, f.dataType) for f in dataset.schema
        ]
    assert set(LOAD_ORDER) == set(DATASETS)
    assert borrowed_schema(warehouse.current(OIL.name), OIL.to_file_names).names == ["date", "dcoilwtico"]


def test_tables_are_appended_replaced_and_extended(spark):
    warehouse = Warehouse(spark)
    warehouse.create(OIL)
    first, second = oil_rows(spark, ("2020-01-01", 1.0)), oil_rows(spark, ("2020-01-02", None))
    warehouse.append(first, OIL.name)
    warehouse.append(second.select("date"), OIL.name)
    assert warehouse.current(OIL.name).count() == 2
    with pytest.raises(ValueError):
        warehouse.append(first.toDF("date", "other"), OIL.name)
    warehouse.add_columns(OIL.name, {"oil_price": "double", "scaled": "float", "parts": "array<double>"})
    assert warehouse.current(OIL.name).columns == ["date", "oil_price", "scaled", "parts"]
    assert warehouse.current(OIL.name).filter("scaled IS NULL AND parts IS NULL").count() == 2
    before = warehouse.current(OIL.name)
    values = oil_rows(spark, ("2020-01-01", 5.0), ("2030-01-01", 6.0))
    warehouse.update_columns(OIL.name, values, ["date"], ["oil_price"])
    assert rows(warehouse.current(OIL.name), "oil_price") == [(None,), (5.0,)]
    assert before.count() == 2  # the replaced version still serves its readers
    for _ in range(3):
        warehouse.save(warehouse.current(OIL.name), OIL.name)
    assert warehouse.current(OIL.name).count() == 2
    assert warehouse.last_entry(OIL.name, ["date"]).first()["oil_price"] is None
    with pytest.raises(ValueError):
        warehouse.save_new(first, OIL.name)
    stored = [t.name for t in spark.catalog.listTables(warehouse.database) if not t.isTemporary]
    assert len(stored) == 3  # the name, its table and the one before


def test_a_failed_append_leaves_nothing(spark):
    warehouse = Warehouse(spark)
    warehouse.create(OIL)
    bad = spark.range(100).selectExpr("DATE'2020-01-01' + CAST(id AS INT) AS date", "1 / (id - 70) AS oil_price")
    with pytest.raises(Exception):
        warehouse.append(bad, OIL.name)
    assert warehouse.current(OIL.name).count() == 0


def test_missing_columns_of_a_frame(spark):
    assert with_missing_columns(spark.range(1), {"id": "int", "x": "array<string>"}).dtypes == [
        ("id", "bigint"), ("x", "array<string>"),
    ]


def test_external_sources_need_their_driver(spark):
    with pytest.raises(Exception):
        read_external(spark, "jdbc", "t", url="jdbc:none:x").count()
    with pytest.raises(AnalysisException):
        Warehouse(spark).current("absent")


def write_trade(path, name, *lines):
    (path / name).write_text("\n".join(["date,store_nbr,transactions", *lines]) + "\n")


def test_loading_twice_adds_nothing(spark, tmp_path):
    write_trade(tmp_path, "a.csv", "2020-01-01,1,10", "2020-01-01,2,11")
    warehouse = Warehouse(spark)
    load_new_rows(warehouse, TRADE, str(tmp_path))
    write_trade(tmp_path, "b.csv", "2020-01-01,3,12", "2020-01-02,1,13")
    for by in ("keys", "newer", "position"):
        assert new_rows(warehouse, TRADE, str(tmp_path), by).count() == 2
    for _ in range(2):
        load_new_rows(warehouse, TRADE, str(tmp_path))
    assert warehouse.current(TRADE.name).count() == 4
    with pytest.raises(ValueError):
        new_rows(warehouse, TRADE, str(tmp_path), "guess")


def test_new_rows_are_written_once_and_looked_up_below_the_mark_only(spark, tmp_path, monkeypatch):
    from shelfcast.sources import ingest

    written, searched = [], []
    own_write, own_search = ingest.written_table, ingest.drop_existing
    monkeypatch.setattr(ingest, "written_table", lambda df, label: written.append(label) or own_write(df, label))
    monkeypatch.setattr(ingest, "drop_existing", lambda df, *a: searched.append(df.count()) or own_search(df, *a))
    warehouse = Warehouse(spark)
    write_trade(tmp_path, "a.csv", "2020-01-01,1,10", "2020-01-02,2,11")
    load_new_rows(warehouse, TRADE, str(tmp_path))
    write_trade(tmp_path, "b.csv", "2020-01-02,1,12", "2020-01-03,1,13", "2020-01-04,1,14", ",7,15")
    load_new_rows(warehouse, TRADE, str(tmp_path))
    assert written == ["arrived"] * 2 and searched == [4]  # the two later ones are new without a look
    load_new_rows(warehouse, TRADE, str(tmp_path))
    found = rows(warehouse.current(TRADE.name), "store_id", "transactions_count")
    assert found == [(1, 10), (1, 12), (1, 13), (1, 14), (2, 11), (7, 15)]
    write_trade(tmp_path, "c.csv", "2020-01-05,1,1", "2020-01-05,1,2")
    with pytest.raises(ValueError):
        load_new_rows(warehouse, TRADE, str(tmp_path))
    assert warehouse.current(TRADE.name).count() == 6


def test_two_rows_under_one_key_are_refused(spark, tmp_path):
    write_trade(tmp_path, "a.csv", "2020-01-01,1,10", "2020-01-01,1,11")
    warehouse = Warehouse(spark)
    with pytest.raises(ValueError):
        load_new_rows(warehouse, TRADE, str(tmp_path))
    assert warehouse.current(TRADE.name).count() == 0


def test_load_all_loads_what_it_is_told(spark, tmp_path):
    folder = tmp_path / TRADE.file
    folder.mkdir()
    write_trade(folder, "a.csv", "2020-01-01,1,10")
    warehouse = Warehouse(spark)
    load_all(warehouse, str(tmp_path), names=[TRADE.name])
    assert warehouse.current(TRADE.name).count() == 1


def test_streams_take_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    landed, warehouse = str(tmp_path / "landed"), Warehouse(spark)
    for i, name in enumerate(("a.csv", "b.csv", "c.csv")):
        write_trade(folder, name, f"2020-01-0{i + 1},1,{i}")
        land_stream(arriving_rows(spark, TRADE, str(folder)), landed, str(tmp_path / "p1")).awaitTermination()
        load_stream(arriving_rows(spark, TRADE, str(folder), 1), warehouse, TRADE, str(tmp_path / "p2")).awaitTermination()
        assert spark.read.parquet(landed).count() == i + 1
        assert warehouse.current(TRADE.name).count() == i + 1
    # a stream that lost its progress delivers everything again
    load_stream(arriving_rows(spark, TRADE, str(folder)), warehouse, TRADE, str(tmp_path / "p3")).awaitTermination()
    assert warehouse.current(TRADE.name).count() == 3


def test_a_part_that_was_never_taken_in_is_written_over(spark, monkeypatch):
    warehouse = Warehouse(spark)
    warehouse.create(OIL)
    warehouse.append(oil_rows(spark, ("2020-01-01", 1.0)), OIL.name)
    point = Warehouse._point

    def lost(self, table, state):
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(Warehouse, "_point", lost)  # all files are there, but nobody has been told
    with pytest.raises(RuntimeError):
        warehouse.append(oil_rows(spark, ("2020-01-02", 2.0), ("2020-01-03", 3.0)), OIL.name)
    monkeypatch.setattr(Warehouse, "_point", point)
    assert warehouse.current(OIL.name).count() == 1
    warehouse.append(oil_rows(spark, ("2020-01-04", 4.0)), OIL.name)
    assert rows(warehouse.current(OIL.name), "oil_price") == [(1.0,), (4.0,)]


def trade_rows(spark, *values):
    return spark.createDataFrame(list(values), "date string, store_id int, transactions_count int").withColumn("date", F.to_date("date"))


def test_a_batch_that_comes_again_is_known_by_its_number(spark, monkeypatch):
    from shelfcast.streaming import load

    warehouse, searched = Warehouse(spark), []
    own = load.drop_existing
    monkeypatch.setattr(load, "drop_existing", lambda *a: searched.append(1) or own(*a))
    warehouse.create(TRADE)
    add = load.table_sink(warehouse, TRADE, "progress/a")
    first = trade_rows(spark, ("2020-01-01", 1, 10), ("2020-01-01", 1, 10), ("2020-01-02", 1, 11))
    add(first, 0)
    add(first, 0)
    add(trade_rows(spark, ("2020-01-03", 1, 12)), 1)
    assert warehouse.current(TRADE.name).count() == 3 and warehouse.last_batch(TRADE.name, "progress/a") == 1
    assert not searched  # nothing stored can be among them
    add(trade_rows(spark, ("2020-01-03", 1, 12), ("2020-01-03", 2, 5)), 2)
    assert searched and warehouse.current(TRADE.name).count() == 4
    load.table_sink(warehouse, TRADE, "progress/b")(first, 0)  # another stream has numbers of its own
    assert warehouse.current(TRADE.name).count() == 4
    warehouse.append(trade_rows(spark, ("2030-01-01", 1, 1)), TRADE.name)  # nobody has noted its largest key
    assert not warehouse.all_newer(trade_rows(spark, ("2040-01-01", 1, 1)), TRADE.name, "date")


def test_stored_keys_are_read_in_the_range_of_the_batch(spark):
    from shelfcast.operators import joins

    stored = written_table(spark.range(1000).select("id", (F.col("id") * 2).alias("x")), "stored")
    batch = spark.createDataFrame([(990, 1), (1005, 2)], "id bigint, y int")
    near = joins.key_range(batch, ["id"])
    plan = stored.filter(near)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,990), LessThanOrEqual(id,1005)" in plan
    assert rows(joins.drop_existing(batch, stored, ["id"])) == [(1005, 2)]
    assert rows(joins.drop_existing(batch.limit(0), stored, ["id"])) == []
    holed = spark.createDataFrame([(None, 1), (5, 2)], "id bigint, y int")
    assert rows(joins.drop_existing(holed, stored, ["id"])) == [(None, 1)]


def test_values_beside_are_read_without_a_shuffle(spark):
    warehouse = Warehouse(spark)
    base = spark.range(100).select("id", (F.col("id") * 1.0).alias("x"))
    warehouse.save(base, "t", buckets=4, bucket_by=["id"])
    files = set(warehouse.current("t").inputFiles())
    warehouse.update_beside("t", base.filter("id < 10").select("id", F.lit(None).cast("double").alias("x"), F.lit("new").alias("n")), ["id"], ["x", "n"], 4)
    warehouse.update_beside("t", base.filter("id < 5").select("id", F.lit(7.0).alias("x")), ["id"], ["x"], 4)
    got = {r["id"]: (r["x"], r["n"]) for r in warehouse.current("t").collect()}
    assert got[3] == (7.0, "new") and got[8] == (None, "new") and got[50] == (50.0, None) and len(got) == 100
    assert files <= set(warehouse.current("t").inputFiles())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warehouse.current("t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    with pytest.raises(ValueError):
        warehouse.update_beside("t", spark.createDataFrame([(1, 1.0), (1, 2.0)], "id bigint, x double"), ["id"], ["x"], 4)
    warehouse.append(spark.createDataFrame([(3, 9.0)], "id bigint, x double").filter("id > 5"), "t")
    warehouse.save(warehouse.current("t"), "t")
    assert {r["id"]: (r["x"], r["n"]) for r in warehouse.current("t").collect()} == got


def test_one_partition_is_replaced_and_the_others_stay(spark):
    warehouse = Warehouse(spark)
    warehouse.save(spark.range(20).select("id", (F.col("id") % 2).cast("int").alias("fold"), F.lit("a").alias("side")), "f", ["fold", "side"])
    kept = set(warehouse.current("f").filter("fold = 0").inputFiles())
    warehouse.replace_partition(spark.createDataFrame([(100,)], "id bigint"), "f", {"fold": 1, "side": "a"})
    assert rows(warehouse.current("f").filter("fold = 1"), "id", "side") == [(100, "a")]
    assert set(warehouse.current("f").filter("fold = 0").inputFiles()) == kept
    warehouse.name_partition("f_1", "f", {"fold": 1, "side": "a"})
    assert rows(warehouse.current("f_1")) == [(100,)]
    warehouse.append(spark.createDataFrame([(5, 1, "a")], "id bigint, fold int, side string"), "f")
    assert warehouse.current("f").count() == 12
    with pytest.raises(ValueError):
        warehouse.replace_partition(spark.range(1), "f", {"fold": 1, "side": "a"})


def test_what_a_scope_has_written_is_removed(spark):
    from shelfcast.shared import scratch

    outside = written_table(spark.range(3), "kept")
    with scratch(spark):
        inside = written_table(spark.range(3), "gone")
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert inside.count() == 3
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)
    assert outside.count() == 3
    with pytest.raises(ValueError):
        with scratch(spark):
            raise ValueError("all the same")


def test_derived_tables_follow_their_files(spark, small, tmp_path):
    from shelfcast.queries.views import given, table

    for name in ("part", "lineitem", "nation", "region", "supplier", "orders"):
        given(spark, small, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    first = table(spark, str(tmp_path), "stores")
    assert table(spark, str(tmp_path), "stores") is first
    given(spark, small, "supplier").limit(4).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "supplier.parquet"))
    assert table(spark, str(tmp_path), "stores").count() == 4 != first.count()
