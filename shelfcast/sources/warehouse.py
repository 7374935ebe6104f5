"""Stored tables in a Spark catalog database.

Executors write, and nothing passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.joins import require_unique, update_columns
from shelfcast.operators.ordering import newest_first
from shelfcast.shared import shared_folder
from shelfcast.sources.registry import Dataset


#: Partition column of every stored table: the number of the append that a row came with.
PART = "_part"


@dataclass(frozen=True)
class Stored:
    """What a name stands for; kept as properties of its view, so that all of it changes at once."""

    stored_in: str
    columns: tuple[str, ...]
    #: The version that this one replaced, if any.
    before: str = ""
    #: The last append that readers see.
    parts: int = 0
    #: Per stream, named by where it keeps its progress, the last batch that is in the table.
    batches: Mapping[str, int] = field(default_factory=dict)
    #: A column and its largest value as text, or None where that is not known; the value is None for no rows.
    mark: tuple[str | None, str | None] | None = None
    #: Tables with later values of some columns, the oldest first: table, keys, columns.
    sides: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = ()
    #: Buckets that the rows lie in; 0 for none.
    buckets: int = 0


class Warehouse:
    """Named tables; the database lies in the folder all executors share unless ``location`` says otherwise.

    A name is a view of the stored table that holds its current version.  A new version is written in
    full before the view is pointed at it, so readers never meet a half-written table, and a job
    may read the very table it replaces.  The version before stays for jobs that still read it,
    until the next one is stored.  Appended rows are a part of their own, which the view takes in once it is
    complete: an append is there as a whole or not at all, even if the driver is lost in between, and what a
    lost one has left is written over by the next.  One writer at a time changes a table.
    """

    def __init__(self, spark: SparkSession, database: str | None = None, location: str | None = None):
        self.spark = spark
        self.database = database or f"shelfcast_{uuid.uuid4().hex}"
        location = location or f"{shared_folder(spark)}/shelfcast/{self.database}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{location}'")

    def full_name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(table))

    def create(self, dataset: Dataset) -> None:
        """An empty table as declared, unless there is one."""
        self.create_table(dataset.name, dataset.schema, dataset.comment)

    def create_table(self, table: str, schema: T.StructType, comment: str = "") -> None:
        if not self.exists(table):
            version = self._version_name(table)
            said = {f.name: f.metadata.get("comment", "") for f in schema.fields}
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT {_text(said[f.name])}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE {version} ({columns}, {PART} INT) USING parquet PARTITIONED BY ({PART}) COMMENT {_text(comment)}")
            self._point(table, Stored(version, tuple(schema.names), mark=(None, None)))

    def current(self, table: str) -> DataFrame:
        """What the table holds now, other sessions' writes included."""
        self.spark.catalog.refreshTable(self.full_name(table))
        return self.spark.table(self.full_name(table))

    def query(self, sql: str) -> DataFrame:
        """A query in which ``{table}`` stands for a stored table of that name."""
        names = {t.name: self.full_name(t.name) for t in self.spark.catalog.listTables(self.database) if not t.isTemporary}
        return self.spark.sql(sql.format(**names))

    def as_view(self, table: str, view: str | None = None) -> DataFrame:
        """Make the table known to plain SQL under a temporary name."""
        self.current(table).createOrReplaceTempView(view or table)
        return self.spark.table(view or table)

    def last_entry(self, table: str, keys: Sequence[str]) -> DataFrame:
        """The newest row by the keys; none for an empty table."""
        return self.current(table).orderBy(*newest_first(keys)).limit(1)

    def save(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (), buckets: int = 0, bucket_by: Sequence[str] = ()
    ) -> None:
        """Store, replacing what is there; in ``buckets`` sorted by ``bucket_by`` on request, a file each."""
        version = self._version_name(table)
        if buckets:
            df = df.repartition(buckets, *bucket_by)
        writer = df.withColumn(PART, F.lit(0)).write.format("parquet").partitionBy(PART, *partition_by)
        if buckets:
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        writer.saveAsTable(version)
        columns = tuple([c for c in df.columns if c not in partition_by] + list(partition_by))
        if not self.exists(table):
            self._point(table, Stored(version, columns, buckets=buckets))
            return
        old = self._stored(table)
        self._point(table, Stored(version, columns, old.stored_in, batches=old.batches, buckets=buckets))
        for gone in filter(None, [old.before]):
            self.spark.sql(f"DROP TABLE {gone}")

    def save_new(self, df: DataFrame, table: str) -> None:
        """Store, refusing when the table exists."""
        if self.exists(table):
            raise ValueError(f"table {self.full_name(table)} already exists")
        self.save(df, table)

    def append(
        self, df: DataFrame, table: str, mark: str | None = None, batch: tuple[str, int] | None = None, unique: Sequence[str] = ()
    ) -> None:
        """Add rows, all or none; columns the rows lack become null.

        ``mark`` names a column whose largest value the table shall know; ``batch`` (stream and number) is noted with the
        rows, in the same step that makes them visible.  Two of the rows under one key of ``unique`` are an error, and then
        none is added.  Rows are computed once: what is looked up afterwards is read from the part they were written as.
        """
        old = self._stored(table)
        unknown = [c for c in df.columns if c not in old.columns]
        if unknown:
            raise ValueError(f"{table} has no columns {unknown}")
        part = old.parts + 1
        self._write_part(df, old.stored_in, {PART: str(part)})
        added = self.spark.table(old.stored_in).filter(F.col(PART) == part)
        if unique:
            require_unique(added, unique)
        high = None
        if mark is not None and old.mark is not None and old.mark[0] in (None, mark):
            known = F.lit(old.mark[1]).cast(added.schema[mark].dataType)
            high = (mark, added.agg(F.greatest(F.max(mark), known).cast("string")).first()[0])
        batches = {**old.batches, batch[0]: batch[1]} if batch else old.batches
        self._point(table, replace(old, parts=part, batches=batches, mark=high))

    def rows_and_buckets(self, table: str) -> tuple[int, int]:
        """How many rows are stored, side tables not read, and in how many buckets they lie."""
        old = self._stored(table)
        return self.spark.table(old.stored_in).filter(F.col(PART) <= old.parts).count(), old.buckets

    def last_batch(self, table: str, stream: str) -> int:
        """The last batch of a stream that the table holds; -1 for none."""
        return self._stored(table).batches.get(stream, -1)

    def all_newer(self, rows: DataFrame, table: str, column: str) -> bool:
        """Whether every row lies above the table's mark, so that none of them can be stored yet; not if that is unknown."""
        mark = self._stored(table).mark
        if mark is None or mark[0] not in (None, column):
            return False
        if mark[1] is None and mark[0] is None:
            return True  # nothing has been stored
        least, empty = rows.agg(F.min(column), F.count_if(F.col(column).isNull()) > 0).first()
        if empty or mark[1] is None:
            return False
        kind = rows.schema[column].dataType
        return least is None or rows.sparkSession.range(1).select(F.lit(least) > F.lit(mark[1]).cast(kind)).first()[0]

    def above_mark(self, table: str, column: str) -> Column | None:
        """A condition that holds for rows above the table's mark, which cannot be stored yet; nothing if that is unknown."""
        mark = self._stored(table).mark
        if mark is None or mark[0] != column or mark[1] is None:
            return None
        return F.coalesce(F.col(column) > F.lit(mark[1]).cast(self.current(table).schema[column].dataType), F.lit(False))

    def replace_partition(self, df: DataFrame, table: str, values: Mapping[str, object]) -> None:
        """Replace the rows of one partition of a partitioned table; the files of all others stay."""
        old = self._stored(table)
        if old.parts:
            raise ValueError(f"{table} has appended rows; store it as a whole")
        spec = {PART: "0", **{c: _text(v) if isinstance(v, str) else str(v) for c, v in values.items()}}
        self._write_part(df, old.stored_in, spec)

    def name_partition(self, name: str, table: str, values: Mapping[str, object]) -> None:
        """Let ``name`` stand for one partition of a stored table, without the columns that tell it."""
        columns = ", ".join(f"`{c}`" for c in self._stored(table).columns if c not in values)
        chosen = " AND ".join(f"`{c}` = {_text(v) if isinstance(v, str) else v}" for c, v in values.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.full_name(name)} AS SELECT {columns} FROM {self.full_name(table)} WHERE {chosen}")

    def add_columns(self, table: str, kinds: Mapping[str, str]) -> None:
        """Add the columns that are missing; a change of metadata only, old rows read as null."""
        old = self._stored(table)
        missing = {c: kind for c, kind in kinds.items() if c not in old.columns}
        if missing:
            self.spark.sql(f"ALTER TABLE {old.stored_in} ADD COLUMNS ({', '.join(f'`{c}` {kind}' for c, kind in missing.items())})")
            self._point(table, replace(old, columns=(*old.columns, *missing)))

    def update_columns(
        self, table: str, values: DataFrame, keys: Sequence[str], columns: Sequence[str]
    ) -> None:
        """Set columns of stored rows by key; see :func:`shelfcast.operators.joins.update_columns`."""
        self.save(update_columns(self.current(table), values, keys, columns), table)

    def update_beside(self, table: str, values: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> None:
        """As :meth:`update_columns` for a table stored in ``buckets`` by ``keys``, without writing it anew.

        The values are stored in a side table with the same buckets, and readers join the two bucket by bucket, without a
        shuffle.  Columns that the table lacks are added.  The next :meth:`save` of what the name holds takes them in.
        """
        old = self._stored(table)
        values = values.select(*keys, *columns)
        require_unique(values, keys)
        side = self._version_name(f"{table}_side")
        values.withColumn("_matched", F.lit(True)).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(side)
        added = [c for c in columns if c not in old.columns]
        self._point(table, replace(old, columns=(*old.columns, *added), sides=(*old.sides, (side, tuple(keys), tuple(columns)))))

    def _write_part(self, df: DataFrame, version: str, spec: Mapping[str, str]) -> None:
        """Write the rows as the partition that ``spec`` names (further partition columns come from the rows)."""
        fields = [f for f in self.spark.table(version).schema.fields if f.name not in spec]
        rows = df.select(*[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
        ])
        further = [c.name for c in self.spark.catalog.listColumns(version) if c.isPartition and c.name not in spec]
        named = ", ".join([f"{c} = {v}" for c, v in spec.items()] + further)
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {version} PARTITION ({named}) SELECT * FROM {{rows}}", rows=rows)

    def _version_name(self, table: str) -> str:
        return self.full_name(f"{table}__{uuid.uuid4().hex}")

    def _stored(self, table: str) -> Stored:
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(table)}").collect()}
        state = json.loads(found["state"])
        mark = tuple(state["mark"]) if state["mark"] is not None else None
        sides = tuple((t, tuple(k), tuple(c)) for t, k, c in state["sides"])
        return Stored(
            state["stored_in"], tuple(state["columns"]), state["before"], state["parts"], state["batches"], mark, sides, state.get("buckets", 0)
        )

    def _point(self, table: str, state: Stored) -> None:
        """Let the name stand for ``state`` from now on."""
        base = set(self.spark.table(state.stored_in).columns)
        source, values = f"{state.stored_in} b", {c: f"b.`{c}`" if c in base else "NULL" for c in state.columns}
        for k, (side, keys, columns) in enumerate(state.sides):
            source += f" LEFT JOIN {side} s{k} ON " + " AND ".join(f"b.`{x}` = s{k}.`{x}`" for x in keys)
            for c in columns:
                values[c] = f"CASE WHEN s{k}._matched THEN s{k}.`{c}` ELSE {values[c]} END"
        shown = ", ".join(f"{v} AS `{c}`" for c, v in values.items())
        # a view's text is read again by the parser, so the properties are quoted and escaped as literals
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.full_name(table)} TBLPROPERTIES ('state' = {_text(json.dumps(asdict(state)))}) "
            f"AS SELECT {shown} FROM {source} WHERE b.{PART} <= {state.parts}"
        )


def _text(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_missing_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """A frame with the named columns; those it lacks are null."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from values in the program."""
    return spark.createDataFrame(list(rows), schema)


def read_external(spark: SparkSession, source: str, table: str, **options: str) -> DataFrame:
    """A table of a database, through a Spark data source such as ``jdbc``; options are the caller's."""
    reader = spark.read.format(source).options(**options)
    return reader.option("query" if table.lstrip().lower().startswith("select") else "dbtable", table).load()
