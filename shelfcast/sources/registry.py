"""The datasets: where their files lie, which table they load, and under which names and types."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcast.functions.columns import rename


def _typed(kinds: Mapping[str, str], keys: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([
        T.StructField(c, T.DataType.fromDDL(kind), True, {"comment": "key"} if c in keys else {})
        for c, kind in kinds.items()
    ])


@dataclass(frozen=True)
class Dataset:
    """A delimited file, the table it loads and how their columns correspond.

    ``columns`` is in file order: table column to (file column, Spark type).
    """

    name: str
    file: str
    comment: str
    keys: tuple[str, ...]
    columns: Mapping[str, tuple[str, str]]

    @property
    def to_file_names(self) -> dict[str, str]:
        return {table: file for table, (file, _) in self.columns.items()}

    @property
    def schema(self) -> T.StructType:
        """Of the table; key columns carry a comment."""
        return _typed({c: kind for c, (_, kind) in self.columns.items()}, self.keys)

    @property
    def file_schema(self) -> T.StructType:
        """Of the file: the same types under the file's names."""
        return _typed(dict(self.columns.values()))

    def to_table(self, rows: DataFrame) -> DataFrame:
        """Rows under the file's names, renamed and ordered as the table."""
        return rows.select(*[rows[f].alias(c) for c, f in self.to_file_names.items()])

    def to_file(self, rows: DataFrame) -> DataFrame:
        """Rows of the table under the file's names."""
        return rename(rows.select(*self.columns), self.to_file_names)


def borrowed_schema(stored: DataFrame, to_file_names: Mapping[str, str]) -> T.StructType:
    """The schema a new file must have, taken from the stored table it will be added to."""
    return rename(stored.select(*to_file_names), to_file_names).schema


# Dataset, file, table and column names.  Identifiers are wider than
# the smallest type that holds today's data, so that a larger table still loads.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset(
            "stores", "stores.csv", "Characteristics of each store", ("id",),
            {
                "id": ("store_nbr", "int"), "city": ("city", "string"), "state": ("state", "string"),
                "type": ("type", "string"), "cluster": ("cluster", "int"),
            },
        ),
        Dataset(
            "oil_price_by_date", "oil.csv", "Price of oil on the dates that have one", ("date",),
            {"date": ("date", "date"), "oil_price": ("dcoilwtico", "double")},
        ),
        Dataset(
            "sales_agg_by_date_store_productfamily", "train.csv",
            "Sales per date, store and product family", ("id",),
            {
                "id": ("id", "bigint"), "date": ("date", "date"), "store_id": ("store_nbr", "int"),
                "product_family": ("family", "string"), "sales_total": ("sales", "double"),
                "products_of_family_on_promotion_count": ("onpromotion", "int"),
            },
        ),
        Dataset(
            "events_by_date", "holidays_events.csv", "Holidays and other events; a date may have several",
            ("date", "type", "locale", "locale_name", "description", "was_transferred"),
            {
                "date": ("date", "date"), "type": ("type", "string"), "locale": ("locale", "string"),
                "locale_name": ("locale_name", "string"), "description": ("description", "string"),
                "was_transferred": ("transferred", "boolean"),
            },
        ),
        Dataset(
            "transactions_agg_by_date_store", "transactions.csv", "Transactions per date and store",
            ("date", "store_id"),
            {"date": ("date", "date"), "store_id": ("store_nbr", "int"), "transactions_count": ("transactions", "int")},
        ),
    )
}
# Tables in an order in which every row finds what it refers to.
LOAD_ORDER = (
    "stores", "oil_price_by_date", "sales_agg_by_date_store_productfamily", "events_by_date",
    "transactions_agg_by_date_store",
)
