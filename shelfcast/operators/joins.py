"""Joins that hold up under a hot key.

Every join here keeps all rows of its left side, so left rows may be spread
freely.  The right side is broadcast only after its size has been measured;
beyond the limit both sides are shuffled, and keys holding very many left rows
are cut into pieces first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.shared import written_table

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 5_000_000
_SLOTS = 1 << 16
_ROW_OVERHEAD = 16
_TEXTS = (T.StringType, T.BinaryType)
_WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16, T.NullType: 1,
}


def measured_bytes(df: DataFrame) -> int | None:
    """Size of ``df`` in memory, from one aggregate; ``None`` where a column has no measure."""
    fixed = _ROW_OVERHEAD
    varying: list[Column] = []
    for field in df.schema.fields:
        width = _WIDTHS.get(type(field.dataType))
        if width is not None:
            fixed += width
        elif isinstance(field.dataType, _TEXTS):
            varying.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
        else:
            return None
    per_row = reduce(lambda a, b: a + b, varying, F.lit(fixed).cast("long"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = measured_bytes(df)
    return size is not None and size <= limit


def attach(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = HOT_ROWS,
    also: Column | None = None,
) -> DataFrame:
    """Join ``right`` onto ``left`` by equal columns; ``how`` is left, inner, left_semi or left_anti.

    ``also`` narrows the match by a condition on further columns of both sides.  Columns come out in
    the order of ``left``, then what ``right`` adds.  ``hot_rows=None`` says that ``on`` identifies a
    left row, so that no key can be hot.  ``right`` is read twice, once to be measured: write it
    first where it is costly to compute.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"attach cannot do a {how!r} join")
    on = list(on)
    if fits_broadcast(right, broadcast_bytes):
        joined = _equal_join(left, F.broadcast(right), on, how, also)
    elif hot_rows is None:
        joined = _equal_join(left, right, on, how, also)
    else:
        joined = _spread_join(left, right, on, how, hot_rows, also)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on]
    return joined.select(*left.columns, *added)


def _equal_join(left: DataFrame, right: DataFrame, on: list[str], how: str, also: Column | None) -> DataFrame:
    if also is None:
        return left.join(right, on, how)
    keyed = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    equal = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_right_{k}") for k in on])
    return left.join(keyed, equal & also, how)


def _any_null(on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])


def hot_keys(left: DataFrame, on: Sequence[str], hot_rows: int) -> tuple[DataFrame | None, bool]:
    """Keys with more than ``hot_rows`` rows and the pieces to cut them into; whether null keys are hot.

    Keys are first counted by hash slot, which combines on the map side to a small fixed number of
    counters; exact counts are taken only within slots that are over the mark, usually none.
    """
    slot = F.when(_any_null(on), F.lit(-1)).otherwise(F.pmod(F.xxhash64(*on), F.lit(_SLOTS)).cast("int"))
    slotted = left.select(*on, slot.alias("_slot"))
    full = written_table(
        slotted.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
        .select("_slot"),
        "full-slots",
    )
    nulls_hot = not full.filter("_slot = -1").isEmpty()
    full = full.filter("_slot >= 0")
    if full.isEmpty():
        return None, nulls_hot
    hot = written_table(
        slotted.join(F.broadcast(full), "_slot", "left_semi")  # at most _SLOTS rows
        .groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
        .select(*on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_pieces")),
        "hot-keys",
    )
    return (None if hot.isEmpty() else hot), nulls_hot


def _spread_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, hot_rows: int, also: Column | None
) -> DataFrame:
    """Shuffled join with each key of more than ``hot_rows`` left rows cut into pieces.

    Where very many left rows have no key, these are left out of the shuffle: they match nothing.
    """
    hot, nulls_hot = hot_keys(left, on, hot_rows)
    if not nulls_hot:
        return _cut_join(left, right, on, how, hot, also)
    keyed = _cut_join(left.filter(~_any_null(on)), right, on, how, hot, also)
    if how in ("inner", "left_semi"):
        return keyed
    return keyed.unionByName(left.filter(_any_null(on)), allowMissingColumns=True)


def _cut_join(left: DataFrame, right: DataFrame, on: list[str], how: str, hot: DataFrame | None, also: Column | None) -> DataFrame:
    """The join with the rows of each key of ``hot`` dealt to its pieces.

    The piece of a row depends on its content and on the partition it comes from, both the
    same when a lost task is run again; exact copies in different partitions still spread.
    """
    if hot is None:
        return _equal_join(left, right, on, how, also)
    hashable = [f.name for f in left.schema.fields if type(f.dataType) in _WIDTHS or type(f.dataType) in _TEXTS]
    spread = F.xxhash64(F.spark_partition_id(), *hashable)
    # as many rows as the left side has hot keys; measured all the same
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    left = left.join(hot, on, "left")
    right = right.filter(~_any_null(on)).join(hot, on, "left")
    piece = F.when(F.col("_pieces").isNotNull(), F.pmod(spread, F.col("_pieces"))).otherwise(F.lit(0)).cast("int")
    every_piece = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    left = left.withColumn("_piece", piece).drop("_pieces")
    right = right.withColumn("_piece", every_piece).drop("_pieces")
    return _equal_join(left, right, [*on, "_piece"], how, also)


def stack_rows(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def key_range(rows: DataFrame, on: Sequence[str]) -> Column | None:
    """A condition on stored keys that holds wherever a key of ``rows`` may be found; nothing if there is no row.

    A least and a largest value per key column, so that the scan can leave out files and row groups beyond them.
    """
    ends = rows.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in on for f in (F.min, F.max)]).first()
    if any(v is None for v in ends):
        return None
    return reduce(lambda a, b: a & b, [F.col(k).between(F.lit(ends[f"min_{k}"]), F.lit(ends[f"max_{k}"])) for k in on])


def drop_existing(
    rows: DataFrame, stored: DataFrame, on: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES, **limits: int
) -> DataFrame:
    """Rows whose key is not stored yet; in a key, a null equals a null.

    Only stored keys in the range of the rows' own are read.  A batch that fits is sent to them, so that they are not
    shuffled and only the keys found on both sides come back.  The keys of a larger batch meet the stored ones in a shuffle
    of keys alone, and the rows are then looked up among the keys that are missing: sent to them where they fit.
    ``rows`` are read several times: write them first where they are costly to compute.  What is read from ``stored`` is
    written, so the result may go into the very table.
    """
    whole = ~_any_null(on)
    holed, rows = rows.filter(~whole), rows.filter(whole)
    without = not holed.isEmpty()
    if without:
        other = stored.select(*[F.col(c).alias(f"_stored_{c}") for c in on]).filter(_any_null([f"_stored_{c}" for c in on]))
        equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_stored_{c}")) for c in on])
        holed = written_table(holed.join(other.distinct(), equal, "left_anti"), "rows-without-key")
    near = key_range(rows, on)
    if near is None:
        return holed
    arriving, known = rows.select(*on), stored.filter(near).select(*on)
    if fits_broadcast(arriving, broadcast_bytes):
        found = known.join(F.broadcast(arriving), list(on), "left_semi")
        fresh = attach(rows, written_table(found.distinct(), "keys-found"), on, "left_anti", broadcast_bytes, **limits)
    else:
        missing = written_table(attach(arriving.distinct(), known, on, "left_anti", broadcast_bytes, hot_rows=None), "keys-missing")
        fresh = attach(rows, missing, on, "left_semi", broadcast_bytes, **limits)
    return fresh.unionByName(holed) if without else fresh


def referenced_rows(
    rows: DataFrame, reference: DataFrame, matching: Mapping[str, str], tuple_match: bool = False, **limits: int
) -> DataFrame:
    """Rows that ``reference`` refers to; ``matching`` maps a column of ``rows`` to one of ``reference``.

    Each column is tested on its own unless ``tuple_match`` asks for the combination.
    """
    groups = [list(matching)] if tuple_match else [[column] for column in matching]
    for columns in groups:
        keys = reference.select(*[F.col(matching[c]).alias(c) for c in columns]).distinct()
        keys = written_table(keys, "referenced-keys")
        rows = attach(rows, keys, columns, "left_semi", **limits)
    return rows


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two rows share a key."""
    if not rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").isEmpty():
        raise ValueError(f"several rows share one key of {list(keys)}")


def update_columns(
    target: DataFrame, values: DataFrame, keys: Sequence[str], columns: Sequence[str], **limits: int
) -> DataFrame:
    """Give ``columns`` of ``target`` the value found in ``values`` under the same keys.

    A match sets the value even when it is null; rows without a match keep theirs; nothing is
    inserted.  Two value rows with one key are an error, since neither could be preferred.
    """
    values = written_table(values.select(*keys, *columns), "new-values")
    require_unique(values, keys)
    renamed = values.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched")
    )
    joined = attach(target, renamed, keys, "left", **limits)
    return joined.select(*[
        F.when(F.col("_matched"), F.col(f"_new_{c}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c)
        for c in target.columns
    ])
