"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree over blocks.

Each source is dealt into blocks by a hash of its documents, a quarter of the square root of all documents in number, so
neither a block nor the list of a source's blocks gets long.  Blocks stand in a permuted order; a source draws whole
rounds of them and then a prefix of one more round, up to its target of words.  How many of the drawn blocks go
to which output shard is decided by a tree: each node splits its exact quota of every source between its two
children, with the hypergeometric law that drawing without replacement has.  Shards then take disjoint runs of
the permuted blocks and order their documents by a hash.  All of it is DataFrame operations.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from shelfcast.operators.joins import fits_broadcast
from shelfcast.operators.ordering import dense_position
from shelfcast.shared import written_table

WORD_BREAKS = r"[\x20\x09-\x0D]+"
BROADCAST_BYTES = 16 * 1024 * 1024
#: Words that a shard of the written mix holds, about, once there are more than its fixed number of shards would take.
SHARD_WORDS = 4_000_000


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code-point order, null last; together the targets hold
    ``percent`` of all words, no target more than ``rounds`` times its source."""

    weights: tuple[int, ...] = (3, 1, 2)
    percent: int = 150
    rounds: int = 2
    shards: int = 32
    seed: int = 17


def word_count(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAKS), "")
    return F.size(words).cast("long")


def _key(docs: DataFrame, text: str, source: str, doc_id: str) -> Column:
    """A document's identity: rows equal in number, source and text are one unit and share one fate."""
    return F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{source}`"), F.col(f"`{text}`"))


def _block(key: str, mix: Mix, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(mix.seed), F.col(key)), F.lit(blocks)).cast("int")


def source_targets(totals: DataFrame, mix: Mix) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source; only sums come to the driver."""
    placed = dense_position(totals, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), F.pmod("_place", F.lit(len(mix.weights))).cast("int") + 1)
    weighed = written_table(placed.select("source", "source_size", weight.cast("long").alias("_weight")), "weights")
    full = F.col("source_size") * mix.rounds
    share, held = 0.0, -1
    while True:  # as many rounds as there are levels of excess; each adds at least one full source
        above = full <= F.col("_weight") * F.lit(share)
        sums = weighed.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"), F.count(F.when(above, 1)).alias("held"),
            F.coalesce(F.sum(F.when(above, full)), F.lit(0)).alias("held_size"),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0)).alias("open_weight"),
        ).first()
        if sums["held"] == held or not sums["open_weight"]:
            break
        held, share = sums["held"], (sums["all"] * mix.percent / 100 - sums["held_size"]) / sums["open_weight"]
    return weighed.select(
        "source", "source_size", F.least(full.cast("double"), F.col("_weight") * F.lit(float(share))).alias("target")
    )


def _log_factorial(n: Column) -> Column:
    """By Stirling's series, seven places up, where it is exact to about 1e-12."""
    z = n + 8.0
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    product = (n + 1.0) * (n + 2.0) * (n + 3.0) * (n + 4.0) * (n + 5.0) * (n + 6.0) * (n + 7.0)
    return series - F.log(product)


def hypergeometric(total: Column, good: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``good`` ones: inverse of the distribution at ``uniform``.

    The sum runs over 14 standard deviations to either side of the mean, beyond which nothing is left.
    """
    n, k, m = total.cast("double"), good.cast("double"), drawn.cast("double")
    mean = F.when(n > 0, m * k / n).otherwise(0.0)
    spread = F.when(n > 1, 14 * F.sqrt(mean * (1 - k / n) * (n - m) / (n - 1))).otherwise(0.0) + 8
    low = F.greatest(F.lit(0.0), m + k - n, F.floor(mean - spread).cast("double")).cast("long")
    high = F.least(k, m, F.ceil(mean + spread).cast("double")).cast("long")
    # choose(k, low) * choose(n - k, m - low) / choose(n, m)
    above, below = (k, n - k, m, n - m), (low.cast("double"), k - low, m - low, n - k - m + low, n)
    terms = F.array(*[F.struct(F.lit(s).alias("sign"), x.alias("of")) for s, xs in ((1.0, above), (-1.0, below)) for x in xs])
    first = F.exp(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["sign"] * _log_factorial(t["of"])))

    def step(state: Column, x: Column) -> Column:
        below = state["sum"] + state["mass"]
        ratio = (k - x) * (m - x) / ((x + 1.0) * (n - k - m + x + 1.0))
        return F.struct(
            (state["mass"] * ratio).alias("mass"), below.alias("sum"),
            (state["got"] + F.when(below < uniform, 1).otherwise(0)).cast("long").alias("got"),
        )

    start = F.struct(first.alias("mass"), F.lit(0.0).alias("sum"), low.alias("got"))
    reached = F.aggregate(F.sequence(low, F.greatest(low, high - 1)), start, step)["got"]
    return F.when((good == 0) | (drawn == 0), F.lit(0).cast("long")).when(low >= high, low).otherwise(reached)


def _split(mix: Mix) -> Column:
    """Quotas of the left child, from columns ``node``, ``left`` (its quota of blocks) and ``quotas`` of the parent."""
    whole = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
    start = F.struct(
        whole.alias("total"), F.col("left").alias("open"), F.array().cast("array<bigint>").alias("taken"),
    )

    def step(state: Column, quota: Column) -> Column:
        bits = F.pmod(F.xxhash64(F.lit(mix.seed), F.col("node"), F.size(state["taken"])), F.lit(1 << 52))
        uniform = (bits.cast("double") + 0.5) / float(1 << 52)
        got = hypergeometric(state["total"], quota, state["open"], uniform)
        return F.struct(
            (state["total"] - quota).alias("total"), (state["open"] - got).alias("open"),
            F.concat(state["taken"], F.array(got)).alias("taken"),
        )

    return F.aggregate("quotas", start, step)["taken"]


def split_quotas(quotas: DataFrame, mix: Mix) -> DataFrame:
    """``quotas`` (``source``, ``draws``) dealt to the shards: ``source``, ``shard``, ``first``, ``draws``.

    A node of the tree is one row with a number per source, which bounds it by the number of sources.
    ``first`` is the number of the source's first block in the shard.
    """
    listed = quotas.agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "draws"))).alias("all"))
    sources = written_table(listed.filter(F.size("all") > 0), "quotas")
    nodes = sources.select(
        F.lit(1).cast("long").alias("node"), F.lit(0).alias("shard"), F.lit(mix.shards).alias("shards"),
        F.col("all.draws").alias("quotas"),
    )
    for _ in range(math.ceil(math.log2(max(mix.shards, 1)))):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        half = F.floor(F.col("shards") / 2).cast("int")
        cut = nodes.withColumn("half", half).withColumn("left", F.floor(total * F.col("half") / F.col("shards")).cast("long"))
        cut = cut.withColumn("taken", F.when(F.col("shards") > 1, _split(mix)))
        children = F.when(
            F.col("shards") > 1,
            F.array(
                F.struct((F.col("node") * 2).alias("node"), "shard", F.col("half").alias("shards"), F.col("taken").alias("quotas")),
                F.struct(
                    (F.col("node") * 2 + 1).alias("node"), (F.col("shard") + F.col("half")).alias("shard"),
                    (F.col("shards") - F.col("half")).alias("shards"),
                    F.zip_with("quotas", "taken", lambda q, t: q - t).alias("quotas"),
                ),
            ),
        ).otherwise(F.array(F.struct("node", "shard", "shards", "quotas")))
        nodes = written_table(cut.select(F.inline(children)), "tree")
    dealt = nodes.select("shard", F.posexplode("quotas").alias("_at", "draws"))
    names = sources.select(F.posexplode("all").alias("_at", "_source")).select("_at", F.col("_source.source").alias("source"))
    before = W.partitionBy("_at").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return dealt.join(names, "_at").select(
        "source", "shard", F.coalesce(F.sum("draws").over(before), F.lit(0)).alias("first"), "draws"
    )


@dataclass(frozen=True)
class Draw:
    """What a mix takes: ``targets`` by source, ``blocks`` with the shards of each, ``rest`` of the last blocks."""

    targets: DataFrame
    blocks: DataFrame
    rest: DataFrame
    n_blocks: int


def same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null, by hash of all of them first; null equals null."""
    other = right.withColumnsRenamed({c: f"_other_{c}" for c in on})
    equal = [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in on]
    condition = equal[0]
    for e in equal[1:]:
        condition &= e
    return left.join(other, condition, how).drop(*[f"_other_{c}" for c in on])


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast once its bytes have been measured and found few; else joined by shuffle."""
    return F.broadcast(df) if fits_broadcast(df, BROADCAST_BYTES) else df


def draw(units: DataFrame, mix: Mix) -> Draw:
    """Decide from ``units`` (``key``, ``source``, ``size``, one per document) what the mix takes."""
    rows = units.count()
    n_blocks = max(1, math.isqrt(rows) // 4)  # few enough for small sources to have some documents in each
    dealt = units.withColumn("block", _block("key", mix, n_blocks))
    blocks = written_table(dealt.groupBy("source", "block").agg(F.sum("size").alias("block_size")), "blocks")
    totals = blocks.groupBy("source").agg(F.sum("block_size").alias("source_size"))
    targets = written_table(source_targets(totals, mix), "targets")
    order = W.partitionBy("source").orderBy(F.xxhash64(F.lit(mix.seed), "block"), "block")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    # at most one row per block of a source in a window: the square root of all documents
    ranked = same(blocks, _small(targets), ["source"]).withColumns({
        "place": F.row_number().over(order) - 1, "end": F.sum("block_size").over(so_far), "rounds": whole,
        "n": F.count(F.lit(1)).over(W.partitionBy("source")),
    }).withColumn("open", F.col("target") - F.col("rounds") * F.col("source_size"))
    ranked = ranked.withColumn("left", F.col("open") - (F.col("end") - F.col("block_size")))
    ranked = written_table(ranked.withColumn("part", F.when(F.col("end") <= F.col("open"), "whole").when(F.col("left") > 0, "part")), "ranked")
    drawn = ranked.select("source", "block", F.explode(F.concat(
        F.when(F.col("rounds") > 0, F.transform(
            F.sequence(F.lit(0), F.greatest(F.col("rounds") - 1, F.lit(0))),
            lambda c: F.struct(c.alias("copy"), (c * F.col("n") + F.col("place")).cast("long").alias("number"), F.lit(False).alias("part")),
        )).otherwise(F.array().cast("array<struct<copy:int,number:bigint,part:boolean>>")),
        F.when(F.col("part").isNotNull(), F.array(F.struct(
            F.col("rounds").alias("copy"), (F.col("rounds") * F.col("n") + F.col("place")).cast("long").alias("number"),
            (F.col("part") == "part").alias("part"),
        ))).otherwise(F.array().cast("array<struct<copy:int,number:bigint,part:boolean>>")),
    )).alias("draw")).select("source", "block", "draw.*")
    quotas = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("draws"))
    shards = split_quotas(quotas, mix).filter("draws > 0").select(
        "source", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("draws") - 1)).alias("number")
    )
    placed = same(drawn, shards, ["source", "number"])
    taken = placed.groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("copy", "shard", "part"))).alias("draws")  # one per round at most
    )
    taken = written_table(taken, "drawn")
    ends = ranked.filter("part = 'part'").select("source", "block", "left")
    return Draw(targets, taken, written_table(_rest(dealt, ends), "rest"), n_blocks)


def _rest(dealt: DataFrame, ends: DataFrame) -> DataFrame:
    """Keys taken from the last block of each source: the largest documents first, as long as they fit."""
    inside = same(dealt, _small(ends), ["source", "block"])
    listed = inside.groupBy("source", "block").agg(  # one block per source
        F.first("left").alias("left"), F.sort_array(F.collect_list(F.struct("size", "key")), asc=False).alias("all")
    )
    start = F.struct(F.col("left").alias("left"), F.array().cast("array<bigint>").alias("keys"))

    def step(state: Column, unit: Column) -> Column:
        fits = unit["size"] <= state["left"]
        return F.struct(
            F.when(fits, state["left"] - unit["size"]).otherwise(state["left"]).alias("left"),
            F.when(fits, F.concat(state["keys"], F.array(unit["key"]))).otherwise(state["keys"]).alias("keys"),
        )

    return listed.select("source", "block", F.explode(F.aggregate("all", start, step)["keys"]).alias("key"))


def units_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size`` and ``key`` of each row, written once."""
    return written_table(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"), _key(docs, text, source, doc_id).alias("key"),
    ), "units")


def with_draws(rows: DataFrame, found: Draw, mix: Mix) -> DataFrame:
    """Add ``draws`` (copy and shard of each time it is taken) to rows that have ``source`` and ``key``."""
    dealt = rows.withColumn("_block", _block("key", mix, found.n_blocks))
    joined = same(dealt, _small(found.blocks.select("source", F.col("block").alias("_block"), "draws")), ["source", "_block"], "left")
    chosen = found.rest.select("key", F.col("block").alias("_block"), F.lit(True).alias("_chosen")).distinct()
    joined = same(joined, _small(chosen), ["key", "_block"], "left")
    none = F.array().cast("array<struct<copy:int,shard:int,part:boolean>>")
    return joined.withColumn(
        "draws", F.filter(F.coalesce("draws", none), lambda d: ~d["part"] | F.coalesce(F.col("_chosen"), F.lit(False)))
    ).drop("_chosen", "_block")


def mixed_sizes(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id size source_size target taken``.

    A null text has no words and is taken like any document of size 0; a null source is a source of its own,
    last in order; rows equal in number, source and text share one fate; an empty table gives no rows.
    """
    mix = mix or Mix()
    units = units_of(docs)
    found = draw(units, mix)
    rows = same(with_draws(units, found, mix), _small(found.targets), ["source"])
    return rows.select("doc_id", "size", "source_size", "target", (F.size("draws") * F.col("size")).alias("taken"))


def shards_for(words: int, mix: Mix) -> int:
    """How many shards a corpus of so many words is dealt to: the mix's own number, or more of bounded size."""
    return max(mix.shards, -(-(words * mix.percent // 100) // SHARD_WORDS))


def mixed(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as drawn, one partition per shard, shuffled inside it.

    Written, each shard is a file whose rows stand in the mix's order (:func:`written_order`).  Odd rows as in
    :func:`mixed_sizes`; columns pass through, whatever their names.
    """
    mix = mix or Mix()
    units = units_of(docs)
    mix = replace(mix, shards=shards_for(units.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], mix))
    found = draw(units, mix)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("source"),
        _key(docs, "text", "source", "doc_id").alias("key"),
    )
    drawn = with_draws(rows, found, mix).select("_row", "key", F.explode("draws").alias("_draw"))
    ordered = drawn.withColumn("_at", F.xxhash64(F.lit(mix.seed), "key", "_draw.copy"))
    dealt = ordered.repartitionById(mix.shards, F.col("_draw.shard").cast("int"))
    return dealt.sortWithinPartitions("_draw.shard", "_at").select("_row.*")


def written_order(docs: DataFrame) -> Column | None:
    """The place of a row in the files that ``docs`` is read from, file by file; nothing if it is no plain scan of files."""
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        docs.select(file, row)
    except AnalysisException:
        return None
    return F.shiftleft(F.regexp_extract(file, r"part-(\d+)", 1).cast("long"), 40) + row
