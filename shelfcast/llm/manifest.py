"""Merkle manifest of a dataset, its tree kept as nested-interval labels.

Each group of rows (one source, say) is a tree whose leaves are the rows' digests in order; every ``FAN`` neighbours,
fewer at the end, become their parent, until one node remains.  The groups' last nodes form one more tree, whose last
node is the root.  A node is labelled by the interval [lo, hi) of leaf ranks that it covers: it lies below every node
whose interval contains its own, and its siblings cover what its parent's interval has beyond its own.

Trees are raised by passes of ``LEVELS`` levels.  A pass gathers the nodes of one bucket, ``FAN ** LEVELS`` consecutive
ones of a tree at most, so a hot source is many buckets.  Proofs go down again: the nodes of a bucket are joined to
the node above them that contains their interval, which brings the rest of the way to the root.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import attach
from shelfcast.operators.ordering import dense_position
from shelfcast.shared import written_table

FAN = 3
LEVELS = 5
#: Columns of the documents table in the order they enter a leaf.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: A step of a proof: the siblings' digests before and after the node, joined.
STEP = "struct<before:string,after:string>"


def encoded(value: Column) -> Column:
    """A value as a leaf holds it: ``-`` if null, else its size in UTF-8 bytes, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256)


def _digests(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def _run(level: str, number: Column) -> Column:
    """The neighbours that make parent ``number`` of a bucket's level."""
    return F.slice(level, (number * FAN + 1).cast("int"), FAN)


def _parents(level: str) -> Column:
    """The parents of a bucket's nodes, labelled by the interval that their children cover."""
    def parent(number: Column) -> Column:
        run = _run(level, number)
        return F.struct(
            F.element_at(run, 1)["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
            F.sha2(_digests(run).cast("binary"), 256).alias("digest"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int")), parent)


def _raise(nodes: DataFrame) -> list[DataFrame]:
    """Stored passes, the lowest first: ``tree bucket size level_0 ... level_<LEVELS>`` (arrays of labelled nodes).

    ``nodes`` has ``tree rank lo hi digest size`` and perhaps ``payload``; ``size`` counts a tree's nodes, and a level
    that has one node of its tree already is passed on as it is.
    """
    width = FAN ** LEVELS
    left = nodes.agg(F.max("size")).first()[0] or 0
    passes = []
    while True:
        held = [c for c in ("rank", "lo", "hi", "digest", "payload") if c in nodes.columns]
        bucket = F.floor(F.col("rank") / width).alias("bucket")
        grouped = nodes.groupBy("tree", bucket).agg(
            F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct(*held))).alias("level_0")
        )
        plain = F.transform("level_0", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest")))
        for j in range(LEVELS):
            grouped = grouped.withColumn(
                f"level_{j + 1}", F.when(F.col("size") > FAN ** j, _parents(f"level_{j}")).otherwise(plain if j == 0 else F.col(f"level_{j}"))
            )
        passes.append(written_table(grouped, "manifest-pass"))
        left = -(-left // width)
        if left <= 1:
            return passes
        nodes = _tops(passes[-1])


def _tops(stored: DataFrame) -> DataFrame:
    """The node that each bucket of a pass has become."""
    top = F.element_at(f"level_{LEVELS}", 1)
    return stored.select(
        "tree", F.col("bucket").alias("rank"), top["lo"].alias("lo"), top["hi"].alias("hi"), top["digest"].alias("digest"),
        F.ceil(F.col("size") / FAN ** LEVELS).alias("size"),
    )


def _steps(node: Column, place: Column) -> Column:
    """Inside a bucket, the steps of a node's proof: at each level those of the run that do not contain its interval."""
    parts = []
    for j in range(LEVELS):
        run = _run(f"level_{j}", F.floor(place / FAN ** (j + 1)))
        before = F.filter(run, lambda s: s["hi"] <= node["lo"])
        after = F.filter(run, lambda s: s["lo"] >= node["hi"])
        step = F.array(F.struct(_digests(before).alias("before"), _digests(after).alias("after")))
        parts.append(F.when(F.col("size") > FAN ** j, step).otherwise(F.array().cast(f"array<{STEP}>")))
    return F.concat(*parts)


def _descend(passes: Sequence[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """The lowest nodes with ``way``, all steps to the root; ``above`` has ``tree``, ``way`` and what goes with a tree.

    Without it the last node of every tree is the root.
    """
    carried = [c for c in above.columns if c not in ("tree", "way")] if above is not None else []
    root = F.array().cast(f"array<{STEP}>").alias("way")
    joined = passes[-1].join(above, "tree") if above is not None else passes[-1].select("*", root)
    for stored in reversed(passes):
        if stored is not passes[-1]:
            top = rows.select(
                F.col("tree").alias("_tree"), F.col("rank").alias("_rank"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "way", *carried
            )
            inside = (F.col("_lo") <= F.element_at("level_0", 1)["lo"]) & (F.element_at("level_0", -1)["hi"] <= F.col("_hi"))
            joined = stored.join(top, (F.col("tree") == F.col("_tree")) & (F.col("bucket") == F.col("_rank")) & inside)
        fields = [f.name for f in stored.schema["level_0"].dataType.elementType.fields]
        placed = F.transform("level_0", lambda x, i: F.struct(
            *[x[f].alias(f) for f in fields], F.concat(_steps(x, i), F.col("way")).alias("way")
        ))
        rows = joined.select("tree", *carried, F.inline(placed))
    return rows


@dataclass
class Manifest:
    """A raised manifest: stored passes of the groups' trees and of the tree above them, and the root's digest."""

    passes: list[DataFrame]
    upper: list[DataFrame]
    root: str | None

    def nodes(self) -> DataFrame:
        """Every node: ``tree`` (null for the tree above the groups), ``level`` (0 for leaves), ``lo``, ``hi``, ``digest``."""
        found = []
        for tree, passes in ((F.col("tree"), self.passes), (F.lit(None).cast("string"), self.upper)):
            for number, stored in enumerate(passes):
                for j in range(0 if number == 0 else 1, LEVELS + 1):  # level 0 of a pass is the last of the one below
                    made = stored if j == 0 else stored.filter(F.col("size") > FAN ** (j - 1))
                    rows = made.select(tree.alias("tree"), F.lit(number * LEVELS + j).alias("level"), F.explode(f"level_{j}").alias("x"))
                    found.append(rows.select("tree", "level", "x.lo", "x.hi", "x.digest"))
        return reduce(DataFrame.unionByName, found)

    def leaves(self) -> DataFrame:
        """Every leaf: the payload's columns, ``leaf``, its tree's last node as ``subroot``, ``way`` (steps to the root)."""
        ways = _descend(self.upper)
        above = ways.select(F.col("payload.group").alias("tree"), F.col("digest").alias("subroot"), "way")
        rows = _descend(self.passes, above)
        return rows.select("payload.*", F.col("digest").alias("leaf"), "subroot", "way")


def folded(leaf: Column, way: Column) -> Column:
    """The root that a leaf and the steps of its proof give."""
    return F.aggregate(way, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]).cast("binary"), 256))


def proof_digest(way: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(way, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def group_key(source: Column) -> Column:
    """A source as a text that orders as the source does, bytewise and null first, and is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def build(
    docs: DataFrame, group: str = "source", order: str = "doc_id", columns: Sequence[str] = LEAF_COLUMNS,
    payload: Mapping[str, Column] | None = None,
) -> Manifest:
    """Raise the manifest of all rows of ``docs``.

    Rows ascend by ``order`` within their ``group`` (null first in both); rows with equal numbers by their leaves, and
    rows equal in all of ``columns`` and the payload are interchangeable leaves of their own.  Null, empty and very long
    texts are values like any other.  Other columns are not read.  An empty table has no nodes and a null root.
    ``payload`` names columns of ``docs`` to hand on beside each leaf.
    """
    kept = {order: F.col(f"`{order}`")} | dict(payload or {})
    rows = docs.select(
        group_key(F.col(f"`{group}`")).alias("tree"), leaf_digest([F.col(f"`{c}`") for c in columns]).alias("digest"),
        F.struct(*[c.alias(n) for n, c in kept.items()]).alias("payload"),
    )
    rest = [F.col("payload")[n] for n in kept if n != order]
    placed = dense_position(rows, ["tree", F.col("payload")[order], "digest", *rest], "_place")
    first = written_table(placed.groupBy("tree").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("size")), "trees")
    ranked = attach(placed, first, ["tree"]).withColumn("rank", F.col("_place") - F.col("_first"))
    leaves = ranked.select("tree", "rank", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "size", "payload")
    passes = _raise(leaves)

    subroots = dense_position(_tops(passes[-1]).select("tree", "digest"), ["tree"], "rank")
    subroots = subroots.withColumn("size", F.lit(first.count()))
    upper = _raise(subroots.select(
        F.lit("").alias("tree"), "rank", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "size",
        F.struct(F.col("tree").alias("group")).alias("payload"),
    ))
    root = _tops(upper[-1]).first()  # one tree: one row, or none
    return Manifest(passes, upper, root["digest"] if root else None)


def tampered(doc_id: Column) -> Column:
    """Which rows the check alters: those whose number's decimal text has an even checksum; a null number has none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def verify(docs: DataFrame) -> DataFrame:
    """Every row's place in the manifest of ``docs``, and whether its row as altered still leads to the root.

    Altered rows (:func:`tampered`) have lost the line ends of their texts, nothing else; a text without any, or null, is
    what it was.  Returns ``doc_id leaf subroot root proof_sha256 folded_root verified``, one row per row of ``docs``;
    repeated rows are verified one by one, rows of a null source form a tree of their own.
    """
    text = F.when(tampered(F.col("doc_id")), F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    altered = leaf_digest([text if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    manifest = build(docs, payload={"altered": altered})
    root = F.lit(manifest.root).cast("string")
    rows = manifest.leaves().select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("way")).alias("proof_sha256"),
        folded(F.col("altered"), F.col("way")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
