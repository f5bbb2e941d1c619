"""Merkle manifest of a table: one root that vouches for every row, and a proof for each row.

Leaves are SHA-256 digests of a row's fields. The leaves of a group (a source) form a tree of
fan-out ``FAN``; the groups' roots form a tree of the same kind, whose root is the table's.

Only every ``STRIDE``-th level is stored. A proof needs the levels between as well: for each
aligned subtree of ``FAN ** STRIDE`` stored nodes these are hashed again from the stored nodes,
their siblings are handed out, and they are dropped. Work goes from the top down: the siblings
above a stored node are found once and shared by the whole subtree below it, so a row costs its
own two levels and one join with the stored level above, which is ``FAN ** STRIDE`` times smaller.

A group may hold any share of the rows. Rows are placed by a sort over (group, order, leaf) cut
into ranges; a range knows its own counts and the ranges' counts are added up, so no group is
ever in one task. Every later step works on aligned subtrees of at most 256 nodes.

Rules for odd rows: a null field counts as ``-``; a null group is a group of its own, the first
one; null order values come first; rows with equal order values are ordered by their leaf
digests, and equal leaves have equal proofs; texts of any length are hashed whole; an empty
table has no root and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifeloom.llm.tables import columns, keep, partitions

FAN = 16
STRIDE = 2
BLOCK = FAN**STRIDE
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def group_key(group: Column) -> Column:
    """A text that sorts null first and else bytewise, and is never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` (grp, node, …) with ``pos``, the place in its group from 0, and ``n``, the group's size.

    Ties of ``order`` are settled by the node. Rows are sorted in ranges; a range that many equal
    rows would make too long is cut by the row's number in the input.
    """
    spark = nodes.sparkSession
    by = ["grp", *order, "node", "_at"]
    ranged = (
        nodes.withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange(max(partitions(spark), 2), *by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ranged = keep(ranged, name)
    part = F.shiftright("_at", 33).alias("_part")
    counts = ranged.groupBy("grp", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    by_group = Window.partitionBy("grp")
    before = by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "grp",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(by_group).alias("n"),
    )
    rows = ranged.withColumn("_part", part).join(offsets, ["grp", "_part"])
    return rows.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def runs(nodes: Column) -> Column:
    """The nodes one level up: a digest for every ``FAN`` consecutive nodes."""
    starts = F.sequence(F.lit(0), ((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(starts, lambda i: digest(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), "")))


def blocks(level: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Aligned subtrees of a stored level: grp, block, n, ``rows`` in order and ``nodes``."""
    rows = F.sort_array(F.collect_list(F.struct("pos", "node", *carry)))
    grouped = level.groupBy("grp", F.expr(f"pos div {BLOCK}").alias("block")).agg(rows.alias("rows"), F.max("n").alias("n"))
    return grouped.withColumn("nodes", F.col("rows.node"))


def level_above(level: DataFrame) -> DataFrame:
    """The next stored level of all groups that are not down to one node yet."""
    up = blocks(level.filter("n > 1").select("grp", "pos", "node", "n")).withColumn("once", runs(F.col("nodes")))
    small = F.col("n") <= FAN
    return up.select(
        "grp",
        F.col("block").alias("pos"),
        F.when(small, F.get("once", F.lit(0))).otherwise(digest(F.array_join("once", ""))).alias("node"),
        F.when(small, F.lit(1)).otherwise(F.ceil(F.col("n") / BLOCK)).cast("long").alias("n"),
    )


def beside(nodes: Column, at: Column) -> Column:
    """What stands left and right of the node ``at`` within its run of ``FAN``."""
    begin = at - at % FAN
    return F.struct(
        F.array_join(F.slice(nodes, begin + 1, at - begin), "").alias("left"),
        F.array_join(F.slice(nodes, at + 2, begin + (FAN - 1) - at), "").alias("right"),
    )


def siblings(level: DataFrame, above: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """grp, pos, node, ``carry`` and ``path``: the siblings of each node from its level to the root.

    ``above`` has grp, pos and path of the next stored level, and of single nodes of this one.
    """
    block = blocks(level, carry).withColumn("once", F.when(F.col("n") > FAN, runs(F.col("nodes"))))
    target = F.when(F.col("n") > 1, F.col("block")).otherwise(F.lit(-1))
    a = above.select(F.col("grp").alias("_grp"), F.col("pos").alias("_pos"), F.col("path").alias("_above"))
    joined = block.join(a, (F.col("grp") == F.col("_grp")) & (target == F.col("_pos")))
    rows = joined.select("grp", "n", "nodes", "once", "_above", F.posexplode("rows").alias("_at", "r"))
    own = F.array(beside(F.col("nodes"), F.col("_at")))
    next_up = F.array(beside(F.col("once"), F.expr(f"_at div {FAN}")))
    path = (
        F.when(F.col("n") == 1, F.col("_above"))
        .when(F.col("n") <= FAN, F.concat(own, F.col("_above")))
        .otherwise(F.concat(own, next_up, F.col("_above")))
    )
    return rows.select("grp", "r.*", path.alias("path"))


def folded(node: Column, path: Column) -> Column:
    """The root that a node and the siblings on its path give."""
    return F.aggregate(path, node, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on the path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


@dataclass
class Tree:
    """Stored levels of the trees of all groups; ``levels[0]`` holds what was put in."""

    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """grp and node: the root of each group."""
        found = self.levels[0].filter("n = 1").select("grp", "node")
        for level in self.levels[1:]:
            found = found.unionByName(level.filter("n = 1").select("grp", "node"))
        return found

    def paths(self, top: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """grp, pos, node, ``carry`` and path of every node put in.

        ``top`` has grp and path: what stands beside and above each group's root.
        """
        ends = top.select("grp", F.lit(-1).cast("long").alias("pos"), "path")
        above = ends
        for k in range(len(self.levels) - 1, -1, -1):
            found = siblings(self.levels[k], above, carry if k == 0 else ())
            if k:
                above = keep(found.select("grp", "pos", "path"), "paths").unionByName(ends)
        return found


def tree(nodes: DataFrame, order: Sequence[str], name: str) -> Tree:
    """Store every ``STRIDE``-th level of the trees over ``nodes`` (grp, node, …)."""
    levels = [keep(placed(nodes, order, f"{name}_sorted"), f"{name}_leaves")]
    n = levels[0].agg(F.max("n")).first()[0] or 1
    while n > 1:
        levels.append(keep(level_above(levels[-1]), f"{name}_level"))
        n = 1 if n <= FAN else -(-n // BLOCK)
    return Tree(levels)


@dataclass
class Manifest:
    """The stored levels of a table's manifest.

    ``groups`` has the trees of the groups, ``top`` the tree over their roots.
    """

    groups: Tree
    top: Tree

    def root(self) -> DataFrame:
        return self.top.roots().select(F.col("node").alias("root"))

    def proofs(self, carry: Sequence[str] = ()) -> DataFrame:
        """grp, subroot, root, pos, node (the leaf), ``carry`` and path of every row."""
        one = F.array().cast("array<struct<left:string,right:string>>")
        ends = self.root().select(F.lit("").alias("grp"), one.alias("path"))
        tops = self.top.paths(ends, ["member"]).select(F.col("member").alias("grp"), F.col("node").alias("subroot"), "path")
        tops = keep(tops.crossJoin(F.broadcast(self.root())), "subroots")  # the root is one row
        leaves = self.groups.paths(tops.select("grp", "path"), carry)
        return leaves.join(tops.select("grp", "subroot", "root"), "grp")


def manifest(leaves: DataFrame, order: Sequence[str]) -> Manifest:
    """The manifest over ``leaves``: grp (see :func:`group_key`), node and the columns of ``order``."""
    groups = tree(leaves, order, "manifest")
    roots = groups.roots().select(F.lit("").alias("grp"), F.col("grp").alias("member"), "node")
    return Manifest(groups, tree(roots, ["member"], "manifest_top"))


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def document_leaves(docs: DataFrame) -> DataFrame:
    """grp, doc_id and node: a leaf for every document; ``tampered`` is the digest after tampering.

    Where 5 divides the CRC-32 of the doc_id, the tampered text has its A-Z in lower case;
    elsewhere, and where doc_id is null, ``tampered`` is null.
    """
    rows = columns(docs, *FIELDS)
    altered = [lowered(F.col(f)) if f == "text" else F.col(f) for f in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return rows.select(
        group_key(F.col("source")).alias("grp"),
        "doc_id",
        leaf_digest([F.col(f) for f in FIELDS]).alias("node"),
        F.when(hit, leaf_digest(altered)).alias("tampered"),
    )


def verified(docs: DataFrame) -> DataFrame:
    """Every document's leaf, roots and proof, and whether its tampered form still proves itself."""
    made = manifest(document_leaves(docs), ["doc_id"])
    rows = made.proofs(["doc_id", "tampered"])
    again = folded(F.coalesce("tampered", "node"), F.col("path"))
    out = rows.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
