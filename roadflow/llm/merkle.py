"""Merkle manifest of a table: a digest a row, a tree of digests by group, one root, and a checked proof for every row.

Each value of a tree column (``lang``) has a tree over its rows in the order of a key; the trees' roots have a tree of
their own. Trees are cut into superblocks of ``8 ** 4`` consecutive nodes. Going up, a superblock is reduced to its root by
built-in expressions, round after round, until each tree is one node. Going down, the nodes of a superblock and the outer
nodes that their proofs need (the siblings on the way from the superblock's root to the top: two texts a level) are
cogrouped by superblock; there the local reduction is finished, proofs are joined and folded. No group is larger than
a superblock, whatever a tree holds.

Nulls in any field have a digest of their own (`-`); null trees and null keys come first. Rows of equal tree and key follow
each other by digest; rows that are equal in all fields have equal digests and are leaves each. An empty table gives an
empty manifest. Other columns of the table don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stage

#: Children of a node; levels of a superblock.
ARITY, LEVELS = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
OUT = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def framed(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(v) for v in values]).cast("binary"), 256)


def leaves(rows: DataFrame, fields: Sequence[str], tree: str, key: str, changes: Mapping[str, Column], where: Column) -> DataFrame:
    """``tree, key, hash, changed``: a row's digest and, where the condition holds, that of the row with ``changes``."""
    own = {f: F.col(f"`{f}`") for f in fields}
    changed = F.when(where, digest([changes.get(f, c) for f, c in own.items()]))
    return rows.select(F.col(f"`{tree}`").alias("tree"), F.col(f"`{key}`").alias("key"), digest(list(own.values())).alias("hash"), changed.alias("changed"))


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0) within their group and ``n``, the group's rows. One sort by range; places follow from
    the number of a row in its partition and the counts of each group in each partition, so that a group may span many."""
    at = stage(rows.orderBy(group, *order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    counts = stage(at.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_c")), "counts")
    w = Window.partitionBy(group)
    before = F.coalesce(F.sum("_c").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select(F.col(group).alias("_group"), "_part", "_first", before.alias("_base"), F.sum("_c").over(w).alias("n"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part"))
    return at.join(base, same).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_base")).drop("_at", "_group", "_part", "_first", "_base")


def _up(nodes: Column) -> Column:
    """Every ARITY consecutive digests become the digest of their texts."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(nodes, i, ARITY), "").cast("binary"), 256))


def superblocks(nodes: DataFrame, levels: int) -> DataFrame:
    """The roots of all superblocks of ``nodes(tree, n, pos, hash)``, as nodes again."""
    size = ARITY**levels
    lists = F.transform(F.sort_array(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"])
    out = nodes.groupBy("tree", "n", F.floor(F.col("pos") / size).alias("pos")).agg(lists.alias("nodes"))
    for k in range(levels):
        out = out.withColumn("nodes", F.when(F.col("n") > ARITY**k, _up(F.col("nodes"))).otherwise(F.col("nodes")))
    return out.select("tree", F.ceil(F.col("n") / size).alias("n"), "pos", F.col("nodes")[0].alias("hash"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _siblings(hashes: list[str], n: int, levels: int) -> tuple[list[list[tuple[str, str]]], str]:
    """For each level of a superblock what stands before and after each node in its run, and the superblock's root."""
    out = []
    for k in range(levels):
        if n <= ARITY**k:
            break
        runs = [hashes[i : i + ARITY] for i in range(0, len(hashes), ARITY)]
        out.append([("".join(run[:j]), "".join(run[j + 1 :])) for run in runs for j in range(len(run))])
        hashes = [_sha("".join(run)) for run in runs]
    return out, hashes[0]


def _ways(hashes: list[str], n: int, levels: int) -> Iterable[list[tuple[str, str]]]:
    """The way of each node to its superblock's root: siblings before and after it, level by level."""
    sides, _ = _siblings(hashes, n, levels)
    return ([side[i // ARITY**k] for k, side in enumerate(sides)] for i in range(len(hashes)))


def outer_nodes(nodes: DataFrame, upper: DataFrame | None, levels: int) -> DataFrame:
    """``tree, pos, level, before, after, subroot``: the siblings of every node on its way to the top. ``upper`` has
    those of the superblocks' roots."""

    def ways(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, above = own.sort_values("pos"), above.sort_values("level")
        rows = []
        for pos, way in zip(own["pos"], _ways(own["hash"].tolist(), int(own["n"].iloc[0]), levels), strict=True):
            subroot = above["subroot"].iloc[0] if len(above) else None
            rows += [(own["tree"].iloc[0], pos, level, before, after, subroot) for level, (before, after) in enumerate(way)]
            rows += [(own["tree"].iloc[0], pos, level + levels, before, after, subroot) for level, before, after in zip(above["level"], above["before"], above["after"], strict=True)]
        return pd.DataFrame(rows, columns=["tree", "pos", "level", "before", "after", "subroot"])

    size = ARITY**levels
    own = nodes.withColumn("block", F.floor(F.col("pos") / size))
    return stage(own.groupBy("tree", "block").cogroup(_above(nodes, upper).groupBy("tree", "block")).applyInPandas(ways, "tree long, pos long, level int, before string, after string, subroot string"), "outer")


def _above(nodes: DataFrame, upper: DataFrame | None) -> DataFrame:
    if upper is None:
        return nodes.sparkSession.createDataFrame([], "tree long, block long, level int, before string, after string, subroot string")
    return upper.withColumnRenamed("pos", "block")


def _rounds(nodes: DataFrame, most: int, levels: int) -> list[DataFrame]:
    """``nodes`` and the roots of their superblocks, of those' superblocks and so on, until each tree is one node."""
    out = [nodes]
    while True:
        out.append(stage(superblocks(out[-1], levels), "blocks"))
        most = -(-most // ARITY**levels)
        if most <= 1:
            return out


def manifest(
    rows: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", key: str = "doc_id", changes: Mapping[str, Column] | None = None, where: Column | None = None, levels: int = LEVELS
) -> DataFrame:
    """One row for each of ``rows``: ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the digest of the fields; each tree of leaves ends in its subroot, the tree of subroots (by the tree column,
    null first) in the root. The proof of a row is the siblings of its way to the root; ``proof_sha256`` is the digest of
    them all, level by level, left to right. ``folded_root`` is what the row's digest (that of the changed row, where
    ``where`` holds: ``changes`` replace its fields) gives with the proof, ``verified`` whether it is the root.
    """
    kind = rows.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    hashed = stage(leaves(rows, fields, tree, key, changes or {}, F.lit(False) if where is None else where), "leaves")
    sized = placed(hashed, "tree", ["key", "hash"])
    trees = stage(placed(sized.groupBy("tree").agg(F.max("n").alias("rows")).withColumn("all", F.lit(0)), "all", ["tree"]), "trees")
    count, most = trees.agg(F.count("*"), F.max("rows")).head()
    if not count:
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind}, {OUT}")
    ranks = trees.select(F.col("tree").alias("_tree"), F.col("pos").alias("_rank"))
    leafs = stage(sized.join(ranks, F.col("tree").eqNullSafe(F.col("_tree"))).select(F.col("_rank").alias("tree"), "n", "pos", F.col("key").cast("string").alias("key"), "hash", "changed"), "placed")

    up = _rounds(leafs.select("tree", "n", "pos", "hash"), most, levels)
    subroots = up[-1]
    tops = _rounds(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("pos"), "hash"), count, levels)
    root = tops[-1].head()["hash"]

    upper = None
    for nodes in reversed(tops[:-1]):
        upper = outer_nodes(nodes, upper, levels)
    # The siblings of a subroot are the outer nodes of its tree's last superblock.
    upper = upper.drop("tree", "subroot").withColumnRenamed("pos", "tree").join(subroots.select("tree", F.col("hash").alias("subroot")), "tree").withColumn("pos", F.lit(0).cast("long"))
    for nodes in reversed(up[1:-1]):
        upper = outer_nodes(nodes, upper.select("tree", "pos", "level", "before", "after", "subroot"), levels)

    def proved(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, above = own.sort_values("pos"), above.sort_values("level")
        hashes, n = own["hash"].tolist(), int(own["n"].iloc[0])
        outer = list(zip(above["before"], above["after"], strict=True))
        tail = "".join(a + b for a, b in outer)
        subroot = above["subroot"].iloc[0] if len(above) else root  # without outer nodes the tree is all there is
        rows = []
        for leaf, changed, way in zip(hashes, own["changed"], _ways(hashes, n, levels), strict=True):
            proof = _sha("".join(a + b for a, b in way) + tail)
            folded = leaf if changed is None else changed
            for a, b in (*way, *outer):
                folded = _sha(a + folded + b)
            rows.append((leaf, subroot, root, proof, folded, folded == root))
        made = pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        made.insert(0, "key", own["key"].array)
        return made

    block = leafs.withColumn("block", F.floor(F.col("pos") / ARITY**levels))
    made = block.groupBy("tree", "block").cogroup(_above(leafs, upper).groupBy("tree", "block")).applyInPandas(proved, f"key string, {OUT}")
    return made.select(F.col("key").cast(kind).alias(key), *[c for c in made.columns if c != "key"])


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` where a third of them (3 divides the crc32 of the id) has lost its capital letters."""
    lower = F.translate(F.col("`text`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    third = F.coalesce(F.crc32(F.col("`doc_id`").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return manifest(docs, changes={"text": lower}, where=third)
