"""Merkle manifest of a table: a persistent tree whose versions copy only the path to a changed leaf."""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import light, stored

#: Levels of a block: 2 ** HEIGHT consecutive nodes, aligned, are one task's work.
HEIGHT = 12


def h(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class Tree:
    """Levels of ``height`` over the nodes of a block; its nodes are never changed."""

    def __init__(self, nodes: list[str], height: int):
        self.levels = [nodes]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([h(*below[i:i + 2]) for i in range(0, len(below), 2)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, i: int) -> list[str]:
        """Siblings of node ``i`` and its ancestors: ``L`` (left) or ``R`` and the digest, ``-`` for none."""
        marks = []
        for level in self.levels[:-1]:
            j = i ^ 1
            marks.append("-" if j >= len(level) else ("L" if j < i else "R") + level[j])
            i >>= 1
        return marks


def copied(digest: str, marks: list[str]) -> list[str]:
    """A version's own nodes: ``digest`` and its ancestors anew. All others are those
    of the tree, reached over ``marks``."""
    nodes = [digest]
    for mark in marks:
        side, sibling = mark[0], mark[1:]
        nodes.append(h(sibling, nodes[-1]) if side == "L" else h(nodes[-1], sibling))
    return nodes


def height(n: int) -> int:
    """Levels that a block of a group of ``n`` nodes has."""
    return min(HEIGHT, (n - 1).bit_length())


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value (numbers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(fields: list[Column]) -> Column:
    """The leaf of a row as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(f) for f in fields]), 256))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order`` within ``grp``) and ``n`` (rows of ``grp``).

    A range sort whose last key is the row's number, so that equal rows are split
    too; the offsets are a row for each sorted partition and group in it.
    """
    placed = rows.withColumn("__row", F.monotonically_increasing_id())
    keys = ["grp", *order, "__row"]
    placed = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
    placed = stored(placed.withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.spark_partition_id()), "leaves")
    runs = placed.groupBy("grp", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("grp").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn(
        "n", F.sum("__n").over(Window.partitionBy("grp"))).drop("__n")
    out = placed.join(light(runs), ["grp", "__part"])
    return out.withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__part", "__first", "__before")


def block() -> Column:
    return F.shiftright("pos", HEIGHT).alias("block")


def climb(nodes: DataFrame) -> DataFrame:
    """``grp``, ``pos``, ``n``, ``digest`` of the nodes that are the blocks' tops."""
    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        tree = Tree([d.hex() for d in rows.sort_values("pos")["digest"]], height(n))
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n >> HEIGHT)],
                             "digest": [bytes.fromhex(tree.top)]})

    return (nodes.select("grp", "pos", "n", "digest").groupBy("grp", block())
            .applyInPandas(top, "grp string, pos long, n long, digest binary"))


def levels(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and, block by block, the levels over it up to one node a group."""
    out = [nodes]
    widest = nodes.agg(F.max("n")).first()[0] or 1
    while True:
        out.append(stored(climb(out[-1]), "nodes"))
        widest = -(-widest >> HEIGHT)
        if widest == 1:
            return out


def paths(upper: list[DataFrame]) -> DataFrame:
    """``grp``, ``block``, ``path`` of the nodes of ``upper[0]``: their siblings up to the group's top."""
    def down(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree = Tree([d.hex() for d in rows["digest"]], height(int(rows["n"].iloc[0])))
        rest = [above["path"].iloc[0]] if above["path"].iloc[0] else []
        return pd.DataFrame({"grp": key[0], "block": rows["pos"],
                             "path": [",".join(tree.path(i) + rest) for i in range(len(rows))]})

    known = upper[-1].select("grp", F.col("pos").alias("block"), F.lit("").alias("path"))
    for nodes in reversed(upper[:-1]):
        known = nodes.groupBy("grp", block()).cogroup(known.groupBy("grp", "block")).applyInPandas(
            down, "grp string, block long, path string")
    return known


@dataclass
class Manifest:
    """``leaves``: ``id``, ``grp``, ``pos``, ``n``, ``digest``, ``changed`` (both 32 bytes; the latter
    null where the row is as it was). ``paths``: for each aligned block of leaves the siblings of its
    top (``path``), its group's ``subroot`` and the ``root`` (hex)."""

    leaves: DataFrame
    paths: DataFrame

    def _walk(self, make, schema: str) -> DataFrame:
        def one(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("pos")
            tree = Tree([d.hex() for d in rows["digest"]], height(int(rows["n"].iloc[0])))
            up = above.iloc[0]
            return make(rows, tree, up["path"].split(",") if up["path"] else [], up)

        return self.leaves.groupBy("grp", block()).cogroup(self.paths.groupBy("grp", "block")).applyInPandas(one, schema)

    def proofs(self) -> DataFrame:
        """``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all siblings up to the root)
        and ``folded_root``: the root of the row's version of the tree."""
        def make(rows, tree, marks, up):
            rest = "".join(m[1:] for m in marks)
            same = copied(tree.top, marks)[-1]
            proof, folded = [], []
            for i, changed in enumerate(rows["changed"]):
                own = tree.path(i)
                proof.append(h(*[m[1:] for m in own], rest))
                folded.append(same if changed is None else copied(changed.hex(), own + marks)[-1])
            return pd.DataFrame({"id": rows["id"].array, "leaf": tree.levels[0], "subroot": up["subroot"], "root": up["root"],
                                 "proof_sha256": proof, "folded_root": folded})

        kind = self.leaves.schema["id"].dataType.simpleString()
        return self._walk(make, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")

    def versions(self) -> DataFrame:
        """The nodes that each changed leaf's version has for itself: ``id``, ``grp``, ``pos`` (of
        the leaf), ``level`` (0: the leaf) and ``digest``; every other node is shared."""
        def make(rows, tree, marks, up):
            out = [(own, pos, level, d)
                   for i, (own, pos, changed) in enumerate(zip(rows["id"], rows["pos"], rows["changed"])) if changed is not None
                   for level, d in enumerate(copied(changed.hex(), tree.path(i) + marks))]
            return pd.DataFrame(out, columns=["id", "pos", "level", "digest"]).assign(grp=up["grp"])

        kind = self.leaves.schema["id"].dataType.simpleString()
        return self._walk(make, f"id {kind}, pos long, level int, digest string, grp string")


def manifest(docs: DataFrame, id_col: str, group_col: str, fields: list[Column], changed: Column | None = None) -> Manifest:
    """Tree over the rows of ``docs``: their leaves, the digest of ``fields``, ascend by ``id_col`` in each
    ``group_col`` (a run of two is one node, an odd last one alone is one too); the groups' tops, by
    name, are the leaves of the tree whose top is the root. ``changed``: 32 bytes where a row was tampered
    with; each such row makes a version that has only its ancestors for itself.

    Each block of ``2 ** HEIGHT`` aligned nodes is a task of its own, on every level; a version
    starts in its leaf's block and goes on over the siblings of the block's top. Defined cases: null
    ids and a null group come first; rows equal in id are ordered by their leaves, equal rows
    are leaves each; null fields are ``-``, empty ones ``0:``; texts are hashed whole; an empty table has no rows and no
    root; columns that are not named are not read.
    """
    # '0' for null and '1' before a name: never null, in the same order
    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    changed = F.lit(None).cast("binary") if changed is None else changed
    rows = stored(docs.select(F.col(id_col).alias("id"), group.alias("grp"), digest(fields).alias("digest"), changed.alias("changed")), "rows")
    leaves = stored(numbered(rows, ["id", "digest"]), "numbered")
    tiers = levels(leaves)
    subroots = tiers[-1].select("grp", "digest")
    tops = levels(stored(numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), ["name"]), "subroots"))
    above = paths([tops[0].select("grp", "pos", "n", "digest"), *tops[1:]]).select(F.col("block").alias("pos"), F.col("path").alias("top_path"))
    return Manifest(leaves, joined_paths(paths(tiers[1:]), tops, above))


def joined_paths(below: DataFrame, tops: list[DataFrame], above: DataFrame) -> DataFrame:
    top = tops[-1].first()  # one row; none if there are no rows at all
    root = F.lit(top["digest"].hex() if top else None).cast("string").alias("root")
    groups = (tops[0].select("pos", F.col("name").alias("grp"), F.lower(F.hex("digest")).alias("subroot"))
              .join(above, "pos").select("grp", "subroot", "top_path", root))
    both = F.concat_ws(",", F.nullif("path", F.lit("")), F.nullif("top_path", F.lit("")))
    return stored(below.join(light(stored(groups, "groups")), "grp").select("grp", "block", both.alias("path"), "subroot", "root"), "paths")
