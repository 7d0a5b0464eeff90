"""Merkle manifest of a dataset (12): a persistent tree whose versions copy
paths.

Leaves are the digests of the rows. They are numbered per group (language) in
one distributed sort, and cut into aligned blocks of ``BLOCK`` = 8**4 nodes.
A block's tree is built in one task; the blocks' roots are the nodes of the next
tier, cut and built alike, until one is left for each group. The groups' roots are
numbered and built by the same steps. Then the tiers are gone through from the top
down: each block learns the path of its root (the siblings on every level up to
the root of all), and its nodes' paths are their own siblings in the block and
then the block's.

A changed leaf makes a version of the tree: it shares every node but the
ancestors of the leaf. These are copied in the leaf's block, and the copy of the block's
root goes on up the block's path, so no version is ever built from its leaves and no
task holds more than a block.

Defined results: a null field is the text ``-``, unlike an empty one; rows of one
id follow by their digest, rows without an id come first; rows alike in all columns are
leaves of their own; a lone leaf is its group's root, and a lone group's root the root of
all; an empty table gives an empty table; columns that are not hashed are not looked at.
Texts of any length are hashed by Spark and never leave the first stage.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstat.llm import common as c

#: Children of a node.
WIDTH = 8
#: Levels that one task builds, and the nodes they start from.
LEVELS = 4
BLOCK = WIDTH**LEVELS
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: From a node to the root: its place among its siblings, and those, per level.
PATH = "array<struct<at: int, others: array<string>>>"
_PATH = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(field: Column) -> Column:
    """A field as it goes into a leaf: its length in bytes and itself."""
    text = field.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**instead: Column) -> Column:
    """The digest of a row, with columns ``instead`` of some fields."""
    return F.sha2(F.concat(*[encoded(instead.get(f, F.col(f))) for f in FIELDS]), 256)


def leaves(docs: DataFrame, changed: Column, **instead: Column) -> DataFrame:
    """``doc_id, grp, lang, leaf, new_leaf``: the digest of each row, and where
    ``changed`` the one that it has with columns ``instead`` of some fields."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        encoded(F.col("lang")).alias("grp"),
        F.col("lang").cast("string").alias("lang"),
        leaf().alias("leaf"),
        F.when(changed, leaf(**instead)).alias("new_leaf"),
    )


def numbered(rows: DataFrame, grp: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (0 on, in ``grp`` by ``order``, nulls first) and
    ``n`` (rows in ``grp``). Rows alike in ``order`` are dealt by a number of
    their own, so that no partition has to hold all of them."""
    by = [F.col(grp), *[F.col(x).asc_nulls_first() for x in order], F.col("__own")]
    dealt = c.written(rows.withColumn("__own", F.monotonically_increasing_id()), "merkle-rows")
    ranged = dealt.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    ranged = c.written(ranged.drop("__own"), "merkle-ranged")
    # a row for each partition and each group in it: a group's lie side by side
    parts = ranged.groupBy(grp, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    before = Window.partitionBy(grp).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        grp,
        "__part",
        "__first",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(Window.partitionBy(grp)).alias("n"),
    )
    return (
        ranged.join(parts, [grp, "__part"])
        .withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before"))
        .drop("__part", "__at", "__first", "__before")
    )


class Block:
    """The tree over the nodes of one aligned block. ``more``: the group has
    other blocks, so that all ``LEVELS`` levels are built; otherwise up to the
    one node that is left."""

    def __init__(self, nodes: list[str], more: bool):
        self.levels = [nodes]
        while len(self.levels) <= LEVELS if more else len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([digest(*below[i : i + WIDTH]) for i in range(0, len(below), WIDTH)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[tuple[int, list[str]]]:
        """Place and siblings of a node and of its ancestors below the root."""
        found = []
        for level in self.levels[:-1]:
            lo = at - at % WIDTH
            run = level[lo : lo + WIDTH]
            found.append((at - lo, run[: at - lo] + run[at - lo + 1 :]))
            at //= WIDTH
        return found


def copied(node: str, path: list[tuple[int, list[str]]]) -> list[str]:
    """The ancestors of a changed node, copied up to the root; every sibling is
    shared with the version before."""
    made = []
    for at, others in path:
        node = digest(*others[:at], node, *others[at:])
        made.append(node)
    return made


def _block_of(table: pa.Table) -> tuple[list[int], Block, pa.Table]:
    table = table.sort_by("pos")
    pos = table.column("pos").to_pylist()
    return [p % BLOCK for p in pos], Block(table.column("node").to_pylist(), table.column("n")[0].as_py() > BLOCK), table


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """From ``grp, pos, n, node``: these, their blocks' roots as nodes, those
    blocks' roots, and so on up to one node for each group."""

    def top(key: tuple, table: pa.Table) -> pa.Table:
        _, block, table = _block_of(table)
        n = -(-table.column("n")[0].as_py() // BLOCK)
        return pa.table({"grp": [key[0].as_py()], "pos": [key[1].as_py()], "n": [n], "node": [block.root]})

    found = [nodes]
    while True:
        blocks = found[-1].select("grp", "pos", "n", "node").groupBy("grp", _block_number()).applyInArrow(
            top, "grp string, pos long, n long, node string"
        )
        found.append(c.written(blocks, "merkle-tier"))
        if found[-1].where("n > 1").isEmpty():
            return found


def _block_number() -> Column:
    return F.expr(f"pos div {BLOCK}").alias("block")


def descended(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """The paths (``grp, pos, path, root, subroot``) of the blocks of the lowest
    tier, from those of the groups' roots (``grp, path, root``)."""
    tops = found[-1].select("grp", "pos", F.col("node").alias("subroot"))
    known = tops.join(above, "grp").select("grp", "pos", "path", "root", "subroot")
    for nodes in found[-2:0:-1]:
        known = c.written(
            _down(nodes.select("grp", "pos", "n", "node"), known, _tier_rows, f"grp string, pos long, path {PATH}, root string, subroot string"),
            "merkle-paths",
        )
    return known


def _down(nodes: DataFrame, known: DataFrame, rows, kind: str) -> DataFrame:
    """``rows(table, block, places, path, root, subroot)`` for each block of
    ``nodes`` and its own path from ``known``."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        places, block, left = _block_of(left)
        own = right.to_pylist()[0]
        path = [(s["at"], s["others"]) for s in own["path"]]
        return rows(left, block, places, path, own["root"], own["subroot"])

    blocks = nodes.groupBy("grp", _block_number())
    return blocks.cogroup(known.groupBy("grp", F.col("pos").alias("block"))).applyInArrow(run, kind)


def _paths(paths: list) -> pa.Array:
    return pa.array([[{"at": at, "others": others} for at, others in p] for p in paths], _PATH)


def _tier_rows(table: pa.Table, block: Block, places: list[int], path: list, root: str, subroot: str) -> pa.Table:
    n = len(places)
    return pa.table(
        {
            "grp": table.column("grp"),
            "pos": table.column("pos"),
            "path": _paths([block.path(p) + path for p in places]),
            "root": pa.array([root] * n, pa.string()),
            "subroot": pa.array([subroot] * n, pa.string()),
        }
    )


def _leaf_rows(table: pa.Table, block: Block, places: list[int], path: list, root: str, subroot: str) -> pa.Table:
    n = len(places)
    paths = [block.path(p) + path for p in places]
    new = table.column("new_leaf").to_pylist()
    old = block.levels[0]
    versions = [copied(new[i] if new[i] is not None else old[i], paths[i]) for i in range(n)]
    folded = [v[-1] if v else new[i] if new[i] is not None else old[i] for i, v in enumerate(versions)]
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "lang": table.column("lang"),
            "pos": table.column("pos"),
            "leaf": table.column("node"),
            "subroot": pa.array([subroot] * n, pa.string()),
            "root": pa.array([root] * n, pa.string()),
            "path": _paths(paths),
            "changed": pa.array([x is not None for x in new], pa.bool_()),
            "copied": pa.array([v if x is not None else [] for v, x in zip(versions, new, strict=True)], pa.list_(pa.string())),
            "folded_root": pa.array(folded, pa.string()),
        }
    )


_MANIFEST = (
    f"doc_id long, lang string, pos long, leaf string, subroot string, root string, path {PATH}, "
    "changed boolean, copied array<string>, folded_root string"
)


def manifest(docs: DataFrame, changed: Column, **instead: Column) -> DataFrame:
    """One row per row of ``docs``: its leaf and place in its language's tree,
    the roots, its ``path`` of siblings up to the root, and the version in which only
    this leaf is changed (where ``changed``, to the digest with columns
    ``instead``): the nodes ``copied``, and ``folded_root``, the version's root.
    Leaves that are not changed are folded up their path all the same."""
    rows = numbered(leaves(docs, changed, **instead), "grp", ["doc_id", "leaf"])
    rows = c.written(rows.withColumnRenamed("leaf", "node"), "merkle-leaves")
    found = tiers(rows)
    langs = rows.select("grp", "lang").distinct().join(found[-1].select("grp", "node"), "grp")
    langs = langs.withColumnRenamed("grp", "own").withColumn("grp", F.lit(""))
    langs = c.written(numbered(langs, "grp", ["lang"]), "merkle-groups")
    over = tiers(langs)
    start = F.array().cast(PATH)
    tops = descended(over, over[-1].select("grp", start.alias("path"), F.col("node").alias("root")))
    paths = _down(langs, tops, _group_rows, f"grp string, path {PATH}, root string")
    return _down(rows, descended(found, paths), _leaf_rows, _MANIFEST)


def _group_rows(table: pa.Table, block: Block, places: list[int], path: list, root: str, subroot: str) -> pa.Table:
    paths = _paths([block.path(p) + path for p in places])
    return pa.table({"grp": table.column("own"), "path": paths, "root": pa.array([root] * len(places), pa.string())})


def versions(found: DataFrame) -> DataFrame:
    """The nodes that the versions of a manifest do not share with its tree:
    ``lang, version`` (the place of the changed leaf), ``level`` (0: the leaf's
    parent) and ``node``."""
    return found.where("changed").select("lang", F.col("pos").alias("version"), F.posexplode("copied").alias("level", "node"))
