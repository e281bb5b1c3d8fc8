"""A Merkle manifest of a table: a hash for each row, a tree for each group, one root over the groups.

Built level by level as tables. The rows of a group get consecutive numbers;
dividing these by FANOUT gives each row's parent, children are grouped by it,
sorted, and hashed into one row of the next level, until each group has one node
left, its subroot. The subroots, numbered the same way, give the root. Then the
levels are walked back down: a node's path is its siblings followed by its
parent's path, so a join of two neighbouring levels appends one step to the
paths of all nodes at once. A join key has FANOUT children at most, so a group
that holds most of the table is as many keys as any other rows are.

Numbers come from a sort in ranges: a row's number is its place in the range
plus the rows of its group in the ranges before, of which there is a row for
each task and group. No task sees a whole group.

A hash is the lowercase hex SHA-256 of its inputs' text, one after the other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches, tidy

FANOUT = 8
#: What a leaf covers, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A step of a path: the hashes before and after a node among its parent's children, each as one text.
PATH = "array<struct<before:string,after:string>>"


def hashed(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 byte count, a colon and itself, or `-` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return hashed(*map(field, values))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def fold(node: Column, path: Column) -> Column:
    """The root that a node leads to along a path."""
    return F.aggregate(path, node, lambda acc, s: hashed(s["before"], acc, s["after"]))


def proof(path: Column) -> Column:
    """The hash of all siblings of a path, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def numbered_in(nodes: DataFrame, *order: str) -> DataFrame:
    """nodes (grp, ...) with idx, their place from 0 in their group by the order, and n, the group's size.

    The order must tell all rows apart. A null group is a group.
    """
    place = ["grp", *order]
    ranged = nodes.repartitionByRange(*place).sortWithinPartitions(*place)
    at = materialize(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = at.groupBy("grp", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("k"))
    # A row for each task and group that met.
    before = Window.partitionBy("grp").orderBy("part")
    sizes = sizes.select(
        F.col("grp").alias("of"),
        "part",
        "first",
        (F.sum("k").over(before) - F.col("k")).alias("before"),
        F.sum("k").over(Window.partitionBy("grp")).alias("n"),
    )
    found = at.join(sizes, F.col("grp").eqNullSafe(F.col("of")) & (part == F.col("part")))
    return found.withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop("at", "of", "part", "first", "before")


@dataclass
class Tree:
    """levels: (grp, n, parent, kids), the nodes of each level under their parents; tops: (grp, hash, ...), the last node of each group."""

    levels: list[DataFrame]
    tops: list[DataFrame]

    def roots(self) -> DataFrame:
        out = self.tops[0].select("grp", "hash")
        for t in self.tops[1:]:
            out = out.unionByName(t.select("grp", "hash"))
        return out


def grow(nodes: DataFrame) -> Tree:
    """The trees of nodes (grp, idx, n, hash, ...); what else a node has is kept in the lowest level."""
    nodes = materialize(nodes)
    width = nodes.agg(F.max("n")).first()[0] or 1
    levels, tops = [], [nodes.where("n = 1")]
    while width > 1:
        kid = F.struct("idx", *[c for c in nodes.columns if c not in ("grp", "n", "idx")])
        parent = F.floor(F.col("idx") / FANOUT).alias("parent")
        levels.append(
            materialize(nodes.where("n > 1").groupBy("grp", "n", parent).agg(F.array_sort(F.collect_list(kid)).alias("kids")))
        )
        nodes = levels[-1].select(
            "grp",
            F.ceil(F.col("n") / FANOUT).alias("n"),
            F.col("parent").alias("idx"),
            hashed(F.array_join("kids.hash", "")).alias("hash"),
        )
        tops.append(nodes.where("n = 1"))
        width = -(-width // FANOUT)
    return Tree(levels, tops)


def _with_siblings(level: DataFrame) -> DataFrame:
    """(grp, parent, step, kid) for each node of a level."""

    def steps(kid: Column, i: Column) -> Column:
        hashes = F.col("kids.hash")
        before, after = F.slice(hashes, F.lit(1), i), F.slice(hashes, i + 2, F.lit(FANOUT))
        return F.struct(kid.alias("kid"), F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after")).alias("step"))

    return level.select("grp", "parent", F.explode(F.transform("kids", steps)).alias("s")).select("grp", "parent", "s.*")


def descend(tree: Tree, above: DataFrame) -> DataFrame:
    """The lowest nodes of the trees with their paths: (grp, kid, path, ...).

    above: (grp, path, ...), one row for each group: the path that follows its
    top, and whatever else all nodes of the group get.
    """
    more = [c for c in above.columns if c not in ("grp", "path")]
    up = above.select(F.col("grp").alias("of"), "path", *more)

    def tops(k: int) -> DataFrame:
        own = [c for c in tree.tops[k].columns if c not in ("grp", "n")]
        found = tree.tops[k].select("grp", F.struct(*own).alias("kid"))
        return found.join(up, F.col("grp").eqNullSafe(F.col("of"))).drop("of")

    nodes = tops(len(tree.levels))
    for k in reversed(range(len(tree.levels))):
        parents = nodes.select(F.col("grp").alias("of"), F.col("kid.idx").alias("at"), "path", *more)
        kids = _with_siblings(tree.levels[k]).join(parents, F.col("grp").eqNullSafe(F.col("of")) & (F.col("parent") == F.col("at")))
        path = F.concat(F.array("step"), "path").cast(PATH).alias("path")
        nodes = kids.select("grp", "kid", path, *more).unionByName(tops(k))
    return nodes


@tidy
def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", **carried: Column) -> DataFrame:
    """(id, leaf, subroot, root, path, ...) for every row of docs.

    Leaves of a group ascend by id (null first); rows with equal ids by their
    hash, so the same rows give the same root in whatever order they are read.
    Repeated rows are leaves of their own, side by side. Null groups are one
    group, the first. A group of one row has its leaf as subroot, a table of one
    group its subroot as root. An empty table gives no rows. carried: more
    columns of the result, as expressions on docs.
    """
    small_batches(docs.sparkSession)
    leaves = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(group_col).alias("grp"),
        F.col(id_col).alias("id"),
        leaf(*map(F.col, columns)).alias("hash"),
        *[c.alias(name) for name, c in carried.items()],
    )
    # Written first: the sort reads its input twice, and the texts are needed once.
    tree = grow(numbered_in(materialize(leaves), "id", "hash", "row"))
    subroots = tree.roots().select(F.lit(0).alias("grp"), F.col("grp").alias("of_group"), "hash")
    upper = grow(numbered_in(subroots, "of_group"))
    root = upper.roots().select("grp", F.col("hash").alias("root"), F.array().cast(PATH).alias("path"))
    above = descend(upper, root).select(F.col("kid.of_group").alias("grp"), "path", F.col("kid.hash").alias("subroot"), "root")
    found = descend(tree, materialize(above))
    more = [F.col(f"kid.{name}").alias(name) for name in carried]
    return found.select(F.col("kid.id").alias("id"), F.col("kid.hash").alias("leaf"), "subroot", "root", "path", *more)
