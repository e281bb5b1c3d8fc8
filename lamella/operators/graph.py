"""Graphs as edge tables: components, positions, roots and paths.

Loops run a few rounds over DataFrames whose lineage is cut by a checkpoint in
the shared folder. Alignment graphs are small, but nothing here collects them.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import runs_down


def checkpoint(df: DataFrame) -> DataFrame:
    """Written to spark.checkpoint.dir; a temporary folder only where that is unset."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and (not sc.master.startswith("local") or "cluster" in sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="lamella-"))
    return df.checkpoint()


def _rounds(most: int | None, name: str) -> Iterator[int]:
    """Without end, or an error once most rounds were not enough."""
    for i in count():
        if i == most:
            raise RuntimeError(f"{name}: not done in {most} rounds")
        yield i


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that can be reached. nodes: (node); edges: (u, v).

    Each round a node takes the least label of its neighbours, then that label's
    own label (pointer jumping), so the rounds grow with the logarithm of the
    diameter and not with it.
    """
    near = checkpoint(both_ways(edges.where("u <> v")))
    label = nodes.select("node", F.col("node").alias("component"))
    for _ in range(rounds):
        least = near.join(label, F.col("v") == F.col("node")).groupBy("u").agg(F.min("component").alias("low"))
        new = label.join(least, F.col("node") == F.col("u"), "left").select("node", "component", F.least("component", F.coalesce("low", "component")).alias("next"))
        jump = label.select(F.col("node").alias("via"), F.col("component").alias("far"))
        new = checkpoint(new.join(jump, F.col("next") == F.col("via"), "left").select("node", "component", F.least("next", F.coalesce("far", "next")).alias("next")))
        label = new.select("node", F.col("next").alias("component"))
        if new.where("component <> next").isEmpty():
            return label
    raise RuntimeError("components: no fixed point")


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree) of an undirected graph without parallel edges."""
    return both_ways(edges).groupBy(F.col("u").alias("node")).agg(F.count("*").alias("degree"))


def special_nodes(edges: DataFrame, root: int) -> DataFrame:
    """(node, degree) of the root and of all nodes where a path begins, ends or branches."""
    return degrees(edges).where((F.col("node") == root) | (F.col("degree") != 2))


def positions(edges: DataFrame, start: int, rounds: int | None = None) -> DataFrame:
    """(node, x, y) by summing relative offsets from start, shifted so that the least is 0.

    edges: (u, v, dx, dy), v at (dx, dy) of u; they are walked both ways, with
    the sign turned. A node gets its place in the first round that reaches it,
    from its smallest neighbour then. Ends when no new node is reached.
    """
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"), (-F.col("dx")).alias("dx"), (-F.col("dy")).alias("dy"))
    directed = checkpoint(edges.select("u", "v", "dx", "dy").unionByName(back).where("u <> v"))
    spark = edges.sparkSession
    placed = frontier = spark.createDataFrame([(start, 0, 0)], f"node {edges.schema['u'].dataType.simpleString()}, x bigint, y bigint")
    for _ in _rounds(rounds, "positions"):
        step = frontier.join(directed, F.col("node") == F.col("u")).select(F.col("v").alias("to"), "u", (F.col("x") + F.col("dx")).alias("nx"), (F.col("y") + F.col("dy")).alias("ny"))
        step = step.groupBy("to").agg(F.min(F.struct("u", "nx", "ny")).alias("s")).select(F.col("to").alias("node"), F.col("s.nx").alias("x"), F.col("s.ny").alias("y"))
        frontier = checkpoint(step.join(placed, "node", "left_anti"))
        if frontier.isEmpty():
            break
        placed = checkpoint(placed.unionByName(frontier))
    low = placed.agg(F.min("x").alias("lx"), F.min("y").alias("ly"))
    return placed.crossJoin(F.broadcast(low)).select("node", (F.col("x") - F.col("lx")).alias("x"), (F.col("y") - F.col("ly")).alias("y"))  # one row


def paths(edges: DataFrame, root: int, rounds: int | None = None) -> DataFrame:
    """(start, end, path): chains between special nodes, each once, starting at the end nearer to the root.

    All chains grow together, a node a round, until they meet a special node. A
    chain found from both ends is kept from the end that is nearer to the root
    (then the smaller one), so every path starts on a node placed before.
    """
    near = checkpoint(both_ways(edges))
    special = checkpoint(special_nodes(edges, root).select("node"))
    depth = levels(near, root)
    chains = near.join(special, F.col("u") == F.col("node"), "left_semi").select(F.col("u").alias("start"), F.col("v").alias("end"), F.array("u", "v").alias("path"))
    done = None
    for _ in _rounds(rounds, "paths"):
        chains = checkpoint(chains)
        ended = chains.join(special, F.col("end") == F.col("node"), "left_semi")
        if done is None or not ended.isEmpty():
            done = ended if done is None else done.unionByName(ended)
        going = chains.join(special, F.col("end") == F.col("node"), "left_anti")
        if going.isEmpty():
            break
        going = going.join(near, F.col("end") == F.col("u")).where(~F.array_contains("path", F.col("v")) | ((F.col("v") == F.col("start")) & (F.size("path") > 2)))
        chains = going.select("start", F.col("v").alias("end"), F.concat("path", F.array("v")).alias("path"))
    a, b = depth.select(F.col("node").alias("start"), F.col("depth").alias("ds")), depth.select(F.col("node").alias("end"), F.col("depth").alias("de"))
    d = done.join(a, "start").join(b, "end")
    turned = F.struct("ds", "start", "path") > F.struct(F.col("de").alias("ds"), F.col("end").alias("start"), F.reverse("path").alias("path"))
    return d.where(~turned).select("start", "end", "path", F.col("ds").alias("depth")).distinct()


def levels(near: DataFrame, root: int, rounds: int | None = None) -> DataFrame:
    """(node, depth) in steps from the root; near holds edges both ways."""
    placed = frontier = near.sparkSession.createDataFrame([(root, 0)], f"node {near.schema['u'].dataType.simpleString()}, depth int")
    for _ in _rounds(rounds, "levels"):
        new = frontier.join(near, F.col("node") == F.col("u")).select(F.col("v").alias("node"), (F.col("depth") + 1).alias("depth")).distinct()
        frontier = checkpoint(new.join(placed, "node", "left_anti"))
        if frontier.isEmpty():
            break
        placed = checkpoint(placed.unionByName(frontier))
    return placed


def uncovered_members(groups: DataFrame) -> DataFrame:
    """groups (island, members) without members that a longer name in the same group contains."""
    covered = F.filter("members", lambda n: F.exists("members", lambda m: (m != n) & m.contains(n)))
    return groups.withColumn("members", F.array_except("members", covered))


def root_dataset(groups: DataFrame) -> DataFrame:
    """(root, island): the first dataset that is alone in its group."""
    alone = groups.where(F.size("members") == 1)
    return alone.agg(F.min_by(F.get("members", F.lit(0)), "island").alias("root"), F.min("island").alias("island"))


def tile_map(matches: DataFrame, threshold: float) -> DataFrame:
    """(node, component, tx, ty) of tiles from pairwise matches (u, v, dx, dy, score), v at (dx, dy) of u.

    Matches under the threshold don't count. An offset that is rather downward
    puts v in the next row (or the one before), any other in the next column.
    Each connected part has a grid of its own, from 0; unmatched tiles stand alone.
    """
    nodes = matches.select(F.col("u").alias("node")).union(matches.select("v")).distinct()
    good = matches.where(F.col("score") >= threshold)
    down = runs_down(F.col("dx"), F.col("dy"))
    step = lambda c, along: F.when(along, F.signum(c)).otherwise(0).cast("bigint")
    edges = good.select("u", "v", step(F.col("dx"), ~down).alias("dx"), step(F.col("dy"), down).alias("dy"))
    return placed(nodes, edges)


def placed(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component, tx, ty): places of nodes (node) by whole steps (u, v, dx, dy: long), v at (dx, dy) of u.

    Each connected part starts from 0; a node without edges stands alone.
    """
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"), (-F.col("dx")).alias("dx"), (-F.col("dy")).alias("dy"))
    directed = checkpoint(edges.select("u", "v", "dx", "dy").unionByName(back).where("u <> v"))
    parts = checkpoint(components(nodes, edges.select("u", "v")))
    found = frontier = parts.where("node = component").select("node", F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"))
    for _ in _rounds(None, "placed"):
        near = frontier.join(directed, F.col("node") == F.col("u")).select(F.col("v").alias("to"), "u", (F.col("x") + F.col("dx")).alias("nx"), (F.col("y") + F.col("dy")).alias("ny"))
        near = near.groupBy("to").agg(F.min(F.struct("u", "nx", "ny")).alias("s")).select(F.col("to").alias("node"), F.col("s.nx").alias("x"), F.col("s.ny").alias("y"))
        frontier = checkpoint(near.join(found, "node", "left_anti"))
        if frontier.isEmpty():
            break
        found = checkpoint(found.unionByName(frontier))
    at = found.join(parts, "node")
    low = at.groupBy("component").agg(F.min("x").alias("lx"), F.min("y").alias("ly"))
    return at.join(low, "component").select("node", "component", (F.col("x") - F.col("lx")).alias("tx"), (F.col("y") - F.col("ly")).alias("ty"))
