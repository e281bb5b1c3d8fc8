"""Pipelines along z: a plan from overlapping datasets, and the serial registration of each dataset."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..kernels import elastic, register, resample
from ..operators import graph, islands, progress, registration, worktiles
from ..sources import configs, store

ALIGNED = "dataset string, z int, h int, w int, px binary, mask binary, reference int, matches int, robust boolean, energy double, steps int, gy int, gx int, mesh binary"


@dataclass(frozen=True)
class Align:
    """Parameters along z. most: pixels searched at full scale, None for half a patch; coarse: the second, smaller scale, 0 for none."""

    scale: float = 1.0
    patch: int = 32
    stride: int = 16
    most: int | None = None
    coarse: float = 0.5
    min_ratio: float = 1.1
    min_sharp: float = 1.0
    max_size: float = 0
    max_deviation: float = 4
    min_patch: int = 2
    mesh: register.Mesh = field(default_factory=lambda: register.Mesh(most=100_000))
    affine: bool = True
    ignore: tuple[int, ...] = ()


#: What a walk carries from slice to slice: the aligned image and its mesh (2, gy, gx), None before the first.
State = tuple[np.ndarray, np.ndarray | None] | None


def membership_edges(datasets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, edges) of datasets (name, z0, z1): runs of z with the same members, and links between members of runs that follow each other.

    A member that a longer name in its run contains is covered by that and goes.
    """
    z = datasets.select("name", F.explode(F.sequence("z0", F.col("z1") - 1)).alias("z"))
    m = islands.islands(islands.membership(z, "z", "name"), "z", F.col("members"))
    groups = graph.uncovered_members(m.groupBy("island").agg(F.first("members").alias("members"), F.min("z").alias("z0"), F.max("z").alias("z1")))
    g = groups.select("island", F.explode("members").alias("u"))
    edges = g.join(g.select((F.col("island") - 1).alias("island"), F.col("u").alias("v")), "island").where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    return groups, edges


def plan(spark: SparkSession, datasets: DataFrame, matched: DataFrame | None = None) -> dict:
    """Root, paths, directions and bounds for datasets (name, z0, z1[, resolution]): a document that holds a name for each dataset.

    The target resolution is that of the finest pixels, null where none is known.

    matched (u, v), if given, keeps only links whose images were found to match.
    Datasets that can't be reached from the root are an error.
    """
    groups, edges = membership_edges(datasets)
    if matched is not None:
        edges = edges.join(matched, ["u", "v"], "left_semi")
    root = graph.root_dataset(groups).first()
    if not root or root.root is None:
        raise ValueError("no dataset is alone in any slice")
    left = graph.components(groups.select(F.explode("members").alias("node")).distinct(), edges)
    if left.select("component").distinct().count() > 1:
        raise ValueError("the datasets are not connected")
    numbered = datasets.select("name", F.col("z0").cast("bigint"))
    order = {r.name: i for i, r in enumerate(numbered.orderBy("z0", "name").collect())}  # a name for each dataset
    number = spark.createDataFrame([(k, i) for k, i in order.items()], "name string, n bigint")
    e = edges.join(number.select(F.col("name").alias("u"), F.col("n").alias("a")), "u").join(number.select(F.col("name").alias("v"), F.col("n").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    names = {i: k for k, i in order.items()}
    found = [] if edges.isEmpty() else graph.paths(e, order[root.root]).orderBy("depth", "start", "path").collect()
    bounds = {r.name: [r.lo, r.hi] for r in groups.select(F.explode("members").alias("name"), "z0", "z1").groupBy("name").agg(F.min("z0").alias("lo"), (F.max("z1") + 1).alias("hi")).collect()}
    low = {r.name: r.z0 for r in numbered.collect()}
    paths = [[names[n] for n in r.path] for r in found] or [[root.root]]
    target = datasets.agg(F.min("resolution")).first()[0] if "resolution" in datasets.columns else None
    return store.stamped({
        "root_stack": root.root, "paths": paths, "reverse_order": [low[p[0]] > low[p[-1]] for p in paths], "root_offset": [0, 0], "pad_offset": [0, 0], "yx_target_resolution": target and [target, target],
        "dataset_local_bounds": {k: [a - low[k], b - low[k]] for k, (a, b) in bounds.items()},
    })


def write_plan(spark: SparkSession, plan: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(plan),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(configs.PLAN).json(path)


def flow_at(reference: np.ndarray, moving: np.ndarray, p: Align, scale: float = 1.0) -> np.ndarray:
    """(2, gy, gx) of trusted vectors at one scale, in its pixels; its node (0, 0) lies at the middle of the first patch."""
    a, b = (resample.resample(i, scale) for i in (reference, moving))
    patch = min(p.patch, *a.shape)
    most = patch // 2 if p.most is None else p.most
    raw = register.flow(a, b, patch, p.stride, most, a > 0, b > 0)
    return register.clean(raw, p.min_ratio, p.min_sharp, p.max_size, p.max_deviation)


def flow_of(reference: np.ndarray, moving: np.ndarray, p: Align) -> np.ndarray:
    """Flow at full scale, completed by that of a smaller scale, which reaches further: a coarse vector stands where the fine one isn't trusted."""
    fine = flow_at(reference, moving, p)
    small = min(reference.shape) * p.coarse
    if not p.coarse or p.coarse >= 1 or small < 8:
        return register.drop_small(fine, p.min_patch)
    rough = flow_at(reference, moving, p, p.coarse)
    # Places of the fine nodes in the coarse grid; values grow with the scale.
    half, wide = min(p.patch, *reference.shape) / 2, min(p.patch, round(small)) / 2
    at = [np.clip(((np.arange(n) * p.stride + half) * p.coarse - wide) / p.stride, 0, m - 1) for n, m in zip(fine.shape[1:], rough.shape[1:], strict=True)]
    upsampled = np.stack([resample.sample(c, *np.meshgrid(*at, indexing="ij")) for c in rough]) / p.coarse
    return register.reconcile([fine, upsampled], 0, p.min_patch)


def align_slice(state: State, own: np.ndarray, p: Align) -> tuple[State, dict]:
    """The slice moved onto the aligned slice before it: by a similarity, then by a relaxed mesh.

    The slice is first seen through the mesh of the slice before; the flow that
    is left is composed with that mesh, and the mesh relaxes from it.
    """
    facts: dict = {"matches": None, "robust": None, "energy": None, "steps": None}
    if state is None:
        return (own, None), facts
    before, solved = state
    if p.affine:
        e = register.estimate(before, own, p.scale)
        facts |= {"matches": e.matches, "robust": e.robust}
        if e.matrix is not None and e.robust:
            own = resample.warp_affine(own, e.matrix, before.shape)
    h, w = before.shape
    own = np.pad(own, ((0, max(0, h - own.shape[0])), (0, max(0, w - own.shape[1]))))[:h, :w]
    first = min(p.patch, h, w) / 2
    seen = own if solved is None else elastic.warp(own, solved, p.stride, first=first)
    left = flow_of(before, seen, p)
    if np.isnan(left).all():
        return (seen, solved), facts
    if solved is None or solved.shape != left.shape:
        solved = np.zeros_like(left)
    target = resample.compose(solved / p.stride, left / p.stride) * p.stride
    mesh, steps = register.relax(target, p.mesh, solved)
    facts |= {"energy": register.energy(mesh, target, p.mesh), "steps": steps}
    return (elastic.warp(own, mesh, p.stride, first=first), mesh), facts


def align(images: DataFrame, p: Align = Align(), reverse: bool = False, first: DataFrame | None = None) -> DataFrame:
    """Aligned slices of datasets (dataset, z, h, w, px[, reverse]): each follows the last one with content, in order of z or against it.

    A dataset's own column reverse, if there, says so for it. The walk is serial
    within a dataset and parallel over datasets; a task holds the slice at hand
    and the one before. first (dataset, h, w, px[, gy, gx, mesh]) gives the
    aligned slice that a dataset is continued from. Steps at the limit of the
    mesh mean that it didn't come to rest.
    """
    columns = [c.split()[0] for c in ALIGNED.split(", ")]
    against = F.col("reverse") if "reverse" in images.columns else F.lit(reverse)
    rows = images.select("dataset", F.lit(1).alias("kind"), F.when(against, -F.col("z")).otherwise(F.col("z")).alias("place"), "z", "h", "w", "px")
    if first is not None:
        has = set(first.columns)
        more = [(F.col(c) if c in has else F.lit(None)).cast(t).alias(c) for c, t in (("gy", "int"), ("gx", "int"), ("mesh", "binary"))]
        start = first.select("dataset", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("place"), F.lit(None).cast("int").alias("z"), "h", "w", "px", *more)
        rows = start.unionByName(rows, allowMissingColumns=True)
    else:
        rows = rows.select("*", F.lit(None).cast("int").alias("gy"), F.lit(None).cast("int").alias("gx"), F.lit(None).cast("binary").alias("mesh"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dataset, state, reference = None, None, None
        for batch in batches:
            for r in batch.to_dict("records"):
                own = np.frombuffer(r["px"], np.uint8).reshape(int(r["h"]), int(r["w"]))
                if r["dataset"] != dataset:
                    dataset, state, reference = r["dataset"], None, None
                if not r["kind"]:
                    mesh = None if r["mesh"] is None else np.frombuffer(r["mesh"], np.float64).reshape(2, int(r["gy"]), int(r["gx"]))
                    state = own, mesh
                    continue
                z = int(r["z"])
                if z in p.ignore or not own.any():
                    continue
                state, facts = align_slice(state, own, p)
                image, mesh = state
                kept = (None, None, None) if mesh is None else (*mesh.shape[1:], mesh.tobytes())
                out = pd.DataFrame([(dataset, z, *image.shape, image.tobytes(), (image > 0).tobytes(), reference, *facts.values(), *kept)], columns=columns)
                yield out.astype({"reference": "Int64", "matches": "Int64", "robust": "boolean", "steps": "Int64", "gy": "Int64", "gx": "Int64"})
                reference = z

    # Two key columns, so that no step is left out by an order that only looks right: a dataset's first slice, then its places.
    return rows.repartition("dataset").sortWithinPartitions("dataset", "kind", "place").mapInPandas(walk, ALIGNED)


def schedule(plan: dict) -> list[list[tuple[str, str | None, bool]]]:
    """Rounds of (dataset, the dataset it is continued from, whether it is walked against z) that follow a plan's paths.

    A dataset comes a round after the one before it on its path; the first of a
    path is the last of another, or the root. One that several paths name is
    aligned on the first.
    """
    rounds: list[list[tuple[str, str | None, bool]]] = []
    at: dict[str, int] = {}
    waiting = list(zip(plan["paths"], plan["reverse_order"], strict=True))
    waiting.sort(key=lambda x: x[0][0] != plan["root_stack"])
    while waiting:
        path, turned = next((x for x in waiting if x[0][0] in at or x[0][0] == plan["root_stack"]), waiting[0])
        waiting.remove((path, turned))
        for before, name in zip([None, *path], path, strict=False):
            if name in at:
                continue
            at[name] = 0 if before is None else at[before] + 1
            while len(rounds) <= at[name]:
                rounds.append([])
            rounds[at[name]].append((name, before, bool(turned)))
    return rounds


def run_plan(spark: SparkSession, images: DataFrame, plan: dict, output: str, p: Align = Align()) -> DataFrame:
    """Align all datasets of a plan, each continued from the one before it on its path; the log.

    images: (dataset, z, h, w, px[, resolution]) with z in the volume; if the plan
    has a target resolution, they are scaled to it. The store is flagged as
    aligned once all rounds are written and logged. Datasets of a round are
    aligned at once. A dataset walked upward is continued from the highest slice
    of the other that lies below its own first one (or its lowest), one walked
    downward the other way round.
    """
    log, target = progress.read(spark, f"{output}/progress"), plan.get("yx_target_resolution")
    if target:
        images = registration.at_resolution(images, target[-1]).drop("resolution")
        store.write_attributes(spark, output, {"resolution": target})
    for entries in schedule(plan):
        table = spark.createDataFrame(entries, "dataset string, before string, reverse boolean")
        own = images.join(F.broadcast(table), "dataset")  # a row for each dataset of a plan
        done = store.read(spark, f"{output}/aligned", ALIGNED, missing_ok=True)
        start = own.groupBy("dataset", "before", "reverse").agg(F.min("z").alias("lo"), F.max("z").alias("hi"))
        near = start.join(done.select(F.col("dataset").alias("before"), "z", "h", "w", "px", "gy", "gx", "mesh"), "before")
        # The slice of the other dataset nearest to where this one begins, on the side that it comes from.
        ahead = F.when(F.col("reverse"), F.col("z") >= F.col("hi")).otherwise(F.col("z") <= F.col("lo"))
        gap = F.abs(F.col("z") - F.when(F.col("reverse"), F.col("hi")).otherwise(F.col("lo")))
        first = near.groupBy("dataset").agg(F.min_by(F.struct("h", "w", "px", "gy", "gx", "mesh"), F.struct(~ahead, gap)).alias("s")).select("dataset", "s.*")
        log = run(spark, own.drop("before"), output, p, first=first, last=False)
    store.write_attributes(spark, output, {"z_aligned": True})
    return log


def run(spark: SparkSession, images: DataFrame, output: str, p: Align = Align(), reverse: bool = False, first: DataFrame | None = None, last: bool = True) -> DataFrame:
    """Align what the log hasn't got yet, write it and log it; the log.

    first gives the slice that a dataset without any aligned one is continued
    from. The store is flagged as aligned after the log has all of it, unless
    this isn't the last run on it; while slices are missing, it isn't flagged.

    A dataset is taken up from its last aligned slice; parameters other than
    those of the first run are an error, as the results would not fit together.
    What has been written counts as done whether it was logged or not, so a run
    that broke off between the two is logged and not repeated.
    """
    key = json.dumps(asdict(p), sort_keys=True, default=str)
    had = store.read_attributes(spark, output)
    if had.get("parameters", key) != key:
        raise ValueError("the store was made with other parameters")
    log = progress.read(spark, f"{output}/progress")
    done = log.where("step_name = 'align'").select(F.col("collection").alias("dataset"), F.col("local_slice").alias("z")).distinct()
    unlogged = progress.pending(images, done, ["dataset", "z"])
    if unlogged.isEmpty():
        if last and not had.get("z_aligned"):
            store.write_attributes(spark, output, {"z_aligned": True})
        return log
    store.write_attributes(spark, output, {"parameters": key, "z_aligned": False})
    old = store.read(spark, f"{output}/aligned", ALIGNED, missing_ok=True)
    rest = progress.pending(unlogged, old.select("dataset", "z").distinct(), ["dataset", "z"])
    if not rest.isEmpty():
        against = F.col("reverse") if "reverse" in images.columns else F.lit(reverse)
        turned = images.groupBy("dataset").agg(F.first(against).alias("reverse"))
        mine = old.join(turned, "dataset")
        latest = mine.groupBy("dataset").agg(F.max_by(F.struct("h", "w", "px", "gy", "gx", "mesh"), F.when(F.col("reverse"), -F.col("z")).otherwise(F.col("z"))).alias("s")).select("dataset", "s.*")
        if first is not None:
            latest = latest.unionByName(first.join(latest, "dataset", "left_anti"))
        align(rest, p, reverse, latest).write.mode("append").partitionBy("dataset").parquet(f"{output}/aligned")
    written = spark.read.schema(ALIGNED).parquet(f"{output}/aligned").select("dataset", "z", "matches", "robust")
    log_rows = unlogged.select("dataset", "z").join(written, ["dataset", "z"], "left")
    meta = F.to_json(F.struct("matches", "robust"))
    progress.append(log_rows.select(F.col("dataset").alias("collection"), F.lit("align").alias("step_name"), F.col("z").alias("global_slice"), F.col("z").alias("local_slice"), F.current_timestamp().alias("ts"), meta.alias("metadata")), f"{output}/progress")
    if last:
        store.write_attributes(spark, output, {"z_aligned": True})
    return progress.read(spark, f"{output}/progress")


def run_large(spark: SparkSession, source: str, output: str, p: Align = Align(affine=False), size: int = 1024) -> None:
    """Align the slices of one store into another in three stages, for slices that no task can hold.

    The flow of each slice against the one before that has content, all slices at
    once and by work tiles of size x size pixels; the meshes, one after the other,
    from the flow composed with the mesh before; the slices seen through their
    meshes, all at once and by work tiles. Neighbouring slices must lie within
    half a patch of each other already, as there is no similarity and one scale.

    A stage is kept under output/stages by its parameters and those of the stage
    before: with another mesh, the flow stays and meshes and slices are made
    anew; slices that are new in the source, or that a run which broke off has
    left, are all that is done again otherwise. New slices come after the others:
    one before them is an error.
    """
    if p.affine:
        raise ValueError("large slices are aligned without a similarity")
    chunks, folder = store.open_chunks(spark, source), f"{output}/stages"
    some = chunks.groupBy("z").agg(F.bool_or(registration.has_content(F.col("px"))).alias("any")).where("any").where(~F.col("z").isin(*p.ignore) if p.ignore else F.lit(True))
    order = graph.checkpoint(some.select("z").withColumn("reference", F.lag("z").over(Window.orderBy("z"))))  # a row for each slice
    search = {"patch": p.patch, "stride": p.stride, "most": p.patch // 2 if p.most is None else p.most}

    def flows(rest: DataFrame, _: DataFrame) -> DataFrame:
        todo = order.join(rest, "z")
        before = chunks.withColumnRenamed("z", "reference").join(todo, "reference")
        return worktiles.flow(before, chunks.join(rest, "z"), search["patch"], search["stride"], search["most"], size)

    later = order.where("reference is not null")
    field, key = store.staged(spark, folder, "flow", {"source": source, "ignore": p.ignore, **search}, worktiles.FIELD, later, flows)
    clean = {"min_ratio": p.min_ratio, "min_sharp": p.min_sharp, "max_size": p.max_size, "max_deviation": p.max_deviation}

    def meshes(rest: DataFrame, old: DataFrame) -> DataFrame:
        ends = old.agg(F.max("z").alias("z"))
        if not rest.join(ends, rest["z"] < ends["z"]).isEmpty():
            raise ValueError("there are new slices before those that are aligned")
        last = old.join(ends, "z")
        return worktiles.meshes(field.join(rest, "z"), p.stride, p.mesh, clean, p.min_patch, last)

    mesh, key = store.staged(spark, folder, "mesh", {"flow": key, "mesh": asdict(p.mesh), "min_patch": p.min_patch, **clean}, worktiles.MESH, later, meshes)
    same = store.read_attributes(spark, output).get("mesh") == key
    done = store.open_chunks(spark, output, missing_ok=True).select("z").distinct()
    rest = graph.checkpoint(order.select("z").join(done, "z", "left_anti") if same else order.select("z"))
    if not rest.isEmpty():
        store.write_attributes(spark, output, {"mesh": None if not same else key})
        new = worktiles.warp(chunks.join(rest, "z"), mesh.join(rest, "z"), p.stride, size, p.patch / 2)
        store.write_chunks(new, output, "r+")
        store.write_attributes(spark, output, {"mesh": key})


def is_done(spark: SparkSession, output: str, images: DataFrame | None = None) -> bool:
    """Whether a store is flagged as aligned and, if images are given, the log has all of their slices."""
    if not store.read_attributes(spark, output).get("z_aligned"):
        return False
    if images is None:
        return True
    log = progress.read(spark, f"{output}/progress").where("step_name = 'align'")
    return progress.pending(images, log.select(F.col("collection").alias("dataset"), F.col("local_slice").alias("z")), ["dataset", "z"]).isEmpty()


def dataset_configs(plans: DataFrame, datasets: DataFrame, p: Align = Align()) -> DataFrame:
    """A document for each dataset that a plan's paths name, once, from the first path that names it.

    plans: (paths, reverse_order, dataset_local_bounds, destination_path);
    datasets: (name, path, z0). first_slice is the slice that the walk begins
    with: the last of a reversed dataset.
    """
    paths = plans.select("destination_path", "dataset_local_bounds", F.posexplode(F.arrays_zip("paths", "reverse_order")).alias("number", "p"))
    named = paths.select("destination_path", "dataset_local_bounds", "number", F.col("p.reverse_order").alias("reverse_order"), F.posexplode("p.paths").alias("place", "name"))
    first = named.groupBy("destination_path", "name").agg(F.min_by(F.struct("reverse_order", "dataset_local_bounds"), F.struct("number", "place")).alias("f"))
    own = first.join(datasets, "name")
    bounds = F.element_at("f.dataset_local_bounds", F.col("name"))
    start = F.when(F.col("f.reverse_order"), F.get(bounds, F.lit(1)) - 1).otherwise(F.get(bounds, F.lit(0)))
    flow = F.struct(F.lit(p.patch).alias("patch"), F.lit(p.stride).alias("stride"), F.lit(float(p.max_size)).alias("max_size"), F.lit(float(p.max_deviation)).alias("max_deviation"))
    mesh = F.struct(F.lit(p.mesh.dt).alias("dt"), F.lit(p.mesh.pull).alias("pull"), F.lit(p.mesh.spring).alias("spring"), F.lit(p.mesh.most).alias("most"))
    return own.select(
        F.col("name").alias("dataset_name"), F.col("path").alias("dataset_path"), start.cast("int").alias("first_slice"), F.col("z0").cast("int").alias("z_offset"),
        F.col("f.reverse_order").alias("reverse_order"), flow.alias("flow"), mesh.alias("mesh"), F.lit(p.scale).alias("scale"), F.concat_ws("/", "destination_path", "name").alias("output_path"),
    )
