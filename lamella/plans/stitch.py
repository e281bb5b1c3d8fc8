"""Pipelines in the plane: stacks from a tile catalogue, tiles to slices, overlapping stacks to one."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..kernels import elastic, masks, register, resample
from ..operators import graph, islands, progress, registration, tilemaps
from ..sources import configs, store, tiles

SLICE = "stack string, z int, h int, w int, px binary, mask binary, score double"


@dataclass(frozen=True)
class Stitch:
    """Parameters of the plane."""

    overlap: int = 16
    ladder: tuple[float, ...] = (1.0, 2.0)  # search range, in overlaps, until the edges are trusted
    scheme: dict = field(default_factory=dict)
    mesh: register.Mesh | None = register.Mesh()  # None: tiles are placed, not deformed
    patch: int = 16
    stride: int = 8
    margin: int = 2  # cut off tiles on the sides that face a neighbour
    work: int = 1024  # pixels of a work tile's side when warping


def stacks(catalogue: DataFrame) -> DataFrame:
    """(island, stack, z_start, z_end, members, combined): runs of slices that the same tilesets cover.

    A run of one tileset is named by its number and the tileset, one of several
    by all of them joined.
    """
    m = islands.membership(catalogue.select("z", "tileset").distinct(), "z", "tileset")
    i = islands.islands(m, "z", F.col("members"))
    out = i.groupBy("island").agg(F.min("z").alias("z_start"), F.max("z").alias("z_end"), F.first("members").alias("members"))
    name = F.concat_ws("_", names.zero_filled(F.col("island"), 2), F.array_join("members", "_"))
    return out.select("island", name.alias("stack"), "z_start", "z_end", "members", (F.size("members") > 1).alias("combined"))


def prepare(spark: SparkSession, main_dir: str, resolution: tuple[int, int], patterns: list[str], invert: dict[str, bool], output: str, kind: str = "tiles", thickness: int = 50, offset: tuple[int, int, int] = (0, 0, 0), **matching) -> DataFrame:
    """Find tilesets, form stacks, write their documents under output/config; the stacks.

    invert says for each tileset whether its tiles are inverted; one without an
    entry is an error. Tilesets of a combined stack are put on one grid by their
    images, matching has the parameters for that (see combine()).
    """
    sets = tiles.tilesets(spark, main_dir, resolution, patterns, kind).select("tileset").distinct()
    found = tiles.catalogue(spark, main_dir, kind).join(sets, "tileset", "left_semi")
    flags = spark.createDataFrame(sorted(invert.items()), "tileset string, invert boolean")
    found = tiles.with_invert(found, F.broadcast(flags), "tileset")
    s = stacks(found)
    named = s.select("stack", "combined", "z_start", "z_end", F.explode("members").alias("tileset"))
    own = found.join(named, "tileset").where("z between z_start and z_end")
    if not s.where("combined").isEmpty():
        own = graph.checkpoint(own.where("not combined").unionByName(combine(own.where("combined"), **matching)))
        s = own.groupBy("stack").agg(F.min("z_start").alias("z_start"), F.max("z_end").alias("z_end"), F.array_sort(F.collect_set("tileset")).alias("members"), F.first("combined").alias("combined"))
        s = s.select(F.split("stack", "_")[0].cast("long").alias("island"), "stack", "z_start", "z_end", "members", "combined")
    key = F.format_string("(%d, %d)", "tx", "ty")
    by_slice = own.groupBy("stack", "z_start", "z_end", "z").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key.alias("k"), "path")))).alias("tiles"), F.map_from_entries(F.array_distinct(F.collect_list(F.struct(key.alias("k"), "invert")))).alias("inverts"))
    docs = by_slice.groupBy("stack", "z_start", "z_end").agg(F.map_from_entries(F.collect_list(F.struct(F.col("z").cast("string"), "tiles"))).alias("tile_maps"), F.first("inverts").alias("tile_maps_invert"))
    docs = docs.join(s.select("stack", "combined"), "stack").select("stack", "combined", "z_start", "z_end", "tile_maps", "tile_maps_invert")
    docs.write.mode("overwrite").json(f"{output}/config/stacks")
    main = spark.createDataFrame([(main_dir, [thickness, *resolution], list(offset), output)], "main_dir string, resolution array<int>, offset array<int>, output_path string")
    main.write.mode("overwrite").json(f"{output}/config/main")
    return s


def combine(own: DataFrame, scheme: dict | None = None, **options) -> DataFrame:
    """Tiles of combined stacks (stack, tileset, z_start, z, tx, ty, path, invert, combined, ...) on the grid that their images show.

    The first slice of a stack decides, its tiles processed by scheme; for
    options see ``tilemaps.grids``. Tilesets whose tiles match are one stack, by
    the names of all of them; one that matches no other is a stack of its own.
    """
    spark = own.sparkSession
    first = own.where("z = z_start")
    # The files of one slice of each combined stack, fewer than Spark's own listing holds.
    paths = [r.path for r in first.select("path").distinct().collect()]
    content = spark.read.format("binaryFile").load(paths).select("path", "content")
    node = F.format_string("%s/%s/%d-%d", "stack", "tileset", "tx", "ty").alias("node")
    files = first.select(F.col("stack").alias("grp"), "tileset", "tx", "ty", "invert", "path", node).join(content, "path")
    loaded = graph.checkpoint(tiles.load(files, scheme))
    found = graph.checkpoint(tilemaps.grids(loaded, **options))
    names_of = found.groupBy("grp", "component").agg(F.array_sort(F.collect_set("tileset")).alias("members"))
    moved = own.join(found.withColumnRenamed("grp", "stack"), ["stack", "tileset"])
    moved = moved.join(names_of.withColumnRenamed("grp", "stack"), ["stack", "component"])
    moved = moved.withColumns({"tx": F.col("tx") + F.col("ox"), "ty": F.col("ty") + F.col("oy")})
    low = moved.groupBy("stack", "component").agg(F.min("tx").alias("lx"), F.min("ty").alias("ly"))
    name = F.concat_ws("_", F.split("stack", "_")[0], F.array_join("members", "_"))
    return moved.join(low, ["stack", "component"]).select(
        *[c for c in own.columns if c not in ("stack", "tx", "ty", "combined")],
        name.alias("stack"),
        (F.col("tx") - F.col("lx")).cast("int").alias("tx"),
        (F.col("ty") - F.col("ly")).cast("int").alias("ty"),
        (F.size("members") > 1).alias("combined"),
    )


def geometry_of(spark: SparkSession, output: str) -> dict:
    """Attributes of the stores below output, from the main document: offset in voxels and in nanometres, and resolution, in order z, y, x."""
    found = store.exists(spark, f"{output}/config/main") and spark.read.schema(configs.MAIN).json(f"{output}/config/main").first()
    resolution, offset = (found.resolution, found.offset) if found else ([50, 10, 10], [0, 0, 0])
    return {"voxel_offset": offset, "resolution": resolution, "offset": [a * b for a, b in zip(offset, resolution, strict=True)]}


def stitch_slice(images: dict[tuple[int, int], np.ndarray], p: Stitch) -> tuple[np.ndarray, np.ndarray, float | None]:
    """One slice from its tiles by (x, y): image, mask, and the median score of its seams.

    Tiles are placed by coarse offsets, then deformed until their seams agree.
    """
    offsets, scores = {}, []
    for wide in p.ladder:
        offsets = register.coarse_offsets(images, p.overlap, int(max(2, p.overlap * wide / 2)))
        if all(np.hypot(*o) < p.overlap for o in offsets.values()):
            break
    at = register.place({k: v.shape for k, v in images.items()}, offsets, p.overlap)
    keys = sorted(images)
    spots = [(round(at[k][1]), round(at[k][0])) for k in keys]
    tiles_of = [images[k] for k in keys]
    pairs = [(keys.index(a), keys.index(b)) for a, b in offsets]
    seams = elastic.Seams(p.patch, p.stride)
    meshes = np.zeros((2, len(keys), *np.max([elastic.nodes_of(i.shape, p.stride) for i in tiles_of], axis=0)))
    if p.mesh is not None and pairs:
        meshes, _ = elastic.relax(tiles_of, spots, pairs, seams, p.mesh)
    edge = lambda x, y: p.margin * int((x, y) in images)
    margins = [(edge(x, y - 1), edge(x, y + 1), edge(x - 1, y), edge(x + 1, y)) for x, y in keys]
    out, mask, warped = elastic.render(tiles_of, spots, meshes, p.stride, margins, p.work)
    for a, b in pairs:
        (ya, xa), (yb, xb) = spots[a], spots[b]
        y0, x0 = max(ya, yb), max(xa, xb)
        y1, x1 = (min(spots[a][k] + tiles_of[a].shape[k], spots[b][k] + tiles_of[b].shape[k]) for k in (0, 1))
        if y1 - y0 > 2 and x1 - x0 > 2:
            va, vb = (masks.sharpness(warped[k][0][y0 - y : y1 - y, x0 - x : x1 - x])["laplacian"] for k, (y, x) in ((a, spots[a]), (b, spots[b])))
            scores.append(1.0 if max(va, vb) == 0 else 1 - abs(va - vb) / max(va, vb))
    ys, xs = np.nonzero(mask)
    box = np.s_[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1]
    out, mask = out[box], mask[box]
    return out, mask, float(np.median(scores)) if scores else None


def stitch(tile_images: DataFrame, p: Stitch = Stitch()) -> DataFrame:
    """(stack, z, h, w, px, mask, score) from tiles (stack, z, tx, ty, h, w, px); tiles that couldn't be read are left out.

    A task holds the tiles of one slice.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        images = {(r["tx"], r["ty"]): np.frombuffer(r["px"], np.uint8).reshape(int(r["h"]), int(r["w"])) for r in frame.dropna(subset=["px"]).to_dict("records")}
        columns = ["stack", "z", "h", "w", "px", "mask", "score"]
        if not images:
            return pd.DataFrame(columns=columns)
        out, mask, score = stitch_slice(images, p)
        return pd.DataFrame([(frame["stack"].iloc[0], frame["z"].iloc[0], *out.shape, out.tobytes(), mask.tobytes(), score)], columns=columns)

    return tile_images.select("stack", "z", "tx", "ty", "h", "w", "px").groupBy("stack", "z").applyInPandas(run, SLICE)


def run(spark: SparkSession, output: str, p: Stitch = Stitch(), start_over: bool = False, inspect: int = 0) -> None:
    """Stitch the slices of all prepared stacks that the log doesn't have yet, into a store for each stack.

    inspect, if not 0, is the factor of a reduced copy beside each store.
    """
    docs = spark.read.schema("stack string, " + configs.STACK).json(f"{output}/config/stacks").withColumn("_file", F.col("stack"))
    log_path = f"{output}/progress"
    log = progress.read(spark, log_path)
    wanted = configs.tile_maps(docs).withColumnRenamed("_file", "stack")
    if not start_over:
        done = log.where("step_name = 'stitch'").select(F.col("collection").alias("stack"), F.col("local_slice").alias("z")).distinct()
        wanted = progress.pending(wanted, done, ["stack", "z"])
    files = wanted.join(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif").load(_folder(wanted)).select("path", "content"), "path") if not wanted.isEmpty() else None
    if files is None:
        return
    attributes = geometry_of(spark, output)
    whole = stitch(tiles.load(files, p.scheme), p)
    names_of = [r.stack for r in docs.select("stack").distinct().collect()]  # stacks, as many as there are documents
    slices = f"{output}/slices"
    whole.write.mode("overwrite").partitionBy("stack").parquet(slices)
    written = spark.read.parquet(slices)
    for name in names_of:
        own = written.where(F.col("stack") == name)
        store.write_chunks(store.cut(own), f"{output}/{name}", "r+")
        store.write_attributes(spark, f"{output}/{name}", attributes)
        if inspect:
            store.write_pyramid(spark, f"{output}/{name}", inspect)
    log_rows = written.select(F.col("stack"), F.col("z").alias("global_slice"), F.col("z").alias("local_slice"), "score")
    entry = log_rows.select(F.col("stack").alias("collection"), F.lit("stitch").alias("step_name"), "global_slice", "local_slice", F.current_timestamp().alias("ts"), F.to_json(F.struct("score")).alias("metadata"))
    progress.append(entry, log_path)


def _folder(wanted: DataFrame) -> str:
    """The folder above all tiles: the common beginning of the first and the last path."""
    low, high = wanted.agg(F.min("path"), F.max("path")).first()
    n = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
    return low[:n].rpartition("/")[0]


def fuse_groups(spans: DataFrame, matched: DataFrame | None = None) -> DataFrame:
    """(stack, component): stacks (stack, z_start, z_end) whose slices overlap, directly or through others.

    matched (u, v), if given, keeps only the overlaps between stacks whose images
    were found to match.
    """
    s = spans.withColumn("hi", F.col("z_end") + 1)
    pairs = islands.overlapping(s, "stack", "z_start", "hi").select(F.col("stack").alias("u"), F.col("other").alias("v"))
    if matched is not None:
        pairs = pairs.join(matched, ["u", "v"], "left_semi")
    return graph.components(s.select(F.col("stack").alias("node")), pairs).select(F.col("node").alias("stack"), "component")


def fuse_configs(spans: DataFrame, groups: DataFrame) -> DataFrame:
    """(component, dataset_paths, z_offsets, zmin, zmax) of each group of several stacks (stack, path, z_start, z_end); zmax is exclusive."""
    own = spans.join(groups, "stack")
    rows = F.array_sort(F.collect_list(F.struct("path", "z_start")))
    found = own.groupBy("component").agg(rows.alias("r"), F.min("z_start").alias("zmin"), (F.max("z_end") + 1).alias("zmax")).where(F.size("r") > 1)
    return found.select("component", F.transform("r", lambda x: x["path"]).alias("dataset_paths"), F.transform("r", lambda x: x["z_start"]).alias("z_offsets"), "zmin", "zmax")


def fuse(images: DataFrame, quality=None, seams: elastic.Seams = elastic.Seams(), mesh: register.Mesh | None = register.Mesh(), target: float | None = None) -> DataFrame:
    """(z, h, w, px, mask) of one canvas from overlapping slices (stack, z, h, w, px, mask[, resolution]).

    With a target resolution, slices are scaled to it first; their masks must
    then be null, which is where pixels are 0.

    In each z the stacks are taken one after the other: each is aligned to the
    canvas so far by a similarity, deformed where both have pixels (unless mesh
    is None), and there the sharper one goes on top. Slices are independent of
    each other; a task holds those of one z.
    """
    quality = quality or (lambda image, mask: masks.sharpness(image, mask)["quality"])
    if target is not None:
        images = registration.at_resolution(images, target)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        canvas = mask = None
        for r in frame.sort_values("stack").to_dict("records"):
            own = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"])
            have = own > 0 if r["mask"] is None else np.frombuffer(r["mask"], np.uint8).reshape(own.shape) > 0
            if not own.any():
                continue
            if canvas is None:
                canvas, mask = own.copy(), have.copy()
                continue
            e = register.estimate(canvas, own)
            if e.matrix is not None and e.robust:
                m, shape, (dx, dy) = resample.canvas(e.matrix, own.shape)
                own, have = resample.warp_affine(own, m, shape), resample.warp_affine(have, m, shape)
            else:
                dx = dy = 0
            h, w = max(canvas.shape[0] + dy, own.shape[0]), max(canvas.shape[1] + dx, own.shape[1])
            grow = lambda a, y, x, h=h, w=w: np.pad(a, ((y, h - y - a.shape[0]), (x, w - x - a.shape[1])))
            canvas, mask, own, have = grow(canvas, dy, dx), grow(mask, dy, dx), grow(own, 0, 0), grow(have, 0, 0)
            both = mask & have
            if mesh is not None and both.any() and e.matrix is not None and e.robust:
                own, have = elastic.onto(canvas, mask, own, have, seams, mesh)
                both = mask & have
            on_top = have if not both.any() or quality(own, both) > quality(canvas, both) else have & ~mask
            canvas = np.where(on_top, own, canvas)
            mask |= have
        if canvas is None:
            return pd.DataFrame(columns=["z", "h", "w", "px", "mask"])
        ys, xs = np.nonzero(mask)
        box = np.s_[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1]
        canvas, mask = canvas[box], mask[box]
        return pd.DataFrame([(frame["z"].iloc[0], *canvas.shape, canvas.tobytes(), mask.tobytes())], columns=["z", "h", "w", "px", "mask"])

    return images.select("stack", "z", "h", "w", "px", "mask").groupBy("z").applyInPandas(run, "z int, h int, w int, px binary, mask binary")
