"""Stores, logs, documents and small steps of the pipelines over the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, names, tables
from ..kernels import masks, register, resample
from ..operators import flow, graph, islands, progress, scores, stencil, volume
from ..operators import registration as reg
from ..sources import configs, store, tiles
from . import align, stitch
from .image_queries import LAP, px, rows
from .kernel_queries import slices
from .registry import VOLUME, Tables, query
from .table_queries import KNN, TILE_NAME, nearest

CELL = 32


def _spark(t: Tables) -> SparkSession:
    return t("region").sparkSession


def _totals(images: DataFrame) -> DataFrame:
    """(z, total): sum of the pixels of each slice."""
    return reg.quality(images, lambda image, mask: int(image.sum())).select("z", F.col("quality").cast("bigint").alias("total"))


def _stored(t: Tables) -> str:
    """A store of the whole volume, newly written."""
    path = f"{store.scratch(_spark(t))}/volume"
    store.write_chunks(store.cut(slices(t), CELL), path, "w")
    return path


@query("WITH {V} SELECT z, sum(CASE WHEN z % 2 = 0 THEN 255 - v ELSE v END)::BIGINT AS total FROM V GROUP BY z UNION ALL SELECT z + 1000, sum(v)::BIGINT FROM V GROUP BY z")
def store_modes(t: Tables) -> DataFrame:
    """Written anew, even slices replaced, all appended at higher z than the store has; reading only and writing where a store is are refused.

    The appended slices are told as 1000 higher: from there on, a deep store has slices of its own, and appending to those would merge both.
    """
    path, spark = _stored(t), _spark(t)
    even = reg.to_binary(stencil.invert(rows(t).where("z % 2 = 0")))
    store.write_chunks(store.cut(even, CELL), path, "r+")
    higher = max(1000, store.extent(store.open_chunks(spark, path)).first()["depth"] or 0)
    store.write_chunks(store.cut(slices(t).withColumn("z", F.col("z") + higher), CELL), path, "a")
    for mode in ("r", "w-"):
        try:
            store.write_chunks(store.cut(slices(t), CELL), path, mode)
        except Exception as e:  # refused, as it should be
            assert mode == "r" or "exists" in str(e).lower(), e
        else:
            raise AssertionError(f"mode {mode} wrote")
    totals = _totals(store.read_window(store.open_chunks(spark, path), (0, 1 << 30), size=CELL))
    z = F.col("z")
    return totals.withColumn("z", F.when(z >= higher, z - higher + 1000).otherwise(z))


@query("WITH {V} SELECT 'absent' AS which, 0::BIGINT AS chunks UNION ALL SELECT 'present', count(DISTINCT (z, y // 32, x // 32)) FROM V")
def store_missing_ok(t: Tables) -> DataFrame:
    """An absent store may be opened as an empty one."""
    spark, path = _spark(t), _stored(t)
    count = lambda which, p: store.open_chunks(spark, p, missing_ok=True).agg(F.lit(which).alias("which"), F.count("*").alias("chunks"))
    return count("absent", f"{path}-not").unionByName(count("present", path))


@query("WITH {V} SELECT z, count(DISTINCT y)::INT AS h, count(DISTINCT x)::INT AS w, sum(v)::BIGINT AS total FROM V WHERE z >= 1 AND z < 6 AND y >= 0 AND y < 40 AND x >= 20 AND x < 64 GROUP BY z")
def store_window(t: Tables) -> DataFrame:
    """A bounded view that keeps the slice numbers; bounds that reach out are clipped."""
    images = store.read_window(store.open_chunks(_spark(t), _stored(t)), (1, 6), (-5, 40), (20, 500), size=CELL)
    return images.select("z", "h", "w").join(_totals(images), "z")


@query("WITH {V} SELECT name, value FROM (VALUES ('kind', '\"image\"'), ('resolution', '[50, 10, 10]'), ('z_aligned', 'true')) a(name, value) UNION ALL SELECT 'depth', (max(z) + 1)::VARCHAR FROM V")
def store_attributes(t: Tables) -> DataFrame:
    """Attributes set in two goes: the second changes one and leaves the others."""
    spark, path = _spark(t), f"{store.scratch(_spark(t))}/volume"
    depth = volume.shape(rows(t)).first()["depth"]
    store.write_attributes(spark, path, {"resolution": [50, 10, 10], "depth": depth, "kind": "labels"})
    store.write_attributes(spark, path, {"kind": "image", "z_aligned": True})
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in store.read_attributes(spark, path).items()], "name string, value string")


@query("WITH {V} SELECT z, ((max(y) + 4) // 4)::INT AS h, ((max(x) + 4) // 4)::INT AS w, sum(v) FILTER (y % 4 = 0 AND x % 4 = 0)::BIGINT AS total FROM V GROUP BY z")
def pyramid_level(t: Tables) -> DataFrame:
    """The reduced copy of a store for inspection, written twice and read back."""
    spark, path = _spark(t), _stored(t)
    for _ in range(2):
        target = store.write_pyramid(spark, path, 4, CELL)
    images = store.read_window(store.open_chunks(spark, target), (0, 1 << 30), size=CELL)
    return images.select("z", "h", "w").join(_totals(images), "z")


@query("SELECT 1 AS round, count(*) AS n, 1 AS builds FROM part UNION ALL SELECT 2, count(*), 1 FROM part UNION ALL SELECT 3, count(*) * 2, 2 FROM part")
def cached_step(t: Tables) -> DataFrame:
    """An intermediate kept by its parameters: built once for the same, anew for others."""
    spark, folder, builds = _spark(t), store.scratch(_spark(t)), []

    def build(times: int) -> DataFrame:
        builds.append(times)
        return t("part").select(F.explode(F.array_repeat("p_partkey", times)).alias("k"))

    out = []
    for number, times in ((1, 1), (2, 1), (3, 2)):
        found = store.cached(spark, folder, {"times": times, "of": "part"}, lambda times=times: build(times))
        out.append(found.agg(F.lit(number).alias("round"), F.count("*").alias("n"), F.lit(len(builds)).alias("builds")))
    return out[0].unionByName(out[1]).unionByName(out[2])


LOG = "SELECT event_type AS collection, CASE WHEN event_id % 3 = 0 THEN 'flow' ELSE 'render' END AS step_name, (event_id % 1000)::INT AS z FROM events"


def _log(t: Tables) -> tuple[str, DataFrame]:
    """A log written a step at a time, and what it was made from."""
    path = f"{store.scratch(_spark(t))}/progress"
    done = t("events").select(F.col("event_type").alias("collection"), F.when(F.col("event_id") % 3 == 0, "flow").otherwise("render").alias("step_name"), (F.col("event_id") % 1000).cast("int").alias("z"))
    for step in ("flow", "render"):
        own = done.where(F.col("step_name") == step).select("collection", "step_name", F.col("z").alias("global_slice"), F.col("z").alias("local_slice"), F.current_timestamp().alias("ts"), F.to_json(F.struct("z")).alias("metadata"))
        progress.append(own, path)
    return path, done


@query(f"WITH L AS ({LOG}) SELECT collection, step_name, count(*) AS n, min(z) AS lo, max(z) AS hi, true AS stamped, sum(z)::BIGINT AS meta FROM L GROUP BY ALL")
def progress_log(t: Tables) -> DataFrame:
    """What a log holds after two steps have been appended: one document a slice, with the time and the step's own data."""
    path, _ = _log(t)
    log = progress.read(_spark(t), path)
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("ts")
    return log.groupBy("collection", "step_name").agg(F.count("*").alias("n"), F.min("global_slice").alias("lo"), F.max("local_slice").alias("hi"), F.bool_and(age.between(0, 86400)).alias("stamped"), F.sum(F.get_json_object("metadata", "$.z").cast("bigint")).alias("meta"))


@query(f"WITH L AS ({LOG}), W AS (SELECT DISTINCT collection, z FROM L), D AS (SELECT DISTINCT collection, z FROM L WHERE step_name = 'flow') SELECT collection, count(*) AS wanted, count(D.z) AS before, count(*) AS after, true AS complete FROM W LEFT JOIN D USING (collection, z) GROUP BY collection")
def progress_resume(t: Tables) -> DataFrame:
    """A run that goes on from a log: it works on what is pending only, and then there is nothing left to do."""
    spark = _spark(t)
    path, done = _log(t)
    wanted = done.select("collection", "z").distinct()
    logged = lambda step: progress.read(spark, path).where(F.col("step_name") == step).select("collection", F.col("local_slice").alias("z")).distinct()
    before = progress.completion(wanted, logged("flow"), ["collection"], ["collection", "z"]).select("collection", "wanted", F.col("done").alias("before"))
    before = graph.checkpoint(before)
    rest = progress.pending(wanted, logged("flow"), ["collection", "z"])
    progress.append(rest.select("collection", F.lit("flow").alias("step_name"), F.col("z").alias("global_slice"), F.col("z").alias("local_slice"), F.current_timestamp().alias("ts"), F.lit("{}").alias("metadata")), path)
    after = progress.completion(wanted, logged("flow"), ["collection"], ["collection", "z"])
    return before.join(after.select("collection", F.col("done").alias("after"), "complete"), "collection")


@query("WITH n AS (SELECT DISTINCT " + TILE_NAME.format(s="VARCHAR", w=3) + " AS path FROM lineitem) SELECT path, regexp_extract(path, '_s(\\d+)', 1)::INT AS z, regexp_extract(path, '-(\\d+)_s', 1)::INT - 1 AS ty, regexp_extract(path, 'Tile_(\\d+)-', 1)::INT - 1 AS tx FROM n WHERE path LIKE '%.tif'")
def backend_names(t: Tables) -> DataFrame:
    """Names read by the functions of a registered backend."""
    b, path = tiles.backend("tiles"), F.col("path")
    found = t("lineitem").select(F.expr(TILE_NAME.format(s="STRING", w=3)).alias("path")).distinct().where(path.endswith(b.extension))
    return found.select("path", b.tile_slice(path).alias("z"), b.tile_y(path).alias("ty"), b.tile_x(path).alias("tx"))


@query("SELECT p_partkey, '1.0' AS version, true AS created, p_size AS stride FROM part")
def config_stamp(t: Tables) -> DataFrame:
    """Documents of a table with the form's version and the time of their making."""
    p = configs.stamped(t("part").select("p_partkey", F.col("p_size").alias("stride")))
    made = F.to_timestamp("_created_at").between(F.current_timestamp() - F.expr("interval 1 hour"), F.current_timestamp())
    return p.select("p_partkey", F.col("_config_version").alias("version"), made.alias("created"), "stride")


@query("SELECT p_partkey, concat('most=', p_size + 8, CASE WHEN p_size % 2 = 0 THEN ',patch=' || p_size * 2 ELSE '' END, ',stride=', p_size) AS kept FROM part")
def accepted_fields(t: Tables) -> DataFrame:
    """Of each document's parameters those that a function takes, with their values."""
    size = F.col("p_size")
    given = F.create_map(F.lit("stride"), size, F.lit("patch"), F.when(size % 2 == 0, size * 2), F.lit("project"), F.length("p_name"), F.lit("most"), size + 8, F.lit("threads"), F.lit(4))
    kept = configs.accepted(F.map_filter(given, lambda _, v: v.isNotNull()), register.flow)
    return t("part").select("p_partkey", F.array_join(F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("kept"))


@query("SELECT l_orderkey, count(*) AS n, count(CASE WHEN l_linenumber % 4 > 1 THEN 1 END) AS valid, sum(CASE WHEN l_linenumber % 4 > 1 THEN l_quantity END) AS total, count(CASE WHEN l_linenumber % 4 > 1 THEN 1 END) = 0 AS none FROM lineitem GROUP BY 1")
def finite_flow(t: Tables) -> DataFrame:
    """NaN and infinite displacements become null; a slice without any valid one is told."""
    nan, inf = F.lit(float("nan")), F.lit(float("-inf"))
    raw = t("lineitem").select("l_orderkey", F.when(F.col("l_linenumber") % 4 == 0, nan).when(F.col("l_linenumber") % 4 == 1, inf).otherwise(F.col("l_quantity")).alias("dx"))
    f = flow.finite(raw, ("dx",))
    return f.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count("dx").alias("valid"), F.sum("dx").alias("total"), (F.count("dx") == 0).alias("none"))


@query("WITH {V} SELECT a.z, count(*) FILTER (b.v > 127) AS n, coalesce(sum(a.v) FILTER (b.v > 127), 0)::BIGINT AS total FROM V a JOIN V b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x GROUP BY a.z")
def image_with_mask(t: Tables) -> DataFrame:
    """Images with the masks of another store, line by line: what the mask leaves of each slice."""
    r = rows(t)
    mask = r.select((F.col("z") - 1).alias("z"), "y", F.transform("px", lambda v: v > 127).alias("mask"))
    both = volume.masked(volume.with_mask(r, mask).where("mask is not null"))
    return both.groupBy("z").agg(F.sum(F.size("px")).cast("bigint").alias("n"), F.sum(F.aggregate("px", F.lit(0).cast("bigint"), lambda a, v: a + v)).alias("total"))


@query("WITH M AS (SELECT n_nationkey AS z, 1.0 + n_nationkey / 8 AS a, n_nationkey * 2.0 AS tx FROM nation WHERE n_nationkey % 3 <> 0) SELECT s_suppkey, s_nationkey AS z, (coalesce(a, 1) * s_suppkey + coalesce(tx, 0))::DOUBLE AS x, a IS NULL AS identity FROM supplier LEFT JOIN M ON z = s_nationkey")
def transform_by_slice(t: Tables) -> DataFrame:
    """Points moved by the transform of their slice; a slice without one leaves them where they are."""
    k = F.col("n_nationkey")
    m = t("nation").where(k % 3 != 0).select(k.alias("z"), (1 + k / 8).alias("a"), (k * 2.0).alias("tx"))
    p = t("supplier").select("s_suppkey", F.col("s_nationkey").alias("z"), F.col("s_suppkey").alias("x"))
    return geometry.moved_by_slice(p, m).select("s_suppkey", "z", "x", "identity")


@query("SELECT c_custkey, c_nationkey % 2 = 0 AS invert, CASE WHEN c_nationkey % 2 = 0 THEN 255 - c_custkey % 256 ELSE c_custkey % 256 END AS v FROM customer")
def invert_lookup(t: Tables) -> DataFrame:
    """Each tile with its set's instruction to invert; a set without one is an error."""
    flags = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_nationkey") % 2 == 0).alias("invert"))
    v = F.col("c_custkey") % 256
    found = tiles.with_invert(t("customer"), flags, "c_nationkey").select("c_custkey", "invert", v.alias("v"))
    return found.withColumn("v", F.when(F.col("invert"), 255 - F.col("v")).otherwise(F.col("v")))


@query("WITH {V} SELECT z, bool_or(v > 175) AS any_bright, bool_and(v > 70) AS all_filled, bool_or(v = 0) AS any_empty FROM V GROUP BY z")
def any_all(t: Tables) -> DataFrame:
    found = rows(t).groupBy("z").agg(*volume.holds(lambda v: v > 175, "bright"), *volume.holds(lambda v: v > 70, "filled"), *volume.holds(lambda v: v == 0, "empty"))
    return found.select("z", "any_bright", "all_filled", "any_empty")


@query("SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER w AS before, lead(l_linenumber) OVER w AS after FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)")
def adjacent_slices(t: Tables) -> DataFrame:
    """The slices before and after each; none at the ends."""
    before, after = islands.beside("l_linenumber", "l_linenumber", ["l_orderkey"])
    return t("lineitem").select("l_orderkey", "l_linenumber").distinct().withColumns({"before": before, "after": after})


@query(f"WITH {KNN}, G AS (SELECT *, q % 7 AS pass FROM K WHERE d1 < 0.97 * d2) SELECT q, t1, pass, row_number() OVER (PARTITION BY pass ORDER BY d1, q)::INT AS rank FROM G")
def match_ranks(t: Tables) -> DataFrame:
    """Good matches of each pass in the order of their distance."""
    return scores.ranked(nearest(t), F.col("q") % 7, 0.97).select("q", "t1", "pass", "rank")


@query("WITH R AS (SELECT l_suppkey AS g, l_quantity * 100 + l_linenumber AS r, l_orderkey, l_partkey FROM lineitem), N AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY r) AS k, count(*) OVER (PARTITION BY g) AS n FROM R) SELECT g, count(*) AS n, min(r) AS least, max(r) AS most FROM N WHERE k > floor(n * 0.75) GROUP BY g")
def worst_quarter(t: Tables) -> DataFrame:
    """The residuals that a trimmed mean leaves out."""
    r = t("lineitem").select(F.col("l_suppkey").alias("g"), (F.col("l_quantity") * 100 + F.col("l_linenumber")).alias("r"))
    return scores.worst(r, "g", "r").groupBy("g").agg(F.count("*").alias("n"), F.min("r").alias("least"), F.max("r").alias("most"))


@query("SELECT n_name AS name, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey * 7 % 5, n_name)::INT AS place FROM nation")
def dataset_order(t: Tables) -> DataFrame:
    """Datasets by their offset along z, ties by name."""
    n = t("nation").select(F.col("n_name").alias("name"), "n_regionkey", (F.col("n_nationkey") * 7 % 5).alias("offset"))
    return islands.ordered(n, ["n_regionkey"], F.col("offset"), "name").drop("offset")


@query("SELECT l_suppkey, min(l_orderkey) AS first, arg_min(l_partkey, l_orderkey * 1000 + l_linenumber * 100000000 + l_partkey) AS part FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def first_match(t: Tables) -> DataFrame:
    """The first slice that fits, and the first match by a given order."""
    order = F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 100000000 + F.col("l_partkey")
    found = islands.first_of(t("lineitem"), ["l_suppkey"], F.col("l_returnflag") == "R", "l_orderkey", "l_partkey", order)
    return found.withColumnRenamed("l_partkey", "part")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN abs(l_quantity - 25) <= abs(l_suppkey % 60 - 30) THEN 'y' ELSE 'x' END AS axis, sign(l_quantity - 25)::INT AS side FROM lineitem")
def offset_axis(t: Tables) -> DataFrame:
    """The axis along which an offset is larger: a neighbour in a row or in a column."""
    dx, dy = F.col("l_quantity") - 25, F.col("l_suppkey") % 60 - 30
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(geometry.runs_down(dx, dy), "y").otherwise("x").alias("axis"), F.signum(dx).cast("int").alias("side"))


@query("SELECT c_custkey, lower(c_name) AS low, CASE WHEN contains(c_name, '#') THEN substr(c_name, instr(c_name, '#') + 1) ELSE c_name END AS tail, CASE WHEN contains(c_mktsegment, 'I') THEN substr(c_mktsegment, instr(c_mktsegment, 'I') + 1) ELSE c_mktsegment END AS rest, trim(concat('  ', c_mktsegment, ' ')) AS stripped, ends_with(c_name, '1') AS odd, CASE WHEN length(c_custkey::VARCHAR) < 3 THEN lpad(c_custkey::VARCHAR, 3, '0') ELSE c_custkey::VARCHAR END AS filled, replace((c_custkey % 100 / 4)::DOUBLE::VARCHAR, '.', '_') AS label FROM customer")
def name_parts(t: Tables) -> DataFrame:
    """Steps on names: case, what follows the first separator, white space, endings, filling up, numbers as labels."""
    c = F.col("c_custkey")
    return t("customer").select(
        "c_custkey", F.lower("c_name").alias("low"), names.tail(F.col("c_name"), "#").alias("tail"), names.tail(F.col("c_mktsegment"), "I").alias("rest"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("stripped"), F.col("c_name").endswith("1").alias("odd"),
        names.zero_filled(c, 3).alias("filled"), names.number_label(c % 100 / 4, 2).alias("label"),
    )


@query("SELECT DISTINCT l_linenumber - 3 AS tx, (l_suppkey % 5)::INT AS ty, concat('(', l_linenumber - 3, ', ', l_suppkey % 5, ')') AS key FROM lineitem")
def tile_keys(t: Tables) -> DataFrame:
    """Positions read from keys such as "(0, 1)"."""
    key = F.format_string("(%d, %d)", F.col("l_linenumber") - 3, F.col("l_suppkey") % 5)
    k = t("lineitem").select(key.alias("key")).distinct()
    at = names.key_numbers(F.col("key"))
    return k.select(F.get(at, F.lit(0)).alias("tx"), F.get(at, F.lit(1)).alias("ty"), "key")


@query("SELECT o_custkey, o_orderkey, greatest(o_orderkey - 300, min(o_orderkey) OVER w) AS lo, least(o_orderkey + 300, max(o_orderkey) OVER w + 1) AS hi FROM orders WINDOW w AS (PARTITION BY o_custkey)")
def clipped_bounds(t: Tables) -> DataFrame:
    """A window around each slice, clipped to its dataset."""
    return islands.clipped(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", 300)


@query("WITH {V} SELECT z, x AS y, y AS x, v FROM V")
def transposed(t: Tables) -> DataFrame:
    """Slices with lines and columns exchanged."""
    return volume.pixels(volume.transposed(rows(t)))


@query(f"WITH {VOLUME}, {LAP} SELECT z, y, x, l AS v FROM L")
def laplacian_pixels(t: Tables) -> DataFrame:
    return volume.pixels(stencil.laplacian(rows(t)))


@query("WITH {V}, I AS (SELECT z, 255 - v AS v FROM V), H AS (SELECT z, v, count(*) AS n FROM I GROUP BY ALL), C AS (SELECT z, v, n, sum(n) OVER (PARTITION BY z ORDER BY v)::BIGINT AS cdf, sum(n) OVER (PARTITION BY z)::BIGINT AS total FROM H), M AS (SELECT *, min(cdf) OVER (PARTITION BY z) AS low FROM C) SELECT z, sum(n * ((cdf - low) * 255 // greatest(total - low, 1)))::BIGINT AS total FROM M GROUP BY z")
def processing_chain(t: Tables) -> DataFrame:
    """Named steps in order, inversion first wherever it stands in the scheme."""
    scheme = {"equalize": {}, "invert": {}}
    return reg.quality(slices(t), lambda image, mask: int(masks.process(image, scheme).astype(int).sum())).select("z", F.col("quality").cast("bigint").alias("total"))


@query("WITH O AS (SELECT l_suppkey AS map, greatest(60 - greatest(abs(l_quantity * 2 - 50), abs(l_linenumber * 20 - 70)), 0) AS o FROM lineitem) SELECT map, max(o) AS overlap, count(*) FILTER (o = 0) AS apart FROM O GROUP BY map")
def tile_map_overlap(t: Tables) -> DataFrame:
    """Overlap that each pair of neighbours has left, and the largest of a map."""
    o = geometry.overlap_left(F.lit(60), F.col("l_quantity") * 2 - 50, F.col("l_linenumber") * 20 - 70)
    return t("lineitem").select(F.col("l_suppkey").alias("map"), o.alias("o")).groupBy("map").agg(F.max("o").alias("overlap"), F.count_if(F.col("o") == 0).alias("apart"))


@query("WITH T AS (SELECT n_regionkey AS map, (row_number() OVER w - 1) % 3 AS tx, (row_number() OVER w - 1) // 3 AS ty, 50 + n_nationkey % 4 AS h, 60 + n_nationkey % 3 AS w FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey)), M AS (SELECT map, max(h) AS mh, max(w) AS mw, max(tx) AS mx, max(ty) AS my FROM T GROUP BY map) SELECT map, tx, ty, h, w, CASE WHEN ty = my THEN 0 ELSE mh - h END AS top, CASE WHEN ty = my THEN mh - h ELSE 0 END AS bottom, CASE WHEN tx = mx THEN mw - w ELSE 0 END AS l, CASE WHEN tx = mx THEN 0 ELSE mw - w END AS r FROM T JOIN M USING (map)")
def equal_tile_shapes(t: Tables) -> DataFrame:
    """Pads that make all tiles of a map the same shape, away from the sides that face a neighbour."""
    n = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).cast("bigint") - 1
    m = t("nation").select(F.col("n_regionkey").alias("map"), (n % 3).alias("tx"), F.floor(n / 3).alias("ty"), (50 + F.col("n_nationkey") % 4).alias("h"), (60 + F.col("n_nationkey") % 3).alias("w"))
    return geometry.equal_shapes(m, "map")


@query("SELECT p_partkey, (p_size + 9)::DOUBLE / 10 AS ratio, greatest(1, floor(640 * (p_size + 9)::DOUBLE / 10))::INT AS h FROM part")
def resolution_ratio(t: Tables) -> DataFrame:
    """What a dataset is scaled by to match the resolution of the others, which must not be coarser."""
    ratio = geometry.scale_ratio(F.col("p_size") + 9, F.lit(10), 1.0)
    return t("part").select("p_partkey", ratio.alias("ratio"), F.greatest(F.lit(1), F.floor(640 * ratio)).cast("int").alias("h"))


@query("WITH {V}, S AS (SELECT z, y, x, v FROM V WHERE y < 8 AND x < 8), G AS (SELECT z, i::INT AS gy, j::INT AS gx FROM (SELECT DISTINCT z FROM S), range(15) a(i), range(15) b(j)) SELECT G.z, gy, gx, ((a.v + b.v + c.v + d.v) / 4.0)::DOUBLE * 2 AS dx FROM G JOIN S a ON a.z = G.z AND a.y = gy // 2 AND a.x = gx // 2 JOIN S b ON b.z = G.z AND b.y = (gy + 1) // 2 AND b.x = gx // 2 JOIN S c ON c.z = G.z AND c.y = gy // 2 AND c.x = (gx + 1) // 2 JOIN S d ON d.z = G.z AND d.y = (gy + 1) // 2 AND d.x = (gx + 1) // 2")
def upsampled_flow(t: Tables) -> DataFrame:
    """A flow of half scale on the grid of the full one: places in between are interpolated, values doubled; the flow is a slice's first 8 x 8 pixels."""
    field = px(t).where("y < 8 and x < 8").select("z", F.col("y").alias("gy"), F.col("x").alias("gx"), F.col("v").cast("double").alias("dx"), F.lit(0.0).alias("dy"))
    return reg.by_slice(field, lambda f: resample.upsample_field(f, (15, 15), 0.5)).select("z", "gy", "gx", "dx")


SPANS = """S AS (SELECT s_suppkey AS k, concat('s', lpad(s_suppkey::VARCHAR, 5, '0')) AS stack, (s_suppkey * 379 % (8 * (SELECT count(*) FROM supplier)))::INT AS lo, (s_suppkey * 379 % (8 * (SELECT count(*) FROM supplier)) + s_suppkey % 17 + 2)::INT AS hi FROM supplier),
N AS (SELECT *, CASE WHEN lo > max(hi) OVER (ORDER BY lo, stack ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM S),
C AS (SELECT *, sum(new) OVER (ORDER BY lo, stack) AS g FROM N), K AS (SELECT g, min(stack) AS component FROM C GROUP BY g), F AS (SELECT C.*, component FROM C JOIN K USING (g))"""


def _spans(t: Tables) -> DataFrame:
    n = t("supplier").agg((8 * F.count("*")).alias("n"))
    lo = F.col("s_suppkey") * 379 % F.col("n")
    s = t("supplier").crossJoin(F.broadcast(n))  # one row
    return s.select(F.concat(F.lit("s"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("stack"), lo.cast("int").alias("z_start"), (lo + F.col("s_suppkey") % 17 + 2).cast("int").alias("z_end"))


@query(f"WITH {SPANS} SELECT stack, component FROM F")
def fuse_groups(t: Tables) -> DataFrame:
    """Stacks that share slices, directly or through others."""
    return stitch.fuse_groups(_spans(t))


@query(f"WITH {SPANS} SELECT component, list(stack || '.zarr' ORDER BY stack) AS dataset_paths, list(lo ORDER BY stack) AS z_offsets, min(lo) AS zmin, max(hi) + 1 AS zmax FROM F GROUP BY component HAVING count(*) > 1")
def fuse_configs(t: Tables) -> DataFrame:
    """A document for each group of several stacks."""
    s = _spans(t)
    return stitch.fuse_configs(s.withColumn("path", F.concat("stack", F.lit(".zarr"))), stitch.fuse_groups(s))


@query("SELECT n_name AS dataset_name, concat('out', n_regionkey, '/', n_name) AS output_path, n_nationkey % 2 = 0 AS reverse_order, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey % 7 + 9 ELSE n_nationkey % 7 END AS first_slice, n_nationkey * 3 AS z_offset, 32 AS patch FROM nation")
def dataset_configs(t: Tables) -> DataFrame:
    """A document for each dataset on a plan's paths; one that several paths name is in the first."""
    k = F.col("n_nationkey")
    n = t("nation")
    one = F.struct(k.alias("k"), F.array("n_name").alias("path"), (k % 2 == 0).alias("turned"))
    entry = F.struct("n_name", F.array((k % 7).cast("int"), (k % 7 + 10).cast("int")))
    p = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(one)).alias("p"), F.map_from_entries(F.collect_list(entry)).alias("dataset_local_bounds"))
    plans = p.select(
        F.concat(F.lit("out"), "n_regionkey").alias("destination_path"), "dataset_local_bounds",
        F.concat(F.transform("p", lambda x: x["path"]), F.array(F.flatten(F.transform("p", lambda x: x["path"])))).alias("paths"),
        F.concat(F.transform("p", lambda x: x["turned"]), F.array(F.lit(False))).alias("reverse_order"),
    )
    datasets = n.select(F.col("n_name").alias("name"), F.concat(F.col("n_name"), F.lit(".zarr")).alias("path"), (k * 3).alias("z0"))
    return align.dataset_configs(plans, datasets).select("dataset_name", "output_path", "reverse_order", "first_slice", "z_offset", "flow.patch")


MATCHES = "M AS (SELECT (n_nationkey // 2)::BIGINT AS u, n_nationkey::BIGINT AS v, (n_nationkey * 5 % 9 - 4)::BIGINT AS dx, (n_nationkey * 7 % 5 - 2)::BIGINT AS dy, n_nationkey % 7 AS score FROM nation WHERE n_nationkey > 0)"


@query(f"WITH RECURSIVE {MATCHES}, E AS (SELECT u, v, CASE WHEN abs(dx) <= abs(dy) THEN 0 ELSE sign(dx) END::BIGINT AS dx, CASE WHEN abs(dx) <= abs(dy) THEN sign(dy) ELSE 0 END::BIGINT AS dy FROM M WHERE score >= 2), B AS (SELECT * FROM E UNION ALL SELECT v, u, -dx, -dy FROM E), R AS (SELECT n AS root, n AS node, 0::BIGINT AS x, 0::BIGINT AS y FROM (SELECT u AS n FROM M UNION SELECT v FROM M) UNION SELECT R.root, B.v, R.x + B.dx, R.y + B.dy FROM R JOIN B ON B.u = R.node WHERE abs(R.x) < 50 AND abs(R.y) < 50), C AS (SELECT node, min(root) AS component FROM R GROUP BY node), P AS (SELECT R.node, component, x, y FROM C JOIN R ON R.root = component AND R.node = C.node) SELECT node, component, x - min(x) OVER w AS tx, y - min(y) OVER w AS ty FROM P WINDOW w AS (PARTITION BY component)")
def tile_map_positions(t: Tables) -> DataFrame:
    """Tile maps from pairwise matches: good ones form connected parts, each with a grid of its own."""
    k = F.col("n_nationkey").cast("bigint")
    m = t("nation").where(k > 0).select(F.floor(k / 2).alias("u"), k.alias("v"), (k * 5 % 9 - 4).alias("dx"), (k * 7 % 5 - 2).alias("dy"), (k % 7).alias("score"))
    return graph.tile_map(m, 2)


@query("WITH {V} SELECT z, y, x, v - 120 AS v FROM V WHERE v > 120")
def pixels_udtf(t: Tables) -> DataFrame:
    """A table function of the engine, called from SQL with a lateral join."""
    spark = _spark(t)
    tables.register(spark)
    lines = rows(t).withColumn("px", F.transform("px", lambda v: F.greatest(v - 120, F.lit(0))))
    return spark.sql("SELECT z, y, p.x, p.v FROM {lines} l, LATERAL explode_pixels(l.px) p", lines=lines)


@query("WITH D AS (SELECT o_custkey AS k, o_orderkey, o_totalprice > 100000 AS ok FROM orders), R AS (SELECT *, max(CASE WHEN ok THEN o_orderkey END) OVER (PARTITION BY k ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reference FROM D) SELECT k, o_orderkey, reference, CASE WHEN ok AND reference IS NOT NULL THEN o_orderkey - reference END AS step FROM R")
def fold_references(t: Tables) -> DataFrame:
    """What a walk along z aligns each slice to: the last valid one; invalid slices leave it as it was."""
    d = t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey", (F.col("o_totalprice") > 100000).alias("ok"))
    r = islands.last_valid(d, "o_orderkey", F.col("ok"), ["k"])
    return r.select("k", "o_orderkey", "reference", F.when(F.col("ok"), F.col("o_orderkey") - F.col("reference")).alias("step"))
