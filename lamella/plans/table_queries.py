"""Metadata, windows, joins, aggregates and sets over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry, names
from ..operators import asof, islands, progress, scores
from .image_queries import HOLED, holed, rows
from .registry import VOLUME, Tables, query

TILE_NAME = "concat('/stack_', l_suppkey % 5, '/Tile_', lpad(CAST(l_linenumber AS {s}), 3, '0'), '-', lpad(CAST(l_partkey % 50 + 1 AS {s}), {w}, '0'), '_s', lpad(CAST(l_orderkey % 10000 AS {s}), 4, '0'), '.tif')"


@query("WITH n AS (SELECT DISTINCT " + TILE_NAME.format(s="VARCHAR", w=2) + " AS path FROM lineitem) SELECT path, regexp_extract(path, '([^/]+)/[^/]*$', 1) AS stack, regexp_extract(path, 'Tile_(\\d+)-', 1)::INT - 1 AS tx, regexp_extract(path, '-(\\d+)_s', 1)::INT - 1 AS ty, regexp_extract(path, '_s(\\d+)', 1)::INT AS z FROM n")
def tile_name_parse(t: Tables) -> DataFrame:
    p = t("lineitem").select(F.expr(TILE_NAME.format(s="STRING", w=2)).alias("path")).distinct()
    c = F.col("path")
    return p.select("path", names.parent_name(c).alias("stack"), names.tile_x(c).alias("tx"), names.tile_y(c).alias("ty"), names.tile_slice(c).alias("z"))


INFO = """L AS (
    SELECT p_partkey, 2 AS n, concat('Pixel Size: ', p_size, ' ', p_size + 1, ' nm') AS line FROM part WHERE p_partkey % 3 <> 0
    UNION ALL SELECT p_partkey, 5, concat(p_size * 2, ' x ', p_size * 3) FROM part WHERE p_partkey % 5 <> 0
    UNION ALL SELECT p_partkey, 0, concat('resolution of ', p_brand) FROM part WHERE p_partkey % 2 = 0
)"""


@query(f"WITH {INFO}, N AS (SELECT p_partkey, n, lower(line) LIKE '%resolution%' OR lower(line) LIKE '%pixel size%' AS said, regexp_extract_all(line, '\\d+') AS v FROM L), B AS (SELECT p_partkey, arg_min(v, n) FILTER (said AND len(v) >= 2) AS a, arg_min(v, n) FILTER (n = 5 AND len(v) >= 2) AS b FROM N GROUP BY 1) SELECT p_partkey, coalesce(a, b)[1]::INT AS res_y, coalesce(a, b)[2]::INT AS res_x FROM B")
def info_resolution_parse(t: Tables) -> DataFrame:
    p = t("part")
    line = lambda n, text, where: p.where(where).select("p_partkey", F.lit(n).alias("n"), text.alias("line"))
    size = F.col("p_size")
    lines = line(2, F.concat(F.lit("Pixel Size: "), size, F.lit(" "), size + 1, F.lit(" nm")), "p_partkey % 3 <> 0")
    lines = lines.unionByName(line(5, F.concat(size * 2, F.lit(" x "), size * 3), "p_partkey % 5 <> 0"))
    lines = lines.unionByName(line(0, F.concat(F.lit("resolution of "), F.col("p_brand")), "p_partkey % 2 = 0"))
    return names.resolution(lines, "p_partkey")


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, CASE WHEN url LIKE '%/%' THEN list_extract(string_split(url, '/'), -2) END AS parent, len(string_split(url, '/')) AS depth FROM pages")
def path_parts(t: Tables) -> DataFrame:
    url = F.col("url")
    return t("pages").select("page_id", names.base_name(url).alias("base"), names.parent_name(url).alias("parent"), F.size(F.split(url, "/")).cast("bigint").alias("depth"))


@query("SELECT DISTINCT concat('(', l_linenumber, ', ', l_suppkey % 9 - 4, ')') AS k, [l_linenumber::INT, (l_suppkey % 9 - 4)::INT] AS pos, (l_linenumber + l_suppkey % 9 - 4)::INT AS total FROM lineitem")
def tuple_key_parse(t: Tables) -> DataFrame:
    k = t("lineitem").select(F.format_string("(%d, %d)", "l_linenumber", F.col("l_suppkey") % 9 - 4).alias("k")).distinct()
    pos = names.key_numbers(F.col("k"))
    return k.select("k", pos.alias("pos"), F.aggregate(pos, F.lit(0), lambda a, b: a + b).alias("total"))


@query("SELECT n_nationkey, CASE WHEN n_name || '.zarr' LIKE '%.zarr' THEN left(n_name || CASE WHEN n_nationkey % 2 = 0 THEN '.zarr' ELSE '_raz' END, length(n_name) + CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE 4 END) END AS name FROM nation")
def strip_suffix(t: Tables) -> DataFrame:
    stored = F.concat("n_name", F.when(F.col("n_nationkey") % 2 == 0, ".zarr").otherwise("_raz"))
    return t("nation").select("n_nationkey", names.without_suffix(stored, ".zarr").alias("name"))


@query("SELECT r_regionkey, string_agg(n_name, '_' ORDER BY n_name) AS name FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def fused_name(t: Tables) -> DataFrame:
    n = t("nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    return t("region").join(n, F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", F.array_join("names", "_").alias("name"))


ISLANDS = """D AS (SELECT o_orderdate::DATE AS z, string_agg(DISTINCT o_orderstatus, '' ORDER BY o_orderstatus) AS members FROM orders GROUP BY 1),
N AS (SELECT *, CASE WHEN members IS DISTINCT FROM lag(members) OVER (ORDER BY z) THEN 1 ELSE 0 END AS new FROM D),
I AS (SELECT z, members, sum(new) OVER (ORDER BY z)::BIGINT AS island FROM N)"""


def order_islands(t: Tables) -> DataFrame:
    m = islands.membership(t("orders").withColumn("z", F.to_date("o_orderdate")), "z", "o_orderstatus").withColumn("members", F.array_join("members", ""))
    return islands.islands(m, "z", F.col("members"))


@query(f"WITH {ISLANDS} SELECT island, any_value(members) AS members, min(z) AS z_start, max(z) AS z_end, count(*) AS n FROM I GROUP BY island")
def islands_membership(t: Tables) -> DataFrame:
    """Days in a row on which the same set of order states occurs."""
    return order_islands(t).groupBy("island").agg(F.first("members").alias("members"), F.min("z").alias("z_start"), F.max("z").alias("z_end"), F.count("*").alias("n"))


@query(f"WITH {ISLANDS} SELECT DISTINCT island, CASE WHEN island < 10 THEN '0' ELSE '' END || island || '_' || members AS name FROM I")
def island_naming(t: Tables) -> DataFrame:
    return order_islands(t).select("island", F.concat_ws("_", names.zero_filled(F.col("island"), 2), "members").alias("name")).distinct()


@query("WITH p AS (SELECT unnest(['a', 'o', 're']) AS pattern) SELECT p_partkey, pattern FROM part JOIN p ON contains(p_name, pattern) WHERE p_size = 10 OR (p_size = 20 AND p_partkey % 2 = 0)")
def tileset_discovery(t: Tables) -> DataFrame:
    """Parts of a wanted size, once for every pattern that the name contains."""
    wanted = t("part").where("p_size = 10 or (p_size = 20 and p_partkey % 2 = 0)")
    patterns = F.array(*map(F.lit, ("a", "o", "re")))
    return wanted.select("p_partkey", "p_name", F.explode(patterns).alias("pattern")).where(F.col("p_name").contains(F.col("pattern"))).select("p_partkey", "pattern")


@query("SELECT p_partkey, p_name FROM part WHERE NOT contains(p_name, 'a') AND NOT contains(p_name, 'lin') AND NOT ends_with(p_name, '_mask')")
def exclude_patterns(t: Tables) -> DataFrame:
    return t("part").where(~F.col("p_name").contains("a") & ~F.col("p_name").contains("lin") & ~F.col("p_name").endswith("_mask")).select("p_partkey", "p_name")


@query("SELECT (props->>'k')::INT AS k, count(*) AS n, count(*) FILTER (event_type = 'click') AS clicks FROM events GROUP BY 1")
def json_props_parse(t: Tables) -> DataFrame:
    k = F.from_json("props", "k int")["k"].alias("k")
    return t("events").groupBy(k).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"))


@query("SELECT c_custkey, list_filter(['key', 'name', 'segment', 'balance'], lambda f: (f = 'key' AND c_custkey % 2 = 0) OR (f = 'segment' AND c_custkey % 3 = 0) OR (f = 'balance' AND c_custkey % 5 = 0)) AS missing, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'error' ELSE 'ok' END AS level FROM customer")
def required_fields_check(t: Tables) -> DataFrame:
    only = lambda n, c: F.when(F.col("c_custkey") % n != 0, F.col(c))
    doc = F.to_json(F.struct(only(2, "c_custkey").alias("key"), F.col("c_name").alias("name"), only(3, "c_mktsegment").alias("segment"), only(5, "c_acctbal").alias("balance")))
    missing = names.missing_fields(F.col("doc"), ["key", "name", "segment", "balance"])
    return t("customer").select("c_custkey", doc.alias("doc")).select("c_custkey", missing.alias("missing")).withColumn("level", F.when(F.size("missing") > 0, "error").otherwise("ok"))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size ELSE 40 END AS stride, (CASE WHEN p_size % 2 = 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS scale, 160 AS patch FROM part")
def config_defaults_merge(t: Tables) -> DataFrame:
    """Defaults overridden by what a user gave, field by field."""
    user = F.map_filter(F.create_map(F.lit("stride"), F.when(F.col("p_size") > 25, F.col("p_size").cast("string")), F.lit("scale"), F.when(F.col("p_size") % 2 == 0, "0.5")), lambda k, v: v.isNotNull())
    default = F.create_map(*[F.lit(x) for x in ("stride", "40", "scale", "1.0", "patch", "160")])
    merged = F.map_from_entries(F.transform(F.map_keys(default), lambda k: F.struct(k, F.coalesce(F.try_element_at(user, k), F.element_at(default, k)))))
    m = t("part").select("p_partkey", merged.alias("m"))
    return m.select("p_partkey", F.col("m")["stride"].cast("int").alias("stride"), F.col("m")["scale"].cast("double").alias("scale"), F.col("m")["patch"].cast("int").alias("patch"))


@query("SELECT DISTINCT l_linenumber, l_suppkey % 10 AS y, [l_linenumber * 50, (l_suppkey % 10) * 10, 3 * 10]::BIGINT[] AS nm FROM lineitem")
def voxel_to_nm(t: Tables) -> DataFrame:
    v = t("lineitem").select("l_linenumber", (F.col("l_suppkey") % 10).alias("y")).distinct()
    nm = F.zip_with(F.array(F.col("l_linenumber").cast("bigint"), "y", F.lit(3).cast("bigint")), F.array(F.lit(50), F.lit(10), F.lit(10)), lambda a, b: a * b)
    return v.select("l_linenumber", "y", nm.alias("nm"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'bool' WHEN p_partkey % 4 = 1 THEN 'uint64' WHEN p_partkey % 4 = 2 THEN 'uint8' ELSE 'float32' END AS dtype, CASE WHEN p_partkey % 4 < 2 OR (p_partkey % 4 = 2 AND p_size <= 1) THEN 'segmentation' ELSE 'image' END AS kind FROM part")
def vtype_case(t: Tables) -> DataFrame:
    dtype = F.element_at(F.array(*map(F.lit, ("bool", "uint64", "uint8", "float32"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t("part").select("p_partkey", dtype.alias("dtype"), names.volume_type(dtype, F.col("p_size")).alias("kind"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_quantity * 10 > 160 THEN 'fine' ELSE 'coarse' END AS mesh, list_filter([0.1, 0.2, 0.5, 1.0], lambda r: r * 50 >= l_quantity)[1]::DOUBLE AS ratio FROM lineitem")
def param_switch(t: Tables) -> DataFrame:
    """Parameters by overlap, and the first step of a ladder that is wide enough."""
    ladder = F.array(*map(F.lit, (0.1, 0.2, 0.5, 1.0)))
    wide = F.get(F.filter(ladder, lambda r: r * 50 >= F.col("l_quantity")), F.lit(0))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.when(F.col("l_quantity") * 10 > 160, "fine").otherwise("coarse").alias("mesh"), wide.alias("ratio"))


@query("SELECT r_regionkey, '{\"name\":\"' || r_name || '\",\"stacks\":{' || string_agg('\"' || n_name || '\":' || n_nationkey, ',' ORDER BY n_name) || '}}' AS doc FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name")
def config_to_json(t: Tables) -> DataFrame:
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("n_name", "n_nationkey"))))
    n = t("region").join(t("nation"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_regionkey", "r_name").agg(entries.alias("stacks"))
    return n.select("r_regionkey", F.to_json(F.struct(F.col("r_name").alias("name"), "stacks")).alias("doc"))


@query("WITH n AS (SELECT event_id, user_id, ts, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS island FROM n) SELECT user_id, island, any_value(event_type) AS event_type, count(*) AS n, min(event_id) AS first_id FROM i GROUP BY ALL")
def islands_events(t: Tables) -> DataFrame:
    i = islands.islands(t("events").select("event_id", "user_id", "ts", "event_type"), "ts", F.col("event_type"), ["user_id"])
    return i.groupBy("user_id", "island").agg(F.first("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type <> 'error' THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reference FROM events")
def prev_valid_slice(t: Tables) -> DataFrame:
    """Each event with the time of its user's last event that was no error."""
    e = t("events").select("event_id", "user_id", "ts", "event_type")
    return islands.last_valid(e, "ts", F.col("event_type") != "error", ["user_id"]).select("event_id", "user_id", "reference")


@query("WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), p AS (SELECT user_id, ts AS pts, event_id AS pid FROM events WHERE event_type = 'purchase') SELECT e.event_id, p.pid FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.pts")
def asof_backward(t: Tables) -> DataFrame:
    e, p = (t("events").where(F.col("event_type") == k) for k in ("click", "purchase"))
    r = p.select("user_id", F.col("ts").alias("pts"), F.col("event_id").alias("pid"))
    return asof.backward(e.select("event_id", "user_id", "ts"), r, "ts", "pts", ["user_id"], ["pid"]).select("event_id", "pid")


@query("WITH o AS (SELECT DISTINCT o_orderdate::DATE - DATE '1970-01-01' AS d FROM orders), e AS (SELECT DISTINCT ts::DATE - DATE '1970-01-01' AS d FROM events), b AS (SELECT min(d) AS a, max(d) AS b FROM e) SELECT d - 2000 AS day, (SELECT min(e.d) FROM e WHERE e.d >= o.d) AS next_day FROM o")
def asof_forward(t: Tables) -> DataFrame:
    """Order days with the next day that has events, in bands of 90 days."""
    day = lambda df, c: df.select(F.unix_date(F.to_date(c)).cast("bigint").alias("d")).distinct()
    found = asof.banded(day(t("orders"), "o_orderdate"), day(t("events"), "ts").withColumnRenamed("d", "next_day"), "d", "next_day", 90, back=False)
    return found.select((F.col("d") - 2000).alias("day"), "next_day")


@query(f"WITH {VOLUME}, T AS (SELECT z, (y // 32)::INT AS ty, (x // 32)::INT AS tx, CASE WHEN (z + y // 32 + x // 32) % 3 = 0 OR z = 3 THEN NULL ELSE sum(v)::BIGINT END AS s FROM V GROUP BY z, y // 32, x // 32) SELECT z, ty, tx, coalesce(s, lag(s) OVER w, lead(s) OVER w) AS s, CASE WHEN s IS NOT NULL THEN 'own' WHEN lag(s) OVER w IS NOT NULL THEN 'previous' WHEN lead(s) OVER w IS NOT NULL THEN 'next' END AS filled_from FROM T WINDOW w AS (PARTITION BY ty, tx ORDER BY z)")
def missing_tile_fallback(t: Tables) -> DataFrame:
    from ..operators import volume

    tiles = volume.tile(volume.pixels(rows(t)), 32, 32).groupBy("z", "ty", "tx").agg(F.sum("v").alias("s"))
    gone = ((F.col("z") + F.col("ty") + F.col("tx")) % 3 == 0) | (F.col("z") == 3)
    return islands.fill_missing(tiles.withColumn("s", F.when(~gone, F.col("s"))), "z", "s", ["ty", "tx"])


@query("WITH s AS (SELECT o_custkey AS path, o_orderkey, ((o_orderkey % 21) - 10)::BIGINT AS dx, ((o_orderkey % 13) - 6)::BIGINT AS dy FROM orders), p AS (SELECT path, sum(dx)::BIGINT AS x, sum(dy)::BIGINT AS y FROM s GROUP BY path) SELECT path, x, y, abs(min(x) OVER ()) AS pad_x, abs(min(y) OVER ()) AS pad_y FROM p")
def path_offset_total(t: Tables) -> DataFrame:
    """Offsets summed along each path, and the pad that the least of the totals asks for."""
    s = t("orders").select(F.col("o_custkey").alias("path"), (F.col("o_orderkey") % 21 - 10).alias("dx"), (F.col("o_orderkey") % 13 - 6).alias("dy"))
    p = s.groupBy("path").agg(F.sum("dx").alias("x"), F.sum("dy").alias("y"))
    pad = p.agg(F.abs(F.min("x")).alias("pad_x"), F.abs(F.min("y")).alias("pad_y"))
    return p.crossJoin(F.broadcast(pad))  # one row


@query(f"WITH {ISLANDS}, T AS (SELECT island, min(z) AS at FROM I GROUP BY island) SELECT T.island, I.z FROM T JOIN I ON I.z BETWEEN T.at - 10 AND T.at + 9")
def transition_windows(t: Tables) -> DataFrame:
    """The days around every transition: each transition names its days, so the join is by day."""
    i = order_islands(t)
    at = i.groupBy("island").agg(F.min("z").alias("at"))
    days = at.select("island", F.explode(F.sequence(F.date_sub("at", 10), F.date_add("at", 9))).alias("z"))
    return days.join(i.select("z"), "z").select("island", "z")


@query("WITH s AS (SELECT DISTINCT (s_suppkey % 6)::INT AS tx, (s_suppkey % 7)::INT AS ty FROM supplier) SELECT a.tx, a.ty, b.tx AS ntx, b.ty AS nty, CASE WHEN b.tx = a.tx + 1 THEN 'right' ELSE 'below' END AS side FROM s a JOIN s b ON (b.tx = a.tx + 1 AND b.ty = a.ty) OR (b.tx = a.tx AND b.ty = a.ty + 1)")
def neighbor_pairs(t: Tables) -> DataFrame:
    s = t("supplier").select(F.lit(0).alias("g"), (F.col("s_suppkey") % 6).cast("int").alias("tx"), (F.col("s_suppkey") % 7).cast("int").alias("ty")).distinct()
    e = geometry.adjacent(s.withColumn("v", F.lit(0)), "g", "v")
    right = F.col("side") == "right"
    return e.select("tx", "ty", F.when(right, F.col("tx") + 1).otherwise(F.col("tx")).alias("ntx"), F.when(right, F.col("ty")).otherwise(F.col("ty") + 1).alias("nty"), "side")


@query("SELECT a.n_regionkey AS region, a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def pair_combinations(t: Tables) -> DataFrame:
    a, b = (t("nation").select(F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias(c)) for c in "ab")
    return a.join(b, "region").where("a < b").select("region", "a", "b")


@query(f"WITH {ISLANDS}, G AS (SELECT DISTINCT island, unnest(string_split(members, '')) AS m FROM I) SELECT a.island, a.m AS u, b.m AS v FROM G a JOIN G b ON b.island = a.island + 1 WHERE a.m <> b.m")
def consecutive_group_edges(t: Tables) -> DataFrame:
    g = order_islands(t).select("island", F.explode(F.split("members", "")).alias("u")).distinct()
    return g.join(g.select((F.col("island") - 1).alias("island"), F.col("u").alias("v")), "island").where("u <> v")


@query("WITH c AS (SELECT o_custkey AS k, min(epoch(o_orderdate)::BIGINT // 86400) AS lo, min(epoch(o_orderdate)::BIGINT // 86400) + 40 AS hi FROM orders GROUP BY 1) SELECT a.k, b.k AS other, greatest(a.lo, b.lo) AS \"from\", least(a.hi, b.hi) AS \"to\" FROM c a JOIN c b ON a.k < b.k AND a.lo < b.hi AND b.lo < a.hi")
def interval_overlap(t: Tables) -> DataFrame:
    day = F.unix_date(F.to_date("o_orderdate")).cast("bigint")
    c = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min(day).alias("lo")).withColumn("hi", F.col("lo") + 40)
    return islands.overlapping(c, "k", "lo", "hi")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def pending_slices_anti(t: Tables) -> DataFrame:
    return progress.pending(t("orders").select("o_orderkey"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def completed_slices_semi(t: Tables) -> DataFrame:
    return progress.completed(t("orders").select("o_orderkey", "o_custkey"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT string_split(p_name, ' ')[1] FROM part) SELECT a.name, b.name AS fused FROM n a JOIN n b ON contains(b.name, a.name) AND a.name <> b.name")
def substring_theta_join(t: Tables) -> DataFrame:
    """Names contained in longer ones: a longer name gives its substrings, so the join is by equality."""
    n = t("part").select(F.col("p_name").alias("name")).distinct()
    n = n.unionByName(n.select(F.get(F.split("name", " "), F.lit(0)).alias("name"))).distinct()
    size = F.length("fused")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), size), lambda i: F.transform(F.sequence(F.lit(1), size - i + 1), lambda k: F.substring(F.col("fused"), i, k))))
    inner = n.select(F.col("name").alias("fused")).select("fused", F.explode(F.array_distinct(parts)).alias("name"))
    return inner.join(n, "name").where("name <> fused").select("name", "fused")


@query("WITH a AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 5000), q AS (SELECT quantile_cont(o_totalprice, 0.9) AS p FROM orders), b AS (SELECT DISTINCT o_custkey AS k FROM orders, q WHERE o_totalprice > p) SELECT k, 'missing' AS level FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'orphan' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)")
def plan_vs_config_diff(t: Tables) -> DataFrame:
    a = t("customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"))
    limit = t("orders").agg(F.percentile("o_totalprice", 0.9).alias("p"))
    b = t("orders").crossJoin(F.broadcast(limit)).where("o_totalprice > p").select(F.col("o_custkey").alias("k")).distinct()  # one row
    return a.join(b, "k", "left_anti").withColumn("level", F.lit("missing")).unionByName(b.join(a, "k", "left_anti").withColumn("level", F.lit("orphan")))


KNN = """E AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
KD AS (SELECT a.id AS q, b.id AS t, floor(sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) * 1e6 + 0.5) / 1e6 AS d FROM E a JOIN E b ON a.id <> b.id),
KR AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, t) AS k FROM KD),
K AS (SELECT a.q, a.t AS t1, a.d AS d1, b.t AS t2, b.d AS d2 FROM KR a JOIN KR b ON a.q = b.q AND a.k = 1 AND b.k = 2)"""


def nearest(t: Tables) -> DataFrame:
    e = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    micro = lambda c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6
    return scores.nearest_two(e, e, same=True).withColumns({"d1": micro("d1"), "d2": micro("d2")})


@query(f"WITH {KNN} SELECT q, t1, d1, t2, d2 FROM K")
def knn_top2(t: Tables) -> DataFrame:
    return nearest(t)


@query(f"WITH {KNN} SELECT q, t1, d1 < 0.95 * d2 AS good FROM K")
def knn_ratio_test(t: Tables) -> DataFrame:
    return scores.ratio_test(nearest(t), 0.95).select("q", "t1", "good")


RESIDUAL = "M AS (SELECT CASE WHEN l_linenumber <= 3 THEN l_orderkey ELSE -l_suppkey END AS g, (l_partkey * 7 + l_orderkey) % 61 + l_quantity / 100 AS residual, (l_partkey + l_linenumber) % 3 > 0 AND l_suppkey % 11 <> 0 AS inlier FROM lineitem)"


def matches(t: Tables) -> DataFrame:
    """Matches in groups of all sizes: a few for an order, hundreds for a supplier."""
    g = F.when(F.col("l_linenumber") <= 3, F.col("l_orderkey")).otherwise(-F.col("l_suppkey"))
    return t("lineitem").select(g.alias("g"), ((F.col("l_partkey") * 7 + F.col("l_orderkey")) % 61 + F.col("l_quantity") / 100).alias("residual"), F.expr("(l_partkey + l_linenumber) % 3 > 0 and l_suppkey % 11 <> 0").alias("inlier"))


@query(f"WITH {RESIDUAL}, R AS (SELECT g, round(residual * 100)::BIGINT AS r, row_number() OVER (PARTITION BY g ORDER BY residual) AS k, count(*) OVER (PARTITION BY g) AS n FROM M) SELECT g, count(*) AS n, sum(r)::DOUBLE / count(*) / 100 AS mean, max(r) AS worst, sqrt((sum(r * r)::DOUBLE * count(*) - sum(r)::DOUBLE * sum(r)) / count(*)) / count(*) AS std FROM R WHERE k <= floor(0.75 * n) GROUP BY g")
def trimmed_stats(t: Tables) -> DataFrame:
    """Mean, worst and deviation of the best three quarters, from sums of hundredths."""
    k = scores.trimmed(matches(t), "g", "residual").withColumn("r", F.round(F.col("residual") * 100).cast("bigint"))
    n = F.count("*")
    s = k.groupBy("g").agg(n.alias("n"), F.sum("r").alias("s"), F.sum(F.col("r") * F.col("r")).alias("s2"), F.max("r").alias("worst"))
    d = lambda c: F.col(c).cast("double")
    return s.select("g", "n", (d("s") / d("n") / 100).alias("mean"), "worst", (F.sqrt((d("s2") * d("n") - d("s") * d("s")) / d("n")) / d("n")).alias("std"))


@query(f"""WITH {RESIDUAL}, C AS (SELECT g, count(*) AS n, count(*) FILTER (inlier) AS i FROM M GROUP BY g),
R AS (SELECT g, residual, row_number() OVER (PARTITION BY g ORDER BY residual) AS k, count(*) OVER (PARTITION BY g) AS n FROM M WHERE inlier),
S AS (SELECT g, avg(residual) AS m, count(*) FILTER (residual <= 20)::DOUBLE / count(*) AS c FROM R WHERE k <= floor(n * 0.75) GROUP BY g),
P AS (SELECT g, n, i, i::DOUBLE / n AS r, m, c,
    CASE WHEN n <= 5 THEN n / 10.0::DOUBLE WHEN n <= 20 THEN 0.5 + (n - 5) / 30.0::DOUBLE ELSE 0.8 + 0.2 * least(1.0, ln(n - 19) / ln(50)) END AS quantity,
    CASE WHEN m <= 10 THEN 1 WHEN m <= 20 THEN 0.8 - 0.3 * (m - 10) / 10 WHEN m <= 40 THEN 0.5 - 0.3 * (m - 20) / 20 ELSE greatest(0.1, 0.2 - 0.1 * (m - 40) / 20) END AS quality
    FROM C LEFT JOIN S USING (g)),
Q AS (SELECT *, CASE WHEN r >= 0.7 THEN 1 WHEN r >= 0.4 THEN 0.6 + 0.4 * (r - 0.4) / 0.3 WHEN r >= 0.2 THEN 0.3 + 0.3 * (r - 0.2) / 0.2 ELSE 0.3 * r / 0.2 END AS proportion,
    CASE WHEN c >= 0.9 THEN 1 WHEN c >= 0.7 THEN 0.8 + 0.2 * (c - 0.7) / 0.2 WHEN c >= 0.5 THEN 0.5 + 0.3 * (c - 0.5) / 0.2 ELSE c END AS consistency FROM P)
SELECT g, n, i AS inliers, floor(coalesce(least(1, greatest(0, (0.25 * quantity + 0.15 * proportion + 0.35 * quality + 0.25 * consistency) * CASE WHEN n >= 10 AND i >= 6 AND m <= 60 THEN 1 ELSE 0.3 END)), 0) * 1e6 + 0.5) / 1e6 AS "index" FROM Q""")
def robustness_index(t: Tables) -> DataFrame:
    r = scores.robustness(matches(t), "g")
    return r.select("g", "n", "inliers", (F.floor(F.col("index") * 1e6 + 0.5) / 1e6).alias("index"))


@query("SELECT l_suppkey, median(l_quantity) AS median, bool_or(l_quantity = 1) AS low FROM lineitem GROUP BY 1")
def median_score(t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_suppkey").agg(F.median("l_quantity").alias("median"), F.bool_or(F.col("l_quantity") == 1).alias("low"))


@query("SELECT l_partkey FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1 HAVING count(DISTINCT l_linenumber) = 3")
def slices_in_all(t: Tables) -> DataFrame:
    """Parts that occur in each of three lists."""
    return t("lineitem").where("l_linenumber <= 3").select("l_partkey", "l_linenumber").distinct().groupBy("l_partkey").agg(F.count("*").alias("n")).where("n = 3").drop("n")


@query("SELECT DISTINCT p_size, p_brand FROM part ORDER BY p_size, p_brand")
def distinct_sorted(t: Tables) -> DataFrame:
    return t("part").select("p_size", "p_brand").distinct().orderBy("p_size", "p_brand")


@query(f"WITH {ISLANDS}, M AS (SELECT z, unnest(string_split(members, '')) AS m FROM I) SELECT m, min(z) AS lo, max(z) + 1 AS hi, (max(z) + 1 - min(z))::INT AS extent FROM M GROUP BY m")
def dataset_bounds(t: Tables) -> DataFrame:
    m = order_islands(t).select("z", F.explode(F.split("members", "")).alias("m"))
    hi = F.date_add(F.max("z"), 1)
    return m.groupBy("m").agg(F.min("z").alias("lo"), hi.alias("hi"), F.date_diff(hi, F.min("z")).alias("extent"))


@query("SELECT n_regionkey, coalesce(max(n_nationkey) FILTER (n_nationkey % 4 <> 0), -1) + 1 AS next_offset FROM nation GROUP BY 1")
def next_offset(t: Tables) -> DataFrame:
    """The first free slice after the stacks that have an end."""
    return t("nation").groupBy("n_regionkey").agg((F.coalesce(F.max(F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey"))), F.lit(-1)) + 1).alias("next_offset"))


@query("SELECT o.o_custkey, count(DISTINCT o_orderkey) AS wanted, count(DISTINCT l_orderkey) AS done, count(DISTINCT l_orderkey) >= count(DISTINCT o_orderkey) AS complete FROM orders o LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def step_completion(t: Tables) -> DataFrame:
    done = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return progress.completion(t("orders").select("o_custkey", "o_orderkey"), done, ["o_custkey"], ["o_orderkey"])


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value = 0 OR value IS NULL) AS empty, count(*) FILTER (value > 50) AS skipped, bool_and(value >= 0) AS fine FROM events GROUP BY 1")
def run_counters(t: Tables) -> DataFrame:
    v = F.col("value")
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if((v == 0) | v.isNull()).alias("empty"), F.count_if(v > 50).alias("skipped"), F.bool_and(v >= 0).alias("fine"))


@query("SELECT l_orderkey AS z, string_agg(DISTINCT l_linenumber || ':' || l_suppkey % 4, ',' ORDER BY l_linenumber || ':' || l_suppkey % 4) AS tiles FROM lineitem GROUP BY 1")
def slice_to_tiles_map(t: Tables) -> DataFrame:
    tile = F.concat_ws(":", "l_linenumber", F.col("l_suppkey") % 4)
    return t("lineitem").groupBy(F.col("l_orderkey").alias("z")).agg(F.array_join(F.array_sort(F.collect_set(tile)), ",").alias("tiles"))


@query("WITH d AS (SELECT l_orderkey AS g, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity * 20 - 500 END AS d FROM lineitem) SELECT g, min(abs(d)) AS least, least(200, floor(floor(min(abs(d)) / 2) * 0.9))::INT AS margin FROM d GROUP BY g")
def margin_from_displacement(t: Tables) -> DataFrame:
    d = t("lineitem").select(F.col("l_orderkey").alias("g"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_quantity") * 20 - 500).alias("d"))
    m = d.groupBy("g").agg(F.min(F.abs("d")).alias("least"))
    return m.select("g", "least", F.least(F.lit(200), F.floor(F.floor(F.col("least") / 2) * 0.9)).cast("int").alias("margin"))


@query("SELECT event_type AS step, user_id, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY ALL")
def progress_wipe_step(t: Tables) -> DataFrame:
    log = t("events").select(F.lit("p").alias("collection"), F.col("event_type").alias("step_name"), "user_id")
    return progress.wiped(log, "p", "error").groupBy(F.col("step_name").alias("step"), "user_id").agg(F.count("*").alias("n"))


A = (0.98, -0.17, 12.0, 0.17, 0.98, -7.5)


@query("SELECT l_orderkey, l_linenumber, l_partkey, floor((0.98 * l_quantity - 0.17 * l_suppkey + 12) * 1e6 + 0.5)::BIGINT AS x, floor((0.17 * l_quantity + 0.98 * l_suppkey - 7.5) * 1e6 + 0.5)::BIGINT AS y FROM lineitem")
def affine_points(t: Tables) -> DataFrame:
    x, y = geometry.affine(F.col("l_quantity"), F.col("l_suppkey"), A)
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.floor(x * 1e6 + 0.5).alias("x"), F.floor(y * 1e6 + 0.5).alias("y"))


@query("WITH c AS (SELECT p_partkey, unnest([0, 1, 0, 1]) * p_size AS x, unnest([0, 0, 1, 1]) * (p_size + 5) AS y FROM part), m AS (SELECT p_partkey, 0.98 * x - 0.17 * y + 12 AS u, 0.17 * x + 0.98 * y - 7.5 AS v FROM c) SELECT p_partkey, least(floor(min(u)), 0)::INT AS ref_x, least(floor(min(v)), 0)::INT AS ref_y, (ceil(max(u)) - least(floor(min(u)), 0))::INT AS w, (ceil(max(v)) - least(floor(min(v)), 0))::INT AS h FROM m GROUP BY 1")
def affine_canvas(t: Tables) -> DataFrame:
    """The canvas that holds a transformed image without negative places, from its four corners."""
    w, h, zero = F.col("p_size").cast("double"), F.col("p_size").cast("double") + 5, F.lit(0.0)
    corners = [geometry.affine(a, b, A) for a, b in ((zero, zero), (w, zero), (zero, h), (w, h))]
    us, vs = zip(*corners, strict=True)
    left, top = F.least(F.floor(F.least(*us)), F.lit(0)), F.least(F.floor(F.least(*vs)), F.lit(0))
    return t("part").select("p_partkey", left.cast("int").alias("ref_x"), top.cast("int").alias("ref_y"), (F.ceil(F.greatest(*us)) - left).cast("int").alias("w"), (F.ceil(F.greatest(*vs)) - top).cast("int").alias("h"))


@query("SELECT p_partkey, floor((p_size + 20) * abs(cos(radians(p_partkey % 360))) + p_size * abs(sin(radians(p_partkey % 360))) + 1e-9)::INT AS h, floor((p_size + 20) * abs(sin(radians(p_partkey % 360))) + p_size * abs(cos(radians(p_partkey % 360))) + 1e-9)::INT AS w FROM part")
def rotate_bounds(t: Tables) -> DataFrame:
    h, w = geometry.rotated_bounds(F.col("p_size") + 20, F.col("p_size"), F.col("p_partkey") % 360)
    return t("part").select("p_partkey", h.alias("h"), w.alias("w"))


@query("SELECT p_partkey, 0.98::DOUBLE AS a, 12 * (p_size / 10.0::DOUBLE) AS tx, -7.5 * (p_size / 10.0::DOUBLE) AS ty FROM part")
def scale_transform(t: Tables) -> DataFrame:
    m = F.struct(*[F.lit(v).alias(n) for v, n in zip(A, ("a", "b", "tx", "c", "d", "ty"), strict=True)])
    s = t("part").select("p_partkey", geometry.scaled(m, F.col("p_size") / 10).alias("m"))
    return s.select("p_partkey", "m.a", "m.tx", "m.ty")


@query("SELECT l_orderkey, l_linenumber, l_partkey, floor(sqrt((l_quantity - 10) * (l_quantity - 10) + (l_suppkey - 50) * (l_suppkey - 50)) * 1e6 + 0.5)::BIGINT AS residual FROM lineitem")
def residual_norms(t: Tables) -> DataFrame:
    dx, dy = F.col("l_quantity") - 10, F.col("l_suppkey") - 50
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.floor(F.sqrt(dx * dx + dy * dy) * 1e6 + 0.5).alias("residual"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_discount > 0.05 AND l_quantity < 30 AS edge, l_tax >= 0.04 AS robust, CASE WHEN l_tax <> 0 THEN 'rotate' ELSE 'keep' END AS rotation FROM lineitem WHERE l_quantity > 16")
def threshold_gate(t: Tables) -> DataFrame:
    return t("lineitem").where("l_quantity > 16").select("l_orderkey", "l_linenumber", "l_partkey", ((F.col("l_discount") > 0.05) & (F.col("l_quantity") < 30)).alias("edge"), (F.col("l_tax") >= 0.04).alias("robust"), F.when(F.col("l_tax") != 0, "rotate").otherwise("keep").alias("rotation"))


@query(f"WITH {HOLED}, F AS (SELECT z, sum(v)::BIGINT AS flow FROM H GROUP BY z), G AS (SELECT unnest([2, 5, 77]) AS z) SELECT F.z, CASE WHEN G.z IS NULL THEN flow END AS flow, CASE WHEN G.z IS NULL THEN 'done' ELSE 'skipped' END AS state FROM F LEFT JOIN G USING (z)")
def ignore_list_mask(t: Tables) -> DataFrame:
    r = holed(t)
    flow = r.groupBy("z").agg(F.sum(F.aggregate("px", F.lit(0).cast("bigint"), lambda a, v: a + v)).alias("flow"))
    ignored = F.col("z").isin(2, 5, 77)
    return flow.select("z", F.when(~ignored, F.col("flow")).alias("flow"), F.when(ignored, "skipped").otherwise("done").alias("state"))


@query("SELECT o_orderkey, floor(ln(o_totalprice) * 1e6)::BIGINT AS log, floor(o_totalprice)::BIGINT AS low, ceil(o_totalprice)::BIGINT AS high, trunc(-o_totalprice)::BIGINT AS cut, least(greatest(o_totalprice, 50000), 200000) AS clipped, abs(o_totalprice - 100000) AS gap, sign(o_totalprice - 100000)::INT AS side FROM orders")
def math_scalars(t: Tables) -> DataFrame:
    p = F.col("o_totalprice")
    return t("orders").select("o_orderkey", F.floor(F.log(p) * 1e6).alias("log"), F.floor(p).alias("low"), F.ceil(p).alias("high"), (-p).cast("bigint").alias("cut"), F.least(F.greatest(p, F.lit(50000.0)), F.lit(200000.0)).alias("clipped"), F.abs(p - 100000).alias("gap"), F.signum(p - 100000).cast("int").alias("side"))


@query("SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT p_partkey FROM part WHERE p_size < 5")
def set_union(t: Tables) -> DataFrame:
    return t("lineitem").where("l_returnflag = 'R'").select("l_partkey").union(t("part").where("p_size < 5").select("p_partkey")).distinct()


@query("SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT p_partkey FROM part WHERE p_size < 5")
def set_intersect(t: Tables) -> DataFrame:
    return t("lineitem").where("l_returnflag = 'R'").select("l_partkey").intersect(t("part").where("p_size < 5").select("p_partkey"))


@query("WITH g AS (SELECT o_custkey, list_sort(list_distinct(list(o_orderstatus))) AS members FROM orders GROUP BY 1) SELECT o_custkey, list_filter(members, lambda m: m <> 'O' AND m <> 'X') AS rest FROM g")
def array_except_members(t: Tables) -> DataFrame:
    g = t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderstatus")).alias("members"))
    return g.select("o_custkey", F.array_except("members", F.array(F.lit("O"), F.lit("X"))).alias("rest"))


@query("SELECT n_name AS name, 'single' AS kind FROM nation WHERE n_regionkey < 3 UNION ALL SELECT r_name, 'combined' FROM region UNION ALL SELECT n_name, 'combined' FROM nation WHERE n_regionkey > 1")
def union_all_stacks(t: Tables) -> DataFrame:
    n, r = t("nation"), t("region")
    one = lambda df, c, kind: df.select(F.col(c).alias("name"), F.lit(kind).alias("kind"))
    return one(n.where("n_regionkey < 3"), "n_name", "single").unionByName(one(r, "r_name", "combined")).unionByName(one(n.where("n_regionkey > 1"), "n_name", "combined"))


@query("SELECT l_partkey AS dataset, min(l_orderkey) AS path FROM lineitem GROUP BY 1")
def first_path_wins(t: Tables) -> DataFrame:
    """A dataset belongs to the first path that names it."""
    return t("lineitem").groupBy(F.col("l_partkey").alias("dataset")).agg(F.min("l_orderkey").alias("path"))


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 250")
def topk_features(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(250)


@query("WITH d AS (SELECT n_regionkey AS g, n_name AS name, (n_nationkey * 7 % 11)::BIGINT AS z, (n_nationkey % 5 + 3)::BIGINT AS n FROM nation WHERE NOT contains(n_name, 'UNITED') AND NOT contains(n_name, 'IND')), e AS (SELECT g, arg_max(z + n, z * 1000 + n)::BIGINT AS extent FROM d GROUP BY g), o AS (SELECT g, coalesce(sum(extent) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM e) SELECT g, name, z + off AS z_off FROM d JOIN o USING (g)")
def ordered_datasets(t: Tables) -> DataFrame:
    d = t("nation").where(~F.col("n_name").contains("UNITED") & ~F.col("n_name").contains("IND"))
    key = F.col("n_nationkey").cast("bigint")
    d = d.select(F.col("n_regionkey").alias("g"), F.col("n_name").alias("name"), (key * 7 % 11).alias("z"), (key % 5 + 3).alias("n"))
    e = d.groupBy("g").agg(F.max_by(F.col("z") + F.col("n"), F.struct("z", "n")).alias("extent"))
    return d.join(names.running_offset(e, "g", "extent"), "g").select("g", "name", (F.col("z") + F.col("offset")).alias("z_off")).orderBy("z_off", "name")


@query("SELECT n_regionkey AS plan, max(n_nationkey % 7 + 1) AS depth, max(n_nationkey) + 100 + 10000 AS height, max(n_nationkey * 2) + 100 + 10000 AS width FROM nation GROUP BY 1")
def destination_shape(t: Tables) -> DataFrame:
    """Extent of the output volume of a plan: deepest local bound, root size with pad and slack."""
    k = F.col("n_nationkey")
    return t("nation").groupBy(F.col("n_regionkey").alias("plan")).agg(F.max(k % 7 + 1).alias("depth"), (F.max(k) + 10100).alias("height"), (F.max(k * 2) + 10100).alias("width"))
