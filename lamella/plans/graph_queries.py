"""Graphs and displacement fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import flow, graph
from .image_queries import px
from .registry import VOLUME, Tables, query
from .table_queries import ISLANDS, KNN, order_islands
from .table_queries import nearest as nearest_of

EDGES = "E0 AS (SELECT q AS u, t1 AS v FROM K WHERE d1 < 1.1), B AS (SELECT u, v FROM E0 UNION SELECT v, u FROM E0)"


def knn_edges(t: Tables) -> DataFrame:
    return nearest_of(t).where("d1 < 1.1").select(F.col("q").alias("u"), F.col("t1").alias("v"))


@query(f"WITH RECURSIVE {KNN}, {EDGES}, R AS (SELECT vec_id AS node, vec_id AS c FROM embeddings UNION SELECT B.v, R.c FROM R JOIN B ON B.u = R.node) SELECT node, min(c) AS component FROM R GROUP BY node")
def connected_components(t: Tables) -> DataFrame:
    return graph.components(t("embeddings").select(F.col("vec_id").alias("node")), knn_edges(t))


@query("WITH RECURSIVE {V}, M AS (SELECT z, y, x, z::BIGINT * 4096 + y * 64 + x AS id FROM V WHERE v > 150), R AS (SELECT z, y, x, id FROM M UNION SELECT M.z, M.y, M.x, R.id FROM R JOIN M ON M.z = R.z AND abs(M.y - R.y) + abs(M.x - R.x) = 1), C AS (SELECT z, y, x, min(id) AS c FROM R GROUP BY ALL), S AS (SELECT z, c, count(*) AS n FROM C GROUP BY ALL) SELECT z, max(n) AS n, arg_max(c, n * 100000 - c % 4096) AS first FROM S GROUP BY z")
def largest_component(t: Tables) -> DataFrame:
    m = px(t).where("v > 150").select("z", F.col("y").alias("gy"), F.col("x").alias("gx"))
    wide = 1 << 20
    p = flow.largest_patch(m)
    y, x = F.expr(f"patch div {wide} % {wide}"), F.col("patch") % wide
    return p.select("z", "n", (F.col("z").cast("bigint") * 4096 + y * 64 + x).alias("first"))


#: A tree of nations: each is placed against the one with half its number.
TREE = "SELECT (n_nationkey // 2)::BIGINT AS u, n_nationkey::BIGINT AS v, (n_nationkey % 5 - 2)::BIGINT AS dx, (n_nationkey % 3 - 1)::BIGINT AS dy FROM nation WHERE n_nationkey > 0"


def tree(t: Tables) -> DataFrame:
    k = F.col("n_nationkey").cast("bigint")
    return t("nation").where(k > 0).select(F.floor(k / 2).alias("u"), k.alias("v"), (k % 5 - 2).alias("dx"), (k % 3 - 1).alias("dy"))


@query(f"WITH RECURSIVE T AS ({TREE}), B AS (SELECT u, v, dx, dy FROM T UNION ALL SELECT v, u, -dx, -dy FROM T), R AS (SELECT 7::BIGINT AS node, 0::BIGINT AS x, 0::BIGINT AS y UNION SELECT B.v, R.x + B.dx, R.y + B.dy FROM R JOIN B ON B.u = R.node WHERE abs(R.x) < 100) SELECT node, x - min(x) OVER () AS x, y - min(y) OVER () AS y FROM R")
def tile_positions_bfs(t: Tables) -> DataFrame:
    """Places of tiles from relative offsets, from a start in the middle of the tree."""
    return graph.positions(tree(t), 7)


@query(f"WITH {ISLANDS}, G AS (SELECT DISTINCT island, members FROM I) SELECT arg_min(members, island) AS root, min(island) AS island FROM G WHERE length(members) = 1")
def alignment_root(t: Tables) -> DataFrame:
    g = order_islands(t).select("island", F.split("members", "").alias("members")).distinct()
    return graph.root_dataset(graph.uncovered_members(g))


@query(f"WITH {KNN}, {EDGES}, D AS (SELECT u AS node, count(*) AS degree FROM B GROUP BY u), M AS (SELECT min(u) AS root FROM B) SELECT node, degree FROM D, M WHERE degree <> 2 OR node = root")
def special_nodes_degree(t: Tables) -> DataFrame:
    edges = knn_edges(t)
    return graph.special_nodes(edges, graph.both_ways(edges).agg(F.min("u")).first()[0])


PATHS = f"""T AS ({TREE}), B AS (SELECT u, v FROM T UNION SELECT v, u FROM T), L AS (SELECT 0::BIGINT AS node, 0 AS depth UNION ALL SELECT T.v, L.depth + 1 FROM L JOIN T ON T.u = L.node),
S AS (SELECT u AS node FROM B GROUP BY u HAVING count(*) <> 2 OR u = 0),
C AS (SELECT u AS s, v AS e, [u, v] AS path FROM B WHERE u IN (SELECT node FROM S) UNION ALL SELECT s, B.v, list_append(path, B.v) FROM C JOIN B ON B.u = C.e WHERE e NOT IN (SELECT node FROM S) AND NOT list_contains(path, B.v)),
P AS (SELECT s AS start, e AS "end", path, a.depth AS depth FROM C JOIN L a ON a.node = s JOIN L b ON b.node = e WHERE e IN (SELECT node FROM S) AND a.depth < b.depth)"""


@query(f"WITH RECURSIVE {PATHS} SELECT start, \"end\", array_to_string(path, '-') AS path, depth FROM P")
def paths_recursive(t: Tables) -> DataFrame:
    p = graph.paths(tree(t), 0)
    return p.select("start", "end", F.array_join(F.transform("path", lambda n: n.cast("string")), "-").alias("path"), "depth")


@query(f"WITH RECURSIVE {PATHS} SELECT start, \"end\", start * 7 % 11 > \"end\" * 7 % 11 AS reversed FROM P")
def path_reverse_flag(t: Tables) -> DataFrame:
    """Whether a path runs against the order of its datasets' offsets."""
    p = graph.paths(tree(t), 0)
    first, last = F.element_at("path", 1), F.element_at("path", -1)
    return p.select("start", "end", (first * 7 % 11 > last * 7 % 11).alias("reversed"))


FIELD = VOLUME + ", F AS (SELECT a.z, a.y AS gy, a.x AS gx, (a.v - b.v)::DOUBLE AS dx, (a.v + b.v) % 17 - 8.0::DOUBLE AS dy, a.v / 64.0::DOUBLE AS sharp, b.v / 64.0::DOUBLE AS ratio FROM V a JOIN V b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x)"


def field(t: Tables) -> DataFrame:
    """A displacement field made of two adjacent slices."""
    p = px(t).select("z", F.col("y").alias("gy"), F.col("x").alias("gx"), F.col("v").alias("a"))
    both = p.join(p.select((F.col("z") - 1).alias("z"), "gy", "gx", F.col("a").alias("b")), ["z", "gy", "gx"])
    return both.select("z", "gy", "gx", (F.col("a") - F.col("b")).cast("double").alias("dx"), ((F.col("a") + F.col("b")) % 17 - 8.0).alias("dy"), (F.col("a") / 64).alias("sharp"), (F.col("b") / 64).alias("ratio"))


@query(f"WITH {FIELD}, G AS (SELECT z, gy, gx, sharp, ratio, CASE WHEN ok THEN dx END AS dx, CASE WHEN ok THEN dy END AS dy FROM (SELECT *, ratio >= 1.6 AND sharp >= 1.6 AND abs(dx) <= 30 AND abs(dy) <= 30 AS ok FROM F)), M AS (SELECT a.z, a.gy, a.gx, median(b.dx) AS mx, median(b.dy) AS my FROM G a JOIN G b ON a.z = b.z AND abs(a.gy - b.gy) <= 1 AND abs(a.gx - b.gx) <= 1 GROUP BY ALL) SELECT z, gy, gx, CASE WHEN abs(dx - mx) <= 12 AND abs(dy - my) <= 12 THEN dx END AS dx, CASE WHEN abs(dx - mx) <= 12 AND abs(dy - my) <= 12 THEN dy END AS dy FROM G JOIN M USING (z, gy, gx)")
def clean_flow(t: Tables) -> DataFrame:
    return flow.clean(field(t), 1.6, 1.6, 30, 12).select("z", "gy", "gx", "dx", "dy")


@query(f"""WITH RECURSIVE {FIELD}, A AS (SELECT z, gy, gx, CASE WHEN ratio >= 2.2 THEN dx WHEN sharp >= 2.2 THEN dx / 2 END AS dx, CASE WHEN ratio >= 2.2 THEN dy WHEN sharp >= 2.2 THEN dy / 2 END AS dy FROM F),
S AS (SELECT *, coalesce(abs(dx - lag(dx) OVER r) > 20, false) OR coalesce(abs(dx - lag(dx) OVER c) > 20, false) OR coalesce(abs(dy - lag(dy) OVER r) > 20, false) OR coalesce(abs(dy - lag(dy) OVER c) > 20, false) AS bad FROM A WINDOW r AS (PARTITION BY z, gy ORDER BY gx), c AS (PARTITION BY z, gx ORDER BY gy)),
N AS (SELECT z, gy, gx, dx, dy, gy * 64 + gx AS id FROM S WHERE NOT bad AND dx IS NOT NULL),
R AS (SELECT z, gy, gx, id FROM N UNION SELECT N.z, N.gy, N.gx, R.id FROM R JOIN N ON N.z = R.z AND abs(N.gy - R.gy) + abs(N.gx - R.gx) = 1),
C AS (SELECT z, gy, gx, min(id) AS c FROM R GROUP BY ALL), L AS (SELECT z, c FROM C GROUP BY ALL HAVING count(*) >= 4)
SELECT F.z, F.gy, F.gx, CASE WHEN L.c IS NOT NULL THEN N.dx END AS dx, CASE WHEN L.c IS NOT NULL THEN N.dy END AS dy FROM F LEFT JOIN N USING (z, gy, gx) LEFT JOIN C USING (z, gy, gx) LEFT JOIN L ON L.z = F.z AND L.c = C.c""")
def reconcile_flows(t: Tables) -> DataFrame:
    """A fine flow where it is trusted, else a coarse one; steep places and small patches go."""
    f = field(t)
    one = lambda n, where, by: f.select("z", "gy", "gx", F.lit(n).alias("priority"), *[F.when(F.expr(where), F.col(c) / by).alias(c) for c in ("dx", "dy")])
    return flow.reconcile(one(0, "ratio >= 2.2", 1).unionByName(one(1, "sharp >= 2.2", 2)), 20, 4)
