"""Exact top-k inner-product search over norm-sorted blocks.

Vectors become integers, sorted by descending length and packed into blocks,
which are dealt to lanes. Query blocks meet every candidate block of a lane
through a join, longest first, and a query's threshold, its k-th score so far,
goes on from block to block of the lane. Inside a block the candidates go by in
chunks of falling length. A chunk is left out when the product of lengths can't
reach a query's k-th score; else the first coordinates
after a rotation (the right singular vectors of a bounded sample: most of the
length comes first) give partial sums, and by Cauchy-Schwarz the rest adds at
most the product of the residual lengths. Only candidates whose bound reaches
the threshold get their exact integer product. The rotation only sets how much
is pruned; any orthogonal matrix gives the same result. Products beyond what a
double or a long holds exactly are taken in wider integers, without pruning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, materialize, small_batches, tidy, with_row

K, SCALE, EVERY = 10, 1024, 100
#: Rows of a candidate block, of a query block, of a chunk; rows the rotation is fitted on.
BLOCK, QUERY_BLOCK, CHUNK, SAMPLE = 2048, 512, 256, 4096
#: Candidate rows of one range of lengths; lanes for each core of the cluster, if there are as many blocks.
RANGE_ROWS, LANES = 50_000, 2
#: Products up to here are exact in doubles, and up to here in longs.
DOUBLE, LONG = float(1 << 53), float(1 << 62)
#: Scaled components that a double can't hold count as this.
MOST = 1e308


def prepare(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(__row, vec_id, v, length): components as floor(scale * x); vectors that are null or hold a null or non-finite component are left out."""
    x = with_row(vectors, F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    fine = F.col("x").isNotNull() & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    # floor() gives longs; a double of 2**53 or more is an integer already.
    whole = lambda e: F.when(F.abs(e) < DOUBLE, F.floor(e).cast("double")).otherwise(F.least(F.greatest(e, F.lit(-MOST)), F.lit(MOST)))
    v = F.transform("x", lambda e: whole(e * scale))
    out = x.where(fine).select(ROW, "vec_id", v.alias("v"))
    return out.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows as one matrix; shorter vectors are filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; those of length zero stay."""
    rows = rows / np.maximum(np.abs(rows).max(axis=1, initial=0.0, keepdims=True), 1e-300)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def _pack(width: int, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while len(rest) >= size:
                yield of(rest.iloc[:size])
                rest = rest.iloc[size:]
        if rest is not None and len(rest):
            yield of(rest)

    def of(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"top": [f["length"].max()], "rows": [f[ROW].to_numpy(np.int64).tobytes()], "ids": [f["vec_id"].to_numpy(np.float64 if f["vec_id"].isna().any() else np.int64).astype(np.int64).tobytes()], "vectors": [_matrix(f["v"].tolist(), width).tobytes()]})

    return run


class _Best:
    """The k best candidates of each query of a block, so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.least = k, floor.copy()
        self.q, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def meet(self, q, score, ids, rows) -> None:
        reach = score >= self.least[q]
        self.add(q[reach], score[reach], ids[reach], rows[reach])

    def add(self, q, score, ids, rows) -> None:
        q, score, ids, rows = (np.concatenate(x) for x in ((self.q, q), (self.score, score), (self.id, ids), (self.row, rows)))
        order = np.lexsort((rows, ids, ~score, q))  # ~ falls as - does, without overflow
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.least[q[rank == self.k - 1]] = np.maximum(self.least[q[rank == self.k - 1]], score[full])
        self.q, self.score, self.id, self.row = q[rank < self.k], score[keep], ids[keep], rows[keep]


def _products(queries: np.ndarray, vectors: np.ndarray, most: float) -> np.ndarray:
    """All integer products, as longs; none is larger than ``most``. What a long can't hold becomes the nearest long."""
    if most < LONG:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    ints = lambda a: np.array([[int(x) for x in row] for row in a], object)
    long = np.iinfo(np.int64)
    return np.array([[min(max(x, long.min), long.max) for x in row] for row in ints(queries) @ ints(vectors).T], np.int64)


def search(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, rotation: np.ndarray, k: int) -> _Best:
    """The k best of a block for each query. vectors come by descending length; floor: scores that are too low are below it."""
    best = _Best(len(queries), k, floor)
    first = max(1, queries.shape[1] // 4)
    with np.errstate(all="ignore"):  # huge vectors take the other way
        turned, length = queries @ rotation, np.linalg.norm(queries, axis=1)
        rest = np.linalg.norm(turned[:, first:], axis=1)
    for at in range(0, len(vectors), CHUNK):
        own_v, own_ids, own_rows = vectors[at : at + CHUNK], ids[at : at + CHUNK], rows[at : at + CHUNK]
        with np.errstate(all="ignore"):
            lengths = np.linalg.norm(own_v, axis=1)
            top = length * lengths.max()
            exact = top < DOUBLE
            slack = 1e-9 * top + 1e-6
            live = np.flatnonzero(exact & (top + slack >= best.least))
        if len(live):
            t = own_v @ rotation
            bound = turned[live, :first] @ t[:, :first].T + rest[live, None] * np.linalg.norm(t[:, first:], axis=1) + slack[live, None]
            q, c = np.nonzero((bound >= best.least[live, None]) & (own_rows != own[live, None]))
            if 4 * len(q) > len(live) * len(own_v):
                score = (queries[live] @ own_v.T)[q, c]
            else:
                score = np.einsum("ij,ij->i", queries[live[q]], own_v[c])
            best.meet(live[q], score.astype(np.int64), own_ids[c], own_rows[c])
        huge = np.flatnonzero(~exact)
        if len(huge):
            far = top[huge]
            score = _products(queries[huge], own_v, float(far.max()) if np.isfinite(far).all() else np.inf)
            q, c = np.nonzero(own_rows != own[huge, None])
            best.meet(huge[q], score[q, c], own_ids[c], own_rows[c])
    return best


def _arrays(block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(block["rows"], np.int64), np.frombuffer(block["ids"], np.int64), np.frombuffer(block["vectors"]).reshape(-1, width)


@tidy
def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the k highest scores over all other rows.

    Ties go to the smaller id, then to the row read first. Of repeated rows each
    is a candidate, and each is a query with results of its own. Rows with a
    null id take no part. Vectors of unlike lengths are compared as if filled up
    with zeros. Fewer candidates give fewer rows; an empty table gives none.
    Scores are exact; one that a long can't hold is given as the nearest long,
    and such scores tie.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    ready = materialize(prepare(vectors, id_col, vector_col, scale).where("vec_id is not null"))
    facts = ready.agg(F.max(F.size("v")).alias("width"), F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    n, width = facts["n"], max(1, facts["width"] or 1)
    sample = ready.orderBy(F.xxhash64(ROW)).limit(SAMPLE).select("v").toPandas()["v"].tolist()
    rotation = np.linalg.svd(_unit(_matrix(sample, width)), full_matrices=True)[2].T if sample else np.eye(width)

    packed = "top double, rows binary, ids binary, vectors binary"
    ranges = max(1, -(-n // RANGE_ROWS))
    blocks = materialize(ready.repartitionByRange(ranges, F.desc("length"), F.col(ROW)).sortWithinPartitions(F.desc("length"), F.col(ROW)).mapInPandas(_pack(width, BLOCK), packed))
    asked = ready.where(F.col("vec_id") % every == 0).repartition(max(1, -(-facts["q"] // QUERY_BLOCK))).mapInPandas(_pack(width, QUERY_BLOCK), packed)

    # The longest vectors give every query a first threshold.
    head = blocks.orderBy(F.desc("top")).limit(1).collect()
    head = _arrays(head[0], width) if head else None

    def threshold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            floors = []
            for block in batch.to_dict("records"):
                rows, _, v = _arrays(block, width)
                floor = np.full(len(v), np.iinfo(np.int64).min)
                floors.append(search(v, rows, floor, head[2], head[1], head[0], rotation, k).least.tobytes())
            yield batch.assign(floor=floors)

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        so_far: dict[int, np.ndarray] = {}  # thresholds of the query blocks met in this task, by their first row
        for batch in batches:
            for b in batch.to_dict("records"):
                own, query_ids, q = _arrays({"rows": b["q_rows"], "ids": b["q_ids"], "vectors": b["q_vectors"]}, width)
                rows, ids, v = _arrays(b, width)
                best = search(q, own, so_far.get(int(own[0]), np.frombuffer(b["floor"], np.int64)), v, ids, rows, rotation, k)
                so_far[int(own[0])] = best.least
                yield pd.DataFrame({"query_row": own[best.q], "query_id": query_ids[best.q], "vec_id": best.id, "row": best.row, "score": best.score})

    asked = materialize(asked.mapInPandas(threshold, packed + ", floor binary")) if head is not None else asked.withColumn("floor", F.lit(b""))
    lanes = max(1, min(LANES * spark.sparkContext.defaultParallelism, -(-n // BLOCK)))
    # Sorted by lane, so the join keeps the order by length inside a lane; without it only more would be computed.
    dealt = blocks.withColumn("lane", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(lanes)).cast("int")).repartition(lanes, "lane").sortWithinPartitions("lane", F.desc("top"))
    met = asked.select(F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "floor", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    found = dealt.join(met, "lane").mapInPandas(pair, "query_row long, query_id long, vec_id long, row long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
