"""Match quality: nearest neighbours, the ratio test, trimmed statistics, the robustness index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import robustness as formula
from . import batches, graph

#: Rows of a block; lanes that blocks are dealt to, for each core of the cluster, if there are as many blocks.
BLOCK, LANES = 4096, 2
#: Queries whose matrix is made at once; candidates of a query, on the average, that are looked at without a finer matrix; pairs whose distance is taken at once.
ROWS, FEW, PAIRS = 256, 16, 1 << 14


def nearest_two(queries: DataFrame, train: DataFrame, same: bool = False) -> DataFrame:
    """(q, t1, d1, t2, d2): the two nearest train vectors of each query; both sides are (id, vec: array of double).

    The query side goes block by block (packed, BLOCK rows each) against the
    train side in blocks too; each pair of blocks gives its own top two, and a
    window keeps two of those. Ties go to the smaller id. same: an id is not its
    own neighbour. All pairs are looked at, so the result is written once, and a
    worker gets a pair of blocks at a time.
    """
    q, t = _blocks(queries).select(F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")), _blocks(train)
    lanes = LANES * queries.sparkSession.sparkContext.defaultParallelism
    t = t.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)))
    q = q.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))

    def run(met: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in met:
            for k in range(batch.num_rows):
                # Read where they lie in the batch: a pair of blocks is some MB, of which no copies are made.
                qi, qv, ti, tv = (np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in (("q_ids", np.int64), ("q_vecs", float), ("ids", np.int64), ("vecs", float)))
                order = np.argsort(ti, kind="stable")
                two = _two(qi, qv.reshape(len(qi), -1), ti[order], tv.reshape(len(ti), -1)[order], same)
                yield pa.RecordBatch.from_pandas(two, preserve_index=False)

    found = q.join(t, "lane").select("q_ids", "q_vecs", "ids", "vecs").mapInArrow(run, "q long, t long, d double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "t"))
    top = found.withColumn("k", rank).where("k <= 2")
    pick = lambda c, k: F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}")
    with batches.small(queries.sparkSession):
        return graph.checkpoint(top.groupBy("q").agg(pick("t", 1), pick("d", 1), pick("t", 2), pick("d", 2)))


def _two(qi: np.ndarray, qv: np.ndarray, ti: np.ndarray, tv: np.ndarray, same: bool) -> pd.DataFrame:
    """The two nearest of a block by exact distance, then id; ti ascends.

    A product of matrices in single precision finds all that its rounding leaves
    in question, one in double precision what is left of these where they are
    many; distances are exact.
    """
    q2, t2 = (qv * qv).sum(1), (tv * tv).sum(1)
    if not (np.isfinite(q2).all() and np.isfinite(t2).all()):
        q, t = np.isfinite(q2), np.isfinite(t2)
        qi, qv, q2, ti, tv, t2 = qi[q], qv[q], q2[q], ti[t], tv[t], t2[t]
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if len(qi) and len(ti):
        size = max(np.abs(qv).max(), np.abs(tv).max()) or 1.0
        a = np.column_stack([-2 / size * qv, np.ones(len(qi))]).astype(np.float32)
        b = np.column_stack([tv / size, t2 / size / size]).astype(np.float32)
        most = t2.max()
        rough = (qv.shape[1] + 8) * 2.0**-22 * (2 * np.sqrt(q2 * most) + most) / size / size + 1e-30
        fine = 1e-9 * (1 + q2 + most)
        own = np.isin(qi, ti) if same else np.zeros(len(qi), bool)
        for at in range(0, len(qi), ROWS):
            part = np.s_[at : at + ROWS]
            hide = qi[part, None] == ti[None] if own[part].any() else None
            q, t = _close(a[part] @ b.T, rough[part], hide)
            if len(q) > FEW * len(qi[part]):
                q, t = _close(q2[part, None] + t2[None] - 2 * qv[part] @ tv.T, fine[part], hide)
            q += at
            d = np.concatenate([np.sqrt(((qv[q[k : k + PAIRS]] - tv[t[k : k + PAIRS]]) ** 2).sum(1)) for k in range(0, len(q), PAIRS)] or [np.zeros(0)])
            order = np.lexsort((ti[t], d, q))
            q, t, d = q[order], t[order], d[order]
            first = np.arange(len(q)) - np.searchsorted(q, q) < 2
            out.append((qi[q[first]], ti[t[first]], d[first]))
    return pd.DataFrame({name: np.concatenate(c) for name, c in zip("qtd", zip(*out, strict=True), strict=True)})


def _close(square: np.ndarray, slack: np.ndarray, hide: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (line, column) of all that may be the two least of their line, if they are known to slack; none that is hidden."""
    if hide is not None:
        square[hide] = np.inf
    line = np.arange(len(square))
    first = square.argmin(1)
    least = square[line, first]
    square[line, first] = np.inf
    limit = np.minimum(square.min(1) + slack, np.finfo(square.dtype).max).astype(square.dtype)
    square[line, first] = least
    return np.divmod(np.flatnonzero(square <= limit[:, None]), square.shape[1])


def _blocks(vectors: DataFrame) -> DataFrame:
    """(ids, vecs): vectors packed by BLOCK, whatever the size of the batches that they come in."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in parts:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while len(rest) >= BLOCK:
                yield pack(rest.iloc[:BLOCK])
                rest = rest.iloc[BLOCK:]
        if rest is not None and len(rest):
            yield pack(rest)

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ids": [part["id"].to_numpy(np.int64).tobytes()], "vecs": [np.array(part["vec"].tolist(), float).tobytes()]})

    return vectors.select(F.col("id").cast("long"), "vec").mapInPandas(run, "ids binary, vecs binary")


def ratio_test(two: DataFrame, ratio: float = 0.7) -> DataFrame:
    """Whether the nearest is clearly nearer than the second; a query with one neighbour fails."""
    return two.withColumn("good", F.coalesce(F.col("d1") < ratio * F.col("d2"), F.lit(False)))


def trimmed(df: DataFrame, group: str, value: str, keep: float = 0.75) -> DataFrame:
    """Rows of each group with the smallest values, the share to keep cut down to whole rows."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(value))
    n = F.count("*").over(Window.partitionBy(group))
    return df.withColumn("__rank", rank).withColumn("__n", n).where(F.col("__rank") <= F.floor(F.col("__n") * keep)).drop("__rank", "__n")


def robustness(matches: DataFrame, group: str, tolerance: float = 20.0) -> DataFrame:
    """(group, n, inliers, mean, share, index, robust) of matches (group, residual, inlier).

    The residuals of the inliers count without their worst quarter. A group
    without inliers, or with too few to keep any, has index 0.
    """
    counts = matches.groupBy(group).agg(F.count("*").alias("n"), F.count_if("inlier").alias("inliers"))
    kept = trimmed(matches.where("inlier"), group, "residual")
    stats = kept.groupBy(group).agg(F.avg("residual").alias("mean"), (F.count_if(F.col("residual") <= tolerance) / F.count("*")).alias("share"))
    both = counts.join(stats, group, "left")
    n, inliers = F.col("n").cast("double"), F.col("inliers").cast("double")
    index = F.coalesce(formula.index(n, inliers, F.col("mean"), F.col("share"), tolerance, formula.Columns), F.lit(0.0))
    return both.withColumn("index", index).withColumn("robust", F.col("index") >= formula.ROBUST)


def ranked(two: DataFrame, by: Column, ratio: float = 0.7) -> DataFrame:
    """The good matches of each pass with their rank by distance, nearest first, ties by query."""
    good = ratio_test(two, ratio).where("good").withColumn("pass", by)
    return good.withColumn("rank", F.row_number().over(Window.partitionBy("pass").orderBy("d1", "q"))).drop("good")


def worst(df: DataFrame, group: str, value: str, keep: float = 0.75) -> DataFrame:
    """The rows that trimmed() leaves out."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(value))
    n = F.count("*").over(Window.partitionBy(group))
    return df.withColumn("__rank", rank).withColumn("__n", n).where(F.col("__rank") > F.floor(F.col("__n") * keep)).drop("__rank", "__n")
