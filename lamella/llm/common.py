"""Helpers shared by the operators: reliable materialisation, row ids, components.

Nothing here collects rows. Intermediate tables are written as Parquet under
``spark.checkpoint.dir`` (the folder that driver and executors share), so a
lost executor costs only the tasks it ran.
"""

from __future__ import annotations

import atexit
import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Column names that the operators use inside; inputs are projected first, so
#: columns of the caller can't clash with them.
ROW = "__row"
#: Words are maximal runs of anything but the six ASCII white-space characters;
#: ``bytes.split()`` splits on exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows and bytes in one Arrow batch: a batch of very long texts stays small.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Shuffle files go when the step that made them has been written.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one of this machine only where none is set and Spark runs in one process (tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lamella-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Folders of tables written by the operators that are running, innermost last.
_made: list[list[str]] = []


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again; cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lamella-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_delete, spark, path)
    if _made:
        _made[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator, without the tables it wrote that its result doesn't read: those are deleted when it returns."""

    @functools.wraps(operator)
    def run(*args, **options) -> DataFrame:
        _made.append([])
        try:
            out = operator(*args, **options)
        finally:
            made = _made.pop()
        used = {f.split("/")[-2] for f in out.inputFiles()}
        for path in made:
            if path.rpartition("/")[2] not in used:
                _delete(out.sparkSession, path)
            elif _made:
                _made[-1].append(path)
        return out

    return run


class Stages:
    """Runs pipeline stages one after the other: the tables behind a stage's result go when the next stage begins.

    By then the result has been written, as the contract of a stage says.
    """

    def __init__(self) -> None:
        self.behind: list[str] = []

    def __call__(self, stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for path in self.behind:
                _delete(spark, path)
            _made.append([])
            try:
                return tidy(stage)(spark, docs, sf_dir)
            finally:
                self.behind = _made.pop()

        return run


def discard(df: DataFrame) -> None:
    """Delete a table made by materialize() that nothing reads any more."""
    for f in df.inputFiles()[:1]:
        _delete(df.sparkSession, f.rpartition("/")[0])


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may have ended already
        return


def with_row(docs: DataFrame, *cols) -> DataFrame:
    """The columns asked for, with a row id: partition and place in this scan.

    Another scan of the same files may split them otherwise and give other ids
    (the number of cores decides), so a table that is read twice is written
    first: by materialize() of this, or by numbered().
    """
    return docs.select(F.monotonically_increasing_id().alias(ROW), *cols)


def whole(docs: DataFrame) -> Column:
    """All columns of docs as one struct, __doc, so that none can clash with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")


def numbered(docs: DataFrame) -> DataFrame:
    """(__row, __doc): each row of docs as one struct, with a row id, written once.

    Ids and rows come from one scan and stay as written, whatever executors are
    lost or added later. Repeated rows and repeated or null document ids stay
    apart.
    """
    return materialize(with_row(docs, whole(docs)))


def doc(column: str) -> Column:
    """A column of a row of numbered(); only that is read."""
    return F.col("__doc")[column]


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): root is the smallest node reachable over edges (u, v: long).

    Alternating large-star and small-star rounds; each is a min by node joined
    back to the edges, so a hot node is a skewed join that adaptive execution
    splits, never a group held in one task. A node is split once what meets at it
    is larger than spark.sql.adaptive.advisoryPartitionSizeInBytes. Ends when the
    edges stand still.
    """
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, as adaptive execution only splits a join of two exchanges.
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        seen = Observation()  # counted while it is written; a repeated task could only cost one more round
        new = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        new = materialize(new.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")))
        now = seen.get
        discard(e)
        discard(low)
        e = new
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components: no fixed point")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def rooted(nodes: DataFrame, roots: DataFrame | None, node: str = "node", root: str = "root") -> DataFrame:
    """nodes with the root of one of their columns; a node without one is its own."""
    if roots is None:
        return nodes.withColumn(root, F.col(node))
    named = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return nodes.join(named, node, "left").withColumn(root, F.coalesce(root, node))


def extended(roots: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(node, root): components() of what roots has already connected and of more edges (u, v); only roots are worked on again."""
    if roots is None:
        return components(edges)
    between = rooted(rooted(edges, roots, "u", "a"), roots, "v", "b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    new = materialize(components(between))
    moved = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return materialize(moved.unionByName(new.join(roots.select("node"), "node", "left_anti")))
