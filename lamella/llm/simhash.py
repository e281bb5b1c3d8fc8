"""SimHash near-duplicate detection over a byte-position inverted index.

Two 64-bit fingerprints that differ in at most two bits differ in at most two
of their eight bytes, so they share at least six positional bytes. A list of
the index holds the fingerprints that agree in four given byte positions; the
fourteen sets of four are the blocks of the Steiner system S(3, 4, 8). A pair
that shares eight, seven, six or five positional bytes meets in exactly 14, 7,
3 or 1 of the lists, one that shares four in at most 1. So the tally of the
lists in which a pair meets tells how many positional bytes it shares, pairs
under the guaranteed tally of 3 go, and the others are verified bit by bit.

Lists longer than ``LONG_LIST`` would emit a quadratic number of pairs. Their
members are linked exactly another way: fingerprints at distance two or less
share a value at distance one or less from both, so each member posts its 65
neighbours (itself and one flipped bit each), and a neighbour's posters, 65 at
most, are all linked to the smallest of them. A pair that meets in no long list
has its whole tally in short ones, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import xor

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import ROW, components, doc, materialize, numbered, small_batches, tidy, with_row

SHINGLE, SEED, MAX_BITS = 3, 42, 2
LONG_LIST = 32
#: Shingles hashed at once, so that long texts need little memory besides themselves.
STEP = 1 << 16
#: Sets of byte positions, one for each list of a fingerprint: four numbers below 8 whose exclusive or is 0.
BLOCKS = [b for b in combinations(range(8), 4) if reduce(xor, b) == 0]
#: Lists that a pair with two differing bytes still shares.
LEAST_TALLY = min(sum(not set(b) & set(gone) for b in BLOCKS) for gone in combinations(range(8), MAX_BITS))


def shingle_hashes(text: str | bytes | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of each word shingle of a text, repeats included, in arrays of at most STEP; A-Z is lower-cased.

    Fewer words than a shingle make one shingle of all; no words (null or blank
    text) make none.
    """
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    words = raw.lower().split()
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    del words
    for at in range(0, len(ends), STEP):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + STEP].tolist(), ends[at : at + STEP].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles; zero if there is none."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, shingle):
        n += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def links(classes: DataFrame) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints (fp: long) at MAX_BITS or fewer."""

    def key(number: int, block: tuple[int, ...]):
        parts = [F.shiftleft(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(0xFF)), 8 * i) for i, p in enumerate(block)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts, F.lit(number << 32).cast("long"))

    postings = classes.select("fp", F.explode(F.array(*[key(i, b) for i, b in enumerate(BLOCKS)])).alias("key"))
    lengths = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    postings = materialize(postings.join(lengths, "key"))

    short = postings.where(F.col("n") <= LONG_LIST)
    a, b = short.select("key", F.col("fp").alias("u")), short.select("key", F.col("fp").alias("v"))
    tally = a.join(b, "key").where("u < v").groupBy("u", "v").agg(F.count("*").alias("tally")).where(F.col("tally") >= LEAST_TALLY)
    near = tally.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS).select("u", "v")

    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    posted = postings.where(F.col("n") > LONG_LIST).select("fp").distinct().select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
    first = posted.groupBy("at").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    starred = posted.join(first, "at").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return near.unionByName(starred).distinct()


def _classes(prints: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id, __row, root) of written fingerprints (__row, doc_id, fp)."""
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(classes))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = named.join(least, "root").select("fp", "root", "component_id")
    return prints.join(by_class, "fp").select("doc_id", "fp", "component_id", ROW, "root")


@tidy
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id, __row, root) for every row of docs.

    component_id is the smallest id reachable over links, the document's own
    included. Null and blank texts have fingerprint zero and are linked like
    any other. Rows with a null id keep a row: they link, but never name a
    component unless all its ids are null (then component_id is null).
    Repeated rows come back repeated; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    return _classes(materialize(with_row(docs, F.col(id_col).alias("doc_id"), _fingerprints(F.col(text_col)).alias("fp"))))


@tidy
def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without all but one row of each near-duplicate group.

    The row with the group's smallest id stays (a null id comes last, and of
    rows with the same id the first read stays).
    """
    small_batches(docs.sparkSession)
    rows = numbered(docs)
    found = _classes(materialize(rows.select(ROW, doc(id_col).alias("doc_id"), _fingerprints(doc(text_col)).alias("fp"))))
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", ROW)).alias("k")).select(F.col(f"k.{ROW}").alias(ROW))
    return rows.join(materialize(kept), ROW, "left_semi").select("__doc.*")
