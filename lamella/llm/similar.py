"""The near-dedup stage: SimHash links first, completed to all pairs at a Jaccard similarity of 0.8 or more.

Two documents are linked if their sets of five-word shingles have a similarity
of 0.8 or more. A SimHash radius alone can't give these links: pairs at 0.8
differ by 10 of 64 bits on the average. So the byte-position index of ``simhash``
proposes the first links, which are verified on the whole sets and join most
copies; what it misses comes from set prefixes, so that no link is lost:

1. A document with a partner at 0.8 shares at least 0.8 of its own shingles with
   other documents. Chunks exchange hashes of their shingles (see ``packed``),
   and only documents that share so many go on; most texts end here.
2. Fingerprints within two bits, equal ones included, are linked and verified.
3. What these miss is completed by the join on rare-first prefixes of ``jaccard``,
   which starts from the groups that the fingerprints have connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from . import jaccard, simhash
from .common import ROW, discard, doc, extended, materialize, numbered, small_batches, tidy
from .hashing import grouped
from .packed import CHUNKS, SENT, Words, answers, each_chunk, elsewhere, exchange, flags, normal, pack, send, tasks

SHINGLE, SEED = 5, 7
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Bytes of a chunk, hashes that a task compares, bits of a hash.
CHUNK, BUCKET, BITS = 1 << 20, 1 << 21, 48


def shingles(words: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text given by normal()."""
    found = [x.view(np.int64) for x in simhash.shingle_hashes(words, SHINGLE)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@F.pandas_udf(ArrayType(LongType()))
def _shingles(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(t) for t in texts])


@F.pandas_udf(LongType())
def _prints(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash.fingerprint(t, SHINGLE) for t in texts], dtype="int64")


class Shingled(Words):
    """The distinct shingles of each text of a chunk, by a short hash, and the distinct hashes of all, sorted."""

    def __init__(self, chunk: dict):
        super().__init__(chunk, SEED)
        at, own = self.runs(SHINGLE)
        text = np.repeat(np.arange(len(self.counts)), self.counts)[at]
        order = np.lexsort((own, text))
        text, own = text[order], own[order]
        new = np.concatenate(([True], (np.diff(text) != 0) | (np.diff(own) != 0)))[: len(own)]
        self.text = text[new]
        self.keys, self.of, self.times = grouped(own[new] >> np.uint64(64 - BITS))

    def shared(self, deal: int, replies) -> tuple[np.ndarray, np.ndarray]:
        """For each text, its distinct shingles and how many of them another text may have too."""
        other = (answers(self.keys, BITS, deal, replies, flags) > 0) | (self.times > 1)
        n = len(self.counts)
        return np.bincount(self.text, minlength=n), np.bincount(self.text, other[self.of], minlength=n)


def _partnered(deal: int):
    """(__row, raw) of the texts that may have a partner; raw is null for a text that was cut into parts."""

    def work(chunk: dict) -> Iterator[pd.DataFrame]:
        s = Shingled(chunk)
        n, shared = s.shared(deal, chunk["replies"])
        rows, whole = (np.frombuffer(chunk[c], np.int64) for c in ("rows", "whole"))
        # Two more for hashes that meet inside the text.
        may = (n == 0) | (whole == 0) | ((shared + 2) * LEAST[1] >= n * LEAST[0])
        end = s.first + s.counts
        raw = [(s.raw[s.starts[a] : s.ends[b - 1]] if b > a else b"") if w else None for a, b, w in zip(s.first[may].tolist(), end[may].tolist(), whole[may].tolist(), strict=True)]
        yield pd.DataFrame({ROW: rows[may], "raw": pd.Series(raw, dtype=object)})

    return each_chunk(work)


def partnered(texts: DataFrame) -> DataFrame:
    """(__row, raw): of texts (__row, text) those that may have a partner, as normal() gives them; written."""
    named = texts.select(ROW, F.lit(None).cast("string").alias("id"), "text")
    chunks = materialize(named.mapInPandas(pack(SHINGLE, CHUNK, lower=True), CHUNKS).withColumn("chunk", F.monotonically_increasing_id()))
    deal = tasks(chunks.agg(F.sum("n_words")).first()[0] or 0, BUCKET)

    def edges(chunk: dict) -> Iterator[pd.DataFrame]:
        yield send(chunk["chunk"], Shingled(chunk).keys, BITS, deal)

    sent = chunks.select("chunk", "raw", "counts").mapInPandas(each_chunk(edges), SENT)
    told = chunks.select("chunk", "raw", "counts", "rows", "whole").join(exchange(sent, deal, elsewhere), "chunk", "left")
    found = materialize(told.mapInPandas(_partnered(deal), f"{ROW} long, raw binary"))
    discard(chunks)
    long = found.where("raw is null").select(ROW).distinct()
    if long.isEmpty():
        return found

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({ROW: batch[ROW], "raw": [normal(t, lower=True) for t in batch["text"]]})

    whole = texts.join(long, ROW).mapInPandas(words, f"{ROW} long, raw binary")
    return materialize(found.where("raw is not null").unionByName(whole))


def proposed(sets: DataFrame) -> DataFrame:
    """Pairs (u, v) of sets (node, fp) whose fingerprints the byte-position index links, one of each fingerprint for all of it."""
    first = materialize(sets.groupBy("fp").agg(F.min("node").alias("first")))
    near = simhash.links(first.select("fp"))
    name = lambda fp, node: first.select(F.col("fp").alias(fp), F.col("first").alias(node))
    across = near.withColumnsRenamed({"u": "p", "v": "q"}).join(name("p", "u"), "p").join(name("q", "v"), "q").select("u", "v")
    within = sets.select("node", "fp").join(first, "fp").where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v"))
    return across.unionByName(within)


def linked(sets: DataFrame) -> DataFrame:
    """(node, root): the components of the distinct sets (node, fp, tokens) that are similar."""
    sized = sets.select("node", F.size("tokens").cast("long").alias("n"), "tokens")
    close = jaccard.verified(materialize(proposed(sets).distinct()), sized)
    return jaccard.linked(sized, extended(None, close))


@tidy
def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without all but one row of each group that is connected by similar pairs.

    Words are lower-cased (A-Z); a text of fewer words than a shingle is one
    shingle. The row with the group's smallest id stays (a null id comes last,
    and of rows with the same id the first read stays). Null and blank texts are
    one group. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = numbered(docs)
    near = partnered(rows.select(ROW, doc(text_col).alias("text")))
    # Texts with the same words are one node, named by its first row.
    words = materialize(near.select(ROW, F.md5("raw").alias("words")).join(rows.select(ROW, doc(id_col).alias("id")), ROW))
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", ROW)).alias("k")
    classes = materialize(words.groupBy("words").agg(F.min(ROW).alias("node"), first))
    texts = near.join(classes.select(F.col("node").alias(ROW)), ROW, "left_semi")
    sets = materialize(texts.select(F.col(ROW).alias("node"), _shingles("raw").alias("tokens"), _prints("raw").alias("fp")))
    roots = linked(sets)
    discard(sets)
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = named.groupBy("root").agg(F.min("k").alias("k")).select(F.col(f"k.{ROW}").alias(ROW))
    gone = words.select(ROW).join(kept, ROW, "left_anti")
    return rows.join(materialize(gone), ROW, "left_anti").select("__doc.*")
