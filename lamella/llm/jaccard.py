"""N-gram Jaccard join: documents whose sets of word n-grams have a similarity of 0.8 or more, by rare-first prefixes.

The shingles of all documents have one order, rare ones first. If two sets of n
and m shingles are similar, the first n - ceil(0.8 n) + 1 of the one and as many
of the other share a shingle. So documents are joined on these prefixes, and a
meeting is kept only if the pair can still be similar by

* length: the smaller set has 0.8 of the larger one's shingles at least,
* position: what follows the meeting shingle in both is enough,
* suffix: so it is when what follows is counted by eighths of the hash range.

A pair is similar only if these hold where its first common shingle meets, so
each pair with such a meeting is verified, once, on the whole sets.

Equal sets are one class and are joined as one. Shingles that no other text has
are the rarest. They are found before any list is made: chunks of texts exchange
packed hashes (see ``packed``), and a class with as many of them as its prefix
holds has no partner. Of the others, the shingles that are shared become rows,
get their exact counts among classes, and are put in order.

A long list doesn't become all its pairs. In two rounds its members are verified
with a few hubs, first any of them, then members of the component that has most
of the list. Then only meetings of different components are left, and of those
the ones that involve a member outside the largest. All of these are verified: no
list, partner or candidate is capped.

Shingles are told apart by 64 bits of a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.batches import small
from .common import ROW, discard, extended, materialize, rooted, small_batches, tidy, with_row
from .hashing import byte_hashes, grams, grouped, mix, run_hashes
from .packed import SENT, answers, each_chunk, elsewhere, exchange, flags, normal, send, tasks

SHINGLE, SEED = 5, 12
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Hubs of a list in a round, and rounds; what they miss is found by all that is left.
HUBS, ROUNDS = 8, 2
#: Parts of the hash range in which the suffix filter counts, as a power of two.
EIGHTHS = 3
#: Bytes of a chunk of texts, hashes that a task compares, bits of a hash beyond those that count all of them.
CHUNK, BUCKET, SPARE = 1 << 20, 1 << 21, 20
#: Bytes of an Arrow batch: each thread of an executor's JVM keeps room for the largest outside the heap.
BATCH = 4 << 20
#: Bytes hashed at once.
STEP = 1 << 20

TEXTS = "rows binary, ids array<string>, counts binary, raw binary, n_words long"


def chunked(texts: DataFrame, size: int) -> DataFrame:
    """Chunks of about size bytes of texts (__row, id: string, text), with a number each; a long text is a chunk of its own; written."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, held_bytes = [], 0

        def flush() -> pd.DataFrame:
            rows, ids, raws = zip(*held, strict=True)
            counts = [x.count(b" ") + bool(x) for x in raws]
            numbers = [np.array(x, np.int64).tobytes() for x in (rows, counts)]
            return pd.DataFrame({"rows": [numbers[0]], "ids": [list(ids)], "counts": [numbers[1]], "raw": [b" ".join(filter(None, raws))], "n_words": [sum(counts)]})

        for batch in batches:
            for row, name, text in zip(batch[ROW], batch["id"], batch["text"], strict=True):
                raw = normal(text, lower=True)
                if held and held_bytes + len(raw) > size:
                    yield flush()
                    held, held_bytes = [], 0
                held.append((row, name, raw))
                held_bytes += len(raw) + 64  # a blank text takes room too
        if held:
            yield flush()

    return materialize(texts.mapInPandas(run, TEXTS).withColumn("chunk", F.monotonically_increasing_id()))


class Sets:
    """The sets of the texts of a chunk: text and token of each member, ordered by both, and the number of words and members of each text."""

    def __init__(self, chunk: dict, shingle: int = SHINGLE):
        self.raw, self.counts = chunk["raw"], np.frombuffer(chunk["counts"], np.int64)
        data = np.frombuffer(self.raw, np.uint8)
        gaps = np.flatnonzero(data == 32)
        self.starts = np.concatenate(([0], gaps + 1)) if len(data) else gaps
        self.ends = np.concatenate((gaps, [len(data)])) if len(data) else gaps
        self.first = np.cumsum(self.counts) - self.counts
        words = self._words(data)
        left = np.repeat(self.first + self.counts, self.counts) - np.arange(len(words))
        at = np.flatnonzero(left >= shingle)
        found = [grams(words, shingle)[at] if len(at) else np.zeros(0, np.uint64)]
        text = [np.repeat(np.arange(len(self.counts)), self.counts)[at]]
        for n in range(1, shingle):  # the whole sequence, told apart from others by its length
            short = np.flatnonzero(self.counts == n)
            if len(short):
                found.append(grams(words, n)[self.first[short]] + np.uint64(n))
                text.append(short)
        own, text = mix(np.concatenate(found)), np.concatenate(text)
        order = np.lexsort((own, text))
        own, text = own[order], text[order]
        new = np.concatenate(([True], (np.diff(text) != 0) | (own[1:] != own[:-1])))[: len(own)]
        self.text, self.tokens = text[new], own[new]
        self.sizes = np.bincount(self.text, minlength=len(self.counts))

    def _words(self, data: np.ndarray) -> np.ndarray:
        """A hash of each word; in steps, so that a long text needs little memory besides itself."""
        out, value = [], byte_hashes(SEED)
        at = 0
        while at < len(self.starts):
            end = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + STEP)))
            a, b = self.starts[at], self.ends[end - 1]
            out.append(run_hashes(value[data[a:b]], self.starts[at:end] - a, self.ends[at:end] - a))
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def parts(self) -> Iterator[np.ndarray]:
        yield from np.split(self.tokens, np.cumsum(self.sizes)[:-1])


def measured(chunks: DataFrame) -> DataFrame:
    """(chunk, at, __row, id, n, key) for each text: its place, the size of its set, and a digest of it."""

    def work(chunk: dict) -> Iterator[pd.DataFrame]:
        s = Sets(chunk)
        keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in s.parts()]
        rows = np.frombuffer(chunk["rows"], np.int64)
        yield pd.DataFrame({"chunk": chunk["chunk"], "at": np.arange(len(rows)), ROW: rows, "id": chunk["ids"], "n": s.sizes, "key": keys})

    return materialize(chunks.mapInPandas(each_chunk(work), f"chunk long, at long, {ROW} long, id string, n long, key binary"))


def partnered(chunks: DataFrame, classes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(node, n, tokens) of the classes (place) whose prefix has a shingle that another text has; written.

    tokens are the shingles of the set that other texts have too, sorted; n
    counts all. Copies of a class count as others here; they leave later.
    """
    words = chunks.agg(F.sum("n_words")).first()[0] or 0
    deal, bits = tasks(words, bucket), min(64, int(words).bit_length() + SPARE)

    def short(s: Sets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return grouped(s.tokens >> np.uint64(64 - bits))

    def keys(chunk: dict) -> Iterator[pd.DataFrame]:
        yield send(chunk["chunk"], short(Sets(chunk))[0], bits, deal)

    def work(chunk: dict) -> Iterator[pd.DataFrame]:
        s = Sets(chunk)
        found, of, times = short(s)
        other = ((answers(found, bits, deal, chunk["replies"], flags) > 0) | (times > 1))[of]
        shared = np.bincount(s.text, other, minlength=len(s.sizes)).astype(np.int64)
        may = np.zeros(len(s.sizes), bool)
        may[np.asarray(chunk["wanted"], np.int64)] = True
        may &= shared * LEAST[1] >= s.sizes * LEAST[0]
        tokens = [t[o].view(np.int64) for t, o, m in zip(s.parts(), np.split(other, np.cumsum(s.sizes)[:-1]), may, strict=True) if m]
        yield pd.DataFrame({"node": np.frombuffer(chunk["rows"], np.int64)[may], "n": s.sizes[may], "tokens": pd.Series(tokens, dtype=object)})

    some = chunks.select("chunk", "rows", "counts", "raw")
    wanted = classes.groupBy("place.chunk").agg(F.collect_list("place.at").alias("wanted"))
    replies = exchange(some.mapInPandas(each_chunk(keys), SENT), deal, elsewhere)
    told = some.join(wanted, "chunk").join(replies, "chunk", "left")
    return materialize(told.mapInPandas(each_chunk(work), "node long, n long, tokens array<long>"))


def in_order(sets: DataFrame) -> DataFrame:
    """(node, n, tokens): the shingles that several sets have, rarest first; a shingle that one set has comes before all of them."""
    tokens = sets.select("node", "n", F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("k")).where("k > 1")
    ranked = tokens.join(materialize(often), "token")
    return ranked.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("k", "token"))).alias("t")).select("node", "n", F.col("t.token").alias("tokens"))


COUNTS = [f"c{i}" for i in range(1 << EIGHTHS)]
#: What a posting tells of its set.
SECOND = ["node", "n", "rest", "root", *COUNTS]


def prefixes(ordered: DataFrame) -> DataFrame:
    """(token, node, n, rest, c0 ...) for each shingle of each prefix: how many shingles follow it in the set, in all and by part of the hash range; written."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, n, tokens in zip(batch["node"], batch["n"], batch["tokens"], strict=True):
                k = n - -(-n * LEAST[0] // LEAST[1]) + 1 - (n - len(tokens))
                if k <= 0:
                    continue
                part = (np.asarray(tokens, np.int64).view(np.uint64) >> np.uint64(64 - EIGHTHS)).astype(np.int64)
                after = np.bincount(part, minlength=len(COUNTS)) - np.cumsum(part[:k, None] == np.arange(len(COUNTS)), axis=0)
                yield pd.DataFrame({"token": tokens[:k], "node": node, "n": n, "rest": after.sum(axis=1)} | dict(zip(COUNTS, after.astype(np.int32).T, strict=True)))

    return materialize(ordered.mapInPandas(run, "token long, node long, n long, rest long, " + ", ".join(f"{c} int" for c in COUNTS)))


def may_link() -> Column:
    """Whether the sets of two postings, the second's columns named with a 2, can be similar if they meet here first."""
    sizes = F.col("n") + F.col("n2")
    enough = lambda follow: (follow + 1) * sum(LEAST) >= LEAST[0] * sizes
    length = F.least("n", "n2") * LEAST[1] >= F.greatest("n", "n2") * LEAST[0]
    suffix = reduce(lambda a, b: a + b, [F.least(c, f"{c}2") for c in COUNTS])
    return length & enough(F.least("rest", "rest2")) & enough(suffix)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the distinct pairs (u, v) that are similar; written."""
    side = lambda name, n, tokens: sets.select(F.col("node").alias(name), F.col("n").alias(n), F.col("tokens").alias(tokens))
    both = pairs.join(side("u", "n", "a"), "u").join(side("v", "m", "b"), "v")
    # i / (n + m - i) >= p / q
    enough = F.size(F.array_intersect("a", "b")) * sum(LEAST) >= LEAST[0] * (F.col("n") + F.col("m"))
    return materialize(both.where(enough).select("u", "v"))


def _mixed(postings: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Postings with their root, of the lists that have several, and the root that most members have; written.

    The others have nothing left to tell, now or later.
    """
    members = rooted(postings, roots)
    by_root = members.groupBy("token", "root").agg(F.count("*").alias("k"))
    lists = by_root.groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("most"), F.count("*").alias("roots"))
    return materialize(members.join(lists.where("roots > 1").drop("roots"), "token"))


def _with_hubs(members: DataFrame, step: int) -> DataFrame:
    """Pairs (u, v) of each member with the hubs of another component that it meets most often.

    The hubs of a list are the members with the least of HUBS hashes, so lists
    that are alike have the same ones; after the first step, only members of a
    list's largest component are hubs, and the others look for one.
    """
    inside, outside = (members, members) if not step else (members.where("root = most"), members.where("root <> most"))
    least = [F.min_by("node", F.xxhash64(F.lit(step * HUBS + i), "node")).alias(f"h{i}") for i in range(HUBS)]
    hubs = inside.groupBy("token").agg(*least).select("token", F.explode(F.array_distinct(F.array(*[f"h{i}" for i in range(HUBS)]))).alias("node"))
    hubs = members.join(hubs, ["token", "node"]).select("token", *[F.col(c).alias(f"{c}2") for c in SECOND])
    met = outside.join(hubs, "token").where((F.col("root") != F.col("root2")) & may_link())
    often = met.groupBy("node", "node2").agg(F.count("*").alias("k"))
    # As many as a set's prefix has lists, times HUBS.
    best = often.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("k", "node2")), asc=False), 1, HUBS).alias("best"))
    best = best.select("node", F.explode("best.node2").alias("hub"))
    return best.select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()


def linked(sets: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(node, root): the components of the similar pairs of sets (node, n, tokens), and of what roots has connected before.

    Nodes without a partner may be left out.
    """
    members = _mixed(prefixes(in_order(sets)), roots)
    tried = None
    for step in range(ROUNDS):
        pairs = _with_hubs(members, step)
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        edges = verified(pairs, sets)
        if edges.isEmpty():
            break
        roots = extended(roots, edges)
        before, members = members, _mixed(members.drop("root", "most"), roots)
        discard(before)
    other = members.select("token", *[F.col(c).alias(f"{c}2") for c in SECOND])
    apart = (F.col("root") != F.col("root2")) & ((F.col("root2") == F.col("most")) | (F.col("node") < F.col("node2")))
    met = members.where("root <> most").join(other, "token").where(apart & may_link())
    pairs = met.select(F.least("node", "node2").alias("u"), F.greatest("node", "node2").alias("v")).distinct()
    pairs = materialize(pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti"))
    edges = verified(pairs, sets)
    return roots if roots is not None and edges.isEmpty() else extended(roots, edges)


@tidy
def near_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """(id, n_shingles, component_id, __row) for every row of docs.

    A document's set has the distinct shingles of its words, A-Z in lower case;
    fewer words than a shingle are one shingle. Two are linked if their sets have
    a similarity of LEAST or more. component_id is the smallest id reachable,
    the document's own included. A null or blank text has an empty set and is
    linked with nothing. A null id links, but names no component unless all ids
    of it are null. Repeated rows come back repeated; an empty table gives no
    rows. A text is held whole by one task, with about ten times its bytes.
    """
    small_batches(docs.sparkSession)
    with small(docs.sparkSession, BATCH):  # all but the last join runs inside
        return _near_sets(docs, id_col, text_col, chunk, bucket)


def _near_sets(docs: DataFrame, id_col: str, text_col: str, chunk: int, bucket: int) -> DataFrame:
    kind = docs.schema[id_col].dataType
    texts = with_row(docs, F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    chunks = chunked(texts, chunk)
    rows = measured(chunks).withColumn("id", F.col("id").cast(kind))
    place = F.min(F.struct("chunk", "at", ROW)).alias("place")
    classes = materialize(rows.where("n > 0").groupBy("key").agg(F.min("id").alias("first"), place))
    sets = partnered(chunks, classes, bucket)
    discard(chunks)
    roots = linked(sets)
    node = F.col(f"place.{ROW}")
    named = classes.select("key", "first", node.alias("node")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = materialize(named.join(least, "root").select("key", "component_id"))
    found = rows.join(by_class, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    return found.select("id", F.col("n").alias("n_shingles"), component, ROW)
