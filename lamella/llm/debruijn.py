"""Substring dedup over a compacted De Bruijn graph of word k-mers.

A k-mer of words (k = ``WINDOW``) is an edge between its first and its last
k - 1 words, the nodes. An edge is repeated if it occurs twice or more anywhere;
words covered by a repeated edge go.

Occurrences are never rows. Texts are packed into chunks, which exchange sorted
hashes (see ``packed``), so that no passage, however frequent, makes a hot
group. Two exchanges are made:

1. edges by a short hash: those met in one place only leave;
2. nodes of what is left, by a long hash, with the words before and after: the
   answer says which of the two edges is repeated, and whether the node
   branches, that is has more than one repeated edge in or out.

With that a chunk compacts its repeated edges to paths that branch nowhere
inside. Paths are also cut at some nodes chosen by their hash, so that two
places that share a part of a path share whole pieces. Pieces of the same name
(node, first edge, length) are then joined over all source coordinates, and
their words must be the same: a digest of the source text verifies it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, discard, doc, materialize, numbered, small_batches, tidy
from .hashing import distinct, grams, grouped, mix
from .packed import CHUNKS, SENT, Words, answers, bounds, codes, each_chunk, elsewhere, encode, decode, exchange, flags, pack, send, tasks

WINDOW, SEED = 35, 7
#: Bytes of text in a chunk (a single longer word excepted); hashes that one task compares at once, about.
CHUNK, BUCKET = 1 << 20, 1 << 21
#: Bits of the short hash beyond those that number the edges: one edge in 2**SPARE stays by mistake and leaves in the second exchange.
SPARE = 11
#: One node in so many is a cut, besides those that branch.
CUTS = 16


class Graph(Words):
    """The edges and nodes of one chunk. bits, deal: of the short hash, and of the number of the task that compares it."""

    def __init__(self, chunk: dict, window: int, bits: int, deal: int, seed: int):
        super().__init__(chunk, seed)
        self.window, self.bits, self.deal = window, bits, deal

    def keys(self) -> np.ndarray:
        """The distinct short hashes of the edges, sorted."""
        return distinct(self.runs(self.window)[1] >> np.uint64(64 - self.bits))

    def live(self, replies) -> np.ndarray:
        """For each word, whether an edge starts there that may be repeated."""
        at, hashes = self.runs(self.window)
        keys, of, times = grouped(hashes >> np.uint64(64 - self.bits))
        out = np.zeros(len(self.words), bool)
        out[at] = ((answers(keys, self.bits, self.deal, replies, flags) > 0) | (times > 1))[of]
        return out

    def nodes(self, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of nodes with a live edge; their distinct (hash, words around) sorted, which is whose, and whether one is there twice.

        The words around are 31-bit hashes plus one, 0 where the edge isn't live.
        """
        before = np.concatenate(([False], live[:-1]))
        at = np.flatnonzero(live | before)
        if not len(at):
            none = np.zeros(0, np.uint64)
            return at, none, none, at, np.zeros(0, bool)
        short = (self.words >> np.uint64(33)) + np.uint64(1)
        self.node = mix(grams(self.words, self.window - 1) + np.uint64(1))
        prior = np.where(before[at], short[at - 1], np.uint64(0))
        later = np.where(live[at], short[np.minimum(at + self.window - 1, len(short) - 1)], np.uint64(0))
        node, around = self.node[at], prior << np.uint64(32) | later
        order = np.lexsort((around, node))
        node, around = node[order], around[order]
        new = np.concatenate(([True], (np.diff(node) != 0) | (np.diff(around) != 0)))
        of = np.empty(len(at), np.int64)
        of[order] = np.cumsum(new) - 1
        return at, node[new], around[new], of, np.bincount(of) > 1


def _graphs(window: int, bits: int, deal: int, seed: int, each):
    return each_chunk(lambda chunk: each(chunk, Graph(chunk, window, bits, deal, seed)))


def _send_edges(chunk: dict, g: Graph) -> Iterator[pd.DataFrame]:
    yield send(chunk["chunk"], g.keys(), g.bits, g.deal)


def _send_nodes(chunk: dict, g: Graph) -> Iterator[pd.DataFrame]:
    live = g.live(chunk["replies"])
    _, node, around, _, twice = g.nodes(live)
    cut = bounds(node, 64, g.deal)
    some = np.flatnonzero(np.diff(cut)).tolist()
    parts = [slice(cut[b], cut[b + 1]) for b in some]
    rows = [(b, encode(node[p]), around[p].tobytes(), np.packbits(twice[p]).tobytes()) for b, p in zip(some, parts, strict=True)]
    # The chunk's own row keeps what the first exchange said.
    out = pd.DataFrame([*rows, (-1, np.packbits(live).tobytes(), None, None)], columns=["bucket", "keys", "around", "twice"])
    yield out.assign(chunk=chunk["chunk"])


def _degrees(node: np.ndarray, word: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (node, word): whether that edge is repeated, and whether its node has more than one repeated edge."""
    order = np.lexsort((word, node))
    n, w = node[order], word[order]
    new = np.concatenate(([True], (np.diff(n) != 0) | (np.diff(w) != 0)))
    first = np.flatnonzero(new)
    repeated = (np.add.reduceat(weight[order], first) > 1) & (w[first] > 0)
    at = np.cumsum(np.concatenate(([True], np.diff(n[first]) != 0))) - 1
    branches = np.bincount(at, repeated)[at] > 1
    group = np.cumsum(new) - 1
    out = np.empty(len(n), bool), np.empty(len(n), bool)
    out[0][order], out[1][order] = repeated[group], branches[group]
    return out


def _answer_nodes(rows: list[dict]) -> list[bytes | None]:
    """Four bits for each node of a chunk: edge out repeated, edge in repeated, branches out, branches in."""
    node = [decode(r["keys"]) for r in rows]
    cuts = np.cumsum([len(x) for x in node])[:-1]
    weight = np.concatenate([np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(x)) for r, x in zip(rows, node, strict=True)]).astype(np.int64) + 1
    around = np.concatenate([np.frombuffer(r["around"], np.uint64) for r in rows])
    node = np.concatenate(node)
    out, out_branch = _degrees(node, around & np.uint64(0xFFFFFFFF), weight)
    into, in_branch = _degrees(node, around >> np.uint64(32), weight)
    code = (out | into << 1 | out_branch << 2 | in_branch << 3).astype(np.uint8)
    return [x.tobytes() if x.any() else None for x in np.split(code, cuts)]


def _runs(flags: np.ndarray) -> np.ndarray:
    """(n, 2): the runs [start, end) of true flags."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0])))).reshape(-1, 2)


PIECE = ("node", "edge", "length", "high", "low")
FOUND = f"{ROW} long, id string, whole boolean, n_units long, n_removed long, spans array<array<long>>, kept binary, " + ", ".join(f"{c} array<long>" for c in PIECE)


def _cut(chunk: dict, g: Graph) -> Iterator[pd.DataFrame]:
    """What is left of each text of a chunk, its removed spans, and the pieces of its repeated paths.

    Of a part of a long text the spans are runs of repeated edges.
    """
    live = np.unpackbits(np.frombuffer(chunk["live"], np.uint8), count=len(g.words)).astype(bool)
    at, node, _, of, _ = g.nodes(live)
    code = answers(node, 64, g.deal, chunk["replies"], codes)[of] if len(at) else np.zeros(0, np.uint8)
    repeated, cuts = np.zeros(len(live), bool), np.zeros(len(live) + 1, bool)
    repeated[at[(code & 1) > 0]] = True
    repeated &= live
    if len(at):
        cuts[at] = ((code & 12) > 0) | (g.node[at] % np.uint64(CUTS) == 0)
    runs = _runs(repeated)
    change = np.zeros(len(live) + 1, np.int64)
    np.add.at(change, runs[:, 0], 1)
    np.add.at(change, np.minimum(runs[:, 1] + g.window - 1, len(live)), -1)
    gone = np.cumsum(change[:-1]) > 0

    # Pieces: edges [a, b) of a run between cuts.
    inside = np.flatnonzero(cuts[:-1] & repeated & np.concatenate(([False], repeated[:-1])))
    a = np.sort(np.concatenate([runs[:, 0], inside]))
    b = np.sort(np.concatenate([runs[:, 1], inside]))
    names = [g.node[a].view(np.int64), (g.words[a + g.window - 1] >> np.uint64(33)).astype(np.int64), b - a] if len(a) else [a, a, a]
    digest = [xxhash.xxh3_128_intdigest(g.raw[s:e]) for s, e in zip(g.starts[a].tolist(), g.ends[b + g.window - 2].tolist(), strict=True)] if len(a) else []
    high, low = (np.array([(x >> k) & ((1 << 64) - 1) for x in digest], np.uint64).view(np.int64) for k in (64, 0))
    pieces = [*names, high, low]

    out = []
    numbers = [np.frombuffer(chunk[c], np.int64) for c in ("rows", "firsts", "whole")]
    ids = chunk["ids"]
    end = g.first + g.counts
    piece_at, run_at = np.searchsorted(a, g.first), np.searchsorted(runs[:, 0], g.first)
    piece_end, run_end = np.searchsorted(a, end), np.searchsorted(runs[:, 0], end)
    for i, (row, first, whole) in enumerate(zip(*(x.tolist() for x in numbers), strict=True)):
        lo, hi = int(g.first[i]), int(end[i])
        own = [x[piece_at[i] : piece_end[i]] for x in pieces]
        if not whole:
            spans = runs[run_at[i] : run_end[i]] - lo + first
            out.append((row, ids[i], False, 0, 0, spans.tolist(), None, *own))
            continue
        spans = _runs(gone[lo:hi])
        if hi == lo:
            kept = b""
        elif not len(spans):
            kept = g.raw[g.starts[lo] : g.ends[hi - 1]]
        else:
            kept = b" ".join(g.raw[g.starts[x] : g.ends[y - 1]] for x, y in (_runs(~gone[lo:hi]) + lo).tolist())
        out.append((row, ids[i], True, hi - lo, int(gone[lo:hi].sum()), spans.tolist(), kept, *own))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])


def _cut_long(window: int):
    """What is left of texts that were cut into parts, from all their runs of repeated edges."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, name, text, runs in zip(batch[ROW], batch["id"], batch["text"], batch["runs"], strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                change = np.zeros(len(words) + 1, np.int64)
                for lo, hi in runs:
                    change[lo] += 1
                    change[min(hi + window - 1, len(words))] -= 1
                gone = np.cumsum(change[:-1]) > 0
                out.append((row, name, len(words), int(gone.sum()), _runs(gone).tolist(), b" ".join(w for w, x in zip(words, gone, strict=True) if not x)))
            yield pd.DataFrame(out, columns=[ROW, "id", "n_units", "n_removed", "spans", "kept"])

    return run


def _compacted(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """The columns FOUND for (__row, id: string, text), written."""
    chunks = materialize(rows.mapInPandas(pack(window, CHUNK), CHUNKS).withColumn("chunk", F.monotonically_increasing_id()))
    n = chunks.agg(F.sum("n_words")).first()[0] or 0
    bits, deal = min(64, max(40, n.bit_length() + SPARE)), tasks(n, BUCKET)
    graph = chunks.select("chunk", "raw", "counts")
    run = lambda each: _graphs(window, bits, deal, seed, each)

    asked = graph.join(exchange(graph.mapInPandas(run(_send_edges), SENT), deal, elsewhere), "chunk", "left")
    nodes = materialize(asked.mapInPandas(run(_send_nodes), "bucket int, keys binary, around binary, twice binary, chunk long"))
    live = nodes.where("bucket = -1").select("chunk", F.col("keys").alias("live"))
    told = live.join(exchange(nodes.where("bucket >= 0"), deal, _answer_nodes), "chunk", "left")
    out = materialize(chunks.join(told, "chunk").mapInPandas(run(_cut), FOUND))
    discard(nodes)
    discard(chunks)
    return out


def verify(found: DataFrame) -> None:
    """Raise if two pieces of one name differ in their words, over all places where they occur."""
    pieces = found.select(F.explode(F.arrays_zip(*PIECE)).alias("p")).groupBy(*[f"p.{c}" for c in PIECE[:3]])
    differ = pieces.agg(*[(F.min(f"p.{c}") != F.max(f"p.{c}")).alias(c) for c in PIECE[3:]]).where("high or low")
    if not differ.isEmpty():
        raise RuntimeError("two different passages have the same hashes; use another seed")


def _dedup(rows: DataFrame, id_col: str, text_col: str, window: int, seed: int = SEED) -> DataFrame:
    kind = rows.schema["__doc"].dataType[id_col].dataType
    texts = rows.select(ROW, doc(id_col).cast("string").alias("id"), doc(text_col).alias("text"))
    found = _compacted(texts, window, seed)
    verify(found)
    columns = [ROW, F.col("id").cast(kind).alias("id"), "n_units", "n_removed", "spans", "kept"]
    out = found.where("whole").select(*columns)
    long = found.where("not whole").groupBy(ROW).agg(F.flatten(F.collect_list("spans")).alias("runs"))
    if long.isEmpty():
        return out
    schema = f"{ROW} long, id string, n_units long, n_removed long, spans array<array<long>>, kept binary"
    return out.unionByName(texts.join(materialize(long), ROW).mapInPandas(_cut_long(window), schema).select(*columns))


@tidy
def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(__row, id, n_units, n_removed, spans, kept): words outside any repeated window, joined by a space.

    Words are taken unchanged. Matches never cross documents; a window that
    starts at two places of one document is repeated too. spans are the maximal
    removed runs [start, end) in words. Null and blank texts have no words;
    repeated rows lose all words if they are a window long; an empty table gives
    no rows. A text longer than a chunk is worked through in overlapping parts.
    """
    small_batches(docs.sparkSession)
    return _dedup(numbered(docs), id_col, text_col, window, seed)


@tidy
def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with repeated spans cut out of the texts; a text without any stays as it was.

    All columns stay; length_col, if there, is set to the new length in
    characters. A text of which nothing is left becomes empty.
    """
    small_batches(docs.sparkSession)
    rows = numbered(docs)
    found = _dedup(rows, id_col, text_col, WINDOW).where("n_removed > 0").select(ROW, F.col("kept").cast("string").alias("__kept"))
    new = F.col("__kept")
    out = {c: doc(c) for c in docs.columns}
    out[text_col] = F.coalesce(new, out[text_col])
    if length_col in out:
        out[length_col] = F.when(new.isNotNull(), F.length(new).cast(docs.schema[length_col].dataType)).otherwise(out[length_col])
    return rows.join(found, ROW, "left").select(*[x.alias(c) for c, x in out.items()])
