"""Suffix-array dedup by a depth-limited radix sort of the suffixes, on bytes.

Suffixes need an order only through the first ``WINDOW`` bytes: two windows are
equal exactly if their suffixes stay in one group to that depth. The sort goes
most significant digit first, digits are blocks of bytes, and a suffix alone in
its group leaves after each pass:

1. anchor: among the grams (short runs of bytes) of a window the one with the
   smallest hash is its anchor, so equal windows have equal anchors at equal
   places. Suffixes that follow each other and share the anchor enter as one
   run, a row for about 70 of them, dealt by the anchor; runs whose anchor
   occurs once leave.
2. run: of runs with equal bytes one stays, with their number; if an anchor has
   no other, all its suffixes are in groups of several and the sort of it ends.
3. suffixes: the runs that are left are opened, and their suffixes are sorted by
   the blocks of bytes ``DIGITS``, from the first byte to the full depth, inside
   the groups that the passes before left. Equal groups are the repeated windows,
   and their bytes are compared, not only hashes.

An anchor with up to ``GATHER`` contents is finished in memory. Runs of a hotter
one are cut again by longer grams, nearer to the whole window, and go through
the passes once more; what is hot under the longest grams becomes a row for each
suffix, for a last grouped count to the full depth. Sorting single suffixes from
the start would shuffle over six times the input even as packed hashes.

Every grouped count aggregates partially before it shuffles; what one task
gathers is bounded by GATHER runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, discard, doc, materialize, numbered, small_batches, tidy
from .hashing import byte_hashes, grams, mix

WINDOW, GRAMS = 200, (32, 150, 190)
#: Depths that the digits of the third pass end at, as parts of the window.
DIGITS = (0.2, 0.6, 1.0)
#: Bytes looked at together; a longer document is worked through in steps that
#: overlap by a window, so that no window is missed and memory stays bounded.
STEP = 1 << 21
#: Most contents of one anchor that are compared in one place; bytes of runs sorted at once.
GATHER, SORTED = 1000, 1 << 22
_PLACE = np.uint64((1 << 22) - 1)
_BYTE = byte_hashes(7)


@dataclass(frozen=True)
class Depth:
    """Window and gram lengths in bytes."""

    window: int = WINDOW
    grams: tuple[int, ...] = GRAMS


def _signed(digests: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests as two columns of longs."""
    return tuple(np.array([(x >> k) & ((1 << 64) - 1) for x in digests], np.uint64).view(np.int64) for k in (64, 0))


def runs_of(raw: bytes, depth: Depth, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First suffix, last suffix and anchor hash of each run of one document, in steps."""
    for at in range(0, max(1, len(raw) - depth.window + 1), STEP):
        h = _BYTE[np.frombuffer(raw[at : at + STEP + depth.window - 1], np.uint8)]
        windows = len(h) - depth.window + 1
        if windows < 1:
            break
        found = mix(grams(h, gram))
        low = (found & ~_PLACE) | np.arange(len(found), dtype=np.uint64)
        size, span = 1, depth.window - gram + 1
        while size < span:
            by = min(size, span - size)
            low = np.minimum(low[:-by], low[by:])
            size += by
        place = (low & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        last = np.concatenate((first[1:] - 1, [windows - 1]))
        yield first + at, last + at, found[place[first]].view(np.int64)


def _find(depth: Depth):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_intdigest
        for batch in batches:
            out, n = [], 0
            for row, text in zip(batch[ROW], batch["text"], strict=True):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                for lo, hi, anchor in runs_of(raw, depth, depth.grams[0]):
                    whole = [digest(raw[a:b]) for a, b in zip(lo.tolist(), (hi + depth.window).tolist(), strict=True)]
                    out.append((np.full(len(lo), row, np.int64), lo, hi, anchor, *_signed(whole)))
                    n += len(lo)
                    if n > STEP:  # periodic text has a run for each suffix
                        yield table(out)
                        out, n = [], 0
            if out:
                yield table(out)

    def table(out: list) -> pd.DataFrame:
        return pd.DataFrame(dict(zip((ROW, "lo", "hi", "anchor", "whole", "more"), (np.concatenate(x) for x in zip(*out, strict=True)), strict=True)))

    return run


def _open(depth: Depth):
    """The runs to be opened, with their bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, n = [], 0
            for row, text, opened in zip(batch[ROW], batch["text"], batch["opened"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for x in opened:
                    out.append((row, x["lo"], x["anchor"], x["n"], raw[x["lo"] : x["hi"] + depth.window]))
                    n += len(out[-1][-1])
                    if n > SORTED:
                        yield pd.DataFrame(out, columns=[ROW, "lo", "anchor", "n", "raw"])
                        out, n = [], 0
            yield pd.DataFrame(out, columns=[ROW, "lo", "anchor", "n", "raw"])

    return run


def _recut(depth: Depth, gram: int):
    """Runs under longer grams, of runs given by their bytes; keeps the bytes of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_intdigest
        for batch in batches:
            out = []
            for row, at, n, raw in zip(*[batch[c] for c in (ROW, "lo", "n", "raw")], strict=True):
                for lo, hi, anchor in runs_of(raw, depth, gram):
                    own = [raw[a:b] for a, b in zip(lo.tolist(), (hi + depth.window).tolist(), strict=True)]
                    high, low = _signed([digest(x) for x in own])
                    out += zip([row] * len(lo), (lo + at).tolist(), (hi + at).tolist(), [n] * len(lo), anchor.tolist(), high.tolist(), low.tolist(), own, strict=True)
            yield pd.DataFrame(out, columns=[ROW, "lo", "hi", "n", "anchor", "whole", "more", "raw"])

    return run


def repeated_suffixes(anchors: np.ndarray, raws: list[bytes], times: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Radix sort of all suffixes of the runs, each inside its anchor's group, to depth ``window``.

    (run, place in the run) of the suffixes that share their first window bytes
    with another, or whose run occurs several times.
    """
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    starts = np.cumsum(lengths) - lengths
    count = lengths - window + 1
    run = np.repeat(np.arange(len(raws)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - starts, count)
    data = np.frombuffer(b"".join([*raws, bytes(8)]), np.uint8)
    h = _BYTE[data[:-8]]
    group, live, before = anchors.view(np.uint64)[run], np.arange(len(run)), 0
    for end in sorted({max(1, round(window * x)) for x in DIGITS}):
        digit = grams(h, end - before)[at[live] + before]
        key = mix(group[live] * np.uint64(0xD6E8FEB86659FD93) + mix(digit))
        order = np.argsort(key, kind="stable")
        key, live = key[order], live[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        of = np.cumsum(new) - 1
        stay = np.bincount(of, times[run[live]])[of] > 1
        group[live], before = key, end
        live, new = live[stay], new[stay]
        if not len(live):
            return run[live], at[live]
    # Neighbours in a group have equal bytes, eight at a time; else hashes have met, and the group is split by its bytes.
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)[:, ::1]
    same = ~new[1:]
    for k in [*range(0, window - 7, 8), *([window - 8] if window % 8 and window > 8 else [])]:
        word = eight[at[live] + k].copy().view(np.uint64)[:, 0]
        same &= new[1:] | (word[1:] == word[:-1])
    if (same | new[1:]).all():
        return run[live], at[live] - starts[run[live]]
    total: dict[tuple, int] = {}
    keys = [(int(anchors[r]), data[a : a + window].tobytes()) for r, a in zip(run[live].tolist(), at[live].tolist(), strict=True)]
    for key, r in zip(keys, run[live].tolist(), strict=True):
        total[key] = total.get(key, 0) + int(times[r])
    live = live[np.array([total[key] > 1 for key in keys], bool)]
    return run[live], at[live] - starts[run[live]]


def _compare(depth: Depth):
    """Runs of suffixes that are repeated among those of one anchor; rows come sorted by anchor."""

    def of(rows: list[tuple]) -> pd.DataFrame:
        row, lo, n, anchor = (np.array(x, np.int64) for x in list(zip(*rows, strict=True))[:4])
        found, place = repeated_suffixes(anchor, [r[4] for r in rows], n, depth.window)
        once = n[found] == 1  # of the others all suffixes are known to be repeated
        found, place = found[once], place[once]
        order = np.lexsort((place, found))
        found, place = found[order], place[order]
        first = np.concatenate(([True], (np.diff(found) != 0) | (np.diff(place) != 1)))[: len(found)]
        last = np.concatenate((first[1:], [True]))[: len(found)]
        own = found[first]
        return pd.DataFrame({ROW: row[own], "lo": lo[own] + place[first], "hi": lo[own] + place[last]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for x in zip(*[batch[c] for c in (ROW, "lo", "n", "anchor", "raw")], strict=True):
                if size > SORTED and x[3] != rows[-1][3]:
                    yield of(rows)
                    rows, size = [], 0
                rows.append(x)
                size += len(x[4])
        if rows:
            yield of(rows)

    return run


def _explode(depth: Depth):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_intdigest
        for batch in batches:
            for row, lo, n, raw in zip(*[batch[c] for c in (ROW, "lo", "n", "raw")], strict=True):
                high, low = _signed([digest(raw[i : i + depth.window]) for i in range(len(raw) - depth.window + 1)])
                yield pd.DataFrame({ROW: row, "lo": np.arange(lo, lo + len(high)), "high": high, "low": low, "n": n})

    return run


RUNS = f"{ROW} long, lo long, hi long"


def repeated(docs: DataFrame, depth: Depth) -> DataFrame:
    """(__row, lo, hi): runs of suffixes that are repeated to the full depth, for docs (__row, text)."""
    found = materialize(docs.mapInPandas(_find(depth), f"{RUNS}, anchor long, whole long, more long").withColumn("n", F.lit(1).cast("long")))
    return materialize(_refine(found, depth, depth.grams[1:], docs))


def _refine(found: DataFrame, depth: Depth, longer: tuple[int, ...], docs: DataFrame | None = None) -> DataFrame:
    """Repeated runs among runs (__row, lo, hi, n, anchor, whole, more[, raw]); n: how often the run occurs.

    The bytes of the runs to be opened come from docs, if not in raw. Of a run
    with n over 1 all suffixes are known to be repeated.
    """
    differ = (F.min("whole") != F.max("whole")) | (F.min("more") != F.max("more"))
    anchors = found.groupBy("anchor").agg(F.sum("n").alias("times"), differ.alias("mixed")).where("times > 1").drop("times")
    shared = materialize(found.join(materialize(anchors), "anchor"))  # written first: a skewed join can be split, one with an aggregate can't
    discard(found)
    alike, mixed = shared.where("not mixed"), shared.where("mixed")

    content = ["anchor", "whole", "more"]
    one = F.struct(ROW, "lo", "hi", *["raw"] * (docs is None))
    contents = materialize(mixed.groupBy(*content).agg(F.sum("n").alias("n"), F.min(one).alias("one")))
    copied = mixed.join(contents.where("n > 1").select(*content), content)
    out = alike.select(ROW, "lo", "hi").unionByName(copied.select(ROW, "lo", "hi"))

    if docs is None:
        bare = contents.select("one.*", "anchor", "n")
    else:
        opened = contents.groupBy(F.col(f"one.{ROW}").alias(ROW)).agg(F.collect_list(F.struct("one.lo", "one.hi", "anchor", "n")).alias("opened"))
        bare = materialize(docs.join(opened, ROW).mapInPandas(_open(depth), f"{ROW} long, lo long, anchor long, n long, raw binary"))
    bare = bare.select(ROW, "lo", "anchor", "n", "raw")
    hot = materialize(contents.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > GATHER).select("anchor"))
    out = out.unionByName(bare.join(hot, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_compare(depth), RUNS))
    if hot.isEmpty():
        return out
    if longer:
        again = bare.join(hot, "anchor").mapInPandas(_recut(depth, longer[0]), f"{RUNS}, n long, anchor long, whole long, more long, raw binary")
        return out.unionByName(_refine(materialize(again), depth, longer[1:]))
    suffixes = materialize(bare.join(hot, "anchor").mapInPandas(_explode(depth), f"{ROW} long, lo long, high long, low long, n long"))
    several = suffixes.groupBy("high", "low").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    return out.unionByName(suffixes.where("n = 1").join(several, ["high", "low"]).select(ROW, "lo", F.col("lo").alias("hi")))


def _cut_out(depth: Depth):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, runs in zip(batch["text"], batch["runs"], strict=True):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                n, drop = len(raw), np.zeros(len(raw) + 1, np.int64)
                if runs is not None and len(runs):
                    np.add.at(drop, [x["lo"] for x in runs], 1)
                    np.add.at(drop, [x["hi"] + depth.window for x in runs], -1)
                drop = np.cumsum(drop[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], drop.view(np.int8), [0]))))
                keep = np.concatenate(([0], edge, [n])).reshape(-1, 2)
                out.append((n, int(drop.sum()), edge.reshape(-1, 2).tolist(), b"".join(raw[a:b] for a, b in keep.tolist())))
            got = pd.DataFrame(out, columns=["n_units", "n_removed", "spans", "kept"])
            yield pd.concat([batch[[ROW, "id"]].reset_index(drop=True), got], axis=1)

    return run


@tidy
def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(__row, id, n_units, n_removed, spans, kept): UTF-8 bytes outside any repeated window.

    A byte goes if a repeated window covers it, in every place the window
    occurs; spans are the maximal removed runs [start, end) in bytes. Matches
    never cross documents; a window that starts at two places of one document is
    repeated too. Null and empty texts have no bytes; repeated rows lose all
    bytes if they are a window long; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows, depth = numbered(docs), Depth(window, tuple(min(g, window) for g in GRAMS))
    texts = rows.select(ROW, doc(id_col).alias("id"), doc(text_col).alias("text"))
    runs = repeated(texts.select(ROW, "text"), depth).groupBy(ROW).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.join(runs, ROW, "left").select(ROW, "id", "text", "runs").mapInPandas(
        _cut_out(depth), f"{ROW} long, id {kind}, n_units long, n_removed long, spans array<array<long>>, kept binary"
    )
