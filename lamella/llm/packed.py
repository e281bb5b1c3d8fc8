"""Texts packed into chunks, and exchanges of sorted hashes between them.

What occurs somewhere is never a row: a chunk sends its distinct hashes sorted
and delta-coded, dealt by their leading bits, and the task that has a range of
the hashes sends each chunk its answers. Copies inside a chunk are sent once and
hashes spread evenly, so nothing that is frequent makes a hot group, and what a
task holds is bounded by the sizes of a chunk and of a range.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, materialize
from .hashing import byte_hashes, distinct, grams, mix, run_hashes

CHUNKS = "rows binary, ids array<string>, firsts binary, counts binary, whole binary, raw binary, n_words long"


def normal(text: str | None, lower: bool = False) -> bytes:
    """The words of a text joined by one space."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return b" ".join((raw.lower() if lower else raw).split())


def pack(window: int, size: int, lower: bool = False):
    """Chunks of texts: their words joined by one space, A-Z in lower case if lower. A text longer than a chunk is cut into parts that overlap by window - 1 words."""

    def parts(text: str | None) -> Iterator[tuple[int, bool, bytes, int]]:
        raw = normal(text, lower)
        if len(raw) <= size:
            yield 0, True, raw, raw.count(b" ") + bool(raw)
            return
        words = raw.split()
        at, end, n = 0, 0, 0
        while at < len(words):
            while end < len(words) and (n < size or end == at):
                n += len(words[end]) + 1
                end += 1
            part = words[at : end + window - 1]
            yield at, False, b" ".join(part), len(part)
            at, n = end, 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        bytes_held = 0

        def flush() -> pd.DataFrame:
            rows, ids, firsts, whole, raws, counts = zip(*held, strict=True)
            numbers = [np.array(x, np.int64).tobytes() for x in (rows, firsts, counts, whole)]
            return pd.DataFrame({"rows": [numbers[0]], "ids": [list(ids)], "firsts": [numbers[1]], "counts": [numbers[2]], "whole": [numbers[3]], "raw": [b" ".join(x for x in raws if x)], "n_words": [sum(counts)]})

        for batch in batches:
            for row, name, text in zip(batch[ROW], batch["id"], batch["text"], strict=True):
                for first, whole, raw, n in parts(text):
                    if held and bytes_held + len(raw) > size:
                        yield flush()
                        held, bytes_held = [], 0
                    held.append((row, name, first, whole, raw, n))
                    bytes_held += len(raw) + 1
        if held:
            yield flush()

    return run


def encode(sorted_keys: np.ndarray) -> bytes:
    """Differences of sorted 64-bit keys, byte plane by byte plane, without the leading planes that are zero."""
    steps = np.diff(sorted_keys, prepend=np.uint64(0))
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def decode(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return np.cumsum(out.reshape(-1).view("<u8").astype(np.uint64))


class Words:
    """The words of one chunk and the hash of each."""

    def __init__(self, chunk: dict, seed: int):
        self.raw, self.counts = chunk["raw"], np.frombuffer(chunk["counts"], np.int64)
        data = np.frombuffer(self.raw, np.uint8)
        gaps = np.flatnonzero(data == 32)
        self.starts = np.concatenate(([0], gaps + 1)) if len(data) else gaps
        self.ends = np.concatenate((gaps, [len(data)])) if len(data) else gaps
        self.words = run_hashes(byte_hashes(seed)[data], self.starts, self.ends)
        self.first = np.cumsum(self.counts) - self.counts  # of each text

    def runs(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the runs of ``window`` words of one text start, and their hashes."""
        left = np.repeat(self.first + self.counts, self.counts) - np.arange(len(self.words))
        at = np.flatnonzero(left >= window)
        return at, mix(grams(self.words, window))[at] if len(at) else np.zeros(0, np.uint64)


def tasks(n: int, size: int) -> int:
    """Bits that number the tasks which compare n hashes, about ``size`` in each."""
    return max(0, math.ceil(math.log2(max(1, n / size))))


def bounds(keys: np.ndarray, bits: int, deal: int) -> np.ndarray:
    """Where the keys of each task begin among sorted keys of so many bits."""
    return np.searchsorted(keys >> np.uint64(bits - deal) if deal else np.zeros(len(keys), np.uint64), np.arange((1 << deal) + 1, dtype=np.uint64))


def answers(keys: np.ndarray, bits: int, deal: int, replies, unpack: Callable[[bytes, int], np.ndarray]) -> np.ndarray:
    """What came back for each of a chunk's sorted keys; 0 where nothing did."""
    out, cut = np.zeros(len(keys), np.uint8), bounds(keys, bits, deal)
    for r in replies if replies is not None else ():
        a, b = cut[r["bucket"]], cut[r["bucket"] + 1]
        out[a:b] = unpack(r["data"], b - a)
    return out


def flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n)


def codes(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


def by_bucket(answer):
    """Rows come sorted by bucket; answer gives the data of the replies for all rows of one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[dict] = []

        def reply(rows: list[dict]) -> pd.DataFrame:
            found = [(r["chunk"], r["bucket"], x) for r, x in zip(rows, answer(rows), strict=True) if x is not None]
            return pd.DataFrame(found, columns=["chunk", "bucket", "data"]).astype({"chunk": "int64", "bucket": "int32"})

        for batch in batches:
            for row in batch.to_dict("records"):
                if rest and rest[0]["bucket"] != row["bucket"]:
                    yield reply(rest)
                    rest = []
                rest.append(row)
        if rest:
            yield reply(rest)

    return run


def elsewhere(rows: list[dict]) -> list[bytes | None]:
    """A bit for each key: whether another chunk has it too."""
    keys = [decode(r["keys"]) for r in rows]
    every = np.sort(np.concatenate(keys))
    several = distinct(every[1:][every[1:] == every[:-1]])
    if not len(several):
        return [None] * len(rows)
    hits = [several[np.minimum(np.searchsorted(several, k), len(several) - 1)] == k for k in keys]
    return [np.packbits(h).tobytes() if h.any() else None for h in hits]


def exchange(sent: DataFrame, deal: int, answer: Callable[[list[dict]], list[bytes | None]]) -> DataFrame:
    """(chunk, replies) for rows (bucket, chunk, ...) that chunks send; written."""
    dealt = sent.repartition(1 << deal, "bucket").sortWithinPartitions("bucket")
    back = materialize(dealt.mapInPandas(by_bucket(answer), "chunk long, bucket int, data binary"))
    return back.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "data")).alias("replies"))


def send(chunk: int, keys: np.ndarray, bits: int, deal: int) -> pd.DataFrame:
    """Rows (bucket, chunk, keys) of a chunk's sorted distinct keys."""
    cut = bounds(keys, bits, deal)
    some = np.flatnonzero(np.diff(cut)).tolist()
    return pd.DataFrame({"bucket": some, "chunk": chunk, "keys": [encode(keys[cut[b] : cut[b + 1]]) for b in some]}).astype({"bucket": "int32", "chunk": "int64"})


SENT = "bucket int, chunk long, keys binary"


def each_chunk(work: Callable[[dict], Iterator[pd.DataFrame]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk in batch.to_dict("records"):
                yield from work(chunk)

    return run
