"""Best-fit packing of token sequences, online and in bounded space.

Texts are tokenised once; what is kept of a piece is its length, place and
checksum. A document longer than a sequence is cut so that all its pieces but
the first are full; full pieces are sequences of their own. The rest is dealt
at random over groups of about ``GROUP`` pieces, and each group is packed
online: a piece goes to the open bin with the least free space that holds it,
found in a bitset keyed by free space. At most ``OPEN`` bins are open; when
another is needed the fullest closes. State is bounded by OPEN and the capacity.
Pieces arrive in random order through a sorted buffer: each run of ``RUN`` of
them longest first, so that the short ones of a run fill what its long ones
leave. Without the buffer best fit leaves about 2.6 % of the space, with it 0.7.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, materialize, small_batches, tidy, with_row

CAPACITY, END, OPEN, RUN, GROUP = 1024, 2, 4096, 8192, 100_000


def _bytes_of() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary.

    Bytes that print stand for themselves; the others, in order, for the
    characters from 256 on.
    """
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level file as ranks by bytes, if ranks alone say how it encodes; else None.

    That is so if texts are neither normalised nor prefixed before they are
    split by the usual pattern, the first ids are the single bytes, and each
    merge makes the token of the next id.
    """
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    usual = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain or not usual or spec.get("normalizer") or any(spec.get(k) for k in ("truncation", "padding")):
        return None
    of, special = _bytes_of(), {x["content"] for x in spec.get("added_tokens", [])}
    try:
        ranks = {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    except KeyError:
        return None
    in_order = merged == list(range(256, 256 + len(merged))) and sorted(i for b, i in ranks.items() if len(b) == 1) == list(range(256))
    return ranks if in_order and len(ranks) == 256 + len(merged) else None


@lru_cache(2)
def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Texts to ids, as the `tokenizers` library gives them for this file without special tokens added.

    A byte-level vocabulary whose merges are its ids in order is encoded by the
    faster engine of `tiktoken`, which then gives the same ids. For any other
    file, for a text that holds the string of an added token, and for one that
    the fast engine gives up on, `tokenizers` does the work itself.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    plain = lambda texts: [x.ids for x in slow.encode_batch(texts, add_special_tokens=False)]
    try:
        import public_tokenizers
        import tiktoken
    except ImportError:
        return plain
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = byte_ranks(spec)
    if ranks is None:
        return plain
    special = {x["content"] for x in spec.get("added_tokens", [])}
    fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            try:
                ids = None if any(s in text for s in special) else fast.encode_ordinary(text)
            except Exception:  # some engines refuse extreme texts
                ids = None
            out.append(plain([text])[0] if ids is None else ids)
        return out

    return encode


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(path: str, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            out = []
            ids_of = encode([t or "" for t in batch["text"]])
            for row, doc, ids in zip(batch[ROW], batch["id"], ids_of, strict=True):
                ids = np.array([*ids, END], "<u4")
                first = len(ids) % CAPACITY or CAPACITY
                for piece, end in enumerate(range(first, len(ids) + 1, CAPACITY)):
                    start = max(0, end - CAPACITY) if piece else 0
                    part = ids[start:end]
                    out.append((row, doc, piece, start, len(part), zlib.crc32(part.tobytes()), *([part.astype(np.int32)] if with_ids else [])))
            yield pd.DataFrame(out, columns=[ROW, "id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return run


def best_fit(lengths: list[int], capacity: int = CAPACITY, most_open: int = OPEN) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in order of arrival."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, n_open, made = 0, 0, 0  # free: bit f is set if an open bin has f units left
    bins, offsets = [], []
    for n in lengths:
        fits = free >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            at = stacks[left].pop()
            free ^= (not stacks[left]) << left
        else:
            if n_open == most_open:
                fullest = (free & -free).bit_length() - 1
                stacks[fullest].pop()
                free ^= (not stacks[fullest]) << fullest
                n_open -= 1
            at, left = made, capacity
            made += 1
            n_open += 1
        bins.append(at)
        offsets.append(capacity - left)
        left -= n
        if left:
            stacks[left].append(at)
            free |= 1 << left
        else:
            n_open -= 1
    return bins, offsets


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["deal", ROW, "piece"], kind="stable")
    frame = frame.iloc[np.lexsort((-frame["length"].to_numpy(), np.arange(len(frame)) // RUN))]
    bins, offsets = best_fit(frame["length"].tolist())
    number = frame["group"].to_numpy() * (1 << 32) + np.array(bins, np.int64)
    return frame.assign(sequence_id=2 * number + 1, offset=np.array(offsets, np.int64)).drop(columns=["deal", "group"])


@tidy
def pack(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(__row, id, piece, start, length, ids_crc32, [ids,] sequence_id, offset): a row for each piece of each document.

    Null and empty texts are one piece that holds the end id only. Repeated
    rows are packed as often as they occur; null ids stay null; an empty table
    gives no rows. Sequences are gapless from 0 and at most CAPACITY long.
    """
    small_batches(docs.sparkSession)
    rows = with_row(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    columns = f"{ROW} long, id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    pieces = materialize(rows.mapInPandas(_pieces(tokenizer or default_tokenizer(), with_ids), columns))
    full = pieces.where(F.col("length") == CAPACITY).withColumn("sequence_id", 2 * F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.where(F.col("length") < CAPACITY)
    groups = max(1, -(-rest.count() // GROUP))
    dealt = rest.withColumn("deal", F.xxhash64(ROW, "piece")).withColumn("group", F.pmod("deal", F.lit(groups)).cast("long"))
    packed = dealt.groupBy("group").applyInPandas(_pack, f"{columns}, sequence_id long, offset long")
    return full.unionByName(packed)
