"""Quality rules by distribution divergence.

For each language the corpus itself gives two references: the histogram of
character classes and the histogram of its common words, each counted over all
documents that pass the base rules. A document is compared with its language's
references, and if it is far from them with those of every language (a wrong
language label is no fault of the text), by Jensen-Shannon distance (base 2, 0
to 1). Short documents give noisy histograms, so a distance is judged only from
a minimum length on, and the limit is wider the fewer characters or words there
are.

The texts are read once: what is kept of a document is its counts, its character
classes and hashes of its distinct words with their counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, doc, materialize, numbered, small_batches, tidy, with_row

MIN_WORDS, MOST_REPEATED = 50, 50  # base rules: words at least, per cent of repeated words at most
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other")
#: Common words are the COMMON most frequent ones; they are ranked in BUCKETS first, so that no task ranks all words of a language.
COMMON, BUCKETS = 48, 64
#: Words are told apart by a hash of 40 bits, so that what is kept of a document is small whatever its words.
WORD_BITS = 40
#: A distance is judged from FROM characters or words on, against LIMIT + SPREAD / sqrt(length).
CHARS_FROM, CHARS_LIMIT, CHARS_SPREAD = 100, 0.24, 1.0
WORDS_FROM, WORDS_LIMIT, WORDS_SPREAD = 50, 0.12, 3.0
SYMBOLS = b"#*$%&|<>"
_STOPS = frozenset(".,;:!?'\"()-…«»¿¡’“”„")


def _classes() -> np.ndarray:
    out = np.full(1 << 16, 6, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        out[i] = 3 if c.isspace() else 4 if c in _STOPS else 2 if c.isdigit() else 1 if c.isupper() else 0 if c.isalpha() else 5 if i < 128 else 6
    return out


_CLASS = _classes()
_CODES = [SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))]


def char_classes(text: str) -> np.ndarray:
    """Characters of each class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_CLASS[np.minimum(points, 0xFFFF)], minlength=len(CLASSES))


def measure(text: str | None) -> tuple[int, int, int, int, int, list[int], list[int], list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, character classes, hashes of the distinct words, their counts."""
    if not text:
        return 0, 0, 0, 0, 0, [0] * len(CLASSES), [], []
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = int(np.count_nonzero((np.frombuffer(b"".join(words), np.uint8) & 0xC0) != 0x80))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    repeated = 0
    if n >= 3:
        kinds = len(number)
        windows = ids[:-2] * kinds + ids[1:-1]
        if kinds >= 1 << 21:  # three ids don't fit in 64 bits
            windows = np.unique(windows, return_inverse=True)[1]
        windows = windows * kinds + ids[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        hit = np.zeros(n, bool)
        for at in (order[1:][same], order[:-1][same]):
            for k in range(3):
                hit[at + k] = True
        repeated = int(hit.sum())
    times = np.bincount(ids, minlength=len(number)).tolist()
    return n, chars, sum(map(raw.count, _CODES)), len(lines) - len(set(lines)), repeated, char_classes(text).tolist(), list(map(word_hash, number)), times


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - WORD_BITS)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ", ".join(f"{c} long" for c in COUNTS) + ", classes array<long>, words array<long>, times array<long>"


def features(rows: DataFrame) -> DataFrame:
    """(__row, id, lang, the five counts, classes, words, times, base_failed) of rows (__row, id, lang, text), written to the shared folder."""
    small_batches(rows.sparkSession)
    names = [*COUNTS, "classes", "words", "times"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = pd.DataFrame([measure(t) for t in batch["text"]], columns=names)
            yield pd.concat([batch[[ROW, "id", "lang"]].reset_index(drop=True), got], axis=1)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return materialize(rows.mapInPandas(run, f"{ROW} long, id {rows.schema['id'].dataType.simpleString()}, lang string, {FEATURES}").withColumn("base_failed", failed))


Reference = tuple[np.ndarray, dict[int, int], np.ndarray]


def references(found: DataFrame) -> dict[str, Reference]:
    """By language: character classes; common words by place; their counts, with all other words last.

    "" is the sum over all documents, those without a language included. What
    comes to the driver is COMMON words for each language, whatever the number
    of documents.
    """
    good = found.where("not base_failed").withColumn("lang", F.when(F.col("lang") != "", F.col("lang")))
    sums = [F.sum("n_words").alias("n"), *[F.sum(F.element_at("classes", i + 1)).alias(f"c{i}") for i in range(len(CLASSES))]]
    by_lang = materialize(good.groupBy("lang").agg(*sums))
    everything = by_lang.agg(*[F.sum(c).alias(c) for c in ("n", *[f"c{i}" for i in range(len(CLASSES))])]).where("n > 0").withColumn("lang", F.lit(""))
    totals = by_lang.where("lang is not null and n > 0").unionByName(everything).collect()
    counts = materialize(good.select("lang", F.explode(F.arrays_zip("words", "times")).alias("w")).groupBy("lang", "w.words").agg(F.sum("w.times").alias("n")))
    counts = counts.where("lang is not null").unionByName(counts.groupBy("words").agg(F.sum("n").alias("n")).withColumn("lang", F.lit("")))
    bucket = F.pmod("words", F.lit(BUCKETS))
    for by in (["lang", bucket], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "words"))
        counts = counts.withColumn("rank", rank).where(F.col("rank") <= COMMON)
    common: dict[str, list] = {}
    for x in sorted(counts.collect(), key=lambda x: (x.lang, x.rank)):
        common.setdefault(x.lang, []).append(x)
    out = {}
    for r in totals:
        own = common.get(r.lang, [])
        n = [x.n for x in own]
        out[r.lang] = np.array([r[f"c{i}"] for i in range(len(CLASSES))], float), {x.words: i for i, x in enumerate(own)}, np.array([*n, r.n - sum(n)], float)
    return out


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from the same row of q; 0 if one is empty."""
    n, m = p.sum(axis=1, keepdims=True), q.sum(axis=1, keepdims=True)
    p, q = p / np.maximum(n, 1), q / np.maximum(m, 1)
    middle = (p + q) / 2
    terms = sum(np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(x > 0, middle, 1)), 0).sum(axis=1) for x in (p, q))
    return np.where((n * m)[:, 0] > 0, np.sqrt(np.maximum(terms / 2, 0)), 0.0)


class Judge:
    """All references as matrices: a row for each, its common words by their place in one vocabulary."""

    def __init__(self, refs: dict[str, Reference]):
        self.row = {g: i for i, g in enumerate(refs)}
        self.place: dict[int, int] = {}
        for _, words, _ in refs.values():
            for w in words:
                self.place.setdefault(w, len(self.place))
        nothing = len(self.place)
        self.classes = np.array([r[0] for r in refs.values()]).reshape(len(refs), len(CLASSES))
        self.at = np.full((len(refs), COMMON), nothing)
        self.counts = np.zeros((len(refs), COMMON + 1))
        for i, (_, words, counts) in enumerate(refs.values()):
            self.at[i, : len(words)] = [self.place[w] for w in words]
            self.counts[i, : len(words)], self.counts[i, COMMON] = counts[:-1], counts[-1]

    def of(self, lang: str | None, n_words: int, classes, words, times) -> tuple[float, float, bool]:
        """Distances of character classes and of common words from the document's language, or the nearest if that is too far; whether they pass."""
        own = np.zeros(len(self.place) + 1)
        for w, n in zip(words, times, strict=True):
            if w in self.place:
                own[self.place[w]] += n
        classes = np.asarray(classes, float)
        limits = np.array(limit_of(int(classes.sum()), n_words))

        def to(rows) -> np.ndarray:
            p = own[self.at[rows]]
            p = np.concatenate([p, n_words - p.sum(axis=1, keepdims=True)], axis=1)
            return np.stack([_distances(np.repeat(classes[None], len(p), 0), self.classes[rows]), _distances(p, self.counts[rows])], axis=1)

        if lang in self.row:
            d = to([self.row[lang]])[0]
            if (d <= limits).all():
                return float(d[0]), float(d[1]), True
        every = to(np.arange(len(self.row)))
        d = every[(every - limits).max(axis=1).argmin()]
        return float(d[0]), float(d[1]), bool((d <= limits).all())


def limit_of(chars: int, n_words: int) -> tuple[float, float]:
    """The greatest distances that pass; over 1 below the minimum lengths."""
    return (
        CHARS_LIMIT + CHARS_SPREAD / chars**0.5 if chars >= CHARS_FROM else 2.0,
        WORDS_LIMIT + WORDS_SPREAD / n_words**0.5 if n_words >= WORDS_FROM else 2.0,
    )


def _judge(refs: dict[str, Reference]):
    by = Judge(refs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(*[batch[c] for c in ("lang", "n_words", "base_failed", "classes", "words", "times")], strict=True)
            out = [(0.0, 0.0, not failed) if failed or not refs else by.of(lang, n, *kinds) for lang, n, failed, *kinds in rows]
            got = pd.DataFrame(out, columns=["char_distance", "word_distance", "kept"])
            yield pd.concat([batch[[ROW, "id", *COUNTS, "base_failed"]].reset_index(drop=True), got], axis=1)

    return run


@tidy
def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(__row, id, the five counts, base_failed, char_distance, word_distance, kept) for each row of docs.

    Null texts have no words and fail. A text without a language is compared
    with all references; if no document passes the base rules there is none, and
    the base rules decide. Documents that fail the base rules have distances 0.
    Repeated rows are judged alike, and all count in the references. An empty
    table gives no rows.
    """
    return _judged(with_row(docs, F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")))


def _judged(rows: DataFrame) -> DataFrame:
    found = features(rows)
    out = ", ".join(f"{c} long" for c in COUNTS)
    return found.mapInPandas(_judge(references(found)), f"{ROW} long, id {found.schema['id'].dataType.simpleString()}, {out}, base_failed boolean, char_distance double, word_distance double, kept boolean")


@tidy
def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs without the rows that judge() rejects, all columns as they were."""
    rows = numbered(docs)
    kept = _judged(rows.select(ROW, doc(id_col).alias("id"), doc(lang_col).cast("string").alias("lang"), doc(text_col).alias("text"))).where("kept").select(ROW)
    return rows.join(materialize(kept), ROW, "left_semi").select("__doc.*")
