"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the bag of its character 1-, 2- and 3-grams (lower case, everything
but letters as a space), hashed to ``BINS``. The model averages the embeddings
of the grams and applies a linear softmax; it is trained by stochastic gradient
descent in numpy on a bounded sample of labelled rows, in which every language
has a row. Sample rows that are held back calibrate it: a temperature is fitted
on every second of them, and on the others the threshold under which a
prediction is flagged as not to be trusted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches

BINS, DIM, ORDERS = 1 << 14, 16, (1, 2, 3)
#: Bounds of the training sample: rows for one language, and rows in all, but one for each language at least.
PER_LANGUAGE, MOST_ROWS = 300, 4000
#: Rows drawn by hash for each that is wanted, before the wanted ones are ranked.
DRAWN = 3
EPOCHS, BATCH, RATE, SEED = 30, 16, 8.0, 17
#: Share of errors wanted among predictions that are not rejected.
ERRORS = 0.005
STEP = 1 << 18
UNKNOWN = "und"

_LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])


def _letters(points: np.ndarray) -> np.ndarray:
    high = points >> 16 != 0
    letter = _LETTER[np.where(high, 0, points)]
    if high.any():
        letter = letter & ~high
        letter[high] = [chr(p).isalpha() for p in points[high]]
    return letter


def grams(text: str | None) -> np.ndarray | None:
    """Histogram of a text's hashed grams; None if it has no letter. A long text goes by in parts of STEP characters."""
    if not text:
        return None
    out, found, before = np.zeros(BINS, np.int64), False, np.zeros(0, np.uint64)
    text = text.lower()
    for at in range(0, len(text), STEP):
        points = np.frombuffer(text[at : at + STEP].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(points)
        found = found or bool(letter.any())
        points = np.concatenate([before, np.where(letter, points, 32).astype(np.uint64)])
        old = len(before)  # characters of the part before, so that grams across the cut count once
        value = np.zeros(len(points), np.uint64)
        for n in range(1, ORDERS[-1] + 1):
            value = value[: len(points) - n + 1] * np.uint64(1 << 21) + points[n - 1 :]
            own = value[max(0, old - n + 1) :]
            if n in ORDERS and len(own):
                mixed = (own + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                out += np.bincount((mixed >> np.uint64(50)).astype(np.int64), minlength=BINS)
        before = points[len(points) - ORDERS[-1] + 1 :] if len(points) >= ORDERS[-1] - 1 else points
    return out if found else None


@dataclass
class Model:
    """languages; embed: BINS x DIM; weight, bias: DIM x languages, over the temperature; threshold of the score."""

    languages: list[str]
    embed: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    threshold: float

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, calibrated probability, and whether it is rejected, of each text."""
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        at, rows = [], []
        for i, text in enumerate(texts if self.languages else []):
            found = grams(text)
            if found is not None:
                bins = np.flatnonzero(found)
                at.append(i)
                rows.append((found[bins] / found.sum()).astype(np.float32) @ self.embed[bins])
        if at:
            p = _softmax((np.stack(rows) @ self.weight + self.bias).astype(np.float64))
            best = p.argmax(axis=1)
            for i, k, score in zip(at, best.tolist(), p[np.arange(len(at)), best].tolist(), strict=True):
                out[i] = self.languages[k], score, score < self.threshold
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """A model from (language, bins, counts); the rows' order doesn't matter."""
    rows = sorted(rows, key=lambda r: (r[0], r[1].tolist(), r[2].tolist()))
    languages = sorted({r[0] for r in rows})
    if not rows:
        return Model([], np.zeros((BINS, DIM), np.float32), np.zeros((DIM, 0), np.float32), np.zeros(0), 1.0)
    random = np.random.default_rng(SEED)
    y = np.array([languages.index(r[0]) for r in rows])
    order = random.permutation(len(rows))
    # A fifth is held back, of languages with five rows or more.
    able = np.bincount(y)[y[order]] >= 5
    held = order[able][: len(rows) // 5]
    learn = np.setdiff1d(order, held)
    embed = random.normal(0, 0.1, (BINS, DIM)).astype(np.float32)
    weight = random.normal(0, 0.3, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)

    def dense(at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), BINS), np.float32)
        for i, k in enumerate(at):
            out[i, rows[k][1]] = rows[k][2] / rows[k][2].sum()
        return out

    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        random.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            own = learn[at : at + BATCH]
            x = dense(own)
            h = x @ embed
            p = _softmax(h @ weight + bias)
            p[np.arange(len(own)), y[own]] -= 1
            p /= len(own)
            back = p @ weight.T
            weight -= 0.1 * rate * (h.T @ p)
            bias -= 0.01 * rate * p.sum(axis=0)
            used = np.flatnonzero(x.any(axis=0))
            embed[used] -= rate * 10 * (x[:, used].T @ back)
    z = np.concatenate([dense(held[i : i + 200]) @ embed for i in range(0, len(held), 200)]) @ weight + bias if len(held) else np.zeros((0, len(languages)))
    heat, threshold = 1.0, 0.0
    if len(held) > 1:
        target = y[held]
        for_heat, for_threshold = slice(0, None, 2), slice(1, None, 2)
        loss = lambda t: -np.log(np.maximum(_softmax(z[for_heat] / t)[np.arange(len(z[for_heat])), target[for_heat]], 1e-12)).mean()
        heat = min((float(t) for t in np.geomspace(0.25, 8, 41)), key=loss)
        p = _softmax(z[for_threshold] / heat)
        sure, right = p.max(axis=1), p.argmax(axis=1) == target[for_threshold]
        down = np.argsort(-sure, kind="stable")
        wrong = np.cumsum(~right[down]) / np.arange(1, len(down) + 1)
        fine = np.flatnonzero(wrong <= ERRORS)
        threshold = float(sure[down][fine[-1]]) if len(fine) and fine[-1] + 1 < len(down) else 0.5 if len(fine) else 1.0
    return Model(languages, embed, (weight / heat).astype(np.float32), (bias / heat).astype(np.float32), threshold)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model:
    """Learn from labelled rows that are not held out, chosen by a hash of id and text.

    At most per_language rows of a language, and most_rows in all but one for
    each language, so that any language with a row can be predicted. Each
    language's share is drawn by its number of rows before it is ranked, so no
    task ranks all rows of a language; if fewer are drawn than wanted (very
    uneven hashes), fewer are learned from. Of repeated rows one counts.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    able = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    counts = able.groupBy("lang").agg(F.count("*").alias("n"))
    languages = counts.count()
    each = max(1, min(per_language, most_rows // max(1, languages)))
    # A language whose drawn rows could well be too few is taken whole, and that is a small one.
    share = F.least(F.lit(1.0), (DRAWN * each + 64) / F.col("n"))
    cuts = materialize(counts.select("lang", (share * (1 << 52)).cast("long").alias("cut")))
    place = F.xxhash64("id", "text")
    drawn = able.join(cuts, "lang").where(F.shiftrightunsigned(place, 12) <= F.col("cut")).groupBy("lang", place.alias("place")).agg(F.min("text").alias("text"))
    chosen = Window.partitionBy("lang").orderBy("place")
    sample = drawn.withColumn("rank", F.row_number().over(chosen)).where(F.col("rank") <= each)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(g, x) for g, x in zip(batch["lang"], map(grams, batch["text"]), strict=True) if x is not None]
            yield pd.DataFrame([(g, (at := np.flatnonzero(x)).tolist(), x[at].tolist()) for g, x in found], columns=["lang", "bins", "counts"])

    got = sample.select("lang", "text").mapInPandas(count, "lang string, bins array<int>, counts array<long>").toPandas()
    return train([(g, np.asarray(b, np.int64), np.asarray(c, np.float32)) for g, b, c in zip(got["lang"], got["bins"], got["counts"], strict=True)])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for each row of docs, from its whole text alone.

    A null text, or one without a letter, gives "und", score 0, rejected.
    Repeated rows come back repeated; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = pd.DataFrame(model.predict(batch["text"].tolist()), columns=["lang_pred", "score", "rejected"])
            yield pd.concat([batch[["id"]].reset_index(drop=True), got], axis=1)

    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
