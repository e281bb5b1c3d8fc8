"""Quality classifier by hierarchical empirical Bayes.

Evidence from a document: shape measures of its text and the words that tell
labelled classes apart, in a logistic regression fitted on a bounded sample of
labelled rows. Evidence from its site: labelled documents are counted by host
and by path within the host, over all labels; a host's rate is shrunk toward
the global rate and a path's toward its host's, as strongly as the spread
between sites, estimated by moments, asks for. The two are added as log odds,
the site's relative to the global prior, which the regression already holds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches, tidy

#: Labelled documents the regression is fitted on; words it may use; documents a word must be in; its least z-score and log odds ratio.
SAMPLE, WORDS, LEAST, SURE, FAR = 20_000, 4000, 5, 2.5, 1.5
#: Bounds of the strength of shrinkage, in documents.
WEAK, STRONG = 1.0, 1000.0
TARGETS = ("quality", "toxic")
MARKS = b".,;:!?\"'()[]{}*#&$%|<>-"
SHAPES = ("upper", "symbol", "mark", "digit", "line", "long", "length", "kinds")


def shape(raw: bytes, words: list[bytes], kinds: int) -> list[float]:
    """Shares of kinds of bytes and words, and the logarithm of the length."""
    b = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, w = max(1, len(raw)), max(1, len(words))
    count = lambda chars: int(b[list(chars)].sum())
    return [
        count(range(65, 91)) / n, count(b"#*$%&|<>{}[]\\^~_=+") / n, count(b"!?.,;:") / n, count(range(48, 58)) / n,
        (count(b"\n") + 1) / w, sum(len(x) > 20 for x in words) / w, float(np.log1p(w)), kinds / w,
    ]


def words_of(text: str | None) -> tuple[bytes, list[bytes], set[bytes]]:
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    return raw, words, {w.strip(MARKS).lower() for w in set(words)} - {b""}


def signature(text: str | None) -> int:
    """Equal for most near copies: a hash of the three words of a text whose own hashes are smallest."""
    low = sorted(map(xxhash.xxh3_64_intdigest, words_of(text)[2]))[:3]
    return int(np.array(xxhash.xxh3_64_intdigest(repr(low)), np.uint64).view(np.int64))


@dataclass
class Model:
    """words: place of each telling word; odds: its log odds ratio by target; mean, scale, weights: of the regression."""

    words: dict[bytes, int]
    odds: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def evidence(self, text: str | None) -> np.ndarray:
        raw, words, kinds = words_of(text)
        at = [self.words[w] for w in kinds if w in self.words]
        return np.array([*shape(raw, words, len(kinds)), *self.odds[at].sum(axis=0)])

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(x), 1)), z], axis=1) @ self.weights


def _regress(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps; the first column isn't shrunk."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled(labels: DataFrame) -> DataFrame:
    """One row for a document: the worst of its labels; those with a null are left out."""
    return labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """docs: id, text; labels: as labelled() gives them."""
    small_batches(docs.sparkSession)
    some = materialize(labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    found = docs.join(F.broadcast(some), docs["id"] == some["doc_id"]).select("id", "text", "quality", "toxic")  # at most `sample` rows

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(sign=[signature(t) for t in batch["text"]])

    # Of near copies one counts: else the words of a text that is often copied look telling.
    signed = found.mapInPandas(sign, f"id {docs.schema['id'].dataType.simpleString()}, text string, quality int, toxic int, sign long")
    order = Window.partitionBy("sign").orderBy("id", "text")
    texts = materialize(signed.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("text", "quality", "toxic"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: list[Counter] = [Counter(), Counter(), Counter()]
        for batch in batches:
            for text, q, t in zip(batch["text"], batch["quality"], batch["toxic"], strict=True):
                kinds = words_of(text)[2]
                for c, on in zip(sums, (1, q, t), strict=True):
                    if on:
                        c.update(kinds)
        yield pd.DataFrame([(w, n, sums[1][w], sums[2][w]) for w, n in sums[0].items()], columns=["word", "n", "quality", "toxic"])

    counts = materialize(texts.mapInPandas(count, "word binary, n long, quality long, toxic long").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", *TARGETS)]).where(F.col("n") >= LEAST))
    total = texts.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TARGETS]).first()

    def odds(target: str) -> tuple[Column, Column]:
        yes, no = F.col(target), F.col("n") - F.col(target)
        all_yes, all_no = total[target] or 0, total["n"] - (total[target] or 0)
        ratio = F.log((yes + 0.5) / (all_yes + 1.0)) - F.log((no + 0.5) / (all_no + 1.0))
        return ratio, ratio / F.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))

    ratios = {t: odds(t) for t in TARGETS}
    strong = {t: (F.abs(z) >= SURE) & (F.abs(r) >= FAR) for t, (r, z) in ratios.items()}
    telling = counts.select("word", *[F.when(strong[t], r).otherwise(0.0).alias(t) for t, (r, _) in ratios.items()], F.greatest(*[F.when(strong[t], F.abs(z)).otherwise(0.0) for t, (_, z) in ratios.items()]).alias("z"))
    chosen = telling.where(F.col("z") >= SURE).orderBy(F.desc("z"), "word").limit(WORDS).collect()
    width = len(SHAPES) + len(TARGETS)
    model = Model({bytes(r.word): i for i, r in enumerate(chosen)}, np.array([[r.quality, r.toxic] for r in chosen]).reshape(-1, 2), np.zeros(width), np.ones(width), np.zeros((width + 1, 2)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[list(TARGETS)].assign(x=[model.evidence(t).tolist() for t in batch["text"]])

    got = texts.mapInPandas(measure, "quality int, toxic int, x array<double>").toPandas()
    if len(got):
        x = np.array(got["x"].tolist())
        order = np.lexsort(x.T)
        x, got = x[order], got.iloc[order]
        model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.concatenate([np.ones((len(x), 1)), np.clip((x - model.mean) / model.scale, -8, 8)], axis=1)
        model.weights = np.stack([_regress(z, got[t].to_numpy(float)) for t in TARGETS], axis=1)
    return model


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, target: str, rate: float, prior: Column) -> float:
    """Documents that the prior counts for: from how much the sites' rates spread beyond chance."""
    r = sites.where("n > 0").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(F.col(target) / F.col("n") - prior, 2)).alias("spread"), F.count("*").alias("sites"), F.sum(F.col("n") * F.col("n")).alias("n2")
    ).first()
    noise = rate * (1 - rate)
    if not r["sites"] or r["sites"] < 2 or noise <= 0:
        return STRONG
    between = (r["spread"] - r["sites"] * noise) / max(1e-9, r["n"] - r["n2"] / r["n"])
    return STRONG if between <= noise / (STRONG + 1) else float(np.clip(noise / between - 1, WEAK, STRONG))


def sites(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(host, path, n, and for each target its posterior rate): all paths with a document; and the global rates."""
    known = docs.select("id", "host", "path").join(labels, docs["id"] == labels["doc_id"], "left")
    by_path = materialize(known.groupBy("host", "path").agg(F.count("quality").alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TARGETS]))
    by_host = materialize(by_path.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", *TARGETS)]).select(F.col("host").alias("of"), F.col("n").alias("host_n"), *[F.col(t).alias(f"host_{t}") for t in TARGETS]))
    total = by_host.agg(F.coalesce(F.sum("host_n"), F.lit(0)).alias("n"), *[F.coalesce(F.sum(f"host_{t}"), F.lit(0)).alias(t) for t in TARGETS]).first()
    rates = {t: (total[t] + 1) / (total["n"] + 2) for t in TARGETS}
    hosts = by_host.select(F.col("host_n").alias("n"), *[F.col(f"host_{t}").alias(t) for t in TARGETS])
    out = by_path.join(by_host, F.col("host").eqNullSafe(F.col("of")))
    for t in TARGETS:
        m = _strength(hosts, t, rates[t], F.lit(rates[t]))
        out = out.withColumn(f"host_{t}", (F.col(f"host_{t}") + m * rates[t]) / (F.col("host_n") + m))
        m = _strength(out, t, rates[t], F.col(f"host_{t}"))
        out = out.withColumn(f"path_{t}", (F.col(t) + m * F.col(f"host_{t}")) / (F.col("n") + m))
    return out.select(F.col("host").alias("of"), F.col("path").alias("at"), "n", *[f"path_{t}" for t in TARGETS]), rates


@tidy
def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """(id, quality_score, toxic_score, kept) for each row of docs; labels: doc_id, quality, toxic.

    kept: more likely good than not, and not more likely toxic than not. Null
    hosts and paths are sites like others; a null or empty text gives what an
    empty text's shape says; labels of unknown documents count for nothing.
    Without any label all scores are one half and all rows are kept. Repeated
    rows are scored alike. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text"))
    labels = materialize(labelled(labels))
    model = fit(rows, labels, sample)
    site, rates = sites(rows, labels)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = model.logits(np.array([model.evidence(t) for t in batch["text"]]).reshape(len(batch), -1))
            yield batch[["id", "host", "path"]].assign(quality=z[:, 0], toxic=z[:, 1])

    scored = rows.mapInPandas(score, f"id {rows.schema['id'].dataType.simpleString()}, host string, path string, quality double, toxic double")
    joined = scored.join(materialize(site), F.col("host").eqNullSafe(F.col("of")) & F.col("path").eqNullSafe(F.col("at")))
    chance = lambda t: 1 / (1 + F.exp(-(F.col(t) + _logit(F.col(f"path_{t}")) - _logit(F.lit(rates[t])))))
    out = joined.select("id", chance("quality").alias("quality_score"), chance("toxic").alias("toxic_score"))
    return out.withColumn("kept", (F.col("quality_score") >= 0.5) & (F.col("toxic_score") <= 0.5))
