"""Scans that split the input otherwise, as when executors come or go, change no result."""

import random
import sys
from itertools import cycle
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from lamella.llm import common, debruijn, langid, mixing, rules, simhash, similar, suffixes  # noqa: E402

OPERATORS = {
    "keep": (rules, lambda d: rules.keep(d)),
    "near_duplicates": (simhash, lambda d: simhash.near_duplicates(d).select("doc_id", "fp", "component_id")),
    "keep_first": (simhash, lambda d: simhash.keep_first(d)),
    "similar": (similar, lambda d: similar.keep_first(d)),
    "clean": (debruijn, lambda d: debruijn.clean(d)),
    "dedup_bytes": (suffixes, lambda d: suffixes.dedup_bytes(d).drop("__row")),
    "identify": (langid, lambda d: langid.identify(d, langid.fit(d))),
    "mixed": (mixing, lambda d: mixing.mixed(d)),
}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    r = random.Random(2)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(300)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(55, 120))) for _ in range(120)]
    texts += texts[:30] + [texts[40] + " " + texts[41] for _ in range(3)]
    rows = [(i, t, "ab"[i % 2], f"s{i % 3}") for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("rows") / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(40).write.parquet(path)
    return path


@pytest.mark.parametrize("name", OPERATORS)
def test_scans_that_differ(spark, docs, monkeypatch, name):
    module, run = OPERATORS[name]
    key, before = "spark.sql.leafNodeDefaultParallelism", spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    show = lambda df: sorted(map(str, df.collect()))
    want = show(run(spark.read.parquet(docs)))
    cores, plain = cycle((24, 1, 8, 3)), common.materialize

    def moved(df):
        out = plain(df)
        spark.conf.set(key, next(cores))
        return out

    for m in {module, common}:
        monkeypatch.setattr(m, "materialize", moved)
    try:
        spark.conf.set(key, 24)
        assert show(run(spark.read.parquet(docs))) == want
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
