"""The near-dedup stage of the pipeline against all pairs, with planted near copies."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus_pipeline  # noqa: E402

from lamella.llm import jaccard, similar  # noqa: E402


def _rows():
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghé") for _ in range(r.randint(2, 8))) for _ in range(500)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    texts = [say(r.randint(50, 200)) for _ in range(20)]
    for n, edits, copies in ((60, 1, 6), (150, 2, 12), (300, 7, 12), (300, 14, 12)):
        base = say(n)
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(n)] = r.choice(words)
            texts.append(w[: n - r.randint(0, n // 20)])
    line = say(30)
    texts += [say(40) + line for _ in range(8)] + [line + say(k) for k in range(6)]
    texts = [" ".join(t) for t in texts] + [texts[0][0], "", None, " ".join(texts[0]).upper(), "a b c"]
    return [(i * 7 % len(texts), t) for i, t in enumerate(texts)]


def _groups(rows):
    def grams(t):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [grams(t) for _, t in rows]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both * 9 >= 4 * (len(sets[i]) + len(sets[j])):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    return root


@pytest.mark.parametrize("sizes", [{}, {"ROUNDS": 0}, {"HUBS": 1, "ROUNDS": 1}, {"CHUNK": 300, "BUCKET": 100}])
def test_near_copies_go(spark, monkeypatch, tmp_path, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(similar if hasattr(similar, name) else jaccard, name, value)
    rows = _rows()
    least = {}
    for (i, _), g in zip(rows, _groups(rows), strict=True):
        least[g] = min(least.get(g, i), i)
    assert 20 < len(least) < len(rows) - 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert sorted(x.doc_id for x in got.collect()) == sorted(least.values())


def test_edges(spark):
    """Null and repeated ids, repeated rows, null and blank texts, columns with the names used inside."""
    rows = [(3, "a b", 1), (None, "A  b", 2), (3, "a b", 1), (5, None, 3), (4, " \n", 4), (7, "a b c d e f", 5), (None, "x y z", 6), (None, "x y z", 7)]
    docs = spark.createDataFrame(rows, "root long, tokens string, __row int")
    got = similar.keep_first(docs, "root", "tokens")
    assert got.columns == docs.columns
    found = sorted(((x.root, x.tokens, x["__row"]) for x in got.collect()), key=str)
    assert found == sorted([(3, "a b", 1), (4, " \n", 4), (7, "a b c d e f", 5), next(x for x in found if x[0] is None)], key=str)
    assert similar.keep_first(docs.limit(0), "root", "tokens").count() == 0
