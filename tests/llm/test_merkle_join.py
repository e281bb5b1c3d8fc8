"""op11 and op12 against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lamella.llm import jaccard, merkle
from lamella.llm.queries import op12_ngram_join

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string, idx int, grp string"


def _h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _leaf(row, text):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def _path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 8 * 8
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 8])))
        i //= 8
    return out


def _manifest(rows):
    """(id, leaf, subroot, root, siblings, root of the altered row) of each row, sorted."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, _leaf(r, r[4]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    upper = _levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = _path(trees[g], i) + _path(upper, k)
            altered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = _leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])) if altered else leaf
            for a, b in path:
                node = _h(a, node, b)
            out.append((r[0] if r[0] is not None else -1, leaf, trees[g][-1][0], upper[-1][0], _h(*[a + b for a, b in path]), node))
    return sorted(out)


def _rows(n, langs, seed=1):
    r = random.Random(seed)
    rows = [(i * 5 % n, r.choice(["s", None, ""]), r.choice(langs), r.choice([None, 7]), r.choice([None, "", "Ä big A", "b" * 3000, f"T{i}"])) for i in range(n)]
    return [(*x, "clash", 3, "g") for x in rows]


CASES = {
    "empty": [],
    "one": _rows(1, ["en"]),
    "eight": _rows(8, ["en"]),
    "nine and alone": _rows(9, ["en"]) + _rows(1, ["de"]),
    "two groups": _rows(70, ["en", None]),
    "many groups": _rows(60, [None, "", *[f"l{i}" for i in range(20)], "é", "z"]),
    "hot group": _rows(600, ["en"] * 30 + ["de", "fr"]),
    "repeats": _rows(20, ["en", "de"]) * 3 + [(None, "s", "en", 1, "A", "", 0, "")] * 2,
}


@pytest.mark.parametrize("name", CASES)
def test_manifest(spark, name):
    rows = CASES[name]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    altered = merkle.leaf(*[merkle.lowered(F.col(c)) if c == "text" else F.col(c) for c in merkle.COLUMNS])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = merkle.manifest(docs, altered=F.when(chosen, altered))
    got = found.select(F.coalesce("id", F.lit(-1)), "leaf", "subroot", "root", merkle.proof(F.col("path")), merkle.fold(F.coalesce("altered", "leaf"), F.col("path")))
    assert sorted(map(tuple, got.collect())) == _manifest(rows)


def test_a_change_is_found(spark):
    rows = _rows(90, ["en", "de"])
    root = lambda rows: {x.root for x in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).select("root").collect()}
    first = root(rows)
    assert len(first) == 1 and root(rows[::-1]) == first
    assert root([(*rows[0][:4], "other", *rows[0][5:]), *rows[1:]]) != first
    assert root(rows[1:]) != first


def _words(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()


def _linked(rows):
    """(id, set size, component) of each row by all pairs."""

    def grams(text):
        w = _words(text)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    least = {}
    for (i, _), g in zip(rows, root, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, len(s), least.get(g)) for (i, _), s, g in zip(rows, sets, root, strict=True)]


def _texts():
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghé") for _ in range(r.randint(2, 8))) for _ in range(400)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    texts = [say(r.randint(20, 120)) for _ in range(15)]
    for n, edits, copies in ((30, 1, 8), (60, 2, 10), (150, 3, 15), (300, 7, 15), (300, 13, 15), (9, 1, 5), (6, 0, 4)):
        base = say(n)
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(n)] = r.choice(words)
            texts.append(w[: n - r.randint(0, n // 12)])
    # A chain: neighbours are similar, its ends aren't.
    long = say(260)
    texts += [long[i : i + 200] for i in range(0, 61, 12)]
    line = say(30)
    texts += [say(k) + line for k in (2, 3, 4, 40, 50)] + [line * 2, line * 3, line]
    out = [" ".join(t) for t in texts]
    out += ["", None, " \t\n", "one", "ONE", "a b c d", "a b c d e", "a  B\tc d", "É one", "é one", out[20].upper(), out[20], "x " * 5000]
    return [(None if i == 30 else i * 7 % len(out), t) for i, t in enumerate(out)]


def _key(x):
    return tuple((v is None, v or 0) for v in x)


@pytest.mark.parametrize("sizes", [{}, {"ROUNDS": 0}, {"HUBS": 1, "ROUNDS": 1, "STEP": 50}])
@pytest.mark.parametrize("chunk", [{}, {"chunk": 500, "bucket": 100}])
def test_join(spark, monkeypatch, sizes, chunk):
    for name, value in sizes.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = _texts()
    want = _linked(rows)
    assert 30 < len({c for _, _, c in want}) < len(rows) - 30
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n string, key int").repartition(3)
    got = jaccard.near_sets(docs, **chunk).select("id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=_key) == sorted(want, key=_key)


def test_join_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_sets(docs).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.near_sets(blank).drop("__row").collect())) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    """Of a list of n members no n * n pairs are verified."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    base = [r.choice(words) for _ in range(200)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(2):
            w[r.randrange(200)] = r.choice(words)
        rows.append((i, " ".join(w)))
    counted, verify = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, sets: counted.append(pairs.count()) or verify(pairs, sets))
    got = jaccard.near_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x.component_id for x in got.collect()} == {0}
    assert sum(counted) < 10 * len(rows)


def test_query_on_documents(spark):
    """The registered query against all pairs that share a shingle, on the whole smallest table."""
    sf = "/root/testdata/sf0.001"
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op12_ngram_join(spark, sf).collect())) == sorted(_linked(rows))
