"""op1, op4 and op8 against brute force on small tables with planted copies."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from lamella.llm import debruijn, simhash, suffixes


def _corpus(seed=3):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = say(60)
    docs = [say(r.randint(0, 160)) for _ in range(40)]
    docs += [say(r.randint(0, 50)) + " " + shared + " " + say(r.randint(0, 50)) for _ in range(12)]
    base = say(150)
    for _ in range(12):
        w = base.split()
        w[r.randrange(150)] = r.choice(words)
        docs.append("  ".join(w) if r.random() < 0.2 else " ".join(w))
    docs += [base, base, "ab " * 200, "x" * 450, "", None, " \n\t ", "A b", "one", shared + " " + shared]
    rows = [(i, t, "s") for i, t in enumerate(docs)]
    return rows + [rows[3], (None, docs[5], None)]


def _removed(units, window, all_units):
    where = Counter(tuple(u[i : i + window]) for u in all_units for i in range(len(u) - window + 1))
    drop = [False] * len(units)
    for i in range(len(units) - window + 1):
        if where[tuple(units[i : i + window])] > 1:
            drop[i : i + window] = [True] * window
    return drop


@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_repeated_windows(spark, kind):
    rows = _corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string")
    cut = (lambda t: (t or "").encode().split()) if kind == "words" else (lambda t: list((t or "").encode()))
    window = 35 if kind == "words" else 200
    units = [cut(t) for _, t, _ in rows]
    want = []
    for (i, _, _), u in zip(rows, units, strict=True):
        drop = _removed(u, window, units)
        kept = [x for x, d in zip(u, drop, strict=True) if not d]
        spans = sum(d and not p for d, p in zip(drop, [False, *drop], strict=False))
        want.append((i, len(u), sum(drop), spans, hashlib.sha256(b" ".join(kept) if kind == "words" else bytes(kept)).hexdigest()))
    f = debruijn.dedup_words if kind == "words" else suffixes.dedup_bytes
    got = [(r.id, r.n_units, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in f(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 500


def test_long_documents_in_steps(monkeypatch):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    text = [r.choice(words) for _ in range(3000)]
    text[2500:2600] = text[100:200]
    raw = " ".join(text).encode()
    pick = lambda: {w: int(a) for lo, hi, anchor in suffixes.runs_of(raw, suffixes.Depth(), 32) for x, y, a in zip(lo, hi, anchor, strict=True) for w in range(x, y + 1)}
    whole = pick()
    assert sorted(whole) == list(range(len(raw) - 199))
    monkeypatch.setattr(suffixes, "STEP", 257)
    assert pick() == whole


@pytest.mark.parametrize(("chunk", "bucket"), [(400, 1 << 21), (1500, 40), (1 << 21, 64), (1, 1 << 21)])
def test_chunks_and_buckets(spark, monkeypatch, chunk, bucket):
    """Many small chunks, texts longer than a chunk, and many tasks for the hashes give the same."""
    docs = spark.createDataFrame(_corpus(), "doc_id long, text string, s string")
    show = lambda: sorted(str((x.id, x.n_units, x.n_removed, x.spans, x.kept)) for x in debruijn.dedup_words(docs).collect())
    want = show()
    monkeypatch.setattr(debruijn, "CHUNK", chunk)
    monkeypatch.setattr(debruijn, "BUCKET", bucket)
    assert show() == want


def test_codes_of_keys():
    r = np.random.default_rng(1)
    for high in (1, 200, 1 << 20, 1 << 45, (1 << 64) - 1):
        keys = np.sort(r.integers(0, high, 300, np.uint64, endpoint=True))
        assert (debruijn.decode(debruijn.encode(keys)) == keys).all()
    assert len(debruijn.decode(debruijn.encode(keys[:0]))) == 0


def test_hashes_that_meet_are_found(spark):
    """Pieces of one name with other words are an error, wherever they are."""
    columns = "node array<long>, edge array<long>, length array<long>, high array<long>, low array<long>"
    debruijn.verify(spark.createDataFrame([([1, 2], [3, 3], [4, 4], [5, 6], [7, 7]), ([1], [3], [4], [5], [7])], columns))
    with pytest.raises(RuntimeError):
        debruijn.verify(spark.createDataFrame([([1, 2], [3, 3], [4, 4], [5, 6], [7, 7]), ([1], [3], [4], [5], [8])], columns))


def test_paths_branch_nowhere_inside(spark):
    """Degrees of the repeated graph against a plain count: pieces end at every node with two repeated edges in or out."""
    r = random.Random(8)
    a, b, c, d = ([f"{k}{i}" for i in range(60)] for k in "abcd")
    texts = [a + b, a + b, a + c, a + c, d + b[20:], d + b[20:], b[5:50]]
    r.shuffle(texts)
    docs = spark.createDataFrame([(i, i, " ".join(t)) for i, t in enumerate(texts)], "__row long, id long, text string")
    found = debruijn._compacted(docs.withColumn("id", docs["id"].cast("string")), 35, 7).collect()
    edges = Counter(tuple(t[i : i + 35]) for t in texts for i in range(len(t) - 34))
    repeated = [e for e, n in edges.items() if n > 1]
    out, into = Counter(e[:-1] for e in repeated), Counter(e[1:] for e in repeated)
    branching = {n for n in [*out, *into] if out[n] > 1 or into[n] > 1}
    assert branching
    by_row = {x["__row"]: x for x in found}
    for row, t in enumerate(texts):
        x, flags = by_row[row], [edges[tuple(t[i : i + 35])] > 1 for i in range(len(t) - 34)]
        place = 0
        starts = [i for i, f in enumerate(flags) if f and not (i and flags[i - 1])]
        cut = {i for i in range(1, len(flags)) if flags[i] and flags[i - 1] and tuple(t[i : i + 34]) in branching}
        got = []
        for n in x.length:
            place = next(i for i in range(place, len(flags)) if flags[i])
            got.append(place)
            place += n
        assert sum(x.length) == sum(flags) and set(starts) | cut <= set(got)


def _fingerprint(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(prints):
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def test_simhash(spark):
    rows = _corpus()
    prints = [_fingerprint(t) for _, t, _ in rows]
    roots = _components(prints)
    least = {}
    for (i, _, _), r in zip(rows, roots, strict=True):
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (least.get(r), i) != (None, None) else None
    want = [(i, f"{p:016x}", least[r]) for (i, _, _), p, r in zip(rows, prints, roots, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({w[2] for w in want}) < len(want) - 5
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots))


def test_links_in_long_lists(spark, monkeypatch):
    """A dense cluster: the two ways give the same components, with any list length."""
    r = random.Random(1)
    base = r.getrandbits(64)
    prints = list({base ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 3))) & (1 << 64) - 1 for _ in range(300)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    want = Counter(Counter(_components(prints)).values())
    for length in (1, 32, 10**6):
        monkeypatch.setattr(simhash, "LONG_LIST", length)
        classes = spark.createDataFrame(signed, "fp long")
        roots = dict(simhash.components(simhash.links(classes)).collect())
        assert Counter(Counter(roots.get(s[0], s[0]) for s in signed).values()) == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert suffixes.dedup_bytes(docs).count() == 0
    assert debruijn.clean(docs).count() == 0


def test_clean_keeps_columns(spark):
    rows = _corpus()
    docs = spark.createDataFrame([(i, t, len(t or ""), "k") for i, t, _ in rows], "doc_id long, text string, n_chars int, __kept string")
    out = debruijn.clean(docs)
    assert out.schema.fieldNames() == docs.schema.fieldNames()
    assert out.count() == docs.count()


def test_hot_anchors(spark, monkeypatch):
    """With no anchor gathered, the counts of single suffixes give the same; so do runs sorted a few at a time."""
    docs = spark.createDataFrame(_corpus()[:-1], "doc_id long, text string, s string")
    want = sorted(map(str, suffixes.dedup_bytes(docs).collect()))
    for name, value in (("GATHER", 1), ("SORTED", 1)):
        with monkeypatch.context() as m:
            m.setattr(suffixes, name, value)
            assert sorted(map(str, suffixes.dedup_bytes(docs).collect())) == want


@pytest.mark.parametrize("clash", [False, True])
def test_radix_sort(monkeypatch, clash):
    """Repeated suffixes against a plain count, also if all hashes meet."""
    r = random.Random(3)
    base = bytes(r.choice(b"ab") for _ in range(60))
    raws = [base[r.randrange(20) : 60 - r.randrange(10)] + bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(30)]
    raws = [x + b"b" * max(0, 25 - len(x)) for x in raws]
    anchors, times = np.array([i % 3 for i in range(30)], np.int64), np.array([1 + (i % 11 == 0) for i in range(30)])
    if clash:
        monkeypatch.setattr(suffixes, "mix", lambda x: x * np.uint64(0))
    total = Counter()
    for a, x, n in zip(anchors, raws, times, strict=True):
        for i in range(len(x) - 24):
            total[int(a), x[i : i + 25]] += int(n)
    want = {(k, i) for k, x in enumerate(raws) for i in range(len(x) - 24) if total[int(anchors[k]), x[i : i + 25]] > 1}
    run, place = suffixes.repeated_suffixes(anchors, raws, times, 25)
    assert set(zip(run.tolist(), place.tolist(), strict=True)) == want and want
