"""op3, op5, op6, op7 and op10 against brute force, held-out rows and fixed cases."""

import json
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.llm import chat, langid, queries, rules, sitebayes, topk

SF = "/root/testdata/sf0.001"


def _prose(r, stems, n):
    return " ".join(r.choice(stems) for _ in range(n))


def _docs(seed=4):
    r = random.Random(seed)
    stems = {g: ["".join(r.choice(a) for _ in range(r.randint(2, 7))) for _ in range(120)] for g, a in (("xx", "abcdeé"), ("yy", "mnopqu"))}
    rows = [(i, _prose(r, stems[g], r.randint(20, 200)), g) for i in range(200) for g in [r.choice(["xx", "yy"])]]
    return r, stems, rows


def test_language(spark):
    r, stems, rows = _docs()
    rows += [(900, None, "xx"), (901, "123 !!", None), (902, "", "yy"), (903, "a", None), (None, _prose(r, stems["yy"], 90), "xx"), rows[0], (905, _prose(r, stems["xx"], 30000), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    got = [x for x in langid.identify(docs, model).collect()]
    assert len(got) == len(rows)
    by = {x.id: x for x in got}
    assert all(by[i].lang_pred == "und" for i in (900, 901, 902))
    assert by[905].lang_pred == "xx" and by[None].lang_pred == "yy"
    assert all(0 <= x.score <= 1 and x.lang_pred in ("xx", "yy", "und") for x in got)
    held = {x.doc_id for x in docs.where(langid.held_out(docs.doc_id)).collect()}
    assert held and None not in held
    assert np.mean([by[i].lang_pred == g for i, _, g in rows[:200] if i in held]) > 0.95
    # labels and ids don't matter for the prediction, nor does what is held out for the model
    moved = docs.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'zz' else lang end as lang")
    assert (langid.fit(moved).embed == model.embed).all() and (langid.fit(moved).weight == model.weight).all()
    assert langid.identify(docs.limit(0), model).count() == 0
    assert langid.train([]).predict(["abc"]) == [("und", 0.0, True)]


def _plain_grams(text):
    """Every 1-, 2- and 3-gram of the lower-cased text, with a space for all that isn't a letter, hashed one by one."""
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            value = 0
            for c in t[i : i + n]:
                value = value * (1 << 21) + ord(c)
            out[((value + n) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 50] += 1
    return out


def test_language_is_the_plain_model(spark, monkeypatch):
    """Predictions equal a plain average of embeddings and softmax; parts of a long text give the grams of the whole."""
    _, _, rows = _docs()
    rows = rows[:60] + [(900, "ÀÉ ab1c\U00010400\U00010401 \U0001f600 x", "xx"), (901, "a", "rare"), (902, "ß" * 700, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert "rare" in model.languages
    monkeypatch.setattr(langid, "STEP", 13)
    for _, text, _ in rows:
        plain = _plain_grams(text)
        got = langid.grams(text)
        assert {i: int(got[i]) for i in np.flatnonzero(got)} == dict(plain)
        h = sum(n / sum(plain.values()) * model.embed[i].astype(float) for i, n in plain.items())
        z = [float(sum(a * b for a, b in zip(h, w, strict=True)) + c) for w, c in zip(model.weight.T, model.bias, strict=True)]
        e = [math.exp(x - max(z)) for x in z]
        lang, score, rejected = model.predict([text])[0]
        assert lang == model.languages[e.index(max(e))] and score == pytest.approx(max(e) / sum(e), rel=1e-4) and rejected == (score < model.threshold)


def test_language_sample(spark, monkeypatch):
    """Each language has its bounded share, however uneven the languages and however often a row is repeated."""
    rows = [(i, f"word{i} text", "big") for i in range(3000)] + [(5000 + i, f"mot{i}", "small") for i in range(5)] + [(9000, "same", "again")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}
    plain = langid.train
    monkeypatch.setattr(langid, "train", lambda rows: seen.update(Counter(r[0] for r in rows)) or plain(rows))
    langid.fit(docs, per_language=50)
    assert seen["big"] == 50 and 1 <= seen["small"] <= 5 and seen.get("again", 1) == 1


def test_language_on_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, langid.fit(docs)).join(docs.selectExpr("doc_id as id", "lang"), "id").where("crc32(cast(cast(id as string) as binary)) % 4 = 2").collect()
    assert np.mean([x.lang_pred == x.lang for x in got]) > 0.97


def _plain_counts(text):
    w = (text or "").encode().split()
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def _plain_distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b, strict=True) if x)
    m = [(x + y) / 2 for x, y in zip(p, q, strict=True)]
    return math.sqrt((kl(p, m) + kl(q, m)) / 2)


def test_rules(spark):
    r, stems, rows = _docs()
    rows += [(900, None, "xx"), (901, "", None), (902, " \n\n ", "yy"), (903, "a b c " * 40, "xx"), (904, "a\nb\na\n\n \n", None), (905, _prose(r, stems["xx"], 300).upper(), "xx")]
    rows += [(906, " ".join(w + "***" for w in _prose(r, stems["yy"], 200).split()), "yy"), (907, _prose(r, stems["yy"], 300), None), (908, _prose(r, stems["yy"], 300), "xx"), rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = rules.judge(docs).collect()
    key = lambda x: (x[0], str(x))
    assert sorted([(x.id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in got], key=key) == sorted([(i, *_plain_counts(t)) for i, t, _ in rows], key=key)
    by = {x.id: x for x in got}
    assert not any(by[i].kept for i in (900, 901, 902, 903, 905, 906)) and by[907].kept and by[908].kept
    assert all(x.kept == (not x.base_failed) for x in got if x.id < 200)
    refs = rules.references(rules.features(docs.selectExpr("doc_id as __row", "doc_id as id", "lang", "text")))
    good = [t for i, t, g in rows if g == "xx" and not _plain_counts(t)[-1]]
    letters = sum((Counter(t) for t in good), Counter())
    assert refs["xx"][0].sum() == sum(letters.values())
    words = sum((Counter(t.split()) for t in good), Counter())
    common = sorted(words, key=lambda w: (-words[w], rules.word_hash(w.encode())))[: rules.COMMON]
    assert list(refs["xx"][1]) == [rules.word_hash(w.encode()) for w in common]
    text = rows[5][1] if rows[5][2] == "xx" else next(t for _, t, g in rows if g == "xx" and not _plain_counts(t)[-1])
    own = Counter(text.split())
    p = [own[w] for w in common]
    q = [words[w] for w in common]
    want = _plain_distance([*p, len(text.split()) - sum(p)], [*q, sum(words.values()) - sum(q)])
    x = next(x for x in got if x.id == next(i for i, t, _ in rows if t == text))
    assert x.word_distance == pytest.approx(want)
    clash = docs.toDF("__row", "__doc", "id").withColumn("kept", F.lit(1))
    kept = rules.keep(clash, "__row", "__doc", "id")
    assert kept.columns == clash.columns and sorted(str(x[0]) for x in kept.collect()) == sorted(str(x.id) for x in got if x.kept)
    # kept, for every row, from references counted plainly
    base = {i: _plain_counts(t) for i, t, _ in rows}
    langs = sorted({g for i, t, g in rows if g and not base[i][-1]})
    refs = {}
    for lang in [*langs, ""]:
        own = [t for i, t, g in rows if not base[i][-1] and lang in (g, "")]
        words = sum((Counter(t.split()) for t in own), Counter())
        top = sorted(words, key=lambda w: (-words[w], rules.word_hash(w.encode())))[: rules.COMMON]
        refs[lang] = sum((_plain_classes(t) for t in own), Counter()), top, [*[words[w] for w in top], sum(words.values()) - sum(words[w] for w in top)]

    def plain_kept(text):
        own, chars, n = Counter(text.split()), _plain_classes(text), len(text.split())
        limits = rules.limit_of(sum(chars.values()), n)
        found = []
        for classes, top, counts in refs.values():
            p = [own[w] for w in top]
            d = _plain_distance([chars[c] for c in range(7)], [classes[c] for c in range(7)]), _plain_distance([*p, n - sum(p)], counts)
            found.append(all(x <= y for x, y in zip(d, limits, strict=True)))
        return any(found)

    for x in got:
        i, text, lang = next(r for r in rows if r[0] == x.id)
        assert x.kept == (not base[i][-1] and plain_kept(text)), x.id


def _plain_classes(text):
    stops = ".,;:!?'\"()-…«»¿¡’“”„"
    return Counter(3 if c.isspace() else 4 if c in stops else 2 if c.isdigit() else 1 if c.isupper() else 0 if c.isalpha() else 5 if ord(c) < 128 else 6 for c in text)


def test_rules_count_each_document_once(spark):
    """A document without a language counts once in the references of all; long words are words like others."""
    long = "Пожалуйста" * 9
    rows = [(1, " ".join(f"w{i}" for i in range(99)) + " " + long, "xx"), (2, " ".join(f"v{i}" for i in range(100)), None), (3, " ".join(f"u{i}" for i in range(100)), "")]
    refs = rules.references(rules.features(spark.createDataFrame(rows, "__row long, text string, lang string").withColumn("id", F.col("__row"))))
    assert set(refs) == {"xx", ""} and refs[""][2].sum() == 300 and refs["xx"][2].sum() == 100
    assert refs[""][0].sum() == sum(len(t) for _, t, _ in rows)
    assert rules.measure(long)[6:] == ([rules.word_hash(long.encode())], [1])


def test_rules_edges(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert rules.judge(docs).count() == 0
    docs = spark.createDataFrame([(1, "few words", "a"), (2, None, None)], "doc_id long, text string, lang string")
    assert [x.kept for x in rules.judge(docs).collect()] == [False, False]
    assert rules.measure("a b c a b c")[4] == 6 and rules.measure("a a a a")[4] == 4


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "CHUNK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = np.random.default_rng(0)
    x = r.normal(size=(600, 8)) * r.choice([0.1, 1, 3], size=(600, 1))
    x[100:300] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1100, [1.0, None]), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8), (None, [9.0] * 8), (200, x[3].tolist()), (1400, [2.0]), (1500, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    valid = [(i, [math.floor(1024 * e) for e in v] + [0] * (8 - len(v))) for i, v in rows if i is not None and v is not None and all(e is not None and math.isfinite(e) for e in v)]
    want = []
    for n, (i, v) in enumerate(valid):
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, u, strict=True)), j) for m, (j, u) in enumerate(valid) if m != n)[:10]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found)]
    assert sorted(map(tuple, topk.top_k(vectors).collect())) == sorted(want)
    assert topk.top_k(vectors.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(x) for x in topk.top_k(few).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]


def test_top_k_of_huge_components(spark):
    """Products over 2**53 are exact, those over a long are the nearest long; the best match ranks first."""
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.integers(-(1 << 34), 1 << 34, 6) / 1024 + 0.25]) for i in range(60)]
    rows += [(100, [3e6] * 6), (101, [3e6] * 5 + [2.9e6]), (200, [1e200, -1.0]), (201, [1e200]), (202, [-1e200]), (203, [1.7e308]), (300, [0.0] * 6), (400, [5e11] * 6), (401, [5e11, 5e11])]
    valid = [(i, [math.floor(1024.0 * e) if abs(1024.0 * e) < 2**53 else int(min(1024.0 * e, topk.MOST)) for e in v] + [0] * (6 - len(v))) for i, v in rows]
    long = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    want = []
    for i, v in valid:
        if i % 100 == 0:
            found = sorted((-long(sum(a * b for a, b in zip(v, u, strict=True))), j) for j, u in valid if j != i)[:10]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, name):
    got = queries.QUERIES[name](spark, SF)
    db = duckdb.connect()
    for t in ("embeddings", "conversations"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(x) for x in got.select(*columns).collect()))) == sorted(map(str, found.fetchall()))


def test_chat_links(spark):
    call = lambda *c, content=None: json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments"), x, strict=True)) for x in c], "content": content})
    rows = [
        (1, 0, "user", "hi \"there\"\n é \U0001f600"),
        (1, 1, "tool", '{"tool_call_id": "a", "content": "early"}'),
        (1, 2, "assistant", call(("a", "find", {"z": 1, "q": "x"}), ("b", "find", '{"q": "s"}'), content="ok")),
        (1, 3, "tool", '{"tool_call_id": "b", "content": "late"}'),
        (1, 3, "tool", '{"tool_call_id": "none", "content": "lost"}'),
        (1, 4, "assistant", call(("a", "find", {"q": "again"}), ("c", "find", {}), ("d", "find", {"q": 5}), ("e", "find", "not json"), ("f", "none", {}), (None, "find", {"q": "x"}), ("g", "find", [1]), ("h", "find", {"q": "x", "y": 2}))),
        (2, 0, "tool", '{"tool_call_id": "a", "content": "other conversation"}'),
        (2, 1, "assistant", "{broken"),
        (None, None, None, None),
        (2, 1, "assistant", "{broken"),
    ]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.link(chat.parse(t), {"find": {"q": ("string", True), "z": ("integer", False)}}).orderBy("conv_id", "anchor", "step", "turn").collect()
    status = {(x.conv_id, x.turn, x.call_id): x.status for x in got}
    assert status[1, 2, "a"] == "ok" and status[1, 2, "b"] == "ok" and status[1, 1, "a"] == "linked" and status[1, 3, "b"] == "linked"
    assert status[1, 3, "none"] == "orphan" and status[2, 0, "a"] == "orphan" and status[1, 4, "a"] == "duplicate_id"
    assert [status[1, 4, c] for c in ("c", "d", "e", "f", None, "g", "h")] == ["missing:q", "type:q", "bad_json", "unknown_tool", "no_id", "not_an_object", "unknown_argument"]
    order = [(x.kind, x.call_id) for x in got if x.conv_id == 1]
    assert order.index(("call", "a")) < order.index(("result", "a")) and order.index(("call", "b")) < order.index(("result", "b"))
    lines = {(x.turn, x.call_id): x.line for x in got if x.conv_id == 1 and x.kind == "call" and x.turn == 2}
    assert lines[2, "a"] == '{"arguments":{"q":"x","z":1},"call_id":"a","kind":"call","role":"assistant","tool":"find"}'
    assert all(list(json.loads(x.line)) == sorted(json.loads(x.line)) for x in got)
    assert sum(x.conv_id == 2 and x.turn == 1 for x in got) == 2 and sum(x.conv_id is None for x in got) == 1
    assert chat.link(chat.parse(t.limit(0)), {}).count() == 0


def test_chat_order(spark):
    """Chains of references, out of order, crossing, broken and circular: every call comes after the results it refers to."""
    r = random.Random(5)
    calls, refs = {}, {}
    for conv in range(6):
        n = 12
        turn = list(range(n))
        r.shuffle(turn)
        for i in range(n):
            calls[conv, f"c{i}"] = turn[i] // 2  # two calls a turn
            refs[conv, f"c{i}"] = sorted({f"c{r.randrange(i)}" for _ in range(r.randint(0, 2))}) if i else []
    refs[0, "c11"], refs[0, "c10"], refs[0, "c9"] = ["c10"], ["c11"], ["c9"]
    refs[1, "c5"] = ["nowhere", "c0"]
    rows = []
    for (conv, name), turn in calls.items():
        arguments = json.dumps({"q": [{"$ref": x} for x in refs[conv, name]]})
        rows.append((conv, turn, "assistant", json.dumps({"tool_calls": [{"id": name, "name": "f", "arguments": arguments}]})))
        rows.append((conv, r.randint(0, 9), "tool", json.dumps({"tool_call_id": name, "content": "x"})))
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.link(chat.parse(t), {"f": {"q": ("array", True)}}).orderBy("conv_id", "anchor", "step", "turn").collect()
    at = {(x.conv_id, x.kind, x.call_id): (x.anchor, x.step) for x in got}
    info = {(x.conv_id, x.call_id): (x.status, x.depth) for x in got if x.kind == "call"}

    def plain(key, above=()):
        if key in above:
            return None
        found = [plain((key[0], x), (*above, key)) for x in refs[key] if (key[0], x) in calls]
        return None if None in found else max((d + 1 for d in found), default=0)

    for key in calls:
        depth = plain(key)
        assert info[key] == (("cycle", 0) if depth is None else ("unknown_ref" if "nowhere" in refs[key] else "ok", depth)), key
        assert at[key[0], "result", key[1]] == (at[key[0], "call", key[1]][0], at[key[0], "call", key[1]][1] + 1)
        for x in refs[key]:
            if depth is not None and (key[0], x) in calls:
                assert at[key[0], "call", key[1]] > at[key[0], "result", x]
    assert max(d for _, d in info.values()) > 2


def test_site_bayes(spark):
    r = random.Random(8)
    stems = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    docs, labels = [], []
    for i in range(900):
        text, toxic, good = _prose(r, stems, 80).split(), i % 9 == 0, i % 7 != 0
        if toxic:
            text[r.randrange(80)] = "zzslur"
            text[r.randrange(80)] = "zzinsult"
        docs.append((i, (" ".join(text) if good else " ".join(w.upper() + "!!" for w in text)), "hot" if i % 3 else f"s{i % 40}", "p"))
        if i % 2:
            labels.append((i, int(good), int(toxic)))
    docs += [(9000, None, None, None), (9001, "", "hot", None), docs[0], (None, "x y", "hot", "p")]
    labels += [(1, 1, 0), (77777, 1, 1), (None, 1, 0), (3, None, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    b = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sitebayes.classify(d, b).collect()
    assert len(got) == len(docs)
    by = {x.id: x for x in got}
    unseen = [i for i in range(0, 900, 2)]
    assert np.mean([by[i].kept == (i % 7 != 0 and i % 9 != 0) for i in unseen]) > 0.97
    again = sitebayes.classify(d.repartition(5), b).collect()
    assert sorted((x.id or -1, round(x.toxic_score, 9)) for x in got) == sorted((x.id or -1, round(x.toxic_score, 9)) for x in again)
    none = sitebayes.classify(d, b.limit(0)).collect()
    assert all(x.kept and x.quality_score == 0.5 for x in none) and len(none) == len(docs)
    assert sitebayes.classify(d.limit(0), b).count() == 0


def test_shrinkage(spark):
    """A path with few labels stays near its host, one with many goes its own way."""
    rows = [(i, "", "h" if i < 600 else f"g{i % 20}", "a" if i < 300 else "b" if i < 600 else "c") for i in range(1200)] + [(5000, "", "h", "rare")]
    labels = [(i, int(i < 300 or (i >= 600 and i % 20 < 10)), 0) for i in range(1200)] + [(5000, 1, 0)]
    d = spark.createDataFrame(rows, "id long, text string, host string, path string")
    site, _ = sitebayes.sites(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    p = {(x.of, x.at): x.path_quality for x in site.collect()}
    assert p["h", "a"] > 0.95 and p["h", "b"] < 0.05 and 0.3 < p["h", "rare"] < 0.9


def test_posteriors_are_the_plain_ones(spark):
    """Host and path rates against the formulas worked out in plain Python; null sites are sites."""
    r = random.Random(11)
    docs = [(i, "", r.choice(["a", "b", "c", None]), r.choice(["x", "y", None])) for i in range(700)]
    label = {i: (int(r.random() < (0.9 if h == "a" else 0.4)), int(r.random() < (0.5 if p == "y" else 0.1))) for i, _, h, p in docs if r.random() < 0.6}
    d = spark.createDataFrame(docs, "id long, text string, host string, path string")
    got, rates = sitebayes.sites(d, spark.createDataFrame([(i, *v) for i, v in label.items()], "doc_id long, quality int, toxic int"))

    def strength(sites, rate):
        """sites: (n, positives, prior) of each."""
        sites = [s for s in sites if s[0]]
        noise, n = rate * (1 - rate), sum(s[0] for s in sites)
        if len(sites) < 2:
            return sitebayes.STRONG
        spread = sum(s[0] * (s[1] / s[0] - s[2]) ** 2 for s in sites)
        between = (spread - len(sites) * noise) / (n - sum(s[0] ** 2 for s in sites) / n)
        return sitebayes.STRONG if between <= noise / (sitebayes.STRONG + 1) else min(max(noise / between - 1, sitebayes.WEAK), sitebayes.STRONG)

    for k, target in enumerate(sitebayes.TARGETS):
        count = lambda keep, k=k: (sum(keep(x) for x in docs if x[0] in label), sum(label[x[0]][k] for x in docs if x[0] in label and keep(x)))
        n, yes = count(lambda x: True)
        rate = (yes + 1) / (n + 2)
        assert rates[target] == pytest.approx(rate)
        hosts = {h: count(lambda x, h=h: x[2] == h) for h in {x[2] for x in docs}}
        m = strength([(*v, rate) for v in hosts.values()], rate)
        host = {h: (y + m * rate) / (c + m) for h, (c, y) in hosts.items()}
        paths = {(h, p): count(lambda x, h=h, p=p: x[2] == h and x[3] == p) for h, p in {x[2:] for x in docs}}
        m = strength([(*v, host[at[0]]) for at, v in paths.items()], rate)
        want = {at: (y + m * host[at[0]]) / (c + m) for at, (c, y) in paths.items()}
        found = {(x.of, x.at): x[f"path_{target}"] for x in got.collect()}
        assert set(found) == set(want) and all(found[at] == pytest.approx(want[at]) for at in want)


def test_clashing_names(spark):
    """Columns with the names used inside, for the operators that keep or read columns of the caller."""
    r, stems, rows = _docs()
    docs = spark.createDataFrame([(i, t, g, float(i), 0) for i, t, g in rows[:40]], "id long, text string, lang string, score double, place int")
    got = langid.identify(docs, langid.fit(docs, "id"), "id")
    assert got.count() == 40 and got.columns == ["id", "lang_pred", "score", "rejected"]
    vectors = spark.createDataFrame([(0, [1.0, 2.0], 5, "x"), (1, [2.0, 0.5], 6, "y")], "vec_id long, embedding array<double>, score int, `row` string")
    assert [tuple(x) for x in topk.top_k(vectors).collect()] == [(0, 1, 1, 3 * 1024 * 1024)]
    t = spark.createDataFrame([(1, 0, "user", "hi", 9, "z"), (1, 1, "assistant", "yo", 8, "z")], "conv_id long, turn long, role string, text string, anchor int, called string")
    assert {x.status for x in chat.link(chat.parse(t), {}).collect()} == {"ok"}
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    clash = docs.select("id", "text", "lang", docs.score.alias("quality"), docs.place.alias("of"))
    assert sitebayes.classify(clash, labels, "id", "text", "lang", "lang").count() == 40
