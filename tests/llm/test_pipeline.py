"""The pipeline against a plain version of its stages, on a small table with planted cases."""

import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus_pipeline  # noqa: E402
from test_similar import _groups  # noqa: E402
from test_windows import _removed  # noqa: E402

from lamella.llm import mixing, packing, rules  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _table(spark, folder):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghé") for _ in range(r.randint(2, 8))) for _ in range(600)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = say(55)
    texts = [say(r.randint(60, 400)) for _ in range(90)]
    texts += [f"{say(60)} {passage}\n{say(80)}" for _ in range(6)]
    texts += [texts[0], texts[0], texts[1] + "!", say(20), "### $$$ " * 90, say(200).upper(), None, "", say(3000)]
    rows = [(i, t, "xx", f"s{i % 4}" if i % 3 else "hot", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, COLUMNS)
    docs.write.parquet(f"{folder}/documents.parquet")
    return rows


def test_pipeline(spark, tmp_path):
    rows = _table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    kept = {x.id for x in rules.judge(docs).where("kept").collect()}
    assert {90, 91, 0, 1} <= kept and not {99, 100, 101, 102, 103} & kept
    rows = [x for x in rows if x[0] in kept]
    first = {}
    for x, root in zip(rows, _groups([x[:2] for x in rows]), strict=True):
        first[root] = min(first.get(root, x), x)
    rows = sorted(first.values())
    assert not {96, 97, 98} & {x[0] for x in rows}  # two copies and a near copy
    units = [t.encode().split() for _, t, *_ in rows]
    cleaned = []
    for (i, t, g, s, n), u in zip(rows, units, strict=True):
        drop = _removed(u, 35, units)
        new = b" ".join(w for w, d in zip(u, drop, strict=True) if not d).decode() if any(drop) else t
        cleaned.append((i, new, g, s, len(new) if any(drop) else n))
    assert sum(a != b for a, b in zip(rows, cleaned, strict=True)) >= 6
    plain = spark.createDataFrame(cleaned, COLUMNS)
    times = {x.id: x.times for x in mixing.mix(plain).collect()}
    assert any(t > 1 for t in times.values())
    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for i, t, *_ in cleaned:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += times[i]

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == +want
    bins = defaultdict(list)
    for x in got:
        bins[x.sequence_id].append((x.offset, x.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024


def test_stages_keep_columns_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], COLUMNS + ", __row string, spare double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).schema.names == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0
