"""The two jobs: growing input, failures, reruns, and plain versions of what they compute."""

import random
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
from jobs import notes, queries, stacks  # noqa: E402

from lamella.functions import names  # noqa: E402
from lamella.operators import asof, islands  # noqa: E402

SF = "/root/testdata/sf0.001"


def _plain(rows, columns):
    return sorted(([x[c] for c in columns] for x in rows), key=str)


def _expected(files, sql, view):
    db = duckdb.connect()
    db.execute(f"create view {view} as select * from read_parquet({[str(f) for f in files]})")
    found = db.execute(sql)
    columns = [d[0] for d in found.description]
    return columns, sorted(([r[i] for i in range(len(columns))] for r in found.fetchall()), key=str)


@pytest.fixture
def texts(spark, tmp_path):
    """Three files of documents, two to be added later, and a folder that holds none."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("Pixel Size: "), "doc_id", F.lit(" x 12 nm\n"), "text")).otherwise(F.col("text")))
    files = []
    for i, part in enumerate(("doc_id < 80", "doc_id >= 80 and doc_id < 140 and source <> 'src3'", "doc_id >= 140 and source = 'src3'")):
        docs.where(part).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        files.append(next((tmp_path / f"part{i}").glob("*.parquet")))
    (tmp_path / "in").mkdir()

    def add(i):
        to = tmp_path / "in" / f"{i}.parquet"
        to.write_bytes(files[i].read_bytes())
        return to

    return add


def _folders(path):
    return {d.name: sorted(f.name for f in d.iterdir()) for d in Path(path).iterdir() if d.is_dir()}


def test_notes_take_only_what_is_new(spark, texts, tmp_path, caplog):
    go = lambda: notes.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), {"files_per_batch": 1, "band": 10})
    assert go().collect() == []
    files = [texts(0)]
    columns, want = _expected(files, queries.JOB1_SQL, "documents")
    assert _plain(go().collect(), columns) == want
    assert len({x[columns.index("filled_from")] for x in want}) >= 3
    files.append(texts(1))
    columns, want = _expected(files, queries.JOB1_SQL, "documents")
    assert _plain(go().collect(), columns) == want
    before = _folders(tmp_path / "out/catalogue")
    with caplog.at_level("INFO", logger="jobs.notes"):
        assert _plain(go().collect(), columns) == want
    assert not [m for m in caplog.messages if m.startswith("batch")] and _folders(tmp_path / "out/catalogue") == before
    files.append(texts(2))
    with caplog.at_level("INFO", logger="jobs.notes"):
        columns, want = _expected(files, queries.JOB1_SQL, "documents")
        assert _plain(go().collect(), columns) == want
    read = [int(re.search(r"read (\d+) notes of 1 folders", m)[1]) for m in caplog.messages if m.startswith("batch 2: read")]
    assert read == [len(want) - sum(map(len, [_expected(files[:2], queries.JOB1_SQL, "documents")[1]]))]
    after = _folders(tmp_path / "out/catalogue")
    assert {k for k in after if after[k] != before.get(k)} == {"folder=in_src3"}


@pytest.mark.parametrize("at", ["read", "catalogue"])
def test_notes_after_a_failure(spark, texts, tmp_path, monkeypatch, at):
    """A run that ends after either write, before the batch is marked as done."""
    files = [texts(0), texts(1)]
    go = lambda: notes.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"))
    with monkeypatch.context() as m:
        if at == "read":
            m.setattr(notes, "catalogue", lambda *_: 1 / 0)
        else:
            m.setattr(notes.log, "info", lambda text, *_: 1 / 0 if "wrote" in text else None)
        with pytest.raises(Exception, match="division by zero"):
            go()
    columns, want = _expected(files, queries.JOB1_SQL, "documents")
    assert _plain(go().collect(), columns) == want


def test_notes_of_odd_texts(spark, tmp_path):
    rows = [(None, None, None), (1, "s", ""), (1, "s", ""), (2, "s", None), (3, "", "x\n" * 5 + "8 9 10"), (4, "s", "RESOLUTION 99999999999 7"), (None, "s", "version 1.2"), (5, "s", "pixel size 4"), (6, None, "a b " * 50000)]
    spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, source string, text string, folder string, batch int").write.parquet(str(tmp_path / "in"))
    got = notes.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"))
    assert set(map(tuple, got.select("doc_id", "source", "n_words", "copy_of", "res_y", "res_x", "filled_from", "from_id").collect())) == {
        (None, None, 0, None, None, None, None, None),
        (1, "s", 0, None, None, 7, "next", 4),
        (2, "s", 0, None, None, 7, "next", 4),
        (3, "", 8, None, 8, 9, "own", 3),
        (4, "s", 3, None, None, 7, "own", 4),
        (None, "s", 2, None, 1, 2, "own", None),
        (5, "s", 3, None, None, 7, "previous", 4),
        (6, None, 100000, None, None, None, None, None),
    }
    assert got.count() == 8


def test_text_resolution_is_resolution(spark):
    r = random.Random(3)
    line = lambda: r.choice(["", "Pixel Size: 10 12 nm", "resolution 5", "4 x 5", "a", "the Resolution is 7, 8 and 9"])
    rows = [(i, [line() for _ in range(r.randint(1, 9))]) for i in range(200)]
    texts = spark.createDataFrame([(i, "\n".join(x)) for i, x in rows], "k int, text string")
    lines = spark.createDataFrame([(i, n, s) for i, x in rows for n, s in enumerate(x)], "k int, n int, line string")
    got = texts.select("k", names.text_resolution(F.col("text"), ["resolution", "pixel size"]).alias("r")).select("k", "r.y", "r.x")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, names.resolution(lines, "k").collect()))


def test_banded_runs(spark):
    r = random.Random(5)
    rows = {(r.choice(["a", "a", "a", "b", None]), r.randint(-40, 60)) for _ in range(150)} | {("c", None), ("d", 7)}
    df = spark.createDataFrame([(k, z, r.choice(["p", "q", None])) for k, z in rows], "k string, z int, v string")
    want = islands.islands(df, "z", F.col("v"), ["k"]).collect()
    for band in (1, 7, 1000):
        assert _plain(islands.banded(df, "z", F.col("v"), ["k"], band).collect(), df.columns + ["island"]) == _plain(want, df.columns + ["island"])


@pytest.mark.parametrize("back", [True, False])
def test_banded_asof(spark, back):
    r = random.Random(6)
    left = [(i, r.choice(["a", "a", "b", None]), r.choice([None, *range(0, 200, 5)])) for i in range(120)]
    right = list({(k, t): (k, t, t * 2) for k, t in ((r.choice(["a", "b", None]), r.randint(20, 180)) for _ in range(25))}.values())

    def nearest(k, t):
        near = [x for x in right if x[0] == k and t is not None and (x[1] <= t if back else x[1] >= t)]
        return (max if back else min)(near, key=lambda x: x[1])[1:] if near else (None, None)

    a, b = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, u int, w int")
    for band in (1, 30, 500):
        got = asof.banded(a, b, "t", "u", band, back, by=["k"], carry=["w"])
        assert got.columns == ["i", "k", "t", "u", "w"]
        assert sorted(map(tuple, got.collect())) == [(*x, *nearest(*x[1:])) for x in left]


def test_stacks(spark, tmp_path):
    """Runs and gaps of a random listing by plain loops; written twice with the same rows."""
    r = random.Random(8)
    urls = [f"https://{r.choice(['', 'www.', 'blog.'])}d{r.choice('0001')}.org/{r.choice('xxxy')}/{r.randint(1, 90)}{r.choice(['', '/', '.html', '?a=1', '#t'])}" for _ in range(150)]
    urls += ["https://d2.org/x/99999999999", "https://d2.org/x/", None, "", "nothing", urls[0], "http://lone/x/5"]
    spark.createDataFrame([(u, 1, "p") for u in urls], "url string, z int, part string").repartition(3).write.parquet(str(tmp_path / "in"))
    slices = {}
    for u in urls:
        m = re.match(r"[a-z]+://(?:www\.|blog\.)?([^/]+)/(\w)/(\d{1,5})(?:\.html)?/?(?:[?#].*)?$", u or "")
        if m:
            slices.setdefault(m[1], {}).setdefault(int(m[3]), []).append((m[2], u))
    want = []
    for d, by_z in slices.items():
        run, before, rows, zs = 0, None, [], sorted(by_z)
        for z, following in zip(zs, [*zs[1:], None], strict=True):
            members = sorted({s for s, _ in by_z[z]})
            run += members != before
            before = members
            rows.append([d, z, run, f"{run:02d}_{'_'.join(members)}", len(members) > 1, ",".join(members), len(by_z[z]), min(u for _, u in by_z[z]), (following or z + 1) - z - 1])
        for x in rows:
            same = [y[1] for y in rows if y[2] == x[2]]
            want.append([*x[:8], min(same), max(same) + 1, x[8]])
    columns = ["dataset", "z", "run", "name", "combined", "members", "n_paths", "first_path", "z_start", "z_end", "gap"]
    for _ in range(2):
        got = stacks.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"band": 4})
        assert _plain(got.collect(), columns) == sorted(want, key=str)
    gaps = spark.read.parquet(str(tmp_path / "out/gaps"))
    assert gaps.agg(F.sum("n")).first()[0] == sum(x[-1] for x in want)
    run_of = {(x[0], x[1]): x[2] for x in want}
    assert all(g.before == run_of[g.dataset, g.z_start - 1] and g.after == run_of[g.dataset, g.z_end] for g in gaps.collect())


def test_stacks_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "url string").write.parquet(str(tmp_path / "in"))
    assert stacks.run(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect() == []


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_is_its_sql(spark, name):
    table = {"job1_notes": "documents", "job2_stacks": "pages"}[name]
    columns, want = _expected([f"{SF}/{table}.parquet"], queries.ORACLES[name], table)
    assert _plain(queries.QUERIES[name](spark, SF).collect(), columns) == want


def test_command_lines(tmp_path):
    """Each job by its command line, on a copy, twice: what it logs, and the output of the second run."""
    (tmp_path / "in.parquet").write_bytes(Path(f"{SF}/pages.parquet").read_bytes())
    (tmp_path / "c.json").write_text('{"folders": 2}')
    command = [sys.executable, "-m", "jobs.stacks", "--input", str(tmp_path / "in.parquet"), "--output", str(tmp_path / "out"), "--config", str(tmp_path / "c.json")]
    done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "read 50 paths" in done.stderr and "wrote" in done.stderr, done.stderr[-2000:]
    assert {d.name for d in (tmp_path / "out/slices").glob("part=*")} <= {"part=0", "part=1"}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/1.parquet").write_bytes(Path(f"{SF}/documents.parquet").read_bytes())
    command = [sys.executable, "-m", "jobs.notes", "--input", str(tmp_path / "docs"), "--output", str(tmp_path / "notes"), "--checkpoint", str(tmp_path / "mark")]
    done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "read 200 notes of 20 folders" in done.stderr and "catalogue: 200 notes" in done.stderr, done.stderr[-2000:]
