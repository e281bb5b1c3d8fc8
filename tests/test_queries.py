"""Every query with an oracle against DuckDB, and every other one for rows, at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from lamella.plans import catalogue  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="session")
def db():
    out = duckdb.connect()
    out.execute("set timezone = 'UTC'")
    for t in TABLES.split():
        out.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return out


def _plain(v):
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(str, ([_plain(x) for x in r] for r in df.select(*columns).collect())))
    found = db.execute(catalogue.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(map(str, ([_plain(r[i]) for i in at] for r in found.fetchall())))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.QUERIES) <= set(entry.queries())
