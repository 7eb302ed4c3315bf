"""Every query with SQL gives the rows that SQL gives."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(rows):
    def value(v):
        if v is None or isinstance(v, float) and v != v:
            return None
        return float(v) if isinstance(v, int | float) and not isinstance(v, bool) else v if isinstance(v, bool) else str(v)

    return sorted((tuple(map(value, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SMALL)
    names = sorted(df.columns)
    cursor = db.execute(ORACLES[name])
    have = [c[0] for c in cursor.description]
    assert sorted(have) == names
    want = [tuple(r[have.index(c)] for c in names) for r in cursor.fetchall()]
    assert plain([tuple(r[c] for c in names) for r in df.collect()]) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
