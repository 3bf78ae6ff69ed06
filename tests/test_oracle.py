"""Every relational query against its SQL in DuckDB, on the supplied tables."""

import os

import duckdb
import pytest

from pointstream.plans import formats, relational  # noqa: F401  formats adds its queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


def plain(v):
    return round(v, 9) if isinstance(v, float) else int(v) if isinstance(v, int) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(relational.QUERIES))
def test_same_rows(spark, duck, name):
    want = duck.execute(relational.ORACLE_SQL[name])
    columns = sorted(c[0] for c in want.description)
    place = [[c[0] for c in want.description].index(c) for c in columns]
    rows = sorted((tuple(plain(r[k]) for k in place) for r in want.fetchall()), key=str)
    df = relational.QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert len(got) == len(rows) > 0
    assert got == rows
