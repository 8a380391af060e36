"""Every registered query that has SQL gives the same rows as DuckDB on the same tables."""

import duckdb
import pytest

from ledgerloom.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def cell(x):
    if isinstance(x, float):
        return float(f"{x:.9g}")
    return x.replace(tzinfo=None) if hasattr(x, "tzinfo") else x


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    assert got
    if name in ORACLE_SQL:
        answer = duck.execute(ORACLE_SQL[name])
        names = [c[0] for c in answer.description]
        assert sorted(names) == sorted(df.columns)
        assert got == normal(answer.fetchall(), names)
