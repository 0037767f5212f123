import duckdb
import pytest

from textquarry.session import TABLES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sql():
    """A function that runs an oracle over the smallest tables: (columns, rows)."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")

    def run(text):
        res = con.execute(text)
        return [d[0] for d in res.description], res.fetchall()

    return run


@pytest.fixture(scope="session")
def same(spark, sql):
    """Asserts that a registered query and its oracle agree on the smallest tables."""

    def check(name):
        from textquarry.llm.queries import ORACLES, QUERIES

        df = QUERIES[name](spark, SMALL)
        cols, want = sql(ORACLES[name])
        assert sorted(df.columns) == sorted(cols)
        got = sorted((tuple(r[c] for c in sorted(cols)) for r in df.collect()), key=repr)
        at = [cols.index(c) for c in sorted(cols)]
        assert got == sorted((tuple(r[i] for i in at) for r in want), key=repr)

    return check
