"""The registered queries: those that SQL can express against it, and where they come from."""

import __spark_entry__ as entry
import duckdb
import pytest
from check import TABLES, compare

from ebbtide.llm import queries

ORACLE = queries.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, folder, con, name):
    df = entry.queries()[name](spark, folder)
    cur = con.execute(ORACLE[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cur.description], cur.fetchall()) == ""


def test_all_operators_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names
