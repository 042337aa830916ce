"""What SQL can express of the operators' results, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest
from foliomill.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, duck, name):
    rows = queries.QUERIES[name](spark, SF)
    columns = sorted(rows.columns)
    found = duck.execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(tuple(map(str, r)) for r in rows.select(columns).collect()) == want and want


def test_every_operator_has_one_query():
    own = [name for name in queries.QUERIES if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in own) == list(range(1, 14))
