"""Every registered query that SQL can express, against DuckDB on the smallest tables; the others for stable rows."""

import os
import re
import unicodedata
from collections import Counter

import duckdb
import pytest
from foliomill.plans import catalog
from test_scores import plain_alignment

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, duck, name):
    rows = catalog.QUERIES[name](spark, SF)
    columns = sorted(rows.columns)
    found = duck.execute(catalog.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(tuple(map(plain, r)) for r in rows.select(columns).collect()) == want and want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs_the_same_twice(spark, name):
    one, two = (sorted(tuple(map(plain, r)) for r in catalog.QUERIES[name](spark, SF).collect()) for _ in range(2))
    assert one == two and one


@pytest.mark.parametrize("level", ["word", "character"])
def test_operations_equal_brute_force(spark, level):
    pairs = catalog.turn_pairs(spark, SF).limit(25 if level == "character" else 1000)
    rows = [(r.truth, r.found) for r in pairs.collect()]
    split = str.split if level == "word" else lambda t: re.findall(r"(?s).[\u0300-\u036f]*", unicodedata.normalize("NFD", t))
    if level == "character":
        rows = [(a[:150], b[:150]) for a, b in rows]
        pairs = spark.createDataFrame(rows, "truth string, found string")
    want = Counter(x for a, b in rows for x in plain_alignment(split(a), split(b)))
    got = catalog.errors.operations(pairs, level=level).collect()
    assert {(r.operation, r.truth, r.found): r.n for r in got} == want


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["doc_id", "n_lines", "n_chars", "n_words"] and rows.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
