"""Recall and distances against brute force."""

import numpy as np
import pytest
from foliomill.llm import ann

SF = "/root/testdata/sf0.1"


def brute(rows, k=10, every=100):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q in sorted({i for i in ids if i % every == 0}):
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        found = sorted((a, b) for a, b in zip(d, ids, strict=True) if b != q)
        out[q] = found[:k]
    return out


def compare(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q, found in want.items():
        own = sorted(by.get(q, []), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(found) + 1))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & {i for _, i in found})
        total += len(found)
        right = {i: d for d, i in found}
        assert all(abs(r.score - right[r.vec_id]) < 1e-12 for r in own if r.vec_id in right)
    assert set(by) <= set(want)
    return hits / max(1, total)


def test_recall(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    assert compare(ann.nearest(e).collect(), brute(rows)) >= 0.99


def test_codes_alone_find_the_nearest(spark):
    """Recall of a shortlist of 32 of 20,000 vectors in which nothing but codes has been compared."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(400, 32))
    rows = [(i, (centres[i % 400] + 0.5 * draw.normal(size=32)).tolist()) for i in range(20000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = ann.nearest(frame, every=400, shortlist=32, sample=2000).collect()
    assert compare(got, brute(rows, every=400)) >= 0.9


def test_coding_gets_better_with_beam_and_books():
    x = np.random.default_rng(0).normal(size=(2000, 16))
    books = ann.train(x, 4, 32)
    error = lambda codes, b: ((x - ann.decode(codes, b)) ** 2).sum(1).mean()
    assert error(ann.encode(x, books, beam=8), books) <= error(ann.encode(x, books, beam=1), books)
    assert error(ann.encode(x, books), books) < error(ann.encode(x, books[:2]), books[:2])


def test_odd_rows_ties_and_copies(spark):
    draw = np.random.default_rng(1)
    hot = [0.5] * 8
    rows = [(i, draw.normal(size=8).tolist()) for i in range(150)] + [(1000 + i, hot) for i in range(300)]
    rows += [(100, rows[100][1])]
    odd = [(None, hot), (5000, None), (5001, [0.0] * 8), (5002, [float("nan")] * 8), (5003, [None] * 8), (5004, [1.0] * 7), (5005, [float("inf")] * 8), (5006, [])]
    frame = spark.createDataFrame([(*r, "w", 1) for r in rows + odd], "vec_id long, embedding array<double>, block string, x int").repartition(3)
    got = [r for r in ann.nearest(frame, queries_at_once=2).collect()]
    assert compare(got, brute(list(dict((str(r), r) for r in rows).values()))) == 1.0
    own = sorted((r.rank, r.vec_id) for r in got if r.query_id == 1000)
    assert own == [(i, 1000 + i) for i in range(1, 11)]


def test_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (7, [1.0, 4.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(frame).collect()] == [(0, 1, 7, 2.0)]
    assert ann.nearest(frame.filter("vec_id = 0")).count() == 0
    assert ann.nearest(frame.limit(0)).count() == 0


def test_each_length_is_an_index_of_its_own(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=3 + i % 2).tolist()) for i in range(0, 300, 25)] + [(i, draw.normal(size=3).tolist()) for i in range(301, 330)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ann.nearest(frame, k=3, every=25).select("query_id", "rank", "vec_id").collect()))
    want = []
    for q, x in (r for r in rows if r[0] % 25 == 0):
        found = sorted((float(np.linalg.norm(np.subtract(x, v))), i) for i, v in rows if i != q and len(v) == len(x))[:3]
        want += [(q, k, i) for k, (_, i) in enumerate(found, 1)]
    assert got == sorted(want)


def test_parameters_that_make_no_sense(spark):
    frame = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    for bad in ({"every": 0}, {"k": 0}, {"n_words": 500}):
        with pytest.raises(ValueError):
            ann.nearest(frame, **bad)
