"""Ranks and scores against sums over all documents."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from foliomill.llm import impacts
from hypothesis import given, settings
from hypothesis import strategies as st

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, block long, term string, q int"
ITEMS = "item_id long, text string, doc_id long, rank int"


def words(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    own = [(i, words(t)) for i, t in docs]
    n, total = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    df = {}
    for _, w in own:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, w in own:
            m = 25 + (75 * len(w) * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 8 * m)) for t in words(text) if t in w)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x", 2) for r in docs], DOCS).repartition(3)
    found = impacts.ranked(d, spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def made(n, seed=0, vocabulary=400):
    draw = np.random.default_rng(seed)
    names = [f"w{i}" if i % 7 else f"É{i}" for i in range(vocabulary)]
    return [(i, " ".join(names[j] for j in draw.zipf(1.3, draw.integers(1, 60)) % vocabulary) + ("." if i % 2 else "\n")) for i in range(n)]


def test_equals_sums_over_all_documents(spark):
    docs = made(500)
    docs += [(1000 + i, docs[3][1]) for i in range(40)]  # copies: ties beyond k
    items = [(i, t) for i, t in made(30, 1)] + [(50, docs[3][1].upper() + docs[3][1]), (51, "w1 " * 700 + "w2")]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_docs=64, block_bytes=1500, at_once=4) == want == run(spark, docs, items, most_small=0)
    assert run(spark, docs, items, k=1) == brute(docs, items, 1)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "alpha Beta"), (None, "alpha beta"), (5, "alpha"), (6, "x" * 300_000 + " alpha " * 50_000), (7, "ünï x \U0001f600"), (8, "other"), (9, "other"), (10, "a-b_c")]
    items = [(1, None), (2, ""), (3, "ALPHA"), (4, "beta gamma"), (None, "beta"), (5, "Ünï x"), (5, "ünï x \U0001f600"), (6, "c b a"), (7, "absent")]
    assert run(spark, docs, items) == brute(docs, items)


def test_repeated_rows_have_ranks_of_their_own(spark):
    docs = [(1, "alpha")] * 3 + [(2, "beta"), (3, "gamma"), (4, "delta"), (5, "delta")]
    assert run(spark, docs, [(9, "alpha")], k=2) == brute(docs, [(9, "alpha")], 2)
    assert run(spark, docs, [(9, "beta"), (9, "beta")]) == brute(docs, [(9, "beta"), (9, "beta")])


def test_no_rows(spark):
    assert run(spark, [], [(1, "a")]) == run(spark, [(1, "a")], []) == run(spark, [(1, None)], [(1, "a")]) == []


def test_parameters_that_make_no_sense(spark):
    for bad in ({"k": 0}, {"block_docs": 0}, {"block_docs": 1 << 17}, {"at_once": 0}):
        with pytest.raises(ValueError):
            run(spark, [(1, "a")], [(1, "a")], **bad)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ09 é\n.\x00\U0001f600", max_size=8) | st.none(), max_size=6), st.integers(0, 3))
def test_terms(texts, cut):
    found, at = impacts.terms(pa.array(texts, pa.string())[cut:])
    assert list(zip(at.tolist(), found.to_pylist(), strict=True)) == [(i, w) for i, t in enumerate(texts[cut:]) for w in words(t)]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1 << 32), st.integers(1, 5), st.integers(1, 150), st.integers(1, 12))
def test_bitwise_sums_and_tops(seed, n_rows, n_places, k):
    draw = np.random.default_rng(seed)
    want, sums = np.zeros((n_rows, n_places), np.int64), np.zeros((2, n_rows, -(-n_places // 64)), np.uint64)
    for _ in range(6):
        at = np.sort(draw.choice(n_places, draw.integers(1, n_places + 1), replace=False))
        values = draw.integers(0, 1 << draw.integers(1, 36), len(at)) // draw.integers(1, 3)
        bits, ends = impacts.sliced(np.append(values, [5]), np.array([0, len(at), len(at) + 1]))
        rows = np.sort(draw.choice(n_rows, draw.integers(1, n_rows + 1), replace=False))
        times = draw.integers(1, 6, len(rows))
        sums = impacts.add(sums, rows, impacts.expanded(at.astype("<u2").tobytes(), bits[: ends[1]].tobytes(), bits.shape[1], sums.shape[2]), times)
        want[rows[:, None], at] += times[:, None] * values
    for own, found in zip(want, impacts.top(sums, k), strict=True):
        assert sorted(found) == sorted(sorted(np.flatnonzero(own).tolist(), key=lambda p: (-own[p], p))[:k])
