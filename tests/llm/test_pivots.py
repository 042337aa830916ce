"""Links, counts and components against all pairs."""

import numpy as np
import pytest
from foliomill.llm import pivots, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, n long, list string, e int"


def brute(rows, threshold=0.98):
    """(links, component) of each vec_id, ids distinct; pairs whose cosine is at the threshold but for rounding are refused."""
    own = [(i, np.array(v, float), label) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    n, low = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}
    edges = []
    for a, (i, v, label) in enumerate(own):
        for j, w, other in own[a + 1 :]:
            if label == other and len(v) == len(w):
                c = v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)
                assert abs(c - threshold) > 1e-9
                if c >= threshold:
                    edges.append((i, j))
                    n[i] += 1
                    n[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            least = min(low[i], low[j])
            changed |= low[i] != low[j]
            low[i] = low[j] = least
    return {i: (n[i], low[i]) for i in n}


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], SCHEMA).repartition(3)
    got = pivots.near_duplicates(frame, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return got


def around(draw, centre, n, cosine):
    """n vectors at about the given cosine from a centre."""
    z = draw.normal(size=(n, len(centre)))
    z -= (z @ centre)[:, None] * centre / (centre @ centre)
    z /= np.linalg.norm(z, axis=1)[:, None]
    return cosine * centre / np.linalg.norm(centre) + np.sqrt(1 - cosine**2) * z


@pytest.mark.parametrize("d", [1, 2, 3, 8, 64])
def test_equals_all_pairs_whatever_the_length(spark, d):
    draw = np.random.default_rng(d)
    x = draw.normal(size=(200, d))
    near = np.concatenate([around(draw, v, 3, 0.985) for v in x[:40]]) if d > 1 else x[:40] * 2
    both = np.concatenate([x, near]) * draw.uniform(0.1, 10, size=(len(x) + len(near), 1))
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(both)]
    got = run(spark, rows, block=50)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


def test_dense_clusters_and_a_cone(spark):
    """A third of all vectors in one cluster, and vectors that all point the same way; blocks are split."""
    draw = np.random.default_rng(0)
    cluster = around(draw, draw.normal(size=32), 300, 0.9905)
    cone = around(draw, draw.normal(size=32), 300, 0.93)
    pairs = np.concatenate([around(draw, v, 1, 0.985) for v in cone[:100]])
    rows = [(i, v.tolist(), 7) for i, v in enumerate(np.concatenate([cluster, cone, pairs, draw.normal(size=(200, 32))]))]
    want = brute(rows)
    for options in ({"block": 64}, {}):
        got = {r.vec_id: (r.n_links, r.component_id) for r in run(spark, rows, **options)}
        found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
        assert there > 10000 and 0.99 * there <= found <= there
        assert all(got[i][0] <= want[i][0] for i in want)


def test_recall_of_pairs_at_the_threshold(spark):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(3000, 64))
    near = np.concatenate([around(draw, v, 1, 0.9801) for v in x])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, near]))]
    got = run(spark, rows)
    assert sum(r.n_links > 0 for r in got) >= 0.995 * 6000
    assert all(r.component_id % 3000 == r.vec_id % 3000 for r in got)


def test_odd_rows_and_copies(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v, 1), (6, [2.0, 4.0, 6.0], 1), (7, v, 2), (8, v, None), (9, None, 1), (10, [0.0, 0.0, 0.0], 1), (11, [float("nan"), 1.0, 2.0], 1)]
    rows += [(12, [1.0, None, 2.0], 1), (13, [], 1), (14, [float("inf"), 1.0, 1.0], 1), (15, [1.0, 2.0], 1), (16, [1e300, 2e300, 3e300], 1), (17, [-1.0, -2.0, -3.0], 1)]
    rows += [(18, [0.0, 1.0, 0.0], 1), (19, [-0.0, 1.0, 0.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in run(spark, rows)}
    want = {i: (0, i) for i, _, _ in rows} | {5: (2, 5), 6: (2, 5), 16: (2, 5), 18: (1, 18), 19: (1, 18)}
    assert got == want


def test_repeated_rows_and_null_ids(spark):
    v, w = [1.0, 2.0], [5.0, -1.0]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in pivots.near_duplicates(
        spark.createDataFrame([(3, v, 1, 1, "", 1)] * 2 + [(None, v, 1, 1, "", 1), (None, w, 1, 1, "", 1), (4, v, 1, 1, "", 1)], SCHEMA)).collect())
    assert got == [("3", 3, "3", True)] * 2 + [("4", 3, "3", False), ("None", 0, "None", True), ("None", 3, "3", False)]


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert pivots.near_duplicates(frame).collect() == []
    assert pivots.near_duplicates(frame).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_parameters_that_make_no_sense(spark):
    for bad in ({"threshold": 0.0}, {"threshold": 1.5}, {"block": 0}, {"most_points": 0}):
        with pytest.raises(ValueError):
            pivots.near_duplicates(spark.createDataFrame([], SCHEMA), **bad)


def test_query(spark):
    rows = queries.QUERIES["op13_pivot_near_dedup"](spark, SF)
    own = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows.collect()} == brute([(r.vec_id, r.embedding, r.label) for r in own])
