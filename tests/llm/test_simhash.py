"""Fingerprints, links and components against brute force."""

import random
import re

import xxhash
from foliomill.llm import simhash
from foliomill.llm.components import connected_components


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for t in (None, "", "  \n", "a", "A b", "a b C", "a b c a b c a b c", "Ünï x y z İ w", "one two three four five " * 300):
        assert simhash.fingerprint(t) == plain_print(t)


def test_spark_hash_is_the_same(spark):
    row = spark.sql("select xxhash64('a b ü') as h").first()
    assert row.h & (2**64 - 1) == xxhash.xxh64_intdigest("a b ü".encode(), 42)


def near_values(n, seed):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(max(1, n // 8))] + [0, 2**64 - 1]
    out = set()
    while len(out) < n:
        x = r.choice(base)
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_links(values, most):
    return {
        tuple(sorted((signed(a), signed(b))))
        for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= most
    }


def test_links_equal_brute_force(spark):
    for most, hot, n in ((3, 256, 300), (3, 2, 300), (0, 256, 60), (1, 256, 100), (2, 256, 200), (2, 3, 200), (4, 5, 160), (5, 4, 120), (6, 256, 120)):
        values = near_values(n, most)
        want = plain_links(values, most)
        got = simhash.links(spark.createDataFrame([(signed(v),) for v in values], "fp long"), most, hot).collect()
        assert len(got) == len(want) and {(r.u, r.v) for r in got} == want, most


def test_links_across_every_split_of_the_bits(spark):
    at = ((0, 1), (0, 63), (31, 32), (15, 16, 47, 48), (0, 1, 2, 3), (0, 21, 42, 63), (20, 21, 41, 42, 62, 63))
    for most in (2, 4, 6):
        values = sorted({0} | {sum(1 << b for b in bits) for bits in at})
        got = simhash.links(spark.createDataFrame([(v,) for v in map(signed, values)], "fp long"), most).collect()
        assert {(r.u, r.v) for r in got} == plain_links(values, most)


def test_links_of_a_dense_group_in_small_batches(spark):
    """Fingerprints that agree in their upper half: its variants are hot, and groups go on from batch to batch."""
    draw = random.Random(9)
    values = sorted({(7 << 40) | draw.getrandbits(11) for _ in range(900)} | {draw.getrandbits(64) for _ in range(50)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = simhash.links(spark.createDataFrame([(signed(v),) for v in [*values, values[0]]] + [(None,)], "fp long"), 3, 16).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain_links(values, 3)
    assert len(got) == len(want) and {(r.u, r.v) for r in got} == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (1, 0), (200, 201), (None, 5)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    nodes = {n for e in edges for n in e if None not in e}
    assert {r.node: r.root for r in got} == roots(nodes, [e for e in edges if None not in e])
    assert len(got) == len(nodes)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


TEXT = " ".join(f"w{i}" for i in range(400))
ROWS = [
    (5, TEXT), (3, TEXT), (9, TEXT.replace("w7 ", "x7 ")), (1, None), (2, ""), (4, " "), (8, "a b"), (8, "A B"), (8, "quite other text"),
    (None, TEXT), (None, "only without an id here"), (None, "only without an id here"), (7, "long " * 20000), (7, "long " * 20000),
]


def test_documents(spark):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in ROWS], "doc_id long, text string, fp int, root string").repartition(3)
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_print(t) for _, t in ROWS]
    edges = [(a, b) for a in range(len(ROWS)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    group = roots(range(len(ROWS)), edges)
    least = {}
    for k, (i, _) in enumerate(ROWS):
        if i is not None:
            least[group[k]] = min(i, least.get(group[k], i))
    want = [(i, signed(prints[k]), least.get(group[k])) for k, (i, _) in enumerate(ROWS)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.fp, r.component_id)) for r in got)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    first = {}
    for k, (i, t) in enumerate(ROWS):
        key = (i is None, i or 0)
        if group[k] not in first or key < first[group[k]][0]:
            first[group[k]] = (key, i)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for _, i in first.values())


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0
