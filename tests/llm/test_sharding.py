"""Shards: whole, near equal, ordered by key, gapless slots."""

from collections import defaultdict

from foliomill.llm import sharding

LOW = sharding.LOW


def check(rows, want, shards, slack):
    assert sorted(map(str, ((r.doc_id, r.text) for r in rows))) == sorted(map(str, want))
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len((r.text or "").encode()) + 1
        by[r.shard].append(r)
    sizes = [sum(r["size"] for r in by[k]) for k in range(shards)]
    mean = sum(sizes) / shards
    assert max(abs(s - mean) for s in sizes) <= slack, sizes
    last = LOW
    for k in range(shards):
        own = sorted(by[k], key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [LOW if r.doc_id is None else r.doc_id for r in own]
        assert keys == sorted(keys) and (not keys or keys[0] >= last)
        last = keys[-1] if keys else last


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    got = sharding.shard(docs, 16, part_bytes=50_000).collect()
    longest = max(len(r.text.encode()) + 1 for r in rows)
    check(got, [(r.doc_id, r.text) for r in rows], 16, longest + 100)


def test_hot_key_nulls_and_repeats_are_spread(spark):
    rows = [(None, "t" * 50)] * 3000 + [(7, "same")] * 3000 + [(i, None) for i in range(500)] + [(-(1 << 63), ""), ((1 << 63) - 1, "é")]
    docs = spark.createDataFrame([(*r, 1, "a") for r in rows], "doc_id long, text string, slot int, shard string").repartition(5)
    got = sharding.shard(docs, 8).collect()
    check(got, rows, 8, 120)


def test_few_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b" * 100000), (3, None)], "doc_id long, text string")
    got = sharding.shard(docs, 4).collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == [(1, 2), (2, 100001), (3, 1)]
    assert len({(r.shard, r.slot) for r in got}) == 3
    assert sharding.shard(docs.limit(0), 4).count() == 0


def test_splitters_are_exact(spark):
    keys = spark.createDataFrame([(i * 10**15, i, 1 + i % 7) for i in range(2000)], "key long, tie long, size long")
    total = sum(1 + i % 7 for i in range(2000))
    for k, (key, _) in enumerate(sharding.splitters(keys, 10, tolerance=0, probes=4), 1):
        below = sum(1 + i % 7 for i in range(2000) if i * 10**15 < key)
        assert abs(below - total * k / 10) <= 7


def test_many_points_are_searched(spark):
    points = sorted((k // 3, (k % 3) * 10) for k in range(700))
    rows = [(k, t) for k in (-1, 0, 5, 100, 233, 234) for t in (-1, 0, 5, 10, 20, 21)]
    frame = spark.createDataFrame(rows, "key long, tie long")
    got = {(r.key, r.tie): r.n for r in frame.withColumn("n", sharding._below(points)).collect()}
    assert got == {r: sum(p <= r for p in points) for r in rows}
    assert frame.select(sharding._below([])).first()[0] == 0
