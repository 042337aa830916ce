"""Schedules keep within a block of the weights; mixing keeps every row once."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from foliomill.llm import mixing
from pyspark.sql import functions as F


def deviation(order, share):
    length, had, worst = len(order), Counter(), 0.0
    for t, s in enumerate(order, 1):
        had[s] += 1
        worst = max(worst, max(abs(had[x] - t * n / length) for x, n in share.items()))
    return worst


def test_schedule_deviates_by_less_than_one_block():
    draw = random.Random(3)
    for _ in range(60):
        share = {f"s{i}": draw.choice([1, 1, 2, 5, 40, 300]) for i in range(draw.randint(1, 12))}
        slots = mixing.schedule(share)
        assert sorted(t for x in slots.values() for t in x) == list(range(sum(share.values())))
        order = [s for _, s in sorted((t, s) for s, x in slots.items() for t in x)]
        assert deviation(order, share) < 1


def test_phases_use_all_blocks():
    blocks = {"a": 1000, "b": 70, "c": 3, "d": 0, "e": 11}
    got = Counter()
    for share, cycles in mixing.phases(blocks, {"a": 1.0, "b": 1.0, "c": 5.0}, 16):
        got.update({s: n * cycles for s, n in share.items()})
    assert got == Counter({s: n for s, n in blocks.items() if n})


def brute(rows, weights, block):
    """Blocks of each source, by the definition: each slot goes to the released block that is due first.

    A fluid mix is advanced slot by slot in fractions; block k is released in the slot where it starts and due in the one
    where it ends. Sources without a weight follow by their sizes.
    """
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size_
    key = {s: "n" if s is None else f"s{s}" for s in sizes}
    blocks = {key[s]: -(-n // block) for s, n in sizes.items()}
    names = {v: k for k, v in key.items()}
    order = []
    for own in ({s: Fraction(weights[s]) for s in blocks if s in weights}, {s: Fraction(n) for s, n in blocks.items() if s not in weights}):
        had, time, crossed = dict.fromkeys(own, Fraction(0)), Fraction(0), {s: [Fraction(0)] for s in own}
        while any(had[s] < blocks[s] for s in own):
            live = [s for s in own if had[s] < blocks[s]]
            rate = {s: own[s] / sum(own[x] for x in live) for s in live}
            step = min((Fraction(int(had[s]) + 1) - had[s]) / rate[s] for s in live)
            time += step
            for s in live:
                had[s] += rate[s] * step
                if had[s].denominator == 1 and had[s] == len(crossed[s]):
                    crossed[s].append(time)
        got, base = Counter(), len(order)
        for t in range(sum(blocks[s] for s in own)):
            ready = [(-(-crossed[s][got[s] + 1] // 1), s) for s in own if got[s] < blocks[s] and crossed[s][got[s]] // 1 <= t]
            s = min(ready)[1]
            got[s] += 1
            order.append(names[s])
        assert len(order) - base == sum(blocks[s] for s in own)
    return order


def test_mix(spark):
    draw = random.Random(5)
    rows = [(i, "x" * draw.randint(0, 300), draw.choice(["a", "a", "a", "b", "", None])) for i in range(1500)]
    rows += [(None, None, "b")] * 3 + [(7, "dup", "a")] * 2 + [(9000, "y" * 5000, "c")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, slot_ int").repartition(7)
    got = mixing.mix(docs, {"a": 2, "b": 1, None: 1, "c": 1}, block_bytes=500, cycle=8).collect()
    assert sorted(map(str, ((r.doc_id, r.text, r.source) for r in got))) == sorted(map(str, rows))
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    order = brute(got, {"sa": 2, "sb": 1, "n": 1, "sc": 1}, 500)
    for own in by.values():
        own.sort(key=lambda r: (r.block_, r.slot_))
        assert [r.block_ for r in own] == sorted(r.block_ for r in own)
    seen = Counter()
    blocks = {}
    for t, s in enumerate(order):
        blocks[s, seen[s]] = t
        seen[s] += 1
    assert all(blocks[r.source, r.block_] == r.slot_ for r in got)
    assert [r.slot_ for r in got] == sorted(r.slot_ for r in got)


def test_plain_join_beyond_the_broadcast_bound(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = mixing.mix(docs, block_bytes=2000).select("doc_id", "slot_").collect()
    monkeypatch.setattr(mixing, "BROADCAST_NUMBERS", 0)
    two = mixing.mix(docs, block_bytes=2000).select("doc_id", "slot_").collect()
    assert sorted(one) == sorted(two) and len(one) == docs.count()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0


def fluid_deviation(blocks, weights, order):
    """The most blocks that any source is ahead of or behind a fluid mix by the weights, after any slot."""
    w = {s: Fraction(weights[s]) for s in blocks}
    ends = sorted(blocks, key=lambda s: blocks[s] / w[s])
    left, had, time, at, worst = dict(blocks), Counter(), Fraction(0), Fraction(0), 0.0  # at: fluid blocks for each unit of weight
    active = sum(w.values())
    for t, s in enumerate(order, 1):
        had[s] += 1
        while ends and time + (blocks[ends[0]] / w[ends[0]] - at) * active <= t:
            e = ends.pop(0)
            time, at, active = time + (blocks[e] / w[e] - at) * active, blocks[e] / w[e], active - w[e]
        now = float(at + (t - time) / active) if ends else float(at)
        worst = max(worst, max(abs(had[x] - min(float(w[x]) * now, blocks[x])) for x in left))
    return worst


def whole_order(blocks, weights):
    order = []
    for share, cycles in mixing.phases(blocks, weights):
        order += [s for _, s in sorted((t, s) for s, x in mixing.schedule(share).items() for t in x)] * cycles
    return order


def test_small_mixes_keep_the_weights():
    for times in (1, 5, 20):
        blocks = {"hot": 129 * times} | {f"s{i}": 13 * times for i in range(20)}
        order = whole_order(blocks, {s: n**0.7 for s, n in blocks.items()})
        target = blocks["hot"] ** 0.7 / sum(n**0.7 for n in blocks.values())
        until = int(min(n / (n**0.7 / sum(m**0.7 for m in blocks.values())) for n in blocks.values()))
        assert abs(order[:until].count("hot") - until * target) < 2
    order = whole_order({"a": 600, "b": 200}, {"a": 1, "b": 1})
    assert abs(order[:400].count("a") - 200) <= 1 and order[400:] == ["a"] * 400 and len(order) == 800


def test_rows_keep_the_weights_at_several_sizes(spark):
    for n in (40, 150):
        rows = [(i, "x" * 999, "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(12 * n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
        weights = {"hot": 1, "s0": 1, "s1": 1, "s2": 1, "s3": 1}
        got = [r.source for r in mixing.mix(docs, weights, block_bytes=1000).collect()]
        assert fluid_deviation(Counter(got), weights, got) < 1.001  # a block is a row here


def test_rounding_does_not_add_up():
    blocks = {"hot": 9500} | {f"s{i}": 960 + 7 * i for i in range(20)}
    weights = {s: n**0.7 for s, n in blocks.items()}
    assert fluid_deviation(blocks, weights, whole_order(blocks, weights)) < 1.001
    blocks, weights = {"a": 20000, "b": 13000, "c": 90}, {"a": 0.6, "b": 0.39999, "c": 1e-5}
    order = whole_order(blocks, weights)
    assert fluid_deviation(blocks, weights, order) < 1.001
    assert order[:30000].count("c") <= 1
    draw = random.Random(11)
    for _ in range(40):
        blocks = {f"s{i}": draw.choice([1, 3, 50, 400]) for i in range(draw.randint(1, 15))}
        weights = {s: draw.choice([1e-6, 0.3, 1, 2.5, 1e4]) * draw.random() for s in blocks}
        assert fluid_deviation(blocks, weights, whole_order(blocks, weights)) < 1.001


def test_one_text_on_all_rows_is_spread(spark):
    docs = spark.createDataFrame([(5, "same " * 20, "a", 0)] * 3000 + [(6, "b", "b", 0)], "doc_id long, text string, source string, q int")
    got = mixing.mix(docs, block_bytes=2000)
    parts = Counter(r.p for r in got.select(F.spark_partition_id().alias("p")).collect())
    assert sum(parts.values()) == 3001 and max(parts.values()) < 1500
    starts = got.filter("source = 'a'").groupBy("block_").count().collect()
    assert max(r["count"] for r in starts) <= 20 and len(starts) == -(-3000 * 101 // 2000)


def test_too_many_sources(spark):
    docs = spark.createDataFrame([(i, "x", f"s{i}") for i in range(30)], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        mixing.mix(docs, most_sources=29)


def test_many_sources_are_dealt_in_good_time():
    draw = random.Random(2)
    blocks = {f"s{i}": draw.choice([1, 2, 3]) for i in range(20000)}
    order = whole_order(blocks, {s: n**0.7 for s, n in blocks.items()})
    assert Counter(order) == Counter(blocks)


def test_blocks_grow_so_that_slots_stay_few(spark):
    """With most_slots below the blocks of block_bytes, blocks are larger, and no source is off its target by more than one."""
    docs = spark.createDataFrame([(i, "x" * (i % 50), "ab"[i % 3 == 0]) for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, {"a": 1.0, "b": 3.0}, block_bytes=100, most_slots=40).collect()
    total = sum(r.size_ for r in rows)
    assert len(rows) == 3000 and max(r.slot_ for r in rows) <= 41 and len({(r.source, r.block_) for r in rows}) <= 42
    size, had = -(-total // 40), {"a": set(), "b": set()}
    assert all(sum(r.size_ for r in rows if (r.source, r.block_) == k) < 2 * size for k in {(r.source, r.block_) for r in rows})
    last = min(max(r.slot_ for r in rows if r.source == s) for s in "ab")
    for r in sorted(rows, key=lambda r: r.slot_):
        had[r.source].add(r.block_)
        if r.slot_ <= last:
            n = r.slot_ + 1
            assert abs(len(had["a"]) - n / 4) <= 1 + 1e-9
