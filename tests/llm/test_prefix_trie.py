"""The trie against one built turn by turn."""

import hashlib
import zlib

import pytest
from foliomill.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, n_convs long"


def brute(rows, every=5, most_taken=8):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most_taken + 1)
        whole[c] = own.get(c - c % every, [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for k, ids in members.items():
        below = [x for x in members if x[: len(k)] == k]
        leaves = sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in members) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0 for x in below)
        ends = ",".join(map(str, sorted(c for c in ids if len(whole[c]) == len(k))))
        kids = sum(len(x) == len(k) + 1 for x in below)
        out.append((min(ids), len(k), min(members[k[:-1]]) if k else None, len(ids), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    found = prefix_trie.prefix_trie(frame, **options)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def test_shared_starts_copies_and_branches(spark):
    """Conversations that share turns by rebuilding and by themselves, that end inside others, and whole copies."""
    rows = []
    for c in range(60):
        for t in range(c % 7 + 1):
            rows.append((c, t, ("user", "assistant")[t % 2], f"turn {t} of {min(t, c % 3)} é"))
    rows += [(100 + c, t, "user", f"same {t}") for c in range(40) for t in range(4)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, every=1) == brute(rows, every=1)
    assert run(spark, rows, every=7, most_taken=0) == brute(rows, every=7, most_taken=0)


def test_one_conversation_with_most_turns_and_a_deep_comb(spark):
    """Each conversation leaves the longest one a turn later, so stretches hang from one path at every depth."""
    rows = [(0, t, "user", f"t{t}") for t in range(400)]
    rows += [(5 * k, t, "user", f"t{t}" if t < k else "off") for k in range(1, 12) for t in range(k + 1)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "a", "z"), (2, 5, "user", "x" * 200_000), (3, 1, None, "é😀"), (None, 0, "user", "lost")]
    rows += [(-7, 0, "user", "below"), (-7, 1, "user", "zero"), (10, 3, "user", "b"), (10, None, "user", "a"), (14, 0, "user", "own")]
    want = brute([r for r in rows if r[0] != -7])
    assert run(spark, [r for r in rows if r[0] != -7]) == want
    assert len(run(spark, rows)) >= len(want)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "x")]) == []


def test_parameters_that_make_no_sense(spark):
    for bad in ({"every": 0}, {"most_taken": -1}):
        with pytest.raises(ValueError):
            prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA), **bad)


def test_sums_over_ranges(spark):
    """A key with most rows is summed over several tasks."""
    from pyspark.sql import functions as F

    rows = [(k, i) for k in range(5) for i in range(300 if k == 2 else 7)]
    frame = spark.createDataFrame(rows, "k long, i long").withColumn("s", F.col("i"))
    got = prefix_trie.running(frame, "k", [F.col("i").desc()], ["s"], ["k", "i", "s"], "test")
    assert sorted(map(tuple, got.collect())) == sorted((k, i, sum(j for q, j in rows if q == k and j >= i)) for k, i in rows)
