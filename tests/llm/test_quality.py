"""Counts against brute force, learned lists against held-out labels."""

import re
from collections import Counter

import numpy as np
from foliomill.llm import quality
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside)


def test_counts(spark):
    texts = [None, "", " \n\n", "a b c a b c a b c", "x\ny\nx\nx \n\n", "ü ñ é #*$%&|<>", "a a a a", "A! B? " * 5000]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    for t in texts:
        assert quality.text_counts(t)[:5] == plain_counts(t)


def test_covering_finds_planted_rules():
    draw = np.random.default_rng(1)
    x = {"a": draw.random(3000), "b": draw.random(3000), "c": draw.random(3000)}
    bad = ((x["a"] > 0.8) & (x["b"] <= 0.5)) | (x["c"] > 0.9)
    rules = quality.learn(x, bad)
    got = np.any([r.meets(x) for r in rules], axis=0)
    assert (got == bad).mean() > 0.97 and len(rules) <= 8
    assert all(sign in (">", "<=") for r in rules for _, sign, _ in r.conditions)


def test_no_rules_without_both_classes():
    x = {"a": np.arange(10.0)}
    assert quality.learn(x, np.zeros(10, bool)) == []
    assert quality.learn({"a": np.zeros(0)}, np.zeros(0, bool)) == []


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    rules = quality.fit(docs, train)
    rows = quality.judge(docs.join(test, "doc_id"), rules).select("quality", "quality_.*").collect()
    good, bad = [r for r in rows if r.quality], [r for r in rows if not r.quality]
    assert sum(r.rule is not None for r in good) <= 0.01 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)


def test_expression_equals_rules(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.fit(docs, labels)
    for r in quality.judge(docs, rules).select("text", "quality_.*").limit(200).collect():
        c = dict(zip(quality.COUNTS, quality.text_counts(r.text), strict=True))
        x = {
            "words": c["n_words"], "word_length": c["word_chars"] / max(1, c["n_words"]), "symbols": c["n_symbols"] / max(1, c["word_chars"]),
            "capitals": c["n_capitals"] / max(1, c["word_chars"]), "marks": c["n_marks"] / max(1, c["n_words"]),
            "repeated_lines": c["n_dup_lines"] / max(1, c["n_lines"]), "repeated_words": c["n_repeat_words"] / max(1, c["n_words"]),
            "distinct_words": c["n_distinct_words"] / max(1, c["n_words"]), "words_in_a_line": c["n_words"] / max(1, c["n_lines"]),
        }
        first = next((k for k, rule in enumerate(rules) if rule.meets({n: np.array([v]) for n, v in x.items()})[0]), None)
        assert r.rule == first
        assert r.base_failed == (c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"])
        assert r.kept == (not r.base_failed and first is None)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, "x " * 50000, 3)], "doc_id long, text string, n_words int")
    assert quality.fit(docs, spark.createDataFrame([(None, 0), (1, None), (77, 1)], "doc_id long, quality int")) == []
    rows = quality.judge(docs, []).collect()
    assert len(rows) == 4 and not any(r.quality_.kept for r in rows) and {r.n_words for r in rows} == {1, 2, 3}
    assert quality.judge(docs.limit(0), []).select(F.col("quality_.kept")).count() == 0


def test_an_id_on_all_rows_stays_within_the_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i} " * 60) for i in range(3000)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(quality, "learn", lambda x, bad, **_: seen.append(len(bad)) or [])
    for most in (1, 50):
        quality.fit(docs, spark.createDataFrame([(1, 0)], "doc_id long, quality int"), most_labelled=most)
    assert seen == [1, 50]


def best_first_condition(x, bad):
    """Information gain of every condition, one by one."""
    base, best = np.log2(bad.mean()), None
    for name, v in x.items():
        values = np.unique(v)
        for at in (values[1:] + values[:-1]) / 2:
            for sign, met in ((">", v > at), ("<=", v <= at)):
                hit = (met & bad).sum()
                if hit:
                    gain = hit * (np.log2(hit / met.sum()) - base)
                    if best is None or gain > best[0] + 1e-12:
                        best = (gain, name, sign, at)
    return best


def test_growing_takes_the_condition_of_most_gain():
    draw = np.random.default_rng(4)
    for _ in range(20):
        x = {n: draw.integers(0, 12, 80).astype(float) for n in "abc"}
        bad = (x["a"] + x["b"] + draw.normal(size=80) * 3) > 13
        if not bad.any() or bad.all():
            continue
        rule = quality._grow(x, bad, 1)
        assert rule.conditions == (best_first_condition(x, bad)[1:],)


def test_pruning_keeps_the_prefix_that_held_back_rows_speak_for():
    draw = np.random.default_rng(6)
    for _ in range(30):
        x = {n: draw.random(60) for n in "abc"}
        bad = draw.random(60) < x["a"]
        rule = quality.Rule((("a", ">", 0.5), ("b", "<=", draw.random()), ("c", ">", draw.random())))
        worths = []
        for k in range(1, 4):
            met = [all(x[n][i] > at if sign == ">" else x[n][i] <= at for n, sign, at in rule.conditions[:k]) for i in range(60)]
            p, n = sum(m and b for m, b in zip(met, bad, strict=True)), sum(m and not b for m, b in zip(met, bad, strict=True))
            worths.append((p - n) / max(1, p + n))
        assert len(quality._pruned(rule, x, bad)[0].conditions) == 1 + worths.index(max(worths))
