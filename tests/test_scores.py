"""Error rates, detection scores and roll-ups."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from foliomill.operators import detection, errors, rollup
from pyspark.sql import functions as F


def test_rates_and_worst(spark):
    pairs = spark.createDataFrame([("d", "p1", "abc", "abd"), ("d", "p2", "a b", ""), ("d", "p3", None, "x"), ("d", "p4", "same", "same")], "document string, page string, truth string, found string")
    edited = errors.with_edits(pairs)
    r = errors.rates(edited).first()
    assert (r.cer, r.wer) == (5 / 10, 4 / 4) and r.char_accuracy == 0.5 and r.total_chars == 8
    scores = errors.page_scores(edited, ["document", "page"])
    top = {x.rank: (x.file, x.cer) for x in errors.worst(scores, name=F.concat_ws("/", "document", "page")).collect()}
    assert top[1] == ("d/p2", 1.0) and top[2] == ("d/p1", 1 / 3) and top[5] == (None, None) and len(top) == 5
    none = errors.matched_lines(pairs.select("page", F.col("truth").alias("text")), pairs.select(F.lit("z").alias("page"), F.col("found").alias("text")), ["page"]).first()
    assert (none.cer, none.matched_lines) == (None, 0)


def plain_table(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j - 1] + (x != y), rows[-1][j] + 1, row[-1] + 1))
        rows.append(row)
    return rows


def plain_distance(a, b):
    return plain_table(a, b)[-1][-1]


def plain_alignment(a, b):
    """From the ends: equal symbols, else the first of substitution, deletion and insertion that is on a cheapest way."""
    rows, out, i, j = plain_table(a, b), [], len(a), len(b)
    while (i, j) != (0, 0):
        ways = [((i - 1, j - 1), None, i and j and a[i - 1] == b[j - 1], 0), ((i - 1, j - 1), "substitution", i and j, 1)]
        ways += [((i - 1, j), "deletion", i, 1), ((i, j - 1), "insertion", j, 1)]
        (k, m), name, _, _ = next(w for w in ways if w[2] and rows[w[0][0]][w[0][1]] + w[3] == rows[i][j])
        if name:
            out.append((name, a[i - 1] if k < i else "", b[j - 1] if m < j else ""))
        i, j = k, m
    return out[::-1]


def test_alignment_is_cheapest():
    draw = random.Random(0)
    for _ in range(200):
        a, b = ("".join(draw.choice("abc") for _ in range(draw.randint(0, 8))) for _ in range(2))
        got = errors.alignment(a, b)
        assert len(got) == plain_distance(a, b) and got == plain_alignment(a, b)
    a = [str(draw.randint(0, 30)) for _ in range(700)]
    b = [x for x in a if draw.random() < 0.9] + ["end"]
    assert errors.alignment(a, b) == plain_alignment(a, b)


def test_operations(spark):
    pairs = spark.createDataFrame([("a b c", "a x c"), ("a b", "a"), ("é", "e"), ("q", "q")], "truth string, found string")
    got = {(r.operation, r.truth, r.found): r.n for r in errors.operations(pairs).collect()}
    assert got == {("substitution", "b", "x"): 1, ("deletion", "b", ""): 1, ("substitution", "é", "e"): 1}
    signs = {(r.operation, r.truth): r.n for r in errors.operations(pairs, level="character").collect()}
    assert signs["substitution", "é"] == 1


def test_pairing_modes(spark):
    truth = spark.createDataFrame([(p, i, t) for p, ts in {1: ["a", " ", "c"], 2: ["a", "b", "c"], 3: ["a"], 4: [" "]}.items() for i, t in enumerate(ts)], "page int, idx int, text string")
    found = spark.createDataFrame([(1, 0, "x\ny\nz"), (2, 0, "x\ny"), (3, 0, "q"), (3, 1, "r"), (4, 0, "s")], "page int, idx int, text string")
    got = sorted(tuple(r) for r in errors.pairing_modes(truth, found, ["page"]).collect())
    assert got == [(1, "line", 0, "a", "x"), (1, "line", 2, "c", "z"), (2, "joined", 0, "a b c", "x y"), (3, "whole", 0, "a", "q r")]


def shoelace(p):
    return abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(p, [*p[1:], p[0]], strict=True))) / 2


def test_cells_areas():
    draw = np.random.default_rng(2)
    for _ in range(20):
        angles = np.sort(draw.uniform(0, 2 * np.pi, 7))
        a = [(10 * np.cos(t), 8 * np.sin(t)) for t in angles]
        b = [(x + 5, y + 3) for x, y in a]
        areas, inside = detection.cells([np.array(a), np.array(b)])
        assert areas[inside[:, 0]].sum() == pytest.approx(shoelace(a)) and areas[inside[:, 1]].sum() == pytest.approx(shoelace(b))
        points = draw.uniform(-15, 20, (20000, 2))
        within = lambda poly: np.logical_xor.reduce([
            ((y1 > points[:, 1]) != (y2 > points[:, 1])) & (points[:, 0] < x1 + (points[:, 1] - y1) * (x2 - x1) / (y2 - y1))
            for (x1, y1), (x2, y2) in zip(poly, [*poly[1:], poly[0]], strict=True)])
        both = (within(a) & within(b)).mean() * 35 * 35
        assert areas[inside[:, 0] & inside[:, 1]].sum() == pytest.approx(both, abs=9)


def box(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]


def plain_stats(gt, dt, need_text=True):
    """Zone scores of a page of rectangles, by sets of unit squares."""
    squares = lambda b: {(x, y) for x in range(b[0], b[2]) for y in range(b[1], b[3])}
    g, d = [squares(b) for b, _ in gt], [squares(b) for b, _ in dt]
    out = dict.fromkeys(detection.STATS, 0)
    if not gt:
        return out
    out["gt_area"] = sum(map(len, g))
    if not dt:
        return out | {"area_miss": out["gt_area"], "n_miss": len(gt)}
    strength = {(i, j): (len(x & y) / len(x)) ** 2 + (len(x & y) / len(y)) ** 2 for i, x in enumerate(g) for j, y in enumerate(d) if x & y}
    links, rows = [], []
    for i, j in sorted(strength, key=lambda k: (-strength[k], k)):
        gone = set().union(*(g[a] for a, b in links if b == j), *(d[b] for a, b in links if a == i))
        left = g[i] - gone
        if left & d[j] and len(left & d[j]) / len(left) > 0.2:
            links.append((i, j))
            n_gt, n_dt = sum(b == j for _, b in links), sum(a == i for a, _ in links)
            kind = "match" if n_gt == n_dt == 1 else "split" if n_gt == 1 else "merge" if n_dt == 1 else "multiple"
            factor = {"match": 1, "split": 0.5 * n_dt, "merge": 0.5 * n_gt, "multiple": 0.5 * (n_gt + n_dt)}[kind]
            rows.append((kind, {i}, {j}, factor * len(left & d[j]), 1))
    for i, x in enumerate(g):
        rest = x - set().union(*(d[b] for a, b in links if a == i))
        if rest and (gt[i][1].strip() or not need_text):
            rows.append(("miss", {i}, set(), len(rest), i not in {a for a, _ in links}))
    for j, y in enumerate(d):
        rest = y - set().union(*(g[a] for a, b in links if b == j))
        if rest and (dt[j][1].strip() or not need_text):
            rows.append(("false_alarm", set(), {j}, len(rest), j not in {b for _, b in links}))
    for kind, _, _, area, counts in rows:
        out[f"area_{kind}"] += area
        out[f"n_{kind}"] += counts
    used = (set(), set())
    for wanted in ("multiple", "split", "merge", "match", "miss", "false_alarm"):
        for kind, a, b, *_ in rows:
            if kind != wanted:
                continue
            more = ({x for x, y in links if y in b}, {y for x, y in links if x in a})
            if wanted == "multiple":
                a, b = more
            elif (wanted != "merge" and a & used[0]) or (wanted != "split" and b & used[1]):
                continue
            elif wanted in ("split", "merge"):
                a, b = (a, more[1]) if wanted == "split" else (more[0], b)
            a, b = a - used[0], b - used[1]
            used[0].update(a)
            used[1].update(b)
            text = lambda side, own: "".join(side[i][1] for i in sorted(own, key=lambda i: (side[i][0][1], side[i][0][0], i)))
            x, y = text(gt, a), text(dt, b)
            out["edits"] += plain_distance(x, y)
            out["gt_chars"] += len(x)
            out["dt_chars"] += len(y)
            out["gt_words"] += len(x.split())
            out["dt_words"] += len(y.split())
            out["word_hits"] += sum((Counter(x.split()) & Counter(y.split())).values())
    return out


POINTS = "array<struct<x: int, y: int>>"
ZONES = f"page int, idx int, boundary {POINTS}, baseline {POINTS}, text string"


def stats(spark, pages, **options):
    """zone_map() of (gt, dt) pages of (box, text), in the order given."""
    sides = [spark.createDataFrame([(p, i, box(*b), None, t) for p, both in enumerate(pages) for i, (b, t) in enumerate(both[k])], ZONES) for k in (0, 1)]
    rows = {r.page: r.asDict() for r in detection.zone_map(*sides, ["page"], **options).collect()}
    return [rows[p] if p in rows else dict.fromkeys(detection.STATS, 0) for p in range(len(pages))]


def test_zone_map_configurations(spark):
    whole = ((0, 0, 10, 10), "ab c")
    pages = [
        ([whole], [((0, 0, 10, 10), "ab d")]), ([((0, 0, 10, 10), "ab")], [((20, 20, 30, 30), "xyz")]),
        ([((0, 0, 10, 10), "ab")], [((0, 0, 10, 6), "a"), ((0, 6, 10, 10), "b")]),
        ([((0, 0, 10, 6), "a"), ((0, 6, 10, 10), "b")], [((0, 0, 10, 10), "ab")]), ([((0, 0, 10, 10), "ab")], []),
        ([], [((0, 0, 1, 1), "x")]), ([((0, 0, 10, 10), "")], [((20, 20, 30, 30), "")]),
    ]
    one, miss, split, merge, none, empty, silent = stats(spark, pages)
    assert (one["area_match"], one["n_match"], one["edits"], one["word_hits"], one["gt_chars"]) == (100, 1, 1, 1, 4)
    assert (miss["n_miss"], miss["n_false_alarm"], miss["area_miss"], miss["area_false_alarm"], miss["edits"]) == (1, 1, 100, 100, 5)
    assert (split["n_match"], split["n_split"], split["area_match"], split["area_split"]) == (1, 1, 60, 40)
    assert (merge["n_match"], merge["n_merge"]) == (1, 1)
    assert (none["area_miss"], none["n_miss"], none["edits"]) == (100, 1, 0)
    assert empty["gt_area"] == 0 and silent["n_miss"] == 0
    assert stats(spark, pages, need_text=False)[6]["n_miss"] == 1


def test_zone_map_equals_unit_squares(spark):
    draw = random.Random(3)

    def zones(n):
        out = []
        for _ in range(n):
            x, y = draw.randint(0, 14), draw.randint(0, 14)
            out.append(((x, y, x + draw.randint(1, 9), y + draw.randint(1, 9)), draw.choice(["", "a b", "é c", "a", "b b a"])))
        return out

    pages = [(zones(draw.randint(1, 5)), zones(draw.randint(0, 5))) for _ in range(60)]
    for need_text in (True, False):
        for got, (gt, dt) in zip(stats(spark, pages, need_text=need_text), pages, strict=True):
            want = plain_stats(gt, dt, need_text)
            assert {k: got[k] for k in want} == pytest.approx(want), (gt, dt)


def test_zone_map_on_pages(spark):
    points = "array<struct<x: int, y: int>>"
    kinds = f"page int, idx int, boundary {points}, baseline {points}, text string"
    truth = spark.createDataFrame([(1, 0, box(0, 0, 10, 10), None, "ab"), (2, 0, None, [(0, 50), (100, 50)], "cd")], kinds)
    found = spark.createDataFrame([(1, 0, box(0, 0, 10, 10), None, "ab"), (3, 0, box(0, 0, 5, 5), None, "z")], kinds)
    rows = {r.page: r for r in detection.zone_map(truth, found, ["page"]).collect()}
    assert rows[1].area_match == 100 and rows[2].area_miss == 2000 and rows[3].gt_area == 0 and len(rows) == 3
    total = detection.zone_map_scores(detection.zone_map(truth, found, ["page"])).first()
    assert total.score == round(100 * 2000 / 2100, 4) and total.char_recall == 1.0 and total.n_miss == 1


def test_average_precision(spark):
    kinds = "page int, idx long, box struct<x1: int, y1: int, x2: int, y2: int>"
    truth = spark.createDataFrame([(1, 0, (0, 0, 10, 10)), (1, 1, (20, 0, 30, 10)), (2, 0, (0, 0, 10, 10))], kinds)
    found = spark.createDataFrame([(1, 0, (0, 0, 10, 10)), (1, 1, (0, 0, 10, 9)), (1, 2, (20, 0, 30, 6))], kinds).withColumn("confidence", F.when(F.col("idx") == 2, 0.5).otherwise(1.0))
    rows = {r.threshold: r for r in detection.average_precision(detection.hits(truth, found, ["page"]), truth).collect()}
    assert rows[0.5].recall == pytest.approx(2 / 3) and rows[0.5].precision == pytest.approx(2 / 3)
    assert rows[0.5].ap == pytest.approx(2 / 3 * 2 / 3) and rows[0.95].ap == pytest.approx(1 / 2 / 3)


def test_average_precision_of_many_levels(spark):
    draw = random.Random(4)
    rows = [(0.5, draw.choice([0.1, 0.1004, 0.1009, 0.5, draw.random(), 1.0]), draw.random() < 0.6) for _ in range(300)]
    hit = spark.createDataFrame(rows, "threshold double, confidence double, hit boolean")
    points, tp, n = [], 0, 0
    for c in sorted({c for _, c, _ in rows}, reverse=True):
        tp += sum(h for _, x, h in rows if x == c)
        n += sum(x == c for _, x, _ in rows)
        points.append((tp / n, tp / 250))
    want = sum(max(p for p, _ in points[i:]) * (r - (points[i - 1][1] if i else 0)) for i, (_, r) in enumerate(points))
    for stretches in (1, 10, 1000):
        got = detection.average_precision(hit, 250, stretches=stretches).first()
        assert got.ap == pytest.approx(want) and (got.precision, got.recall) == pytest.approx(points[-1])


def test_rollups(spark):
    wide = spark.createDataFrame([("a", 0.1, 10.0, "French", 1), ("b", 0.3, None, "English", 100), ("c", 0.5, 5.0, None, 2)], "document string, cer double, n double, language string, pages int")
    rows = rollup.over_documents(rollup.long_form(wide, ["document"], ["cer"], "score/").unionByName(rollup.long_form(wide, ["document"], ["n"], "total/")))
    assert {r.key: r.value for r in rows.collect()} == {"score/cer": pytest.approx(0.3), "total/n": 15.0}
    by = rollup.by_feature(wide, ["language"], ["cer"])
    got = {r.value: (r["mean"], r["std"], r.n, r.pages) for r in by.collect()}
    assert got == {"French": (0.1, None, 1, 1), "English": (0.3, None, 1, 100)}
    assert rollup.macro_average(by).first().value == pytest.approx(0.2)
    family = rollup.by_family(by).first()
    assert (family.romance, family.other) == (0.1, 0.3)


def test_regression(spark):
    draw = np.random.default_rng(0)
    x = draw.normal(size=40)
    y = 2 * x + draw.normal(size=40)
    points = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y, strict=True)] + [("flat", 1.0, 2.0)] * 3, "g string, x double, y double")
    r = rollup.regression(points, "x", "y", ["g"]).collect()
    assert len(r) == 1 and r[0].slope == pytest.approx(np.polyfit(x, y, 1)[0]) and r[0].p_value < 1e-6
    assert rollup.two_sided(0.25, 12) == pytest.approx(0.0978, abs=5e-4) and math.isnan(rollup.two_sided(0.5, 2)) and rollup.two_sided(1.0, 5) == 0.0


def test_resampling(spark):
    rows = spark.createDataFrame([(i, 9.0 if i == 3 else 0.0) for i in range(10)], "id int, density double")
    weighted = rollup.sample_weights(rows)
    got = {r.id: r.copies for r in rollup.resampled(weighted, "id", 19000, parts=4).collect()}
    assert sum(got.values()) == 19000 and abs(got[3] - 10000) < 500 and all(abs(got[i] - 1000) < 200 for i in got if i != 3)
    assert rollup.resampled(weighted.limit(0), "id", 10).count() == 0


def test_resampling_equals_a_walk_along_the_line(spark):
    """Draws by draws against a plain search, whatever the ranges; weights of zero and null are never drawn; no join on a range."""
    draw = np.random.default_rng(7)
    weights = [(i, float(w)) for i, w in enumerate(draw.choice([0.0, 0.5, 1.0, 30.0], size=300))] + [(300, None), (301, -1.0)]
    frame = spark.createDataFrame(weights, "id long, weight double").repartition(7)
    points = {r.draw: r.u for r in rollup.draws(spark, 5000, 3).collect()}
    ends = np.cumsum([max(0.0, w or 0.0) for _, w in weights])
    want = np.bincount(np.searchsorted(ends, [u * ends[-1] for u in points.values()], side="right"), minlength=302)
    for parts in (1, 3, 16):
        rows = rollup.resampled(frame, "id", 5000, seed=3, parts=parts)
        assert {r.id: r.copies for r in rows.collect()} == {i: n for i, n in enumerate(want.tolist()) if n}
    assert "CartesianProduct" not in rows._jdf.queryExecution().toString() and "NestedLoop" not in rows._jdf.queryExecution().toString()


def test_last_before(spark):
    marks = spark.createDataFrame([(1.0, 5), (1.0, 7), (4.0, 2)], "at double, k int")
    points = spark.createDataFrame([(0.5, "a"), (1.0, "b"), (3.9, "c"), (4.0, "d"), (9.0, "e")], "at double, name string")
    for parts in (1, 5):
        got = {r.name: r.k for r in rollup.last_before(points, marks, "at", "k", parts=parts).collect()}
        assert got == {"a": None, "b": 7, "c": 7, "d": 2, "e": 2}

def test_zone_map_keeps_only_pages_whose_zones_meet(spark, monkeypatch):
    """of pages whose level zones share no area only sums are written; they are what all pages' cells and links give, whichever page
    has how many zones. Null pages and documents, zones without a place, empty, level and other polygons."""
    draw, rows, points = random.Random(11), [], lambda b: [(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3])]
    for p in range(60):
        for i in range(draw.choice([1, 2, 3, 4, 5])):
            x, y = draw.randint(0, 90), draw.randint(0, 90)
            shape = points((x, y, x + draw.randint(0, 20), y + draw.randint(0, 20)))
            kind, line = draw.randint(0, 11), [(x, y), (x + 30, y)]
            shape, line = (shape[:3], None) if kind == 0 else (None, line) if kind == 1 else (None, None) if kind == 2 else (shape, None)
            rows.append((None if p == 7 else "d", None if p in (7, 8) else p, draw.randint(0, 1), i, shape, line, draw.choice([None, "", " ", "a b", "é"])))
    zones = spark.createDataFrame(rows, f"doc string, page int, side int, idx int, boundary {POINTS}, baseline {POINTS}, text string").repartition(3)
    sides = [zones.filter(F.col("side") == k).drop("side") for k in (0, 1)]
    written, sizes = detection.written, {}

    def counted(df, name):
        out = written(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(detection, "written", counted)
    for options in ({}, {"need_text": False}, {"with_text": False}):
        some = sorted(detection.zone_map(*sides, ["doc", "page"], **options).collect(), key=str)
        kept = sizes["zones"]
        for most in (0, 3):
            assert sorted(detection.zone_map(*sides, ["doc", "page"], most=most, **options).collect(), key=str) == some
        assert 0 < kept < len(rows) * 0.8 and len(some) == 60
    far = spark.createDataFrame([(p, s, 0, points((50 * s, 0, 50 * s + 10, 10)), None, "a b") for p in range(9) for s in (0, 1)], f"page int, side int, {ZONES[10:]}")
    sizes.clear()
    got = detection.zone_map(*[far.filter(F.col("side") == k).drop("side") for k in (0, 1)], ["page"]).collect()
    assert {(r.area_miss, r.area_false_alarm, r.gt_area, r.n_miss, r.edits, r.gt_words) for r in got} == {(100.0, 100.0, 100.0, 1, 6, 2)}
    assert not sizes.get("zones") and len(got) == 9
