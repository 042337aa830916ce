"""Geometry, box joins and reading order."""

import random

import numpy as np
import pytest
from foliomill.functions import geometry as G
from foliomill.operators import boxes, order
from pyspark.sql import functions as F

BOX = "struct<x1: int, y1: int, x2: int, y2: int>"


def frame(spark, rows):
    return spark.createDataFrame(rows, f"page int, idx int, box {BOX}")


def some_boxes(n, seed, pages=4):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x, y = r.randrange(0, 400), r.randrange(0, 400)
        out.append((r.randrange(pages), i, (x, y, x + r.randrange(1, 200), y + r.randrange(1, 200))))
    return out


def plain_iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    shared = w * h if w > 0 and h > 0 else 0
    return shared / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared)


def test_iou_and_grid(spark):
    at = lambda *v: G.box(*[F.lit(x) for x in v])
    row = spark.range(1).select(
        G.iou(at(0, 0, 100, 100), at(50, 50, 150, 150)).alias("a"), G.iou(at(0, 0, 1, 1), at(2, 2, 3, 3)).alias("b"), G.iou(at(1, 1, 5, 5), at(1, 1, 5, 5)).alias("c"),
        G.iou(at(1, 1, 1, 1), at(1, 1, 1, 1)).alias("d"), G.on_grid(at(100, 50, 300, 150), F.lit(640), F.lit(480)).alias("e"),
    ).first()
    assert (row.a, row.b, row.c, row.d, tuple(row.e)) == (2500 / 17500, 0.0, 1.0, 0.0, (15, 10, 46, 31))


def test_points(spark):
    cases = {"1,2 3,4": 2, "1 2 3 4 5": 2, "1,2 x,y 3,4": 2, "": 0, None: 0, "1 2 x 4 5 6": 2, "1.9,2.9": 1}
    for t, n in cases.items():
        found = spark.createDataFrame([(t,)], "t string").select(G.points(F.col("t")).alias("p"), G.points(F.col("t"), strict=True).alias("s")).first()
        assert len(found.p) == n
        assert (found.s is None) == (t in ("1,2 x,y 3,4", "1 2 x 4 5 6"))
    assert tuple(spark.createDataFrame([("1.9,2.9",)], "t string").select(G.points(F.col("t"))[0]).first()[0]) == (1, 2)


def test_tags_types_and_rows(spark):
    row = spark.range(1).select(
        G.tag_id(F.lit("MainZone")).alias("a"), G.line_type(F.array(F.lit("line type headingline"))).alias("b"), G.line_type(F.array(F.lit("x"))).alias("c"),
        G.detection_row(F.lit(1), G.box(F.lit(0), F.lit(0), F.lit(320), F.lit(960)), F.lit(640), F.lit(480)).alias("d"),
        G.polygon_row(F.lit(2), F.expr("array(named_struct('x', 64, 'y', 960))"), F.lit(640), F.lit(480)).alias("e"),
        G.degenerate(F.expr("array(named_struct('x', 1, 'y', 2), named_struct('x', 1, 'y', 2))")).alias("f"),
    ).first()
    assert tuple(row) == (43014, "HeadingLine", "DefaultLine", "1 0.250000 1.000000 0.500000 1.000000", "2 0.100000 1.000000", True)


@pytest.mark.parametrize("crowd", [None, 4096, 30, 3])
def test_suppression_and_assignment(spark, crowd):
    rows = some_boxes(160, 2)
    gone = set()
    for p, i, a in rows:
        for q, j, b in rows:
            if p == q and i < j and plain_iou(a, b) > 0.5:
                small = (a[2] - a[0]) * (a[3] - a[1]) < (b[2] - b[0]) * (b[3] - b[1])
                gone.add(i if small else j)
    got = boxes.suppressed(frame(spark, rows), ["page"], crowd=crowd)
    assert {r.idx for r in got.collect()} == {i for _, i, _ in rows} - gone and gone
    zones, lines = rows[:40], rows[40:]
    want = {}
    for p, i, a in lines:
        best = [(plain_iou(a, b), -j) for q, j, b in zones if q == p and plain_iou(a, b) >= 0.001]
        want[i] = -max(best)[1] if best else None
    found = boxes.assigned(frame(spark, lines), frame(spark, zones), ["page"], crowd=crowd).collect()
    assert {r.idx: r.zone for r in found} == want


def test_a_crowded_page_is_cut_into_cells(spark):
    """One page of 20,000 boxes: the same links as by a plain sweep, and no task that meets all of it."""
    draw = np.random.default_rng(2)
    low = draw.integers(0, 20_000, size=(20_000, 2))
    size = draw.integers(5, 60, size=(20_000, 2))
    x = np.concatenate([low, low + size], 1)
    rows = [(1, i, tuple(map(int, b))) for i, b in enumerate(x)] + [(1, 20_000, (0, 0, 20_100, 20_100)), (2, 0, (0, 0, 5, 5)), (2, 1, (4, 4, 9, 9))]
    x = np.concatenate([x, [(0, 0, 20_100, 20_100)]])
    want = set()
    order_ = np.argsort(x[:, 0], kind="stable")
    starts = x[order_, 0]
    for k in order_.tolist():
        near = order_[: np.searchsorted(starts, x[k, 2])]
        hit = near[(x[near, 2] > x[k, 0]) & (x[near, 1] < x[k, 3]) & (x[near, 3] > x[k, 1]) & (near > k)]
        want |= {(1, k, j) for j in hit.tolist()}
    got = boxes.overlaps(frame(spark, rows), frame(spark, rows), ["page"], F.col("a_idx") < F.col("b_idx"), crowd=500)
    assert {(r.page, r.a_idx, r.b_idx) for r in got.collect()} == want | {(2, 0, 1)}
    grid = boxes.crowded([boxes._flat(frame(spark, rows), ["page"], "a")], ["page"], 500).collect()
    assert len(grid) == 1 and 20_100 / grid[0].wide == pytest.approx(7)


def test_chain_of_doubles(spark):
    rows = [(1, 0, (0, 0, 100, 100)), (1, 1, (0, 0, 100, 60)), (1, 2, (0, 0, 100, 33))]
    assert [r.idx for r in boxes.suppressed(frame(spark, rows), ["page"]).collect()] == [0]


def ordered(spark, rows, name, **options):
    zones = order.with_first_y(frame(spark, rows), None, ["page"])
    return [r.idx for r in order.reading_order(zones, ["page"], name, **options).orderBy("page", "position").collect()]


def test_columns(spark):
    rows = [(1, k, (x, y, x + 10, y + 10)) for k, (x, y) in enumerate([(600, 0), (0, 50), (250, 0), (0, 0), (600, 90)])]
    assert ordered(spark, rows, "dbscan") == [3, 2, 1, 0, 4]
    assert ordered(spark, rows, "none") == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="nothing"):
        ordered(spark, rows, "nothing")
    assert ordered(spark, [], "dbscan") == [] == ordered(spark, [], "heatmap")


def test_bands_and_gutters(spark):
    # a heading, a white gap, then two columns of four lines each
    rows = [(1, 0, (10, 10, 390, 30))]
    rows += [(1, 1 + k, (10 + 210 * c, 100 + 25 * y, 180 + 210 * c, 120 + 25 * y)) for k, (y, c) in enumerate((y, c) for y in range(8) for c in (1, 0))]
    columns = [0, *[2 + 2 * y for y in range(8)], *[1 + 2 * y for y in range(8)]]
    assert ordered(spark, rows, "heatmap") == columns
    assert ordered(spark, rows, "hybrid", eps=100) == columns
    assert ordered(spark, [(1, 0, (0, 0, 5, 5))], "heatmap") == [0]


def test_profile_equals_a_raster():
    draw = np.random.default_rng(0)
    b = draw.integers(-5, 60, (12, 4))
    b = np.column_stack([b[:, 0], b[:, 1], b[:, 0] + abs(b[:, 2]) % 30, b[:, 1] + abs(b[:, 3]) % 30]).astype(float)
    image = np.zeros((70, 80), bool)
    for x1, y1, x2, y2 in b.astype(int):
        image[max(y1, 0) : max(y2, 0), max(x1, 0) : max(x2, 0)] = True
    for axis in (0, 1):
        assert (order._profile(b, (70, 80), axis) == image.sum(axis=axis)).all()


def test_peaks():
    assert order.peaks(np.array([0, 3, 0, 1, 1, 0, 5, 4, 6, 0]), 1) == [1, 3, 6, 8]
    assert order.peaks(np.array([0, 3, 0, 1, 1, 0, 5, 4, 6, 0]), 2) == [1, 8]
    assert order.peaks(np.array([3, 1, 3]), 1) == [] == order.peaks(np.array([1.0]), 1)


def test_repeats_and_chunks(spark):
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(["a", "a", "b", "", "", "b", "b"])], "page int, idx int, text string")
    assert [r.text for r in order.without_repeats(rows, ["page"]).orderBy("idx").collect()] == ["a", "b", "", "", "b"]
    assert [r.chunk for r in order.chunks(rows, ["page"], size=3).orderBy("idx").collect()] == [0, 0, 0, 1, 1, 1, 2]


def raster_order(zones, strategy, eps=300, multiplier=5, window=15, divisor=4):
    """Positions of zones (box, first_y) by drawing them: bands between white rows, then columns."""
    boxes_ = [b for b, _ in zones]
    if len(zones) == 1:
        return [0]
    height, width = max(b[3] for b in boxes_) + 1, max(b[2] for b in boxes_) + 1
    page = np.zeros((height, width), bool)
    for x1, y1, x2, y2 in boxes_:
        page[y1:y2, x1:x2] = True
    smooth = lambda v, w: [sum(v[k] for k in range(i - (w - 1) // 2 - (w % 2 == 0), i + (w - 1) // 2 + 1) if 0 <= k < len(v)) / w for i in range(len(v))]
    median = float(np.median([b[3] - b[1] for b in boxes_]))
    rows = [int(v) for v in smooth(page.sum(1).tolist(), max(1, int(median / 2)))]
    gaps, run = [], []
    for i, v in enumerate([*rows, 1]):
        if v == 0:
            run.append(i)
        elif run:
            gaps.append(run[len(run) // 2])
            run = []
    edges = [0, *gaps, height]
    keys = [None] * len(zones)
    for k, (top, end) in enumerate(zip(edges, edges[1:])):  # noqa: B905
        own = [i for i, b in enumerate(boxes_) if top < (b[1] + b[3]) / 2 <= end]
        thin = end - top < multiplier * median
        x = {i: (boxes_[i][0] + boxes_[i][2]) / 2 for i in own}
        if strategy == "hybrid":
            column, last = 0, None
            for i in sorted(own, key=lambda i: x[i]):
                column += last is not None and x[i] - last > (width if thin else eps)
                last = x[i]
                keys[i] = (k, column, zones[i][1], x[i])
        elif own:
            cuts = [-np.inf, np.inf]
            if not thin:
                drawn = np.zeros((end - top, width), bool)  # zones that reach over an edge are cut there
                for x1, y1, x2, y2 in boxes_:
                    drawn[max(0, min(y1 - top, end - top)) : max(0, min(y2 - top, end - top)), x1:x2] = True
                low = [-v for v in smooth(drawn.sum(0).tolist(), window)]
                cuts = [0, *plain_peaks(low, (end - top) // divisor), width + 1]
            for c, (a, b) in enumerate(zip(cuts, cuts[1:])):  # noqa: B905
                for i in own:
                    if a < x[i] <= b:
                        keys[i] = (k, c, zones[i][1], boxes_[i][0])
    return sorted((i for i, key in enumerate(keys) if key is not None), key=lambda i: (keys[i], i))


def plain_peaks(v, prominence):
    """Middles of flat tops that fall on both sides, and by prominence before a higher value on either."""
    out, i = [], 1
    while i < len(v) - 1:
        j = i
        while j + 1 < len(v) and v[j + 1] == v[i]:
            j += 1
        if v[i - 1] < v[i] and j + 1 < len(v) and v[j + 1] < v[i]:
            left = next((k for k in range(i - 1, -1, -1) if v[k] > v[i]), -1)
            right = next((k for k in range(j + 1, len(v)) if v[k] > v[i]), len(v))
            if v[i] - max(min(v[left + 1 : i + 1]), min(v[i:right])) >= prominence:
                out.append((i + j) // 2)
        i = j + 1
    return out


@pytest.mark.parametrize("strategy", ["heatmap", "hybrid"])
def test_raster_orders_equal_drawn_pages(spark, strategy):
    draw, rows, pages = random.Random(12), [], []
    for p in range(40):
        zones = []
        for _ in range(draw.randint(1, 9)):
            x, y = draw.randint(0, 3) * 120 + draw.randint(0, 20), draw.randint(0, 4) * 70 + draw.randint(0, 10)
            zones.append(((x, y, x + draw.randint(20, 110), y + draw.randint(5, 65)), y + draw.randint(0, 5)))
        pages.append(zones)
        rows += [(p, i, b, f) for i, (b, f) in enumerate(zones)]
    for multiplier in (5, 1):
        got = order.reading_order(spark.createDataFrame(rows, f"page int, idx int, box {BOX}, first_y int"), ["page"], strategy, eps=100, multiplier=multiplier)
        by = {}
        for r in got.orderBy("page", "position").collect():
            by.setdefault(r.page, []).append(r.idx)
        assert [by.get(p, []) for p in range(40)] == [raster_order(z, strategy, eps=100, multiplier=multiplier) for z in pages]
