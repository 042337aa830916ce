"""Steps that go page by page: no group of its own for each page, and results equal to plain loops."""

import numpy as np
import pytest
from foliomill.operators import detection, order
from pyspark.sql import functions as F

BOX = "box struct<x1: int, y1: int, x2: int, y2: int>"


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def plain_iou(a, b) -> float:
    wide, high = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    shared = max(wide, 0) * max(high, 0)
    both = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared
    return shared / both if both else 0.0


def test_hits_equal_brute_force_without_a_group_for_each_page(spark):
    draw = np.random.default_rng(7)

    def boxes(n):
        return [tuple(map(int, (x, y, x + w, y + h))) for x, y, w, h in zip(*draw.integers(0, 4, (2, n)), *draw.integers(0, 9, (2, n)), strict=True)]

    pages = {p: (boxes(draw.integers(0, 6)), [(b, float(draw.choice([0.5, 0.9]))) for b in boxes(draw.integers(0, 8))]) for p in range(40)}
    truth = spark.createDataFrame([(p, i, b) for p, (t, _) in pages.items() for i, b in enumerate(t)], f"page int, idx int, {BOX}")
    found = spark.createDataFrame([(p, i, b, c) for p, (_, f) in pages.items() for i, (b, c) in enumerate(f)], f"page int, idx long, {BOX}, confidence double")
    want = []
    for p, (t, f) in pages.items():
        for at in (0.5, 0.75) if t else ():
            free = dict(enumerate(t))
            for i in sorted(range(len(f)), key=lambda i: (-f[i][1], i)):
                best = max(free, key=lambda k: (plain_iou(f[i][0], free[k]), -k), default=None)
                hit = best is not None and plain_iou(f[i][0], free[best]) >= at
                if hit:
                    del free[best]
                want.append((p, i, f[i][1], at, hit))
    got = detection.hits(truth, found, ["page"], [0.5, 0.75])
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(x[-1] for x in want)
    assert "CoGroup" not in plan(got) and "FlatMapGroups" not in plan(got)
    far = found.withColumn("box", F.struct(*[(F.col(f"box.{s}") + 1000).alias(s) for s in ("x1", "y1", "x2", "y2")]))
    assert not detection.hits(truth, far, ["page"]).filter("hit").count()


@pytest.mark.parametrize("name", ["heatmap", "hybrid"])
def test_raster_orders_stream_pages(spark, name):
    """Pages that are cut by small batches, of one zone and more, in one stream: each as if it were alone."""
    draw = np.random.default_rng(3)
    rows = []
    for p in range(30):
        for i in range(int(draw.integers(1, 9))):
            x, y, w, h = map(int, (draw.integers(0, 500), draw.integers(0, 400), draw.integers(1, 200), draw.integers(1, 60)))
            rows.append((p, i, (x, y, x + w, y + h), None if i % 3 else y))
    rows += [(99, 0, (-9, -90, -5, 12), None), (99, 1, (3, -80, 9, 14), None)]  # higher than the part of the page that is seen
    zones = spark.createDataFrame(rows, f"page int, idx int, {BOX}, first_y int")
    whole = order.reading_order(zones, ["page"], name, multiplier=2)
    assert "FlatMapGroups" not in plan(whole)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = sorted((r.page, r.idx, r.position) for r in whole.collect())
        alone = sorted((r.page, r.idx, r.position) for p in (0, 1, 2, 99) for r in order.reading_order(zones.filter(F.col("page") == p), ["page"], name, multiplier=2).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r for r in got if r[0] in (0, 1, 2, 99)] == alone and len({r[0] for r in got}) >= 30


@pytest.mark.parametrize("name", ["alto_lines", "alto_zones", "alto_page_texts", "alto_texts_in_order", "alto_score_boxes", "detector_polygons", "detector_split_counts"])
def test_pages_are_parsed_once(spark, name):
    from foliomill.plans import catalog

    rows = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1


def test_points_split_a_text_once(spark):
    from foliomill.functions import geometry as G

    texts = ["1,2 3,4", "1 2 3 4 5", " 1.9,-2.9\n\t3,x 5,6,7 8 ,9", "7", "", None, "a b 1 2", "1,", "  "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", G.points(F.col("t")).alias("p"), G.points(F.col("t"), strict=True).alias("s"), G.float_points(F.col("t")).alias("f"))
    made = got._jdf.queryExecution().optimizedPlan().toString()
    assert made.count("split(") <= 10, made.count("split(")
    flat = lambda p: None if p is None else [tuple(x) for x in p]
    got = {r.i: (flat(r.p), flat(r.s), flat(r.f)) for r in got.collect()}
    assert got[0] == ([(1, 2), (3, 4)], [(1, 2), (3, 4)], [(1.0, 2.0), (3.0, 4.0)])
    assert got[1][0] == got[1][1] == [(1, 2), (3, 4)] and got[2][0] == [(1, -2), (5, 6)] and got[2][1] is None
    assert got[3] == got[4] == got[5] == got[8] == ([], [], []) and got[6][0] == [(1, 2)] and got[6][1] is None and got[7][0] == []


def test_zone_map_has_no_group_for_each_page(spark):
    """Zones that meet others and zones that do not, on one page: numbers stay those of the page, and level ones alone need no Python."""
    kinds = "page int, side int, z int, points array<struct<x: int, y: int>>"
    at = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + 10), (x, y + 10)]
    rows = [(1, 0, 0, at(500, 0, 10)), (1, 0, 1, at(0, 0, 10)), (1, 1, 0, at(900, 0, 20)), (1, 1, 1, at(5, 0, 10)), (2, 0, 0, [(0, 0), (10, 0), (0, 10)])]
    cut = detection.page_cells(spark.createDataFrame(rows, kinds), ["page"])
    assert "FlatMapGroups" not in plan(cut) and "CoGroup" not in plan(cut)
    got = sorted((r.page, tuple(r.truth), tuple(r.found), r.area) for r in cut.collect())
    assert got == [(1, (), (0,), 200.0), (1, (), (1,), 50.0), (1, (0,), (), 100.0), (1, (1,), (), 50.0), (1, (1,), (1,), 50.0), (2, (0,), (), 50.0)]


def test_points_of_a_line_are_made_once(spark):
    """no filter on the points of lines is pushed below what makes them, which parsed each line's points a dozen times; decimals of a row are
    those of %.6f."""
    from foliomill.functions import geometry as G
    from foliomill.plans import catalog

    rows = catalog.QUERIES["detector_polygons"](spark, "/root/testdata/sf0.001")
    filters = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in x]
    assert filters and not [x for x in filters if "split(" in x or "regexp_replace(" in x]
    made = spark.range(5000).select((F.col("id") % 2100).cast("int").alias("x"), F.element_at(F.array(F.lit(128), F.lit(1024), F.lit(2100)), (F.col("id") % 3 + 1).cast("int")).alias("w"))
    unit = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("x") / F.col("w")))
    want = F.format_string("0 %.6f %.6f", unit, unit)
    assert made.filter(G.polygon_row(F.lit(0), F.array(F.struct("x", F.col("x").alias("y"))), F.col("w"), F.col("w")) != want).isEmpty()
