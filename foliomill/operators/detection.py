"""Scores of detected zones and lines: mean average precision, and areas of matched, missed, split and merged zones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.functions import geometry as G
from foliomill.functions import text as T
from foliomill.operators import boxes, errors, stream
from foliomill.sinks.paths import written

THRESHOLDS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
CONFIGS = ("match", "miss", "false_alarm", "split", "merge", "multiple")


def hits(truth: DataFrame, found: DataFrame, page: Sequence[str], thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """(page columns, idx, confidence, threshold, hit) of every found box on pages where both sides have boxes.

    On a page boxes are taken by falling confidence, then idx; each takes the free true box of most IoU, if that is
    threshold (over 0) or more. A null confidence is 0. A null page meets none. Pairs below the least threshold decide nothing, so
    Spark joins the others; only boxes that have such a pair are matched one by one, those of a page together.
    """
    page = list(page)
    exact = F.col("box").cast("struct<x1: double, y1: double, x2: double, y2: double>")
    sides = [exact[s] for s in boxes.SIDES]
    along = Window.partitionBy(*page)
    number = lambda *by: F.row_number().over(along.orderBy(*by)).alias("idx")
    truth = truth.select(*page, number("idx", *sides), exact.alias("box"))
    confidence = F.coalesce("confidence", F.lit(0.0)).cast("double")
    found = found.select(*page, F.col("idx").cast("long").alias("_idx"), confidence.alias("confidence"), number(F.desc(confidence), "idx", *sides), exact.alias("box"))
    pairs = boxes.overlaps(found, truth, page).filter(F.col("iou") >= min(thresholds))
    near = pairs.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("a_idx", (-F.col("iou")).alias("far"), "b_idx"))).alias("near"))

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rows = []
            for i, own in enumerate(t["near"].to_pylist()):
                taken = [set() for _ in thresholds]
                got = {p["a_idx"]: [False] * len(thresholds) for p in own}
                for p in own:
                    for k, at in enumerate(thresholds):
                        if -p["far"] >= at and not got[p["a_idx"]][k] and p["b_idx"] not in taken[k]:
                            got[p["a_idx"]][k] = True
                            taken[k].add(p["b_idx"])
                rows += [(i, *x) for x in got.items()]
            at, idx, hit = zip(*rows, strict=True) if rows else ((), (), ())
            out = t.select(page).take(pa.array(at, pa.int64())).append_column("idx", pa.array(idx, pa.int32()))
            yield from out.append_column("hits", pa.array(hit, pa.list_(pa.bool_()))).to_batches()

    kind = ", ".join(f"{c} {dict(found.dtypes)[c]}" for c in page)
    matched = near.mapInArrow(run, f"{kind}, idx int, hits array<boolean>")
    rows = found.drop("box").join(truth.select(*page), page, "left_semi").join(matched, [*page, "idx"], "left")
    rows = rows.withColumn("hits", F.coalesce("hits", F.array(*[F.lit(False)] * len(thresholds))))
    each = F.inline(F.arrays_zip(F.array(*[F.lit(float(x)) for x in thresholds]).alias("threshold"), F.col("hits").alias("hit")))
    return rows.select(*page, F.col("_idx").alias("idx"), "confidence", each.alias("threshold", "hit"))


def _arrow(key: DataFrame, kinds: str):
    """Rows as an Arrow table of a Spark schema given as text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(key.sparkSession.createDataFrame([], kinds).schema)
    return lambda rows: pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema
    )


def average_precision(hit: DataFrame, truth_boxes: DataFrame | int, *, by: Sequence[str] = (), stretches: int = 1000) -> DataFrame:
    """(by, threshold, ap, precision, recall): the area under the interpolated curve over levels of confidence.

    Boxes of one confidence count together, so their order has no effect; the curve has a point for each level.
    precision and recall are those after the last. Confidence is cut into stretches of 1 / stretches: sums and best precisions
    run along the levels of a stretch, and along stretches, so that no task holds all levels. by: columns (of the page's) whose
    values are scored each by itself, in the same pass. No hits give no rows.
    """
    key = [*by, "threshold"]
    levels = hit.groupBy(*key, "confidence").agg(F.sum(F.col("hit").cast("long")).alias("tp"), F.count("*").alias("n"))
    levels = levels.withColumn("part", F.floor(F.col("confidence") * stretches))
    levels = _with_total(levels, truth_boxes, by)
    parts = levels.groupBy(*key, "part").agg(F.sum("tp").alias("tp"), F.sum("n").alias("n"))
    above = Window.partitionBy(*key).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)  # stretches, not levels
    before = lambda c: F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_before")
    levels = levels.join(parts.select(*key, "part", before("tp"), before("n")), [*key, "part"])
    inside = Window.partitionBy(*key, "part").orderBy(F.desc("confidence"))
    down = inside.rowsBetween(Window.unboundedPreceding, 0)
    tp, n = F.sum("tp").over(down) + F.col("tp_before"), F.sum("n").over(down) + F.col("n_before")
    share = lambda x: F.coalesce(F.try_divide(x, F.col("total")), F.lit(0.0))
    curve = levels.select(*key, "part", "confidence", (tp / n).alias("p"), share(tp).alias("r"), share(F.col("tp_before")).alias("r_before"))
    below = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    after = curve.groupBy(*key, "part").agg(F.max("p").alias("p_part"))
    curve = curve.join(after.select(*key, "part", F.max("p_part").over(below).alias("p_after")), [*key, "part"])
    best = F.greatest(F.max("p").over(inside.rowsBetween(0, Window.unboundedFollowing)), F.coalesce("p_after", F.lit(0.0)))
    step = F.col("r") - F.coalesce(F.lag("r").over(inside), "r_before")
    curve = curve.select(*key, "confidence", "p", "r", (best * step).alias("area"))
    return curve.groupBy(*key).agg(F.sum("area").alias("ap"), F.min_by("p", "confidence").alias("precision"), F.max("r").alias("recall"))


def _with_total(rows: DataFrame, truth_boxes: DataFrame | int, by: Sequence[str]) -> DataFrame:
    """rows with total: the number of true boxes, of the row's own group."""
    if isinstance(truth_boxes, int):
        return rows.withColumn("total", F.lit(truth_boxes))
    if by:
        return rows.join(truth_boxes.groupBy(*by).agg(F.count("*").alias("total")), list(by))
    return rows.join(F.broadcast(truth_boxes.agg(F.count("*").alias("total"))), how="cross")  # one row


def curve_means(hit: DataFrame, truth_boxes: DataFrame | int, page: Sequence[str], *, by: Sequence[str] = (), stretches: int = 1000) -> DataFrame:
    """(by, threshold, precision, recall): means over the curve that has a point for each found box.

    Boxes come by falling confidence, then page, then idx. What comes before a box is summed level by level: stretches of
    confidence, confidences of a stretch, pages of a confidence, boxes of a page; so no window holds more than one of these.
    """
    key = [*by, "threshold"]
    rows = hit.withColumns({"part": F.floor(F.col("confidence") * stretches), "tp": F.col("hit").cast("long"), "n": F.lit(1).cast("long")})
    levels = [["part"], ["confidence"], [c for c in page if c not in by] or list(page)]
    order = [[F.desc("part")], [F.desc("confidence")], [F.asc(c) for c in levels[2]]]
    sums = {"tp": F.col("tp"), "n": F.col("n")}
    for i, (own, by_order) in enumerate(zip(levels, order, strict=True)):
        outer = [*key, *[c for x in levels[:i] for c in x]]
        counts = rows.groupBy(*outer, *own).agg(F.sum("tp").alias("_tp"), F.sum("n").alias("_n"))
        before = Window.partitionBy(*outer).orderBy(*by_order).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.select(*outer, *own, *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"{c}_{i}") for c in sums])
        rows = rows.join(counts, [*outer, *own])
        sums = {c: v + F.col(f"{c}_{i}") for c, v in sums.items()}
    inside = Window.partitionBy(*key, *[c for x in levels for c in x]).orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"{c}_own": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})  # boxes of a page are already together
    sums = {c: v + F.col(f"{c}_own") for c, v in sums.items()}
    rows = _with_total(rows, truth_boxes, by)
    recall = F.coalesce(F.try_divide(sums["tp"], F.col("total")), F.lit(0.0))
    return rows.groupBy(*key).agg(F.avg(sums["tp"] / sums["n"]).alias("precision"), F.avg(recall).alias("recall"))


def dataset_scores(hit: DataFrame, truth_boxes: DataFrame, page: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, key, value): dataset_test/map50-95, map50, map75, and precision and recall, means of the curve at 0.75."""
    at = lambda x: F.max(F.when(F.col("threshold") == x, F.col("ap")))
    ap = average_precision(hit, truth_boxes, by=by).groupBy(*by).agg(F.avg("ap").alias("map50-95"), at(0.5).alias("map50"), at(0.75).alias("map75"))
    ap = ap.join(curve_means(hit.filter("threshold = 0.75"), truth_boxes, page, by=by).drop("threshold"), list(by))
    rows = ap.unpivot(list(by), ["map50-95", "map50", "map75", "precision", "recall"], "key", "value")
    return rows.withColumn("key", F.concat(F.lit("dataset_test/"), "key"))


def cells(polygons: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Areas of the cells that polygons cut the plane into, and which polygons hold each cell.

    The plane is cut into strips at every corner and crossing. No edges cross inside a strip, so between two neighbouring
    edges the area is the strip's height times the width at its middle. Even-odd: what a polygon covers twice is out.
    """
    edges, owner = [], []
    for k, p in enumerate(polygons):
        p = np.asarray(p, float)
        if len(p) >= 3:
            edges.append(np.hstack([p, np.roll(p, -1, axis=0)]))
            owner.append(np.full(len(p), k))
    if not edges:
        return np.zeros(0), np.zeros((0, len(polygons)), bool)
    e, own = np.concatenate(edges), np.concatenate(owner)
    keep = e[:, 1] != e[:, 3]  # level edges bound no strip
    ys = [e[:, 1], e[:, 3]]
    e, own = e[keep], own[keep]
    lean = (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1])
    start = e[:, 0] - lean * e[:, 1]  # x = start + lean * y
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    for i in range(len(e)):
        other = lean[i + 1 :] - lean[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            y = (start[i] - start[i + 1 :]) / other
        ok = np.isfinite(y) & (y > np.maximum(low[i], low[i + 1 :])) & (y < np.minimum(high[i], high[i + 1 :]))
        if ok.any():
            ys.append(y[ok])
    ys = np.unique(np.concatenate(ys))
    areas, inside = [], []
    for a, b in zip(ys, ys[1:]):  # noqa: B905
        mid = (a + b) / 2
        at = np.flatnonzero((low <= a) & (high >= b) & (low < mid) & (high > mid))
        if len(at) < 2 or b - a < 1e-12:
            continue
        x = start[at] + lean[at] * mid
        order = np.argsort(x, kind="stable")
        x, sides = x[order], own[at][order]
        flips = np.zeros((len(at), len(polygons)), np.int32)
        flips[np.arange(len(at)), sides] = 1
        within = np.cumsum(flips, axis=0)[:-1] % 2 == 1
        areas.append(np.diff(x) * (b - a))
        inside.append(within)
    if not areas:
        return np.zeros(0), np.zeros((0, len(polygons)), bool)
    return np.concatenate(areas), np.concatenate(inside)


def zone_polygon(boundary: Column, baseline: Column, pad: int = 10) -> Column:
    """A boundary of three points and more, else a box around the baseline with pad above and below; null without either."""
    around = G.polygon(G.padded(G.bounds(baseline), pad)).cast(G.POINTS)
    return F.when(F.size(boundary) >= 3, boundary).when(F.size(baseline) >= 2, around)


def sided(truth: DataFrame, found: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page columns, side, idx, boundary, baseline, text) of both: side 0 is the truth, 1 what is found."""
    sides = [x.select(*page, F.lit(k).alias("side"), "idx", "boundary", "baseline", "text") for k, x in enumerate((truth, found))]
    return sides[0].unionByName(sides[1])


def _zones(rows: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page columns, side, z, corner, points, text) of zones (page columns, side, idx, points, text): z numbers a side's zones of
    a page by idx, corner by their tops and left edges."""
    top = [G.corner(F.col("points"), a, True) for a in "yx"]
    along = Window.partitionBy(*page, "side")
    number = lambda *by: F.row_number().over(along.orderBy(*by)) - 1
    return rows.select(*page, "side", number("idx").alias("z"), number(*top, "idx").alias("corner"), "points", "text")


def _level(points: Column, box: Column) -> Column:
    """Whether points are the corners of their bounds, in the order of G.polygon()."""
    around = ((0, "x", "x1"), (0, "y", "y1"), (1, "x", "x2"), (1, "y", "y1"), (2, "x", "x2"), (2, "y", "y2"), (3, "x", "x1"), (3, "y", "y2"))
    level = (F.size(points) == 4) & reduce(lambda x, y: x & y, [F.get(points, i)[a] == box[k] for i, a, k in around])
    return F.coalesce(level, F.lit(False))


def _by_page(rows: DataFrame, page: Sequence[str], kinds: str, each) -> DataFrame:
    """each(rows of a page) -> tuples, with the page's columns before them. A page is small; many go through Python in one stream."""
    head = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in page)
    fields = _arrow(rows.select(*page), kinds)

    def some(table: pa.Table, starts: np.ndarray) -> pa.Table:
        made = [(i, *x) for i, (a, b) in enumerate(zip(starts, starts[1:])) for x in each(table.slice(a, b - a))]  # noqa: B905
        own = table.select(list(page)).take(pa.array([starts[r[0]] for r in made], pa.int64()))
        found = fields([r[1:] for r in made])
        for name in found.column_names:
            own = own.append_column(name, found[name])
        return own

    return stream.by_pages(rows, page, [], f"{head}, {kinds}", some)


def page_cells(zones: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page columns, area, truth, found): the areas that zones cut each other into, and the zones z that hold each.

    A level rectangle whose bounds meet no other zone's is one such area; only other zones go to Python.
    """
    page = list(page)
    key = F.struct("side", "z").alias("idx")
    placed = zones.select(*page, "side", "z", "points", key, G.bounds(F.col("points")).alias("box")).withColumn("level", _level(F.col("points"), F.col("box")))
    boxed = placed.select(*page, "idx", F.col("box").cast("struct<x1: double, y1: double, x2: double, y2: double>").alias("box"))
    met = boxes.overlaps(boxed, boxed, page, F.col("a_idx") < F.col("b_idx"))
    met = met.select(*page, F.explode(F.array("a_idx", "b_idx")).alias("idx")).distinct().withColumn("_met", F.lit(True))
    placed = written(placed.join(met, [*page, "idx"], "left"), "zone-places")
    alone = F.col("level") & F.col("_met").isNull()
    wide, high = ((F.col(f"box.{a}2") - F.col(f"box.{a}1")).cast("double") for a in "xy")
    own = lambda side: F.when(F.col("side") == side, F.array("z")).otherwise(F.array().cast("array<int>"))
    single = placed.filter(alone).select(*page, (wide * high).alias("area"), own(0).alias("truth"), own(1).alias("found")).filter("area > 0")

    def each(table: pa.Table):
        rows = table.sort_by([("side", "ascending"), ("z", "ascending")]).select(["side", "z", "points"]).to_pylist()
        n, z = sum(r["side"] == 0 for r in rows), np.array([r["z"] for r in rows])
        areas, inside = cells([np.array([(p["x"], p["y"]) for p in r["points"]], float) for r in rows])
        for area, row in zip(areas.tolist(), inside, strict=True):
            at = np.flatnonzero(row)
            if len(at):
                yield area, z[at[at < n]].tolist(), z[at[at >= n]].tolist()

    return single.unionByName(_by_page(placed.filter(~alone).select(*page, "side", "z", "points"), page, "area double, truth array<int>, found array<int>", each))


def _groups(links: DataFrame, cut: DataFrame, page: Sequence[str], beta: float) -> DataFrame:
    """(page columns, n, g, d, n_gt, n_dt, area): links that hold, in the order of falling strength.

    Of a link's shared area that counts which no zone covers that is already linked to either; the link holds if this is over
    beta of what is so left of the true zone. n_gt and n_dt: links of the found and of the true zone so far.
    """

    def each(table: pa.Table):
        cut = [r for r in table.to_pylist() if r["g"] is None]
        areas = np.array([r["area"] for r in cut], float)
        holds = [[set(r[side]) for r in cut] for side in ("truth", "found")]
        of: tuple[dict, dict] = ({}, {})
        order = sorted((r for r in table.select(["strength", "g", "d"]).to_pylist() if r["g"] is not None), key=lambda r: (-r["strength"], r["g"], r["d"]))
        n = 0
        for r in order:
            g, d = r["g"], r["d"]
            mine, theirs = of[0].setdefault(g, set()), of[1].setdefault(d, set())
            free = [i for i, (t, f) in enumerate(zip(*holds, strict=True)) if g in t and not t & theirs and not f & mine]
            shared = areas[[i for i in free if d in holds[1][i]]].sum()
            if shared > 0 and shared / areas[free].sum() > beta:
                mine.add(d)
                theirs.add(g)
                yield n, g, d, len(theirs), len(mine), float(shared)
                n += 1

    own = cut.join(links.select(*page), list(page), "left_semi")  # other pages have nothing to take
    return _by_page(links.unionByName(own, allowMissingColumns=True), page, "n int, g int, d int, n_gt int, n_dt int, area double", each)


def _text_groups(groups: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page columns, t, side, z): which zones' texts are compared together; each counts in one group t at most.

    groups (n, config, g, d) are taken by configuration in a fixed order, then by n. Multiple groups take all zones linked to
    either side that are still free, splits and merges those of their divided side; others need both zones free.
    """
    # The order in which configurations take texts.
    turns = ("multiple", "split", "merge", "match", "miss", "false_alarm")

    def each(table: pa.Table):
        rows = sorted(table.select(["config", "n", "g", "d"]).to_pylist(), key=lambda r: (turns.index(r["config"]), r["n"]))
        of: tuple[dict, dict] = ({}, {})
        for r in rows:
            if r["g"] is not None and r["d"] is not None:
                of[0].setdefault(r["g"], []).append(r["d"])
                of[1].setdefault(r["d"], []).append(r["g"])
        taken: tuple[set, set] = (set(), set())
        for t, r in enumerate(rows):
            own = [{r["g"]} - {None}, {r["d"]} - {None}]
            fixed = {"multiple": (), "split": (0,), "merge": (1,)}.get(r["config"], (0, 1))
            if any(own[k] & taken[k] for k in fixed):
                continue
            wide = [set(of[1].get(r["d"], ())), set(of[0].get(r["g"], ()))]
            for k in (0, 1):
                got = (own[k] if k in fixed else wide[k]) - taken[k]
                taken[k].update(got)
                yield from ((t, k, z) for z in got)

    # a zone without links is a group of its own, and no other takes it
    single = groups.filter("alone").select(*page, F.col("n").alias("t"), F.col("g").isNull().cast("int").alias("side"), F.coalesce("g", "d").alias("z"))
    return single.unionByName(_by_page(groups.filter("not alone").drop("alone"), page, "t long, side int, z int", each))


STATS = [*(f"area_{c}" for c in CONFIGS), "gt_area", *(f"n_{c}" for c in CONFIGS), "edits", "gt_chars", "dt_chars", "gt_words", "dt_words", "word_hits"]


def zone_map(truth: DataFrame, found: DataFrame, page: Sequence[str], **options) -> DataFrame:
    """zone_map_of() of truth and found (page columns, idx, boundary, baseline, text)."""
    return zone_map_of(sided(truth, found, page), page, **options)


def zone_map_of(
    rows: DataFrame, page: Sequence[str], *, with_text: bool = True, beta: float = 0.2, weight: float = 0.5, need_text: bool = True, most: int = 64
) -> DataFrame:
    """(page columns, STATS): areas and counts by configuration, and recognition counts, a row for each page of rows
    (see sided()).

    Zones that share some area are linked, by falling strength; a link's configuration is that of the links made so far.
    Links count their shared area; splits, merges and multiples count weight times the zones on the divided side. What a zone
    with text (or any, without need_text) keeps uncovered by the zones it is linked to is missed or a false alarm. On pages
    without found zones all true zones are missed. Pages without true zones count nothing.

    Where level rectangles, most of them on a page, meet no other, a page's statistics are sums of its rows, and only these are kept. Zones of all other
    pages (of more zones too) are written, then cut and linked; see _linked_map(). rows are read once more only for pages of over most zones.
    """
    page = list(page)
    rows = rows.select(*page, "side", "idx", zone_polygon(F.col("boundary"), F.col("baseline")).alias("points"), F.coalesce("text", F.lit("")).alias("text"))
    each = written(_page_sums(rows, page, with_text, need_text, most), "zone-pages")
    quiet, other = each.filter("quiet").select(*page, *STATS), each.filter("not quiet")
    if other.isEmpty():
        return quiet
    zones = other.select(*page, F.explode("zones").alias("_z")).select(*page, "_z.side", "_z.idx", "_z.points", "_z.text")
    crowded = other.filter("crowded").select(*page)
    if not crowded.isEmpty():
        zones = zones.unionByName(rows.filter("points is not null").join(crowded, page, "left_semi"))
    return quiet.unionByName(_linked_map(zones, other.select(*page), page, with_text, beta, weight, need_text))


def _page_sums(rows: DataFrame, page: list[str], with_text: bool, need_text: bool, most: int) -> DataFrame:
    """(page columns, quiet, crowded, zones, STATS) of zones (page columns, side, idx, points, text). quiet: STATS are the page's, as it has at most
    so many zones, all level rectangles that share no area; else zones are the page's, but none of a crowded page, which has more. A null
    page counts nothing, as it meets none."""
    b, x, none = F.col("_box"), F.col("text"), F.lit(0)
    rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy(*page))).withColumn("_box", G.bounds(F.col("points")))
    placed = reduce(lambda p, q: p & q, [F.col("points").isNotNull(), *[F.col(c).isNotNull() for c in page]])
    area = ((b["x2"] - b["x1"]).cast("double") * (b["y2"] - b["y1"]).cast("double")).alias("area")
    counts = (area > 0) & ((T.stripped(x) != "") | F.lit(not need_text))
    zone = F.struct("side", "idx", "points", "text", b.alias("box"), _level(F.col("points"), b).alias("level"))
    values = {"all_area": (placed, area), "all_n": (placed, F.lit(1)), "area": (placed & counts, area), "n": (placed & counts, F.lit(1)),
              "chars": (placed & counts, F.length(x)), "words": (placed & counts, F.size(T.words(x)))}
    sums = [F.coalesce(F.sum(F.when(on & (F.col("side") == k), v)), none).alias(f"_{name}{k}") for name, (on, v) in values.items() for k in (0, 1)]
    each = rows.groupBy(*page).agg(F.max("_n").alias("_n"), F.collect_list(F.when(placed & (F.col("_n") <= most), zone)).alias("zones"), *sums)
    meet = lambda p, q: reduce(lambda r, s: r & s, [F.greatest(p[f"{a}1"], q[f"{a}1"]) < F.least(p[f"{a}2"], q[f"{a}2"]) for a in "xy"])
    # a zone of some area meets itself
    own = F.size(F.filter("zones", lambda z: meet(z["box"], z["box"])))
    met = F.aggregate("zones", none, lambda n, z: n + F.size(F.filter("zones", lambda o: meet(z["box"], o["box"]))))
    each = each.withColumn("crowded", F.col("_n") > most).withColumn("quiet", ~F.col("crowded") & F.forall("zones", lambda z: z["level"]) & (met == own))
    c = F.col
    truth, found = c("_all_n0") > 0, c("_all_n1") > 0
    missed = lambda name: F.when(truth & found, c(f"_{name}0")).when(truth, c(f"_all_{name}0")).otherwise(none)
    alarm = lambda name: F.when(truth, c(f"_{name}1")).otherwise(none)
    read = lambda v: F.when(truth & found & F.lit(with_text), v).otherwise(none)
    stats = {
        "area_miss": missed("area"), "n_miss": missed("n"), "area_false_alarm": alarm("area"), "n_false_alarm": alarm("n"), "gt_area": c("_all_area0"),
        "edits": read(c("_chars0") + c("_chars1")), "gt_chars": read(c("_chars0")), "dt_chars": read(c("_chars1")), "gt_words": read(c("_words0")), "dt_words": read(c("_words1")),
    }
    kept = [F.when(c("quiet"), stats.get(name, none)).cast("double" if "area" in name else "long").alias(name) for name in STATS]
    return each.select(*page, "quiet", "crowded", F.when(~c("quiet"), c("zones")).alias("zones"), *kept)


def _linked_map(rows: DataFrame, pages: DataFrame, page: list[str], with_text: bool, beta: float, weight: float, need_text: bool) -> DataFrame:
    """zone_map_of() of pages, whose zones are rows (page columns, side, idx, points, text).

    Areas, links, sums and texts are rows that Spark joins and adds up; Arrow functions cut a page's polygons and take its
    links one by one. What is used more than once is written to the shared folder.
    """
    zones = written(_zones(rows, page), "zones")
    cut = written(page_cells(zones, page), "zone-cells")
    inside = lambda side, name: cut.select(*page, "area", F.explode(side).alias(name), "truth", "found")
    sizes = [inside(side, name).groupBy(*page, name).agg(F.sum("area").alias(f"{name}_size")) for side, name in (("truth", "g"), ("found", "d"))]
    shared = inside("truth", "g").select(*page, "area", "g", F.explode("found").alias("d")).groupBy(*page, "g", "d").agg(F.sum("area").alias("shared"))
    share = lambda c: F.pow(F.col("shared") / F.col(c), 2)
    links = shared.filter("shared > 0").join(sizes[0], [*page, "g"]).join(sizes[1], [*page, "d"])
    links = links.select(*page, "g", "d", (share("g_size") + share("d_size")).alias("strength"))
    linked = written(_groups(links, cut, page, beta), "zone-groups")

    config = (
        F.when((F.col("n_gt") == 1) & (F.col("n_dt") == 1), "match").when(F.col("n_gt") == 1, "split")
        .when(F.col("n_dt") == 1, "merge").otherwise("multiple")
    )
    divided = F.when(config == "match", 1.0).otherwise(weight * (F.when(config == "merge", 0).otherwise(F.col("n_dt")) + F.when(config == "split", 0).otherwise(F.col("n_gt"))))
    counted = linked.select(*page, "n", config.alias("config"), "g", "d", (divided * F.col("area")).alias("area"), F.lit(1).alias("counts"))

    on = zones.groupBy(*page).agg(F.count_if(F.col("side") == 0).alias("n_truth"), F.count_if(F.col("side") == 1).alias("n_found")).filter("n_truth > 0")
    partners = {0: linked.groupBy(*page, F.col("g").alias("z")).agg(F.collect_set("d").alias("own")), 1: linked.groupBy(*page, F.col("d").alias("z")).agg(F.collect_set("g").alias("own"))}
    rests = []
    for side, (own, other, kind) in enumerate((("truth", "found", "miss"), ("found", "truth", "false_alarm"))):
        parts = inside(own, "z").select(*page, "z", "area", F.col(other).alias("others")).join(partners[side], [*page, "z"], "left")
        left = parts.filter(~F.coalesce(F.arrays_overlap("others", "own"), F.lit(False))).groupBy(*page, "z").agg(F.sum("area").alias("area"))
        rows = zones.filter(F.col("side") == side).select(*page, "z", (T.stripped(F.col("text")) != "").alias("filled"))
        rows = rows.join(on, page).join(left, [*page, "z"], "left").join(partners[side], [*page, "z"], "left")
        area = F.coalesce("area", F.lit(0.0))
        wanted = ((area > 0) & (F.col("filled") | F.lit(not need_text))) | (F.col("n_found") == 0)
        at = (F.lit(None).cast("int"), F.col("z"))
        rests.append(rows.filter(wanted).select(
            *page, (F.lit(1_000_000_000 * (side + 1)) + F.col("z")).cast("long").alias("n"), F.lit(kind).alias("config"), at[1 - side].alias("g"), at[side].alias("d"),
            area.alias("area"), F.col("own").isNull().cast("int").alias("counts"),
        ))
    counted = written(counted.withColumn("n", F.col("n").cast("long")).unionByName(rests[0]).unionByName(rests[1]), "zone-counts")
    of = lambda c, value: F.sum(F.when(F.col("config") == c, F.col(value)))
    sums = counted.groupBy(*page).agg(*[of(c, "area").alias(f"area_{c}") for c in CONFIGS], *[of(c, "counts").cast("long").alias(f"n_{c}") for c in CONFIGS])
    total = sizes[0].groupBy(*page).agg(F.sum("g_size").alias("gt_area"))
    out = pages.join(sums, page, "left").join(total, page, "left")
    if with_text:
        out = out.join(_recognition(counted.join(on.filter("n_found > 0").select(*page), page), zones, page), page, "left")
    filled = [F.coalesce(F.col(c) if c in out.columns else F.lit(None), F.lit(0)).cast("double" if "area" in c else "long").alias(c) for c in STATS]
    return out.select(*page, *filled)


def _recognition(groups: DataFrame, zones: DataFrame, page: list[str]) -> DataFrame:
    """(page columns, edits, gt_chars, dt_chars, gt_words, dt_words, word_hits) over the texts of the groups."""
    members = _text_groups(groups.select(*page, "n", "config", "g", "d", (F.col("g").isNull() | F.col("d").isNull()) & (F.col("counts") == 1)).toDF(*page, "n", "config", "g", "d", "alone"), page).join(zones.select(*page, "side", "z", "corner", "text"), [*page, "side", "z"])
    texts = lambda side: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, F.struct("corner", "text")))), lambda x: x["text"]), "")
    pairs = written(members.groupBy(*page, "t").agg(texts(0).alias("truth"), texts(1).alias("found")), "zone-texts")
    edited = errors.with_edits(pairs).join(errors.word_overlap(pairs, [*page, "t"]), [*page, "t"])
    return edited.groupBy(*page).agg(
        F.sum("char_edits").alias("edits"), F.sum("chars").alias("gt_chars"), F.sum("found_chars").alias("dt_chars"), F.sum("words").alias("gt_words"),
        F.sum("found_words").alias("dt_words"), F.sum("common").alias("word_hits"),
    )


def zone_map_scores(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of page statistics as scores: 100 times what is not matched over the true area, shares of areas, counts, and
    precision, recall and F1 of characters and words. A zero denominator gives 0.0."""
    sums = stats.groupBy(*by).agg(*[F.sum(c).alias(c) for c in STATS])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = F.col
    out = {"score": 100 * ratio(sum((c(f"area_{x}") for x in CONFIGS[1:]), F.lit(0.0)), c("gt_area"))}
    out |= {f"share_{x}": ratio(c(f"area_{x}"), c("gt_area")) for x in CONFIGS}
    good = {"char": F.greatest(F.lit(0), F.least("gt_chars", "dt_chars") - c("edits")), "word": c("word_hits")}
    for kind, n in good.items():
        p, r = ratio(n, c(f"dt_{kind}s")), ratio(n, c(f"gt_{kind}s"))
        out |= {f"{kind}_precision": p, f"{kind}_recall": r, f"{kind}_f1": ratio(2 * p * r, p + r)}
    return sums.select(*by, *[F.round(v, 4).alias(k) for k, v in out.items()], *[f"n_{x}" for x in CONFIGS])
