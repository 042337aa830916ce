"""Reading order of zones on a page: a registry of strategies, each DataFrame -> DataFrame with a column position."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foliomill.operators import stream

STRATEGIES: dict[str, Callable[..., DataFrame]] = {}


def strategy(name: str):
    def add(f):
        STRATEGIES[name] = f
        return f

    return add


def reading_order(zones: DataFrame, page: list[str], name: str = "dbscan", **options) -> DataFrame:
    """zones (page columns, idx, box, first_y) with position from 1. first_y: the top of a zone's first line, or null.

    An unknown name raises ValueError. A table without rows stays one.
    """
    if name not in STRATEGIES:
        raise ValueError(f"unknown reading order {name!r}; known: {', '.join(sorted(STRATEGIES))}")
    return STRATEGIES[name](zones, page, **options)


def with_first_y(zones: DataFrame, lines: DataFrame | None, page: list[str]) -> DataFrame:
    """zones with first_y: the least y of the lines (page columns, zone, y) they hold, else their box's top."""
    if lines is None:
        return zones.withColumn("first_y", F.col("box.y1"))
    top = lines.groupBy(*page, F.col("zone").alias("idx")).agg(F.min("y").alias("_top"))
    return zones.join(top, [*page, "idx"], "left").withColumn("first_y", F.coalesce("_top", "box.y1")).drop("_top")


def median_height(zones: DataFrame, page: list[str]) -> DataFrame:
    """(page columns, median_height) of the zones of each page."""
    return zones.groupBy(*page).agg(F.median(F.col("box.y2") - F.col("box.y1")).alias("median_height"))


@strategy("none")
def as_given(zones: DataFrame, page: list[str], **_) -> DataFrame:
    return zones.withColumn("position", F.row_number().over(Window.partitionBy(*page).orderBy("idx")))


def column_number(page: list[str], eps) -> Column:
    """Number of a zone's column: a gap of over eps between neighbouring centres starts the next.

    That is one-dimensional density clustering with clusters of one and more.
    """
    along = Window.partitionBy(*page).orderBy("_x", "idx")
    gap = F.col("_x") - F.lag("_x").over(along) > eps
    return F.coalesce(gap, F.lit(True)).cast("int")


@strategy("dbscan")
def in_columns(zones: DataFrame, page: list[str], *, eps: int = 300, **_) -> DataFrame:
    """Columns from left to right; in a column by first line, then centre."""
    zones = zones.withColumn("_x", (F.col("box.x1") + F.col("box.x2")) / 2)
    zones = zones.withColumn("_new", column_number(page, eps))
    along = Window.partitionBy(*page).orderBy("_x", "idx").rowsBetween(Window.unboundedPreceding, 0)
    zones = zones.withColumn("_column", F.sum("_new").over(along))
    order = Window.partitionBy(*page).orderBy("_column", F.coalesce("first_y", "box.y1"), "_x", "idx")
    return zones.withColumn("position", F.row_number().over(order)).drop("_x", "_new", "_column")


def _smooth(values: np.ndarray, window: int) -> np.ndarray:
    return np.convolve(values, np.ones(window), "same") / window


def _gap_middles(blank: np.ndarray) -> list[int]:
    """The middle element of each run of indices where blank holds."""
    at = np.flatnonzero(blank)
    if not len(at):
        return []
    return [int(run[len(run) // 2]) for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)]




def _profile(boxes: np.ndarray, size: tuple[int, int], axis: int) -> np.ndarray:
    """Pixels that zones cover in each row (axis 1) or column (axis 0) of a page.

    Between two neighbouring edges of boxes all rows are alike, so only cells of the grid of edges are looked at.
    """
    b = np.clip(boxes.astype(int), 0, [size[1], size[0], size[1], size[0]])
    xs, ys = np.unique([0, size[1], *b[:, 0], *b[:, 2]]), np.unique([0, size[0], *b[:, 1], *b[:, 3]])
    x, y = xs[:-1], ys[:-1]
    inside_x = (b[:, 0, None] <= x) & (x < b[:, 2, None])
    inside_y = (b[:, 1, None] <= y) & (y < b[:, 3, None])
    covered = np.einsum("ky,kx->yx", inside_y.astype(np.int32), inside_x.astype(np.int32)) > 0
    if axis == 1:
        return np.repeat(covered @ np.diff(xs), np.diff(ys))
    return np.repeat(covered.T @ np.diff(ys), np.diff(xs))


def peaks(values: np.ndarray, prominence: float) -> list[int]:
    """Local maxima (the middle of flat ones) that stand out by prominence from the higher of the lows beside them."""
    edges = np.flatnonzero(np.diff(values)) + 1  # where runs of equal values begin, but for the first
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(values)]]) - 1
    level = values[starts]
    out = []
    for r in np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1 if len(level) > 2 else ():
        higher = np.flatnonzero(level > level[r])
        left, right = higher[higher < r].max(initial=-1) + 1, higher[higher > r].min(initial=len(level))
        if level[r] - max(level[left : r + 1].min(), level[r:right].min()) >= prominence:
            out.append(int(starts[r] + ends[r]) // 2)
    return out


def bands(boxes: np.ndarray, size: tuple[int, int]) -> list[tuple[int, int]]:
    """Horizontal bands between the white gaps of a page."""
    median = float(np.median(boxes[:, 3] - boxes[:, 1]))
    rows = _smooth(_profile(boxes, size, 1), max(1, int(median / 2))).astype(int)
    edges = [0, *_gap_middles(rows == 0), size[0]]
    return list(zip(edges, edges[1:]))  # noqa: B905


def gutters(boxes: np.ndarray, size: tuple[int, int], band: tuple[int, int], divisor: int, window: int) -> list[int]:
    """Where columns of a band end."""
    inside = boxes.copy()
    inside[:, [1, 3]] = np.clip(inside[:, [1, 3]] - band[0], 0, band[1] - band[0])
    values = _smooth(_profile(inside, (band[1] - band[0], size[1]), 0), window)
    return peaks(-values, (band[1] - band[0]) // divisor)


def _rows_covered(b: np.ndarray, wide: np.ndarray, high: np.ndarray) -> np.ndarray:
    """_profile() of axis 1 of many pages, one after the other: b (pages, zones, 4) with as many zones on each page."""
    b = np.clip(b.astype(int), 0, np.stack([wide, high, wide, high], 1)[:, None])
    zero = np.zeros((len(b), 1), int)
    xs, ys = (np.sort(np.concatenate([zero, n[:, None], b[:, :, k], b[:, :, k + 2]], 1), axis=1) for k, n in ((0, wide), (1, high)))
    inside_x = (b[:, :, 0, None] <= xs[:, None, :-1]) & (xs[:, None, :-1] < b[:, :, 2, None])
    inside_y = (b[:, :, 1, None] <= ys[:, None, :-1]) & (ys[:, None, :-1] < b[:, :, 3, None])
    covered = (np.swapaxes(inside_y, 1, 2).astype(np.float32) @ inside_x.astype(np.float32)) > 0
    return np.repeat((covered * np.diff(xs)[:, None]).sum(2).ravel(), np.diff(ys).ravel())


def _band_edges(boxes: np.ndarray, starts: np.ndarray, median: np.ndarray, wide: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """The edges of bands() of each page; page i has the zones from starts[i] to starts[i + 1]. Pages with as many zones are looked at
    together, some at a time, so that their rasters stay small."""
    counts, out = np.diff(starts), [np.zeros(0)] * (len(starts) - 1)
    window = np.maximum(1, (median / 2).astype(int))
    for i in np.flatnonzero((window > high) & (counts > 1)):  # numpy's "same" is then longer than the page
        edges = bands(boxes[starts[i] : starts[i + 1]], (high[i], wide[i]))
        out[i] = np.array([a for a, _ in edges] + [high[i]])
    for n in np.unique(counts[counts > 1]):
        own = np.flatnonzero((counts == n) & (window <= high))
        room = int(max(high[own].max(initial=1), 4 * (n + 1) ** 2))
        for pages in np.array_split(own, -(-len(own) * room // 2_000_000) or 1):
            if not len(pages):
                continue
            size, w = high[pages], window[pages]
            values = _rows_covered(boxes[starts[pages][:, None] + np.arange(n)], wide[pages], size)
            sums = np.concatenate([[0], np.cumsum(values)])
            page = np.repeat(np.arange(len(pages)), size)
            low, at = (np.cumsum(size) - size)[page], np.arange(len(values))
            left, right = np.maximum(at - (w // 2)[page], low), np.minimum(at + ((w - 1) // 2)[page] + 1, low + size[page])
            blank = sums[right] - sums[left] < w[page]
            turn = np.append(page[1:] != page[:-1], True)
            begin = np.flatnonzero(blank & np.append(True, turn[:-1] | ~blank[:-1]))
            end = np.flatnonzero(blank & (turn | ~np.append(blank[1:], False))) + 1
            middle = begin + (end - begin) // 2
            cuts = np.split(middle - low[middle], np.searchsorted(page[middle], np.arange(1, len(pages))))
            for i, cut in zip(pages, cuts, strict=True):
                out[i] = np.concatenate([[0], cut, [high[i]]])
    return out


def _on_pages(zones: DataFrame, page: list[str], multiplier: int, columns) -> DataFrame:
    """zones with position, in bands, in these by columns(...) and what it sorts by; see by_raster() and by_raster_and_columns().

    columns(boxes, starts, inside, x, band, thin, (tops, bottoms), (heights, widths), page) -> (column, last sort key) for each of the zones
    inside bands; boxes and starts are those of all pages, page numbers these, band the bands of all; column is -1 for a zone that has no
    place. Zones in no band or column are left out; one that is alone on its page stays.
    """
    kind = T.StructType([*zones.schema.fields, T.StructField("position", T.IntegerType())])

    def each(table: pa.Table, starts: np.ndarray) -> pa.Table:
        box = table["box"].combine_chunks()
        boxes = np.stack([pc.struct_field(box, k).to_numpy(zero_copy_only=False).astype(float) for k in ("x1", "y1", "x2", "y2")], 1)
        first = table["first_y"].to_numpy().astype(float)
        first = np.where(np.isnan(first), boxes[:, 1], first)
        counts = np.diff(starts)
        own = np.repeat(np.arange(len(counts)), counts)
        high, wide = (np.maximum.reduceat(boxes[:, k], starts[:-1]).astype(int) + 1 for k in (3, 2))
        median = np.zeros(len(counts))
        for n in np.unique(counts):
            pages = np.flatnonzero(counts == n)
            rows = starts[pages][:, None] + np.arange(n)
            median[pages] = np.median(boxes[rows, 3] - boxes[rows, 1], axis=1)
        edges = _band_edges(boxes, starts, median, wide, high)
        ends = np.cumsum([len(e) for e in edges])
        begins, edge = ends - [len(e) for e in edges], np.concatenate(edges)
        step = float(np.abs(high).max() + 3)  # pages are laid one below the other, so that one search finds all bands
        line = edge + np.repeat(np.arange(len(edges)), ends - begins) * step
        x, y = (boxes[:, 0] + boxes[:, 2]) / 2, (boxes[:, 1] + boxes[:, 3]) / 2
        band = np.searchsorted(line, np.clip(y, -0.5, high[own] + 1) + own * step, "left") - 1
        alone = counts[own] == 1
        inside = np.flatnonzero(~alone & (band >= begins[own]) & (band < ends[own] - 1))
        column, last, place = np.zeros(len(own), int), np.zeros(len(own)), alone.copy()
        if len(inside):
            b, p = band[inside], own[inside]
            low, top = edge[b], edge[b + 1]
            column[inside], last[inside] = columns(boxes, starts, inside, x[inside], b, top - low < multiplier * median[p], (low, top), (high[p], wide[p]), p)
            place[inside] = column[inside] >= 0
        sort = np.lexsort((last, first, column, band, own))
        sort = sort[place[sort]]
        shown = own[sort]
        at = np.flatnonzero(np.append(True, shown[1:] != shown[:-1])) if len(shown) else np.zeros(0, int)
        position = np.arange(len(shown)) - np.repeat(at, np.diff(np.append(at, len(shown)))) + 1
        return table.take(pa.array(sort)).append_column("position", pa.array(position, pa.int32()))

    return stream.by_pages(zones, page, ["idx"], kind, each)


@strategy("heatmap")
def by_raster(zones: DataFrame, page: list[str], *, multiplier: int = 5, window: int = 15, divisor: int = 4, **_) -> DataFrame:
    """Bands from top to bottom; in high bands columns between gutters; then by first line and left edge.

    A zone whose centre lies in no band or column (these leave out their lower end) is dropped. Gutters are looked for only in bands of
    two zones and more, as one zone's column has no effect.
    """

    def columns(boxes, starts, inside, x, band, thin, between, size, page):
        column = np.where(thin, 0, np.where((x > 0) & (x <= size[1] + 1), 0, -1))
        order = np.argsort(band, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(band[order])) + 1):
            i = rows[0]
            if len(rows) > 1 and not thin[i]:
                whole, p = (int(size[0][i]), int(size[1][i])), page[i]
                cuts = gutters(boxes[starts[p] : starts[p + 1]], whole, (int(between[0][i]), int(between[1][i])), divisor, window)
                ends = [0, *cuts, whole[1] + 1]
                at = np.searchsorted(ends, x[rows], "left") - 1
                column[rows] = np.where(at < len(ends) - 1, at, -1)
        return column, boxes[inside, 0]

    return _on_pages(zones, page, multiplier, columns)


@strategy("hybrid")
def by_raster_and_columns(zones: DataFrame, page: list[str], *, eps: int = 300, multiplier: int = 5, **_) -> DataFrame:
    """Bands as in heatmap, in each the columns of dbscan; a thin band is one column."""

    def columns(boxes, starts, inside, x, band, thin, between, size, page):
        order = np.lexsort((x, band))
        gap = np.diff(x[order], prepend=0) > np.where(thin, size[1], eps)[order]
        gap &= np.append(False, band[order][1:] == band[order][:-1])
        column = np.empty(len(order), int)
        column[order] = np.cumsum(gap)  # counts on from band to band, which changes no order
        return column, x

    return _on_pages(zones, page, multiplier, columns)


def without_repeats(lines: DataFrame, block: list[str], *, text: str = "text", order: str = "idx") -> DataFrame:
    """lines without those that repeat the line before in their block. Blank lines stay, and end a run."""
    before = F.lag(text).over(Window.partitionBy(*block).orderBy(order))
    lines = lines.withColumn("_before", before)
    return lines.filter(~((F.col(text) != "") & F.col(text).eqNullSafe(F.col("_before")))).drop("_before")


def chunks(lines: DataFrame, page: list[str], *, size: int = 40, order: str = "idx") -> DataFrame:
    """lines with chunk: each size lines of a page, from 0."""
    n = F.row_number().over(Window.partitionBy(*page).orderBy(order))
    return lines.withColumn("chunk", F.floor((n - 1) / size))
