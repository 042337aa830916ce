"""Joins of boxes on a page: suppression of doubles, assignment by overlap, link strengths.

Boxes are shuffled by page and by cell of a grid. Most pages are one cell. A page with very many boxes is cut into more, the more
boxes it has; a box goes to each cell that it reaches, and a pair counts in the cell of the corner where their shared area begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliomill.functions import geometry as G

SIDES = ("x1", "y1", "x2", "y2")


def _flat(rows: DataFrame, page: list[str], name: str) -> DataFrame:
    """Page columns, and idx and sides of the box as plain columns <name>_..., of boxes with some area."""
    rows = rows.select(*page, F.col("idx").alias(f"{name}_idx"), *[F.col(f"box.{s}").alias(f"{name}_{s}") for s in SIDES])
    return rows.filter((F.col(f"{name}_x2") > F.col(f"{name}_x1")) & (F.col(f"{name}_y2") > F.col(f"{name}_y1")))


def crowded(sides: list[DataFrame], page: list[str], crowd: int) -> DataFrame:
    """(page columns, low_x, low_y, wide, high, cells): a grid for each page of over crowd boxes; about crowd of them begin in a cell."""
    each = [x.select(*page, *[F.col(c).alias(s) for s, c in zip(SIDES, (c for c in x.columns if c[-3:] in ("_x1", "_y1", "_x2", "_y2")), strict=True)]) for x in sides]
    rows = each[0]
    for x in each[1:]:
        rows = rows.unionByName(x)
    rows = rows.groupBy(*page).agg(F.count("*").alias("n"), F.min("x1").alias("low_x"), F.min("y1").alias("low_y"), F.max("x2").alias("_x"), F.max("y2").alias("_y"))
    cells = F.ceil(F.sqrt(F.col("n") / crowd)).cast("int")
    span = lambda a, b: F.greatest(F.lit(1.0), (F.col(b) - F.col(a)) / cells)
    return rows.filter(F.col("n") > crowd).select(*page, "low_x", "low_y", span("low_x", "_x").alias("wide"), span("low_y", "_y").alias("high"))


def _cell(value: Column, low: str, step: str) -> Column:
    """Number of the cell along one side; 0 on a page without a grid."""
    return F.coalesce(F.floor((value - F.col(low)) / F.col(step)).cast("int"), F.lit(0))


def _meetings(a: DataFrame, b: DataFrame, page: list[str], also: Column | None = None, *, crowd: int | None = 4096) -> DataFrame:
    """Pairs of rows of one page (page columns, a_idx, a_x1, ..., b_idx, ...) that share some area and for which also holds. A null page
    meets none. crowd: boxes that a page may have before it is cut into cells (None: pages are never cut). Whether any page has more is
    counted first, over the page columns alone; where none has, there are no cells."""
    left, right = _flat(a, page, "a"), _flat(b, page, "b")
    low = {s: F.greatest(f"a_{s}", f"b_{s}") for s in ("x1", "y1")}
    fits = (low["x1"] < F.least("a_x2", "b_x2")) & (low["y1"] < F.least("a_y2", "b_y2"))
    fits = fits if also is None else fits & also
    names = a.select(*page) if a is b else a.select(*page).unionByName(b.select(*page))
    if crowd is None or names.groupBy(*page).count().filter(F.col("count") > crowd).isEmpty():
        return _joined(left, right, page, fits)
    grid = crowded([left] if a is b else [left, right], page, crowd)
    reach = lambda n, s, step: F.sequence(_cell(F.col(f"{n}_{s}1"), f"low_{s}", step), _cell(F.col(f"{n}_{s}2"), f"low_{s}", step))
    steps = ["low_x", "low_y", "wide", "high"]

    def in_cells(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.join(grid, page, "left").withColumn("_cx", F.explode(reach(name, "x", "wide"))).withColumn("_cy", F.explode(reach(name, "y", "high")))
        return rows if name == "a" else rows.drop(*steps)

    first = (F.col("_cx") == _cell(low["x1"], "low_x", "wide")) & (F.col("_cy") == _cell(low["y1"], "low_y", "high"))
    return _joined(in_cells(left, "a"), in_cells(right, "b"), [*page, "_cx", "_cy"], fits & first).drop("_cx", "_cy", *steps)


def _joined(left: DataFrame, right: DataFrame, on: list[str], fits: Column) -> DataFrame:
    """left and right on equal columns, where fits holds, tested as pairs are made."""
    right = right.withColumnsRenamed({c: f"_b{i}" for i, c in enumerate(on)})
    equal = [F.col(c) == F.col(f"_b{i}") for i, c in enumerate(on)]
    for e in equal:
        fits = e & fits
    return left.join(right, fits).drop(*[f"_b{i}" for i in range(len(on))])


def _box(name: str) -> Column:
    return F.struct(*[F.col(f"{name}_{s}").alias(s) for s in SIDES])


def overlaps(a: DataFrame, b: DataFrame, page: list[str], also: Column | None = None, *, crowd: int | None = 4096) -> DataFrame:
    """(page columns, a_idx, b_idx, iou) of boxes (idx, box) that share some area and for which also holds, over a_ and b_ columns."""
    return _meetings(a, b, page, also, crowd=crowd).select(*page, "a_idx", "b_idx", G.iou(_box("a"), _box("b")).alias("iou"))


def suppressed(boxes: DataFrame, page: list[str], *, least: float = 0.5, crowd: int | None = 4096) -> DataFrame:
    """boxes (page columns, idx, box) without those that a pair of more than least IoU speaks against.

    Of such a pair the smaller box goes; of equal ones the later. A box that goes still counts against others.
    """
    a, b = _box("a"), _box("b")
    pairs = _meetings(boxes, boxes, page, (F.col("a_idx") < F.col("b_idx")) & (G.iou(a, b) > least), crowd=crowd)
    gone = F.when(G.area(a) < G.area(b), F.col("a_idx")).otherwise(F.col("b_idx"))
    return boxes.join(pairs.select(*page, gone.alias("idx")).distinct(), [*page, "idx"], "left_anti")


def assigned(lines: DataFrame, zones: DataFrame, page: list[str], *, least: float = 0.001, crowd: int | None = 4096) -> DataFrame:
    """lines (page columns, idx, box) with zone and iou: the zone of most IoU, the first of equal ones.

    Lines without a zone of IoU least or more are orphans: both are null.
    """
    iou = G.iou(_box("a"), _box("b"))
    met = _meetings(lines, zones, page, iou >= least, crowd=crowd).withColumn("iou", iou)
    best = F.max_by(F.struct(F.col("b_idx").alias("zone"), "iou"), F.struct("iou", -F.col("b_idx")))
    met = met.groupBy(*page, F.col("a_idx").alias("idx")).agg(best.alias("best"))
    lines = lines.drop("zone", "iou")
    return lines.join(met, [*page, "idx"], "left").select(*lines.columns, "best.zone", "best.iou")


def link_table(truth: DataFrame, found: DataFrame, page: list[str], *, crowd: int | None = 4096) -> DataFrame:
    """(page columns, gt, dt, strength) of boxes that share some area."""
    met = _meetings(truth, found, page, crowd=crowd)
    return met.select(*page, F.col("a_idx").alias("gt"), F.col("b_idx").alias("dt"), G.link_strength(_box("a"), _box("b")).alias("strength"))


def in_rows(v: str | Column = "vpos", h: str | Column = "hpos", tie: str = "idx", height: int = 10) -> list[Column]:
    """Sort keys for lines read in rows: bands of height, then from left to right."""
    v, h = (F.col(x) if isinstance(x, str) else x for x in (v, h))
    return [F.floor(v / height), h, F.col(tie)]


def in_place(v: Column, h: Column) -> Column:
    """Sort key for zones by their tops, then left edges."""
    return v * 1_000_000 + h


def named(found: DataFrame, names: dict[int, str]) -> DataFrame:
    """Detections with label: the name of their class_id; unknown classes keep their number as text."""
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else F.lit(None).cast("map<int, string>")
    return found.withColumn("label", F.coalesce(F.try_element_at(known, F.col("class_id")), F.col("class_id").cast("string")))


def zones_only(found: DataFrame, page: list[str]) -> DataFrame:
    """Detections whose label ends with Zone, numbered anew from 0 in their order."""
    kept = found.filter(F.col("label").endswith("Zone"))
    return kept.withColumn("idx", F.row_number().over(Window.partitionBy(*page).orderBy("idx")) - 1)


def position(order: list[Column], page: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*page).orderBy(*order))
