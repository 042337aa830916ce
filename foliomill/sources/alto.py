"""ALTO pages as tables of zones, lines and texts.

Files are parsed once, by Spark's XML reader with a fixed schema; the tables are projections of that. Namespaces and their
prefixes are ignored. Numbers are read as text and cut towards zero, so "10.7" is 10. A file that is no XML has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions import geometry as G
from foliomill.functions import text as T
from foliomill.sources import files

# Zones that hold no running text.
IGNORED_ZONES = ("DigitizationArtefactZone", "MarginTextZone", "NumberingZone", "DropCapitalZone")

_BOX = "_HPOS: string, _VPOS: string, _WIDTH: string, _HEIGHT: string"
_SHAPE = "Shape: struct<Polygon: struct<_POINTS: string>>"
_LINE = f"_ID: string, {_BOX}, _TAGREFS: string, _BASELINE: string, {_SHAPE}, String: array<struct<_CONTENT: string, _WC: string>>"
_BLOCK = f"_ID: string, {_BOX}, _TAGREFS: string, {_SHAPE}, TextLine: array<struct<{_LINE}>>"
_TAG = "array<struct<_ID: string, _LABEL: string>>"
SCHEMA = (
    "Description struct<sourceImageInformation: struct<fileName: string>>, "
    f"Tags struct<OtherTag: {_TAG}, LayoutTag: {_TAG}, StructureTag: {_TAG}>, "
    f"Layout struct<Page: struct<_WIDTH: string, _HEIGHT: string, PrintSpace: struct<_HEIGHT: string, TextBlock: array<struct<{_BLOCK}>>>>>"
)


def place(path: Column) -> dict[str, Column]:
    """Document (the folder) and page (the name without its ending) of a file."""
    return {"document": files.decoded(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)), "page": files.decoded(F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1))}


def read_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row for each page: document, page, image, width, height, tags (map), other_tags (map), blocks."""
    reader = spark.read.format("xml").schema(SCHEMA).option("rowTag", "alto").option("ignoreNamespace", "true")
    rows = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(paths)
    return _pages(rows, place(F.col("_metadata.file_path")))


def parsed_pages(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for rows (document, page, xml: text), with the columns in keep. What is no XML has nulls only."""
    names = ("document", "page", *keep)
    fields = rows.select(*names, F.from_xml("xml", SCHEMA, {"ignoreNamespace": "true"}).alias("x"))
    return _pages(fields.select(*names, "x.*"), {n: F.col(n) for n in names})


def whole_text(blocks: Column) -> Column:
    """All texts of a page's lines, ignored zones too, in the order of the document, joined by spaces: page_texts() of one row, so that a
    stream has it without state."""
    contents = lambda line: F.filter(F.transform(line["String"], lambda s: s["_CONTENT"]), lambda c: c.isNotNull() & (c != ""))
    lines = F.flatten(F.transform(F.coalesce(blocks, F.array()), lambda b: F.coalesce(b["TextLine"], F.array())))
    texts = F.filter(F.transform(lines, lambda x: F.coalesce(contents(x), F.array())), lambda c: F.size(c) > 0)
    return F.array_join(F.transform(texts, lambda c: F.array_join(c, " ")), " ")


def _pages(rows: DataFrame, names: dict[str, Column]) -> DataFrame:
    entries = lambda kind: F.transform(F.coalesce(F.col(f"Tags.{kind}"), F.array().cast(_TAG)), lambda t: F.struct(t["_ID"], t["_LABEL"]))
    as_map = lambda e: F.map_from_entries(F.array_distinct(F.filter(e, lambda t: t["_ID"].isNotNull() & t["_LABEL"].isNotNull())))
    every = F.concat(entries("OtherTag"), entries("LayoutTag"), entries("StructureTag"))
    return rows.select(
        *[v.alias(k) for k, v in names.items()], F.col("Description.sourceImageInformation.fileName").alias("image"),
        G.whole(F.col("Layout.Page._WIDTH")).alias("width"), G.whole(F.col("Layout.Page._HEIGHT")).alias("height"),
        as_map(every).alias("tags"), as_map(entries("OtherTag")).alias("other_tags"), F.col("Layout.Page.PrintSpace.TextBlock").alias("blocks"),
    )


def labels(refs: Column, tags: Column) -> Column:
    """The label of each tag reference, or the reference."""
    split = F.filter(F.split(F.coalesce(refs, F.lit("")), r"\s+"), lambda r: r != "")
    return F.transform(split, lambda r: F.coalesce(F.element_at(tags, r), r))


def _box(x: str) -> Column:
    x1, y1, w, h = (F.coalesce(G.whole(F.col(f"{x}.{a}")), F.lit(0)) for a in ("_HPOS", "_VPOS", "_WIDTH", "_HEIGHT"))
    return G.box(x1, y1, x1 + w, y1 + h)


def _exploded(rows: DataFrame, keep: list, name: str, at: str, value: str) -> DataFrame:
    """keep, and a row for each element of an array. An outer explode, filtered: for a plain one Spark infers a filter on the array,
    pushes it below what makes the array, and so parses a page once more for each."""
    return rows.select(*keep, F.posexplode_outer(name).alias(at, value)).filter(F.col(at).isNotNull())


def zones(pages: DataFrame) -> DataFrame:
    """A row for each block: document, page, idx, id, label, tag_ref, box, boundary, n_lines."""
    rows = _exploded(pages, ["document", "page", "other_tags"], "blocks", "idx", "b")
    return rows.select(
        "document", "page", "idx", F.col("b._ID").alias("id"), F.coalesce(F.element_at("other_tags", F.coalesce(F.col("b._TAGREFS"), F.lit(""))), F.lit("unknown")).alias("label"),
        F.col("b._TAGREFS").alias("tag_ref"), _box("b").alias("box"), G.points(F.col("b.Shape.Polygon._POINTS"), strict=True).alias("boundary"),
        F.coalesce(F.size("b.TextLine"), F.lit(0)).alias("n_lines"),
    )


def lines(pages: DataFrame, *, ignored: tuple[str, ...] = IGNORED_ZONES, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each line outside ignored zones: document, page, zone, zone_id, region, idx, id, tags, hpos, vpos, box, baseline, boundary, text.

    idx numbers the lines of a page in the order of the document, ignored ones included. text: the contents of the line
    joined by spaces; null without any. confidence: the mean of theirs; null without any. keep: columns of pages that lines have too, so
    that they need no join with them.
    """
    names = ["document", "page", *keep, "tags"]
    blocks = _exploded(pages, names, "blocks", "zone", "b")
    region = F.get(labels(F.col("b._TAGREFS"), F.col("tags")), 0)
    rows = _exploded(blocks, [*names, "zone", F.col("b._ID").alias("zone_id"), region.alias("region")], "b.TextLine", "_at", "l")
    rows = rows.filter(F.coalesce(~F.col("region").isin(*ignored), F.lit(True)))
    scores = F.filter(F.transform("l.String", lambda s: s["_WC"].try_cast("double")), lambda c: c.isNotNull())
    contents = F.filter(F.transform("l.String", lambda s: s["_CONTENT"]), lambda c: c.isNotNull() & (c != ""))
    return rows.select(
        "document", "page", *keep, "zone", "zone_id", "region", G.let(scores, lambda s: F.try_divide(F.aggregate(s, F.lit(0.0), lambda a, x: a + x), F.size(s))).alias("confidence"), (F.col("zone").cast("long") * 100_000 + F.col("_at")).alias("idx"), F.col("l._ID").alias("id"),
        F.array_distinct(labels(F.col("l._TAGREFS"), F.col("tags"))).alias("tags"), G.whole(F.col("l._HPOS")).alias("hpos"), G.whole(F.col("l._VPOS")).alias("vpos"),
        F.when(F.col("l._HPOS").isNotNull() & F.col("l._WIDTH").isNotNull(), _box("l")).alias("box"), G.points(F.col("l._BASELINE")).alias("baseline"),
        G.points(F.col("l.Shape.Polygon._POINTS")).alias("boundary"), G.let(contents, lambda c: F.when(F.size(c) > 0, F.array_join(c, " "))).alias("text"),
    )


def with_baseline(lines: DataFrame) -> DataFrame:
    """Lines whose baseline has two points and more."""
    return lines.filter(F.size("baseline") >= 2)


def with_geometry(lines: DataFrame) -> DataFrame:
    """Lines that have a place: a polygon, a baseline, or a box, whose level middle then is the baseline."""
    made = F.when(F.col("box").isNotNull() & (F.col("box.x2") > F.col("box.x1")), G.midline(F.col("box")))
    lines = lines.withColumn("baseline", F.when(F.size("baseline") >= 2, F.col("baseline")).when(F.size("boundary") == 0, made))
    lines = lines.withColumn("boundary", F.when(F.size("boundary") > 0, F.col("boundary")))
    return lines.filter(F.col("boundary").isNotNull() | F.col("baseline").isNotNull())


def page_texts(lines: DataFrame) -> DataFrame:
    """(document, page, text): all texts of a page in the order of the document, joined by spaces."""
    inside = lines.filter("text is not null").groupBy("document", "page")
    ordered = F.array_sort(F.collect_list(F.struct("idx", "text")))
    return inside.agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("text"))


def score_boxes(lines: DataFrame, pages: DataFrame | None = None, *, pad: int = 5, scale: int = 100) -> DataFrame:
    """(document, page, idx, box, class_id, confidence) on a grid: a line's boundary, else its padded baseline. Without pages the lines
    have width and height; see lines()."""
    box = F.coalesce(G.bounds(F.col("boundary")), G.padded(G.bounds(F.col("baseline")), pad))
    sized = lines if pages is None else lines.join(pages.select("document", "page", "width", "height"), ["document", "page"])
    sized = sized.withColumn("box", box).filter("box is not null")
    grid = G.on_grid(F.col("box"), F.col("width"), F.col("height"), scale)
    return sized.select("document", "page", "idx", grid.alias("box"), F.lit(0).alias("class_id"), F.lit(1.0).alias("confidence"))


def page_texts_of(names: DataFrame, lines: DataFrame) -> DataFrame:
    """(document, page, text) of names (document, page): empty where a page has no text or its file could not be read."""
    return names.join(page_texts(lines), ["document", "page"], "left").fillna("", ["text"])


def texts_in_order(lines: DataFrame) -> DataFrame:
    """(document, page, texts): the texts of a page's lines, read in rows of 10 pixels, from left to right in a row."""
    order = F.struct(F.floor(F.coalesce("vpos", F.lit(0)) / 10), F.coalesce("hpos", F.lit(0)), F.col("idx"), F.col("text").alias("text"))
    rows = lines.filter("text is not null").groupBy("document", "page").agg(F.array_sort(F.collect_list(order)).alias("t"))
    return rows.select("document", "page", F.transform("t", lambda x: x["text"]).alias("texts"))


def seen_zones(pages: DataFrame) -> DataFrame:
    """zones() for a view of the page: a box of zeros only is that around the polygon."""
    zero = (F.col("box.x1") == 0) & (F.col("box.y1") == 0) & (F.col("box.x2") == 0) & (F.col("box.y2") == 0)
    return zones(pages).withColumn("box", F.when(zero & (F.size("boundary") > 0), G.bounds(F.col("boundary"))).otherwise(F.col("box")))


def without_prefixes(xml: Column) -> Column:
    """XML text with the prefixes of its elements' names taken off."""
    return F.regexp_replace(xml, r"(</?)[A-Za-z_][\w.-]*:", "$1")


def text_lines(lines: DataFrame) -> DataFrame:
    """Lines with a box of some width and height and a text that is not blank."""
    sized = (F.col("box.x2") > F.col("box.x1")) & (F.col("box.y2") > F.col("box.y1"))
    return lines.filter(sized & ~T.blank(F.col("text")))
