"""ALTO output: rows become lines, lines blocks, blocks pages, all as one text value for each page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions import geometry as G
from foliomill.functions import text as T
from foliomill.operators import boxes, order
from foliomill.sinks import exports, paths
from foliomill.sources.alto import IGNORED_ZONES

NAMESPACE = "http://www.loc.gov/standards/alto/ns-v4#"
PAGE = ("document", "page")


def escaped(value: Column) -> Column:
    """A value for an attribute in double quotes."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;")):
        value = F.replace(value, F.lit(a), F.lit(b))
    return value


def unescaped(value: Column) -> Column:
    """The value of an attribute as it stands in a file: named and numbered signs replaced."""
    parts = F.when(value.contains("&#"), F.regexp_extract_all(value, F.lit(r"(&#x?[0-9A-Fa-f]+;|[^&]+|&)"), F.lit(1))).otherwise(F.array(value))

    def sign(p: Column) -> Column:
        code = F.when(p.startswith("&#x"), F.conv(F.regexp_extract(p, "&#x([0-9A-Fa-f]+);", 1), 16, 10)).otherwise(F.regexp_extract(p, "&#([0-9]+);", 1))
        utf32 = F.lpad(F.hex(code.try_cast("int")), 8, "0")
        return F.when(p.startswith("&#") & p.endswith(";"), F.coalesce(F.decode(F.unhex(utf32), "UTF-32"), p)).otherwise(p)

    out = F.array_join(F.transform(parts, sign), "")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def with_clean_texts(pages: DataFrame, extended: bool = False) -> DataFrame:
    """pages (xml, ...) with xml, whose texts are cleaned and all else is as it was, and modified: how many texts that changed."""
    before, value = (F.regexp_extract_all("xml", F.lit(r"""(?s)(.*?\sCONTENT\s*=\s*)("[^"]*"|'[^']*')"""), F.lit(i)) for i in (1, 2))
    inside = lambda v: F.substring(v, F.lit(2), F.length(v) - 2)
    pieces = F.zip_with(before, value, lambda b, v: F.struct(b.alias("before"), v.alias("value"), unescaped(inside(v)).alias("old")))
    pieces = F.transform(pieces, lambda x: F.struct(x["before"].alias("before"), x["value"].alias("value"), x["old"].alias("old"), T.cleaned(x["old"], extended).alias("new")))
    new = lambda x: F.when(x["old"] == x["new"], x["value"]).otherwise(F.concat(F.lit('"'), escaped(x["new"]), F.lit('"')))
    made = F.struct(
        F.array_join(F.transform("_pieces", lambda x: F.concat(x["before"], new(x))), "").alias("text"),
        F.aggregate("_pieces", F.lit(0), lambda n, x: n + F.length(x["before"]) + F.length(x["value"])).alias("size"),
        F.size(F.filter("_pieces", lambda x: x["old"] != x["new"])).alias("modified"),
    )
    rows = pages.withColumn("_pieces", pieces).withColumn("_made", made)
    tail = F.substring("xml", F.col("_made.size") + 1, F.length("xml"))
    return rows.withColumns({"xml": F.concat("_made.text", tail), "modified": F.col("_made.modified")}).drop("_pieces", "_made")


def element(name: str, attributes: dict[str, Column], inner: Column | None = None, numbers: dict[str, Column] | None = None) -> Column:
    """An element; attributes that are null are left out. numbers: attributes of digits, which need no escapes."""
    values = {k: escaped(v.cast("string")) for k, v in attributes.items()} | {k: v.cast("string") for k, v in (numbers or {}).items()}
    parts = [F.coalesce(F.concat(F.lit(f' {k}="'), v, F.lit('"')), F.lit("")) for k, v in values.items()]
    head = F.concat(F.lit(f"<{name}"), *parts)
    return F.concat(head, F.lit("/>")) if inner is None else F.concat(head, F.lit(">"), inner, F.lit(f"</{name}>"))


def placed(b: Column) -> dict[str, Column]:
    return {"HPOS": b["x1"], "VPOS": b["y1"], "WIDTH": b["x2"] - b["x1"], "HEIGHT": b["y2"] - b["y1"]}


def flat(points: Column) -> Column:
    r"""x y x y ... of points; null for none."""
    return F.when(F.size(points) > 0, F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["x"], p["y"])), " "))


def recognised(lines: DataFrame, results: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """lines with the text and confidence of results (page columns, id, text, confidence); old texts never stay.

    Lines without a result, or with an empty one, have an empty text and confidence 0. Of several results for an id the one of most
    confidence counts, of equal ones the last text.
    """
    best = F.max(F.struct(F.col("confidence").alias("_confidence"), F.col("text").alias("_text"))).alias("_best")
    new = results.groupBy(*page, "id").agg(best).select(*page, "id", "_best.*")
    rows = lines.drop("confidence").join(paths.shuffled(new), [*page, "id"], "left")
    filled = F.coalesce(F.col("_text"), F.lit("")) != ""
    return rows.withColumn("text", F.when(filled, F.col("_text")).otherwise("")).withColumn(
        "confidence", F.when(filled, F.coalesce("_confidence", F.lit(0.0))).otherwise(F.lit(0.0))
    ).drop("_text", "_confidence")


def recognised_in_order(lines: DataFrame, texts: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """The same for texts (page columns, position from 1, text, confidence) in the order of lines; what one side has too much is left."""
    numbered = lines.withColumn("_n", boxes.position([F.col("idx")], list(page)))
    results = texts.join(numbered.select(*page, "id", F.col("_n").alias("position")), [*page, "position"])
    return recognised(lines, results.select(*page, "id", "text", "confidence"), page)


def without_text(lines: DataFrame) -> DataFrame:
    return lines.withColumn("text", F.lit("")).withColumn("confidence", F.lit(0.0))


def with_split_text(pages: DataFrame, lines: DataFrame, zones: DataFrame, texts: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """Lines with the parts of each page's text (page columns, text), cut at line breaks.

    As many parts as lines are given to them in the order of the document. Else new lines are laid evenly down the page (its
    height over their number, 10 off each side and the top) and belong to its first block, the only one that then holds lines;
    a page without a block has none.
    """
    counted = lines.groupBy(*page).agg(F.count("*").alias("_lines"))
    first = zones.groupBy(*page).agg(F.min_by(F.struct("id", F.col("idx").alias("zone")), "idx").alias("_zone"))
    rows = texts.select(*page, T.lines(F.col("text")).alias("_parts")).join(counted, list(page), "left").join(first, list(page), "left")
    rows = rows.join(pages.select(*page, F.col("width").alias("_width"), F.col("height").alias("_height")), list(page), "left")
    rows = rows.withColumn("_same", F.coalesce(F.col("_lines"), F.lit(0)) == F.size("_parts"))
    numbered = lines.withColumn("_n", boxes.position([F.col("idx")], list(page)))
    same = numbered.join(rows.filter("_same").select(*page, "_parts"), list(page))
    same = same.select(*page, "zone", "idx", "id", "box", "baseline", "boundary", F.get("_parts", F.col("_n") - 1).alias("text"))
    new = rows.filter("not _same and _zone is not null")
    new = new.select(*page, "_zone", "_width", "_height", F.size("_parts").alias("_size"), F.posexplode("_parts").alias("_at", "text"))
    step, margin = F.floor(F.col("_height") / F.col("_size")).cast("int"), 10
    top, right = F.col("_at") * step + margin, F.col("_width") - margin
    box = G.box(F.lit(margin), top, right, top + step - margin)
    middle = (top + F.floor(step / 2)).cast("int")
    baseline = F.array(F.struct(F.lit(margin).alias("x"), middle.alias("y")), F.struct(right.alias("x"), middle.alias("y")))
    new = new.select(
        *page, F.col("_zone.zone").alias("zone"), F.col("_at").cast("long").alias("idx"), F.concat(F.lit("line_"), F.col("_at").cast("string")).alias("id"),
        box.alias("box"), baseline.alias("baseline"), G.polygon(box).cast(G.POINTS).alias("boundary"), "text",
    )
    return same.unionByName(new)


def inserted(zones: DataFrame, lines: DataFrame, page: Sequence[str] = PAGE, *, reading_order: str = "dbscan", eps: int = 200) -> tuple[DataFrame, DataFrame]:
    """Blocks in reading order and lines put into them, from zones and newly found lines (with a boundary).

    A line goes to the block of most IoU, 0.001 at least; others become blocks of their own, pseudo_block_0 and on. Ignored
    zones and lines without a boundary are left out. Lines of a block are in the order of their middles.
    """
    page = list(page)
    zones = zones.filter(~F.col("label").isin(*IGNORED_ZONES))
    lines = lines.filter(F.size("boundary") > 0).withColumn("box", G.bounds(F.col("boundary")))
    put = boxes.assigned(lines, zones.select(*page, "idx", "box"), page)
    orphan = put.filter("zone is null").withColumn("_k", boxes.position([F.col("idx")], page) - 1)
    last = zones.groupBy(*page).agg((F.max("idx") + 1).alias("_next"))
    orphan = orphan.join(last, page, "left").withColumn("zone", F.coalesce("_next", F.lit(0)) + F.col("_k"))
    own = orphan.select(*page, F.col("zone").alias("idx"), F.concat(F.lit("pseudo_block_"), F.col("_k").cast("string")).alias("id"), F.lit("").alias("label"), "box")
    blocks = zones.select(*page, "idx", "id", "label", "box").unionByName(own)
    filled = put.filter("zone is not null").select(*lines.columns, "zone").unionByName(orphan.select(*lines.columns, "zone"))
    tops = filled.select(*page, "zone", F.col("box.y1").alias("y"))
    blocks = order.reading_order(order.with_first_y(blocks, paths.shuffled(tops), page), page, reading_order, eps=eps)
    middle = (F.col("box.y1") + F.col("box.y2")) / 2
    filled = filled.withColumn("position", boxes.position([middle, F.col("idx")], [*page, "zone"]))
    return blocks, filled


def rendered(pages: DataFrame, blocks: DataFrame, lines: DataFrame, page: Sequence[str] = PAGE) -> DataFrame:
    """(page columns, xml) from pages (image, width, height), blocks (idx, id, label, box, position) and lines (zone, id, box,
    baseline, boundary, text, confidence, position)."""
    page = list(page)
    confidence = F.format_string("%.4f", F.coalesce("confidence", F.lit(0.0)))
    content = element("String", {"CONTENT": F.coalesce(F.col("text"), F.lit(""))}, numbers={"WC": confidence})
    shape = lambda p: F.coalesce(element("Shape", {}, element("Polygon", {}, numbers={"POINTS": flat(p)})), F.lit(""))
    has = F.when(F.size("boundary") > 0, shape(F.col("boundary"))).otherwise("")
    line = element("TextLine", {"ID": F.col("id")}, F.concat(has, content), {"BASELINE": flat(F.col("baseline")), **placed(F.col("box"))})
    inside = lines.select(*page, F.col("zone").alias("idx"), F.struct("position", line.alias("xml")).alias("l"))
    inside = inside.groupBy(*page, "idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["xml"]), "").alias("lines"))
    rows = blocks.join(paths.shuffled(inside), [*page, "idx"], "left")
    tag = F.when(F.col("label") != "", F.concat(F.lit("BT"), G.tag_id(F.col("label")).cast("string")))
    block = element("TextBlock", {"ID": F.col("id"), "TAGREFS": tag, **placed(F.col("box"))}, F.coalesce("lines", F.lit("")))
    entry = F.when(F.col("label") != "", element("OtherTag", {"ID": tag, "LABEL": F.col("label"), "DESCRIPTION": F.concat(F.lit("block type "), "label")}))
    rows = rows.groupBy(*page).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", block.alias("xml")))), lambda x: x["xml"]), "").alias("blocks"),
        F.array_join(F.array_sort(F.collect_set(entry)), "").alias("entries"),
    )
    rows = pages.select(*page, "image", "width", "height").join(paths.shuffled(rows), page, "left")
    size = {"HEIGHT": F.col("height"), "WIDTH": F.col("width")}
    layout = element("Page", {"ID": F.lit("page1"), "PHYSICAL_IMG_NR": F.lit(1), **size}, element("PrintSpace", {**size, "VPOS": F.lit(0), "HPOS": F.lit(0)}, F.coalesce("blocks", F.lit(""))))
    head = F.concat(F.lit("<Description><MeasurementUnit>pixel</MeasurementUnit><sourceImageInformation><fileName>"), escaped(F.coalesce("image", F.lit(""))), F.lit("</fileName></sourceImageInformation></Description>"))
    whole = F.concat(head, element("Tags", {}, F.coalesce("entries", F.lit(""))), element("Layout", {}, layout))
    return rows.select(*page, F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>'), element("alto", {"xmlns": F.lit(NAMESPACE)}, whole)).alias("xml"))


def minimal(images: DataFrame, page: Sequence[str] = PAGE, *, margin: int = 5) -> tuple[DataFrame, DataFrame]:
    """Blocks and lines of pages of one line: images (page columns, width, height, text, maybe region); the line fills all but the
    margin."""
    box = G.box(F.lit(margin), F.lit(margin), F.col("width") - margin, F.col("height") - margin)
    label = F.coalesce("region", F.lit("MainZone")) if "region" in images.columns else F.lit("MainZone")
    blocks = images.select(*page, F.lit(0).alias("idx"), F.lit("block_0").alias("id"), label.alias("label"), box.alias("box"), F.lit(1).alias("position"))
    lines = images.select(
        *page, F.lit(0).alias("zone"), F.lit(0).cast("long").alias("idx"), F.lit("line_0").alias("id"), box.alias("box"), G.midline(box).alias("baseline"),
        G.polygon(box).cast(G.POINTS).alias("boundary"), "text", F.lit(1.0).alias("confidence"), F.lit(1).alias("position"),
    )
    return blocks, lines


def named_line_images(rows: DataFrame) -> DataFrame:
    """rows (shelfmark, region, text, width, height, ...) with document and page: the folder of the shelfmark, and a name of it and the
    row's number there, in the order of text and then of all columns, so that every run gives the same names."""
    tied = rows.withColumn("_tie", F.xxhash64(*rows.columns))
    named = exports.numbered_names(tied, F.col("shelfmark"), ["text", "_tie"])
    return named.withColumn("document", T.file_name(F.col("shelfmark"))).withColumnRenamed("file", "page").drop("_tie")


def from_line_images(rows: DataFrame, *, margin: int = 2) -> DataFrame:
    """(document, page, xml) of line images: a page for each row, see named_line_images(). A row's image is <page>.jpg."""
    images = named_line_images(rows).withColumn("image", F.concat("page", F.lit(".jpg")))
    return rendered(images.select(*PAGE, "image", "width", "height"), *minimal(images, margin=margin))


def line_image_files(rows: DataFrame) -> DataFrame:
    """(document, name, data) of rows whose image is binary, or a struct with bytes: the file of each, as its row has it."""
    kind = dict(rows.dtypes).get("image", "")
    data = F.col("image") if kind == "binary" else F.col("image.bytes") if "bytes:binary" in kind else F.lit(None).cast("binary")
    return named_line_images(rows).select("document", F.concat("page", F.lit(".jpg")).alias("name"), data.alias("data")).filter("data is not null")


def from_detections(found: DataFrame, page: Sequence[str] = PAGE, *, reading_order: str = "dbscan", **options) -> DataFrame:
    """Blocks (idx, id, label, box, position) of layout detections (idx, label, box): ignored labels and doubles go, the rest is
    put into reading order and named by it."""
    page = list(page)
    kept = boxes.suppressed(found.filter(~F.col("label").isin(*IGNORED_ZONES)), page)
    kept = order.reading_order(order.with_first_y(kept, None, page), page, reading_order, **options)
    return kept.withColumn("id", F.concat(F.lit("block_"), (F.col("position") - 1).cast("string")))


def write_files(rows: DataFrame, folder: str) -> None:
    """(document, name, data: binary) as files, written by the tasks through pyarrow's file systems, in a folder for each document.

    Each attempt writes under a name of its own and renames the whole file, so attempts that overlap leave one whole file. folder is
    named as Spark names it.
    """
    folder = paths.qualified(rows.sparkSession, folder)

    def run(batch):
        system, base = paths.opened(folder)
        attempt = TaskContext.get().taskAttemptId()
        for r in batch:
            where = f"{base}/{r.document}" if r.document else base
            system.create_dir(where, recursive=True)
            path = f"{where}/{r.name}"
            with system.open_output_stream(f"{path}.{attempt}.part", compression=None) as out:
                out.write(r.data)
            system.move(f"{path}.{attempt}.part", path)

    rows.select("document", "name", "data").foreachPartition(run)


def copy_files(rows: DataFrame, folder: str) -> None:
    """(document, name, source): copies of the files at source, piece by piece, as write_files() writes its own."""
    folder = paths.qualified(rows.sparkSession, folder)

    def run(batch):
        system, base = paths.opened(folder)
        attempt = TaskContext.get().taskAttemptId()
        for r in batch:
            where = f"{base}/{r.document}" if r.document else base
            system.create_dir(where, recursive=True)
            path = f"{where}/{r.name}"
            own, at = paths.opened(r.source)
            with own.open_input_stream(at) as source, system.open_output_stream(f"{path}.{attempt}.part", compression=None) as out:
                while piece := source.read(1 << 20):
                    out.write(piece)
            system.move(f"{path}.{attempt}.part", path)

    rows.select("document", "name", "source").foreachPartition(run)


def write_pages(rows: DataFrame, folder: str, *, files: bool = False) -> None:
    """(document, page, xml) as text, a folder for each document.

    files: a file for each page instead of Spark's part files; see write_files().
    """
    if files:
        write_files(rows.select("document", F.concat("page", F.lit(".xml")).alias("name"), F.col("xml").cast("binary").alias("data")), folder)
    else:
        rows.select("document", F.col("xml").alias("value")).write.partitionBy("document").text(folder)
