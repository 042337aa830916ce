"""Tasks: recognition models as plug-ins that see Arrow batches, and the jobs that predict and score around them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions import geometry as G
from foliomill.functions import text as T
from foliomill.operators import detection, order
from foliomill.plans import reports
from foliomill.sinks import alto as out
from foliomill.sinks import paths
from foliomill.sources import alto, files

PAGE = ["document", "page"]


class UnknownTask(ValueError):
    """A name that no registered task has."""

    def __init__(self, name: str):
        super().__init__(f"unknown task {name!r}; known: {', '.join(sorted(TASKS))}")


class Recogniser(Protocol):
    """A model. Made once in each worker from its config; process() gets line rows and gives (id, text, confidence) for them."""

    def process(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]: ...


class Detector(Protocol):
    """A model of layouts. process() gets (document, page, image) and gives DETECTED rows: a box each. A page's size comes with
    each of its rows; a page without boxes has one row, of a null idx."""

    def process(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]: ...


class Segmenter(Protocol):
    """A model of lines. process() gets (document, page, image, width, height, regions: array of label and boundary) and gives
    SEGMENTED rows: a line each."""

    def process(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]: ...


DETECTED = "document string, page string, width int, height int, idx int, label string, x1 int, y1 int, x2 int, y2 int, confidence double"
_POINTS = "array<struct<x: int, y: int>>"
SEGMENTED = f"document string, page string, idx int, id string, baseline {_POINTS}, boundary {_POINTS}"
_REGIONS = pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32())]))

TASKS: dict[str, Callable[[dict], Recogniser | Detector | Segmenter]] = {}


def task(name: str, *aliases: str):
    """Register a factory of recognisers under names that are matched whatever their case."""

    def add(factory):
        for n in (name, *aliases):
            TASKS[n.upper()] = factory
        return factory

    return add


def created(name: str, config: dict | None = None) -> Recogniser | Detector | Segmenter:
    if name.upper() not in TASKS:
        raise UnknownTask(name)
    return TASKS[name.upper()](config or {})


@task("StubHTR")
class Stub:
    """A recogniser without a model: the text is made from the line's id, so runs can be compared."""

    def __init__(self, config: dict):
        self.text = config.get("text", "line {id}")

    def process(self, batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("id")).to_pylist()
            columns = [b.column(b.schema.get_field_index(c)) for c in ("document", "page", "id")]
            texts = pa.array([self.text.format(id=i) for i in ids])
            yield pa.RecordBatch.from_arrays([*columns, texts, pa.array([1.0] * len(ids))], ["document", "page", "id", "text", "confidence"])


def _record(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    """Rows as a batch of a schema given as text."""
    types = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), _POINTS: _REGIONS}
    fields = [f.split(" ", 1) for f in kinds.replace(_POINTS, "points").split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    arrays = [pa.array(x, types.get(kind, _REGIONS)) for x, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


@task("StubLayout")
class StubLayout:
    """A detector without a model: the same boxes (label, x1, y1, x2, y2) on every page."""

    def __init__(self, config: dict):
        self.size = (config.get("width", 600), config.get("height", 800))
        self.boxes = config.get("boxes", [["MainZone", 50, 50, 550, 750]])

    def process(self, batches):
        for b in batches:
            rows = []
            for document, page in zip(b["document"].to_pylist(), b["page"].to_pylist(), strict=True):
                own = [(document, page, *self.size, i, label, *box, 1.0) for i, (label, *box) in enumerate(self.boxes)]
                rows += own or [(document, page, *self.size, *[None] * 7)]
            yield _record(rows, DETECTED)


@task("StubLine")
class StubLine:
    """A segmenter without a model: lines of even height from top to bottom of each region, or of a page without regions."""

    def __init__(self, config: dict):
        self.lines = config.get("lines", 3)

    def process(self, batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                regions = [x["boundary"] for x in r["regions"] or ()] or [[{"x": 0, "y": 0}, {"x": r["width"] or 0, "y": r["height"] or 0}]]
                n = 0
                for points in regions:
                    xs, ys = [p["x"] for p in points], [p["y"] for p in points]
                    step = (max(ys) - min(ys)) // self.lines
                    for k in range(self.lines):
                        left, right, top = min(xs), max(xs), min(ys) + k * step
                        corners = [(left, top), (right, top), (right, top + step), (left, top + step)]
                        at = lambda own: [{"x": x, "y": y} for x, y in own]
                        rows.append((r["document"], r["page"], n, f"line_{n}", at([(left, top + step // 2), (right, top + step // 2)]), at(corners)))
                        n += 1
            yield _record(rows, SEGMENTED)


def detect(images: DataFrame, name: str, config: dict | None = None) -> DataFrame:
    """DETECTED rows of images (document, page, image)."""
    created(name, config)  # unknown names fail before any task
    n = images.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = images.select(*PAGE, "image").repartition(int(n), *PAGE)  # a task's images are few and its model costs more than they do
    return rows.mapInArrow(lambda batches: created(name, config).process(batches), DETECTED)


def segment(pages: DataFrame, zones: DataFrame, images: DataFrame, name: str, config: dict | None = None) -> DataFrame:
    """SEGMENTED rows of pages (document, page, width, height) with images, from the regions of their zones outside ignored ones."""
    created(name, config)
    shape = F.when(F.size("boundary") > 0, F.col("boundary")).otherwise(G.polygon(F.col("box")).cast(G.POINTS))
    own = zones.filter(~F.col("label").isin(*alto.IGNORED_ZONES)).groupBy(*PAGE)
    own = own.agg(F.array_sort(F.collect_list(F.struct("idx", "label", shape.alias("boundary")))).alias("_z"))
    rows = pages.select(*PAGE, "width", "height").join(images, PAGE).join(own, PAGE, "left")
    regions = F.transform("_z", lambda z: F.struct(z["label"].alias("label"), z["boundary"].alias("boundary")))
    rows = rows.select(*PAGE, "image", "width", "height", regions.alias("regions"))
    return rows.mapInArrow(lambda batches: created(name, config).process(batches), SEGMENTED)


def predict_layout(images: DataFrame, name: str, config: dict | None = None, *, reading_order: str = "dbscan") -> DataFrame:
    """(document, page, xml): pages of images (document, page, image) with blocks: detections without doubles, in reading order."""
    found = paths.shuffled(paths.written(detect(images, name, config), "detections"))
    sizes = found.groupBy(*PAGE).agg(F.max("width").alias("width"), F.max("height").alias("height"))
    box = F.struct(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("box")
    blocks = out.from_detections(found.filter("idx is not null").select(*PAGE, "idx", "label", box), PAGE, reading_order=reading_order)
    pages = images.select(*PAGE, F.regexp_extract("image", r"([^/]+)$", 1).alias("image")).join(sizes, PAGE)
    return out.rendered(pages, blocks, _no_lines(blocks))


def _no_lines(like: DataFrame) -> DataFrame:
    kinds = f"document string, page string, zone int, id string, box struct<x1: int, y1: int, x2: int, y2: int>, baseline {_POINTS}, boundary {_POINTS}, text string, confidence double, position int"
    return like.sparkSession.createDataFrame([], kinds)


def predict_lines(pages: DataFrame, images: DataFrame, name: str, config: dict | None = None, *, reading_order: str = "dbscan") -> DataFrame:
    """(document, page, xml): pages with newly found lines in their blocks (see inserted()). Pages without an image are left out."""
    pages = paths.shuffled(pages)
    zones = alto.zones(pages)
    found = paths.shuffled(paths.written(segment(pages, zones, images, name, config), "segments"))
    blocks, lines = out.inserted(zones, found.withColumn("idx", F.col("idx").cast("long")), PAGE, reading_order=reading_order)
    lines = lines.withColumn("text", F.lit("")).withColumn("confidence", F.lit(0.0))
    return out.rendered(pages.join(images.select(*PAGE), PAGE, "left_semi"), blocks, lines)


def recognise(lines: DataFrame, name: str, config: dict | None = None, *, batch: int | None = None, images: DataFrame | None = None) -> DataFrame:
    """(document, page, id, text, confidence) of lines (with geometry). Lines of a page stay together, so its image is read once.

    images (document, page, image): paths that the model gets beside the lines; lines of pages without one are left out.
    """
    created(name, config)  # unknown names fail before any task
    rows = lines.filter(~F.coalesce(G.degenerate(F.col("baseline")), F.lit(False)))
    rows = rows.withColumn("image", F.lit(None).cast("string")) if images is None else rows.drop("image").join(images, PAGE)
    rows = rows.repartition("document", "page").sortWithinPartitions("document", "page", "idx")
    rows = rows.select("document", "page", "id", "idx", "baseline", "boundary", "image")

    def run(batches):
        cut = (b.slice(i, batch or b.num_rows or 1) for b in batches for i in range(0, b.num_rows, batch or b.num_rows or 1))
        yield from created(name, config).process(cut)

    return rows.mapInArrow(run, "document string, page string, id string, text string, confidence double")


def cleaned_output(lines: DataFrame, extended: bool = False) -> DataFrame:
    """Recognised lines without repeats of the line before in a block, then with clean texts."""
    kept = order.without_repeats(lines, [*PAGE, "zone"])
    return kept.withColumn("text", T.cleaned(F.col("text"), extended))


def predict_texts(pages: DataFrame, done: DataFrame, name: str, config: dict | None = None, **options) -> DataFrame:
    """Lines with recognised, cleaned texts of the pages that done (document, page) does not have."""
    left = paths.shuffled(files.remaining(pages, done, PAGE))
    lines = alto.with_baseline(alto.lines(left))
    results = recognise(lines, name, config, **options)
    return cleaned_output(out.recognised(out.without_text(lines), results))


def predict_pages(pages: DataFrame, done: DataFrame, name: str, config: dict | None = None, **options) -> DataFrame:
    """(document, page, xml): pages with recognised texts, of those that done does not have. Blocks and lines stay as they are;
    files that could not be read are left out. done is fixed first, as the output may go to where it was read from."""
    done = paths.joined_small(paths.written(done.select(*PAGE), "done-pages"))
    left = paths.shuffled(files.remaining(pages.filter("width is not null or blocks is not null"), done, PAGE))
    lines = predict_texts(left, done, name, config, **options).withColumn("position", F.col("idx"))
    return out.rendered(left, alto.zones(left).withColumn("position", F.col("idx")), lines)


def cleaned_counts(lines: DataFrame, extended: bool = False) -> DataFrame:
    """(document, page, modified): how many texts of a page cleaning changes."""
    changed = F.coalesce(T.cleaned(F.col("text"), extended) != F.col("text"), F.lit(False))
    return lines.groupBy(*PAGE).agg(F.count_if(changed).alias("modified"))


def by_document(rows: DataFrame, each, schema: str) -> DataFrame:
    """each(a document's rows as a pandas frame) of every document: for jobs that need a document whole; it has to fit a worker."""
    return rows.groupBy("document").applyInPandas(each, schema)


def _pairs(truth: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines, those of ignored zones too, of the pages that both sides have."""
    both = truth.select(*PAGE).distinct().join(found.select(*PAGE).distinct(), PAGE)
    return tuple(alto.lines(side, ignored=()).join(both, PAGE, "left_semi") for side in (truth, found))


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with a place, outside ignored zones."""
    return alto.with_geometry(lines.filter(F.coalesce(~F.col("region").isin(*alto.IGNORED_ZONES), F.lit(True))))


def box_report(true_boxes: DataFrame, found_boxes: DataFrame, pages: DataFrame, stats: DataFrame | None = None) -> dict[str, DataFrame]:
    """Scores of boxes on pages where both sides have some: scores_all_pages (pages), scores_per_document, metrics (key, value: means of
    documents), results (one wide row), precision (by threshold, over all pages), and of stats, areas by page, results_zonemap."""
    hits = paths.written(detection.hits(true_boxes, found_boxes, PAGE), "box-hits")
    on_both = true_boxes.join(found_boxes.select(*PAGE).distinct(), PAGE, "left_semi")
    each, keys = detection.dataset_scores(hits, on_both, PAGE, ["document"]), list(reports.BOX_KEYS)
    if stats is not None:
        each, keys = each.unionByName(reports.zone_keys(stats)), [*keys, *(k for k in reports.ZONE_KEYS if "char_" not in k and "word_" not in k)]
    each = paths.written(each.filter(F.col("key").isin(*keys)), "document-scores")
    metrics = reports.over_all(each)
    out = {"scores_all_pages": pages, "scores_per_document": reports.by_document(each, pages, keys), "metrics": metrics, "results": reports.results_row(metrics)}
    out["precision"] = detection.average_precision(hits, on_both)
    if stats is not None:
        out["results_zonemap"] = reports.zone_report(metrics, recognition=False)
    return out


def _counted(truth: DataFrame, found: DataFrame, boxes: tuple[DataFrame, DataFrame], what: str) -> DataFrame:
    """(document, page, gt_<what>, pred_<what>) of pages where both sides have boxes."""
    count = lambda rows, side: rows.groupBy(*PAGE).agg(F.count("*").alias(f"{side}_{what}"))
    rows = count(truth, "gt").join(count(found, "pred"), PAGE)
    for side in boxes:
        rows = rows.join(side.select(*PAGE).distinct(), PAGE, "left_semi")
    return rows


def score_lines(truth: DataFrame, found: DataFrame) -> dict[str, DataFrame]:
    """Segmentation scores by document: average precision over thresholds, and areas by configuration. True lines need a baseline for the
    first. Pages on which a side has no lines are left out of both."""
    a, b = _pairs(truth, found)
    a, b = _placed(a), _placed(b)
    lines = alto.with_baseline(a)
    true_boxes, found_boxes = alto.score_boxes(lines, truth), alto.score_boxes(b, found)
    on = lambda side, other: side.join(other.select(*PAGE).distinct(), PAGE, "left_semi")
    stats = detection.zone_map(on(a, b), on(b, a), PAGE, with_text=False)
    return box_report(true_boxes, found_boxes, _counted(lines, b, (true_boxes, found_boxes), "lines"), stats)


def score_layout(truth: DataFrame, found: DataFrame) -> dict[str, DataFrame]:
    """Layout scores by document: average precision of blocks, whatever their labels. Pages on which a side has no blocks are left out."""

    def grid(pages):
        sized = alto.zones(pages).join(pages.select(*PAGE, "width", "height"), PAGE)
        box = F.coalesce(alto.G.bounds(F.col("boundary")), F.col("box"))
        return sized.select(*PAGE, F.col("idx").cast("long").alias("idx"), alto.G.on_grid(box, F.col("width"), F.col("height")).alias("box"), F.lit(1.0).alias("confidence"))

    a, b = grid(truth), grid(found)
    return box_report(a, b, _counted(a, b, (a, b), "zones"))


SCORERS = {"layout": score_layout, "line": score_lines, "htr": reports.text_report}


def scoreable(pages: DataFrame) -> DataFrame:
    """One row: layout, line, htr: whether any page has blocks, lines, texts."""
    has = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    lines = F.flatten(F.transform("blocks", lambda b: F.coalesce(b["TextLine"], F.array())))
    texts = F.exists(lines, lambda x: F.exists(x["String"], lambda s: s["_CONTENT"] != ""))
    return pages.agg(has(F.size("blocks") > 0).alias("layout"), has(F.size(lines) > 0).alias("line"), has(texts).alias("htr"))


def training_lines(lines: DataFrame, images: DataFrame) -> DataFrame:
    """Samples (document, page, id, boundary, text, image) of lines with a text and an image."""
    named = files.best_images(images).withColumnsRenamed({"folder": "document", "stem": "page"})
    return lines.filter(~T.blank(F.col("text")) & (F.size("boundary") > 0)).join(named, PAGE).select(*PAGE, "id", "boundary", "text", "image")


def training_blocks(lines: DataFrame, *, size: int = 40) -> DataFrame:
    """Samples (document, page, chunk, text): each size lines of a page, a line each."""
    chunked = order.chunks(lines.filter(~T.blank(F.col("text"))), PAGE, size=size)
    ordered = F.array_sort(F.collect_list(F.struct("idx", "text")))
    return chunked.groupBy(*PAGE, "chunk").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))


def training_pages(lines: DataFrame, images: DataFrame) -> DataFrame:
    """Samples (document, page, text, image) of whole pages with a text and an image: one page, one text."""
    named = files.best_images(images).withColumnsRenamed({"folder": "document", "stem": "page"})
    return alto.page_texts(lines).filter(~T.blank(F.col("text"))).join(named, PAGE)


def corpus_samples(spark: SparkSession, path: str, *, width: int = 1024) -> DataFrame:
    """(text): lines of a text corpus, blank ones left out, long ones wrapped."""
    rows = spark.read.text(path).filter("value <> ''")
    return rows.select(F.explode(T.wrapped(F.col("value"), width)).alias("text"))
