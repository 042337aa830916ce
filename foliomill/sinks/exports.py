"""Exports: score tables, texts, line files for detectors, chat samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions import geometry as G
from foliomill.operators import rollup
from foliomill.sinks import paths


def write_csv(rows: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    out = rows.write.option("header", "true")
    (out.partitionBy(*by) if by else out).csv(path)


def page_text_files(lines: DataFrame, page: Sequence[str] = ("document", "page")) -> DataFrame:
    """(page columns, value): the texts of a page's lines, a line each, in the order of the document."""
    ordered = F.array_sort(F.collect_list(F.struct("idx", F.coalesce("text", F.lit("")).alias("text"))))
    return lines.groupBy(*page).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("value"))


def last_texts(lines: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by columns, id, text): for an id that several files have, the last by order; lines without id are left out, null texts are
    empty."""
    rows = lines.filter("id is not null").groupBy(*by, "id")
    return rows.agg(F.max_by(F.coalesce("text", F.lit("")), F.struct(*order)).alias("text"))


def as_json(texts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by columns, value): a JSON object of id and text for each group, ids in order; without columns one for each id.

    A group (a document, say) is one value, so it has to fit into a row; a corpus is many objects.
    """
    if not by:
        return texts.select(F.to_json(F.create_map("id", "text")).alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("id", "text")))
    return texts.groupBy(*by).agg(F.to_json(F.map_from_entries(ordered)).alias("value"))


def yolo_rows(
    lines: DataFrame, pages: DataFrame | None = None, page: Sequence[str] = ("document", "page"), *, polygons: bool = False, pad: int = 20, keep: Sequence[str] = ()
) -> DataFrame:
    """(page columns, keep, idx, value) of lines with a boundary, or with a baseline, whose bounds are padded. Without pages the lines have
    width and height; see alto.lines()."""
    sized = lines if pages is None else lines.join(pages.select(*page, "width", "height"), list(page))
    kind = F.create_map(*[F.lit(x) for kv in G.LINE_TYPES.items() for x in kv])[G.line_type(F.col("tags"))]
    sized = G.fixed(sized, "boundary", "baseline").filter((F.size("boundary") > 0) | (F.size("baseline") >= 2))
    around = F.when(F.size("boundary") > 0, G.bounds(F.col("boundary"))).otherwise(G.padded(G.bounds(F.col("baseline")), pad))
    sized = sized.withColumn("_box", around)
    shape = F.when(F.size("boundary") > 0, F.col("boundary")).otherwise(G.polygon(F.col("_box")).cast(G.POINTS))
    row = G.polygon_row(kind, shape, F.col("width"), F.col("height")) if polygons else G.detection_row(kind, F.col("_box"), F.col("width"), F.col("height"))
    return sized.select(*page, *keep, "idx", row.alias("value"))


def conversation(prompt: Column, image: Column, answer: Column) -> Column:
    """A training sample as messages: a user's text and image, an assistant's text."""
    part = lambda kind, text, path: F.struct(F.lit(kind).alias("type"), text.alias("text"), path.alias("image_path"))
    none = F.lit(None).cast("string")
    message = lambda role, *parts: F.struct(F.lit(role).alias("role"), F.array(*parts).alias("content"))
    return F.array(message("user", part("image", none, image), part("text", prompt, none)), message("assistant", part("text", answer, none)))


def numbered_names(rows: DataFrame, name: Column, order: Sequence[str]) -> DataFrame:
    """rows with file: a safe name and the row's number among those of its name, which may be the name of most rows."""
    rows = rollup.numbered(rows.withColumn("_name", F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")), "_name", order, "_number")
    return rows.withColumn("file", F.format_string("%s_line_%05d", "_name", "_number")).drop("_name", "_number")


def detector_set(rows: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(split, page, image, label, n): the label file of each page that has an image and a line, from yolo_rows() and pages
    (document, page, split, image). Without pages the rows have split and image."""
    ordered = F.array_sort(F.collect_list(F.struct("idx", "value")))
    own = [F.first(c).alias(c) for c in ("split", "image")] if pages is None else []
    texts = rows.groupBy("document", "page").agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "\n").alias("label"), F.count("*").alias("n"), *own)
    if pages is None:
        return texts.filter("image is not null").select("split", "page", "image", "label", "n")
    return pages.filter("image is not null").join(texts, ["document", "page"]).select("split", "page", "image", "label", "n")


def detector_counts(samples: DataFrame) -> DataFrame:
    """(split, images, lines) of detector_set()."""
    return samples.groupBy("split").agg(F.count("*").alias("images"), F.sum("n").alias("lines"))


def write_detector_set(samples: DataFrame, folder: str) -> DataFrame:
    """labels/<split>/<page>.txt, images/<split>/<page>.<ending> and data.yaml; returns detector_counts().

    Tasks write labels and copy images, each attempt under a name of its own first; the driver writes the few lines of data.yaml.
    """
    spark = samples.sparkSession
    folder = paths.qualified(spark, folder)

    def put(system, path: str, parts, attempt: int) -> None:
        with system.open_output_stream(f"{path}.{attempt}.part", compression=None) as out:
            for p in parts:
                out.write(p)
        system.move(f"{path}.{attempt}.part", path)

    def run(batch):
        system, base = paths.opened(folder)
        attempt = TaskContext.get().taskAttemptId()
        for r in batch:
            for kind in ("labels", "images"):
                system.create_dir(f"{base}/{kind}/{r.split}", recursive=True)
            put(system, f"{base}/labels/{r.split}/{r.page}.txt", [r.label.encode()], attempt)
            source, at = paths.opened(r.image)
            ending = r.image.rpartition(".")[2]
            with source.open_input_stream(at) as image:
                put(system, f"{base}/images/{r.split}/{r.page}.{ending}", iter(lambda: image.read(1 << 20), b""), attempt)

    samples.foreachPartition(run)
    counts = detector_counts(samples)
    system, base = paths.opened(folder)
    present = {r.split for r in counts.collect()}  # three at most
    lines = [f"path: {base}", *[f"{s}: images/{s}" for s in ("train", "val", "test") if s in present], "names:"]
    lines += [f"  {i}: {name}" for name, i in G.LINE_TYPES.items()]
    with system.open_output_stream(f"{base}/data.yaml", compression=None) as out:
        out.write(("\n".join(lines) + "\n").encode())
    return counts
