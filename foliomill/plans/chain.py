"""Prediction over a folder: layout, line and htr, one after the other, each going on where it was left.

A page's file in a task's output is the sign that it is done: files are written whole under another name and renamed, so a
listing tells what is left, and no page is read to find out. A task reads what the one before wrote, of the pages it has not done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.plans import tasks
from foliomill.plans.config import ORDER, Config
from foliomill.sinks import alto as out
from foliomill.sinks import paths
from foliomill.sources import alto, files

PAGE = ["document", "page"]


def done(spark: SparkSession, folder: str) -> DataFrame:
    """(document, page) of the pages that a task's output has, by listing it. document is empty for those in the folder itself."""
    if not files._present(spark, folder):
        return spark.createDataFrame([], "document string, page string")
    return _named(files.listed(spark, folder, "*.xml")).select(*PAGE)


def _named(listed: DataFrame) -> DataFrame:
    """A listing with document (the folder; empty for the root) and page."""
    return listed.withColumns({"document": F.coalesce("folder", F.lit("")), "page": F.col("stem")})


def images(spark: SparkSession, data: str) -> DataFrame:
    """(document, page, image) of a data folder: the path of each page's image, the first ending first."""
    return files.best_images(files.listed(spark, data)).select(F.coalesce("folder", F.lit("")).alias("document"), F.col("stem").alias("page"), "image")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """alto.read_pages() of a folder, with an empty document for pages in the folder itself."""
    root = folder.rstrip("/").rpartition("/")[2]
    rooted = _named(files.listed(spark, folder, "*.xml")).filter("document = ''").select("page", F.lit(root).alias("document"), F.lit(True).alias("_rooted"))
    rows = alto.read_pages(spark, folder).filter("width is not null or blocks is not null").join(rooted, PAGE, "left")
    return rows.withColumn("document", F.when(F.col("_rooted"), F.lit("")).otherwise(F.col("document"))).drop("_rooted")


def predicted(spark: SparkSession, name: str, settings: dict, data: str, before: str, folder: str, *, reading_order: str = "dbscan") -> DataFrame:
    """(document, page, xml) of what a task has not done in folder yet. before: the folder of the pages it starts from, data that of the
    images. Layout takes images; line takes pages that have an image; htr takes pages, with their images if there are any."""
    model, config = settings["type"], settings.get("config")
    finished = paths.joined_small(paths.written(done(spark, folder), "done-pages"))  # fixed, as the output goes to where it is listed
    if name == "layout":
        return tasks.predict_layout(files.remaining(images(spark, data), finished, PAGE), model, config, reading_order=reading_order)
    left = paths.written(files.remaining(pages(spark, before), finished, PAGE), f"{name}-pages")
    if name == "line":
        return tasks.predict_lines(left, images(spark, data), model, config, reading_order=reading_order)
    return tasks.predict_pages(left, finished, model, config)


def copied(spark: SparkSession, data: str, folder: str) -> None:
    """The images of data's pages that folder has, beside them; those that are there already are left alone."""
    rows = images(spark, data).join(done(spark, folder), PAGE, "left_semi").select("document", F.regexp_extract("image", r"([^/]+)$", 1).alias("name"), F.col("image").alias("source"))
    there = files.listed(spark, folder).select(F.coalesce("folder", F.lit("")).alias("document"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    out.copy_files(rows.join(there, ["document", "name"], "left_anti"), folder)


def predict(
    spark: SparkSession, own: Config, data: str, output: str, wanted: Sequence[str] = ORDER, *, save_images: bool = False, cleanup: bool = False
) -> list[str]:
    """Runs the configured tasks among wanted, in their order, and returns the folders of their pages.

    One task writes to output; several write to a folder of output each, named by the task, and each starts from the pages of the one
    before, the first from data. Unknown models fail before anything runs. No task configured raises ValueError.
    save_images: the pages' images go beside the last task's pages. cleanup: a task's folder is removed once the next has all its
    pages; a later run would begin anew there.
    """
    run = [t for t in ORDER if t in wanted and t in own.tasks]
    if not run:
        raise ValueError(f"the configuration has no task of {', '.join(wanted)}")
    for t in run:
        tasks.created(own.tasks[t]["type"], own.tasks[t].get("config"))
    before, folders = data, []
    for t in run:
        folder = output if len(run) == 1 else f"{output.rstrip('/')}/{t}"
        out.write_pages(predicted(spark, t, own.tasks[t], data, before, folder, reading_order=own.reading_order), folder, files=True)
        if cleanup and folders:
            paths.removed(spark, folders.pop())
        before = folder
        folders.append(folder)
    if save_images:
        copied(spark, data, folders[-1])
    return folders
