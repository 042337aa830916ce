"""Command line: python -m foliomill.cli score|predict|print|study|clean|lines-to-alto|prepare-yolo-lines ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="foliomill")
    commands = top.add_subparsers(dest="command", required=True)
    score = commands.add_parser("score", help="compare predicted with true pages")
    score.add_argument("-t", "--task", choices=("layout", "line", "htr", "all"), required=True)
    score.add_argument("-d", "--truth", required=True)
    score.add_argument("-p", "--found", required=True)
    score.add_argument("-o", "--output", required=True)
    score.add_argument("--metadata", action="store_true", help="score by what metadata.json says of documents")
    score.add_argument("--tables", help="a folder that keeps parsed pages, so that only new and changed files are opened")
    predict = commands.add_parser("predict", help="find blocks and lines and recognise texts, of pages that are not done yet")
    predict.add_argument("-t", "--task", choices=("layout", "line", "htr", "all"), default="all")
    predict.add_argument("--save-images", action="store_true", help="copy images beside the last task's pages")
    predict.add_argument("--cleanup-intermediate", action="store_true", help="remove the pages of all tasks but the last")
    predict.add_argument("-c", "--config", required=True)
    predict.add_argument("-d", "--data", required=True)
    predict.add_argument("-o", "--output", required=True)
    out = commands.add_parser("print", help="export texts of pages")
    out.add_argument("-p", "--pages", required=True)
    out.add_argument("-o", "--output", required=True)
    out.add_argument("--json", action="store_true")
    study = commands.add_parser("study", help="errors against the density of special characters")
    study.add_argument("-s", "--scores", required=True)
    study.add_argument("-p", "--pages", required=True)
    study.add_argument("-o", "--output", required=True)
    images = commands.add_parser("lines-to-alto", help="pages of one line from Parquet rows of line images")
    images.add_argument("-i", "--input", required=True)
    images.add_argument("-o", "--output", required=True)
    clean = commands.add_parser("clean", help="clean the texts of all pages; all else in the files stays")
    clean.add_argument("-i", "--input", required=True)
    clean.add_argument("-o", "--output", help="a folder for the pages; without it they are changed where they are")
    clean.add_argument("--extended", action="store_true", help="replace the extended set of signs too")
    yolo = commands.add_parser("prepare-yolo-lines", help="labels, images and data.yaml for a detector of lines")
    yolo.add_argument("-i", "--input", required=True)
    yolo.add_argument("-o", "--output", required=True)
    yolo.add_argument("--polygon", action="store_true")
    return top


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    from foliomill.sinks import paths

    spark = SparkSession.builder.appName("foliomill").getOrCreate()
    with paths.run(spark, a.command):  # what commands write by the way goes when they end
        return ran(spark, a)


def ran(spark: SparkSession, a: argparse.Namespace) -> int:
    from foliomill.plans import chain, config, reports, tasks
    from foliomill.sinks import alto as out_alto
    from foliomill.sinks import exports, paths
    from foliomill.sources import alto, files, page_table

    if a.command == "score":
        kept = lambda root, name: page_table.PageTable(spark, root, f"{a.tables}/{name}").refresh() if a.tables else alto.read_pages(spark, root)
        truth, found = kept(a.truth, "truth"), kept(a.found, "found")
        listed = files.structure(files.listed(spark, a.truth, "*.xml")).first()
        if not listed.ok:
            raise SystemExit(f"no pages in {a.truth}")
        for name in scored(tasks.scoreable(truth), a.task):
            own = (files.metadata(spark, a.truth) if a.metadata else None,) if name == "htr" else ()
            report = tasks.SCORERS[name](truth, found, *own)
            reports.shown(report["metrics"]).show(200, truncate=False)
            if name == "htr" and a.metadata:
                reports.feature_tables(report["metrics"]).show(200, truncate=False)
            reports.write(report, f"{a.output}/{name}", flat=listed.kind == "flat")
    elif a.command == "predict":
        own = config.Config.read(a.config)
        try:
            chain.predict(spark, own, a.data, a.output, config.ORDER if a.task == "all" else (a.task,), save_images=a.save_images, cleanup=a.cleanup_intermediate)
        except ValueError as e:
            raise SystemExit(str(e)) from e
    elif a.command == "print":
        lines = alto.lines(alto.read_pages(spark, a.pages), ignored=())
        if a.json:
            texts = exports.last_texts(lines, ["document", "page", "idx"], ["document"])
            exports.as_json(texts, ["document"]).write.partitionBy("document").text(a.output)
        else:
            exports.page_text_files(lines).write.partitionBy("document").json(a.output)
    elif a.command == "study":
        scores, _ = files.scores(spark, a.scores)
        pages = alto.read_pages(spark, a.pages)
        own = files.listed(spark, a.pages, "*.xml").select(F.coalesce("folder", F.lit("")).alias("_folder"), F.col("stem").alias("page"))
        texts = alto.page_texts_of(pages.select("document", "page"), alto.lines(pages, ignored=()))
        rooted = own.filter("_folder = ''").select("page", F.lit(True).alias("_root"))
        texts = texts.join(rooted, "page", "left").withColumn("document", F.when(F.col("_root").isNull(), F.col("document"))).drop("_root")
        rows = reports.with_densities(reports.scored_texts(scores, texts))
        exports.write_csv(rows, f"{a.output}/scores_with_density.csv")
        exports.write_csv(reports.density_study(rows), f"{a.output}/correlation.csv")
    elif a.command == "clean":
        texts = out_alto.with_clean_texts(page_table.opened(page_table.listed(spark, a.input)).filter("xml is not null"), a.extended)
        below = F.substring_index(files.decoded(F.col("path")), a.input.rstrip("/") + "/", -1)
        rows = texts.select(F.regexp_extract(below, r"^(.*)/[^/]*$", 1).alias("document"), F.regexp_extract(below, r"([^/]*)$", 1).alias("name"), F.encode("xml", "UTF-8").alias("data"), "modified")
        rows = paths.written(rows, "clean-pages")  # before the files it was read from are replaced
        out_alto.write_files(rows if a.output else rows.filter("modified > 0"), a.output or a.input)
        rows.agg(F.count("*").alias("pages"), F.sum("modified").alias("modified")).show()
    elif a.command == "lines-to-alto":
        rows = files.line_images(spark, a.input)
        out_alto.write_pages(out_alto.from_line_images(rows), a.output, files=True)
        out_alto.write_files(out_alto.line_image_files(rows), a.output)
    else:
        pages = alto.read_pages(spark, a.input)
        listed = files.listed(spark, a.input)
        split = files.splits(listed.filter("ending = '.xml'")).select(F.col("folder"), "stem", "split")
        paired = files.paired(split, listed).withColumnsRenamed({"folder": "document", "stem": "page"})
        rows = exports.yolo_rows(alto.lines(pages), pages, polygons=a.polygon)
        exports.write_detector_set(exports.detector_set(rows, paired), a.output).show()
    return 0


def scored(has, task: str) -> list[str]:
    """The tasks to score: the one asked for, or all that the pages can be scored for."""
    row = has.first()
    return [t for t in ("layout", "line", "htr") if (row[t] if task == "all" else t == task)]


if __name__ == "__main__":
    raise SystemExit(main())
