"""Data sets as folders: listing, structure, splits, pairs of pages and images, side files. Listings never open a file."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Endings of images in the order they are tried, names of splits in order of preference.
IMAGES = (".jpg", ".jpeg", ".png", ".tif", ".tiff")
SPLITS = {"train": ("train", "training"), "val": ("val", "valid", "validation", "dev"), "test": ("test", "testing")}


def decoded(path: Column) -> Column:
    """A path as it is, of one that is encoded as in a URI, where a plus sign stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def listed(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, folder, stem, ending, depth) of files in root (depth 0) and its folders that are not hidden (depth 1). Spark lists no empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    path = decoded(F.col("_metadata.file_path"))
    rows = files.select(path.alias("path"))
    base = root.rstrip("/").removeprefix("file://").rstrip("/") + "/"
    below = F.substring_index("path", base, -1)
    rows = rows.withColumn("_below", below)
    parts = F.split("_below", "/")
    return rows.filter((F.size(parts) <= 2) & ~F.get(parts, 0).startswith(".")).select(
        "path", F.when(F.size(parts) == 2, F.get(parts, 0)).alias("folder"),
        F.regexp_extract(F.element_at(parts, -1), r"^(.*?)(\.[^.]*)?$", 1).alias("stem"),
        F.lower(F.regexp_extract(F.element_at(parts, -1), r"(\.[^.]*)$", 1)).alias("ending"), (F.size(parts) - 1).alias("depth"),
    )


def structure(files: DataFrame) -> DataFrame:
    """One row: kind (flat, hierarchical, mixed, empty), n_root, n_folders, ok, message."""
    found = files.agg(F.count_if(F.col("depth") == 0).alias("n_root"), F.count_distinct(F.when(F.col("depth") == 1, F.col("folder"))).alias("n_folders"))
    kind = (
        F.when((F.col("n_root") > 0) & (F.col("n_folders") > 0), "mixed").when(F.col("n_root") > 0, "flat")
        .when(F.col("n_folders") > 0, "hierarchical").otherwise("empty")
    )
    found = found.withColumn("kind", kind).withColumn("ok", F.col("kind") != "empty")
    return found.withColumn("message", F.when(F.col("ok"), F.concat(F.lit("a "), "kind", F.lit(" data set"))).otherwise("no files"))


def best_images(images: DataFrame) -> DataFrame:
    """(folder, stem, image): of the images of one name the path of the first ending."""
    rank = F.array_position(F.array(*[F.lit(x) for x in IMAGES]), F.col("ending"))
    return images.withColumn("_rank", rank).filter("_rank > 0").groupBy("folder", "stem").agg(F.min_by("path", F.struct("_rank", "path")).alias("image"))


def paired(pages: DataFrame, images: DataFrame) -> DataFrame:
    """pages (folder, stem) with image: the path of the same folder, else of the root, first ending first; null without one."""
    best = best_images(images)
    own = best.withColumnRenamed("folder", "_folder").withColumnRenamed("stem", "_stem").withColumnRenamed("image", "_own")
    root = best.filter("folder is null").select(F.col("stem").alias("_stem2"), F.col("image").alias("_root"))
    rows = pages.join(own, F.col("folder").eqNullSafe(F.col("_folder")) & (F.col("stem") == F.col("_stem")), "left")
    rows = rows.join(root, F.col("stem") == F.col("_stem2"), "left")
    return rows.select(*pages.columns, F.coalesce("_own", "_root").alias("image"))


def paired_xml(images: DataFrame, xml: DataFrame, apart: DataFrame | None = None) -> DataFrame:
    """images (folder, stem, ...) with xml: the path of the page of the same folder and name, else of that folder among the pages
    apart (a listing of another root), else of the root there; null without one."""
    at = lambda rows, name: rows.select(F.col("folder").alias("_folder"), F.col("stem").alias("_stem"), F.col("path").alias(name))
    one = lambda rows, name: rows.groupBy("_folder", "_stem").agg(F.min(name).alias(name))
    kept, rows = images.columns, images
    places = [("_near", xml)] + ([("_apart", apart)] if apart is not None else [])
    for name, listed_ in places:
        own = one(at(listed_, name), name)
        rows = rows.join(own, F.col("folder").eqNullSafe(F.col("_folder")) & (F.col("stem") == F.col("_stem")), "left").drop("_folder", "_stem")
    found = [F.col(name) for name, _ in places]
    if apart is not None:
        root = one(at(apart.filter("folder is null"), "_root"), "_root")
        rows = rows.join(root.drop("_folder"), F.col("stem") == F.col("_stem"), "left").drop("_stem")
        found.append(F.col("_root"))
    return rows.select(*kept, F.coalesce(*found).alias("xml"))


def splits(files: DataFrame) -> DataFrame:
    """files with split: of each split the first of its names that has files. A data set without a train folder raises ValueError."""
    names = [(split, name, k) for split, all_ in SPLITS.items() for k, name in enumerate(all_)]
    names = files.sparkSession.createDataFrame(names, "split string, name string, _rank int")
    found = files.join(F.broadcast(names), F.lower("folder") == F.col("name"))  # a dozen fixed rows
    first = F.min("_rank").over(Window.partitionBy("split"))
    if found.filter("split = 'train'").isEmpty():
        raise ValueError("no files in a train folder")
    return found.withColumn("_first", first).filter("_rank = _first").drop("name", "_rank", "_first")


def is_split(files: DataFrame) -> DataFrame:
    """One row: has_splits, whether there is a train folder and one of val or test."""
    name = F.lower("folder")
    has = lambda *s: F.coalesce(F.bool_or(name.isin(*[n for x in s for n in SPLITS[x]])), F.lit(False))
    return files.agg((has("train") & has("val", "test")).alias("has_splits"))


def remaining(inputs: DataFrame, outputs: DataFrame, key: list[str] | None = None) -> DataFrame:
    """inputs of which outputs have none with the same key."""
    return inputs.join(outputs, key or ["document", "page"], "left_anti")


def parsed(json: Column) -> Column:
    """A JSON object's keys and values as text; null for what is none."""
    return F.from_json(json, "map<string, string>")


def metadata(spark: SparkSession, root: str) -> DataFrame:
    """(document, metadata: map<string, string>) of metadata.json files; what is no JSON object gives no row."""
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json").text(root)
    document = decoded(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1))
    return files.select(document.alias("document"), parsed(F.col("value")).alias("metadata")).filter("metadata is not null")


def conventions(meta: DataFrame) -> DataFrame:
    """(document, conventions: map<string, string>); empty where the metadata has none."""
    found = parsed(F.element_at("metadata", "conventions"))
    return meta.select("document", F.coalesce(found, F.create_map().cast("map<string, string>")).alias("conventions"))


def _present(spark: SparkSession, path: str) -> bool:
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(own)


def charset(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(character): the code points of all characters of the JSON files. A file that is not there gives a warning."""
    there = [p for p in paths if _present(spark, p)]
    for p in sorted(set(paths) - set(there)):
        warnings.warn(f"no character set {p}", stacklevel=2)
    if not there:
        return spark.createDataFrame([], "character string")
    paths = there
    rows = spark.read.option("multiLine", "true").schema("characters array<struct<character: string>>").json(paths)
    points = F.explode(F.split(F.col("c.character"), ""))
    return rows.select(F.explode("characters").alias("c")).select(points.alias("character")).filter("character <> ''").distinct()


def scores(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """Score rows of a CSV file (page, cer, wer and maybe document), and whether it has documents."""
    rows = spark.read.option("header", "true").csv(path)
    if absent := {"page", "cer", "wer"} - set(rows.columns):
        raise ValueError(f"{path} has no column {', '.join(sorted(absent))}")
    return rows.withColumn("cer", F.col("cer").try_cast("double")).withColumn("wer", F.col("wer").try_cast("double")), "document" in rows.columns


def named_charsets(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(set, character) of named JSON files, and of all together as merged. A file that is not there raises FileNotFoundError."""
    if absent := [n for n, p in paths.items() if not _present(spark, p)]:
        raise FileNotFoundError(f"no character set {', '.join(sorted(absent))}")
    rows = reduce(DataFrame.unionByName, [charset(spark, [p]).withColumn("set", F.lit(n)) for n, p in paths.items()])
    return rows.unionByName(rows.select("character").distinct().withColumn("set", F.lit("merged"))).select("set", "character")


def norms(spark: SparkSession, path: str, *, extended: bool = False) -> dict[str, str]:
    """Replacements of a CSV file (source, target, set) with some dozens of rows: those of the base set, or all."""
    rows = spark.read.option("header", "true").csv(path)
    rows = rows if extended else rows.filter("set = 'base'")
    return {r.source: r.target or "" for r in rows.filter("source is not null").limit(10_000).collect()}


def line_images(spark: SparkSession, path: str) -> DataFrame:
    """Lines of Parquet rows (shelfmark, region, line_type, text, width, height, ...), with what is absent filled in."""
    rows = spark.read.parquet(path)
    given = lambda c, default: F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in rows.columns else F.lit(default)
    return rows.withColumns({
        "shelfmark": given("shelfmark", "unknown"), "region": given("region", "MainZone"), "line_type": given("line_type", "DefaultLine"), "text": given("text", ""),
    })
